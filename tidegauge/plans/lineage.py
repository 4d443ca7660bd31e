"""Transitive dependers over an edge table."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.session import cut_lineage


def lineage_closure(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """``(root, name, level, paths)`` of everything that depends on each root, over ``(source, depender)``.

    ``paths`` is the number of ways in which the depender is reached at that level; each level is at most one row per
    (root, depender). Every level is written out, so none is ever computed twice. Chains may have any length; a cycle
    raises ``ValueError``.
    """
    step = edges.select("source", "depender")
    counted = (
        roots.select(F.col("name").alias("root")).distinct()
        .join(step.withColumnRenamed("source", "root"), "root")
        .groupBy("root", F.col("depender").alias("name")).agg(F.count(F.lit(1)).alias("paths"))
    )
    levels: list[DataFrame] = []
    while True:
        frontier = cut_lineage(counted)
        if frontier.isEmpty():
            break
        levels.append(frontier.withColumn("level", F.lit(len(levels) + 1)))
        if len(levels) & (len(levels) - 1) == 0:  # at levels 1, 2, 4, 8 and so on
            _refuse_cycle(levels, frontier)
        counted = (
            frontier.withColumnRenamed("name", "source")
            .join(step, "source")
            .groupBy("root", F.col("depender").alias("name")).agg(F.sum("paths").alias("paths"))
        )
    if not levels:
        levels = [counted.withColumn("level", F.lit(1))]
    return functools.reduce(DataFrame.unionByName, levels).select("root", "name", "level", "paths")


def _refuse_cycle(levels: list[DataFrame], frontier: DataFrame) -> None:
    """A path with more steps than its root has dependers passes one of them, or the root itself, twice."""
    names = functools.reduce(DataFrame.unionByName, [level.select("root", "name") for level in levels]).distinct()
    reached = names.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.max((F.col("name") == F.col("root"))).alias("itself"))
    if not frontier.join(reached, "root").filter((F.col("n") < len(levels)) | F.col("itself")).isEmpty():
        raise ValueError("the dependencies have a cycle")
