"""Which rules are to be evaluated at which timestamps.

A label of a rule is evaluated when all of its sources are complete, each with a change mark at every source label of the
period, and when its fingerprint over these marks is not the one it was last evaluated with. So a label with a gap waits, one that
was evaluated already is left alone, and one whose sources changed again is evaluated again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.timeaxis import window_grid
from tidegauge.operators.rules import Rule
from tidegauge.plans.cascade import source_fingerprints

LABEL = ["rule", "timestamp"]


def rule_links(spark, rules: Sequence[Rule]) -> DataFrame:
    """Links of :func:`~tidegauge.operators.rules.rule_timestamps_due`, from the rules' sources."""
    rows = [(rule.name, link.part, link.granularity, rule.granularity) for rule in rules for link in rule.sources]
    return spark.createDataFrame(rows, "rule string, part string, source_granularity string, target_granularity string")


def rule_fingerprints(rules: Sequence[Rule], labels: DataFrame, modified: DataFrame) -> DataFrame:
    """``rule, timestamp, max_modified, fingerprint`` of labels (``rule, timestamp``) from change marks."""
    marks = dict.fromkeys([rule.granularity for rule in rules], modified)
    prints = source_fingerprints(labels.withColumnRenamed("rule", "materialization"), rules, marks)
    return prints.withColumnRenamed("materialization", "rule")


def complete_labels(rules: Sequence[Rule], labels: DataFrame, modified: DataFrame) -> DataFrame:
    """``rule, timestamp, complete``: whether every source has a mark at every source label of the period.

    A label's grid has at most target / source granularity entries per source.
    """
    marks = modified.select("part", F.col("timestamp").alias("slot"), F.lit(1).alias("there"))
    grids = None
    for target in dict.fromkeys(rule.granularity for rule in rules):
        for source in dict.fromkeys(link.granularity for rule in rules if rule.granularity == target for link in rule.sources):
            links = [(r.name, link.part) for r in rules if r.granularity == target for link in r.sources if link.granularity == source]
            wanted = labels.join(labels.sparkSession.createDataFrame(links, "rule string, part string"), "rule")
            grid = wanted.select(*LABEL, "part", F.explode(window_grid(F.col("timestamp"), source, target)).alias("slot"))
            grids = grid if grids is None else grids.unionByName(grid)
    return grids.join(marks, ["part", "slot"], "left").groupBy(*LABEL).agg(
        (F.count(F.lit(1)) == F.count("there")).alias("complete")
    )


def gated(rules: Sequence[Rule], labels: DataFrame, modified: DataFrame, evaluated: DataFrame) -> DataFrame:
    """``rule, timestamp, fingerprint, complete, changed, runnable`` of labels (``rule, timestamp``).

    ``evaluated`` has the ``fingerprint`` each label was last evaluated with. Rules that are switched off are never runnable.
    """
    before = evaluated.select(*LABEL, F.col("fingerprint").alias("last"))
    on = [rule.name for rule in rules if rule.runnable]
    changed = ~F.col("fingerprint").eqNullSafe(F.col("last"))
    return (
        rule_fingerprints(rules, labels, modified)
        .join(complete_labels(rules, labels, modified), LABEL)
        .join(before, LABEL, "left")
        .select(*LABEL, "fingerprint", "complete", changed.alias("changed"), (F.col("complete") & changed & F.col("rule").isin(on)).alias("runnable"))
    )


def mark_evaluated(evaluated: DataFrame, done: DataFrame) -> DataFrame:
    """``evaluated`` (``rule, timestamp, fingerprint``) with the labels in ``done`` at their present fingerprints."""
    kept = evaluated.join(done.select(*LABEL), LABEL, "left_anti").select(*LABEL, "fingerprint")
    return kept.unionByName(done.select(*LABEL, "fingerprint"))
