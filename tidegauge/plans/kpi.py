"""KPIs computed from trends that may live in several parts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.timeaxis import map_label
from tidegauge.functions.types import spark_type
from tidegauge.operators.aggregates import aggregate
from tidegauge.operators.joins import join_parts
from tidegauge.plans.spec import KEY, KPI_GRANULARITIES

# Part name -> granularity -> records.
Catalog = Mapping[str, Mapping[str, DataFrame]]
_RESOLVE_AT = "1d"


def parts_of(catalog: Catalog, trends: Sequence[str]) -> list[str]:
    """Parts the trends are read from, resolved at one day, without repeats and sorted."""
    found = set()
    for trend in trends:
        owner = next((name for name in sorted(catalog)
                      if _RESOLVE_AT in catalog[name] and trend in catalog[name][_RESOLVE_AT].columns), None)
        if owner is None:
            raise ValueError(f"no part has trend {trend!r}")
        found.add(owner)
    return sorted(found)


def project_kpi(df: DataFrame, expression: str, name: str, data_type: str = "numeric") -> DataFrame:
    """``timestamp, entity_id`` and one expression over the record."""
    return df.select("timestamp", "entity_id", F.expr(expression).cast(spark_type(data_type)).alias(name))


def kpi_from_trends(
    catalog: Catalog, trends: Sequence[str], definition: str, name: str, data_type: str = "numeric",
    aggregated: bool = False, granularities: Sequence[str] = tuple(KPI_GRANULARITIES),
) -> dict[str, DataFrame]:
    """KPI records per granularity; one with a source part missing is left out.

    Only the wanted trends of each part are read. ``aggregated`` is for a definition made of
    aggregates, evaluated per (entity, timestamp).
    """
    parts = parts_of(catalog, trends)
    result = {}
    for granularity in granularities:
        if any(granularity not in catalog[part] for part in parts):
            continue
        taken: set[str] = set()
        slim = []
        for part in parts:
            df = catalog[part][granularity]
            columns = [t for t in dict.fromkeys(trends) if t in df.columns and t not in taken]
            taken.update(columns)
            slim.append(df.select(*KEY, *columns))
        joined = join_parts(slim)
        value = F.expr(definition).cast(spark_type(data_type)).alias(name)
        result[granularity] = joined.groupBy(*KEY).agg(value) if aggregated else joined.select(*KEY, value)
    return result


def kpi_at_granularities(
    parts: Mapping[str, DataFrame], source: str, targets: Sequence[str], trends: Mapping[str, str], definition: str, name: str,
    data_type: str = "numeric",
) -> DataFrame:
    """``granularity, entity_id, timestamp`` and a KPI over rolled-up trends, for all ``targets`` from one pass.

    ``parts`` has records at granularity ``source``; ``trends`` names the aggregate of each wanted trend, one that ignores nulls. A
    record is expanded to its label at every target and all are aggregated together, with one shuffle; parts that are the
    same DataFrame are scanned once. A label that one of the trends' parts has no record at is left out.
    """
    owners = {trend: next((part for part in sorted(parts) if trend in parts[part].columns), None) for trend in trends}
    if None in owners.values():
        raise ValueError(f"no part has trend {next(trend for trend, part in owners.items() if part is None)!r}")
    tables: list[tuple[DataFrame, list[str]]] = []
    for part in sorted(set(owners.values())):
        shared = next((names for table, names in tables if table is parts[part]), None)
        if shared is None:
            tables.append((parts[part], [part]))
        else:
            shared.append(part)
    rows = None
    for number, (table, names) in enumerate(tables):
        own = table.select(*KEY, F.lit(number).alias("__table"), *[trend for trend, part in owners.items() if part in names])
        rows = own if rows is None else rows.unionByName(own, allowMissingColumns=True)
    labels = [
        F.struct(F.lit(target).alias("granularity"), (map_label("timestamp", source, target) if target != source else F.col("timestamp")).alias("label"))
        for target in targets
    ]
    expanded = rows.withColumn("__at", F.explode(F.array(*labels)))
    present = [F.count_if(F.col("__table") == number).alias(f"__rows_{number}") for number in range(len(tables))]
    rolled = expanded.groupBy("entity_id", F.col("__at.granularity").alias("granularity"), F.col("__at.label").alias("timestamp")).agg(
        *[aggregate(function, trend).alias(trend) for trend, function in trends.items()], *present
    )
    for number in range(len(tables)):
        rolled = rolled.filter(F.col(f"__rows_{number}") > 0)
    return rolled.select("granularity", *KEY, F.expr(definition).cast(spark_type(data_type)).alias(name))


def resolve_view_sources(parts: DataFrame, edges: DataFrame) -> DataFrame:
    """Base parts behind each name: a view's sources, a table itself.

    ``parts``: ``name``; ``edges``: ``view, source``.
    """
    return parts.join(edges.withColumnRenamed("view", "name"), "name", "left").select(
        "name", F.coalesce("source", "name").alias("source")
    )
