"""Grouped aggregation over time, entities and parts.

All groupings combine map-side, so a hot entity or label only sends partial results.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import Col, as_column, names
from tidegauge.functions.timeaxis import Interval, bucket_index, bucket_start, floor_to_granularity, grid, map_label, period_start
from tidegauge.functions.types import data_type_order
from tidegauge.plans.spec import Trend

_AGGREGATES = {
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "avg": F.avg,
    "count": F.count,
}


def aggregate(function: str, column: Col) -> Column:
    """Aggregate by its metadata name, in any letter case."""
    try:
        return _AGGREGATES[function.strip().lower()](as_column(column))
    except KeyError:
        raise ValueError(f"unknown aggregation: {function!r}") from None


def samples(column: str | None) -> Column:
    """Record count of base records, or the summed sample counts of already rolled-up ones."""
    total = F.count(F.lit(1)) if column is None else F.sum(column)
    return total.cast("bigint").alias("samples")


def first_value(value: Col, order: Col) -> Column:
    """First non-NULL value by ``order``."""
    return F.min_by(as_column(value), F.when(as_column(value).isNotNull(), as_column(order)))


def last_value(value: Col, order: Col) -> Column:
    """Last non-NULL value by ``order``."""
    return F.max_by(as_column(value), F.when(as_column(value).isNotNull(), as_column(order)))


def max_data_type(name: Col) -> Column:
    """Widest declared type name of a group."""
    return F.max_by(as_column(name), data_type_order(name))


def sum_array(df: DataFrame, keys, column: str, alias: str | None = None) -> DataFrame:
    """Element-wise sum per group, cut to the group's shortest array; NULL arrays are skipped.

    Elements are summed per (group, position) with map-side combining and only then put
    together again, so what is collected per group is one sum per position.
    """
    by = names(keys)
    parts = df.filter(F.col(column).isNotNull()).select(*by, F.posexplode_outer(column).alias("pos", "item"))
    per_position = parts.groupBy(*by, "pos").agg(
        F.sum("item").alias("total"), F.count(F.lit(1)).alias("rows"), F.count("item").alias("present")
    )
    cell = F.struct(
        "pos", F.when(F.col("rows") == F.col("present"), F.col("total")).alias("total"), "rows"
    )
    # Every non-empty array has position 0; an empty one shows up under a NULL position.
    arrays = F.sum(F.when(F.coalesce(F.col("pos"), F.lit(0)) == 0, F.col("rows")))
    cells = F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), cell)))
    full = per_position.groupBy(*by).agg(cells.alias("cells"), arrays.alias("arrays"))
    kept = F.filter("cells", lambda c: c["rows"] == F.col("arrays"))
    sums = F.transform(kept, lambda c: c["total"])
    return full.select(*by, F.when(F.size(sums) > 0, sums).alias(alias or column))


def time_rollup(
    df: DataFrame,
    source: str,
    target: str,
    trends: Sequence[str] | Mapping[str, str],
    samples_from: str | None = None,
) -> DataFrame:
    """Roll records up to right-closed target periods, for all labels at once.

    ``trends`` is a list of columns to sum or a mapping of column to aggregate name.
    ``samples_from`` names the sample-count column of an already rolled-up source.
    """
    functions = trends if isinstance(trends, Mapping) else dict.fromkeys(trends, "sum")
    label = map_label("timestamp", source, target).alias("timestamp")
    return df.groupBy("entity_id", label).agg(
        samples(samples_from), *[aggregate(function, name).alias(name) for name, function in functions.items()]
    )


def rollup_at(df: DataFrame, label: Column, source: str, target: str, trends, samples_from: str | None = None) -> DataFrame:
    """One target period only; the bounds stay on the raw column, so they prune files."""
    inside = (F.col("timestamp") > period_start(label, target)) & (F.col("timestamp") <= label)
    return time_rollup(df.filter(inside), source, target, trends, samples_from)


def entity_rollup(
    df: DataFrame,
    relation: DataFrame,
    trends: Sequence[str] | Mapping[str, str],
    samples_from: str | None = None,
) -> DataFrame:
    """Aggregate records of related source entities onto the target entity, per timestamp."""
    functions = trends if isinstance(trends, Mapping) else dict.fromkeys(trends, "sum")
    edges = relation.select(F.col("source_id").alias("entity_id"), "target_id")
    return (
        df.join(edges, "entity_id")
        .groupBy("timestamp", F.col("target_id").alias("entity_id"))
        .agg(samples(samples_from), *[aggregate(fn, name).alias(name) for name, fn in functions.items()])
    )


def aggregate_by_metadata(
    df: DataFrame,
    trends: Sequence[Trend],
    source: str,
    target: str | None = None,
    relation: DataFrame | None = None,
    samples_from: str | None = None,
) -> DataFrame:
    """Rollup whose aggregate per column comes from the trend metadata.

    With ``target`` a rollup over time, with ``relation`` one over entities.
    """
    if relation is not None:
        functions = {trend.name: trend.entity_aggregation for trend in trends}
        return entity_rollup(df, relation, functions, samples_from)
    functions = {trend.name: trend.time_aggregation for trend in trends}
    return time_rollup(df, source, target, functions, samples_from)


def daily_max_report(df: DataFrame, trend: str) -> DataFrame:
    return df.groupBy(F.to_date("timestamp").alias("date")).agg(F.max(trend).alias(f"max_{trend}"))


def analyze_part(df: DataFrame, trends: Sequence[str]) -> DataFrame:
    """Smallest and largest value of every trend as text: one pass, then one row per trend."""
    bounds = df.agg(
        *[F.min(name).cast("string").alias(f"min_{name}") for name in trends],
        *[F.max(name).cast("string").alias(f"max_{name}") for name in trends],
    )
    rows = [
        F.struct(
            F.lit(name).alias("trend"),
            F.col(f"min_{name}").alias("min_value"),
            F.col(f"max_{name}").alias("max_value"),
        )
        for name in trends
    ]
    return bounds.select(F.inline(F.array(*rows)))


def part_stats(df: DataFrame, part: str) -> DataFrame:
    """Record count per (part, timestamp)."""
    return df.groupBy(F.lit(part).alias("part"), "timestamp").agg(F.count(F.lit(1)).alias("count"))


def completeness(stats: DataFrame, granularity: str, start: Column, end: Column) -> DataFrame:
    """Record count for every boundary between ``start`` and ``end``, 0 where nothing was stored.

    ``start`` and ``end`` are constant expressions; both are truncated to the granularity.
    """
    gran = Interval.of(granularity)

    def truncated(ts: Column) -> Column:
        if gran.months or gran.seconds in (3600, 86400, 604800):
            return floor_to_granularity(ts, gran)
        return bucket_start(bucket_index(ts, gran), gran)

    first, last = truncated(start), truncated(end)
    boundaries = stats.sparkSession.range(1).select(F.explode(grid(first, last, gran)).alias("timestamp"))
    counts = stats.filter(F.col("timestamp").between(first, last)).select("timestamp", "count")
    return (
        boundaries.join(counts, "timestamp", "left")
        .select("timestamp", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))
        .orderBy("timestamp")
    )


def max_modified(modified: DataFrame, part: str, before: Column) -> DataFrame:
    """Latest modification of a part's records labelled strictly before ``before``."""
    return modified.filter((F.col("part") == part) & (F.col("timestamp") < before)).agg(
        F.max("last").alias("max_modified")
    )


def max_modified_at(records: DataFrame, ts: Column) -> DataFrame:
    """Latest modification among the records at one timestamp."""
    return records.filter(F.col("timestamp") == ts).agg(F.max("modified").alias("max_modified"))


def execution_metrics(jobs: DataFrame) -> DataFrame:
    """Number of runs and total run time per materialization from its job log."""
    seconds = F.timestamp_diff("MICROSECOND", F.col("started"), F.col("finished"))
    return jobs.groupBy("materialization").agg(
        F.count(F.lit(1)).alias("execution_count"), F.sum(seconds).alias("total_duration_us")
    )
