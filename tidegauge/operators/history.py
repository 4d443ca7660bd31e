"""Attribute history: change detection, staging, run-length compaction and lookup.

A history row is ``id, first_appearance, modified, hash, entity_id, timestamp, end`` plus the
attributes; (entity_id, timestamp) is unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import other_columns
from tidegauge.functions.fingerprints import attribute_hash
from tidegauge.operators.aggregates import last_value
from tidegauge.operators.joins import as_of_latest
from tidegauge.operators.numbering import next_id, with_dense_ids
from tidegauge.operators.slices import AUTO, with_previous, with_run_start
from tidegauge.plans.spec import KEY

BASE = ("id", "first_appearance", "modified", "hash", "entity_id", "timestamp", "end")


def attribute_changes(history: DataFrame, width=AUTO) -> DataFrame:
    """Flag rows whose hash differs from the entity's previous row; a first row counts as a change."""
    slim = history.select(*KEY, "hash")
    changed = with_previous(slim, "entity_id", "timestamp", "hash", "before", width)
    return changed.select(
        *KEY, F.coalesce(F.col("hash") != F.col("before.value"), F.lit(True)).alias("change")
    )


def mark_runs(history: DataFrame, width=AUTO, name: str = "run") -> DataFrame:
    """Add the timestamp at which the row's run of equal hashes started."""
    return with_run_start(history, "entity_id", "timestamp", "hash", name, width)


def attribute_run_length(history: DataFrame, width=AUTO) -> DataFrame:
    """One row per run of equal consecutive hashes of an entity."""
    slim = history.select("id", *KEY, "first_appearance", "modified", "hash")
    runs = mark_runs(slim, width).groupBy("entity_id", "run").agg(
        F.min("id").alias("id"),
        F.min("timestamp").alias("start"),
        F.max("timestamp").alias("end"),
        F.min("first_appearance").alias("first_appearance"),
        F.max("modified").alias("modified"),
        F.count(F.lit(1)).alias("run_length"),
    )
    return runs.select("id", "entity_id", "start", "end", "first_appearance", "modified", "run_length")


def staging_new(staging: DataFrame, history: DataFrame, order: str | None = None) -> DataFrame:
    """Staged keys not in the history yet, one row per key with the last non-NULL attributes.

    ``order`` is the column telling which of several staged rows of a key came last.
    """
    fresh = staging.join(history.select(*KEY), list(KEY), "left_anti")
    attributes = other_columns(staging, [*KEY, *([order] if order else [])])
    position = order or "timestamp"
    return fresh.groupBy(*KEY).agg(*[last_value(name, position).alias(name) for name in attributes])


def staging_modified(staging: DataFrame, history: DataFrame) -> DataFrame:
    """Staged rows whose key already exists in the history."""
    return staging.join(history.select(*KEY), list(KEY), "left_semi")


def transfer_staged(
    history: DataFrame, staging: DataFrame, attributes: Sequence[str], now: Column, order: str | None = None,
    arrays: Sequence[str] = (), after: Column | int | None = None,
) -> DataFrame:
    """History after taking over the staged rows.

    New keys are appended with fresh ids, counted on from ``after`` or from the history's largest; existing keys get all staged attributes, a new
    ``modified`` and a recomputed hash. The history is scanned and shuffled once, on its key.
    """
    new = with_dense_ids(staging_new(staging, history, order), KEY, after=next_id(history) if after is None else after)
    inserted = new.select(
        "id", now.alias("first_appearance"), now.alias("modified"),
        attribute_hash(attributes, arrays).alias("hash"), *KEY,
        F.lit(None).cast("timestamp_ntz").alias("end"), *attributes,
    )
    position = order or "timestamp"
    values = F.struct(*attributes)
    staged = staging.groupBy(*KEY).agg(F.max_by(values, position).alias("staged"))
    hit = F.col("staged").isNotNull()
    merged = history.join(staged, list(KEY), "left")
    for name in attributes:
        merged = merged.withColumn(name, F.when(hit, F.col(f"staged.{name}")).otherwise(F.col(name)))
    merged = merged.withColumn("modified", F.when(hit, now).otherwise(F.col("modified"))).withColumn(
        "hash", F.when(hit, attribute_hash(attributes, arrays)).otherwise(F.col("hash"))
    )
    columns = [*BASE, *attributes]
    return merged.select(*columns).unionByName(inserted.select(*columns))


def attribute_compact(
    history: DataFrame, attributes: Sequence[str], now: Column, after_id: int = 0, up_to_id: int | None = None,
    width=AUTO,
) -> DataFrame:
    """History with every run of equal consecutive rows replaced by its first row and an end.

    Only entities with rows numbered above ``after_id`` take part (the first of them no later
    than ``up_to_id``); all other rows just get ``end = timestamp`` where it is missing.
    """
    filled = history.withColumn("end", F.coalesce("end", "timestamp"))
    untouched = None
    if after_id > 0 or up_to_id is not None:
        first_new = history.filter(F.col("id") > after_id).groupBy("entity_id").agg(F.min("id").alias("first_id"))
        touched = first_new if up_to_id is None else first_new.filter(F.col("first_id") <= up_to_id)
        touched = touched.select("entity_id")
        untouched = filled.join(touched, "entity_id", "left_anti")
        filled = filled.join(touched, "entity_id", "left_semi")
    row = F.struct("hash", *attributes)
    runs = mark_runs(filled, width).groupBy("entity_id", "run").agg(
        F.min("id").alias("id"),
        F.max("end").alias("single_end"),
        F.max("timestamp").alias("last"),
        F.min("first_appearance").alias("first_appearance"),
        F.max("modified").alias("single_modified"),
        F.count(F.lit(1)).alias("rows"),
        F.min_by(row, "timestamp").alias("row"),
    )
    several = F.col("rows") > 1
    compacted = runs.select(
        "id", "first_appearance", F.when(several, now).otherwise(F.col("single_modified")).alias("modified"),
        F.col("row.hash").alias("hash"), "entity_id", F.col("run").alias("timestamp"),
        F.when(several, F.col("last")).otherwise(F.col("single_end")).alias("end"),
        *[F.col(f"row.{name}").alias(name) for name in attributes],
    )
    if untouched is None:
        return compacted
    return compacted.unionByName(untouched.select(*compacted.columns))


def attribute_current(history: DataFrame, attributes: Sequence[str], now: Column, width=AUTO) -> DataFrame:
    """Latest compacted row per entity."""
    return as_of_latest(attribute_compact(history, attributes, now, width=width))


def attribute_at(history: DataFrame, ts: Column) -> DataFrame:
    """Latest row per entity at or before ``ts``."""
    return as_of_latest(history, ts)


def entity_attribute_at(history: DataFrame, entity_id, ts: Column) -> DataFrame:
    """Latest row of one entity at or before ``ts``; the entity filter reaches the scan."""
    return as_of_latest(history.filter(F.col("entity_id") == entity_id), ts)


def sampled_view_materialize(
    history: DataFrame, view: DataFrame, attributes: Sequence[str], sampled_at: Column, now: Column
) -> DataFrame:
    """Take the view's present rows as staged attributes at one timestamp and transfer them."""
    staging = view.select("entity_id", sampled_at.alias("timestamp"), *attributes)
    return transfer_staged(history, staging, attributes, now)


def history_markers(histories: DataFrame, marks: DataFrame) -> DataFrame:
    """Last history id per store, its compaction mark and whether compaction is due.

    ``histories`` has ``store, id``; ``marks`` has ``store, compacted``.
    """
    last = histories.groupBy("store").agg(F.max("id").alias("last_id"))
    due = F.col("last_id") > F.coalesce("compacted", F.lit(0))
    return last.join(marks, "store", "left").select(
        "store", "last_id", F.coalesce("compacted", F.lit(0)).cast("bigint").alias("compacted"),
        due.alias("requires_compacting"),
    )


def advance_marker(marks: DataFrame, updates: DataFrame, column: str, key: str = "store") -> DataFrame:
    """Merge marker updates; a marker never moves back."""
    return marks.unionByName(updates).groupBy(key).agg(F.max(column).alias(column))


def first_appearance_backfill(history: DataFrame) -> DataFrame:
    """Histories written before ``first_appearance`` existed get it from ``modified``."""
    return history.withColumn("first_appearance", F.col("modified"))
