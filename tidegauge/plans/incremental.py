"""Incremental recomputation: change log to touched labels to replaced labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.timeaxis import map_label
from tidegauge.operators.aggregates import time_rollup
from tidegauge.operators.changes import replace_timestamps
from tidegauge.session import cut_lineage
from tidegauge.sources.factstore import FactStore


def touched_labels(changed: DataFrame, source: str, target: str) -> DataFrame:
    """Target labels whose period holds a changed source label."""
    return changed.select(map_label("timestamp", source, target).alias("timestamp")).distinct()


def records_of_labels(records: DataFrame, labels: DataFrame, source: str, target: str) -> DataFrame:
    """Source records belonging to the given target labels."""
    wanted = labels.select(F.col("timestamp").alias("__label"))
    labelled = records.withColumn("__label", map_label("timestamp", source, target))
    return labelled.join(wanted, "__label", "left_semi").drop("__label")


def incremental_rollup(
    records: DataFrame, destination: DataFrame, changed: DataFrame, source: str, target: str, trends: Sequence[str],
    now: Column, job_id: int, samples_from: str | None = None,
) -> DataFrame:
    """Destination after recomputing the labels touched by ``changed`` source timestamps.

    ``changed`` (``timestamp``) is one row per label and small next to the records, which are
    filtered by a semi-join before they are aggregated. Labels whose source records are all
    gone disappear.
    """
    labels = touched_labels(changed, source, target)
    touched = records_of_labels(records, labels, source, target)
    fresh = time_rollup(touched, source, target, trends, samples_from)
    return replace_timestamps(destination, fresh, labels, now, job_id, within_labels=True)


def incremental_rollup_stored(
    source_store: FactStore, destination_store: FactStore, changed: DataFrame, source: str, target: str,
    trends: Sequence[str], now: Column, job_id: int, samples_from: str | None = None,
) -> None:
    """The same between two stores: reads and rewrites only the buckets the touched labels need."""
    labels = cut_lineage(touched_labels(changed, source, target))
    records = source_store.of_periods(labels, target)
    touched = records_of_labels(records, labels, source, target)
    fresh = time_rollup(touched, source, target, trends, samples_from)
    destination_store.replace(fresh, labels, now, job_id, within_labels=True)
