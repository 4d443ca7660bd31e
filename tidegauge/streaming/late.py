"""Rows that arrive behind a stream's watermark, noted and made up for.

A streaming aggregate drops a record once its period lies further behind the newest than the lateness. Here the same records also
go to a store, and the timestamps of those that come late go into the change marks. The batch path then computes the labels
of the marked timestamps again from all stored records and replaces them whole.

What counts as late is a little more than the aggregate drops: the newest label of all earlier batches decides, and the
aggregate's watermark never passes that. So a marked label may have been complete, but no incomplete one is left unmarked.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidegauge.functions.timeaxis import map_label, minus
from tidegauge.plans.cascade import record_modified
from tidegauge.plans.incremental import incremental_rollup_stored
from tidegauge.session import cut_lineage, written_once
from tidegauge.sources.factstore import FactStore
from tidegauge.streaming.jobs import REPROCESSING_PERIOD, VersionedTable

HORIZON = "newest timestamp_ntz"


def horizon(spark, path: str) -> VersionedTable:
    """The newest label a stream has seen, one row."""
    return VersionedTable(spark, path, HORIZON)


def keep_records(
    records: DataFrame, part: str, source: str, target: str, store: FactStore, modified: FactStore, seen: VersionedTable,
    now: Callable[[int], Column], lateness: str = REPROCESSING_PERIOD,
) -> DataStreamWriter:
    """Store arriving records of ``part`` by the store's key, and mark the timestamps of those behind the watermark.

    A batch that is run again stores the same rows and sets the same marks.
    """

    def keep(batch: DataFrame, number: int) -> None:
        label = map_label("timestamp", source, target)
        with written_once(batch) as rows:
            store.put(rows)
            before = seen.before(number)
            limit = before.select(minus("newest", lateness).alias("limit")).agg(F.max("limit").alias("limit")).scalar()
            late = rows.filter(label <= limit).select(F.lit(1).alias("id"), F.lit(part).alias("part"), "timestamp").distinct()
            record_modified(modified, late.withColumn("modified", now(number)))
            newest = before.unionByName(rows.select(label.alias("newest"))).agg(F.max("newest").alias("newest"))
            seen.write(number, newest)

    return records.writeStream.foreachBatch(keep)


def make_up_rollup(
    records: FactStore, destination: FactStore, modified: FactStore, part: str, source: str, target: str, trends: Sequence[str],
    now: Column, job_id: int, samples_from: str | None = None,
) -> None:
    """Roll the marked timestamps' labels up again from all stored records, and take the marks away."""
    with written_once(modified.read().filter(F.col("part") == part)) as marks:
        changed = marks.select("timestamp").distinct()
        incremental_rollup_stored(records, destination, changed, source, target, trends, now, job_id, samples_from)
        modified.exchange(marks.limit(0), marks)


def make_up_counts(records: FactStore, counts: FactStore, modified: FactStore, part: str) -> None:
    """Count the records at the marked timestamps again, for :func:`~tidegauge.streaming.jobs.completeness`; take the marks away."""
    with written_once(modified.read().filter(F.col("part") == part)) as marks:
        changed = cut_lineage(marks.select("timestamp").distinct())
        stored = records.having(changed).groupBy("timestamp").agg(F.count(F.lit(1)).alias("count"))
        counts.put(stored.select(F.lit(part).alias("part"), "timestamp", "count"))
        modified.exchange(marks.limit(0), marks)
