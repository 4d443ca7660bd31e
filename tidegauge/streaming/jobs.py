"""The incremental jobs as Structured Streaming queries.

Every job takes a streaming DataFrame and a checkpoint folder. State lives in that folder and
in tables written per micro-batch; a batch that is run again after a failure writes the same
rows again (merges are idempotent, appended files go to a folder named after the batch).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidegauge.functions.columns import other_columns
from tidegauge.functions.timeaxis import NTZ, map_label
from tidegauge.operators.aggregates import samples
from tidegauge.operators.rules import NOTIFICATION_KEY, Rule
from tidegauge.plans.cascade import record_modified
from tidegauge.session import written_once
from tidegauge.sources.factstore import FactStore, emit_modified
from tidegauge.sources.loading import EntityStore

# Lets a source period still arrive for as long as a materialization is reprocessed.
REPROCESSING_PERIOD = "3 days"


class VersionedTable:
    """A table of one row per entity, such as current attributes, rewritten per micro-batch.

    A batch reads the newest older version, so running it again gives the same result and
    readers of the previous version are not disturbed. The ``keep`` newest versions stay.
    """

    def __init__(self, spark, path: str, schema: str, keep: int = 3):
        self.spark, self.path, self.schema, self.keep = spark, path, T.StructType.fromDDL(schema), keep

    def _folder(self, batch: int) -> str:
        return f"{self.path}/version={batch}"

    def _versions(self) -> list[int]:
        """Numbers of the complete versions, from the folder listing."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = files.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/version=*/_SUCCESS")) or []
        return sorted(int(item.getPath().getParent().getName().split("=")[1]) for item in found)

    def before(self, batch: int | None = None) -> DataFrame:
        older = [number for number in self._versions() if batch is None or number < batch]
        if not older:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._folder(older[-1]))

    def write(self, batch: int, rows: DataFrame) -> None:
        rows.select(*self.schema.names).write.mode("overwrite").parquet(self._folder(batch))
        for number in [number for number in self._versions() if number <= batch][: -self.keep]:
            old = self.spark._jvm.org.apache.hadoop.fs.Path(self._folder(number))
            old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, True)

    def read(self) -> DataFrame:
        return self.before()


MODIFIED_SCHEMA = "part string, timestamp timestamp_ntz, first timestamp_ntz, last timestamp_ntz"


def ingest(
    rows: DataFrame, part: str, store: FactStore, entities: EntityStore, modified: FactStore, now: Callable[[int], Column],
    job_id: Callable[[int], int] = lambda batch: batch, order: str | None = None,
) -> DataStreamWriter:
    """Arriving rows (``entity, timestamp, trends``): resolve entities, merge, mark what changed.

    Only the buckets of the batch's names and timestamps are read and written. A repeated batch finds its entities, overwrites
    its own keys and sets the same marks.
    """

    def store_batch(batch: DataFrame, number: int) -> None:
        moment = now(number)
        with written_once(batch) as rows_:
            entities.add(rows_.select(F.col("entity").alias("name")), moment)
            with written_once(entities.resolve(rows_)) as resolved:
                store.upsert(resolved, moment, job_id(number), order)
                record_modified(modified, emit_modified(resolved, part, moment).withColumn("id", F.lit(1)))

    return rows.writeStream.foreachBatch(store_batch)


def process_log(log: DataFrame, modified: FactStore) -> DataStreamWriter:
    """Keep the stored ``modified`` rows up to date with an arriving modified log.

    The checkpoint takes the place of a high-water mark: each log row is in one batch. Only
    the time buckets of changed labels are rewritten.
    """

    def merge(batch: DataFrame, number: int) -> None:
        record_modified(modified, batch, start_id=-1)

    return log.writeStream.foreachBatch(merge)


def modified_store(spark, path: str, partition_size: str = "1 day") -> FactStore:
    return FactStore(spark, path, MODIFIED_SCHEMA, partition_size, key=("part", "timestamp"))


def rollup(
    records: DataFrame, source: str, target: str, trends: Sequence[str], lateness: str = REPROCESSING_PERIOD
) -> DataFrame:
    """Right-closed rollup of arriving records.

    Records later than ``lateness`` behind the newest are dropped; in append mode a period
    comes out once it can no longer change, in update mode whenever it does.
    """
    labelled = records.select(
        "entity_id", map_label("timestamp", source, target).cast("timestamp").alias("timestamp"), *trends
    )
    rolled = (
        labelled.withWatermark("timestamp", lateness)
        .groupBy("entity_id", "timestamp")
        .agg(samples(None), *[F.sum(name).alias(name) for name in trends])
    )
    return rolled.withColumn("timestamp", F.col("timestamp").cast(NTZ))


NOTIFICATION_SCHEMA = (
    "entity_id bigint, timestamp timestamp_ntz, rule_id int, created timestamp_ntz, weight int, details string, data string"
)


def notification_store(spark, path: str, partition_size: str = "1 day") -> FactStore:
    return FactStore(spark, path, NOTIFICATION_SCHEMA, partition_size, key=("entity_id", "timestamp", "rule_id"))


def notify(
    kpi: DataFrame, rule: Rule, store: FactStore, now: Callable[[int], Column], exceptions: DataFrame | None = None,
    weight_exceptions: DataFrame | None = None,
) -> DataStreamWriter:
    """Arriving KPI rows to stored notifications, one per (entity, timestamp, rule).

    Of several rows of a key the one with the largest (weight, details, data) is kept. That is the same whatever order they arrive in, at
    whatever distance, and however often a batch is run, as the stored row takes part; ``created`` tells when the kept row
    came first. Rows without data or weight are left out. The store is the state: nothing has to be remembered beside it.
    """
    best = ["weight", "details", "data"]

    def merge(batch: DataFrame, number: int) -> None:
        found = rule.evaluate(batch, exceptions, weight_exceptions).filter(F.col("data").isNotNull() & F.col("weight").isNotNull())
        fresh = found.select("entity_id", "timestamp", F.lit(rule.id).alias("rule_id"), now(number).alias("created"), *best)
        with written_once(fresh) as rows:
            store.merge(rows, lambda stored: _best_of(stored.unionByName(rows.select(*stored.columns)), best))

    return kpi.writeStream.foreachBatch(merge)


def _best_of(rows: DataFrame, best: Sequence[str]) -> DataFrame:
    """One row per notification: the largest by ``best``, created when it first was."""
    earliest = rows.groupBy(*NOTIFICATION_KEY, *best).agg(F.min("created").alias("created"))
    top = earliest.groupBy(*NOTIFICATION_KEY).agg(F.max(F.struct(*best, "created")).alias("row"))
    return top.select(*[name if name in NOTIFICATION_KEY else F.col(f"row.{name}") for name in rows.columns])


def attribute_current(history: DataFrame) -> DataFrame:
    """Latest attributes per entity of an arriving history; use in update or complete mode."""
    rest = other_columns(history, ["entity_id"])
    latest = history.groupBy("entity_id").agg(F.max_by(F.struct(*rest), "timestamp").alias("row"))
    return latest.select("entity_id", *[F.col(f"row.{name}") for name in rest])


def completeness(records: DataFrame, part: str, lateness: str = REPROCESSING_PERIOD) -> DataFrame:
    """Record count per (part, timestamp) of arriving records."""
    timed = records.select(F.lit(part).alias("part"), F.col("timestamp").cast("timestamp").alias("timestamp"))
    counted = timed.withWatermark("timestamp", lateness).groupBy("part", "timestamp").agg(F.count(F.lit(1)).alias("count"))
    return counted.withColumn("timestamp", F.col("timestamp").cast(NTZ))


def keep_latest(updates: DataFrame, table: VersionedTable, key: Sequence[str]) -> DataStreamWriter:
    """Merge an update-mode aggregate into a table: the newest row per key replaces the older."""

    def merge(batch: DataFrame, number: int) -> None:
        old = table.before(number).join(batch.select(*key), list(key), "left_anti")
        table.write(number, old.unionByName(batch.select(*old.columns)))

    return updates.writeStream.outputMode("update").foreachBatch(merge)


def into_store(updates: DataFrame, store: FactStore, now: Callable[[int], Column]) -> DataStreamWriter:
    """Merge an update-mode aggregate of facts into a store, bucket by bucket."""

    def merge(batch: DataFrame, number: int) -> None:
        store.upsert(batch, now(number), number)

    return updates.writeStream.outputMode("update").foreachBatch(merge)


def put_in_store(updates: DataFrame, store: FactStore) -> DataStreamWriter:
    """Insert or replace the rows of an update-mode aggregate by the store's key."""

    def put(batch: DataFrame, number: int) -> None:
        store.put(batch)

    return updates.writeStream.outputMode("update").foreachBatch(put)


def run_available(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process everything that has arrived, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
