"""Keyed fact tables as Parquet, one folder per time bucket.

A fact row is ``entity_id, timestamp, created, job_id`` plus the trends, unique on
(entity_id, timestamp). Writers only rewrite the buckets they touch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.columns import other_columns
from tidegauge.functions.timeaxis import Interval, bucket_index, bucket_start, minus, plus
from tidegauge.operators.changes import replace_timestamps
from tidegauge.plans.spec import AUDIT, KEY, TrendStorePart
from tidegauge.session import delete_folder, folder_names, read_or_empty, written_once

BUCKET = "bucket"


def last_per_key(batch: DataFrame, order: str) -> DataFrame:
    """One row per key: the last by ``order``."""
    rest = other_columns(batch, [*KEY, order])
    last = batch.groupBy(*KEY).agg(F.max_by(F.struct(*rest), order).alias("row"))
    return last.select(*KEY, *[F.col(f"row.{name}") for name in rest])


def upsert_partial(
    existing: DataFrame, batch: DataFrame, now: Column, job_id: int, order: str | None = None
) -> DataFrame:
    """``existing`` with the batch merged in on (entity_id, timestamp).

    A known key gets the supplied columns overwritten, also by NULL; its other columns and
    its audit columns stay. A new key has NULL in columns the batch does not supply. Of a key that the batch repeats the last
    row by ``order`` counts; without ``order`` the job fails on it.
    """
    rows = last_per_key(batch, order) if order else batch
    supplied = [name for name in other_columns(rows, KEY) if name in existing.columns]
    incoming = rows.select(*KEY, F.struct(F.lit(True).alias("hit"), *supplied).alias("new"))
    if not order:
        twice = F.raise_error(F.format_string("the batch repeats entity %s at %s", *[F.col(k).cast("string") for k in KEY]))
        grouped = incoming.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.first("new").alias("new"))
        incoming = grouped.select(*KEY, F.when(F.col("n") == 1, F.col("new")).otherwise(twice.cast(grouped.schema["new"].dataType)).alias("new"))
    merged = existing.withColumn("known", F.lit(True)).join(incoming, list(KEY), "full_outer")
    hit, known = F.col("new.hit").isNotNull(), F.col("known").isNotNull()
    audit = {"created": now.cast("timestamp_ntz"), "job_id": F.lit(job_id).cast("bigint")}
    columns = []
    for name in existing.columns:
        if name in KEY:
            columns.append(F.col(name))
        elif name in audit:
            columns.append(F.when(known, F.col(name)).otherwise(audit[name]).alias(name))
        elif name in supplied:
            columns.append(F.when(hit, F.col(f"new.{name}")).otherwise(F.col(name)).alias(name))
        else:
            columns.append(F.col(name))
    return merged.select(*columns)


def emit_modified(batch: DataFrame, part: str | Column, now: Column) -> DataFrame:
    """Modified-log rows for a stored batch: one per part and distinct timestamp."""
    name = part if isinstance(part, Column) else F.lit(part)
    return batch.select(name.alias("part"), "timestamp").distinct().withColumn("modified", now)


def stamp_job(rows: DataFrame, now: Column, job_id: int) -> DataFrame:
    return rows.withColumns({"created": now.cast("timestamp_ntz"), "job_id": F.lit(job_id).cast("bigint")})


def start_job(jobs: DataFrame, job_id: int, action: Column, now: Column) -> DataFrame:
    """Job log (``id, action, started, finished``) with one more, running job."""
    row = jobs.sparkSession.range(1).select(
        F.lit(job_id).cast("bigint").alias("id"), action.alias("action"), now.alias("started"),
        F.lit(None).cast("timestamp_ntz").alias("finished"),
    )
    return jobs.unionByName(row)


def finish_job(jobs: DataFrame, job_id: int, now: Column) -> DataFrame:
    done = F.when(F.col("id") == job_id, now).otherwise(F.col("finished"))
    return jobs.withColumn("finished", done)


def staged_timestamps(staging: DataFrame) -> DataFrame:
    return staging.select("timestamp").distinct()


def transfer_staged(base: DataFrame, staging: DataFrame, timestamps: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Base with the staged rows appended, and what is left in staging.

    Without ``timestamps`` everything is taken and staging ends up empty.
    """
    if timestamps is None:
        return base.unionByName(staging.select(*base.columns)), staging.limit(0)
    taken = staging.join(timestamps, "timestamp", "left_semi")
    return base.unionByName(taken.select(*base.columns)), staging.join(timestamps, "timestamp", "left_anti")


def delete_timestamp(df: DataFrame, ts: Column) -> tuple[DataFrame, DataFrame]:
    """Table without the rows at ``ts``, and the number of rows removed."""
    at = F.col("timestamp") == ts
    return df.filter(~at), df.filter(at).agg(F.count(F.lit(1)).alias("removed"))


def delete_timestamp_everywhere(
    parts: Sequence[TrendStorePart], stores: Mapping[str, FactStore], granularity: str, ts: datetime
) -> dict[str, int]:
    """Delete one timestamp from the stores of all parts of a granularity, however it is spelled; removed rows by part."""
    wanted = Interval.of(granularity)
    return {part.name: stores[part.name].delete_timestamp(ts) for part in parts if Interval.of(part.granularity) == wanted}


def missing_buckets(parts: DataFrame, existing: DataFrame, now: Column, ahead: str = "3 days") -> DataFrame:
    """Buckets each part should have but does not.

    ``parts``: ``part, size_seconds, retention_seconds``; ``existing``: ``part, bucket``. Buckets
    run from one partition before the retention period to one beyond ``ahead``.
    """
    size = F.make_dt_interval(secs=F.col("size_seconds"))
    keep = F.make_dt_interval(secs=F.col("retention_seconds"))
    moments = F.sequence(now - size - keep, plus(now + size, ahead), size)
    wanted = parts.select("part", "size_seconds", F.explode(moments).alias("moment"))
    seconds = F.round(F.unix_micros(F.col("moment").cast("timestamp")).cast("decimal(20,0)") / 1_000_000, 0).cast("bigint")
    indexed = wanted.select("part", F.call_function("div", seconds, F.col("size_seconds")).cast("bigint").alias(BUCKET))
    return indexed.join(existing, ["part", BUCKET], "left_anti")


def buckets_for_timestamp(parts: DataFrame, existing: DataFrame, ts: Column) -> DataFrame:
    """The bucket each part needs for one timestamp, where it does not exist yet."""
    seconds = F.unix_seconds(ts.cast("timestamp"))
    wanted = parts.select("part", F.call_function("div", seconds, F.col("size_seconds")).cast("bigint").alias(BUCKET))
    return wanted.join(existing, ["part", BUCKET], "left_anti")


def expired_buckets(buckets: DataFrame, now: Column, retention: str, size: str) -> DataFrame:
    """Buckets (``part, bucket``) that began before now - retention - two partition sizes."""
    limit = minus(minus(minus(now, retention), size), size)
    start = bucket_start(BUCKET, size)
    return buckets.withColumn("from", start).withColumn("to", bucket_start(F.col(BUCKET) + 1, size)).filter(
        F.col("from") < limit
    )


class FactStore:
    """A table with a ``timestamp`` stored below ``path``, partitioned by time bucket.

    Facts are keyed by (entity_id, timestamp); ``key`` names another key for other tables. ``bucket`` numbers the buckets by
    another expression of the key's columns than the time, for tables without one; then only the methods by key apply.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType | str, partition_size: str = "1 day",
        key: Sequence[str] = KEY, bucket: Column | None = None,
    ):
        self.bucket = bucket
        self.spark = spark
        self.key = tuple(key)
        self.path = path
        self.partition_size = partition_size
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def _stored(self) -> DataFrame:
        typed = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.LongType())])
        return read_or_empty(self.spark, self.path, typed)

    def read(self) -> DataFrame:
        return self._stored().drop(BUCKET)

    def between(self, after: datetime, until: datetime) -> DataFrame:
        """Rows with after < timestamp <= until; other buckets' folders are not opened."""
        low, high = F.lit(after).cast("timestamp_ntz"), F.lit(until).cast("timestamp_ntz")
        bounds = [bucket_index(ts, self.partition_size) for ts in (low, high)]
        first, last = self.spark.range(1).select(*bounds).first()
        inside = (F.col("timestamp") > low) & (F.col("timestamp") <= high)
        return self._in_buckets(n for n in self._numbers() if first <= n <= last).filter(inside)

    def of_periods(self, labels: DataFrame, period: Interval | str | int) -> DataFrame:
        """Stored rows of the buckets that the periods labelled by ``labels`` reach into.

        A superset of the periods' rows, read without listing or opening any other folder.
        """
        first = bucket_index(minus("timestamp", period), self.partition_size)
        last = bucket_index("timestamp", self.partition_size)
        numbers = labels.select(F.explode(F.sequence(first, last)).alias(BUCKET)).distinct().collect()
        return self._in_buckets(sorted(row[BUCKET] for row in numbers))

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        number = bucket_index("timestamp", self.partition_size) if self.bucket is None else self.bucket
        return rows.withColumn(BUCKET, number.cast("bigint"))

    def _write(self, rows: DataFrame, mode: str) -> None:
        """One task per bucket where buckets are small; AQE splits a bucket holding most rows."""
        balanced = self._bucketed(rows.select(*self.schema.names)).hint("rebalance", BUCKET)
        (
            balanced.sortWithinPartitions(BUCKET, *self.key)
            .write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET)
            .parquet(self.path)
        )

    def append(self, rows: DataFrame) -> None:
        self._write(rows, "append")

    def _bucket_numbers(self, rows: DataFrame) -> list[int]:
        """Buckets the rows fall into: at most one number per folder of the store."""
        numbers = self._bucketed(rows).select(BUCKET).distinct()
        return sorted(row[BUCKET] for row in numbers.collect())

    def _touched(self, batch: DataFrame) -> DataFrame:
        """Stored rows of the buckets the batch falls into; no other folder is listed or read."""
        return self._in_buckets(self._bucket_numbers(batch))

    def _numbers(self) -> list[int]:
        """Existing buckets, from the names of their folders."""
        return sorted(int(name.split("=")[1]) for name in folder_names(self.spark, self.path) if name.startswith(f"{BUCKET}="))

    def _in_buckets(self, numbers: Iterable[int]) -> DataFrame:
        """Rows of some buckets, read from their folders alone."""
        folders = [f"{self.path}/{BUCKET}={n}" for n in sorted(set(numbers) & set(self._numbers()))]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*folders).select(*self.schema.names)

    def merge(self, batch: DataFrame, combine: Callable[[DataFrame], DataFrame]) -> None:
        """Rewrite the buckets of a batch with ``combine`` of their stored rows."""
        numbers = self._bucket_numbers(batch)
        if numbers:
            self._write(combine(self._in_buckets(numbers)), "overwrite")

    def put(self, batch: DataFrame) -> None:
        """Insert or replace whole rows by key; the batch has each key once."""
        with written_once(batch.select(*self.schema.names)) as rows:
            self.put_written(rows)

    def put_written(self, rows: DataFrame) -> None:
        """The same with rows that are cheap to read several times, such as a table."""
        self.merge(rows, lambda stored: stored.join(rows.select(*self.key), list(self.key), "left_anti").unionByName(
            rows.select(*self.schema.names)
        ))

    def having(self, keys: DataFrame) -> DataFrame:
        """Stored rows with one of the keys (``keys`` has the columns of a part of the key that buckets are numbered by)."""
        on = [name for name in self.key if name in keys.columns]
        return self._touched(keys).join(keys.select(*on).distinct(), on, "left_semi")

    def exchange(self, batch: DataFrame, gone: DataFrame) -> None:
        """Insert or replace whole rows by key and delete the keys in ``gone``; both have each key once, and no key in common."""
        with written_once(batch.select(*self.schema.names)) as rows, written_once(gone.select(*self.key)) as keys:
            named = rows.select(*self.key).unionByName(keys)
            self._rewrite(self._bucket_numbers(named), lambda stored: stored.join(named, list(self.key), "left_anti").unionByName(rows))

    def upsert(self, batch: DataFrame, now: Column, job_id: int, order: str | None = None) -> None:
        """Merge facts on their key, rewriting the buckets they fall into."""
        with written_once(batch) as rows:
            self._upsert(rows, now, job_id, order)

    def _upsert(self, rows: DataFrame, now: Column, job_id: int, order: str | None) -> None:
        self.merge(rows, lambda stored: upsert_partial(stored, rows, now, job_id, order))

    def append_or_upsert(self, batch: DataFrame, now: Column, job_id: int, order: str | None = None) -> str:
        """Append when no key of the batch is stored or repeated, else merge; tells which. The batch is computed once."""
        with written_once(batch) as rows:
            return self._append_or_upsert(rows, now, job_id, order)

    def _append_or_upsert(self, batch: DataFrame, now: Column, job_id: int, order: str | None) -> str:
        """One pass over the keys tells whether any is repeated or stored."""
        keys = batch.select(*KEY, F.lit(1).alias("n")).unionByName(
            self._touched(batch).select(*KEY, F.lit(0).alias("n")).join(batch.select(*KEY), list(KEY), "left_semi")
        )
        counts = keys.groupBy(*KEY).agg(F.sum("n").alias("given"), F.count_if(F.col("n") == 0).alias("stored"))
        if not counts.filter((F.col("given") > 1) | (F.col("stored") > 0)).isEmpty():
            self._upsert(batch, now, job_id, order)
            return "upsert"
        missing = [name for name in self.schema.names if name not in batch.columns and name not in AUDIT]
        types = {field.name: field.dataType for field in self.schema.fields}
        wide = batch.withColumns({name: F.lit(None).cast(types[name]) for name in missing}) if missing else batch
        self.append(stamp_job(wide, now, job_id))
        return "append"

    def replace(self, fresh: DataFrame, labels: DataFrame, now: Column, job_id: int, within_labels: bool = False) -> None:
        """Replace whole timestamps, rewriting the buckets they fall into."""
        with written_once(fresh) as rows, written_once(labels) as wanted:
            self._rewrite(
                self._bucket_numbers(wanted), lambda stored: replace_timestamps(stored, rows, wanted, now, job_id, within_labels)
            )

    def delete_timestamp(self, ts: datetime) -> int:
        """Delete the rows at one timestamp; how many. Only its bucket is read and written."""
        label = self.spark.range(1).select(F.lit(ts).cast("timestamp_ntz").alias("timestamp"))
        removed = self._touched(label).join(label, "timestamp", "left_semi").count()
        if removed:
            self._rewrite(self._bucket_numbers(label), lambda stored: stored.join(label, "timestamp", "left_anti"))
        return removed

    def _rewrite(self, touched: list[int], combine: Callable[[DataFrame], DataFrame]) -> None:
        """Replace the touched buckets by ``combine`` of their rows; one left without any row is dropped."""
        if not touched:
            return
        with written_once(combine(self._in_buckets(touched))) as ready:
            filled = set(self._bucket_numbers(ready))
            self._write(ready, "overwrite")
        self._drop(sorted(set(touched) - filled))

    def _drop(self, buckets: Sequence[int]) -> None:
        """Remove whole bucket folders."""
        for bucket in buckets:
            delete_folder(self.spark, f"{self.path}/{BUCKET}={bucket}")

    def buckets(self) -> DataFrame:
        """Existing bucket numbers, read from folder names."""
        return self.spark.createDataFrame([(n,) for n in self._numbers()], f"{BUCKET} bigint")

    def clean_up(self, now: datetime, retention: str, pretend: bool = False) -> list[int]:
        """Drop buckets past their retention; returns their numbers, one per folder."""
        moment = F.lit(now).cast("timestamp_ntz")
        old = expired_buckets(self.buckets(), moment, retention, self.partition_size).select(BUCKET).orderBy(BUCKET)
        numbers = [row[BUCKET] for row in old.toLocalIterator()]
        if not pretend:
            self._drop(numbers)
        return numbers

    def missing(self, now: datetime, retention: str, ahead: str = "3 days") -> DataFrame:
        size = Interval.of(self.partition_size).epoch_seconds()
        moment = F.lit(now).cast("timestamp_ntz")
        part = F.lit(self.path).alias("part")
        span = F.timestamp_diff("SECOND", minus(moment, retention), moment)
        parts = self.spark.range(1).select(part, F.lit(size).cast("bigint").alias("size_seconds"), span.alias("retention_seconds"))
        return missing_buckets(parts, self.buckets().select(part, BUCKET), moment, ahead)
