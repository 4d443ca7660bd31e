"""From a delimited file to stored, marked and job-stamped parts in one load.

A file is scanned once, whatever number of parts its columns belong to. Entities, change marks and jobs are stored tables, of which a
load reads and rewrites only the buckets its names and timestamps fall into.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.entities import create_missing_entities, resolve_entities
from tidegauge.plans.cascade import record_modified
from tidegauge.plans.spec import TrendStorePart
from tidegauge.session import read_or_empty, written_once
from tidegauge.sources.delimited import LINE, DelimitedFormat, part_batch, read_delimited
from tidegauge.sources.factstore import FactStore, emit_modified

ENTITY = "id bigint, name string, created timestamp_ntz"
JOB = "id bigint, action string, started timestamp_ntz, finished timestamp_ntz"


class EntityStore:
    """Entities by name below ``path``, in ``spread`` buckets by a hash of the name; ids are given without gaps.

    ``ids`` beside them lists the highest id after each batch that added entities, so neither names nor ids of the whole
    table are read for a batch.
    """

    def __init__(self, spark: SparkSession, path: str, spread: int = 64):
        self.spark, self._ids = spark, f"{path}/ids"
        self.table = FactStore(spark, f"{path}/entities", ENTITY, key=("name",), bucket=F.pmod(F.xxhash64("name"), F.lit(spread)))

    def read(self) -> DataFrame:
        return self.table.read()

    def last_id(self) -> int:
        ids = read_or_empty(self.spark, self._ids, self.spark.createDataFrame([], "last_id bigint").schema)
        return ids.agg(F.coalesce(F.max("last_id"), F.lit(0)).alias("last")).first()["last"]

    def add(self, names: DataFrame, now: Column) -> int:
        """Create the names that aren't known yet; how many. Adding them again, also after a failure, adds none."""
        with written_once(names.select("name").filter(F.col("name").isNotNull()).distinct()) as wanted:
            known, last = self.table.having(wanted), self.last_id()
            with written_once(create_missing_entities(known, wanted, now, after=last)) as new:
                added = new.count()
                if added:
                    # Ids first: a batch that fails here leaves a gap, but never gives an id twice.
                    row = self.spark.createDataFrame([(last + added,)], "last_id bigint")
                    row.coalesce(1).write.mode("append").parquet(self._ids)
                    self.table.put(new)
        return added

    def resolve(self, rows: DataFrame, name_column: str = "entity") -> DataFrame:
        """Rows with ``entity_id`` in place of the name; only the names' buckets are read."""
        return resolve_entities(rows, self.table.having(rows.select(F.col(name_column).alias("name"))), name_column)


def _utc() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


class JobLog:
    """Jobs below ``path``: one row when a job starts, one more when it has finished."""

    def __init__(self, spark: SparkSession, path: str, clock: Callable[[], datetime] = _utc):
        self.spark, self.path, self.clock = spark, path, clock

    def _rows(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, self.spark.createDataFrame([], JOB).schema)

    def read(self) -> DataFrame:
        """``id, action, started, finished``, one row per job; ``finished`` is null for one that runs or has failed."""
        return self._rows().groupBy("id").agg(
            F.max("action").alias("action"), F.min("started").alias("started"), F.max("finished").alias("finished")
        )

    def _note(self, *row) -> None:
        self.spark.createDataFrame([row], JOB).coalesce(1).write.mode("append").parquet(self.path)

    def start(self, action: str) -> int:
        job = self._rows().agg(F.coalesce(F.max("id"), F.lit(0)).alias("last")).first()["last"] + 1
        self._note(job, action, self.clock(), None)
        return job

    def finish(self, job: int) -> None:
        self._note(job, None, None, self.clock())


@dataclass(frozen=True)
class Loaded:
    """What a load did: its job, and ``append`` or ``upsert`` for each part the file had columns of."""

    job_id: int
    parts: Mapping[str, str]


class Loader:
    """Loads files into parts: resolves entities, stores what each part knows, marks what changed, keeps the job log."""

    def __init__(
        self, parts: Sequence[TrendStorePart], stores: Mapping[str, FactStore], entities: EntityStore, modified: FactStore, jobs: JobLog
    ):
        self.parts, self.stores, self.entities, self.modified, self.jobs = parts, stores, entities, modified, jobs

    def load(self, path: str, now: Column, layout: DelimitedFormat = DelimitedFormat(), lenient: bool = False) -> Loaded:
        """One file, or a folder of files with the same columns.

        The file is parsed once into a written batch; parts, names and marks are made of that. A column that several parts have
        goes to each, one that none has is left out. Of a key that the file repeats the last row counts. A part that has none of the
        file's columns is not touched. If the load fails its job stays unfinished; loading the file again overwrites the same keys.
        """
        spark = self.entities.spark
        rows = read_delimited(spark, path, layout)
        job = self.jobs.start(f"load {path}")
        ways = {}
        with written_once(rows) as parsed:
            self.entities.add(parsed.select(F.col("entity").alias("name")), now)
            with written_once(self.entities.resolve(parsed)) as resolved:
                marks = None
                for part in self.parts:
                    batch = part_batch(resolved, part, layout, lenient)
                    if batch is None:
                        continue
                    ways[part.name] = self.stores[part.name].append_or_upsert(batch, now, job, order=LINE)
                    own = emit_modified(resolved, part.name, now)
                    marks = own if marks is None else marks.unionByName(own)
                if marks is not None:
                    record_modified(self.modified, marks.withColumn("id", F.lit(1)))
        self.jobs.finish(job)
        return Loaded(job, ways)
