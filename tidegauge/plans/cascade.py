"""Materializations that feed one another, recomputed level by level where their sources changed.

A tick takes the labels that changed since the last one. Level by level, sources before what is computed from them, it

1. maps changed labels to the labels of the level's destinations and refreshes their source fingerprints,
2. takes the labels that are due by their delays and whose fingerprint is not the one last processed,
3. computes all due labels of a materialization at once and replaces them in its destination,
4. marks the destination's labels as modified, which makes them changed labels of the levels above, notes the run, and moves
   the state: the processed fingerprint becomes the source fingerprint the rows were computed from.

Change marks, states and runs are stored tables beside the parts, so a tick reads and rewrites only the buckets that changed labels
fall into, however many there are. The state moves last: a tick that fails is repeated by the next, which finds the same labels due.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import nullcontext
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.timeaxis import Interval, map_label
from tidegauge.operators.aggregates import time_rollup
from tidegauge.operators.changes import (
    STATE_KEY, fingerprint_window, materialization_jobs, pending_materializations, process_modified_log, reconcile,
    update_source_fingerprint,
)
from tidegauge.plans.incremental import records_of_labels
from tidegauge.plans.spec import Materialization
from tidegauge.session import cut_lineage, read_or_empty, written_once
from tidegauge.sources.factstore import FactStore

MODIFIED = "part string, timestamp timestamp_ntz, first timestamp_ntz, last timestamp_ntz"
STATE = (
    "materialization string, timestamp timestamp_ntz, source_fingerprint string, processed_fingerprint string, "
    "max_modified timestamp_ntz, job_id bigint"
)
RUNS = "id bigint, materialization string, labels bigint, started timestamp_ntz, finished timestamp_ntz"


def levels(materializations: Sequence[Materialization]) -> list[list[Materialization]]:
    """The materializations in the order they can be computed; those of one level don't need each other.

    Raises ``ValueError`` for a cycle and for two materializations with one destination.
    """
    left = {m.destination: m for m in materializations}
    if len(left) < len(materializations):
        raise ValueError("two materializations have the same destination")
    found = []
    while left:
        ready = [m for m in left.values() if not any(link.part in left for link in m.sources)]
        if not ready:
            raise ValueError(f"materializations need each other: {', '.join(sorted(m.name for m in left.values()))}")
        found.append(ready)
        for m in ready:
            del left[m.destination]
    return found


def rollup_of(part: str, source: str, target: str, trends: Sequence[str] | Mapping[str, str], samples_from: str | None = None):
    """A ``compute`` that rolls up one source part, for :class:`~tidegauge.plans.spec.Materialization`."""

    def compute(sources: Mapping[str, DataFrame], labels: DataFrame) -> DataFrame:
        return time_rollup(records_of_labels(sources[part], labels, source, target), source, target, trends, samples_from)

    return compute


def record_modified(store: FactStore, log: DataFrame, start_id: int = 0, written: bool = False) -> None:
    """Take log rows (``id, part, timestamp, modified``) numbered above ``start_id`` into the stored change marks.

    The stored form of :func:`~tidegauge.operators.changes.process_modified_log`: only the buckets of the batch's labels are
    read and written, so a batch costs by its own size. ``written`` tells that the log is cheap to read several times.
    """
    rows = log.filter(F.col("id") > start_id).select("id", "part", "timestamp", "modified")
    with nullcontext(rows) if written else written_once(rows) as batch:
        store.merge(batch, lambda stored: process_modified_log(batch, stored, start_id))


def touched_by(changed: DataFrame, materializations: Sequence[Materialization]) -> DataFrame:
    """``materialization, timestamp``: destination labels that changed source labels (``part, timestamp``) are part of."""
    mapped = None
    for m in materializations:
        for link in m.sources:
            label = map_label("timestamp", link.granularity, m.granularity).alias("timestamp")
            own = changed.filter(F.col("part") == link.part).select(F.lit(m.name).alias("materialization"), label)
            mapped = own if mapped is None else mapped.unionByName(own)
    return mapped.distinct()


def source_fingerprints(touched: DataFrame, materializations: Sequence[Materialization], modified: Mapping[str, DataFrame]) -> DataFrame:
    """``materialization, timestamp, max_modified, fingerprint`` of labels (``materialization, timestamp``) over all their sources.

    A source's fingerprint covers every source label of the period, see
    :func:`~tidegauge.operators.changes.fingerprint_window`; several sources' are nested under their names. ``modified`` has
    the change marks by target granularity, restricted as the caller can. Entries per label are the links of one materialization.
    """
    pairs: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for m in materializations:
        for link in m.sources:
            pairs.setdefault((link.granularity, m.granularity), []).append((m.name, link.part))
    found = None
    for (source, target), links in pairs.items():
        table = touched.sparkSession.createDataFrame(links, "materialization string, part string")
        wanted = touched.join(table, "materialization")
        prints = fingerprint_window(wanted.select("part", "timestamp").distinct(), modified[target], source, target)
        own = wanted.join(prints, ["part", "timestamp"])
        found = own if found is None else found.unionByName(own)
    entry = F.struct("part", "fingerprint")
    nested = F.transform("entries", lambda e: F.concat(F.lit('"'), e["part"], F.lit('":'), e["fingerprint"]))
    gathered = found.groupBy(*STATE_KEY).agg(F.max("max_modified").alias("max_modified"), F.sort_array(F.collect_list(entry)).alias("entries"))
    single = F.col("entries")[0]["fingerprint"]
    several = F.concat(F.lit("{"), F.array_join(nested, ","), F.lit("}"))
    return gathered.select(*STATE_KEY, "max_modified", F.when(F.size("entries") == 1, single).otherwise(several).alias("fingerprint"))


def _utc() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


class Cascade:
    """A graph of materializations over stored parts, with its change marks, states and runs below ``folder``.

    ``parts`` has the store of every source and destination by name. ``bucket`` is the bookkeeping tables' partition size.
    """

    def __init__(
        self, spark: SparkSession, materializations: Sequence[Materialization], parts: Mapping[str, FactStore], folder: str,
        bucket: str = "1 week", clock: Callable[[], datetime] = _utc,
    ):
        self.spark, self.parts, self.clock = spark, parts, clock
        self.levels = levels(materializations)
        self.modified = FactStore(spark, f"{folder}/modified", MODIFIED, bucket, key=("part", "timestamp"))
        self.state = FactStore(spark, f"{folder}/state", STATE, bucket, key=STATE_KEY)
        self._runs = f"{folder}/runs"

    def runs(self) -> DataFrame:
        return read_or_empty(self.spark, self._runs, self.spark.createDataFrame([], RUNS).schema)

    def metrics(self) -> DataFrame:
        """``materialization, execution_count, total_duration_us``: labels computed and time taken so far."""
        taken = F.timestamp_diff("MICROSECOND", F.col("started"), F.col("finished"))
        return self.runs().groupBy("materialization").agg(
            F.sum("labels").alias("execution_count"), F.sum(taken).alias("total_duration_us")
        )

    def tick(self, changes: DataFrame, now: datetime) -> list[tuple[str, int]]:
        """Bring all destinations up to date after ``changes`` (``part, timestamp, modified``); what was computed, by name and labels.

        Labels whose delays have not passed stay pending; a later tick, also one without changes, computes them.
        """
        moment = F.lit(now).cast("timestamp_ntz")
        done = []
        with written_once(changes.select("part", "timestamp", "modified")) as batch:
            record_modified(self.modified, batch.withColumn("id", F.lit(1)), written=True)
            job = self._last_job()
            changed = batch.select("part", "timestamp").distinct()
            for level in self.levels:
                self._refresh(level, changed)
                due = cut_lineage(self._due(level, now))
                counts = {row["materialization"]: row["n"] for row in due.groupBy("materialization").agg(F.count(F.lit(1)).alias("n")).collect()}
                for m in (m for m in level if m.name in counts):
                    own, job = due.filter(F.col("materialization") == m.name), job + 1
                    self._materialize(m, own, counts[m.name], moment, job)
                    changed = changed.unionByName(own.select(F.lit(m.destination).alias("part"), "timestamp"))
                    done.append((m.name, counts[m.name]))
        return done

    def _refresh(self, level: Sequence[Materialization], changed: DataFrame) -> None:
        """Source fingerprints of the labels that ``changed`` touches; new labels enter the state unprocessed."""
        touched = cut_lineage(touched_by(changed, level))
        prints = source_fingerprints(touched, level, self._marks(level, touched))
        with written_once(prints) as fresh:
            self.state.merge(fresh, lambda stored: update_source_fingerprint(stored, fresh))

    def _marks(self, level: Sequence[Materialization], touched: DataFrame) -> dict[str, DataFrame]:
        """Change marks of the periods of the touched labels, by granularity."""
        found = {}
        for granularity in {m.granularity for m in level}:
            names = [m.name for m in level if m.granularity == granularity]
            found[granularity] = self.modified.of_periods(touched.filter(F.col("materialization").isin(names)), granularity)
        return found

    def _due(self, level: Sequence[Materialization], now: datetime) -> DataFrame:
        """Due rows of the state; buckets from before the longest reprocessing period are not read."""
        longest = max(int(Interval.of(m.reprocessing_period).seconds) for m in level)
        rows = self.state.between(now - timedelta(seconds=longest, microseconds=1), now)
        return pending_materializations(rows, materialization_jobs(self.spark, level), F.lit(now).cast("timestamp_ntz"))

    def _materialize(self, m: Materialization, due: DataFrame, count: int, now, job: int) -> None:
        """Replace the due labels in the destination, mark them modified, note the run, move the state."""
        started = self.clock()
        labels = due.select("timestamp")
        sources = {link.part: self.parts[link.part].of_periods(labels, m.granularity) for link in m.sources}
        self.parts[m.destination].replace(m.compute(sources, labels), labels, now, job)
        marks = labels.select(F.lit(1).alias("id"), F.lit(m.destination).alias("part"), "timestamp", now.alias("modified"))
        record_modified(self.modified, marks, written=True)
        row = self.spark.createDataFrame([(job, m.name, count, started, self.clock())], RUNS)
        row.coalesce(1).write.mode("append").parquet(self._runs)
        moved = due.withColumns({"processed_fingerprint": F.col("source_fingerprint"), "job_id": F.lit(job).cast("bigint")})
        self.state.put_written(moved)

    def _last_job(self) -> int:
        return self.runs().agg(F.coalesce(F.max("id"), F.lit(0)).alias("last")).first()["last"]

    def reconcile(self, desired: DataFrame) -> None:
        """Make the stored state follow ``desired`` (``materialization, timestamp, max_modified, fingerprint``), see
        :func:`~tidegauge.operators.changes.reconcile`; buckets without a difference are not written."""
        changes = reconcile(self.state.read(), desired, only_changes=True)
        with written_once(changes) as rows:
            self.state.exchange(rows.filter("action <> 'deleted'"), rows.filter("action = 'deleted'"))
