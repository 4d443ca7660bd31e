"""Change tracking and incremental materialization.

``modified_log``: ``id, part, timestamp, modified`` (append only).
``modified``: ``part, timestamp, first, last`` (one row per changed part and label).
``state``: ``materialization, timestamp, source_fingerprint, processed_fingerprint,
max_modified, job_id``.
``links``: ``materialization, part, source_granularity, target_granularity``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.fingerprints import fingerprint_text, stamp
from tidegauge.functions.timeaxis import Interval, map_label, plus, window_grid
from tidegauge.plans.spec import Materialization

PART_KEY = ["part", "timestamp"]
STATE_KEY = ["materialization", "timestamp"]
# Fixed value: modification time of a statistics row that was never counted.
NEVER_COUNTED = "1999-12-31 22:00:00"


def process_modified_log(log: DataFrame, modified: DataFrame, start_id: int = 0) -> DataFrame:
    """``modified`` after taking over the log rows numbered above ``start_id``.

    An existing row keeps ``first``; ``last`` is overwritten even when the new value is older.
    """
    batch = log.filter(F.col("id") > start_id).groupBy(*PART_KEY).agg(F.max("modified").alias("new"))
    merged = modified.join(batch, PART_KEY, "full_outer")
    return merged.select(
        *PART_KEY, F.coalesce("first", "new").alias("first"), F.coalesce("new", "last").alias("last")
    )


def last_processed_id(log: DataFrame, start_id: int = 0) -> DataFrame:
    """The new high-water mark."""
    return log.filter(F.col("id") > start_id).agg(F.coalesce(F.max("id"), F.lit(start_id)).alias("last_processed_id"))


def map_by_link(ts: Column, source: Column, target: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Map a label by the granularity pair of its row's link, however the granularities are spelled.

    A pair without a mapping raises ``ValueError`` here; a row whose pair is not among ``pairs`` fails the job.
    """
    mapped = None
    for src, dst in pairs:
        here = (source == src) & (target == dst)
        label = map_label(ts, src, dst)
        mapped = F.when(here, label) if mapped is None else mapped.when(here, label)
    unknown = F.raise_error(F.format_string("no mapping from granularity %s to %s", source, target)).cast("timestamp_ntz")
    return unknown if mapped is None else mapped.otherwise(unknown)


def link_table(spark, materializations: Sequence[Materialization]) -> DataFrame:
    rows = [(m.name, link.part, link.granularity, m.granularity) for m in materializations for link in m.sources]
    return spark.createDataFrame(rows, "materialization string, part string, source_granularity string, target_granularity string")


def map_modified(modified: DataFrame, links: DataFrame) -> DataFrame:
    """Destination labels touched by modified source labels.

    The distinct granularity pairs of the links, a handful, come to the driver to build the mapping.
    """
    pairs = links.select("source_granularity", "target_granularity").distinct().collect()
    target = map_by_link(
        F.col("timestamp"), F.col("source_granularity"), F.col("target_granularity"), sorted(tuple(pair) for pair in pairs)
    )
    return modified.join(links, "part").select("materialization", target.alias("timestamp")).distinct()


def fingerprint_single(modified: DataFrame) -> DataFrame:
    """Fingerprint of a label that depends on one record label of one part."""
    pair = F.concat(F.lit('{"'), F.col("part"), F.lit('":"'), stamp("last"), F.lit('"}'))
    return modified.select(*PART_KEY, F.col("last").alias("max_modified"), pair.alias("fingerprint"))


def fingerprint_window(labels: DataFrame, modified: DataFrame, source: str, target: str) -> DataFrame:
    """Fingerprint over every source label of the target periods in ``labels`` (``part, timestamp``).

    The grid is dense: a source label that was never stored is part of it with empty text.
    """
    dense = labels.select(
        "part", F.col("timestamp").alias("label"),
        F.explode(window_grid(F.col("timestamp"), source, target)).alias("timestamp"),
    )
    last = modified.select(*PART_KEY, "last")
    return (
        dense.join(last, PART_KEY, "left")
        .groupBy("part", F.col("label"))
        .agg(
            F.max("last").alias("max_modified"),
            fingerprint_text(stamp("timestamp"), stamp("last")).alias("fingerprint"),
        )
        .select("part", F.col("label").alias("timestamp"), "max_modified", "fingerprint")
    )


def fingerprint_multi(modified: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Fingerprint over several parts; labels missing in one of them have none."""
    return (
        modified.filter(F.col("part").isin(list(parts)))
        .groupBy("timestamp")
        .agg(
            F.max("last").alias("max_modified"),
            fingerprint_text("part", stamp("last")).alias("fingerprint"),
            F.count(F.lit(1)).alias("present"),
        )
        .filter(F.col("present") == len(set(parts)))
        .drop("present")
    )


def combine_fingerprints(fingerprints: DataFrame, parts: Sequence[str]) -> DataFrame:
    """One fingerprint per label over several parts, from ``part, timestamp, max_modified, fingerprint``.

    Each part's fingerprint is nested under its name; labels missing in one of the parts have none.
    """
    entry = F.concat(F.lit('"'), F.col("part"), F.lit('":'), F.col("fingerprint"))
    return (
        fingerprints.filter(F.col("part").isin(list(parts)))
        .groupBy("timestamp")
        .agg(F.max("max_modified").alias("max_modified"), F.sort_array(F.collect_list(entry)).alias("entries"))
        .filter(F.size("entries") == len(set(parts)))
        .select("timestamp", "max_modified", F.concat(F.lit("{"), F.array_join("entries", ","), F.lit("}")).alias("fingerprint"))
    )


def update_source_fingerprint(state: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """State with fresh source fingerprints; new labels enter unprocessed.

    ``fingerprints``: ``materialization, timestamp, max_modified, fingerprint``.
    """
    new = fingerprints.select(*STATE_KEY, F.col("max_modified").alias("new_max"), F.col("fingerprint").alias("new_print"))
    hit = F.col("new_print").isNotNull()
    return state.join(new, STATE_KEY, "full_outer").select(
        *STATE_KEY,
        F.when(hit, F.col("new_print")).otherwise(F.col("source_fingerprint")).alias("source_fingerprint"),
        "processed_fingerprint",
        F.when(hit, F.col("new_max")).otherwise(F.col("max_modified")).alias("max_modified"),
        "job_id",
    )


def empty_state(spark) -> DataFrame:
    return spark.createDataFrame(
        [],
        "materialization string, timestamp timestamp_ntz, source_fingerprint string, "
        "processed_fingerprint string, max_modified timestamp_ntz, job_id bigint",
    )


def common_labels(sources: Sequence[tuple[DataFrame, str]], target: str) -> DataFrame:
    """Target labels for which every source part (with its granularity) has records."""
    mapped = [df.select(map_label("timestamp", gran, target).alias("timestamp")).distinct() for df, gran in sources]
    labels, *rest = mapped
    for other in rest:
        labels = labels.join(other, "timestamp")
    return labels


def populate_fingerprint(
    state: DataFrame, materialization: str, sources: Sequence[tuple[DataFrame, str]], target: str,
    fingerprints: DataFrame,
) -> DataFrame:
    """State with a source fingerprint for every label all sources have records for."""
    wanted = common_labels(sources, target)
    known = fingerprints.join(wanted, "timestamp", "left_semi")
    return update_source_fingerprint(state, known.select(F.lit(materialization).alias("materialization"), *known.columns))


def reset_fingerprint(state: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """Refresh the source fingerprint of labels already in the state; none is added."""
    return update_source_fingerprint(state, fingerprints.join(state.select(*STATE_KEY), STATE_KEY, "left_semi"))


def pending_materializations(state: DataFrame, jobs: DataFrame, now: Column) -> DataFrame:
    """Labels due for (re)computation.

    ``jobs``: ``materialization, enabled, processing_delay, stability_delay,
    reprocessing_period`` with the last three as day-time intervals.
    """
    due = (
        F.col("enabled")
        & ~F.col("source_fingerprint").eqNullSafe(F.col("processed_fingerprint"))
        & (F.col("timestamp") + F.col("processing_delay") <= now)
        & (F.coalesce(F.col("max_modified") + F.col("stability_delay") <= now, F.lit(True)))
        & (F.col("timestamp") + F.col("reprocessing_period") >= now)
    )
    return state.join(jobs, "materialization").filter(due).select(*state.columns)


def materialization_jobs(spark, materializations: Sequence[Materialization]) -> DataFrame:
    rows = [
        (m.name, m.enabled, *[int(Interval.of(v).seconds) for v in (m.processing_delay, m.stability_delay, m.reprocessing_period)])
        for m in materializations
    ]
    jobs = spark.createDataFrame(rows, "materialization string, enabled boolean, p bigint, s bigint, r bigint")
    span = {name: F.make_dt_interval(secs=F.col(short)).alias(name)
            for short, name in (("p", "processing_delay"), ("s", "stability_delay"), ("r", "reprocessing_period"))}
    return jobs.select("materialization", "enabled", *span.values())


def replace_timestamps(
    destination: DataFrame, fresh: DataFrame, labels: DataFrame, now: Column, job_id: int, within_labels: bool = False
) -> DataFrame:
    """Destination with the rows of all ``labels`` replaced by ``fresh``'s.

    Whole labels are replaced: a label in ``labels`` without fresh rows ends up empty. Only
    the destination's columns are taken over. ``within_labels`` tells that ``fresh`` has no
    other labels, which saves a semi-join.
    """
    wanted = fresh if within_labels else fresh.join(labels, "timestamp", "left_semi")
    stamped = wanted.withColumn("created", now).withColumn("job_id", F.lit(job_id).cast("bigint"))
    kept = destination.join(labels, "timestamp", "left_anti")
    return kept.select(*destination.columns).unionByName(stamped.select(*destination.columns))


def mark_processed(state: DataFrame, done: DataFrame, job_id: int) -> DataFrame:
    """State after materializing the labels in ``done`` (``materialization, timestamp``)."""
    flag = done.select(*STATE_KEY).distinct().withColumn("__done", F.lit(True))
    hit = F.col("__done").isNotNull()
    return state.join(flag, STATE_KEY, "left").select(
        *STATE_KEY, "source_fingerprint",
        F.when(hit, F.col("source_fingerprint")).otherwise(F.col("processed_fingerprint")).alias("processed_fingerprint"),
        "max_modified",
        F.when(hit, F.lit(job_id)).otherwise(F.col("job_id")).cast("bigint").alias("job_id"),
    )


def missing_stats(modified: DataFrame, stats: DataFrame) -> DataFrame:
    """Statistics rows to seed for changed labels that have none."""
    return modified.join(stats.select(*PART_KEY), PART_KEY, "left_anti").select(
        *PART_KEY, F.lit(NEVER_COUNTED).cast("timestamp_ntz").alias("modified"), F.lit(0).cast("bigint").alias("count")
    )


def stale_stats(stats: DataFrame, modified: DataFrame) -> DataFrame:
    """Statistics counted no later than one second after the last change."""
    last = modified.select(*PART_KEY, "last")
    return stats.join(last, PART_KEY).filter(F.col("modified") < plus("last", "1s")).select(*PART_KEY)


def count_stale(records: DataFrame, stats: DataFrame, modified: DataFrame) -> DataFrame:
    """``part, timestamp, count`` of the stale labels only: the rest of ``records`` is dropped before counting."""
    wanted = records.select(*PART_KEY).join(stale_stats(stats, modified), PART_KEY, "left_semi")
    return wanted.groupBy(*PART_KEY).agg(F.count(F.lit(1)).alias("count"))


def refresh_stats(stats: DataFrame, modified: DataFrame, counts: DataFrame, now: Column) -> DataFrame:
    """Statistics with stale rows recounted; ``counts`` is ``part, timestamp, count``, see :func:`count_stale`.

    A label whose records are all gone counts 0.
    """
    stale = stale_stats(stats, modified).withColumn("stale", F.lit(True))
    counted = counts.select(*PART_KEY, F.col("count").alias("counted"))
    hit = F.col("stale").isNotNull()
    return (
        stats.join(stale, PART_KEY, "left")
        .join(counted, PART_KEY, "left")
        .select(
            *PART_KEY,
            F.when(hit, now).otherwise(F.col("modified")).alias("modified"),
            F.when(hit, F.coalesce("counted", F.lit(0))).otherwise(F.col("count")).cast("bigint").alias("count"),
        )
    )


def refreshed_stats(records: DataFrame, stats: DataFrame, modified: DataFrame, now: Column) -> DataFrame:
    """Statistics after seeding changed labels that have none and recounting the stale ones in ``records`` (``part, timestamp``).

    The three steps at once: stats meet the change marks in a single join, which tells what is missing and what is stale, and
    only records of stale labels are counted.
    """
    never = F.lit(NEVER_COUNTED).cast("timestamp_ntz")
    met = stats.join(modified.select(*PART_KEY, "last"), PART_KEY, "full_outer").select(
        *PART_KEY, F.coalesce("modified", never).alias("modified"), F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
        F.coalesce(F.coalesce("modified", never) < plus("last", "1s"), F.lit(False)).alias("stale"),
    )
    wanted = records.select(*PART_KEY).join(met.filter("stale").select(*PART_KEY), PART_KEY, "left_semi")
    counted = wanted.groupBy(*PART_KEY).agg(F.count(F.lit(1)).alias("counted"))
    return met.join(counted, PART_KEY, "left").select(
        *PART_KEY,
        F.when(F.col("stale"), now).otherwise(F.col("modified")).alias("modified"),
        F.when(F.col("stale"), F.coalesce("counted", F.lit(0))).otherwise(F.col("count")).cast("bigint").alias("count"),
    )


def state_diff(state: DataFrame, desired: DataFrame) -> DataFrame:
    """Per state key: ``added``, ``updated``, ``deleted`` or ``same``."""
    now_is = state.select(*STATE_KEY, F.struct("max_modified", "source_fingerprint").alias("is"))
    want = desired.select(*STATE_KEY, F.struct("max_modified", "fingerprint").alias("want"))
    return now_is.join(want, STATE_KEY, "full_outer").select(*STATE_KEY, _action().alias("action"))


def reconcile(state: DataFrame, desired: DataFrame, only_changes: bool = False) -> DataFrame:
    """The state after following ``desired`` (``materialization, timestamp, max_modified, fingerprint``).

    Labels new in ``desired`` enter unprocessed, labels that are no longer in it go. A label whose fingerprint or last
    modification differs gets both from ``desired`` and keeps its processed fingerprint and job, so it is pending until it is
    computed again. ``only_changes`` leaves out what stays as it is and adds ``action`` (added, updated, deleted).
    """
    known = state.select(*STATE_KEY, F.struct("source_fingerprint", "processed_fingerprint", "max_modified", "job_id").alias("is"))
    want = desired.select(*STATE_KEY, F.struct("max_modified", "fingerprint").alias("want"))
    met = known.join(want, STATE_KEY, "full_outer").withColumn("action", _action())
    met = met.filter("action <> 'same'" if only_changes else "action <> 'deleted'")
    gone = F.col("action") == "deleted"
    return met.select(
        *STATE_KEY,
        F.when(gone, F.col("is.source_fingerprint")).otherwise(F.col("want.fingerprint")).alias("source_fingerprint"),
        F.col("is.processed_fingerprint").alias("processed_fingerprint"),
        F.when(gone, F.col("is.max_modified")).otherwise(F.col("want.max_modified")).alias("max_modified"),
        F.col("is.job_id").alias("job_id"),
        *(["action"] if only_changes else []),
    )


def _action() -> Column:
    """What becomes of a state row ``is`` for which there is ``want``; either may be missing."""
    same = F.col("is.max_modified").eqNullSafe(F.col("want.max_modified")) & F.col("is.source_fingerprint").eqNullSafe(
        F.col("want.fingerprint")
    )
    return (
        F.when(F.col("is").isNull(), "added")
        .when(F.col("want").isNull(), "deleted")
        .when(same, "same")
        .otherwise("updated")
    )


def state_reconcile(state: DataFrame, desired: DataFrame) -> DataFrame:
    """How many state rows a reconciliation adds, updates and deletes, per materialization."""
    diff = state_diff(state, desired)

    def total(action: str) -> Column:
        return F.count_if(F.col("action") == action).alias(action)

    return diff.groupBy("materialization").agg(total("added"), total("updated"), total("deleted"))
