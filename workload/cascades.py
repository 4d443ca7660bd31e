"""Materializations over stored parts, from quarter-hours to hours to days, brought up to date after late changes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidegauge.operators import changes as C
from tidegauge.plans.cascade import Cascade, rollup_of
from tidegauge.plans.spec import Materialization, SourceLink
from tidegauge.session import scratch_path
from tidegauge.sources.factstore import FactStore, stamp_job
from workload.registry import query
from workload.tables import F15, MOD, Q15, at, total
from workload.tracking import _H, _OLD_MOD, _fingerprints, _old_modified, _window_sql

FIRST, SECOND = datetime(2024, 2, 1), datetime(2024, 2, 2)
_FIRST, _SECOND = f"TIMESTAMP '{FIRST}'", f"TIMESTAMP '{SECOND}'"
_DAY = 'make_timestamp(CAST(ceil(epoch_us("timestamp") / 8.64e10) AS BIGINT) * 86400000000)'
FACT = "entity_id bigint, timestamp timestamp_ntz, created timestamp_ntz, job_id bigint, samples bigint, value decimal(38,2)"


def _materializations():
    rolled = {"reprocessing_period": "60 days", "stability_delay": "0 seconds"}
    return [
        Materialization("day from hour", "day", "1d", [SourceLink("hour", "1h")], rollup_of("hour", "1h", "1d", ["value"], "samples"), **rolled),
        Materialization("hour from quarter", "hour", "1h", [SourceLink("quarter", "15m")], rollup_of("quarter", "15m", "1h", ["value"], "samples"), **rolled),
    ]


def _facts(records):
    return records.groupBy("entity_id", "timestamp").agg(total("value").alias("value"), F.count(F.lit(1)).alias("samples"))


def _after_late_rows(t) -> Cascade:
    """Everything but sign-ups is stored and materialized; then the sign-ups' records arrive and the second tick follows."""
    folder = scratch_path(t.spark, "cascade")
    parts = {name: FactStore(t.spark, f"{folder}/{name}", FACT, size) for name, size in (("quarter", "10 days"), ("hour", "10 days"), ("day", "90 days"))}
    cascade = Cascade(t.spark, _materializations(), parts, folder, "10 days")

    def changed(rows, when):
        return rows.select(F.lit("quarter").alias("part"), "timestamp", at(str(when)).alias("modified")).distinct()

    records = t.records_15m
    early = _facts(records.filter(F.col("part") != "signup"))
    parts["quarter"].append(stamp_job(early, at(str(FIRST)), 0))
    cascade.tick(changed(early, datetime(2024, 1, 31, 12)), FIRST)
    signups = records.filter(F.col("part") == "signup").select("entity_id", "timestamp").distinct()
    late = _facts(records.join(signups, ["entity_id", "timestamp"], "left_semi"))
    parts["quarter"].upsert(late, at(str(SECOND)), 0)
    cascade.tick(changed(signups, datetime(2024, 2, 1, 12)), SECOND)
    return cascade


_LEVELS = f"""{F15},
    hour AS (SELECT entity_id, {_H} AS "timestamp", CAST(sum(samples) AS BIGINT) AS samples, CAST(sum(value) AS DECIMAL(38,2)) AS value FROM f15 GROUP BY 1, 2),
    day AS (SELECT entity_id, {_DAY} AS "timestamp", CAST(sum(samples) AS BIGINT) AS samples, CAST(sum(value) AS DECIMAL(38,2)) AS value FROM hour GROUP BY 1, 2),
    kinds AS (SELECT DISTINCT {Q15} AS "timestamp", event_type = 'signup' AS late FROM events),
    hours AS (SELECT {_H} AS "timestamp", bool_or(late) AS late, bool_or(NOT late) AS early FROM kinds GROUP BY 1),
    days AS (SELECT {_DAY} AS "timestamp", bool_or(late) AS late, bool_or(early) AS early FROM hours GROUP BY 1)"""


@query(f"""WITH {_LEVELS}
    SELECT 'hour' AS part, hour.*, CASE WHEN late THEN {_SECOND} ELSE {_FIRST} END AS created, CASE WHEN late THEN 3 ELSE 1 END AS job_id FROM hour JOIN hours USING ("timestamp")
    UNION ALL
    SELECT 'day', day.*, CASE WHEN late THEN {_SECOND} ELSE {_FIRST} END, CASE WHEN late THEN 4 ELSE 2 END FROM day JOIN days USING ("timestamp")""")
def materialize_cascade(t):
    """Both destinations equal a full rollup; only the labels that late records touch carry the second tick's jobs."""
    parts = _after_late_rows(t).parts
    return parts["hour"].read().withColumn("part", F.lit("hour")).unionByName(parts["day"].read().withColumn("part", F.lit("day")))


@query(f"""WITH {_LEVELS}, marks AS (
    SELECT 'hour' AS part, 'hour from quarter' AS materialization, *, CASE WHEN late THEN 3 ELSE 1 END AS job_id FROM hours
    UNION ALL SELECT 'day', 'day from hour', *, CASE WHEN late THEN 4 ELSE 2 END FROM days)
    SELECT part, "timestamp", CASE WHEN early THEN {_FIRST} ELSE {_SECOND} END AS "first", CASE WHEN late THEN {_SECOND} ELSE {_FIRST} END AS "last",
        true AS settled, job_id, CAST(sum(early::INT + late::INT) OVER (PARTITION BY part) AS BIGINT) AS execution_count FROM marks""")
def cascade_bookkeeping(t):
    """Marks of the destinations, the state behind each label, and how many labels were computed in both ticks."""
    cascade = _after_late_rows(t)
    state = cascade.state.read().join(cascade.metrics(), "materialization")
    part = F.element_at(F.split("materialization", " "), 1).alias("part")
    settled = F.col("source_fingerprint").eqNullSafe(F.col("processed_fingerprint")).alias("settled")
    return cascade.modified.read().join(state.select(part, "timestamp", settled, "job_id", "execution_count"), ["part", "timestamp"])


_DESIRED = f"""{MOD}, {_OLD_MOD}, {_window_sql('old', 'oldw')}, {_window_sql('modified', 'neww')},
    busy AS (SELECT part, {_H} AS "timestamp" FROM modified GROUP BY 1, 2 HAVING count(*) > 1),
    desired AS (SELECT neww.* FROM neww SEMI JOIN busy USING (part, "timestamp"))"""


def desired_and_state(t):
    """The state of the older changes, processed by job 1; wanted are now hours with changes in two quarters or more."""
    seen = C.update_source_fingerprint(C.empty_state(t.spark), _fingerprints(_old_modified(t)))
    state = C.mark_processed(seen, seen.select(*C.STATE_KEY), 1)
    hour = C.map_label("timestamp", "15m", "1h").alias("timestamp")
    busy = t.modified.groupBy(F.col("part").alias("materialization"), hour).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return _fingerprints(t.modified).join(busy, C.STATE_KEY, "left_semi"), state


_RECONCILED = f"""WITH {_DESIRED} SELECT part AS materialization, "timestamp", d.fingerprint AS source_fingerprint, o.fingerprint AS processed_fingerprint,
    d.max_modified, CASE WHEN o.part IS NOT NULL THEN 1 END AS job_id FROM desired d LEFT JOIN oldw o USING (part, "timestamp")"""


@query(_RECONCILED)
def reconciled_state(t):
    desired, state = desired_and_state(t)
    return C.reconcile(state, desired)


@query(_RECONCILED)
def reconciled_state_stored(t):
    """The same on a stored state, of which only differing buckets are written."""
    folder = scratch_path(t.spark, "state")
    cascade = Cascade(t.spark, _materializations(), {}, folder, "5 days")
    desired, state = desired_and_state(t)
    cascade.state.append(state)
    cascade.reconcile(desired)
    return cascade.state.read()


@query(f"""WITH {_DESIRED} SELECT part AS materialization, count(*) FILTER (WHERE o.part IS NULL) AS added,
    count(*) FILTER (WHERE o.part IS NOT NULL AND n.part IS NOT NULL AND (o.fingerprint <> n.fingerprint OR o.max_modified <> n.max_modified)) AS updated,
    count(*) FILTER (WHERE n.part IS NULL) AS deleted
    FROM (SELECT * FROM oldw) o FULL JOIN (SELECT * FROM desired) n USING (part, "timestamp") GROUP BY 1""")
def state_reconcile(t):
    desired, state = desired_and_state(t)
    return C.state_reconcile(state, desired)
