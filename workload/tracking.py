"""Attribute history, change tracking and incremental materialization."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidegauge.functions.timeaxis import map_label
from tidegauge.operators import changes as C
from tidegauge.operators import history as H
from tidegauge.operators.aggregates import time_rollup
from tidegauge.plans import incremental as I
from tidegauge.plans.kpi import resolve_view_sources as resolve_sources
from tidegauge.plans.lineage import lineage_closure as closure
from tidegauge.plans.spec import Materialization, SourceLink
from tidegauge.session import scratch_path
from tidegauge.sources.attributestore import AttributeStore
from tidegauge.sources.factstore import FactStore, stamp_job
from workload.registry import query
from workload.tables import HIST, LOG, MOD, REC, TOTAL, at

NOW = "2024-02-01 00:00:00"
_NOW = f"TIMESTAMP '{NOW}'"

# --- attribute history ---------------------------------------------------------------

# Rows of an entity belong to one run if they have the same hash and the same distance between their number among all
# rows and their number among those with that hash.
_RUNS = """runs AS (SELECT *, hash || '/' || (row_number() OVER (PARTITION BY entity_id ORDER BY "timestamp")
        - row_number() OVER (PARTITION BY entity_id, hash ORDER BY "timestamp")) AS run FROM hist)"""
_RUN_LENGTHS = f"""{_RUNS} SELECT entity_id, count(*) AS run_length, min("timestamp") AS "start", max("timestamp") AS "end", max(modified) AS modified,
    min(id) AS id, min(first_appearance) AS first_appearance FROM runs GROUP BY entity_id, run"""
_CHANGES = """SELECT h.entity_id, h."timestamp", p.entity_id IS NULL AS change FROM hist h
    ASOF LEFT JOIN hist b ON b.entity_id = h.entity_id AND b."timestamp" < h."timestamp"
    LEFT JOIN hist p ON p.entity_id = b.entity_id AND p."timestamp" = b."timestamp" AND p.hash = h.hash"""
_COMPACT = f"""{_RUNS},
    compacted AS (SELECT min(id) AS id, min(first_appearance) AS first_appearance,
        CASE WHEN count(*) > 1 THEN {_NOW} ELSE max(modified) END AS modified, min(hash) AS hash, entity_id,
        min("timestamp") AS "timestamp", max("timestamp") AS "end", min(event_type) AS event_type FROM runs GROUP BY entity_id, run)"""


@query(f"WITH {HIST} {_CHANGES}")
def attribute_changes(t):
    return H.attribute_changes(t.history)


@query(f"WITH {HIST}, {_RUN_LENGTHS}")
def attribute_run_length(t):
    return H.attribute_run_length(t.history)


@query(f"WITH {HIST}, {_RUN_LENGTHS}")
def attribute_run_length_sliced(t):
    """The same with the rows of every entity cut into time slices."""
    return H.attribute_run_length(t.history, width="6 hours")


@query(f"WITH {HIST} {_CHANGES}")
def attribute_changes_sliced(t):
    return H.attribute_changes(t.history, width="6 hours")


@query(f"""WITH {HIST}, {_COMPACT} SELECT * FROM compacted""")
def attribute_compact(t):
    return H.attribute_compact(t.history, ["event_type"], at(NOW))


@query(f"""WITH {HIST}, touched AS (SELECT DISTINCT entity_id FROM hist WHERE event_type = 'signup' AND "timestamp" > TIMESTAMP '2024-01-29 00:00:00'),
    whole AS (SELECT * FROM hist), {_COMPACT.replace("FROM hist)", "FROM hist WHERE entity_id IN (SELECT entity_id FROM touched))", 1)}
    SELECT * FROM compacted UNION ALL
    SELECT id, first_appearance, modified, hash, entity_id, "timestamp", "timestamp", event_type FROM whole
    WHERE entity_id NOT IN (SELECT entity_id FROM touched)""")
def attribute_compact_touched(t):
    """Only entities with a late sign-up are compacted: those rows carry the highest ids."""
    late = (F.col("event_type") == "signup") & (F.col("timestamp") > at("2024-01-29 00:00:00"))
    high = F.lit(1_000_000_000)
    history = t.history.withColumn("id", F.when(late, F.col("id") + high).otherwise(F.col("id")))
    compacted = H.attribute_compact(history, ["event_type"], at(NOW), after_id=1_000_000_000)
    return compacted.withColumn("id", F.when(F.col("id") > high, F.col("id") - high).otherwise(F.col("id")))


@query(f"""WITH {HIST}, {_COMPACT} SELECT * EXCLUDE (rn) FROM
    (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY "timestamp" DESC) AS rn FROM compacted) WHERE rn = 1""")
def attribute_current(t):
    return H.attribute_current(t.history, ["event_type"], at(NOW))


@query(f"""WITH {HIST} SELECT * FROM hist WHERE entity_id = 7 AND "timestamp" <= TIMESTAMP '2024-01-15 00:00:00'
    ORDER BY "timestamp" DESC LIMIT 1""")
def entity_attribute_at(t):
    return H.entity_attribute_at(t.history, 7, at("2024-01-15 00:00:00"))


def _stored(t):
    """History of all but sign-ups."""
    return t.history.filter(F.col("event_type") != "signup")


def _staged(t):
    """Sign-ups (new keys) and clicks (known keys), each staged twice; the second lacks the value."""
    rows = t.events.filter(F.col("event_type").isin("signup", "click")).select(
        F.col("user_id").alias("entity_id"), F.col("ts").alias("timestamp"), F.col("event_id"),
        F.upper("event_type").alias("event_type"), F.col("value").cast("decimal(18,2)").alias("value"),
    )
    first = rows.withColumn("turn", F.col("event_id") * 2)
    second = rows.withColumn("turn", F.col("event_id") * 2 + 1).withColumn("value", F.lit(None).cast("decimal(18,2)"))
    return first.unionByName(second).drop("event_id")


@query("""SELECT user_id AS entity_id, ts AS "timestamp", upper(event_type) AS event_type, CAST(value AS DECIMAL(18,2)) AS value
    FROM events WHERE event_type = 'signup'""")
def staging_new(t):
    return H.staging_new(_staged(t), _stored(t), "turn")


@query("""SELECT user_id AS entity_id, ts AS "timestamp", upper(event_type) AS event_type,
    CASE WHEN i = 0 THEN CAST(value AS DECIMAL(18,2)) END AS value, event_id * 2 + i AS turn
    FROM events, range(0, 2) r(i) WHERE event_type = 'click'""")
def staging_modified(t):
    return H.staging_modified(_staged(t), _stored(t))


_NUMBER = """row_number() OVER (ORDER BY md5(CAST(entity_id AS VARCHAR) || '|' || strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f')),
    entity_id, "timestamp")"""


@query(f"""WITH {HIST}, old AS (SELECT * FROM hist WHERE event_type <> 'signup'),
    new AS (SELECT entity_id, "timestamp", 'SIGNUP' AS event_type FROM hist WHERE event_type = 'signup')
    SELECT id, first_appearance, CASE WHEN event_type = 'click' THEN {_NOW} ELSE modified END AS modified,
        CASE WHEN event_type = 'click' THEN md5('CLICK') ELSE hash END AS hash, entity_id, "timestamp", "end",
        CASE WHEN event_type = 'click' THEN 'CLICK' ELSE event_type END AS event_type FROM old
    UNION ALL SELECT (SELECT max(id) FROM old) + {_NUMBER}, {_NOW}, {_NOW}, md5(event_type), entity_id, "timestamp", NULL, event_type FROM new""")
def attribute_transfer(t):
    return H.transfer_staged(_stored(t), _staged(t).drop("value"), ["event_type"], at(NOW), "turn")


@query(f"""WITH h AS (SELECT c_custkey + 1 AS id, TIMESTAMP '2024-01-01 00:00:00' AS first_appearance, TIMESTAMP '2024-01-01 00:00:00' AS modified,
        md5(c_mktsegment) AS hash, c_custkey AS entity_id, TIMESTAMP '2024-01-01 00:00:00' AS "timestamp",
        CAST(NULL AS TIMESTAMP) AS "end", c_mktsegment AS priority FROM customer),
    sampled AS (SELECT o_custkey AS entity_id, {_NOW} AS "timestamp", max(o_orderpriority) AS priority FROM orders GROUP BY 1)
    SELECT * FROM h UNION ALL
    SELECT (SELECT max(id) FROM h) + {_NUMBER}, {_NOW}, {_NOW}, md5(priority), entity_id, "timestamp", NULL, priority FROM sampled""")
def sampled_attributes(t):
    start = at("2024-01-01 00:00:00")
    history = t.customer.select(
        (F.col("c_custkey") + 1).alias("id"), start.alias("first_appearance"), start.alias("modified"),
        F.md5("c_mktsegment").alias("hash"), F.col("c_custkey").alias("entity_id"), start.alias("timestamp"),
        F.lit(None).cast("timestamp_ntz").alias("end"), F.col("c_mktsegment").alias("priority"),
    )
    view = t.orders.groupBy(F.col("o_custkey").alias("entity_id")).agg(F.max("o_orderpriority").alias("priority"))
    return H.sampled_view_materialize(history, view, ["priority"], at(NOW), at(NOW))


@query("""WITH last AS (SELECT event_type AS store, max(event_id) AS last_id FROM events GROUP BY 1),
    marks AS (SELECT event_type AS store, max(event_id) AS compacted FROM events
        WHERE event_type = 'click' OR (event_type <> 'view' AND ts < TIMESTAMP '2024-01-20 00:00:00') GROUP BY 1)
    SELECT store, last_id, coalesce(compacted, 0) AS compacted, last_id > coalesce(compacted, 0) AS requires_compacting
    FROM last LEFT JOIN marks USING (store)""")
def attribute_markers(t):
    ids = t.events.select(F.col("event_type").alias("store"), F.col("event_id").alias("id"), "ts")
    early = (F.col("store") != "view") & (F.col("ts") < at("2024-01-20 00:00:00"))
    old = ids.filter(early).groupBy("store").agg(F.max("id").alias("compacted"))
    newer = ids.filter(F.col("store") == "click").groupBy("store").agg(F.max("id").alias("compacted"))
    return H.history_markers(ids, H.advance_marker(old, newer, "compacted"))


@query(f"""WITH {HIST} SELECT id, modified AS first_appearance, modified, hash, entity_id, "timestamp", "end", event_type FROM hist""")
def first_appearance(t):
    bare = t.history.withColumn("first_appearance", F.lit(None).cast("timestamp_ntz"))
    return H.first_appearance_backfill(bare)


_SPLIT = "2024-01-20 00:00:00"
_STORED_RUNS = f"""{HIST}, {_RUNS},
    counted AS (SELECT *, "timestamp" < TIMESTAMP '{_SPLIT}' AS early, count(*) FILTER ("timestamp" < TIMESTAMP '{_SPLIT}') OVER () AS earlier FROM runs),
    numbered AS (SELECT * EXCLUDE (id), CASE WHEN early THEN 0 ELSE earlier END + {_NUMBER.replace("(ORDER BY", "(PARTITION BY early ORDER BY")} AS id FROM counted),
    stored AS (SELECT min(id) AS id, CASE WHEN bool_or(early) THEN TIMESTAMP '2024-03-01' ELSE TIMESTAMP '2024-03-03' END AS first_appearance,
        CASE WHEN count(*) > 1 AND NOT bool_and(early) THEN TIMESTAMP '2024-03-04' WHEN count(*) > 1 THEN TIMESTAMP '2024-03-02'
            WHEN bool_and(early) THEN TIMESTAMP '2024-03-01' ELSE TIMESTAMP '2024-03-03' END AS modified,
        min(hash) AS hash, entity_id, min("timestamp") AS "timestamp", max("timestamp") AS "end", min(event_type) AS event_type FROM numbered GROUP BY entity_id, run)"""


def _two_batches(t) -> AttributeStore:
    """Events before and after 20 January, each staged, transferred and compacted, a day apart."""
    store = AttributeStore(t.spark, scratch_path(t.spark, "attributes"), {"event_type": "string"}, "10 days", spread=8)
    rows = t.history.select("entity_id", "timestamp", "event_type")
    early = F.col("timestamp") < at(_SPLIT)
    for day, batch in ((1, rows.filter(early)), (3, rows.filter(~early))):
        store.transfer(batch, datetime(2024, 3, day))
        store.compact(datetime(2024, 3, day + 1))
    return store


@query(f"""WITH {_STORED_RUNS} SELECT * FROM stored""")
def attribute_store(t):
    return _two_batches(t).read()


@query(f"""WITH {_STORED_RUNS} SELECT * EXCLUDE (rn) FROM
    (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY "timestamp" DESC) AS rn FROM stored) WHERE rn = 1""")
def attribute_store_current(t):
    return _two_batches(t).current()


# --- change tracking -----------------------------------------------------------------

_OLD = 2500
_OLD_MOD = f"""old AS (SELECT part, "timestamp", min(modified) AS "first", max(modified) AS "last" FROM log WHERE id <= {_OLD} GROUP BY 1, 2)"""


def _old_modified(t):
    log = t.modified_log.filter(F.col("id") <= _OLD)
    return log.groupBy("part", "timestamp").agg(F.min("modified").alias("first"), F.max("modified").alias("last"))


@query(f"""WITH {LOG}, {_OLD_MOD}, batch AS (SELECT part, "timestamp", max(modified) AS m FROM log WHERE id > {_OLD} GROUP BY 1, 2)
    SELECT part, "timestamp", coalesce("first", m) AS "first", coalesce(m, "last") AS "last" FROM old FULL JOIN batch USING (part, "timestamp")""")
def process_modified_log(t):
    return C.process_modified_log(t.modified_log, _old_modified(t), _OLD)


@query(f"SELECT coalesce(max(event_id), {_OLD}) AS last_processed_id FROM events WHERE event_id > {_OLD}")
def last_processed_id(t):
    return C.last_processed_id(t.modified_log, _OLD)


def _links(t):
    """Also a level above another one, a month of days, and a granularity spelled out."""
    more = [("by_day", "view", "1h", "1d"), ("by_month", "error", "1d", "1month"), ("spelled", "signup", "00:15:00", "1h")]
    return C.link_table(t.spark, _materializations()).unionByName(
        t.spark.createDataFrame(more, "materialization string, part string, source_granularity string, target_granularity string")
    )


def _materializations():
    hourly = Materialization("mixed_1h", "mixed_1h", "1h", [SourceLink("click", "15m"), SourceLink("view", "15m")])
    daily = Materialization("mixed_1d", "mixed_1d", "1d", [SourceLink("click", "15m"), SourceLink("error", "15m")])
    return [hourly, daily]


_H = """CAST(date_trunc('hour', "timestamp" - INTERVAL 15 MINUTE) + INTERVAL 1 HOUR AS TIMESTAMP)"""
_D = """CAST(date_trunc('day', "timestamp" - INTERVAL 15 MINUTE) + INTERVAL 1 DAY AS TIMESTAMP)"""


@query(f"""WITH {MOD} SELECT DISTINCT 'mixed_1h' AS materialization, {_H} AS "timestamp" FROM modified WHERE part IN ('click', 'view')
    UNION ALL SELECT DISTINCT 'mixed_1d', {_D} FROM modified WHERE part IN ('click', 'error')
    UNION ALL SELECT DISTINCT 'by_day', date_trunc('day', "timestamp" - INTERVAL 1 HOUR) + INTERVAL 1 DAY FROM modified WHERE part = 'view'
    UNION ALL SELECT DISTINCT 'by_month', date_trunc('month', "timestamp" - INTERVAL 1 DAY) + INTERVAL 1 MONTH FROM modified WHERE part = 'error'
    UNION ALL SELECT DISTINCT 'spelled', {_H} FROM modified WHERE part = 'signup'""")
def map_modified(t):
    return C.map_modified(t.modified, _links(t))


_STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


@query(f"""WITH {MOD} SELECT part, "timestamp", "last" AS max_modified, '{{"' || part || '":"' || {_STAMP.format('"last"')} || '"}}' AS fingerprint FROM modified""")
def fingerprint_single(t):
    return C.fingerprint_single(t.modified)


def _window_sql(modified: str, name: str) -> str:
    """Fingerprint of every touched hour over its four quarters."""
    return f"""{name} AS (
    WITH label AS (SELECT DISTINCT part, {_H} AS label FROM {modified}),
    dense AS (SELECT part, label, label - i * INTERVAL 15 MINUTE AS "timestamp" FROM label, range(0, 4) r(i))
    SELECT dense.part, label AS "timestamp", max("last") AS max_modified,
        '{{' || string_agg('"' || {_STAMP.format('dense."timestamp"')} || '":"' || coalesce({_STAMP.format('"last"')}, '') || '"', ',' ORDER BY dense."timestamp") || '}}' AS fingerprint
    FROM dense LEFT JOIN {modified} m ON m.part = dense.part AND m."timestamp" = dense."timestamp" GROUP BY dense.part, label)"""


def _window(modified):
    labels = modified.select("part", map_label("timestamp", "15m", "1h").alias("timestamp")).distinct()
    return C.fingerprint_window(labels, modified, "15m", "1h")


@query(f"""WITH {MOD}, {_window_sql('modified', 'w')} SELECT * FROM w""")
def fingerprint_window(t):
    return _window(t.modified)


@query(f"""WITH {MOD} SELECT "timestamp", max("last") AS max_modified,
    '{{' || string_agg('"' || part || '":"' || {_STAMP.format('"last"')} || '"', ',' ORDER BY part) || '}}' AS fingerprint
    FROM modified WHERE part IN ('click', 'view') GROUP BY 1 HAVING count(*) = 2""")
def fingerprint_multi(t):
    return C.fingerprint_multi(t.modified, ["click", "view"])


_STATES = f"""{MOD}, {_OLD_MOD}, {_window_sql('old', 'oldw')}, {_window_sql('modified', 'neww')}"""
_STATE_SQL = f"""{_STATES}, state AS (
    SELECT part AS materialization, "timestamp", neww.fingerprint AS source_fingerprint, oldw.fingerprint AS processed_fingerprint,
        neww.max_modified, CASE WHEN oldw.part IS NOT NULL THEN 1 END AS job_id
    FROM neww LEFT JOIN oldw USING (part, "timestamp"))"""


def _fingerprints(modified):
    return _window(modified).withColumnRenamed("part", "materialization")


def _state(t):
    """State after the older changes were processed by job 1 and the newer ones came in."""
    seen = C.update_source_fingerprint(C.empty_state(t.spark), _fingerprints(_old_modified(t)))
    processed = C.mark_processed(seen, seen.select(*C.STATE_KEY), 1)
    return C.update_source_fingerprint(processed, _fingerprints(t.modified))


@query(f"WITH {_STATE_SQL} SELECT * FROM state")
def materialization_state(t):
    return _state(t)


@query(f"""WITH {MOD}, {_window_sql('modified', 'w')}, clicks AS (SELECT DISTINCT {_H} AS "timestamp" FROM log WHERE part = 'click'),
    views AS (SELECT DISTINCT {_H} AS "timestamp" FROM log WHERE part = 'view')
    SELECT 'mixed_1h' AS materialization, "timestamp", '{{"click":' || c.fingerprint || ',"view":' || v.fingerprint || '}}' AS source_fingerprint,
        CAST(NULL AS VARCHAR) AS processed_fingerprint, greatest(c.max_modified, v.max_modified) AS max_modified, CAST(NULL AS BIGINT) AS job_id
    FROM (FROM w WHERE part = 'click') c JOIN (FROM w WHERE part = 'view') v USING ("timestamp") JOIN clicks USING ("timestamp") JOIN views USING ("timestamp")""")
def populate_fingerprint(t):
    records = t.records_15m
    sources = [(records.filter(F.col("part") == part), "15m") for part in ("click", "view")]
    prints = C.combine_fingerprints(_window(t.modified), ["click", "view"])
    return C.populate_fingerprint(C.empty_state(t.spark), "mixed_1h", sources, "1h", prints)


@query(f"""WITH {_STATE_SQL} SELECT * FROM state WHERE processed_fingerprint IS NOT NULL""")
def reset_fingerprint(t):
    seen = C.update_source_fingerprint(C.empty_state(t.spark), _fingerprints(_old_modified(t)))
    processed = C.mark_processed(seen, seen.select(*C.STATE_KEY), 1)
    return C.reset_fingerprint(processed, _fingerprints(t.modified))


@query(f"""WITH {_STATE_SQL} SELECT * FROM state WHERE source_fingerprint IS DISTINCT FROM processed_fingerprint
    AND materialization <> 'error' AND "timestamp" + INTERVAL 30 MINUTE <= TIMESTAMP '2024-01-30 00:00:00'
    AND max_modified + INTERVAL 5 MINUTE <= TIMESTAMP '2024-01-30 00:00:00'
    AND "timestamp" + INTERVAL 25 DAY >= TIMESTAMP '2024-01-30 00:00:00'""")
def pending_materializations(t):
    kinds = ("click", "view", "error", "signup", "purchase")
    jobs = [Materialization(kind, kind, "1h", [], reprocessing_period="25 days", enabled=kind != "error") for kind in kinds]
    return C.pending_materializations(_state(t), C.materialization_jobs(t.spark, jobs), at("2024-01-30 00:00:00"))


_REC_H = f"""{REC}, hourly AS (SELECT entity_id, {_H} AS "timestamp", count(*) AS samples, CAST(sum(value) AS DECIMAL(38,2)) AS value FROM rec GROUP BY 1, 2)"""


def _hourly(records):
    rolled = time_rollup(records, "15m", "1h", ["value"])
    return rolled.withColumn("value", F.col("value").cast(TOTAL))


def _destination(t):
    """Rollup made by job 1 from everything but sign-ups."""
    stale = _hourly(t.records_15m.filter(F.col("part") != "signup"))
    return stale.withColumn("created", at("2024-01-01 00:00:00")).withColumn("job_id", F.lit(1).cast("bigint"))


_DEST = f"""{_REC_H}, stale AS (SELECT entity_id, {_H} AS "timestamp", count(*) AS samples, CAST(sum(value) AS DECIMAL(38,2)) AS value
    FROM rec WHERE part <> 'signup' GROUP BY 1, 2)"""


@query(f"""WITH {_DEST} SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS created, 1 AS job_id FROM stale WHERE "timestamp" <= TIMESTAMP '2024-01-25 00:00:00'
    UNION ALL SELECT *, {_NOW}, 2 FROM hourly WHERE "timestamp" > TIMESTAMP '2024-01-25 00:00:00'""")
def materialize_replace(t):
    """All hours after 25 January are replaced."""
    fresh = _hourly(t.records_15m)
    labels = fresh.filter(F.col("timestamp") > at("2024-01-25 00:00:00")).select("timestamp").distinct()
    return C.replace_timestamps(_destination(t), fresh, labels, at(NOW), 2)


@query(f"""WITH {_DEST}, touched AS (SELECT DISTINCT {_H} AS "timestamp" FROM rec WHERE part = 'signup')
    SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS created, 1 AS job_id FROM stale WHERE "timestamp" NOT IN (SELECT "timestamp" FROM touched)
    UNION ALL SELECT *, {_NOW}, 2 FROM hourly WHERE "timestamp" IN (SELECT "timestamp" FROM touched)""")
def incremental_rollup(t):
    """The sign-ups arrived late: only the hours they fall into are computed again."""
    changed = t.modified.filter(F.col("part") == "signup").select("timestamp")
    return I.incremental_rollup(
        t.records_15m, _destination(t), changed, "15m", "1h", ["value"], at(NOW), 2
    ).withColumn("value", F.col("value").cast(TOTAL))


@query(f"""WITH {_DEST}, touched AS (SELECT DISTINCT {_H} AS "timestamp" FROM rec WHERE part = 'signup' AND "timestamp" > TIMESTAMP '2024-01-20 00:00:00')
    SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS created, 1 AS job_id FROM stale WHERE "timestamp" NOT IN (SELECT "timestamp" FROM touched)
    UNION ALL SELECT *, {_NOW}, 2 FROM hourly WHERE "timestamp" IN (SELECT "timestamp" FROM touched)""")
def incremental_rollup_stored(t):
    """Between stored tables: late sign-ups change the buckets after 20 January, the others stay as they are."""
    columns = "created timestamp_ntz, job_id bigint, value decimal(38,2)"
    records = FactStore(t.spark, scratch_path(t.spark, "records"), f"entity_id bigint, timestamp timestamp_ntz, {columns}", "5 days")
    hours = FactStore(t.spark, scratch_path(t.spark, "hours"), f"entity_id bigint, timestamp timestamp_ntz, samples bigint, {columns}", "5 days")
    start = at("2024-01-01 00:00:00")
    records.append(stamp_job(t.records_15m.select("entity_id", "timestamp", "value"), start, 1))
    hours.append(_destination(t))
    late = (F.col("part") == "signup") & (F.col("timestamp") > at("2024-01-20 00:00:00"))
    changed = t.modified.filter(late).select("timestamp")
    I.incremental_rollup_stored(records, hours, changed, "15m", "1h", ["value"], at(NOW), 2)
    return hours.read()


def _stats(t):
    """Counts of the older half of the log, taken just after it was processed."""
    counts = t.modified_log.filter(F.col("id") <= _OLD).groupBy("part", "timestamp").agg(
        F.max("modified").alias("modified"), F.count(F.lit(1)).alias("count")
    )
    return counts.withColumn("modified", F.col("modified") + F.make_dt_interval(mins=F.lit(5)))


_STATS = f"""{MOD}, stats AS (SELECT part, "timestamp", max(modified) + INTERVAL 5 MINUTE AS modified, count(*) AS count FROM log WHERE id <= {_OLD} GROUP BY 1, 2)"""


@query(f"""WITH {_STATS} SELECT part, "timestamp", TIMESTAMP '1999-12-31 22:00:00' AS modified, 0 AS count FROM modified
    ANTI JOIN stats USING (part, "timestamp")""")
def missing_stats(t):
    return C.missing_stats(t.modified, _stats(t))


_ALL_STATS = f"""{_STATS}, seeded AS (SELECT * FROM stats UNION ALL
    SELECT part, "timestamp", TIMESTAMP '1999-12-31 22:00:00', 0 FROM modified ANTI JOIN stats USING (part, "timestamp")),
    stale AS (SELECT part, "timestamp" FROM seeded JOIN modified m USING (part, "timestamp") WHERE seeded.modified < m."last" + INTERVAL 1 SECOND)"""


def _seeded(t):
    stats = _stats(t)
    return stats.unionByName(C.missing_stats(t.modified, stats))


@query(f"""WITH {_ALL_STATS} SELECT * FROM stale""")
def stale_stats(t):
    return C.stale_stats(_seeded(t), t.modified)


@query(f"""WITH {_ALL_STATS}, counts AS (SELECT part, "timestamp", count(*) AS n FROM log GROUP BY 1, 2)
    SELECT part, "timestamp", CASE WHEN stale.part IS NOT NULL THEN {_NOW} ELSE modified END AS modified,
        CASE WHEN stale.part IS NOT NULL THEN coalesce(n, 0) ELSE count END AS count
    FROM seeded LEFT JOIN stale USING (part, "timestamp") LEFT JOIN counts USING (part, "timestamp")""")
def refresh_stats(t):
    return C.refreshed_stats(t.modified_log, _stats(t), t.modified, at(NOW))


@query(f"""WITH {_ALL_STATS} SELECT part, "timestamp", count(*) AS count FROM log JOIN stale USING (part, "timestamp") GROUP BY 1, 2""")
def count_stale(t):
    return C.count_stale(t.modified_log, _seeded(t), t.modified)


# Region, nation, customer and order as a dependency chain; suppliers make a second path.
_EDGES = """edges AS (
    SELECT 'region ' || n_regionkey AS source, 'nation ' || n_nationkey AS depender FROM nation
    UNION ALL SELECT 'nation ' || c_nationkey, 'customer ' || c_custkey FROM customer
    UNION ALL SELECT 'nation ' || s_nationkey, 'segment ' || s_suppkey FROM supplier
    UNION ALL SELECT 'segment ' || s_suppkey, 'nation total ' || s_nationkey FROM supplier
    UNION ALL SELECT 'customer ' || o_custkey, 'order ' || o_orderkey FROM orders)"""


def _edges(t):
    def edge(df, source, source_key, depender, key):
        return df.select(
            F.concat(F.lit(source + " "), F.col(source_key).cast("string")).alias("source"),
            F.concat(F.lit(depender + " "), F.col(key).cast("string")).alias("depender"),
        )

    frames = [
        edge(t.nation, "region", "n_regionkey", "nation", "n_nationkey"),
        edge(t.customer, "nation", "c_nationkey", "customer", "c_custkey"),
        edge(t.supplier, "nation", "s_nationkey", "segment", "s_suppkey"),
        edge(t.supplier, "segment", "s_suppkey", "nation total", "s_nationkey"),
        edge(t.orders, "customer", "o_custkey", "order", "o_orderkey"),
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


@query(f"""WITH RECURSIVE {_EDGES}, dependers AS (
    SELECT source AS root, depender AS name, 1 AS level FROM edges WHERE source LIKE 'region %'
    UNION ALL SELECT root, depender, level + 1 FROM dependers JOIN edges ON source = name)
    SELECT root, name, level, count(*) AS paths FROM dependers GROUP BY ALL""")
def lineage_closure(t):
    roots = t.region.select(F.concat(F.lit("region "), F.col("r_regionkey").cast("string")).alias("name"))
    return closure(_edges(t), roots)


@query("""SELECT 'customer ' || c_custkey AS name, coalesce('order ' || o_orderkey, 'customer ' || c_custkey) AS source
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey""")
def resolve_view_sources(t):
    def named(kind, column):
        return F.concat(F.lit(kind + " "), F.col(column).cast("string"))

    parts = t.customer.select(named("customer", "c_custkey").alias("name"))
    return resolve_sources(parts, t.orders.select(named("customer", "o_custkey").alias("view"), named("order", "o_orderkey").alias("source")))
