"""Structured Streaming jobs, run over the whole of ``events`` until nothing is left."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.functions.timeaxis import ceil_to_granularity
from tidegauge.session import scratch_path
from tidegauge.sources.factstore import FactStore
from tidegauge.sources.loading import EntityStore
from tidegauge.streaming import jobs as J
from tidegauge.streaming import late
from workload.alerting import HIGH_VALUE
from workload.registry import query
from workload.tables import EXC, HIST, MOD, REC, TOTAL, at

NOW = "2024-02-01 00:00:00"
_NOW = f"TIMESTAMP '{NOW}'"
_LATENESS = "40 days"
_H = """date_trunc('hour', "timestamp" - INTERVAL 15 MINUTE) + INTERVAL 1 HOUR"""


def _events(t):
    """The events table as a stream."""
    return t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)


def _split_events(t, batches: int = 3):
    """The events arriving as several files, one per micro-batch."""
    path = scratch_path(t.spark, "arriving")
    t.events.repartitionByRange(batches, "event_id").write.parquet(path)
    return t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _columns():
    return (
        F.col("user_id").alias("entity_id"), ceil_to_granularity("ts", "15m").alias("timestamp"),
        F.col("value").cast("decimal(18,2)").alias("value"),
    )


def _records(events):
    return events.select(*_columns())


def _run(t, writer):
    J.run_available(writer, scratch_path(t.spark, "progress"))


@query(f"""WITH {REC} SELECT entity_id, {_H} AS "timestamp", count(*) AS samples, CAST(sum(value) AS DECIMAL(38,2)) AS value FROM rec GROUP BY 1, 2""")
def stream_rollup(t):
    rolled = J.rollup(_records(_split_events(t)), "15m", "1h", ["value"], _LATENESS)
    rolled = rolled.withColumn("value", F.col("value").cast(TOTAL))
    store = FactStore(
        t.spark, scratch_path(t.spark, "rollup"),
        "entity_id bigint, timestamp timestamp_ntz, created timestamp_ntz, job_id bigint, samples bigint, value decimal(38,2)",
        "10 days",
    )
    _run(t, J.into_store(rolled, store, now=lambda batch: at(NOW)))
    return store.read().drop("created", "job_id")


@query(f"WITH {MOD} SELECT * FROM modified".replace('min(modified) AS "first"', 'max(modified) AS "first"'))
def stream_modified_log(t):
    """All log rows in one batch, so a new row's first and last change are the same."""
    log = _events(t).select(
        F.col("event_id").alias("id"), F.col("event_type").alias("part"),
        ceil_to_granularity("ts", "15m").alias("timestamp"), F.col("ts").alias("modified"),
    )
    store = J.modified_store(t.spark, scratch_path(t.spark, "modified"), "10 days")
    _run(t, J.process_log(log, store))
    return store.read()


_FOUND = f"""{REC}, {EXC}, found AS (
    SELECT rec.entity_id, rec."timestamp", CAST(least(900, 100 + 50 * floor((value - lim) / 20)) AS INTEGER) AS weight,
        'value ' || value || ' is ' || (value - lim) || ' above its limit of ' || lim AS details,
        '{{"limit":' || lim || ',"excess":' || (value - lim) || '}}' AS data
    FROM (SELECT rec.*, coalesce(exc.max_value, CAST(100 AS DECIMAL(18,2))) AS lim FROM rec
        LEFT JOIN exc ON exc.entity_id = rec.entity_id AND exc."start" <= rec."timestamp" AND exc.expires > rec."timestamp") rec WHERE value > lim)"""


@query(f"""WITH {_FOUND} SELECT entity_id, "timestamp", 1 AS rule_id, {_NOW} AS created, weight, details, data FROM found
    QUALIFY row_number() OVER (PARTITION BY entity_id, "timestamp" ORDER BY weight DESC, details DESC, data DESC) = 1""")
def stream_notifications(t):
    """Of several records of an entity in one quarter, which arrive in different batches, the strongest counts."""
    store = J.notification_store(t.spark, scratch_path(t.spark, "notifications"), "10 days")
    _run(t, J.notify(_records(_split_events(t)), HIGH_VALUE, store, lambda batch: at(NOW), t.exceptions))
    return store.read()


@query(f"""WITH {HIST} SELECT entity_id, id, "timestamp", event_type FROM
    (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY "timestamp" DESC) AS rn FROM hist) WHERE rn = 1""")
def stream_attribute_current(t):
    history = _split_events(t).select(
        F.col("user_id").alias("entity_id"), F.col("event_id").alias("id"), F.col("ts").alias("timestamp"), "event_type"
    )
    table = J.VersionedTable(
        t.spark, scratch_path(t.spark, "current"), "entity_id bigint, id bigint, timestamp timestamp_ntz, event_type string"
    )
    _run(t, J.keep_latest(J.attribute_current(history), table, ["entity_id"]))
    return table.read()


@query(f"""WITH {REC} SELECT 'events_15m' AS part, "timestamp", count(*) AS count FROM rec GROUP BY 2""")
def stream_completeness(t):
    counts = J.completeness(_records(_split_events(t)), "events_15m", _LATENESS)
    store = FactStore(
        t.spark, scratch_path(t.spark, "counts"), "part string, timestamp timestamp_ntz, count bigint", "10 days",
        key=("part", "timestamp"),
    )
    _run(t, J.put_in_store(counts, store))
    return store.read()


@query(f"""SELECT 'user ' || user_id AS name, ts AS "timestamp", CAST(value AS DECIMAL(18,2)) AS value, {_NOW} AS created, {_NOW} AS marked FROM events""")
def stream_ingest(t):
    rows = _split_events(t).select(
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("entity"), F.col("ts").alias("timestamp"),
        F.col("value").cast("decimal(18,2)").alias("value"),
    )
    store = FactStore(
        t.spark, scratch_path(t.spark, "facts"),
        "entity_id bigint, timestamp timestamp_ntz, created timestamp_ntz, job_id bigint, value decimal(18,2)", "10 days",
    )
    entities = EntityStore(t.spark, scratch_path(t.spark, "entities"), spread=8)
    modified = J.modified_store(t.spark, scratch_path(t.spark, "modified"), "10 days")
    _run(t, J.ingest(rows, "events", store, entities, modified, now=lambda batch: at(NOW)))
    names = entities.read().select(F.col("id").alias("entity_id"), "name")
    marks = modified.read().select("timestamp", F.col("last").alias("marked"))
    return store.read().join(names, "entity_id").join(marks, "timestamp").select("name", "timestamp", "value", "created", "marked")


def _shuffled_events(t, batches: int = 4):
    """The events in an order that has nothing to do with time: every file has records of all thirty days."""
    path = scratch_path(t.spark, "shuffled")
    t.events.repartition(batches, F.xxhash64("event_id")).write.parquet(path)
    return t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _kept(t, events, target: str):
    """Records, change marks of late ones, after all have arrived."""
    store = FactStore(
        t.spark, scratch_path(t.spark, "records"), "event_id bigint, entity_id bigint, timestamp timestamp_ntz, value decimal(18,2)", "5 days",
        key=("event_id", "timestamp"),
    )
    modified = J.modified_store(t.spark, scratch_path(t.spark, "modified"), "5 days")
    records = events.select("event_id", *_columns())
    seen = late.horizon(t.spark, scratch_path(t.spark, "horizon"))
    _run(t, late.keep_records(records, "events_15m", "15m", target, store, modified, seen, lambda batch: at(NOW), "1 day"))
    return store, modified


@query(f"""WITH {REC} SELECT entity_id, {_H} AS "timestamp", count(*) AS samples, CAST(sum(value) AS DECIMAL(38,2)) AS value FROM rec GROUP BY 1, 2""")
def stream_rollup_late(t):
    """Most records come later than the lateness of a day; the rollup of the marked labels makes up for what the stream dropped."""
    events = _shuffled_events(t)
    rolled = J.rollup(_records(events), "15m", "1h", ["value"], "1 day").withColumn("value", F.col("value").cast(TOTAL))
    hours = FactStore(
        t.spark, scratch_path(t.spark, "rollup"),
        "entity_id bigint, timestamp timestamp_ntz, created timestamp_ntz, job_id bigint, samples bigint, value decimal(38,2)", "10 days",
    )
    _run(t, J.into_store(rolled, hours, now=lambda batch: at(NOW)))
    records, modified = _kept(t, events, "1h")
    late.make_up_rollup(records, hours, modified, "events_15m", "15m", "1h", ["value"], at(NOW), 99)
    return hours.read().drop("created", "job_id")


@query(f"""WITH {REC} SELECT 'events_15m' AS part, "timestamp", count(*) AS count FROM rec GROUP BY 2""")
def stream_completeness_late(t):
    """The same for the counts of records."""
    events = _shuffled_events(t)
    counts = FactStore(
        t.spark, scratch_path(t.spark, "counts"), "part string, timestamp timestamp_ntz, count bigint", "10 days", key=("part", "timestamp")
    )
    _run(t, J.put_in_store(J.completeness(_records(events), "events_15m", "1 day"), counts))
    records, modified = _kept(t, events, "15m")
    late.make_up_counts(records, counts, modified, "events_15m")
    return counts.read()
