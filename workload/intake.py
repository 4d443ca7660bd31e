"""Loading: delimited files, typed values, upserts, stores, buckets and job logs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidegauge.functions import arrays as A
from tidegauge.functions import timeaxis as X
from tidegauge.functions import types as Y
from tidegauge.operators import evolution as V
from tidegauge.plans.cascade import MODIFIED
from tidegauge.plans.spec import GeneratedTrend, Trend, TrendStorePart
from tidegauge.session import scratch_path
from tidegauge.sources import delimited as L
from tidegauge.sources import factstore as S
from tidegauge.sources.loading import EntityStore, JobLog, Loader
from workload.registry import query
from workload.tables import F15, Q15, REC, at

NOW = "2024-02-01 00:00:00"
_NOW = f"TIMESTAMP '{NOW}'"

_TEXT_VALUE = "CASE WHEN event_id % 7 = 0 THEN '' ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END"


def _texts(t):
    """Events as text cells; every seventh value is the null token."""
    value = F.col("value").cast("decimal(18,2)").cast("string")
    return t.events.select(
        "event_id", "event_type", "props", F.when(F.col("event_id") % 7 == 0, "").otherwise(value).alias("value"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("node"), "ts",
    )


def _written(t, separator: str = ",", header: bool = True):
    """The events as a delimited file with RFC 3339 timestamps two hours east of UTC."""
    path = scratch_path(t.spark, "delimited")
    local = F.col("ts") + F.make_dt_interval(hours=F.lit(2))
    stamp = F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00"))
    cells = F.concat(F.lit("{"), F.col("event_id").cast("string"), F.lit(",0,5}"))
    rows = _texts(t).select("node", stamp.alias("time"), "value", F.col("event_id").cast("string").alias("event_id"), cells.alias("cells"))
    rows.write.option("emptyValue", "").csv(path, header=header, sep=separator)
    return path


@query("""SELECT 'user ' || user_id AS entity, ts AS "timestamp", event_id,
    CASE WHEN event_id % 7 <> 0 THEN CAST(value AS DECIMAL(18,2)) END AS value FROM events""")
def load_delimited(t):
    layout = L.DelimitedFormat(entity_column="node", timestamp_column="time")
    rows = L.read_delimited(t.spark, _written(t), layout)
    typed = L.typed_columns(rows, {"value": "numeric", "event_id": "bigint"}, layout)
    return typed.select("entity", "timestamp", "event_id", F.col("value").cast("decimal(18,2)").alias("value"))


@query("""SELECT 'user ' || user_id AS entity, ts AS "timestamp", event_id, event_id + 5 AS total FROM events""")
def load_delimited_by_position(t):
    """A tab-separated file without header, with array cells."""
    layout = L.DelimitedFormat(columns=["entity", "timestamp", "value", "event_id", "cells"], separator="\t")
    rows = L.read_delimited(t.spark, _written(t, "\t", header=False), layout)
    typed = L.typed_columns(rows, {"event_id": "bigint", "cells": "integer[]"}, layout)
    return typed.select("entity", "timestamp", "event_id", A.array_sum("cells", "bigint").alias("total"))


@query("""SELECT event_id, 'power' AS part, CAST(value AS DECIMAL(18,2)) AS value, CAST(NULL AS VARCHAR) AS props FROM events
    UNION ALL SELECT event_id, 'all', CAST(value AS DECIMAL(18,2)), props FROM events""")
def route_columns(t):
    """``value`` belongs to two parts, ``event_type`` to none, and one part has no column in the file."""
    rows = t.events.select("event_id", F.col("value").cast("decimal(18,2)").alias("value"), "props", "event_type")
    parts = {"power": ["value", "voltage"], "all": ["value", "props"], "absent": ["humidity"]}
    routed = L.route_columns(rows, parts, key=["event_id"])
    frames = [df.withColumn("part", F.lit(part)) for part, df in routed.items()]
    return frames[0].unionByName(frames[1], allowMissingColumns=True)


@query(f"""SELECT event_id, CAST(nullif({_TEXT_VALUE}, '') AS DECIMAL(18,2)) AS as_numeric, CAST(nullif({_TEXT_VALUE}, '') AS DOUBLE) AS as_double,
    CASE WHEN event_id % 7 <> 0 THEN CAST(user_id AS SMALLINT) END AS as_smallint, event_type AS as_text, ts AS as_timestamp FROM events""")
def parse_strict(t):
    small = F.when(F.col("event_id") % 7 == 0, "").otherwise(F.regexp_extract("node", "[0-9]+", 0))
    texts = _texts(t)
    return texts.select(
        "event_id", Y.parse_strict("value", "numeric").cast("decimal(18,2)").alias("as_numeric"),
        Y.parse_strict("value", "double precision").alias("as_double"), Y.parse_strict(small, "smallint").alias("as_smallint"),
        Y.parse_strict("event_type", "text").alias("as_text"),
        Y.parse_strict(F.col("ts").cast("string"), "timestamp").alias("as_timestamp"),
    )


@query(f"""WITH c AS (SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 THEN props WHEN event_id % 5 = 0 THEN '99999999999'
        WHEN event_id % 5 = 1 THEN CAST(user_id AS VARCHAR) ELSE {_TEXT_VALUE} END AS cell FROM events)
    SELECT event_id, TRY_CAST(nullif(cell, '') AS DECIMAL(18,2)) AS as_numeric, TRY_CAST(nullif(cell, '') AS DOUBLE) AS as_double,
        CASE WHEN regexp_full_match(cell, '[0-9]+') THEN CAST(cell AS BIGINT) END AS as_bigint,
        CASE WHEN regexp_full_match(cell, '[0-9]{{1,9}}') THEN CAST(cell AS INTEGER) END AS as_integer FROM c""")
def parse_lenient(t):
    """Cells of all kinds: JSON, a whole number beyond integer, small ones, decimals and empty text."""
    number = F.regexp_extract("node", "[0-9]+", 0)
    cell = (
        F.when(F.col("event_id") % 3 == 0, F.col("props")).when(F.col("event_id") % 5 == 0, "99999999999")
        .when(F.col("event_id") % 5 == 1, number).otherwise(F.col("value"))
    )
    cells = _texts(t).select("event_id", cell.alias("cell"))
    return cells.select(
        "event_id", Y.parse_lenient("cell", "numeric").try_cast("decimal(18,2)").alias("as_numeric"),
        Y.parse_lenient("cell", "double precision").alias("as_double"),
        Y.parse_lenient("cell", "bigint").alias("as_bigint"), Y.parse_lenient("cell", "integer").alias("as_integer"),
    )


@query("""SELECT o_orderkey, (o_orderkey * 1000003 * 1009 + 2147483648) % 4294967296 - 2147483648 AS wrapped, CAST(o_custkey AS DECIMAL(18,2)) AS widened,
    CASE WHEN o_totalprice * 10000 < 2147483647 THEN CAST(floor(o_totalprice * 10000) AS BIGINT) END AS limited,
    o_orderkey || ',' || o_custkey AS joined FROM orders""")
def coerce_columns(t):
    rows = t.orders.select(
        "o_orderkey", (F.col("o_orderkey") * 1000003 * 1009).alias("large"), "o_custkey",
        F.floor(F.col("o_totalprice") * 10000).cast("double").alias("real"),
        F.array(F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")).alias("keys"),
    )
    return rows.select(
        "o_orderkey", Y.coerce("large", "bigint", "integer").cast("bigint").alias("wrapped"),
        Y.coerce("o_custkey", "bigint", "numeric").cast("decimal(18,2)").alias("widened"),
        Y.coerce("real", "double precision", "integer").cast("bigint").alias("limited"),
        Y.coerce("keys", "text[]", "text").alias("joined"),
    )


_EXISTING = """existing AS (SELECT user_id AS entity_id, ts AS "timestamp", TIMESTAMP '2024-01-01 00:00:00' AS created, 1 AS job_id,
    CAST(value AS DECIMAL(18,2)) AS value, event_type AS note FROM events WHERE event_type <> 'signup')"""
_BATCH = """batch AS (SELECT user_id AS entity_id, ts AS "timestamp", CASE WHEN event_id % 7 <> 0 THEN CAST(value AS DECIMAL(18,2)) + 1 END AS value
    FROM events WHERE event_type IN ('signup', 'click'))"""
_UPSERTED = f"""{_EXISTING}, {_BATCH}, merged AS (
    SELECT entity_id, "timestamp", coalesce(created, {_NOW}) AS created, coalesce(job_id, 2) AS job_id,
        CASE WHEN b.entity_id IS NOT NULL THEN b.value ELSE e.value END AS value, note
    FROM existing e FULL JOIN batch b USING (entity_id, "timestamp"))"""
_STORE_SCHEMA = (
    "entity_id bigint, timestamp timestamp_ntz, created timestamp_ntz, job_id bigint, value decimal(18,2), note string"
)


def _existing(t):
    return t.events.filter(F.col("event_type") != "signup").select(
        F.col("user_id").alias("entity_id"), F.col("ts").alias("timestamp"), at("2024-01-01 00:00:00").alias("created"),
        F.lit(1).cast("bigint").alias("job_id"), F.col("value").cast("decimal(18,2)").alias("value"), F.col("event_type").alias("note"),
    )


def _batch(t):
    """New values for clicks and sign-ups, each sent twice: the second one counts."""
    rows = t.events.filter(F.col("event_type").isin("signup", "click"))
    value = F.col("value").cast("decimal(18,2)")
    keys = [F.col("user_id").alias("entity_id"), F.col("ts").alias("timestamp")]
    first = rows.select(*keys, F.lit(0).alias("line"), value.alias("value"))
    second = rows.select(*keys, F.lit(1).alias("line"), F.when(F.col("event_id") % 7 != 0, (value + 1).cast("decimal(18,2)")).alias("value"))
    return first.unionByName(second)


@query(f"WITH {_UPSERTED} SELECT * FROM merged")
def upsert_partial(t):
    return S.upsert_partial(_existing(t), _batch(t), at(NOW), 2, order="line")


@query(f"WITH {_UPSERTED} SELECT * FROM merged")
def bulk_append_or_upsert(t):
    """A stored table: the first batch is appended, the second one merged into the buckets it touches."""
    store = S.FactStore(t.spark, scratch_path(t.spark, "facts"), _STORE_SCHEMA, "1 day")
    first = _existing(t).drop("created", "job_id")
    store.append_or_upsert(first, at("2024-01-01 00:00:00"), 1)
    store.append_or_upsert(_batch(t), at(NOW), 2, order="line")
    return store.read()


@query(f"""WITH {_EXISTING} SELECT * FROM existing WHERE "timestamp" > TIMESTAMP '2024-01-10 00:00:00' AND "timestamp" <= TIMESTAMP '2024-01-12 06:00:00'""")
def bucketed_write(t):
    """Written in one-day buckets; the range opens only the folders it needs."""
    store = S.FactStore(t.spark, scratch_path(t.spark, "facts"), _STORE_SCHEMA, "1 day")
    store.append(_existing(t))
    return store.between(datetime(2024, 1, 10), datetime(2024, 1, 12, 6))


@query(f"""SELECT s_suppkey AS entity_id, {_NOW} AS "timestamp", {_NOW} AS created, 3 AS job_id, CAST(s_acctbal AS DECIMAL(18,2)) AS value,
    s_name AS note FROM supplier""")
def batch_package_store(t):
    """A package: one timestamp for all rows, values in the order of the trend names."""
    store = S.FactStore(t.spark, scratch_path(t.spark, "facts"), _STORE_SCHEMA, "1 day")
    values = F.array(F.col("s_acctbal").cast("decimal(18,2)").cast("string"), F.col("s_name"))
    package = L.package_batch(t.supplier.select(F.col("s_suppkey").alias("entity_id"), values.alias("values")), at(NOW), ["value", "note"])
    typed = package.withColumn("value", F.col("value").cast("decimal(18,2)"))
    store.append_or_upsert(typed, at(NOW), 3)
    return store.read()


@query(f"""SELECT DISTINCT event_type AS part, {Q15} AS "timestamp", {_NOW} AS modified FROM events""")
def emit_modified(t):
    return S.emit_modified(t.records_15m, F.col("part"), at(NOW))


@query(f"""SELECT o_orderkey AS id, o_orderpriority AS action, o_orderdate AS started, CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY END AS finished FROM orders
    UNION ALL SELECT -1, 'csv-load', {_NOW}, {_NOW} + INTERVAL 1 HOUR""")
def job_lineage(t):
    jobs = t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("action"), F.col("o_orderdate").alias("started"),
        F.when(F.col("o_orderstatus") == "F", X.plus("o_orderdate", "1d")).alias("finished"),
    )
    return S.finish_job(S.start_job(jobs, -1, F.lit("csv-load"), at(NOW)), -1, X.plus(at(NOW), "1h"))


@query(f"""WITH {REC} SELECT event_id, "timestamp", part, part <> 'signup' OR "timestamp" <= TIMESTAMP '2024-01-15 00:00:00' AS stored FROM rec""")
def transfer_staged(t):
    """Sign-ups are staged; those up to 15 January are taken over."""
    records = t.records_15m.select("event_id", "timestamp", "part")
    base, staging = records.filter(F.col("part") != "signup"), records.filter(F.col("part") == "signup")
    due = S.staged_timestamps(staging).filter(F.col("timestamp") <= at("2024-01-15 00:00:00"))
    stored, left = S.transfer_staged(base, staging, due)
    return stored.withColumn("stored", F.lit(True)).unionByName(left.withColumn("stored", F.lit(False)))


@query(f"""WITH moment AS (SELECT unnest(generate_series({_NOW} - INTERVAL 6 HOUR - INTERVAL 31 DAY, {_NOW} + INTERVAL 6 HOUR + INTERVAL 3 DAY, INTERVAL 6 HOUR)) AS m)
    SELECT part, epoch_us(m) // 1000000 // 21600 AS bucket FROM moment, (SELECT DISTINCT event_type AS part FROM events)
    EXCEPT SELECT event_type, (epoch_us(ts) + 500000) // 1000000 // 21600 FROM events""")
def missing_buckets(t):
    existing = t.events.select(F.col("event_type").alias("part"), X.bucket_index("ts", "6h").alias("bucket")).distinct()
    parts = existing.select("part").distinct().select(
        "part", F.lit(21600).cast("bigint").alias("size_seconds"), F.lit(31 * 86400).cast("bigint").alias("retention_seconds")
    )
    return S.missing_buckets(parts, existing, at(NOW))


@query(f"""WITH b AS (SELECT DISTINCT event_type AS part, (epoch_us(ts) + 500000) // 1000000 // 21600 AS bucket FROM events)
    SELECT part, bucket, make_timestamp(bucket * 21600000000) AS "from", make_timestamp((bucket + 1) * 21600000000) AS "to" FROM b
    WHERE make_timestamp(bucket * 21600000000) < {_NOW} - INTERVAL 10 DAY - INTERVAL 12 HOUR""")
def retention_cleanup(t):
    buckets = t.events.select(F.col("event_type").alias("part"), X.bucket_index("ts", "6h").alias("bucket")).distinct()
    return S.expired_buckets(buckets, at(NOW), "10 days", "6h")


@query(f"""WITH {F15} SELECT *, (SELECT count(*) FROM f15 WHERE "timestamp" = TIMESTAMP '2024-01-15 12:00:00') AS removed FROM f15
    WHERE "timestamp" <> TIMESTAMP '2024-01-15 12:00:00'""")
def delete_timestamp(t):
    left, removed = S.delete_timestamp(t.fact_15m, at("2024-01-15 12:00:00"))
    return left.withColumn("removed", removed.scalar())


@query(f"""WITH {F15} SELECT *, CAST(value * 1000 AS DECIMAL(38,2)) AS milli, samples % 2 = 0 AS even FROM f15""")
def generated_columns(t):
    generated = [GeneratedTrend("milli", "numeric", "value * 1000"), GeneratedTrend("even", "boolean", "samples % 2 = 0")]
    table = V.generated_columns(t.fact_15m, generated)
    return table.withColumn("milli", F.col("milli").cast("decimal(38,2)"))


@query("""SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN user_id + 5 END AS total, CASE WHEN event_id % 7 <> 0 THEN 3 END AS items FROM events""")
def parse_array_literal(t):
    """Cells such as ``{7,x,5}``: the middle element does not parse."""
    cell = F.concat(F.lit("{"), F.col("user_id").cast("string"), F.lit(",x,5}"))
    cells = t.events.select("event_id", F.when(F.col("event_id") % 7 == 0, "none").otherwise(cell).alias("cell"))
    parsed = cells.select("event_id", A.parse_array_literal("cell", "int").alias("a"))
    return parsed.select(
        "event_id", A.array_sum("a", "bigint").alias("total"), F.when(F.col("a").isNotNull(), F.size("a")).alias("items")
    )


_SPAN = f"""all_rows AS (SELECT user_id, ts AS "timestamp", event_id, event_type, CAST(value AS DECIMAL(18,2)) AS value FROM events),
    power AS (SELECT 'power' AS part, 'user ' || user_id AS name, "timestamp", CASE WHEN event_type = 'signup' THEN value + 1 ELSE value END AS value,
        CAST(NULL AS BIGINT) AS event_id, event_type = 'purchase' AS late, event_type IN ('signup', 'purchase') AS twice FROM all_rows),
    counts AS (SELECT 'counts', 'user ' || user_id, "timestamp", value, event_id, false, false FROM all_rows WHERE event_type <> 'purchase')"""


def _loaded(t) -> Loader:
    """A file with all trends of two parts; then one that has sign-ups again and the purchases, with one part's trend only."""
    folder = scratch_path(t.spark, "load")
    parts = [
        TrendStorePart("power", "15m", [Trend("value", "numeric"), Trend("voltage", "numeric")]),
        TrendStorePart("counts", "15m", [Trend("event_id", "bigint"), Trend("reading", "numeric")]),
    ]
    audit = "entity_id bigint, timestamp timestamp_ntz, created timestamp_ntz, job_id bigint"
    stores = {
        "power": S.FactStore(t.spark, f"{folder}/power", f"{audit}, value decimal(38,18), voltage decimal(38,18)", "5 days"),
        "counts": S.FactStore(t.spark, f"{folder}/counts", f"{audit}, event_id bigint, reading decimal(38,18)", "5 days"),
    }
    modified = S.FactStore(t.spark, f"{folder}/modified", MODIFIED, "5 days", key=("part", "timestamp"))
    loader = Loader(parts, stores, EntityStore(t.spark, f"{folder}/names", spread=8), modified, JobLog(t.spark, f"{folder}/jobs"))
    layout = L.DelimitedFormat(entity_column="node", timestamp_column="time")
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("time")
    node = F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("node")
    value = F.col("value").cast("decimal(18,2)")
    kind = F.col("event_type")
    first = t.events.filter(kind != "purchase").select(node, stamp, value.alias("value"), "event_id", value.alias("reading"), "props")
    second = t.events.filter(kind.isin("signup", "purchase")).select(node, stamp, F.when(kind == "signup", value + 1).otherwise(value).alias("value"))
    for number, rows in enumerate((first, second)):
        rows.write.csv(f"{folder}/file{number}", header=True)
        loader.load(f"{folder}/file{number}", at(f"2024-02-0{number + 1} 00:00:00"), layout)
    return loader


@query(f"""WITH {_SPAN} SELECT part, name, "timestamp", value, event_id, CASE WHEN late THEN {_NOW} + INTERVAL 1 DAY ELSE {_NOW} END AS created,
    CASE WHEN late THEN 2 ELSE 1 END AS job_id FROM (FROM power UNION ALL FROM counts)""")
def load_file_into_parts(t):
    """A known row takes the second file's value and keeps its audit columns; the other part stays as it was."""
    loader = _loaded(t)
    power = loader.stores["power"].read().withColumn("part", F.lit("power"))
    counts = loader.stores["counts"].read().withColumn("part", F.lit("counts")).withColumnRenamed("reading", "value")
    rows = power.drop("voltage").unionByName(counts, allowMissingColumns=True)
    names = loader.entities.read().select(F.col("id").alias("entity_id"), "name")
    return rows.join(names, "entity_id").select("part", "name", "timestamp", F.col("value").cast("decimal(18,2)").alias("value"), "event_id", "created", "job_id")


@query(f"""WITH {_SPAN} SELECT part, "timestamp", CASE WHEN bool_and(late) THEN {_NOW} + INTERVAL 1 DAY ELSE {_NOW} END AS "first",
    CASE WHEN bool_or(twice) THEN {_NOW} + INTERVAL 1 DAY ELSE {_NOW} END AS "last", 2 AS jobs FROM (FROM power UNION ALL FROM counts) GROUP BY 1, 2""")
def load_marks_and_jobs(t):
    """One change mark per part and timestamp, and two finished jobs."""
    loader = _loaded(t)
    finished = loader.jobs.read().agg(F.count("finished").alias("n")).scalar()
    return loader.modified.read().withColumn("jobs", finished)


@query(f"""WITH {F15} SELECT part, entity_id, "timestamp", value, CASE WHEN part = 'hours' THEN 0 ELSE removed END AS removed
    FROM f15, (SELECT count(*) AS removed FROM f15 WHERE "timestamp" = TIMESTAMP '2024-01-15 12:00:00'),
        (SELECT unnest(['quarters', 'spelled', 'hours']) AS part)
    WHERE part = 'hours' OR "timestamp" <> TIMESTAMP '2024-01-15 12:00:00'""")
def delete_timestamp_everywhere(t):
    """One timestamp goes from both parts of a quarter-hour, however that is spelled, and stays in a part of another granularity."""
    parts = [TrendStorePart(name, span, [Trend("value", "numeric")]) for name, span in (("quarters", "15m"), ("spelled", "00:15:00"), ("hours", "1h"))]
    schema = "entity_id bigint, timestamp timestamp_ntz, created timestamp_ntz, job_id bigint, value decimal(38,2)"
    stores = {part.name: S.FactStore(t.spark, scratch_path(t.spark, part.name), schema, "5 days") for part in parts}
    rows = S.stamp_job(t.fact_15m.select("entity_id", "timestamp", "value"), at(NOW), 1)
    for store in stores.values():
        store.append(rows)
    removed = S.delete_timestamp_everywhere(parts, stores, "15m", datetime(2024, 1, 15, 12))
    frames = [
        store.read().select(F.lit(name).alias("part"), "entity_id", "timestamp", "value", F.lit(removed.get(name, 0)).cast("bigint").alias("removed"))
        for name, store in stores.items()
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])
