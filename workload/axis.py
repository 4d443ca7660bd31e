"""Time axis, scalar and array functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.functions import arrays as A
from tidegauge.functions import timeaxis as X
from tidegauge.functions import types as Y
from tidegauge.functions.fingerprints import attribute_hash as hash_of
from tidegauge.operators.aggregates import max_data_type as widest
from workload.registry import query
from workload.tables import Q15


@query(f"""SELECT event_id, date_trunc('hour', {Q15} - INTERVAL 15 MINUTE) + INTERVAL 1 HOUR AS label FROM events""")
def map_label_1h(t):
    ts = X.ceil_to_granularity("ts", "15m")
    return t.events.select("event_id", X.map_label(ts, "15m", "1h").alias("label"))


@query(f"""SELECT event_id, date_trunc('day', {Q15} - INTERVAL 15 MINUTE) + INTERVAL 1 DAY AS label FROM events""")
def map_label_1d(t):
    ts = X.ceil_to_granularity("ts", "15m")
    return t.events.select("event_id", X.map_label(ts, "15m", "1d").alias("label"))


_HALF = "make_timestamp(CAST(ceil(epoch_us(ts) / 1.8e9) AS BIGINT) * 1800000000)"


@query(f"""SELECT event_id, date_trunc('hour', {_HALF} - INTERVAL 30 MINUTE) + INTERVAL 1 HOUR AS hour,
    date_trunc('day', {_HALF} - INTERVAL 30 MINUTE) + INTERVAL 1 DAY AS day FROM events""")
def map_label_from_30m(t):
    ts = X.ceil_to_granularity("ts", "30m")
    return t.events.select("event_id", X.map_label(ts, "30m", "1h").alias("hour"), X.map_label(ts, "30m", "1d").alias("day"))


@query("""SELECT o_orderkey, o_orderdate + INTERVAL 90 MINUTE AS spelled, o_orderdate + INTERVAL 1 MONTH AS month, o_orderdate + INTERVAL 93600 SECOND AS terms,
    o_orderdate - INTERVAL 14 DAY AS back FROM orders""")
def parse_interval(t):
    """Clock times, short and long words, and several terms."""
    return t.orders.select(
        "o_orderkey", X.plus("o_orderdate", "01:30:00").alias("spelled"), X.plus("o_orderdate", "1 month").alias("month"),
        X.plus("o_orderdate", "1 day 2h").alias("terms"), X.minus("o_orderdate", "2 weeks").alias("back"),
    )


@query("""SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN user_id % 24 * 3600 + event_id % 60 * 60 + event_id % 7 END AS seconds FROM events""")
def interval_seconds(t):
    """A column of clock texts; every fifth has another form."""
    cells = [F.lpad((F.col(name) % span).cast("string"), 2, "0") for name, span in (("user_id", 24), ("event_id", 60), ("event_id", 7))]
    text = F.when(F.col("event_id") % 5 == 0, F.lit("1 day")).otherwise(F.concat_ws(":", *cells))
    return t.events.select("event_id", X.interval_seconds(text).alias("seconds"))


@query("""SELECT event_id, CAST(NULL AS TIMESTAMP) AS moment FROM events""")
def smallint_to_timestamp(t):
    """A numeric column declared a timestamp keeps no value."""
    return t.events.select("event_id", A.null_timestamp().alias("moment"))


@query("""SELECT o_orderkey, CAST('123456789012345678901234' || o_orderkey AS DECIMAL(38,0)) AS long, CAST('0.1234567890123456789' || o_orderkey % 10 AS DECIMAL(30,20)) AS fine,
    CASE WHEN o_orderkey < 100000 THEN CAST(o_orderkey AS DECIMAL(5,0)) END AS small FROM orders""")
def parse_declared_numeric(t):
    """Precision and scale as declared: more whole and more decimal digits than plain numeric has, and fewer."""
    key = F.col("o_orderkey").cast("string")
    return t.orders.select(
        "o_orderkey", Y.parse_strict(F.concat(F.lit("123456789012345678901234"), key), "numeric(38)").alias("long"),
        Y.parse_strict(F.concat(F.lit("0.1234567890123456789"), (F.col("o_orderkey") % 10).cast("string")), "numeric(30, 20)").alias("fine"),
        Y.parse_lenient(key, "numeric(5,0)").alias("small"),
    )


@query("""SELECT o_orderkey, CAST(date_trunc('week', o_orderdate - INTERVAL 1 DAY) + INTERVAL 7 DAY AS TIMESTAMP) AS label FROM orders""")
def map_label_1w(t):
    return t.orders.select("o_orderkey", X.map_label("o_orderdate", "1d", "1w").alias("label"))


@query("""SELECT o_orderkey, CAST(date_trunc('month', o_orderdate - INTERVAL 1 DAY) + INTERVAL 1 MONTH AS TIMESTAMP) AS label FROM orders""")
def map_label_1month(t):
    return t.orders.select("o_orderkey", X.map_label("o_orderdate", "1d", "1month").alias("label"))


def _ceil(unit: str, step: str) -> str:
    floor = f"CAST(date_trunc('{unit}', ts) AS TIMESTAMP)"
    return f"CASE WHEN {floor} = ts THEN ts ELSE {floor} + INTERVAL {step} END"


@query(f"""SELECT event_id, {Q15} AS quarter, {_ceil('hour', '1 HOUR')} AS "hour", {_ceil('day', '1 DAY')} AS "day",
    {_ceil('week', '7 DAY')} AS week, {_ceil('month', '1 MONTH')} AS "month" FROM events""")
def ceil_to_granularity(t):
    grans = {"quarter": "15m", "hour": "1h", "day": "1d", "week": "1w", "month": "1month"}
    return t.events.select("event_id", *[X.ceil_to_granularity("ts", g).alias(n) for n, g in grans.items()])


@query("""SELECT event_id, make_timestamp(epoch_us(ts) // 900000000 * 900000000) AS quarter,
    CAST(date_trunc('hour', ts) AS TIMESTAMP) AS "hour", CAST(date_trunc('day', ts) AS TIMESTAMP) AS "day",
    CAST(date_trunc('week', ts) AS TIMESTAMP) AS week, CAST(date_trunc('month', ts) AS TIMESTAMP) AS "month" FROM events""")
def floor_to_granularity(t):
    grans = {"quarter": "15m", "hour": "1h", "day": "1d", "week": "1w", "month": "1month"}
    return t.events.select("event_id", *[X.floor_to_granularity("ts", g).alias(n) for n, g in grans.items()])


@query("""WITH s AS (SELECT event_id, (epoch_us(ts) + 500000) // 1000000 AS sec FROM events)
    SELECT event_id, sec // 21600 AS i6h, make_timestamp(sec // 21600 * 21600000000) AS s6h,
           sec // 86400 AS i1d, make_timestamp(sec // 86400 * 86400000000) AS s1d,
           sec // 2592000 AS i1month, make_timestamp(sec // 2592000 * 2592000000000) AS s1month,
           sec // 31557600 AS i1y, make_timestamp(sec // 31557600 * 31557600000000) AS s1y FROM s""")
def bucket_index(t):
    sizes = {"6h": "6 hours", "1d": "1 day", "1month": "1 month", "1y": "1 year"}
    numbered = t.events.select("event_id", *[X.bucket_index("ts", size).alias(f"i{n}") for n, size in sizes.items()])
    return numbered.select("*", *[X.bucket_start(f"i{n}", size).alias(f"s{n}") for n, size in sizes.items()])


@query("""WITH s AS (SELECT event_id, ts, (epoch_us(ts) + 500000) // 1000000 AS sec FROM events)
    SELECT event_id, make_timestamp(sec // 900 * 900000000) AS quarter, make_timestamp(sec // 3600 * 3600000000) AS "hour",
           CAST(date_trunc('day', ts) AS TIMESTAMP) AS "day", CAST(date_trunc('week', ts) AS TIMESTAMP) AS week FROM s""")
def truncate_for_rule(t):
    grans = {"quarter": "15m", "hour": "1h", "day": "1 day", "week": "1 week"}
    return t.events.select("event_id", *[X.truncate_for_rule("ts", g).alias(n) for n, g in grans.items()])


@query("""WITH n AS (SELECT user_id, make_timestamp((max(epoch_us(ts)) + 500000) // 1000000 // 900 * 900000000) AS newest
    FROM events GROUP BY 1)
    SELECT user_id, newest - i * INTERVAL 15 MINUTE AS "timestamp" FROM n, range(0, 97) r(i)""")
def rule_timestamps(t):
    newest = t.events.groupBy("user_id").agg(F.max("ts").alias("now"))
    return newest.select("user_id", F.explode(X.rule_timestamps("now", "15m", "1 day")).alias("timestamp"))


_GRANS = ["00:05:00", "00:15:00", "00:30:00", "01:00:00", "12:00:00", "1 day", "1 week", "1 month"]


@query(f"""WITH g AS (SELECT event_id, list_extract({_GRANS}, CAST(event_id % 8 AS INTEGER) + 1) AS granularity FROM events)
    SELECT event_id, granularity,
      CASE granularity WHEN '00:05:00' THEN '5m' WHEN '00:15:00' THEN 'qtr' WHEN '01:00:00' THEN 'hr'
        WHEN '12:00:00' THEN '12hr' WHEN '1 day' THEN 'day' WHEN '1 week' THEN 'wk' WHEN '1 month' THEN 'month'
        ELSE granularity END AS short_name,
      CASE granularity WHEN '00:05:00' THEN '3 hours' WHEN '00:15:00' THEN '6 hours' WHEN '00:30:00' THEN '6 hours'
        WHEN '01:00:00' THEN '1 day' WHEN '12:00:00' THEN '7 days' WHEN '1 day' THEN '7 days'
        WHEN '1 week' THEN '1 month' WHEN '1 month' THEN '1 year' END AS partition_size FROM g""")
def granularity_lookup(t):
    gran = F.element_at(F.array(*map(F.lit, _GRANS)), (F.col("event_id") % 8 + 1).cast("int"))
    named = t.events.select("event_id", gran.alias("granularity"))
    return named.select(
        "*", X.granularity_to_text("granularity").alias("short_name"),
        X.default_partition_size("granularity").alias("partition_size"),
    )


@query("""WITH b AS (SELECT user_id, CAST(date_trunc('hour', min(ts)) AS TIMESTAMP) AS lo, CAST(date_trunc('hour', max(ts)) AS TIMESTAMP) AS hi
    FROM events GROUP BY 1)
    SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS "timestamp" FROM b""")
def grid_series(t):
    bounds = t.events.groupBy("user_id").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    first, last = X.floor_to_granularity("lo", "1h"), X.floor_to_granularity("hi", "1h")
    return bounds.select("user_id", F.explode(X.grid(first, last, "1h")).alias("timestamp"))


@query("""SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey,
    CASE WHEN l_linenumber - 1 = 0 THEN NULL ELSE l_partkey // (l_linenumber - 1) END AS whole,
    CASE WHEN l_linenumber - 1 = 0 THEN NULL ELSE l_extendedprice / (l_linenumber - 1) END AS ratio FROM lineitem""")
def safe_division(t):
    divisor = F.col("l_linenumber") - 1
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey",
        A.safe_division("l_partkey", divisor, integral=True).alias("whole"),
        A.safe_division("l_extendedprice", divisor).alias("ratio"),
    )


@query("""SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey,
    CASE WHEN l_linenumber - 1 = 0 THEN -1 ELSE l_partkey // (l_linenumber - 1) END AS whole,
    CASE WHEN l_linenumber - 1 = 0 THEN l_extendedprice ELSE l_extendedprice / (l_linenumber - 1) END AS ratio FROM lineitem""")
def safe_division_default(t):
    divisor = F.col("l_linenumber") - 1
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey",
        A.safe_division("l_partkey", divisor, F.lit(-1), integral=True).alias("whole"),
        A.safe_division("l_extendedprice", divisor, "l_extendedprice").alias("ratio"),
    )


# Embedding elements as whole millionths, so that sums are exact.
VEC = """vec AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1e6) AS BIGINT)) AS arr
    FROM embeddings)"""


def vectors(t):
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1e6).cast("bigint"))
    return t.embeddings.select("vec_id", "label", whole.alias("arr"))


def _text(values: str) -> str:
    return f"array_to_string({values}, ',')"


@query(f"""WITH {VEC} SELECT vec_id, {_text("list_transform(range(1, 33), lambda i: arr[i] + arr[i + 32])")} AS result FROM vec""")
def add_array(t):
    tail = F.slice("arr", 33, 32)
    return vectors(t).select("vec_id", A.array_to_text(A.add_array("arr", tail)).alias("result"))


@query(f"""WITH {VEC} SELECT vec_id, {_text("list_transform(arr, lambda x: x // 7)")} AS result FROM vec""")
def divide_array_scalar(t):
    return vectors(t).select("vec_id", A.array_to_text(A.divide_array_by("arr", F.lit(7), integral=True)).alias("result"))


@query(f"""WITH {VEC} SELECT vec_id, {_text(
    "list_transform(range(1, 33), lambda i: CASE WHEN arr[i + 32] // 50000 = 0 THEN NULL ELSE arr[i] // (arr[i + 32] // 50000) END)"
    )} AS result FROM vec""")
def divide_array(t):
    tail = A.divide_array_by(F.slice("arr", 33, 32), F.lit(50000), integral=True)
    return vectors(t).select("vec_id", A.array_to_text(A.divide_array("arr", tail, integral=True)).alias("result"))


@query(f"""WITH {VEC} SELECT vec_id, CAST(list_sum(list_filter(arr, lambda x: x > 0)) AS BIGINT) AS positive,
    CAST(list_sum(list_filter(arr, lambda x: x > 100000000)) AS BIGINT) AS nothing FROM vec""")
def array_sum(t):
    gaps = F.transform("arr", lambda x: F.when(x > 0, x))
    none = F.transform("arr", lambda x: F.when(x > 100000000, x))
    return vectors(t).select("vec_id", A.array_sum(gaps, "bigint").alias("positive"), A.array_sum(none, "bigint").alias("nothing"))


@query(f"""WITH {VEC} SELECT vec_id, {_text("list_filter(arr, lambda x: x > 0)")} AS result FROM vec""")
def array_to_text(t):
    gaps = F.transform("arr", lambda x: F.when(x > 0, x))
    return vectors(t).select("vec_id", A.array_to_text(gaps).alias("result"))


@query("""WITH c AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '' ELSE
        regexp_extract(props, '[0-9]+') || ',,' || CAST(user_id AS VARCHAR) END AS cell FROM events)
    SELECT event_id, CASE WHEN cell <> '' THEN len(string_split(cell, ',')) END AS items,
        CASE WHEN cell <> '' THEN CAST(string_split(cell, ',')[1] AS INTEGER) + CAST(string_split(cell, ',')[3] AS INTEGER) END AS total
    FROM c""")
def to_pdf(t):
    digits = F.regexp_extract("props", "[0-9]+", 0)
    cell = F.when(F.col("event_id") % 7 == 0, "").otherwise(F.concat(digits, F.lit(",,"), F.col("user_id").cast("string")))
    pdf = t.events.select("event_id", A.to_pdf(cell).alias("pdf"))
    items = F.when(F.col("pdf").isNotNull(), F.size("pdf").cast("bigint"))
    return pdf.select("event_id", items.alias("items"), A.array_sum("pdf", "int").alias("total"))


@query("""SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS wrapped,
    CASE WHEN event_type = 'view' THEN NULL ELSE 1 END AS items FROM events""")
def to_array(t):
    value = F.when(F.col("event_type") != "view", F.col("user_id").cast("int"))
    wrapped = t.events.select("event_id", A.to_array(value).alias("a"))
    return wrapped.select(
        "event_id", A.array_to_text("a").alias("wrapped"), F.when(F.col("a").isNotNull(), F.size("a")).alias("items")
    )


@query("""SELECT event_id, regexp_full_match(CAST(user_id AS VARCHAR), '[1-9][0-9]*') AS id_is_integer,
    regexp_full_match(props, '[1-9][0-9]*') AS props_is_integer FROM events""")
def is_integer(t):
    return t.events.select(
        "event_id", Y.is_integer(F.col("user_id").cast("string")).alias("id_is_integer"),
        Y.is_integer("props").alias("props_is_integer"),
    )


_TYPES = list(Y.TYPE_ORDER)
_TYPED = f"""typed AS (SELECT event_id, user_id, CAST(user_id % 12 AS INTEGER) + 1 AS i, CAST(event_id % 12 AS INTEGER) + 1 AS j,
    {_TYPES} AS names FROM events)"""


def _typed(t):
    names = F.array(*map(F.lit, _TYPES))
    return t.events.select(
        "event_id", "user_id", F.element_at(names, (F.col("user_id") % 12 + 1).cast("int")).alias("a"),
        F.element_at(names, (F.col("event_id") % 12 + 1).cast("int")).alias("b"),
    )


@query(f"""WITH {_TYPED} SELECT event_id, names[i] AS a, names[j] AS b, i AS rank_a, names[greatest(i, j)] AS widest FROM typed""")
def greatest_data_type(t):
    return _typed(t).select(
        "event_id", "a", "b", Y.data_type_order("a").alias("rank_a"), Y.greatest_data_type("a", "b").alias("widest")
    )


@query(f"""WITH {_TYPED} SELECT user_id, names[max(j)] AS widest FROM typed GROUP BY user_id, names""")
def max_data_type(t):
    return _typed(t).groupBy("user_id").agg(widest("b").alias("widest"))


@query("""SELECT c_custkey, md5(c_name || CAST(c_nationkey AS VARCHAR) || coalesce(nullif(c_mktsegment, 'BUILDING'), '')) AS hash FROM customer""")
def attribute_hash(t):
    rows = t.customer.withColumn("segment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    return rows.select("c_custkey", hash_of(["c_name", "c_nationkey", "segment"]).alias("hash"))
