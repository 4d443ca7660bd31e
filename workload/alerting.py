"""Threshold rules and notifications."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.functions.timeaxis import map_label
from tidegauge.operators import rules as R
from tidegauge.plans import gates as G
from tidegauge.plans.spec import SourceLink
from workload.registry import query
from workload.tables import EXC, F15, at
from workload.tracking import _H, _STAMP, _STATES, _old_modified

NOW = "2024-02-01 00:00:00"
_NOW = f"TIMESTAMP '{NOW}'"

HIGH_VALUE = R.Rule(
    id=1,
    name="high-value",
    thresholds={"max_value": ("decimal(18,2)", "100")},
    condition="value > max_value",
    weight="least(900, 100 + 50 * floor((value - max_value) / 20))",
    message="concat('value ', value, ' is ', value - max_value, ' above its limit of ', max_value)",
    data="to_json(named_struct('limit', max_value, 'excess', value - max_value))",
    default_interval="10 days",
)

_WITH = f"""{F15}, {EXC}, thr AS (
    SELECT f15.entity_id, f15."timestamp", value, samples, coalesce(exc.max_value, CAST(100 AS DECIMAL(18,2))) AS max_value FROM f15
    LEFT JOIN exc ON exc.entity_id = f15.entity_id AND exc."start" <= f15."timestamp" AND exc.expires > f15."timestamp")"""
_WEIGHT = "CAST(least(900, 100 + 50 * floor((value - max_value) / 20)) AS INTEGER)"
# Weight exceptions: every fifteenth entity, in the middle of the month.
_PREVIEW = f"""{_WITH}, wexc AS (SELECT c_custkey AS entity_id, TIMESTAMP '2024-01-12 00:00:00' AS "start", TIMESTAMP '2024-01-25 00:00:00' AS expires,
        42 AS weight FROM customer WHERE c_custkey % 15 = 0),
    prev AS (SELECT n.entity_id, n."timestamp", coalesce(wexc.weight, {_WEIGHT}) AS weight,
        'value ' || value || ' is ' || (value - max_value) || ' above its limit of ' || max_value AS details,
        '{{"limit":' || max_value || ',"excess":' || (value - max_value) || '}}' AS data
    FROM thr n LEFT JOIN wexc ON wexc.entity_id = n.entity_id AND wexc."start" <= n."timestamp" AND wexc.expires > n."timestamp"
    WHERE value > max_value)"""


def weight_exceptions(t):
    return t.customer.filter(F.col("c_custkey") % 15 == 0).select(
        F.col("c_custkey").alias("entity_id"), at("2024-01-12 00:00:00").alias("start"),
        at("2024-01-25 00:00:00").alias("expires"), F.lit(42).alias("weight"),
    )


def preview(t):
    return HIGH_VALUE.evaluate(t.fact_15m, t.exceptions, weight_exceptions(t))


@query(f"WITH {_WITH} SELECT * FROM thr")
def with_thresholds(t):
    return HIGH_VALUE.with_thresholds(t.fact_15m, t.exceptions)


@query(f"""WITH {F15} SELECT * FROM f15 WHERE value > 100""")
def no_thresholds(t):
    rule = R.Rule(id=2, name="plain", condition="value > 100")
    return rule.matches(t.fact_15m)


@query(f"WITH {_WITH} SELECT * FROM thr WHERE value > max_value")
def rule_condition(t):
    return HIGH_VALUE.matches(t.fact_15m, t.exceptions)


@query(f"""WITH {_WITH} SELECT entity_id, "timestamp", {_WEIGHT} AS weight FROM thr WHERE value > max_value""")
def rule_weight(t):
    return HIGH_VALUE.evaluate(t.fact_15m, t.exceptions).select("entity_id", "timestamp", "weight")


@query(f"""WITH {_PREVIEW} SELECT entity_id, "timestamp", weight FROM prev""")
def weight_exception(t):
    return preview(t).select("entity_id", "timestamp", "weight")


@query(f"WITH {_PREVIEW} SELECT * FROM prev")
def preview_notifications(t):
    return preview(t)


@query(f"""WITH {_PREVIEW} SELECT * FROM prev WHERE "timestamp" = TIMESTAMP '2024-01-09 22:30:00'""")
def evaluate_at(t):
    return HIGH_VALUE.evaluate_at(t.fact_15m, at("2024-01-09 22:30:00"), t.exceptions, weight_exceptions(t))


_STORED = """stored AS (SELECT entity_id, "timestamp", 1 AS rule_id FROM prev WHERE "timestamp" <= TIMESTAMP '2024-01-08 00:00:00')"""


def _stored(t):
    """Notifications of the first week exist already."""
    early = preview(t).filter(F.col("timestamp") <= at("2024-01-08 00:00:00"))
    return early.select("entity_id", "timestamp", F.lit(1).alias("rule_id"))


@query(f"""WITH {_PREVIEW}, {_STORED} SELECT entity_id, "timestamp", 1 AS rule_id, {_NOW} AS created, weight, details, data FROM prev
    ANTI JOIN stored USING (entity_id, "timestamp")""")
def create_notifications(t):
    return R.create_notifications(HIGH_VALUE, preview(t), _stored(t), at(NOW))


@query(f"""WITH {_PREVIEW}, {_STORED} SELECT entity_id, "timestamp", 1 AS rule_id, weight, details, data FROM
    (SELECT * FROM prev UNION ALL SELECT entity_id, "timestamp", weight, details || '!', data FROM prev UNION ALL SELECT entity_id, "timestamp", weight - 1, 'z', 'z' FROM prev)
    ANTI JOIN stored USING (entity_id, "timestamp")
    QUALIFY row_number() OVER (PARTITION BY entity_id, "timestamp" ORDER BY weight DESC, details DESC, data DESC) = 1""")
def dedupe_notifications(t):
    """The batch holds every notification three times; the largest by weight, then details, is kept whole."""
    once = preview(t).withColumn("rule_id", F.lit(1))
    longer = once.withColumn("details", F.concat("details", F.lit("!")))
    weaker = once.withColumns({"weight": F.col("weight") - 1, "details": F.lit("z"), "data": F.lit("z")})
    return R.new_notifications(once.unionByName(longer).unionByName(weaker), _stored(t), dedupe_batch=True)


@query(f"""WITH {_WITH} SELECT entity_id, "timestamp", CASE WHEN value > 250 THEN NULL ELSE 300 END AS weight,
    value <= 250 AS accepted FROM thr WHERE value > max_value""")
def reject_null_weight(t):
    rule = R.Rule(**{**HIGH_VALUE.__dict__, "weight": "CASE WHEN value > 250 THEN NULL ELSE 300 END"})
    kept, rejected = R.split_null_weights(rule.evaluate(t.fact_15m, t.exceptions))
    columns = ["entity_id", "timestamp", "weight"]
    return kept.select(*columns, F.lit(True).alias("accepted")).unionByName(
        rejected.select(*columns, F.lit(False).alias("accepted"))
    )


@query(f"""WITH {_PREVIEW} SELECT entity_id, "timestamp", 1 AS rule_id, {_NOW} AS created, weight, details FROM prev
    WHERE "timestamp" > {_NOW} - INTERVAL 10 DAY""")
def notifications_interval(t):
    return R.create_interval_notifications(HIGH_VALUE, preview(t), _stored(t), at(NOW))


@query(f"""WITH {EXC}, change AS (SELECT c_custkey AS entity_id, CAST(c_acctbal AS DECIMAL(18,2)) AS max_value FROM customer WHERE c_mktsegment = 'BUILDING')
    SELECT entity_id, CASE WHEN c.entity_id IS NOT NULL THEN TIMESTAMP '2024-01-15 00:00:00' ELSE e."start" END AS "start",
        CASE WHEN c.entity_id IS NOT NULL THEN TIMESTAMP '2024-01-16 00:00:00' ELSE e.expires END AS expires,
        CASE WHEN c.entity_id IS NOT NULL THEN c.max_value ELSE e.max_value END AS max_value
    FROM exc e FULL JOIN change c USING (entity_id)""")
def exception_upsert(t):
    changes = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("entity_id"), at("2024-01-15 00:00:00").alias("start"),
        at("2024-01-16 00:00:00").alias("expires"), F.col("c_acctbal").cast("decimal(18,2)").alias("max_value"),
    )
    return R.change_exceptions(t.exceptions, changes, ["max_value"])


@query(f"""WITH {EXC} SELECT DISTINCT c_custkey AS entity_id, coalesce("start", {_NOW}) AS "start",
    coalesce(expires, TIMESTAMP '2024-05-01 00:00:00') AS expires, max_value
    FROM customer LEFT JOIN exc ON entity_id = c_custkey WHERE c_mktsegment = 'BUILDING'""")
def exception_get_or_create(t):
    wanted = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("entity_id"))
    return R.get_or_create_exceptions(t.exceptions, wanted, at(NOW), ["max_value"])


@query(f"""WITH {F15} SELECT *, CAST(250 AS DECIMAL(18,2)) AS max_value FROM f15 WHERE value > 250""")
def set_thresholds(t):
    return HIGH_VALUE.with_values(max_value="250").matches(t.fact_15m)


@query("""SELECT o_custkey AS set_id, count(*) AS notifications, min(o_orderdate) AS first_timestamp, max(o_orderdate) AS last_timestamp,
    max(CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) AS max_weight FROM orders GROUP BY 1""")
def notification_sets(t):
    """Orders as notifications, grouped per customer."""
    notifications = t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("timestamp"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("weight"),
    )
    links = t.orders.select(F.col("o_orderkey").alias("notification_id"), F.col("o_custkey").alias("set_id"))
    return R.notification_sets(notifications, links)


@query("""SELECT p_partkey AS id, p_name AS name FROM part WHERE p_brand = 'Brand#7'""")
def filter_by_tag(t):
    items = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    tags = t.part.select(F.col("p_brand").alias("name")).distinct().select(F.md5("name").alias("id"), "name")
    links = t.part.select(F.col("p_partkey").alias("item_id"), F.md5("p_brand").alias("tag_id"))
    return R.filter_by_tag(items, links, tags, "Brand#7")


@query(f"""WITH {F15} SELECT DISTINCT 'high-value' AS rule, CAST(date_trunc('hour', "timestamp" - INTERVAL 15 MINUTE) + INTERVAL 1 HOUR AS TIMESTAMP) AS "timestamp" FROM f15
    UNION ALL SELECT DISTINCT 'plain', "timestamp" FROM f15""")
def map_rule_timestamps(t):
    """An hourly and a quarter-hour rule over the same part."""
    links = t.spark.createDataFrame(
        [("high-value", "f15", "00:15:00", "1h"), ("plain", "f15", "15m", "15m")],
        "rule string, part string, source_granularity string, target_granularity string",
    )
    modified = t.fact_15m.select(F.lit("f15").alias("part"), "timestamp").distinct()
    return R.rule_timestamps_due(links, modified)


_DAY_AND_QUARTER = f"""{_STATES}, due AS (
    SELECT DISTINCT 'mixed' AS rule, {_H} AS "timestamp" FROM modified WHERE part IN ('click', 'view')
    UNION ALL SELECT 'errors', "timestamp" FROM modified WHERE part = 'error' UNION ALL SELECT 'off', "timestamp" FROM modified WHERE part = 'signup'),
    quarters AS (SELECT part, "timestamp", '{{"' || {_STAMP.format('"timestamp"')} || '":"' || {_STAMP.format('"last"')} || '"}}' AS fingerprint, "last" AS max_modified FROM modified),
    old_quarters AS (SELECT part, "timestamp", '{{"' || {_STAMP.format('"timestamp"')} || '":"' || {_STAMP.format('"last"')} || '"}}' AS fingerprint FROM old),
    filled AS (SELECT part, {_H} AS "timestamp", count(*) AS n FROM modified GROUP BY 1, 2),
    empty AS (SELECT '{{' || string_agg('"' || {_STAMP.format("q")} || '":""', ',' ORDER BY q) || '}}' AS fingerprint, "timestamp"
        FROM (SELECT DISTINCT "timestamp", "timestamp" - i * INTERVAL 15 MINUTE AS q FROM due, range(0, 4) r(i) WHERE rule = 'mixed') GROUP BY 2),
    prints AS (
    SELECT rule, due."timestamp", greatest(c.max_modified, v.max_modified) AS max_modified,
        '{{"click":' || coalesce(c.fingerprint, empty.fingerprint) || ',"view":' || coalesce(v.fingerprint, empty.fingerprint) || '}}' AS fingerprint,
        coalesce(fc.n, 0) = 4 AND coalesce(fv.n, 0) = 4 AS complete
    FROM due LEFT JOIN (FROM neww WHERE part = 'click') c USING ("timestamp") LEFT JOIN (FROM neww WHERE part = 'view') v USING ("timestamp")
    LEFT JOIN (FROM filled WHERE part = 'click') fc USING ("timestamp") LEFT JOIN (FROM filled WHERE part = 'view') fv USING ("timestamp")
    JOIN empty USING ("timestamp") WHERE rule = 'mixed'
    UNION ALL SELECT rule, "timestamp", max_modified, fingerprint, true FROM due JOIN quarters q USING ("timestamp")
        WHERE (rule = 'errors' AND part = 'error') OR (rule = 'off' AND part = 'signup')),
    before AS (
    SELECT 'errors' AS rule, "timestamp", fingerprint FROM old_quarters WHERE part = 'error'
    UNION ALL SELECT 'mixed', "timestamp", '{{"click":' || c.fingerprint || ',"view":' || v.fingerprint || '}}'
        FROM (FROM oldw WHERE part = 'click') c JOIN (FROM oldw WHERE part = 'view') v USING ("timestamp")),
    gates AS (SELECT rule, "timestamp", prints.fingerprint, complete, prints.fingerprint IS DISTINCT FROM before.fingerprint AS changed,
        complete AND changed AND rule <> 'off' AS runnable FROM prints LEFT JOIN before USING (rule, "timestamp"))"""

GATED = [
    R.Rule(1, "mixed", "value > 100", granularity="1h", sources=[SourceLink("click", "15m"), SourceLink("view", "15m")]),
    R.Rule(2, "errors", "value > 100", data="to_json(named_struct('value', value))", sources=[SourceLink("error", "15m")]),
    R.Rule(3, "off", "true", runnable=False, sources=[SourceLink("signup", "15m")]),
]


def _due(t):
    return R.rule_timestamps_due(G.rule_links(t.spark, GATED), t.modified)


def _evaluated(t):
    """Fingerprints at the older changes: of ``errors`` everywhere, of ``mixed`` where both its sources had marks."""
    old = _old_modified(t)
    errors = R.rule_timestamps_due(G.rule_links(t.spark, GATED[1:2]), old)
    hours = old.filter(F.col("part").isin("click", "view")).select("part", map_label("timestamp", "15m", "1h").alias("timestamp")).distinct()
    both = hours.groupBy("timestamp").count().filter("count = 2").select(F.lit("mixed").alias("rule"), "timestamp")
    return G.rule_fingerprints(GATED, errors.unionByName(both), old)


def _gates(t):
    return G.gated(GATED, _due(t), t.modified, _evaluated(t))


@query(f"""WITH {_DAY_AND_QUARTER} SELECT rule, "timestamp", max_modified, fingerprint FROM prints""")
def rule_fingerprint(t):
    return G.rule_fingerprints(GATED, _due(t), t.modified)


@query(f"""WITH {_DAY_AND_QUARTER} SELECT rule, "timestamp", complete, changed, runnable FROM gates""")
def rule_runnable(t):
    return _gates(t).drop("fingerprint")


@query(f"""WITH {_DAY_AND_QUARTER}, {F15} SELECT entity_id, "timestamp", 1 AS weight, '' AS details, '{{"value":' || value || '}}' AS data
    FROM f15 SEMI JOIN (FROM gates WHERE runnable AND rule = 'errors') g USING ("timestamp") WHERE value > 100""")
def evaluate_due(t):
    """The rule is evaluated only where errors came in since it last was."""
    return GATED[1].evaluate_due(t.fact_15m, _gates(t).filter("runnable"))


@query(f"""WITH {_DAY_AND_QUARTER} SELECT rule, "timestamp", coalesce(g.fingerprint, b.fingerprint) AS fingerprint
    FROM before b FULL JOIN (FROM gates WHERE runnable) g USING (rule, "timestamp")""")
def mark_evaluated(t):
    return G.mark_evaluated(_evaluated(t), _gates(t).filter("runnable"))
