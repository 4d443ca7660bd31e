"""Rollups, aggregates, projections and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.functions import arrays as A
from tidegauge.operators import aggregates as G
from tidegauge.operators import joins as J
from tidegauge.plans import kpi as K
from tidegauge.plans.spec import Trend
from tidegauge.session import cut_lineage
from workload.axis import VEC, vectors
from workload.registry import query
from workload.tables import D1, EXC, F15, HIST, MOD, TOTAL, at

_HOURLY = """h AS (SELECT entity_id, date_trunc('hour', "timestamp" - INTERVAL 15 MINUTE) + INTERVAL 1 HOUR AS "timestamp",
    count(*) AS samples, CAST(sum(value) AS DECIMAL(38,2)) AS value FROM f15 GROUP BY 1, 2)"""


def _cast(df, *columns):
    return df.withColumns({name: F.col(name).cast(TOTAL) for name in columns})


def hourly(t):
    return _cast(G.time_rollup(t.fact_15m, "15m", "1h", ["value"]), "value")


@query(f"WITH {F15}, {_HOURLY} SELECT * FROM h")
def rollup_1h(t):
    return hourly(t)


@query(f"""WITH {F15} SELECT entity_id, date_trunc('day', "timestamp" - INTERVAL 15 MINUTE) + INTERVAL 1 DAY AS "timestamp",
    count(*) AS samples, CAST(sum(value) AS DECIMAL(38,2)) AS value FROM f15 GROUP BY 1, 2""")
def rollup_1d(t):
    return _cast(G.time_rollup(t.fact_15m, "15m", "1d", ["value"]), "value")


@query(f"""WITH {D1} SELECT entity_id, CAST(date_trunc('week', "timestamp" - INTERVAL 1 DAY) + INTERVAL 7 DAY AS TIMESTAMP) AS "timestamp",
    CAST(sum(samples) AS BIGINT) AS samples, CAST(sum(quantity) AS DECIMAL(38,2)) AS quantity,
    CAST(sum(price) AS DECIMAL(38,2)) AS price FROM d1 GROUP BY 1, 2""")
def rollup_1w(t):
    return _cast(G.time_rollup(t.fact_1d, "1d", "1w", ["quantity", "price"], "samples"), "quantity", "price")


@query(f"""WITH {D1} SELECT entity_id, CAST(date_trunc('month', "timestamp" - INTERVAL 1 DAY) + INTERVAL 1 MONTH AS TIMESTAMP) AS "timestamp",
    CAST(sum(samples) AS BIGINT) AS samples, CAST(sum(quantity) AS DECIMAL(38,2)) AS quantity,
    CAST(sum(price) AS DECIMAL(38,2)) AS price FROM d1 GROUP BY 1, 2""")
def rollup_1month(t):
    return _cast(G.time_rollup(t.fact_1d, "1d", "1month", ["quantity", "price"], "samples"), "quantity", "price")


@query(f"""WITH {F15} SELECT entity_id, "timestamp", samples, value FROM (
    SELECT entity_id, count(*) AS samples, TIMESTAMP '2024-01-15 12:00:00' AS "timestamp", CAST(sum(value) AS DECIMAL(38,2)) AS value
    FROM f15 WHERE "timestamp" > TIMESTAMP '2024-01-15 11:00:00' AND "timestamp" <= TIMESTAMP '2024-01-15 12:00:00' GROUP BY 1)""")
def rollup_at_label(t):
    return _cast(G.rollup_at(t.fact_15m, at("2024-01-15 12:00:00"), "15m", "1h", ["value"]), "value")


@query(f"""WITH {F15} SELECT c_nationkey AS entity_id, "timestamp", count(*) AS samples, CAST(sum(value) AS DECIMAL(38,2)) AS value
    FROM f15 JOIN customer ON c_custkey = entity_id GROUP BY 1, 2""")
def entity_rollup(t):
    return _cast(G.entity_rollup(t.fact_15m, t.customer_nation, ["value"]), "value")


@query(f"""WITH {F15}, {_HOURLY} SELECT c_nationkey AS entity_id, "timestamp", CAST(sum(samples) AS BIGINT) AS samples,
    CAST(sum(value) AS DECIMAL(38,2)) AS value FROM h JOIN customer ON c_custkey = entity_id GROUP BY 1, 2""")
def entity_rollup_1h(t):
    return _cast(G.entity_rollup(hourly(t), t.customer_nation, ["value"], "samples"), "value")


@query(f"""WITH {D1} SELECT s_nationkey AS entity_id, "timestamp", CAST(sum(samples) AS BIGINT) AS samples,
    CAST(sum(quantity) AS DECIMAL(38,2)) AS quantity, CAST(sum(price) AS DECIMAL(38,2)) AS price
    FROM d1 JOIN supplier ON s_suppkey = entity_id GROUP BY 1, 2""")
def entity_rollup_1d(t):
    return _cast(G.entity_rollup(t.fact_1d, t.supplier_nation, ["quantity", "price"], "samples"), "quantity", "price")


@query(f"""WITH {D1} SELECT entity_id, CAST(date_trunc('month', "timestamp" - INTERVAL 1 DAY) + INTERVAL 1 MONTH AS TIMESTAMP) AS "timestamp",
    CAST(sum(samples) AS BIGINT) AS samples, CAST(sum(quantity) AS DECIMAL(38,2)) AS quantity,
    CAST(max(price) AS DECIMAL(38,2)) AS price FROM d1 GROUP BY 1, 2""")
def aggregate_by_metadata(t):
    trends = [Trend("quantity", "numeric"), Trend("price", "numeric", time_aggregation="Max")]
    return _cast(G.aggregate_by_metadata(t.fact_1d, trends, "1d", "1month", samples_from="samples"), "quantity", "price")


@query(f"""WITH {D1} SELECT s_nationkey AS entity_id, "timestamp", CAST(sum(samples) AS BIGINT) AS samples, CAST(min(quantity) AS DECIMAL(38,2)) AS quantity,
    CAST(sum(price) AS DECIMAL(38,2)) AS price FROM d1 JOIN supplier ON s_suppkey = entity_id GROUP BY 1, 2""")
def aggregate_by_metadata_relation(t):
    """Over entities, each column by its own entity aggregation."""
    trends = [Trend("quantity", "numeric", entity_aggregation="MIN"), Trend("price", "numeric")]
    rolled = G.aggregate_by_metadata(t.fact_1d, trends, "1d", relation=t.supplier_nation, samples_from="samples")
    return _cast(rolled, "quantity", "price")


@query(f"""WITH {VEC}, item AS (SELECT label, unnest(arr) AS x, unnest(range(1, len(arr) + 1)) AS pos FROM vec)
    SELECT label, string_agg(CAST(total AS VARCHAR), ',' ORDER BY pos) AS result
    FROM (SELECT label, pos, sum(x) AS total FROM item GROUP BY 1, 2) GROUP BY 1""")
def sum_array(t):
    return G.sum_array(vectors(t), "label", "arr").select("label", A.array_to_text("arr").alias("result"))


_PRIORITY = "nullif(o_orderpriority, '5-LOW')"


@query(f"""SELECT o_custkey, arg_min(p, o_orderkey) FILTER (WHERE p IS NOT NULL) AS first_priority
    FROM (SELECT *, {_PRIORITY} AS p FROM orders) GROUP BY 1""")
def first_value(t):
    priority = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    return t.orders.groupBy("o_custkey").agg(G.first_value(priority, "o_orderkey").alias("first_priority"))


@query(f"""SELECT o_custkey, arg_max(p, o_orderkey) FILTER (WHERE p IS NOT NULL) AS last_priority
    FROM (SELECT *, {_PRIORITY} AS p FROM orders) GROUP BY 1""")
def last_value(t):
    priority = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    return t.orders.groupBy("o_custkey").agg(G.last_value(priority, "o_orderkey").alias("last_priority"))


@query(f"""WITH {F15} SELECT CAST("timestamp" AS DATE) AS date, max(value) AS max_value FROM f15 GROUP BY 1""")
def daily_max_report(t):
    return G.daily_max_report(t.fact_15m, "value")


@query("""WITH l AS (SELECT CAST(l_quantity AS DECIMAL(18,2)) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem)
    SELECT 'quantity' AS trend, CAST(min(quantity) AS VARCHAR) AS min_value, CAST(max(quantity) AS VARCHAR) AS max_value FROM l
    UNION ALL SELECT 'price', CAST(min(price) AS VARCHAR), CAST(max(price) AS VARCHAR) FROM l""")
def analyze_part(t):
    rows = t.lineitem.select(
        F.col("l_quantity").cast("decimal(18,2)").alias("quantity"), F.col("l_extendedprice").cast("decimal(18,2)").alias("price")
    )
    return G.analyze_part(rows, ["quantity", "price"])


@query(f"""WITH {F15} SELECT 'events_15m' AS part, "timestamp", count(*) AS count FROM f15 GROUP BY 2""")
def part_stats(t):
    return G.part_stats(t.fact_15m, "events_15m")


@query(f"""WITH {F15}, s AS (SELECT "timestamp", count(*) AS n FROM f15 GROUP BY 1),
    g AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-02-01 00:00:00', INTERVAL 15 MINUTE)) AS "timestamp")
    SELECT g."timestamp", coalesce(n, 0) AS count FROM g LEFT JOIN s ON s."timestamp" = g."timestamp" """)
def completeness(t):
    stats = G.part_stats(t.fact_15m, "events_15m")
    return G.completeness(stats, "15m", at("2024-01-01 00:07:00"), at("2024-02-01 00:00:00"))


@query(f"""WITH {MOD} SELECT max("last") AS max_modified FROM modified WHERE part = 'click' AND "timestamp" < TIMESTAMP '2024-01-15 00:00:00'""")
def max_modified(t):
    return G.max_modified(t.modified, "click", at("2024-01-15 00:00:00"))


@query("""SELECT o_orderpriority AS materialization, count(*) AS execution_count,
    CAST(sum(o_orderkey % 3600) * 1000000 AS BIGINT) AS total_duration_us FROM orders GROUP BY 1""")
def execution_metrics(t):
    length = F.make_dt_interval(secs=F.col("o_orderkey") % 3600)
    jobs = t.orders.select(
        F.col("o_orderpriority").alias("materialization"), F.col("o_orderdate").alias("started"),
        (F.col("o_orderdate") + length).alias("finished"),
    )
    return G.execution_metrics(jobs)


@query(f"""WITH {F15} SELECT "timestamp", entity_id, CAST(value - 2 * samples AS DECIMAL(38,2)) AS net_value FROM f15""")
def kpi_projection(t):
    return _cast(K.project_kpi(t.fact_15m, "value - 2 * samples", "net_value"), "net_value")


@query(f"""WITH {F15} SELECT "timestamp", entity_id, CAST(value - 2 * samples AS DECIMAL(38,2)) AS net_value FROM f15
    WHERE "timestamp" = TIMESTAMP '2024-01-15 12:00:00'""")
def kpi_at_timestamp(t):
    kpi = K.project_kpi(t.fact_15m, "value - 2 * samples", "net_value")
    return _cast(J.at_timestamp(kpi, at("2024-01-15 12:00:00")), "net_value")


def _catalog(daily):
    """Quantity and price as two parts, each at 1d, 1w and 1month."""
    parts = {}
    for trend in ("quantity", "price"):
        base = daily.select("entity_id", "timestamp", trend, "samples")
        rolled = {target: _cast(G.time_rollup(base, "1d", target, [trend], "samples"), trend) for target in ("1w", "1month")}
        parts[trend + "_part"] = {"1d": base, **rolled}
    return parts


@query(f"""WITH {D1} SELECT entity_id, "timestamp", CAST(price - quantity AS DECIMAL(38,2)) AS margin FROM d1""")
def kpi_from_trends(t):
    kpis = K.kpi_from_trends(_catalog(t.fact_1d), ["price", "quantity"], "price - quantity", "margin", granularities=["1d"])
    return _cast(kpis["1d"], "margin")


@query(f"""WITH {D1}, g AS (
    SELECT '1d' AS granularity, entity_id, "timestamp", price, quantity FROM d1
    UNION ALL SELECT '1w', entity_id, CAST(date_trunc('week', "timestamp" - INTERVAL 1 DAY) + INTERVAL 7 DAY AS TIMESTAMP), price, quantity FROM d1
    UNION ALL SELECT '1month', entity_id, CAST(date_trunc('month', "timestamp" - INTERVAL 1 DAY) + INTERVAL 1 MONTH AS TIMESTAMP), price, quantity FROM d1)
    SELECT granularity, entity_id, "timestamp", CAST(sum(price) - sum(quantity) AS DECIMAL(38,2)) AS margin FROM g GROUP BY 1, 2, 3""")
def kpi_multi_granularity(t):
    """Two parts of one table at three granularities: one scan, one shuffle."""
    daily = t.fact_1d
    parts = {"quantity_part": daily, "price_part": daily}
    kpi = K.kpi_at_granularities(parts, "1d", ["1d", "1w", "1month"], {"price": "SUM", "quantity": "SUM"}, "price - quantity", "margin")
    return _cast(kpi, "margin")


@query(f"""WITH {D1}, g AS (
    SELECT '1d' AS granularity, entity_id, "timestamp", price, quantity FROM d1
    UNION ALL SELECT '1w', entity_id, CAST(date_trunc('week', "timestamp" - INTERVAL 1 DAY) + INTERVAL 7 DAY AS TIMESTAMP), price, quantity FROM d1
    UNION ALL SELECT '1month', entity_id, CAST(date_trunc('month', "timestamp" - INTERVAL 1 DAY) + INTERVAL 1 MONTH AS TIMESTAMP), price, quantity FROM d1)
    SELECT granularity, entity_id, "timestamp", CAST(sum(price) - sum(quantity) AS DECIMAL(38,2)) AS margin FROM g GROUP BY 1, 2, 3""")
def kpi_aggregated_parts(t):
    """The same from granularities of each part, with a definition made of aggregates.

    Six parts are made of the daily records, so these are stored once, those of an entity together: its rollups then combine map-side.
    """
    daily = cut_lineage(t.fact_1d.repartition("entity_id"))
    kpis = K.kpi_from_trends(_catalog(daily), ["price", "quantity"], "sum(price) - sum(quantity)", "margin", aggregated=True)
    frames = [df.select(F.lit(granularity).alias("granularity"), "*") for granularity, df in kpis.items()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return _cast(result, "margin")


@query(f"""WITH {D1} SELECT "timestamp", entity_id, price AS first_value, quantity AS second_value FROM d1
    JOIN supplier ON s_suppkey = entity_id WHERE "timestamp" = TIMESTAMP '1998-06-02 00:00:00'""")
def dynamic_trend_data(t):
    parts = {name: grans["1d"] for name, grans in _catalog(t.fact_1d).items()}
    data = J.dynamic_trend_data(parts, t.suppliers, at("1998-06-02 00:00:00"), ["price", "quantity"])
    return data.select(
        "timestamp", "entity_id", F.col("data")[0].cast(TOTAL).alias("first_value"), F.col("data")[1].cast(TOTAL).alias("second_value")
    )


@query("""SELECT TIMESTAMP '1998-06-02 00:00:00' AS "timestamp", s_suppkey AS entity_id, 0 AS items FROM supplier""")
def dynamic_trend_data_empty(t):
    parts = {name: grans["1d"] for name, grans in _catalog(t.fact_1d).items()}
    data = J.dynamic_trend_data(parts, t.suppliers, at("1998-06-02 00:00:00"), [])
    return data.select("timestamp", "entity_id", F.size("data").alias("items"))


@query(f"""WITH {D1} SELECT entity_id, "timestamp", quantity, price, samples, s_name AS name FROM d1 JOIN supplier ON s_suppkey = entity_id""")
def entity_name_join(t):
    return J.entity_name_join(t.fact_1d, t.suppliers)


@query(f"""WITH {D1} SELECT entity_id, "timestamp", quantity, price, samples, s_nationkey AS target_id FROM d1 JOIN supplier ON s_suppkey = entity_id""")
def relation_join(t):
    return J.relation_join(t.fact_1d, t.supplier_nation)


@query(f"""WITH {D1} SELECT entity_id, "timestamp", quantity, price, samples, s_nationkey AS target_id FROM d1 JOIN supplier ON s_suppkey = entity_id""")
def salted_join(t):
    """The same with every supplier spread over eight tasks."""
    relation = t.supplier_nation.select(F.col("source_id").alias("entity_id"), "target_id")
    return J.salted_join(t.fact_1d, relation, "entity_id", salts=8)


@query("""SELECT s_suppkey AS source_id, (SELECT max(s_suppkey) + 1 FROM supplier) AS target_id FROM supplier""")
def relation_cross(t):
    network = t.supplier.agg((F.max("s_suppkey") + 1).alias("id"))
    return J.relation_to_virtual(t.suppliers, network)


@query(f"""WITH {F15}, {EXC} SELECT f15.entity_id, f15."timestamp", value, samples, exc.max_value AS exc_max_value FROM f15
    LEFT JOIN exc ON exc.entity_id = f15.entity_id AND exc."start" <= f15."timestamp" AND exc.expires > f15."timestamp" """)
def exception_join(t):
    return J.exception_join(t.fact_15m, t.exceptions, ["max_value"])


@query(f"""WITH {F15}, {EXC} SELECT f15.entity_id, f15."timestamp", value, samples, exc.max_value AS exc_max_value FROM f15
    LEFT JOIN exc ON exc.entity_id = f15.entity_id AND exc."start" <= f15."timestamp" AND exc.expires > f15."timestamp" """)
def exception_join_sliced(t):
    """The same with time slices as part of the join key."""
    return J.exception_join(t.fact_15m, t.exceptions, ["max_value"], slice_width="1 day")


@query(f"""WITH {HIST} SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY "timestamp" DESC) AS rn
    FROM hist WHERE "timestamp" <= TIMESTAMP '2024-01-15 00:00:00') WHERE rn = 1""")
def attribute_at(t):
    return J.as_of_latest(t.history, at("2024-01-15 00:00:00"))


@query(f"""WITH {F15}, {HIST} SELECT f15.entity_id, f15."timestamp", value, samples, event_type, id FROM f15
    ASOF LEFT JOIN hist ON hist.entity_id = f15.entity_id AND f15."timestamp" >= hist."timestamp" """)
def attribute_as_of_join(t):
    return J.as_of_join(t.fact_15m, t.history, ["event_type", "id"])


@query(f"""WITH {F15}, {HIST} SELECT f15.entity_id, f15."timestamp", value, samples, event_type, id FROM f15
    ASOF LEFT JOIN hist ON hist.entity_id = f15.entity_id AND f15."timestamp" >= hist."timestamp" """)
def attribute_as_of_join_sliced(t):
    """The same with the rows of every entity cut into time slices."""
    return J.as_of_join(t.fact_15m, t.history, ["event_type", "id"], width="6 hours")


@query("""SELECT name, count(*) AS uses FROM (SELECT DISTINCT c_nationkey AS name, 'customer' AS origin FROM customer
    UNION ALL SELECT DISTINCT s_nationkey, 'supplier' FROM supplier UNION ALL SELECT n_nationkey, 'nation' FROM nation) GROUP BY 1""")
def union_ops(t):
    def of(df, column, origin):
        return df.select(F.col(column).alias("name"), F.lit(origin).alias("origin")).distinct()

    named = of(t.customer, "c_nationkey", "customer").unionByName(of(t.supplier, "s_nationkey", "supplier")).unionByName(
        of(t.nation, "n_nationkey", "nation")
    )
    return named.groupBy("name").agg(F.count(F.lit(1)).alias("uses"))
