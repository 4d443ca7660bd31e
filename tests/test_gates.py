"""Rules per timestamp, KPIs of several granularities, and plans that must not change."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.functions import types as Y
from tidegauge.operators.entities import create_sets_with_members
from tidegauge.operators.joins import as_of_latest
from tidegauge.operators.numbering import range_digits, with_dense_ids
from tidegauge.operators.rules import Rule, rule_timestamps_due
from tidegauge.plans import gates as G
from tidegauge.plans.kpi import kpi_at_granularities
from tidegauge.plans.spec import SourceLink
from tidegauge.session import TASK_BYTES, bound_tasks

T0 = datetime(2024, 1, 1)
MODIFIED = "part string, timestamp timestamp_ntz, first timestamp_ntz, last timestamp_ntz"
RULES = [
    Rule(1, "hourly", "v > 1", granularity="1h", sources=[SourceLink("a", "15m"), SourceLink("b", "1h")]),
    Rule(2, "off", "true", runnable=False, sources=[SourceLink("a", "15m")]),
]


def quarter(n):
    return T0 + timedelta(minutes=15 * n)


def marks(spark, *rows):
    return spark.createDataFrame([(part, quarter(n), T0, quarter(last)) for part, n, last in rows], MODIFIED)


def test_a_label_waits_for_all_sources_and_is_evaluated_once(spark):
    most = [("a", n, 100) for n in (1, 2, 3)] + [("b", 4, 100)]
    modified = marks(spark, *most)
    labels = rule_timestamps_due(G.rule_links(spark, RULES), modified)
    none = spark.createDataFrame([], "rule string, timestamp timestamp_ntz, fingerprint string")

    def runnable(modified, evaluated):
        return {(r.rule, r.timestamp) for r in G.gated(RULES, labels, modified, evaluated).filter("runnable").collect()}

    assert runnable(modified, none) == set()  # the fourth quarter of a is missing
    full = marks(spark, *most, ("a", 4, 101))
    assert runnable(full, none) == {("hourly", quarter(4))}
    done = G.mark_evaluated(none, G.gated(RULES, labels, full, none).filter("runnable"))
    assert runnable(full, done) == set()
    again = marks(spark, *most, ("a", 4, 102))
    assert runnable(again, done) == {("hourly", quarter(4))}
    assert G.mark_evaluated(done, G.gated(RULES, labels, again, done).filter("runnable")).count() == 1


def test_only_due_labels_are_evaluated(spark):
    kpi = spark.createDataFrame([(1, quarter(4), 5), (1, quarter(8), 5), (2, quarter(4), 0)], "entity_id int, timestamp timestamp_ntz, v int")
    labels = spark.createDataFrame([("hourly", quarter(4)), ("off", quarter(8))], "rule string, timestamp timestamp_ntz")
    assert [(r.entity_id, r.timestamp) for r in RULES[0].evaluate_due(kpi, labels).collect()] == [(1, quarter(4))]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_kpis_of_all_granularities_take_one_scan(spark, tmp_path):
    rows = [(e, T0 + timedelta(days=d), d, 2 * e) for e in (1, 2) for d in range(1, 40)]
    spark.createDataFrame(rows, "entity_id int, timestamp timestamp_ntz, x bigint, y bigint").write.parquet(str(tmp_path / "p"))
    daily = spark.read.parquet(str(tmp_path / "p"))
    trends = {"x": "SUM", "y": "MAX"}
    kpi = kpi_at_granularities({"one": daily, "two": daily}, "1d", ["1d", "1w", "1month"], trends, "x + y", "k", "bigint")
    assert plan(kpi).count("FileScan") == 1 and plan(kpi).count("Exchange") == 1
    got = {(r.granularity, r.entity_id, r.timestamp): r.k for r in kpi.collect()}
    assert got["1d", 1, T0 + timedelta(days=3)] == 5
    assert got["1w", 2, T0 + timedelta(days=7)] == sum(range(1, 8)) + 4
    assert got["1month", 1, datetime(2024, 2, 1)] == sum(range(1, 32)) + 2


def test_parts_of_one_table_are_derived_from_it_once(spark):
    from workload.catalog import QUERIES

    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = {name: spark.conf.get(name, None) for name in (initial, *TASK_BYTES)}
    try:
        kpi = QUERIES["kpi_aggregated_parts"](spark, "/root/testdata/sf0.001")
        assert not any("lineitem" in name for name in kpi.inputFiles())
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_partitions_follow_the_bytes_of_a_shuffle(spark):
    partitions, initial = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    names = (partitions, initial, *TASK_BYTES)
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        bound_tasks(spark)
        wide = spark.range(400_000).select("id", *[F.rand(seed).alias(f"v{seed}") for seed in range(4)])
        sums = wide.groupBy("id").agg(*[F.sum(f"v{seed}") for seed in range(4)])
        assert spark.conf.get(partitions) == before[partitions] and sums.rdd.getNumPartitions() > int(before[partitions])
        spark.conf.set(partitions, "2000")
        assert bound_tasks(spark).conf.get(initial) == "2000"
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_registered_queries_have_bounded_tasks(spark):
    from workload.catalog import QUERIES

    names = list(TASK_BYTES)
    before = {name: spark.conf.get(name, None) for name in (*names, "spark.sql.adaptive.coalescePartitions.initialPartitionNum")}
    try:
        spark.conf.set(names[0], "128m")
        QUERIES["kpi_multi_granularity"](spark, "/root/testdata/sf0.001")
        assert {name: spark.conf.get(name) for name in names} == TASK_BYTES
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_a_label_that_a_part_has_no_record_at_has_no_kpi(spark):
    schema = "entity_id int, timestamp timestamp_ntz"
    x = spark.createDataFrame([(1, T0, 1), (1, T0 + timedelta(days=1), 2)], f"{schema}, x bigint")
    y = spark.createDataFrame([(1, T0, 5)], f"{schema}, y bigint")
    got = kpi_at_granularities({"x": x, "y": y}, "1d", ["1d"], {"x": "SUM", "y": "SUM"}, "x * y", "k", "bigint").collect()
    assert [(r.timestamp, r.k) for r in got] == [(T0, 5)]
    with pytest.raises(ValueError, match="no part has trend 'z'"):
        kpi_at_granularities({"x": x}, "1d", ["1d"], {"z": "SUM"}, "z", "k")


def test_the_latest_row_is_found_without_sorting(spark):
    history = spark.createDataFrame([(1, quarter(1), "a"), (1, quarter(2), "b"), (None, quarter(1), "c"), (2, quarter(9), "d")], "entity_id int, timestamp timestamp_ntz, kind string")
    latest = as_of_latest(history, F.lit(quarter(5)).cast("timestamp_ntz"))
    assert "SortAggregate" not in plan(latest)
    assert sorted(r.kind for r in latest.collect()) == ["b", "c"]


def test_ids_are_the_same_for_any_number_of_ranges(spark):
    names = spark.range(500).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    numbered = [{r.name: r.id for r in with_dense_ids(names, "name", digits=digits).collect()} for digits in (1, 3, 5)]
    assert numbered[0] == numbered[1] == numbered[2] and sorted(numbered[0].values()) == list(range(1, 501))
    assert (range_digits(8), range_digits(2000), range_digits(100_000), range_digits(10**9)) == (3, 4, 5, 5)


def test_declared_precision(spark):
    assert (Y.spark_type("numeric(30,2)"), Y.spark_type("numeric(5)"), Y.spark_type("numeric(9, 3)[]")) == ("decimal(30,2)", "decimal(5,0)", "array<decimal(9,3)>")
    for wrong in ("numeric(39,2)", "numeric(3,4)", "numeric(0)", "numeric(x)"):
        with pytest.raises(ValueError, match="unsupported data type"):
            Y.spark_type(wrong)
    assert Y.wider_type("bigint", "numeric(30,2)") == "numeric(30,2)"
    row = spark.range(1).select(Y.data_type_order(F.lit("numeric(30,2)")).alias("a"), Y.data_type_order(F.lit("numeric")).alias("b")).first()
    assert row.a == row.b


def test_sets_are_created_with_all_their_members_or_not_at_all(spark, ts):
    sets = spark.createDataFrame([(7, "old", "me")], "id bigint, name string, owner string")
    entities = spark.createDataFrame([(1, "x"), (2, "y")], "id bigint, name string")
    request = [(name, "g", "node", "me", "") for name in ("old", "new", "bad", "empty")]
    requested = spark.createDataFrame(request, "name string, group string, source_entity_type string, owner string, description string")
    names = spark.createDataFrame([("me", "old", "x"), ("me", "new", "x"), ("me", "new", "y"), ("me", "new", "y"), ("me", "bad", "x"), ("me", "bad", "nobody")], "owner string, set_name string, name string")
    created, members = create_sets_with_members(sets, requested, names, entities, ts("2024-02-01 00:00:00"))
    ids = {r.name: r.id for r in created.collect()}
    assert sorted(ids) == ["empty", "new"] and sorted(ids.values()) == [8, 9]
    assert sorted((r.source_id, r.target_id) for r in members.collect()) == [(1, ids["new"]), (2, ids["new"])]
