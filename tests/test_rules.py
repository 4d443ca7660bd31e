"""Rules, exceptions, notifications, entity sets and schema changes."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import entities as E
from tidegauge.operators import evolution as V
from tidegauge.operators import rules as R
from tidegauge.operators.joins import relation_to_virtual, salted_join
from tidegauge.plans.kpi import kpi_from_trends, parts_of
from tidegauge.plans.spec import GeneratedTrend

T0 = datetime(2024, 1, 1)
EXC = "entity_id int, start timestamp_ntz, expires timestamp_ntz, limit double"


def day(n):
    return T0 + timedelta(days=n)


RULE = R.Rule(
    id=3, name="hot", thresholds={"limit": ("double", 30.0)}, condition="celsius > limit",
    weight="CASE WHEN celsius > 3 * limit THEN 9 WHEN celsius > 2 * limit THEN 5 ELSE 1 END",
    message="concat(celsius - limit, ' degrees too hot')", data="to_json(named_struct('limit', limit))",
)


@pytest.fixture
def kpi(spark):
    data = [(1, day(0), 11.5), (1, day(1), 90.5), (2, day(1), 62.0), (3, day(1), None)]
    return spark.createDataFrame(data, "entity_id int, timestamp timestamp_ntz, celsius double")


def test_weight_takes_the_first_branch(kpi, rows):
    got = rows(RULE.evaluate(kpi))
    assert got == [
        (1, day(1), 9, "60.5 degrees too hot", '{"limit":30.0}'), (2, day(1), 5, "32.0 degrees too hot", '{"limit":30.0}'),
    ]


def test_exceptions_are_half_open_and_repeat_rows(spark, kpi, rows):
    exceptions = spark.createDataFrame(
        [(1, day(1), day(2), 95.0), (2, day(0), day(1), 95.0), (2, day(1), day(3), 44.0), (2, day(0), day(9), None)], EXC
    )
    got = rows(RULE.with_thresholds(kpi, exceptions).select("entity_id", "timestamp", "limit"))
    assert got == [
        (1, day(0), 30.0), (1, day(1), 95.0), (2, day(1), 30.0), (2, day(1), 44.0), (3, day(1), 30.0),
    ]
    with pytest.raises(Exception, match="overlapping exceptions of entity 2"):
        RULE.with_thresholds(kpi, exceptions, strict=True).collect()
    apart = exceptions.filter("expires <= timestamp_ntz'2024-01-03'")
    assert RULE.with_thresholds(kpi, apart, strict=True).count() == 4


def test_rule_switches(kpi):
    assert R.Rule(**{**RULE.__dict__, "runnable": False}).evaluate(kpi).count() == 0
    assert RULE.with_values(limit=80.0).matches(kpi).count() == 1
    with pytest.raises(ValueError):
        RULE.with_values(floor=1)


def test_notifications_are_stored_once(spark, kpi, rows, ts):
    stored = spark.createDataFrame([(1, day(1), 3), (2, day(1), 4)], "entity_id int, timestamp timestamp_ntz, rule_id int")
    evaluated = RULE.evaluate(kpi)
    created = R.create_notifications(RULE, evaluated.unionByName(evaluated), stored, ts("2024-02-01 00:00:00"))
    assert [r[0] for r in rows(created)] == [2, 2]
    single = R.create_notifications(RULE, evaluated.unionByName(evaluated), stored, ts("2024-02-01 00:00:00"), dedupe_batch=True)
    assert rows(single.select("entity_id", "weight", "rule_id")) == [(2, 5, 3)]
    late = R.create_interval_notifications(RULE, evaluated, stored.limit(0), ts("2024-01-02 12:00:00"), "12 h")
    assert late.count() == 0 and "data" not in late.columns


def test_exception_changes(spark, rows, ts):
    exceptions = spark.createDataFrame([(1, day(0), day(1), 1.0)], EXC)
    changes = spark.createDataFrame([(1, day(2), day(3), 2.0), (5, day(2), day(3), 3.0)], EXC)
    assert rows(R.change_exceptions(exceptions, changes, ["limit"])) == [(1, day(2), day(3), 2.0), (5, day(2), day(3), 3.0)]
    wanted = spark.createDataFrame([(1,), (8,)], "entity_id int")
    assert rows(R.get_or_create_exceptions(exceptions, wanted, ts("2024-01-31 00:00:00"), ["limit"])) == [
        (1, day(0), day(1), 1.0), (8, day(30), datetime(2024, 4, 30), None),
    ]


def test_guarded_sets_stay_when_a_name_is_unknown(spark, rows):
    entities = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    members = spark.createDataFrame([(1, 10), (1, 20)], "source_id int, target_id int")
    request = spark.createDataFrame([(10, "b"), (10, "c"), (20, "b"), (20, "zz")], "set_id int, name string")
    assert rows(E.invalid_members(request, entities)) == [(20, "zz")]
    assert rows(E.change_members(members, request, entities, guarded=True)) == [(1, 20), (2, 10), (3, 10)]
    assert rows(E.change_members(members, request, entities)) == [(2, 10), (2, 20), (3, 10)]
    assert rows(E.add_members(members, request, entities)) == [(1, 10), (1, 20), (2, 10), (2, 20), (3, 10)]


def test_cardinality(spark, rows):
    relation = spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "source_id int, target_id int")
    assert rows(E.relation_violations(relation, "many-to-one")) == [("source", 1, 2)]
    assert rows(E.relation_violations(relation, "one-to-many")) == [("target", 2, 2)]
    with pytest.raises(ValueError):
        E.relation_violations(relation, "many-to-many")


def test_virtual_relation_needs_one_target(spark, rows):
    nodes = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(relation_to_virtual(nodes, spark.createDataFrame([(9,)], "id int"))) == [(1, 9), (2, 9)]
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        relation_to_virtual(nodes, nodes).collect()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_is_a_join(spark, rows, how):
    facts = spark.range(500).select((F.col("id") % 7 % 3).alias("k"), F.col("id").alias("v"))
    dim = spark.createDataFrame([(0, "x"), (1, "y"), (1, "z"), (9, "n")], "k bigint, d string")
    assert rows(salted_join(facts, dim, "k", 5, how)) == rows(facts.join(dim, "k", how))


def test_kpi_skips_granularities_without_a_part(spark, rows):
    base = spark.createDataFrame([(1, day(0), 8, 3, 40)], "entity_id int, timestamp timestamp_ntz, sent int, lost int, other int")
    load = base.select("entity_id", "timestamp", F.col("other").alias("load"))
    catalog = {"main": {g: base for g in ("15m", "1h", "1d")}, "extra": {"1d": load}}
    both = kpi_from_trends(catalog, ["sent", "load"], "sent * load", "k", "integer")
    assert list(both) == ["1d"] and rows(both["1d"]) == [(1, day(0), 320)]
    single = kpi_from_trends(catalog, ["sent", "lost"], "100 * lost / sent", "loss rate", "double precision")
    assert list(single) == ["15m", "1h", "1d"] and rows(single["15m"].select("loss rate")) == [(37.5,)]
    assert parts_of(catalog, ["load", "sent", "load"]) == ["extra", "main"]
    with pytest.raises(ValueError):
        parts_of(catalog, ["jitter"])


def test_schema_changes(spark):
    df = spark.createDataFrame([(1, T0, 5, 1.5, "x")], "entity_id int, timestamp timestamp_ntz, a int, b double, c string")
    declared = {"a": "bigint", "b": "integer", "d": "numeric[]"}
    weak, report = V.apply_changes(df, declared)
    assert (report.added, report.removed, report.changed) == (["d"], ["c"], ["a"])
    assert dict(weak.dtypes)["b"] == "double" and dict(weak.dtypes)["a"] == "bigint"
    strong, report = V.apply_changes(df, declared, strong=True)
    assert report.changed == ["a", "b"] and strong.first().b == 1
    _, none = V.apply_changes(df, {"a": "integer", "b": "double precision", "c": "text"})
    assert none.lines() == ["no trends added", "no trends removed", "no trends changed"]
    assert V.add_missing_columns(df, {}, [GeneratedTrend("twice", "bigint", "a * 2")]).first().twice == 10
    with pytest.raises(ValueError):
        V.rename_column(df, "zz", "y")


def test_settings(spark, rows):
    stored = spark.createDataFrame([("a", "1")], "name string, value string")
    changed = E.put_settings(stored, spark.createDataFrame([("a", "2"), ("b", "3")], "name string, value string"))
    wanted = spark.createDataFrame([("a", "x"), ("c", "x")], "name string, default string")
    assert rows(E.get_settings(changed, wanted)) == [("a", "2"), ("c", "x")]
