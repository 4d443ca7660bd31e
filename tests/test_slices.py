"""Sliced windows give the plain results, also with one entity holding most rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import joins
from tidegauge.operators import slices as S
from tidegauge.operators.history import attribute_changes, attribute_compact, attribute_run_length
from tidegauge.operators.joins import as_of_join, exception_join

START = datetime(2024, 1, 1)
SCHEMA = "id bigint, entity_id bigint, timestamp timestamp_ntz, hash string, first_appearance timestamp_ntz, modified timestamp_ntz"


def skewed(spark, seed: int, count: int = 600):
    """Random history: entity 0 has two thirds of the rows, long runs and long gaps occur."""
    rng = random.Random(seed)
    seen, data = set(), []
    state: dict[int, str] = {}
    for number in range(count):
        entity = 0 if rng.random() < 0.66 else rng.randrange(1, 12)
        when = START + timedelta(minutes=rng.choice([rng.randrange(0, 300), rng.randrange(0, 60 * 24 * 20)]))
        if (entity, when) in seen:
            continue
        seen.add((entity, when))
        state[entity] = rng.choice([state.get(entity, "a")] * 3 + ["a", "b", None])
        data.append((number, entity, when, state[entity], when, when))
    return spark.createDataFrame(data, SCHEMA), data


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("width", ["10 m", "7 h", "30 days"])
def test_runs_and_changes(spark, rows, seed, width):
    history, _ = skewed(spark, seed)
    assert rows(attribute_run_length(history, width=width)) == rows(attribute_run_length(history, width=None))
    assert rows(attribute_changes(history, width=width)) == rows(attribute_changes(history, width=None))


def test_runs_against_a_loop(spark, rows):
    history, data = skewed(spark, 4)
    expected = []
    for entity in {item[1] for item in data}:
        run = None
        for item in sorted((x for x in data if x[1] == entity), key=lambda x: x[2]):
            # A NULL hash compares as unknown, which does not end a run.
            if run and (run["hash"] is None or item[3] is None or run["hash"] == item[3]):
                run["ids"].append(item[0])
                run["end"] = item[2]
            else:
                run = {"ids": [item[0]], "start": item[2], "end": item[2]}
                expected.append((entity, run))
            run["hash"] = item[3]
    want = sorted((min(r["ids"]), e, r["start"], r["end"], len(r["ids"])) for e, r in expected)
    got = attribute_run_length(history, width="3 h").select("id", "entity_id", "start", "end", "run_length")
    assert sorted(tuple(row) for row in got.collect()) == want


@pytest.mark.parametrize("width", [None, "45 m", "2 days"])
def test_as_of_join_against_a_loop(spark, width):
    history, data = skewed(spark, 5)
    rng = random.Random(6)
    facts = [(e, START + timedelta(minutes=rng.randrange(-50, 60 * 24 * 21)), n) for n, e in enumerate([0] * 80 + list(range(14)) * 3)]
    joined = as_of_join(spark.createDataFrame(facts, "entity_id bigint, timestamp timestamp_ntz, n int"), history, ["id"], width=width)
    got = {row["n"]: row["id"] for row in joined.collect()}
    for entity, when, n in facts:
        known = [item for item in data if item[1] == entity and item[2] <= when]
        assert got[n] == (max(known, key=lambda x: x[2])[0] if known else None)


def jobs_run(spark, build):
    """Numbers of the Spark jobs that ``build`` starts."""
    spark.sparkContext.setJobGroup("building", "")
    try:
        built = build()
        return built, spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_building_a_plan_runs_nothing(spark, ts):
    history, _ = skewed(spark, 7)
    whole = history.withColumn("end", F.lit(None).cast("timestamp_ntz")).withColumn("kind", F.col("hash"))
    exceptions = history.select("entity_id", F.col("timestamp").alias("start"), F.col("modified").alias("expires"), F.col("id").alias("v"))
    for build in (
        lambda: attribute_run_length(history), lambda: attribute_changes(history), lambda: attribute_compact(whole, ["kind"], ts("2024-06-01 00:00:00")),
        lambda: as_of_join(history.select("entity_id", "timestamp"), history, ["hash"]), lambda: exception_join(history, exceptions, ["v"]),
    ):
        built, jobs = jobs_run(spark, build)
        assert not jobs and built.columns


@pytest.mark.parametrize("hot", [0, None])
def test_hot_keys_are_split_evenly_null_too(spark, hot):
    """Two thirds of the rows on one key, most of them in a few minutes: no slice has much more than its share."""
    rows = [(i, hot if i % 3 else i, START + timedelta(seconds=i if i % 50 else 10_000_000 * (i % 7)), "x", START, START) for i in range(6000)]
    history = spark.createDataFrame(rows, SCHEMA)
    parts = []
    S._by_heat(history, ["entity_id"], "timestamp", S.AUTO, lambda df: parts.append(df) or df, lambda df: parts.append(df) or df.drop("__slice"), 8)
    ordinary, sliced = parts
    counts = {(r.entity_id, r["__slice"]): r["count"] for r in sliced.groupBy("entity_id", "__slice").count().collect()}
    assert {entity for entity, _ in counts} == {hot}
    assert 6 <= len(counts) <= 8 and max(counts.values()) <= 1.6 * 6000 / 8
    assert ordinary.count() + sum(counts.values()) == 6000 and ordinary.groupBy("entity_id").count().agg(F.max("count")).first()[0] == 1


@pytest.mark.parametrize("seed", [10, 11])
def test_hot_keys_give_the_plain_results(spark, rows, seed):
    history, _ = skewed(spark, seed)
    history = history.withColumn("entity_id", F.when(F.col("entity_id") == 3, None).otherwise(F.col("entity_id")))
    assert rows(attribute_run_length(history)) == rows(attribute_run_length(history, width=None))
    assert rows(attribute_changes(history)) == rows(attribute_changes(history, width=None))
    facts = history.select("entity_id", F.col("timestamp") + F.expr("interval 7 minutes"), "id").toDF("entity_id", "timestamp", "n")
    assert rows(as_of_join(facts, history, ["id"])) == rows(as_of_join(facts, history, ["id"], width=None))


def test_slices_of_no_rows(spark):
    history, _ = skewed(spark, 1)
    assert attribute_run_length(history.limit(0)).collect() == [] and attribute_changes(history.limit(0)).collect() == []


def test_compaction_is_the_same_sliced(spark, rows, ts):
    history, _ = skewed(spark, 8)
    history = history.withColumn("end", F.lit(None).cast("timestamp_ntz")).withColumn("kind", F.col("hash"))
    now = ts("2024-06-01 00:00:00")
    assert rows(attribute_compact(history, ["kind"], now, width="1 h")) == rows(attribute_compact(history, ["kind"], now, width=None))


def test_sliced_exceptions(spark, rows):
    rng = random.Random(9)
    facts = [(rng.choice([0, 0, 1, 2]), START + timedelta(hours=h), h) for h in range(300)]
    exceptions = [
        (rng.choice([0, 0, 0, 1, 3]), START + timedelta(hours=s), START + timedelta(hours=s + rng.choice([0, 1, 30, 9000])), s)
        for s in range(-20, 320, 7)
    ]
    f = spark.createDataFrame(facts, "entity_id int, timestamp timestamp_ntz, n int")
    e = spark.createDataFrame(exceptions, "entity_id int, start timestamp_ntz, expires timestamp_ntz, v int")
    plain = rows(exception_join(f, e, ["v"], slice_width=None))
    assert rows(exception_join(f, e, ["v"], slice_width="5 h")) == plain
    assert rows(exception_join(f, e, ["v"])) == plain
    want = []
    for entity, when, n in facts:
        hits = [x for x in exceptions if x[0] == entity and x[1] <= when < x[2]]
        want += [(entity, when, n, x[3]) for x in hits] or [(entity, when, n, None)]
    assert plain == sorted(want, key=str)


def test_bins_bound_the_largest_task_of_an_exception_join(spark):
    """Half of all records and of all exceptions are one entity's; per (entity, bin) there is a small part of them."""
    facts = spark.range(8000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("entity_id"),
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("timestamp"), F.col("id").alias("n"),
    )
    exceptions = facts.select("entity_id", F.col("timestamp").alias("start"), (F.col("timestamp") + F.expr("interval 7 minutes")).alias("expires"), F.col("n").alias("v"))
    ordinary, f, (e,) = joins.by_weight(facts, [exceptions], 16)
    assert ordinary.filter("entity_id = 0").isEmpty()
    for side in (f, e):
        counts = side.groupBy("entity_id", "__slice").count()
        assert counts.filter("entity_id = 0").agg(F.max("count")).first()[0] <= 2 * 8000 / 16
    assert e.count() <= 1.05 * 4000  # short exceptions are in one bin or two
    assert exception_join(facts, exceptions, ["v"]).exceptAll(exception_join(facts, exceptions, ["v"], slice_width=None)).isEmpty()
