"""Materializations level by level over stored parts."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import changes as C
from tidegauge.operators.aggregates import time_rollup
from tidegauge.plans.cascade import Cascade, levels, record_modified, rollup_of, source_fingerprints
from tidegauge.plans.spec import Materialization, SourceLink
from tidegauge.sources.factstore import FactStore

T0 = datetime(2024, 1, 1)
FACT = "entity_id bigint, timestamp timestamp_ntz, created timestamp_ntz, job_id bigint, samples bigint, value bigint"
CHANGE = "part string, timestamp timestamp_ntz, modified timestamp_ntz"
PLAN = [
    Materialization("d", "day", "1d", [SourceLink("hour", "1h")], rollup_of("hour", "1h", "1d", ["value"], "samples"), stability_delay="0 seconds"),
    Materialization("h", "hour", "1h", [SourceLink("quarter", "15m")], rollup_of("quarter", "15m", "1h", ["value"], "samples")),
]


def later(**span):
    return T0 + timedelta(**span)


@pytest.fixture
def cascade(spark, tmp_path):
    parts = {name: FactStore(spark, f"{tmp_path}/{name}", FACT, "1 day") for name in ("quarter", "hour", "day")}
    return Cascade(spark, PLAN, parts, f"{tmp_path}/book", "1 day")


def quarters(spark, days, value=1):
    rows = [(e, T0 + timedelta(days=d, minutes=15 * q), T0, 0, 1, value * e) for d in days for q in range(1, 97) for e in (1, 2)]
    return spark.createDataFrame(rows, FACT)


def changes(df, modified):
    return df.select(F.lit("quarter").alias("part"), "timestamp", F.lit(modified).cast("timestamp_ntz").alias("modified")).distinct()


def full(df, target):
    return time_rollup(df, "15m", target, ["value"], "samples")


def files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def plain(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_levels_put_sources_first_and_refuse_cycles():
    assert [[m.name for m in level] for level in levels(PLAN)] == [["h"], ["d"]]
    loop = [Materialization("a", "x", "1h", [SourceLink("y", "1h")]), Materialization("b", "y", "1h", [SourceLink("x", "1h")])]
    with pytest.raises(ValueError, match="need each other: a, b"):
        levels(loop)
    with pytest.raises(ValueError, match="same destination"):
        levels([PLAN[0], PLAN[0]])


def test_late_rows_recompute_their_labels_only(spark, cascade, tmp_path):
    first = quarters(spark, range(3))
    cascade.parts["quarter"].append(first)
    assert cascade.tick(changes(first, later(days=3)), later(days=3, hours=1)) == [("h", 72), ("d", 3)]
    before = files(f"{tmp_path}/hour") | files(f"{tmp_path}/day")
    late = spark.createDataFrame([(1, later(days=1, minutes=15), None, None, 5, 500)], FACT)
    cascade.parts["quarter"].upsert(late.drop("created", "job_id"), F.lit(T0), 9)
    assert cascade.tick(changes(late, later(days=3, hours=2)), later(days=3, hours=3)) == [("h", 1), ("d", 1)]
    stored = cascade.parts["quarter"].read()
    for name, target in (("hour", "1h"), ("day", "1d")):
        columns = ["entity_id", "timestamp", "samples", "value"]
        assert plain(cascade.parts[name].read(), *columns) == plain(full(stored, target), *columns)
    after = files(f"{tmp_path}/hour") | files(f"{tmp_path}/day")
    kept = {path for path, stamp in before.items() if after.get(path) == stamp}
    touched = {path.split("bucket=")[1].split("/")[0] for path in set(before) - kept}
    assert len(touched) <= 2 and kept
    assert plain(cascade.metrics(), "materialization", "execution_count") == [("d", 4), ("h", 73)]
    marks = {(r.part, r.timestamp): (r.first, r.last) for r in cascade.modified.read().collect()}
    assert marks["hour", later(days=1, hours=1)] == (later(days=3, hours=1), later(days=3, hours=3))
    assert marks["day", later(days=2)] == (later(days=3, hours=1), later(days=3, hours=3))
    assert marks["hour", later(days=1, hours=2)] == (later(days=3, hours=1), later(days=3, hours=1))


def test_nothing_is_done_twice(spark, cascade):
    rows = quarters(spark, [0])
    cascade.parts["quarter"].append(rows)
    assert cascade.tick(changes(rows, later(days=1)), later(days=1, hours=1))
    assert cascade.tick(changes(rows.limit(0), T0), later(days=1, hours=2)) == []


def test_labels_wait_for_their_delays(spark, cascade):
    """Changes of a minute ago are not stable; a tick without changes computes them once they are."""
    rows = quarters(spark, [0])
    cascade.parts["quarter"].append(rows)
    now = later(days=1, hours=1)
    assert cascade.tick(changes(rows, now - timedelta(minutes=1)), now) == []
    assert cascade.tick(changes(rows.limit(0), T0), now + timedelta(minutes=5)) == [("h", 24), ("d", 1)]


def test_a_failed_tick_is_made_up_for(spark, cascade, monkeypatch):
    rows = quarters(spark, [0])
    cascade.parts["quarter"].append(rows)
    monkeypatch.setattr(cascade.state, "put_written", lambda rows: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        cascade.tick(changes(rows, later(days=1)), later(days=1, hours=1))
    monkeypatch.undo()
    assert cascade.tick(changes(rows.limit(0), T0), later(days=1, hours=2)) == [("h", 24), ("d", 1)]
    assert cascade.parts["hour"].read().count() == 48 and cascade.parts["day"].read().count() == 2


def test_a_label_without_records_any_more_ends_empty(spark, cascade):
    rows = quarters(spark, [0, 1])
    cascade.parts["quarter"].append(rows)
    cascade.tick(changes(rows, later(days=2)), later(days=2, hours=1))
    gone = rows.filter(F.col("timestamp") <= F.lit(later(days=1)))
    cascade.parts["quarter"].exchange(gone.limit(0), gone.select("entity_id", "timestamp"))
    cascade.tick(changes(gone, later(days=2, hours=2)), later(days=2, hours=3))
    assert {r.timestamp for r in cascade.parts["day"].read().collect()} == {later(days=2)}
    assert cascade.parts["hour"].read().count() == 48


def test_fingerprint_over_several_sources(spark):
    m = Materialization("k", "kpi", "15m", [SourceLink("b", "15m"), SourceLink("a", "15m")])
    modified = spark.createDataFrame([("a", T0, T0, later(hours=1)), ("b", T0, T0, later(hours=2))], "part string, timestamp timestamp_ntz, first timestamp_ntz, last timestamp_ntz")
    touched = spark.createDataFrame([("k", T0)], "materialization string, timestamp timestamp_ntz")
    row = source_fingerprints(touched, [m], {"15m": modified}).first()
    stamp = '{"2024-01-01 00:00:00.000000":"2024-01-01 0%d:00:00.000000"}'
    assert row.max_modified == later(hours=2)
    assert row.fingerprint == f'{{"a":{stamp % 1},"b":{stamp % 2}}}'


def test_stored_marks_touch_their_buckets_only(spark, tmp_path):
    schema = "part string, timestamp timestamp_ntz, first timestamp_ntz, last timestamp_ntz"
    store = FactStore(spark, f"{tmp_path}/m", schema, "1 day", key=("part", "timestamp"))
    log = "id bigint, part string, timestamp timestamp_ntz, modified timestamp_ntz"
    first = [(i, "a", later(days=i, hours=1), later(days=9)) for i in range(5)]
    record_modified(store, spark.createDataFrame(first, log), -1)
    before = files(store.path)
    record_modified(store, spark.createDataFrame([(3, "a", later(days=3, hours=1), T0), (7, "a", later(days=3, hours=1), later(days=8))], log), 5)
    after = files(store.path)
    assert len(set(before) & set(after)) == 4
    assert (later(days=3, hours=1), later(days=9), later(days=8)) in {(r.timestamp, r.first, r.last) for r in store.read().collect()}


STATE = "materialization string, timestamp timestamp_ntz, source_fingerprint string, processed_fingerprint string, max_modified timestamp_ntz, job_id bigint"


def test_reconciled_state_keeps_what_was_processed(spark, tmp_path):
    state = [("m", later(days=d), f"s{d}", f"p{d}", T0, d) for d in range(4)] + [("m", None, "n", "n", None, 7)]
    wanted = [("m", later(days=0), T0, "s0"), ("m", later(days=1), T0, "other"), ("m", later(days=2), later(hours=1), "s2"), ("m", later(days=9), T0, "new")]
    table = spark.createDataFrame(state, STATE)
    desired = spark.createDataFrame(wanted, "materialization string, timestamp timestamp_ntz, max_modified timestamp_ntz, fingerprint string")
    want = {
        (later(days=0), "s0", "p0", T0, 0), (later(days=1), "other", "p1", T0, 1), (later(days=2), "s2", "p2", later(hours=1), 2), (later(days=9), "new", None, T0, None),
    }
    assert {tuple(r)[1:] for r in C.reconcile(table, desired).collect()} == want
    counts = C.state_reconcile(table, desired).first()
    assert (counts.added, counts.updated, counts.deleted) == (1, 2, 2)
    cascade = Cascade(spark, PLAN, {}, f"{tmp_path}/book", "1 day")
    cascade.state.append(table.filter("timestamp is not null"))
    before = files(cascade.state.path)
    cascade.reconcile(desired)
    assert {tuple(r)[1:] for r in cascade.state.read().collect()} == want
    assert len(set(before) & set(files(cascade.state.path))) == 1
