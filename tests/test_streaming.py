"""Streaming jobs give what the batch operators give, over several micro-batches."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from tidegauge.operators.aggregates import time_rollup
from tidegauge.sources.factstore import FactStore
from tidegauge.sources.loading import EntityStore
from tidegauge.streaming import jobs as J
from tidegauge.streaming import late

T0 = datetime(2024, 1, 1)
RECORDS = "entity_id bigint, timestamp timestamp_ntz, value bigint"


def quarter(n):
    return T0 + timedelta(minutes=15 * n)


@pytest.fixture
def arriving(spark, tmp_path):
    """A folder that receives one file per call, and the stream over it."""
    folder = tmp_path / "in"

    def arrive(data, schema=RECORDS):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(folder))

    arrive.stream = lambda schema=RECORDS: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    return arrive


def test_rollup_across_batches_and_restarts(spark, tmp_path, arriving, rows, ts):
    store = FactStore(spark, str(tmp_path / "store"),
        "entity_id bigint, timestamp timestamp_ntz, created timestamp_ntz, job_id bigint, samples bigint, value bigint", "1 day")
    batches = [[(1, quarter(n), n) for n in range(1, 6)], [(1, quarter(6), 6), (2, quarter(4), 40)], [(1, quarter(7), 7)]]
    for data in batches:
        arriving(data)
        rolled = J.rollup(arriving.stream(), "15m", "1h", ["value"])
        J.run_available(J.into_store(rolled, store, now=lambda n: ts("2024-02-01 00:00:00")), str(tmp_path / "cp"))
    everything = spark.createDataFrame([row for data in batches for row in data], RECORDS)
    batch = time_rollup(everything, "15m", "1h", ["value"])
    assert rows(store.read().select("entity_id", "timestamp", "samples", "value")) == rows(
        batch.select("entity_id", "timestamp", "samples", "value")
    )


def test_records_beyond_the_lateness_are_dropped(spark, tmp_path, arriving, rows):
    table = J.VersionedTable(spark, str(tmp_path / "t"), "entity_id bigint, timestamp timestamp_ntz, samples bigint, value bigint")
    # The watermark seen by a batch comes from the batches before it, and moves on between runs.
    for data in ([(1, quarter(100), 1)], [(1, quarter(101), 1)], [(1, quarter(1), 5), (1, quarter(102), 1)]):
        arriving(data)
        rolled = J.rollup(arriving.stream(), "15m", "1h", ["value"], lateness="2 hours")
        J.run_available(J.keep_latest(rolled, table, ["entity_id", "timestamp"]), str(tmp_path / "cp"))
    got = {row.timestamp for row in table.read().collect()}
    assert T0 + timedelta(hours=1) not in got and T0 + timedelta(hours=26) in got


def test_modified_log(spark, tmp_path, arriving, rows):
    schema = "id bigint, part string, timestamp timestamp_ntz, modified timestamp_ntz"
    store = J.modified_store(spark, str(tmp_path / "m"))
    for data in ([(1, "a", T0, quarter(9)), (2, "a", T0, quarter(8)), (3, "a", quarter(400), quarter(1))], [(4, "a", T0, quarter(5)), (5, "b", T0, quarter(5))]):
        arriving(data, schema)
        J.run_available(J.process_log(arriving.stream(schema), store), str(tmp_path / "cp"))
    assert rows(store.read()) == [
        ("a", T0, quarter(9), quarter(5)), ("a", quarter(400), quarter(1), quarter(1)), ("b", T0, quarter(5), quarter(5)),
    ]


def test_the_strongest_notification_of_a_key_is_kept(spark, tmp_path, arriving, rows, ts):
    """Whatever the order of the batches, however far apart, and if a batch is run again."""
    from tests.test_rules import RULE

    schema = "entity_id bigint, timestamp timestamp_ntz, celsius double"
    batches = [[(1, T0, 95.0), (2, T0, 3.0)], [(1, T0, 99.0), (1, quarter(1), 93.0)], [(1, quarter(9000), 96.0)], [(1, T0, 97.0), (1, T0, 99.0)]]
    want = None
    for number, order in enumerate(([0, 1, 2, 3], [3, 2, 1, 0], [1, 1, 0, 3, 2])):
        store = J.notification_store(spark, str(tmp_path / f"out{number}"))
        kept = J.notify
        for place, batch in enumerate(order):
            folder = str(tmp_path / f"in{number}")
            spark.createDataFrame(batches[batch], schema).coalesce(1).write.mode("append").parquet(folder)
            stream = spark.readStream.schema(schema).parquet(folder)
            J.run_available(kept(stream, RULE, store, lambda n: ts("2024-02-01 00:00:00")), str(tmp_path / f"cp{number}"))
        got = rows(store.read())
        want = want or got
        assert got == want and len(got) == 3
    assert {(r[0], r[1]) for r in want} == {(1, T0), (1, quarter(1)), (1, quarter(9000))}


def test_current_attributes_and_counts(spark, tmp_path, arriving, rows):
    current = J.VersionedTable(spark, str(tmp_path / "current"), "entity_id bigint, timestamp timestamp_ntz, value bigint", keep=2)
    counts = FactStore(spark, str(tmp_path / "counts"), "part string, timestamp timestamp_ntz, count bigint", key=("part", "timestamp"))
    for data in ([(1, quarter(1), 10), (2, quarter(1), 20)], [(1, quarter(2), 11)], [(2, T0, 19), (3, quarter(1), 30)], [(3, quarter(5), 31)]):
        arriving(data)
        J.run_available(J.keep_latest(J.attribute_current(arriving.stream()), current, ["entity_id"]), str(tmp_path / "cp1"))
        J.run_available(J.put_in_store(J.completeness(arriving.stream(), "p"), counts), str(tmp_path / "cp2"))
    assert rows(current.read()) == [(1, quarter(2), 11), (2, quarter(1), 20), (3, quarter(5), 31)]
    assert rows(counts.read().select("timestamp", "count")) == [(T0, 1), (quarter(1), 3), (quarter(2), 1), (quarter(5), 1)]
    assert len(list((tmp_path / "current").glob("version=*"))) == 2


def test_ingest_merges_and_logs(spark, tmp_path, arriving, rows, ts):
    schema = "entity string, timestamp timestamp_ntz, a bigint, b bigint"
    store = FactStore(spark, str(tmp_path / "facts"),
        "entity_id bigint, timestamp timestamp_ntz, created timestamp_ntz, job_id bigint, a bigint, b bigint", "1 day")
    entities = EntityStore(spark, str(tmp_path / "entities"), spread=2)
    modified = J.modified_store(spark, str(tmp_path / "modified"))
    for data in ([("x", T0, 1, 2), ("y", T0, 3, 4)], [("x", T0, 10, 20), ("z", quarter(200), 5, 6)]):
        arriving(data, schema)
        J.run_available(
            J.ingest(arriving.stream(schema), "p", store, entities, modified, now=lambda n: ts(f"2024-02-0{n + 1} 00:00:00")), str(tmp_path / "cp")
        )
    named = store.read().join(entities.read().drop("created").withColumnRenamed("id", "entity_id"), "entity_id")
    assert rows(named.select("name", "timestamp", "a", "b", "job_id")) == [
        ("x", T0, 10, 20, 0), ("y", T0, 3, 4, 0), ("z", quarter(200), 5, 6, 1),
    ]
    assert sorted(row.id for row in entities.read().collect()) == [1, 2, 3]
    first, second = datetime(2024, 2, 1), datetime(2024, 2, 2)
    assert rows(modified.read()) == [("p", T0, first, second), ("p", quarter(200), second, second)]


def test_late_records_are_marked_and_made_up_for(spark, tmp_path, rows, ts):
    """Files out of order; what the stream's rollup lost is there after the marked labels were rolled up again."""
    schema = "key bigint, entity_id bigint, timestamp timestamp_ntz, value bigint"
    batches = [[(n, n % 2, quarter(n), n) for n in range(60, 70)], [(n + 500, 1, quarter(n), n) for n in (70, 3, 61)], [(n + 100, 1, quarter(n), n) for n in (2, 62, 71)]]
    audit = "created timestamp_ntz, job_id bigint"
    hours = FactStore(spark, str(tmp_path / "hours"), f"entity_id bigint, timestamp timestamp_ntz, {audit}, samples bigint, value bigint")
    records = FactStore(spark, str(tmp_path / "records"), schema, key=("key", "timestamp"))
    modified = J.modified_store(spark, str(tmp_path / "modified"))
    seen = late.horizon(spark, str(tmp_path / "seen"))
    now = lambda n: ts("2024-02-01 00:00:00")
    for data in batches:
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        J.run_available(J.into_store(J.rollup(stream, "15m", "1h", ["value"], "2 hours"), hours, now), str(tmp_path / "cp1"))
        J.run_available(late.keep_records(stream, "r", "15m", "1h", records, modified, seen, now, "2 hours"), str(tmp_path / "cp2"))
    columns = ["entity_id", "timestamp", "samples", "value"]
    full = rows(time_rollup(spark.createDataFrame([r for data in batches for r in data], schema), "15m", "1h", ["value"]).select(*columns))
    assert {r.timestamp for r in modified.read().collect()} == {quarter(n) for n in (2, 3, 61, 62)}
    assert rows(hours.read().select(*columns)) != full
    late.make_up_rollup(records, hours, modified, "r", "15m", "1h", ["value"], now(0), 9)
    assert rows(hours.read().select(*columns)) == full and modified.read().isEmpty()
