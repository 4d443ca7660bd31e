"""Files to stored facts: partial upserts, routing, stores and buckets."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidegauge.operators.entities import create_missing_entities, resolve_entities, with_missing_entities
from tidegauge.plans.cascade import MODIFIED
from tidegauge.plans.spec import Trend, TrendStorePart
from tidegauge.sources import delimited as L
from tidegauge.sources import factstore as S
from tidegauge.sources.loading import EntityStore, JobLog, Loader

PART = TrendStorePart(
    "link_15m", "15m", [Trend(name, "numeric") for name in ("sent", "lost", "delay")],
)
SCHEMA = (
    "entity_id bigint, timestamp timestamp_ntz, created timestamp_ntz, job_id bigint, "
    "sent decimal(38,18), lost decimal(38,18), delay decimal(38,18)"
)
FULL = """link,timestamp,sent,lost,delay
north,2024-06-01T09:15:00Z,4100,7,12.25
south,2024-06-01T09:15:00Z,3900,1,8.5
"""
PARTIAL = """link,timestamp,delay,lost
south,2024-06-01T11:15:00+02:00,9.75,2
"""
LAYOUT = L.DelimitedFormat(entity_column="link")


@pytest.fixture
def load(spark, tmp_path):
    entities = spark.createDataFrame([], "id bigint, name string, created timestamp_ntz")

    def run(text: str, store: S.FactStore, now, job: int) -> str:
        nonlocal entities
        file = tmp_path / f"load{job}.csv"
        file.write_text(text)
        rows = L.read_delimited(spark, str(file), LAYOUT)
        entities = with_missing_entities(entities, rows.select(F.col("entity").alias("name")), now)
        batch = L.part_batch(resolve_entities(rows, entities), PART, LAYOUT)
        return store.append_or_upsert(batch, now, job, order=L.LINE)

    run.names = lambda: {r.name: r.id for r in entities.collect()}
    return run


def test_load_twice_with_partial_columns(spark, tmp_path, load, ts):
    store = S.FactStore(spark, str(tmp_path / "store"), SCHEMA)
    assert load(FULL, store, ts("2024-06-01 09:20:00"), 1) == "append"
    assert load(PARTIAL, store, ts("2024-06-01 10:00:00"), 2) == "upsert"
    ids = load.names()
    got = {row.entity_id: row for row in store.read().collect()}
    north, south = got[ids["north"]], got[ids["south"]]
    assert (north.delay, north.lost) == (Decimal("12.25"), 7) and (south.delay, south.lost) == (Decimal("9.75"), 2)
    assert south.sent == 3900
    # A known row keeps its audit columns.
    assert (south.created, south.job_id) == (datetime(2024, 6, 1, 9, 20), 1)
    assert south.timestamp == datetime(2024, 6, 1, 9, 15)


def test_quoted_cells_over_several_files(spark, tmp_path):
    cells = ['plain', 'say "hi", ok', 'c:\\', 'two\nlines', '']
    quoted = ['"' + c.replace('"', '""') + '"' for c in cells]
    for number, name in enumerate(["b.csv", "a.csv"]):
        lines = [f"x{i},2024-01-0{number + 1}T00:00:00Z,{c}" for i, c in enumerate(quoted)]
        (tmp_path / name).write_text("\n".join(["entity,timestamp,note", *lines]) + "\n" + "pad,2024-01-09T00:00:00Z,z\n" * 50 * (1 - number))
    layout = L.DelimitedFormat(multi_line=True)
    got = [r for r in L.read_delimited(spark, str(tmp_path), layout).orderBy("line").collect() if r.entity != "pad"]
    assert [r.note for r in got] == cells * 2
    assert [r.timestamp.day for r in got] == [2] * 5 + [1] * 5  # a.csv comes first, though it is the smaller file


def test_repeated_keys_need_an_order(spark, ts, rows):
    empty = spark.createDataFrame([], "entity_id int, timestamp timestamp_ntz, created timestamp_ntz, job_id bigint, x int")
    batch = spark.createDataFrame([(1, datetime(2024, 1, 1), 5, 2), (1, datetime(2024, 1, 1), 6, 1)], "entity_id int, timestamp timestamp_ntz, x int, line int")
    now = ts("2024-01-02 00:00:00")
    assert [r.x for r in S.upsert_partial(empty, batch, now, 1, order="line").collect()] == [5]
    with pytest.raises(Exception, match="the batch repeats entity 1"):
        S.upsert_partial(empty, batch.drop("line"), now, 1).collect()


def test_array_cells(spark, tmp_path):
    file = tmp_path / "sample.tsv"
    file.write_text(
        "link\ttimestamp\thops\nnorth\t2024-06-01T14:00:00Z\t{3,1,4,1}\nsouth\t2024-06-01T16:00:00+02:00\t{}\n"
    )
    layout = L.DelimitedFormat(entity_column="link", separator="\t")
    got = L.typed_columns(L.read_delimited(spark, str(file), layout), {"hops": "integer[]"}, layout).collect()
    assert got[0].hops == [3, 1, 4, 1] and got[1].hops == []
    assert got[0].timestamp == got[1].timestamp == datetime(2024, 6, 1, 14)


def test_missing_columns_and_bad_values_fail(spark, tmp_path):
    file = tmp_path / "bad.csv"
    file.write_text("link,when,delay\na,2020-01-01T00:00:00Z,x\n")
    with pytest.raises(ValueError, match="timestamp"):
        L.read_delimited(spark, str(file), LAYOUT)
    layout = L.DelimitedFormat(entity_column="link", timestamp_column="when")
    rows = L.read_delimited(spark, str(file), layout)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        L.typed_columns(rows, {"delay": "double precision"}, layout).collect()
    assert L.typed_columns(rows, {"delay": "double precision"}, layout, lenient=True).first().delay is None


def test_empty_cells_follow_the_null_token(spark, tmp_path):
    file = tmp_path / "nulls.csv"
    file.write_text("entity,timestamp,a,b\nx,2020-01-01T00:00:00Z,,-\ny,2020-01-01T00:00:00Z,1,2\n")
    layout = L.DelimitedFormat(null_token="-")
    rows = L.read_delimited(spark, str(file), layout)
    got = L.typed_columns(rows, {"b": "integer"}, layout).orderBy("entity").collect()
    assert [(row.a, row.b) for row in got] == [("", None), ("1", 2)]


def test_ragged_rows_fail(spark, tmp_path):
    file = tmp_path / "ragged.csv"
    file.write_text("entity,timestamp,a,b\nx,2020-01-01T00:00:00Z,1\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        L.read_delimited(spark, str(file)).collect()


def test_routing(spark):
    rows = spark.createDataFrame([(1, datetime(2024, 1, 1), "1", "2")], "entity_id int, timestamp timestamp_ntz, a string, b string")
    routed = L.route_columns(rows, {"one": ["a"], "both": ["b", "a", "c"], "none": ["c"]})
    assert {part: df.columns[2:] for part, df in routed.items()} == {"one": ["a"], "both": ["a", "b"]}
    assert L.part_batch(rows, PART) is None


KEYED = "entity_id bigint, timestamp timestamp_ntz, created timestamp_ntz, job_id bigint, v int, w int"


def batch(spark, data, columns="v int"):
    return spark.createDataFrame(data, f"entity_id bigint, timestamp timestamp_ntz, {columns}")


def test_store_life_cycle(spark, tmp_path, rows, ts):
    store = S.FactStore(spark, str(tmp_path / "s"), KEYED, "1 day")
    assert store.read().count() == 0
    days = [datetime(2024, 1, day, 12) for day in (1, 2, 3, 4)]
    now = ts("2024-02-01 00:00:00")
    assert store.append_or_upsert(batch(spark, [(e, d, e) for e in (1, 2) for d in days]), now, 1) == "append"
    assert [r.bucket for r in store.buckets().orderBy("bucket").collect()] == [19723, 19724, 19725, 19726]

    untouched = sorted((tmp_path / "s" / "bucket=19723").iterdir())
    # Repeats within a batch: the last one counts; a NULL overwrites.
    again = batch(spark, [(1, days[1], 7, 0), (1, days[1], 8, 1), (9, days[1], None, 2)], "v int, line int")
    assert store.append_or_upsert(again, now, 2, order="line") == "upsert"
    assert sorted((tmp_path / "s" / "bucket=19723").iterdir()) == untouched
    second_day = store.between(datetime(2024, 1, 2), datetime(2024, 1, 3)).select("entity_id", "v", "job_id")
    assert rows(second_day) == [(1, 8, 1), (2, 2, 1), (9, None, 2)]

    labels = spark.createDataFrame([(days[2],), (days[3],)], "timestamp timestamp_ntz")
    fresh = batch(spark, [(5, days[2], 50, 51), (6, days[0], 60, 61)], "v int, w int")
    store.replace(fresh, labels, now, 3)
    got = rows(store.read().select("entity_id", "timestamp", "v", "w"))
    assert (5, days[2], 50, 51) in got and not [r for r in got if r[1] == days[3] or r[0] == 6]
    assert not (tmp_path / "s" / "bucket=19726").exists()

    store.delete_timestamp(days[2])
    assert {r[1] for r in rows(store.read().select("entity_id", "timestamp"))} == {days[0], days[1]}

    # 2024-01-02 lies exactly on the limit of three days and stays.
    moment = datetime(2024, 1, 5)
    assert store.clean_up(moment, "1 day", pretend=True) == [19723]
    assert store.buckets().count() == 2
    assert store.clean_up(moment, "1 day") == [19723]
    assert [r.bucket for r in store.buckets().collect()] == [19724]
    missing = [r.bucket for r in store.missing(moment, "1 day", ahead="1 day").orderBy("bucket").collect()]
    assert missing == [19725, 19726, 19727, 19728, 19729]


def test_store_opens_only_wanted_buckets(spark, tmp_path, ts):
    store = S.FactStore(spark, str(tmp_path / "s"), KEYED, "1 day")
    store.append_or_upsert(batch(spark, [(1, datetime(2024, 1, d, 12), d) for d in range(1, 10)]), ts("2024-02-01 00:00:00"), 1)
    wanted = store.between(datetime(2024, 1, 3), datetime(2024, 1, 3, 23))
    assert {name.split("bucket=")[1].split("/")[0] for name in wanted.inputFiles()} == {"19725"}
    assert wanted.count() == 1


def test_periods_open_only_their_buckets(spark, tmp_path, ts):
    store = S.FactStore(spark, str(tmp_path / "s"), KEYED, "1 day")
    store.append_or_upsert(batch(spark, [(1, datetime(2024, 1, d, 12), d) for d in range(1, 10)]), ts("2024-02-01 00:00:00"), 1)
    labels = spark.createDataFrame([(datetime(2024, 1, 3),), (datetime(2024, 1, 7, 1),)], "timestamp timestamp_ntz")
    days = {row.timestamp.day for row in store.of_periods(labels, "1d").collect()}
    assert days == {2, 3, 6, 7}


def test_hot_bucket_is_split_over_files(spark, tmp_path, ts):
    store = S.FactStore(spark, str(tmp_path / "s"), KEYED, "1 day")
    one_day = spark.range(200_000).select(
        F.col("id").alias("entity_id"), ts("2024-01-01 12:00:00").alias("timestamp"), ts("2024-01-01 12:00:00").alias("created"),
        F.lit(1).cast("bigint").alias("job_id"), F.col("id").cast("int").alias("v"), F.lit(0).alias("w"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        store.append(one_day)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "s" / "bucket=19723").glob("*.parquet"))) > 1
    assert store.read().count() == 200_000


def test_transfer_of_all_staged_rows(spark, rows):
    base = spark.createDataFrame([(1, 1)], "timestamp int, v int")
    staging = spark.createDataFrame([(2, 5), (3, 6)], "timestamp int, v int")
    stored, left = S.transfer_staged(base, staging)
    assert rows(stored) == [(1, 1), (2, 5), (3, 6)] and left.count() == 0


def test_bucket_for_one_timestamp(spark, rows, ts):
    parts = spark.createDataFrame([("a", 86400), ("b", 86400)], "part string, size_seconds bigint")
    existing = spark.createDataFrame([("a", 19723)], "part string, bucket bigint")
    assert rows(S.buckets_for_timestamp(parts, existing, ts("2024-01-01 05:00:00"))) == [("b", 19723)]


def test_entity_ids_are_dense_and_repeatable(spark, ts):
    known = spark.createDataFrame([(7, "n3")], "id bigint, name string")
    names = spark.range(5000).select(F.concat(F.lit("n"), (F.col("id") % 2000).cast("string")).alias("name"))
    now = ts("2024-01-01 00:00:00")
    first = create_missing_entities(known, names, now)
    again = create_missing_entities(known, names.repartition(13), now)
    got = {row.name: row.id for row in first.collect()}
    assert sorted(got.values()) == list(range(8, 8 + 1999)) and "n3" not in got
    assert got == {row.name: row.id for row in again.collect()}


def test_a_batch_is_computed_once(spark, tmp_path, ts):
    counted = spark.sparkContext.accumulator(0)

    def note(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    schema = "entity_id int, timestamp timestamp_ntz, x int"
    batch = spark.createDataFrame([(i, datetime(2024, 1, 1 + i % 5), i) for i in range(20)], schema).mapInArrow(note, schema)
    store = S.FactStore(spark, str(tmp_path / "store"), "entity_id int, timestamp timestamp_ntz, created timestamp_ntz, job_id bigint, x int")
    now = ts("2024-02-01 00:00:00")
    for expected, way in ((20, "append"), (40, "upsert")):
        assert store.append_or_upsert(batch, now, 1, order="x") == way
        assert counted.value == expected
    fresh = batch.select("entity_id", "timestamp", "x")
    store.replace(fresh, fresh.select("timestamp").distinct().limit(0), now, 2)
    assert store.read().count() == 20


def test_one_load_feeds_all_parts(spark, tmp_path, ts):
    """Two parts of one file, one of which shares a column; a second file with one part's column; a load that fails."""
    parts = [PART, TrendStorePart("quality_15m", "15m", [Trend("lost", "numeric"), Trend("jitter", "numeric")])]
    audit = "entity_id bigint, timestamp timestamp_ntz, created timestamp_ntz, job_id bigint"
    stores = {
        "link_15m": S.FactStore(spark, str(tmp_path / "link"), SCHEMA),
        "quality_15m": S.FactStore(spark, str(tmp_path / "quality"), f"{audit}, lost decimal(38,18), jitter decimal(38,18)"),
    }
    modified = S.FactStore(spark, str(tmp_path / "modified"), MODIFIED, key=("part", "timestamp"))
    ticks = iter([datetime(2024, 6, 1, 9, minute) for minute in range(20, 40)])
    jobs = JobLog(spark, str(tmp_path / "jobs"), clock=lambda: next(ticks))
    loader = Loader(parts, stores, EntityStore(spark, str(tmp_path / "names"), spread=2), modified, jobs)
    for number, text in enumerate((FULL, "link,timestamp,delay\nsouth,2024-06-01T09:15:00Z,9.75\nwest,2024-06-01T09:30:00Z,1\n", "link,timestamp,delay\neast,2024-06-01T09:15:00Z,x\n")):
        (tmp_path / f"{number}.csv").write_text(text)
    first = loader.load(str(tmp_path / "0.csv"), ts("2024-06-01 10:00:00"), LAYOUT)
    second = loader.load(str(tmp_path / "1.csv"), ts("2024-06-01 11:00:00"), LAYOUT)
    assert (first.job_id, dict(first.parts)) == (1, {"link_15m": "append", "quality_15m": "append"})
    assert (second.job_id, dict(second.parts)) == (2, {"link_15m": "upsert"})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        loader.load(str(tmp_path / "2.csv"), ts("2024-06-01 12:00:00"), LAYOUT)
    names = {r.id: r.name for r in loader.entities.read().collect()}
    assert sorted(names) == [1, 2, 3, 4] and sorted(names.values()) == ["east", "north", "south", "west"]
    link = {names[r.entity_id]: r for r in stores["link_15m"].read().collect()}
    assert set(link) == {"north", "south", "west"} and (link["south"].delay, link["south"].sent, link["south"].job_id) == (Decimal("9.75"), 3900, 1)
    assert (link["west"].job_id, link["west"].lost) == (2, None)
    assert {names[r.entity_id]: (r.lost, r.jitter) for r in stores["quality_15m"].read().collect()} == {"north": (7, None), "south": (1, None)}
    quarter, half = datetime(2024, 6, 1, 9, 15), datetime(2024, 6, 1, 9, 30)
    ten, eleven = datetime(2024, 6, 1, 10), datetime(2024, 6, 1, 11)
    assert {tuple(r) for r in modified.read().collect()} == {("link_15m", quarter, ten, eleven), ("link_15m", half, eleven, eleven), ("quality_15m", quarter, ten, ten)}
    log = {r.id: r for r in jobs.read().collect()}
    assert sorted(log) == [1, 2, 3] and log[1].finished > log[1].started and log[3].finished is None and log[3].action.endswith("2.csv")


def test_entities_are_created_once(spark, tmp_path, ts):
    names = EntityStore(spark, str(tmp_path / "names"), spread=3)
    now = ts("2024-01-01 00:00:00")
    first = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "name string")
    assert (names.add(first, now), names.add(first, now), names.add(spark.createDataFrame([("c",), ("b",)], "name string"), now)) == (2, 0, 1)
    assert sorted(r.id for r in names.read().collect()) == [1, 2, 3] and names.last_id() == 3
    rows = spark.createDataFrame([("c", 1), ("a", 2), ("nobody", 3)], "entity string, v int")
    assert sorted(r.v for r in names.resolve(rows).collect()) == [1, 2]


def test_timestamps_deleted_from_all_parts_of_a_granularity(spark, tmp_path, ts):
    parts = [TrendStorePart(n, g, []) for n, g in (("a", "15m"), ("b", "00:15:00"), ("c", "1h"))]
    stores = {part.name: S.FactStore(spark, str(tmp_path / part.name), KEYED) for part in parts}
    for store in stores.values():
        store.append_or_upsert(batch(spark, [(e, datetime(2024, 1, 1, h), e) for e in (1, 2) for h in (1, 2)]), ts("2024-02-01 00:00:00"), 1)
    assert S.delete_timestamp_everywhere(parts, stores, "15m", datetime(2024, 1, 1, 1)) == {"a": 2, "b": 2}
    assert [stores[name].read().count() for name in "abc"] == [2, 2, 4]
    assert stores["a"].delete_timestamp(datetime(2025, 1, 1)) == 0
