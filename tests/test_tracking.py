"""Change log, fingerprints, history and lineage."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import changes as C
from tidegauge.operators import history as H
from tidegauge.operators.aggregates import completeness, execution_metrics, sum_array
from tidegauge.plans.lineage import lineage_closure
from tidegauge.plans.spec import Materialization, SourceLink

T0 = datetime(2024, 1, 1)
LOG = "id bigint, part string, timestamp timestamp_ntz, modified timestamp_ntz"
MODIFIED = "part string, timestamp timestamp_ntz, first timestamp_ntz, last timestamp_ntz"


def hours(n):
    return T0 + timedelta(hours=n)


def test_last_is_overwritten_even_by_an_older_change(spark, rows):
    modified = spark.createDataFrame([("a", T0, hours(5), hours(9)), ("a", hours(1), hours(5), hours(5))], MODIFIED)
    log = spark.createDataFrame([(1, "a", T0, hours(50)), (2, "a", T0, hours(7)), (3, "b", T0, hours(8)), (4, "a", T0, hours(6))], LOG)
    assert rows(C.process_modified_log(log, modified, 1)) == [
        ("a", T0, hours(5), hours(7)), ("a", hours(1), hours(5), hours(5)), ("b", T0, hours(8), hours(8)),
    ]
    assert C.last_processed_id(log, 1).first()[0] == 4
    assert C.last_processed_id(log, 9).first()[0] == 9


def test_window_fingerprint_has_gaps(spark):
    modified = spark.createDataFrame([("a", hours(1) - timedelta(minutes=30), hours(3), hours(4))], MODIFIED)
    labels = spark.createDataFrame([("a", hours(1))], "part string, timestamp timestamp_ntz")
    row = C.fingerprint_window(labels, modified, "15m", "1h").first()
    assert row.max_modified == hours(4)
    assert row.fingerprint == (
        '{"2024-01-01 00:15:00.000000":"","2024-01-01 00:30:00.000000":"2024-01-01 04:00:00.000000",'
        '"2024-01-01 00:45:00.000000":"","2024-01-01 01:00:00.000000":""}'
    )


def test_multi_fingerprint_needs_all_parts(spark):
    modified = spark.createDataFrame([("a", T0, T0, hours(1)), ("b", T0, T0, hours(2)), ("a", hours(1), T0, T0)], MODIFIED)
    got = C.fingerprint_multi(modified, ["b", "a"]).collect()
    assert [(r.timestamp, r.max_modified) for r in got] == [(T0, hours(2))]


def test_pending_honours_every_delay(spark, ts):
    jobs = [
        Materialization("m", "m", "1h", [], processing_delay="30m", stability_delay="5m", reprocessing_period="3 days"),
        Materialization("off", "off", "1h", [], enabled=False),
    ]
    now = hours(100)
    minute = timedelta(minutes=1)
    cases = {
        "due": ("m", now - 30 * minute, "x", None, now - 5 * minute),
        "same": ("m", now - 31 * minute, "x", "x", now - 5 * minute),
        "too early": ("m", now - 29 * minute, "x", None, now - 5 * minute),
        "unstable": ("m", now - 32 * minute, "x", "y", now - 4 * minute),
        "edge of reprocessing": ("m", now - timedelta(days=3), "x", "y", now - 5 * minute),
        "too old": ("m", now - timedelta(days=3, minutes=1), "x", "y", now - 5 * minute),
        "disabled": ("off", now - 33 * minute, "x", None, now - 5 * minute),
    }
    state = spark.createDataFrame([(*case, name) for name, case in cases.items()],
        "materialization string, timestamp timestamp_ntz, source_fingerprint string, processed_fingerprint string, "
        "max_modified timestamp_ntz, job_id string")
    due = C.pending_materializations(state, C.materialization_jobs(spark, jobs), F.lit(now).cast("timestamp_ntz"))
    assert {row.job_id for row in due.collect()} == {"due", "edge of reprocessing"}


def test_labels_of_unmappable_links_fail(spark):
    modified = spark.createDataFrame([("a", T0, T0, T0)], MODIFIED)
    link = "materialization string, part string, source_granularity string, target_granularity string"
    with pytest.raises(ValueError, match="invalid granularity"):
        C.map_modified(modified, spark.createDataFrame([("m", "a", "15m", "2h")], link))
    with pytest.raises(Exception, match="no mapping from granularity 1h to 1d"):
        df = spark.createDataFrame([(T0, "1h", "1d")], "timestamp timestamp_ntz, s string, t string")
        df.select(C.map_by_link(F.col("timestamp"), F.col("s"), F.col("t"), [("15m", "1h")])).collect()


def test_fingerprints_of_several_parts(spark, rows):
    prints = spark.createDataFrame([("b", T0, T0, "{2}"), ("a", T0, T0, "{1}"), ("a", T0 + timedelta(hours=1), T0, "{3}")], "part string, timestamp timestamp_ntz, max_modified timestamp_ntz, fingerprint string")
    assert rows(C.combine_fingerprints(prints, ["a", "b"])) == [(T0, T0, '{"a":{1},"b":{2}}')]


def test_cascade_from_log_to_processed_state(spark, rows, ts):
    """Log, modified, touched labels, fingerprints, work list, replacement: two rounds."""
    job = Materialization("m", "m", "1h", [SourceLink("a", "15m")], processing_delay="0 s", stability_delay="0 s", reprocessing_period="9 days")
    now = ts("2024-01-02 00:00:00")
    state = C.empty_state(spark)
    quarter = timedelta(minutes=15)
    for round_number, changed in enumerate([[T0 + quarter, T0 + 5 * quarter], [T0 + 2 * quarter]]):
        modified = spark.createDataFrame([("a", at, at, at + timedelta(hours=1)) for at in changed], MODIFIED)
        labels = C.map_modified(modified, C.link_table(spark, [job])).withColumn("part", F.lit("a"))
        prints = C.fingerprint_window(labels.select("part", "timestamp"), modified, "15m", "1h").withColumn("materialization", F.lit("m"))
        state = C.update_source_fingerprint(state, prints)
        due = C.pending_materializations(state, C.materialization_jobs(spark, [job]), now)
        assert {r.timestamp for r in due.collect()} == ({hours(1), hours(2)} if round_number == 0 else {hours(1)})
        state = C.mark_processed(state, due, round_number)
    assert rows(state.select("timestamp", "job_id")) == [(hours(1), 1), (hours(2), 0)]


def test_replace_keeps_destination_columns(spark, rows, ts):
    destination = spark.createDataFrame([(1, T0, 1, T0, 1), (1, hours(1), 2, T0, 1)], "entity_id int, timestamp timestamp_ntz, v int, created timestamp_ntz, job_id bigint")
    fresh = spark.createDataFrame([(2, T0, 9, "x"), (2, hours(2), 9, "x")], "entity_id int, timestamp timestamp_ntz, v int, extra string")
    labels = spark.createDataFrame([(T0,), (hours(1),)], "timestamp timestamp_ntz")
    got = C.replace_timestamps(destination, fresh, labels, ts("2024-01-02 00:00:00"), 2)
    assert rows(got) == [(2, T0, 9, hours(24), 2)]


def history(spark, data):
    base = [(i, T0, T0, h, e, at, end, h) for i, e, at, end, h in data]
    return spark.createDataFrame(base,
        "id bigint, first_appearance timestamp_ntz, modified timestamp_ntz, hash string, entity_id int, "
        "timestamp timestamp_ntz, end timestamp_ntz, kind string")


def test_compaction(spark, rows, ts):
    h = history(spark, [
        (1, 1, hours(1), None, "a"), (2, 1, hours(2), None, "a"), (3, 1, hours(3), None, "b"), (4, 1, hours(4), None, "a"),
        (5, 2, hours(1), hours(9), "a"), (6, 2, hours(2), None, "a"), (7, 3, hours(1), hours(7), "c"),
    ])
    now = ts("2024-05-01 00:00:00")
    got = rows(H.attribute_compact(h, ["kind"], now).select("id", "entity_id", "timestamp", "end", "kind"))
    # Runs look at timestamps, not at an earlier end; a single row keeps the end it has.
    assert got == [
        (1, 1, hours(1), hours(2), "a"), (3, 1, hours(3), hours(3), "b"), (4, 1, hours(4), hours(4), "a"),
        (5, 2, hours(1), hours(2), "a"), (7, 3, hours(1), hours(7), "c"),
    ]
    only_new = rows(H.attribute_compact(h, ["kind"], now, after_id=5).select("id", "entity_id", "end"))
    assert (1, 1, hours(1)) in only_new and (2, 1, hours(2)) in only_new and (5, 2, hours(2)) in only_new
    capped = rows(H.attribute_compact(h, ["kind"], now, after_id=4, up_to_id=5).select("id"))
    assert capped == [(1,), (2,), (3,), (4,), (5,), (7,)]


def test_transfer_of_attributes(spark, rows, ts):
    h = history(spark, [(1, 1, hours(1), None, "a"), (2, 1, hours(2), None, "b")])
    staging = spark.createDataFrame(
        [(1, hours(2), "B", 0), (1, hours(3), "x", 0), (1, hours(3), None, 1)], "entity_id int, timestamp timestamp_ntz, kind string, turn int"
    )
    assert rows(H.staging_new(staging, h, "turn")) == [(1, hours(3), "x")]
    assert H.staging_modified(staging, h).count() == 1
    got = H.transfer_staged(h, staging, ["kind"], ts("2024-01-09 00:00:00"), "turn")
    assert rows(got.select("id", "timestamp", "kind", "modified")) == [
        (1, hours(1), "a", T0), (2, hours(2), "B", datetime(2024, 1, 9)), (3, hours(3), "x", datetime(2024, 1, 9)),
    ]
    assert got.filter("kind = 'B'").first().hash == got.select(F.md5(F.lit("B"))).first()[0]


def test_markers_never_move_back(spark, rows):
    marks = spark.createDataFrame([("a", 5), ("b", 1)], "store string, compacted bigint")
    updates = spark.createDataFrame([("a", 3), ("c", 2)], "store string, compacted bigint")
    assert rows(H.advance_marker(marks, updates, "compacted")) == [("a", 5), ("b", 1), ("c", 2)]


def test_lineage_counts_every_path(spark, rows):
    edges = spark.createDataFrame([("t", "v1"), ("t", "v2"), ("v1", "w"), ("v2", "w"), ("w", "x"), ("u", "v1")], "source string, depender string")
    roots = spark.createDataFrame([("t",), ("nothing",)], "name string")
    assert rows(lineage_closure(edges, roots)) == [
        ("t", "v1", 1, 1), ("t", "v2", 1, 1), ("t", "w", 2, 2), ("t", "x", 3, 2),
    ]
    # A cycle that the root is on, and one behind it.
    for cycle, root in (([("a", "b"), ("b", "a")], "a"), ([("r", "a"), ("a", "b"), ("b", "c"), ("c", "a")], "r")):
        with pytest.raises(ValueError, match="cycle"):
            lineage_closure(spark.createDataFrame(cycle, "source string, depender string"), spark.createDataFrame([(root,)], "name string"))
    assert lineage_closure(edges, spark.createDataFrame([("nothing",)], "name string")).count() == 0


def test_array_sums(spark):
    data = [(1, [1, 2, 3]), (1, [10, 20]), (1, None), (2, [1, None]), (2, [1, 1]), (3, []), (3, [5]), (4, None)]
    got = {r.k: r.a for r in sum_array(spark.createDataFrame(data, "k int, a array<int>"), "k", "a").collect()}
    assert got == {1: [11, 22], 2: [2, None], 3: None}


def test_completeness_truncates_both_ends(spark, ts):
    stats = spark.createDataFrame([("p", hours(24), 3), ("p", hours(72), 4)], "part string, timestamp timestamp_ntz, count bigint")
    got = completeness(stats, "1d", ts("2024-01-02 23:00:00"), ts("2024-01-04 01:00:00")).collect()
    assert [(r.timestamp, r["count"]) for r in got] == [(hours(24), 3), (hours(48), 0), (hours(72), 4)]
    monthly = completeness(stats, "1month", ts("2024-01-31 00:00:00"), ts("2024-03-01 00:00:00"))
    assert [r.timestamp for r in monthly.collect()] == [datetime(2024, m, 1) for m in (1, 2, 3)]


def test_metrics(spark, rows):
    jobs = spark.createDataFrame([("m", T0, hours(1)), ("m", T0, hours(2))], "materialization string, started timestamp_ntz, finished timestamp_ntz")
    assert rows(execution_metrics(jobs)) == [("m", 2, 3 * 3600 * 1_000_000)]
