"""Time axis, arrays and types: hand-computed edge cases."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidegauge.functions import arrays as A
from tidegauge.functions import timeaxis as X
from tidegauge.functions import types as Y
from tidegauge.functions.fingerprints import attribute_hash


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize(
    "text, seconds",
    [("00:01:00", 60), ("2 months 29 days", 7765632), ("15m", 900), ("3 days", 259200), ("1 mon", 30.44 * 86400), ("900", 900)],
)
def test_interval_lengths(text, seconds):
    assert X.Interval.of(text).duration_seconds() == Decimal(str(seconds))


def test_interval_kinds():
    assert X.Interval.of("1month") == X.Interval.of("1 months") == X.Interval(months=1)
    assert X.Interval.of("1w") == X.Interval.of("7 days")
    assert X.Interval.of("1 year").epoch_seconds() == 31557600
    assert X.Interval.of("1 month").epoch_seconds() == 2592000
    for bad in ("", "soon", "3 parsecs", "1h later"):
        with pytest.raises(ValueError):
            X.Interval.of(bad)


def test_ceil_and_floor(spark, ts):
    on, off = ts("2024-03-31 10:15:00"), ts("2024-03-31 10:07:00.000001")
    got = one(
        spark, X.ceil_to_granularity(on, "15m"), X.ceil_to_granularity(off, "15m"), X.ceil_to_granularity(off, "1month"),
        X.floor_to_granularity(off, "5m"), X.floor_to_granularity(off, "1w"), X.ceil_to_granularity(off, "1w"),
    )
    assert got == (
        datetime(2024, 3, 31, 10, 15), datetime(2024, 3, 31, 10, 15), datetime(2024, 4, 1),
        datetime(2024, 3, 31, 10, 5), datetime(2024, 3, 25), datetime(2024, 4, 1),
    )
    with pytest.raises(ValueError):
        X.floor_to_granularity(on, "12 hours")


def test_labels_are_period_ends(spark, ts):
    got = one(
        spark, X.map_label(ts("2024-01-01 09:15:00"), "15m", "1h"), X.map_label(ts("2024-01-01 10:00:00"), "15m", "1h"),
        X.map_label(ts("2024-01-01 00:00:00"), "15m", "1d"), X.map_label(ts("2024-01-08 00:00:00"), "1d", "1w"),
        X.map_label(ts("2024-01-09 00:00:00"), "1d", "1w"), X.map_label(ts("2024-03-01 00:00:00"), "1d", "1month"),
        X.map_label(ts("2024-03-01 00:00:00"), "1d", "1d"),
    )
    assert got == (
        datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 10), datetime(2024, 1, 1), datetime(2024, 1, 8),
        datetime(2024, 1, 15), datetime(2024, 3, 1), datetime(2024, 3, 1),
    )


def test_window_grid_covers_the_period(spark, ts):
    (grid,) = one(spark, X.window_grid(ts("2024-01-01 10:00:00"), "15m", "1h"))
    assert grid == [datetime(2024, 1, 1, 9, 15) + timedelta(minutes=15 * i) for i in range(4)]


def test_bucket_index_rounds_seconds_and_has_fixed_months(spark, ts):
    got = one(
        spark, X.bucket_index(ts("1970-01-01 00:14:59.600"), "15m"), X.bucket_index(ts("1970-01-01 00:14:59.400"), "15m"),
        X.bucket_index(ts("1970-01-31 00:00:00"), "1 month"), X.bucket_start(F.lit(2), "1 month"),
    )
    assert got == (1, 0, 1, datetime(1970, 3, 2))


def test_rule_timestamps_descend(spark, ts):
    (stamps,) = one(spark, X.rule_timestamps(ts("2024-01-03 12:00:00"), "1 day", "2 days"))
    assert stamps == [datetime(2024, 1, day) for day in (3, 2, 1)]


def test_grid_is_empty_when_reversed(spark, ts):
    assert one(spark, X.grid(ts("2024-01-02 00:00:00"), ts("2024-01-01 00:00:00"), "1h")) == ([],)


def test_interval_seconds_column(spark):
    assert one(spark, X.interval_seconds(F.lit("01:02:03")), X.interval_seconds(F.lit("1 day"))) == (3723, None)


def test_division(spark):
    got = one(
        spark, A.safe_division(F.lit(7), F.lit(2), integral=True), A.safe_division(F.lit(-7), F.lit(2), integral=True),
        A.safe_division(F.lit(7), F.lit(0), integral=True), A.safe_division(F.lit(7.0), F.lit(0.0), F.lit(-1.0)),
        A.safe_division(F.lit(7.0), F.lit(None).cast("double"), F.lit(-1.0)),
    )
    assert got == (3, -3, None, -1.0, None)


def test_array_functions(spark):
    a, b = F.array(F.lit(1), F.lit(None), F.lit(3)), F.array(F.lit(10), F.lit(20))
    nothing = F.lit(None).cast("array<int>")
    empty = F.array().cast("array<int>")
    got = one(
        spark, A.add_array(a, b), A.add_array(a, nothing), A.divide_array(b, F.array(F.lit(0), F.lit(4)), integral=True),
        A.array_sum(a, "int"), A.array_sum(empty, "int"), A.array_sum(F.array(F.lit(None).cast("int")), "int"),
        A.array_to_text(a), A.to_pdf(F.lit("1,,3")), A.to_pdf(F.lit("")), A.to_array(F.lit(None).cast("int")), A.to_array(F.lit(5)),
        A.add_array(empty, b),
    )
    assert got == ([11, None], None, [None, 5], 4, None, None, "1,3", [1, None, 3], None, None, [5], None)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        one(spark, A.divide_array_by(F.array(F.lit(1.0)), F.lit(0)))


def test_array_literals(spark):
    got = one(
        spark, A.parse_array_literal(F.lit("{0,0,5}"), "int"), A.parse_array_literal(F.lit("{}"), "int"),
        A.parse_array_literal(F.lit("[1|x| 3]"), "int", "|", "[", "]"), A.parse_array_literal(F.lit("0,1"), "int"),
    )
    assert got == ([0, 0, 5], [], [1, None, 3], None)


def test_type_order(spark):
    got = one(
        spark, Y.greatest_data_type(F.lit("integer"), F.lit("numeric")), Y.greatest_data_type(F.lit("text"), F.lit("real")),
        Y.greatest_data_type(F.lit("real"), F.lit(None).cast("string")), Y.data_type_order(F.lit(None).cast("string")),
        Y.is_integer(F.lit("0")), Y.is_integer(F.lit("10")), Y.is_integer(F.lit("010")),
    )
    assert got == ("numeric", "text", "real", None, False, True, False)
    with pytest.raises(Exception, match="unsupported data type"):
        one(spark, Y.data_type_order(F.lit("money")))


def test_strict_parsing_fails_on_bad_text(spark):
    cells = spark.createDataFrame([("12",), ("",), ("1e3",)], "cell string")
    assert [r[0] for r in cells.select(Y.parse_strict("cell", "double precision")).collect()] == [12.0, None, 1000.0]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cells.select(Y.parse_strict("cell", "integer")).collect()
    assert [r[0] for r in cells.select(Y.parse_lenient("cell", "integer")).collect()] == [12, None, None]
    assert [r[0] for r in cells.select(Y.parse_strict("cell", "integer", null_token="1e3")).limit(1).collect()] == [12]


def test_coercion(spark):
    big = F.lit(3_000_000_000)
    got = one(
        spark, Y.coerce(F.lit(42), "integer", "bigint"), Y.coerce(F.lit(42).cast("bigint"), "bigint", "numeric"),
        Y.coerce(big, "bigint", "integer"), Y.coerce(F.lit(3e9), "double precision", "integer"),
        Y.coerce(F.array(F.lit("a"), F.lit("b")), "text[]", "text"),
    )
    assert got == (42, Decimal(42), 3_000_000_000 - (1 << 32), None, "a,b")
    for source, target in (("double precision", "real"), ("text", "integer"), ("timestamp", "text")):
        with pytest.raises(ValueError):
            Y.coerce(F.lit(1), source, target)


def test_attribute_hash(spark):
    df = spark.createDataFrame([("ab", "c", None), ("a", "bc", None)], "x string, y string, z string")
    plain = {r[0] for r in df.select(attribute_hash(["x", "y", "z"])).collect()}
    separated = {r[0] for r in df.select(attribute_hash(["x", "y", "z"], separator="|")).collect()}
    assert len(plain) == 1 and len(separated) == 2
    assert {r[0] for r in df.select(attribute_hash([])).collect()} == {"Q"}
