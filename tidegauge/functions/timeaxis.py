"""Time-axis columns.

A record's timestamp is the *end* of its period: a 1h record labelled 10:00 covers
(09:00, 10:00]. Timestamps are TIMESTAMP_NTZ in UTC throughout, and every function
here keeps predicates on the raw column possible (nothing wraps the stored column
before a filter).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import timedelta
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.functions.columns import Col, as_column

NTZ = "timestamp_ntz"
MICROS = 1_000_000

_UNIT_SECONDS = {
    "second": Decimal(1), "sec": Decimal(1), "s": Decimal(1),
    "minute": Decimal(60), "min": Decimal(60), "m": Decimal(60),
    "hour": Decimal(3600), "hr": Decimal(3600), "h": Decimal(3600),
    "day": Decimal(86400), "d": Decimal(86400),
    "week": Decimal(604800), "wk": Decimal(604800), "w": Decimal(604800),
}
_MONTHS_PER_UNIT = {"month": 1, "mon": 1, "year": 12, "yr": 12, "y": 12}

# Epoch length of a calendar unit, used for bucket arithmetic only.
MONTH_EPOCH_SECONDS = 30 * 86400
YEAR_EPOCH_SECONDS = 31557600
# Fixed length of a month where an interval is read as a plain duration.
MONTH_DURATION_SECONDS = Decimal("30.44") * 86400

_CLOCK = re.compile(r"^(\d+):(\d{2}):(\d{2})$")
_TERM = re.compile(r"(\d+)\s*([a-zA-Z]+)")


@dataclass(frozen=True)
class Interval:
    """A span of calendar months plus a fixed number of seconds."""

    months: int = 0
    seconds: Decimal = Decimal(0)

    @staticmethod
    def of(spec: "Interval | timedelta | int | str") -> "Interval":
        if isinstance(spec, Interval):
            return spec
        if isinstance(spec, timedelta):
            return Interval(seconds=Decimal(spec.days * 86400 + spec.seconds) + Decimal(spec.microseconds) / MICROS)
        if isinstance(spec, int):
            return Interval(seconds=Decimal(spec))
        return _parse(spec)

    @property
    def micros(self) -> int:
        if self.months:
            raise ValueError("a calendar interval has no fixed length")
        return int(self.seconds * MICROS)

    def duration_seconds(self) -> Decimal:
        """Length as a plain duration (a month counts 30.44 days)."""
        return self.months * MONTH_DURATION_SECONDS + self.seconds

    def epoch_seconds(self) -> int:
        """Length used for bucket arithmetic (month 30 days, year 365.25 days)."""
        years, months = divmod(self.months, 12)
        return int(years * YEAR_EPOCH_SECONDS + months * MONTH_EPOCH_SECONDS + self.seconds)

    def column(self) -> Column:
        """The interval as a foldable Spark literal."""
        if self.months and self.seconds:
            raise ValueError("months and seconds cannot be mixed in one literal")
        if self.months:
            years, months = divmod(self.months, 12)
            return F.make_ym_interval(F.lit(years), F.lit(months))
        return F.lit(timedelta(microseconds=self.micros))


def _parse(text: str) -> Interval:
    clock = _CLOCK.match(text.strip())
    if clock:
        hours, minutes, seconds = (int(part) for part in clock.groups())
        return Interval(seconds=Decimal(hours * 3600 + minutes * 60 + seconds))
    if text.strip().isdigit():
        return Interval(seconds=Decimal(text.strip()))
    leftover = _TERM.sub("", text).strip()
    terms = _TERM.findall(text)
    if leftover or not terms:
        raise ValueError(f"not an interval: {text!r}")
    months, seconds = 0, Decimal(0)
    for amount, word in terms:
        unit = word.lower()
        unit = unit if unit in _UNIT_SECONDS or unit in _MONTHS_PER_UNIT else unit.removesuffix("s")
        if unit in _UNIT_SECONDS:
            seconds += int(amount) * _UNIT_SECONDS[unit]
        elif unit in _MONTHS_PER_UNIT:
            months += int(amount) * _MONTHS_PER_UNIT[unit]
        else:
            raise ValueError(f"unknown interval unit: {word!r}")
    return Interval(months, seconds)


HOUR, DAY, WEEK, MONTH = (Interval.of(text) for text in ("1h", "1d", "1w", "1month"))
_CALENDAR_UNIT = {HOUR: "hour", DAY: "day", WEEK: "week", MONTH: "month"}


def plus(ts: Col, interval: Interval | str | int) -> Column:
    return (as_column(ts) + Interval.of(interval).column()).cast(NTZ)


def minus(ts: Col, interval: Interval | str | int) -> Column:
    return (as_column(ts) - Interval.of(interval).column()).cast(NTZ)


def epoch_micros(ts: Col) -> Column:
    return F.unix_micros(as_column(ts).cast("timestamp"))


def from_micros(micros: Column) -> Column:
    return F.timestamp_micros(micros).cast(NTZ)


def floor_to_granularity(ts: Col, granularity: Interval | str | int) -> Column:
    """Most recent boundary at or before ``ts`` (below one hour, or 1h/1d/1w/1month)."""
    gran = Interval.of(granularity)
    column = as_column(ts)
    if gran in _CALENDAR_UNIT:
        return F.date_trunc(_CALENDAR_UNIT[gran], column).cast(NTZ)
    if gran.months or gran.seconds <= 0 or gran.seconds >= 3600:
        raise ValueError(f"invalid granularity: {granularity!r}")
    micros = epoch_micros(column)
    return from_micros(micros - F.pmod(micros, F.lit(gran.micros)))


def ceil_to_granularity(ts: Col, granularity: Interval | str | int) -> Column:
    """Next boundary, or ``ts`` itself when it already lies on one."""
    just_before = as_column(ts) - F.lit(timedelta(microseconds=1))
    return plus(floor_to_granularity(just_before, granularity), granularity)


def map_label(ts: Col, source: Interval | str | int, target: Interval | str | int) -> Column:
    """Label of the target period that a source record with label ``ts`` belongs to."""
    src, dst = Interval.of(source), Interval.of(target)
    if src == dst:
        return as_column(ts)
    return plus(floor_to_granularity(minus(ts, src), dst), dst)


def period_start(label: Col, target: Interval | str | int) -> Column:
    """Exclusive lower bound of the right-closed period labelled ``label``."""
    return minus(label, target)


def grid(start: Col, stop: Col, step: Interval | str | int) -> Column:
    """Array of all boundaries from ``start`` to ``stop``, both inclusive; explode to use."""
    first, last = as_column(start), as_column(stop)
    return F.when(first <= last, F.sequence(first, last, Interval.of(step).column())).otherwise(
        F.array().cast(f"array<{NTZ}>")
    )


def window_grid(label: Col, source: Interval | str | int, target: Interval | str | int) -> Column:
    """Source labels that make up the target period labelled ``label``."""
    return grid(plus(minus(label, target), source), label, source)


def _whole_seconds(ts: Col) -> Column:
    return F.round(epoch_micros(ts).cast("decimal(20,0)") / F.lit(MICROS), 0).cast("bigint")


def bucket_index(ts: Col, size: Interval | str | int) -> Column:
    """Storage bucket number: whole epoch seconds divided by the epoch length of ``size``."""
    return _integer_division(_whole_seconds(ts), Interval.of(size).epoch_seconds())


def bucket_start(index: Col, size: Interval | str | int) -> Column:
    return from_micros(as_column(index).cast("bigint") * F.lit(Interval.of(size).epoch_seconds() * MICROS))


def _integer_division(value: Column, divisor: int) -> Column:
    return F.call_function("div", value, F.lit(divisor)).cast("bigint")


def truncate_for_rule(ts: Col, granularity: Interval | str | int) -> Column:
    """Calendar truncation for a day or a week, epoch floor for every other granularity."""
    gran = Interval.of(granularity)
    if gran in (DAY, WEEK):
        return floor_to_granularity(ts, gran)
    return bucket_start(bucket_index(ts, gran), gran)


def rule_timestamps(now: Col, granularity: Interval | str | int, default_interval: Interval | str | int) -> Column:
    """Array of rule timestamps, newest first, from truncated ``now`` back over the interval."""
    newest = truncate_for_rule(now, granularity)
    oldest = minus(newest, default_interval)
    return F.sequence(newest, oldest, -Interval.of(granularity).column())


# Short names and default partition sizes per granularity.
GRANULARITY_NAMES = {
    "00:05:00": "5m",
    "00:15:00": "qtr",
    "01:00:00": "hr",
    "12:00:00": "12hr",
    "1 day": "day",
    "1 week": "wk",
    "1 month": "month",
}
DEFAULT_PARTITION_SIZES = {
    "00:05:00": "3 hours",
    "00:15:00": "6 hours",
    "00:30:00": "6 hours",
    "01:00:00": "1 day",
    "12:00:00": "7 days",
    "1 day": "7 days",
    "1 week": "1 month",
    "1 month": "1 year",
}


def _lookup(values: dict[str, str], key: Column) -> Column:
    entries = [F.lit(item) for pair in values.items() for item in pair]
    return F.try_element_at(F.create_map(*entries), key)


def granularity_to_text(granularity: Col) -> Column:
    """Short name of a granularity given as text; unknown ones keep their text."""
    column = as_column(granularity)
    return F.coalesce(_lookup(GRANULARITY_NAMES, column), column)


def default_partition_size(granularity: Col) -> Column:
    """Default partition size of a granularity given as text, NULL where none is set."""
    return _lookup(DEFAULT_PARTITION_SIZES, as_column(granularity))


def interval_seconds(text: Col) -> Column:
    """Length in seconds of a column of ``HH:MM:SS`` interval texts, NULL for other forms."""
    column = as_column(text)
    part = [F.regexp_extract(column, r"^(\d+):(\d{2}):(\d{2})$", group).try_cast("bigint") for group in (1, 2, 3)]
    return part[0] * 3600 + part[1] * 60 + part[2]
