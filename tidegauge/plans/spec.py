"""Driver-side descriptions of stores, materializations and rules."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tidegauge.functions.timeaxis import Interval

KEY = ("entity_id", "timestamp")
AUDIT = ("created", "job_id")


@dataclass(frozen=True)
class Trend:
    """A measured column and how it is aggregated over time and over entities."""

    name: str
    data_type: str
    time_aggregation: str = "SUM"
    entity_aggregation: str = "SUM"
    extra_data: Mapping = field(default_factory=dict)


@dataclass(frozen=True)
class GeneratedTrend:
    """A column computed from stored trends."""

    name: str
    data_type: str
    expression: str


@dataclass(frozen=True)
class TrendStorePart:
    """One wide fact table at one granularity."""

    name: str
    granularity: str
    trends: Sequence[Trend]
    generated: Sequence[GeneratedTrend] = ()
    partition_size: str = "1 day"
    retention_period: str = "1 month"

    @property
    def trend_names(self) -> list[str]:
        return [trend.name for trend in self.trends]


@dataclass(frozen=True)
class SourceLink:
    """A source part of a materialization and how its labels map to the destination's."""

    part: str
    granularity: str


@dataclass(frozen=True)
class Materialization:
    """A destination part computed from source parts.

    ``compute(sources, labels)`` returns the destination rows for all wanted labels at once.
    """

    name: str
    destination: str
    granularity: str
    sources: Sequence[SourceLink]
    compute: Callable[[Mapping[str, DataFrame], DataFrame], DataFrame] | None = None
    processing_delay: str = "30m"
    stability_delay: str = "5m"
    reprocessing_period: str = "3 days"
    enabled: bool = True


# What a KPI gets per granularity (processing delay, partition size).
KPI_GRANULARITIES = {
    "15m": ("10m", "1d"),
    "1h": ("10m", "4d"),
    "1d": ("30m", "3 months"),
    "1w": ("30m", "1 year"),
    "1month": ("30m", "5 years"),
}
KPI_STABILITY_DELAY = "5m"
KPI_REPROCESSING_PERIOD = "3 days"


def interval(spec) -> Interval:
    return Interval.of(spec)
