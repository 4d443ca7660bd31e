"""Threshold rules: KPI rows to weighted, de-duplicated notifications.

A rule is one lazy chain: KPI, thresholds with per-entity exceptions, condition, weight with
exceptions, message and data. Exceptions hold from ``start`` up to, not including, ``expires``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import other_columns
from tidegauge.functions.timeaxis import minus, plus
from tidegauge.operators.joins import BIN, at_timestamp, by_weight, exception_join, overlapping_exceptions
from tidegauge.operators.slices import AUTO
from tidegauge.plans.spec import SourceLink

NOTIFICATION_KEY = ["entity_id", "timestamp", "rule_id"]
DEFAULT_EXCEPTION_LENGTH = "3 months"


@dataclass(frozen=True)
class Rule:
    """A trigger rule; the expressions are Spark SQL over KPI and threshold columns."""

    id: int
    name: str
    condition: str
    thresholds: Mapping[str, tuple[str, object]] = field(default_factory=dict)
    weight: str = "1"
    message: str = "''"
    data: str = "'{}'"
    granularity: str = "15m"
    default_interval: str = "1 day"
    runnable: bool = True
    sources: Sequence[SourceLink] = ()

    def with_values(self, **values) -> "Rule":
        """The rule with other default threshold values."""
        unknown = set(values) - set(self.thresholds)
        if unknown:
            raise ValueError(f"unknown thresholds: {sorted(unknown)}")
        new = {name: (kind, values.get(name, value)) for name, (kind, value) in self.thresholds.items()}
        return replace(self, thresholds=new)

    def threshold_columns(self) -> dict[str, Column]:
        return {name: F.lit(value).cast(kind) for name, (kind, value) in self.thresholds.items()}

    def with_thresholds(
        self, kpi: DataFrame, exceptions: DataFrame | None = None, strict: bool = False, slice_width=AUTO
    ) -> DataFrame:
        """KPI rows with threshold columns; a valid exception overrides the default.

        Overlapping exceptions repeat a row; ``strict`` fails the job on them instead. ``slice_width`` as in
        :func:`~tidegauge.operators.joins.exception_join`.
        """
        if not self.thresholds:
            return kpi
        defaults = self.threshold_columns()
        if exceptions is None:
            return kpi.select("*", *[value.alias(name) for name, value in defaults.items()])
        if strict:
            exceptions = reject_overlap(exceptions)
        joined = exception_join(kpi, exceptions, list(defaults), prefix="__exc_", slice_width=slice_width)
        values = [F.coalesce(F.col(f"__exc_{name}"), value).alias(name) for name, value in defaults.items()]
        return joined.select(*kpi.columns, *values)

    def matches(self, kpi: DataFrame, exceptions: DataFrame | None = None, slice_width=AUTO) -> DataFrame:
        """Rows for which the condition holds; none for a rule that is switched off."""
        condition = F.expr(self.condition) if self.runnable else F.lit(False)
        return self.with_thresholds(kpi, exceptions, slice_width=slice_width).filter(condition)

    def evaluate(
        self, kpi: DataFrame, exceptions: DataFrame | None = None, weight_exceptions: DataFrame | None = None, slice_width=AUTO
    ) -> DataFrame:
        """Notifications ``entity_id, timestamp, weight, details, data`` without storing them.

        Records are cut into bins once, for both kinds of exceptions.
        """
        given = [table for table in (exceptions, weight_exceptions) if table is not None]
        if slice_width != AUTO or not given:
            return self._evaluated(kpi, exceptions, weight_exceptions, slice_width)
        ordinary, heavy, bins = by_weight(kpi, given)
        sliced = iter(bins)
        binned = [None if table is None else next(sliced) for table in (exceptions, weight_exceptions)]
        return self._evaluated(ordinary, exceptions, weight_exceptions, None).union(self._evaluated(heavy, *binned, None))

    def _evaluated(self, kpi: DataFrame, exceptions, weight_exceptions, slice_width) -> DataFrame:
        kept = [BIN] if BIN in kpi.columns else []
        rows = self.matches(kpi, exceptions, slice_width).select(
            "entity_id", "timestamp",
            F.expr(self.weight).cast("int").alias("weight"),
            F.expr(self.message).alias("details"),
            F.expr(self.data).alias("data"),
            *kept,
        )
        if weight_exceptions is not None:
            joined = exception_join(rows, weight_exceptions, ["weight"], slice_width=slice_width)
            rows = joined.withColumn("weight", F.coalesce("exc_weight", "weight").cast("int")).drop("exc_weight")
        return rows.drop(BIN)

    def evaluate_at(self, kpi: DataFrame, ts: Column, *exceptions) -> DataFrame:
        return self.evaluate(at_timestamp(kpi, ts), *exceptions)

    def evaluate_due(self, kpi: DataFrame, labels: DataFrame, *exceptions) -> DataFrame:
        """Notifications at this rule's labels among ``labels`` (``rule, timestamp``), see :mod:`tidegauge.plans.gates`."""
        own = labels.filter(F.col("rule") == self.name).select("timestamp")
        return self.evaluate(kpi.join(own, "timestamp", "left_semi"), *exceptions)


def reject_overlap(exceptions: DataFrame) -> DataFrame:
    """The exceptions, failing the job if two of one entity overlap."""
    first = overlapping_exceptions(exceptions).select("entity_id", F.lit(True).alias("__overlap")).distinct()
    checked = exceptions.join(first, "entity_id", "left")
    problem = F.raise_error(F.format_string("overlapping exceptions of entity %d", "entity_id")).cast("boolean")
    return checked.filter(F.when(F.col("__overlap"), problem).otherwise(True)).drop("__overlap")


def split_null_weights(notifications: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Notifications that may be stored, and those rejected for lack of a weight."""
    weighted = F.col("weight").isNotNull()
    return notifications.filter(weighted), notifications.filter(~weighted)


def create_notifications(
    rule: Rule, evaluated: DataFrame, stored: DataFrame, now: Column, dedupe_batch: bool = False
) -> DataFrame:
    """Notifications of the rule that are not stored yet, ready to append.

    Rows without data or weight are left out.
    """
    usable, _ = split_null_weights(evaluated.filter(F.col("data").isNotNull()))
    staged = usable.select(
        "entity_id", "timestamp", F.lit(rule.id).alias("rule_id"), now.alias("created"), "weight", "details", "data"
    )
    return new_notifications(staged, stored, dedupe_batch)


def new_notifications(staged: DataFrame, stored: DataFrame, dedupe_batch: bool = False) -> DataFrame:
    """Staged rows whose (entity, timestamp, rule) is not stored.

    Repeats inside the batch stay, unless ``dedupe_batch`` asks for one row per key (the
    one with the largest weight, then details and data).
    """
    fresh = staged.join(stored.select(*NOTIFICATION_KEY), NOTIFICATION_KEY, "left_anti")
    if not dedupe_batch:
        return fresh.select(*staged.columns)
    first = [name for name in ("weight", "details", "data") if name in staged.columns]
    rest = other_columns(staged, [*NOTIFICATION_KEY, *first])
    best = fresh.groupBy(*NOTIFICATION_KEY).agg(F.max(F.struct(*first, *rest)).alias("row"))
    return best.select(*[name if name in NOTIFICATION_KEY else F.col(f"row.{name}") for name in staged.columns])


def create_interval_notifications(
    rule: Rule, evaluated: DataFrame, stored: DataFrame, now: Column, interval: str | None = None
) -> DataFrame:
    """Notifications later than ``now - interval``, without the data column."""
    recent = evaluated.filter(F.col("timestamp") > minus(now, interval or rule.default_interval))
    usable, _ = split_null_weights(recent)
    staged = usable.select("entity_id", "timestamp", F.lit(rule.id).alias("rule_id"), now.alias("created"), "weight", "details")
    return new_notifications(staged, stored)


def change_exceptions(exceptions: DataFrame, changes: DataFrame, values: Sequence[str]) -> DataFrame:
    """Exceptions with the entities in ``changes`` created or given a new validity and values.

    ``changes`` has one row per entity. Every exception of a changed entity takes the new values.
    """
    columns = ["start", "expires", *values]
    new = changes.select("entity_id", F.struct(*columns).alias("new"))
    hit = F.col("new").isNotNull()
    return exceptions.select("entity_id", *columns).join(new, "entity_id", "full_outer").select(
        "entity_id", *[F.when(hit, F.col(f"new.{name}")).otherwise(F.col(name)).alias(name) for name in columns]
    )


def get_or_create_exceptions(exceptions: DataFrame, entity_ids: DataFrame, now: Column, values: Sequence[str]) -> DataFrame:
    """Exceptions of the given entities; a missing one starts now, lasts three months, has no values."""
    wanted = entity_ids.select("entity_id").distinct()
    found = wanted.join(exceptions.withColumn("__found", F.lit(True)), "entity_id", "left")
    created = F.col("__found").isNull()
    fields = dict(found.select(*values).dtypes)
    return found.select(
        "entity_id",
        F.when(created, now).otherwise(F.col("start")).alias("start"),
        F.when(created, plus(now, DEFAULT_EXCEPTION_LENGTH)).otherwise(F.col("expires")).alias("expires"),
        *[F.col(name).cast(fields[name]) for name in values],
    )


def rule_timestamps_due(links: DataFrame, modified: DataFrame) -> DataFrame:
    """Timestamps at which rules are to be evaluated after source changes.

    ``links``: ``rule, part, source_granularity, target_granularity``.
    """
    from tidegauge.operators.changes import map_modified

    mapped = map_modified(modified, links.withColumnRenamed("rule", "materialization"))
    return mapped.withColumnRenamed("materialization", "rule")


def notification_sets(notifications: DataFrame, links: DataFrame) -> DataFrame:
    """Number of notifications, time range and largest weight per notification set.

    ``links``: ``notification_id, set_id``.
    """
    members = notifications.select(F.col("id").alias("notification_id"), "timestamp", "weight")
    return links.join(members, "notification_id").groupBy("set_id").agg(
        F.count(F.lit(1)).alias("notifications"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
        F.max("weight").alias("max_weight"),
    )


def filter_by_tag(items: DataFrame, links: DataFrame, tags: DataFrame, tag: str, key: str = "id") -> DataFrame:
    """Items carrying a tag. ``links``: ``item_id, tag_id``; ``tags``: ``id, name``."""
    tag_ids = tags.filter(F.col("name") == tag).select(F.col("id").alias("tag_id"))
    tagged = links.join(tag_ids, "tag_id", "left_semi").select(F.col("item_id").alias(key))
    return items.join(tagged, key, "left_semi")
