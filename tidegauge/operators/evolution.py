"""Schema evolution of stored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.fingerprints import attribute_hash
from tidegauge.functions.types import declared_type, spark_type, wider_type
from tidegauge.plans.spec import AUDIT, KEY, GeneratedTrend

FIXED_COLUMNS = (*KEY, *AUDIT)


@dataclass(frozen=True)
class ChangeReport:
    """Names of the columns a schema change added, removed and retyped."""

    added: list[str] = field(default_factory=list)
    removed: list[str] = field(default_factory=list)
    changed: list[str] = field(default_factory=list)

    def lines(self) -> list[str]:
        def part(word: str, items: list[str]) -> list[str]:
            return [f"{word} trends:", *items] if items else [f"no trends {word}"]

        return [*part("added", self.added), *part("removed", self.removed), *part("changed", self.changed)]


def schema_diff(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """Differences between declared and actual columns (``part, trend, data_type, aggregation``).

    ``change`` is one of new part, new trend, removed trend, type change, metadata change.
    """
    want = declared.select("part", "trend", F.struct("data_type", "aggregation").alias("want"))
    have = actual.select("part", "trend", F.struct("data_type", "aggregation").alias("have"))
    known = actual.select("part").distinct().withColumn("__known", F.lit(True))
    change = (
        F.when(F.col("__known").isNull(), "new part")
        .when(F.col("have").isNull(), "new trend")
        .when(F.col("want").isNull(), "removed trend")
        .when(F.col("want.data_type") != F.col("have.data_type"), "type change")
        .when(~F.col("want.aggregation").eqNullSafe(F.col("have.aggregation")), "metadata change")
    )
    return (
        want.join(have, ["part", "trend"], "full_outer")
        .join(known, "part", "left")
        .select(
            "part", "trend", change.alias("change"),
            F.col("have.data_type").alias("from_type"), F.col("want.data_type").alias("to_type"),
        )
        .filter(F.col("change").isNotNull())
    )


def add_missing_columns(df: DataFrame, declared: Mapping[str, str], generated: Sequence[GeneratedTrend] = ()) -> DataFrame:
    """Table with the missing declared columns (NULL) and generated columns."""
    absent = {name: F.lit(None).cast(spark_type(kind)) for name, kind in declared.items() if name not in df.columns}
    wide = df.withColumns(absent) if absent else df
    return generated_columns(wide, [trend for trend in generated if trend.name not in df.columns])


def generated_columns(df: DataFrame, generated: Sequence[GeneratedTrend]) -> DataFrame:
    """Evaluate generated columns over the stored trends."""
    values = {trend.name: F.expr(trend.expression).cast(spark_type(trend.data_type)) for trend in generated}
    return df.withColumns(values) if values else df


def drop_extra_columns(df: DataFrame, declared: Mapping[str, str], keep: Sequence[str] = FIXED_COLUMNS) -> DataFrame:
    """Table without trend columns that are no longer declared."""
    return df.drop(*[name for name in df.columns if name not in declared and name not in keep])


def _retyped(df: DataFrame, targets: Mapping[str, str]) -> tuple[DataFrame, list[str]]:
    current = {name: declared_type(kind) for name, kind in df.dtypes}
    changed = {name: kind for name, kind in targets.items() if name in current and kind != current[name]}
    casts = {name: F.col(name).cast(spark_type(kind)) for name, kind in changed.items()}
    return (df.withColumns(casts) if casts else df), list(changed)


def retype_strong(df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Cast columns to their declared types."""
    return _retyped(df, declared)[0]


def _widened(df: DataFrame, declared: Mapping[str, str]) -> dict[str, str]:
    current = dict(df.dtypes)
    return {name: wider_type(declared_type(current[name]), kind) for name, kind in declared.items() if name in current}


def retype_weak(df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Cast columns only where the declared type is wider."""
    return _retyped(df, _widened(df, declared))[0]


def apply_changes(df: DataFrame, declared: Mapping[str, str], strong: bool = False) -> tuple[DataFrame, ChangeReport]:
    """Add, remove and retype columns; returns the table and what changed."""
    added = [name for name in declared if name not in df.columns]
    removed = [name for name in df.columns if name not in declared and name not in FIXED_COLUMNS]
    wide = drop_extra_columns(add_missing_columns(df, declared), declared)
    result, changed = _retyped(wide, declared if strong else _widened(wide, declared))
    return result, ChangeReport(added, removed, changed)


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    if old not in df.columns:
        raise ValueError(f"no column {old!r}")
    return df.withColumnRenamed(old, new)


def retype_attribute(history: DataFrame, name: str, data_type: str, attributes: Sequence[str]) -> DataFrame:
    """Recast one attribute and recompute the hash."""
    return history.withColumn(name, F.col(name).cast(spark_type(data_type))).withColumn("hash", attribute_hash(attributes))


def evolve_attributes(
    history: DataFrame, declared: Mapping[str, str], base: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """History with missing attributes added and undeclared ones dropped, and its hash recomputed.

    Attributes whose type differs from the declaration are reported, not changed.
    """
    current = {name: declared_type(kind) for name, kind in history.dtypes}
    mismatched = [name for name, kind in declared.items() if name in current and current[name] != kind]
    table = drop_extra_columns(add_missing_columns(history, declared), declared, keep=base)
    arrays = [name for name, kind in declared.items() if kind.endswith("[]")]
    return table.withColumn("hash", attribute_hash(list(declared), arrays)), mismatched


def infer_schema(df: DataFrame, exclude: Sequence[str] = FIXED_COLUMNS) -> list[tuple[str, str, str, str]]:
    """``(name, data_type, time_aggregation, entity_aggregation)`` of a view's trend columns."""
    return [(name, declared_type(kind), "sum", "sum") for name, kind in df.dtypes if name not in exclude]
