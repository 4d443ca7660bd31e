"""Column helpers shared by all modules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Col = Column | str


def as_column(value: Col) -> Column:
    return F.col(value) if isinstance(value, str) else value


def names(value: str | Iterable[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def other_columns(df: DataFrame, excluded: Iterable[str]) -> list[str]:
    skip = set(excluded)
    return [name for name in df.columns if name not in skip]
