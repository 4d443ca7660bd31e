"""Names for columns an operator carries along, so that tables may use the names it needs itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def held_aside(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, list[str]]:
    """``docs`` with ``text`` and the columns of ``keep`` under names of their own, and those names in order.

    ``text`` keeps its name and is there once, also if it isn't kept.
    """
    names = [k if k == "text" else f"_kept{i}" for i, k in enumerate(keep)]
    columns = [F.col(quoted(k)).alias(n) for k, n in zip(keep, names, strict=True)]
    return docs.select(*columns, *([] if "text" in keep else [F.col("text")])), names


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, with underscores before it until no column has the name."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted
