"""Delimited files: reading, routing to parts, typed values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.arrays import parse_array_literal
from tidegauge.functions.columns import other_columns
from tidegauge.functions.timeaxis import NTZ
from tidegauge.functions.types import parse_lenient, parse_strict, spark_type
from tidegauge.plans.spec import KEY, TrendStorePart

LINE = "line"


@dataclass(frozen=True)
class DelimitedFormat:
    """How a file is laid out.

    Columns come from the header, or from ``columns`` for a file without one; the entity and
    timestamp columns are then called ``entity`` and ``timestamp``.
    """

    entity_column: str = "entity"
    timestamp_column: str = "timestamp"
    columns: Sequence[str] | None = None
    separator: str = ","
    null_token: str = ""
    array_prefix: str = "{"
    array_postfix: str = "}"
    quote: str = '"'
    #: Whether quoted cells may hold line breaks; a file is then read by one task.
    multi_line: bool = False


def check_columns(names: Sequence[str], layout: DelimitedFormat) -> None:
    for wanted in (layout.entity_column, layout.timestamp_column):
        if wanted not in names:
            raise ValueError(f"column {wanted!r} is missing from the file")


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def read_delimited(spark: SparkSession, path: str, layout: DelimitedFormat = DelimitedFormat()) -> DataFrame:
    """Rows ``entity, timestamp, line, <text columns>``; RFC 3339 timestamps become UTC.

    Empty cells become empty text so that the null token decides what is NULL; a row with too
    few or too many cells fails the job. A quote inside a quoted cell is doubled. ``line`` orders rows by file name, then as they
    stand in the file.
    """
    options = {
        "sep": layout.separator, "mode": "FAILFAST", "enforceSchema": "false",
        "quote": layout.quote, "escape": layout.quote, "multiLine": str(layout.multi_line).lower(),
    }
    reader = spark.read.options(**options)
    if layout.columns is None:
        raw = reader.csv(path, header=True)
    else:
        raw = reader.csv(path, header=False, schema=text_schema(layout.columns))
    check_columns(raw.columns, layout)
    # Ids grow inside a task, and a task reads a block of a file from front to back.
    line = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return named_rows(raw.select("*", line.alias(LINE)), layout)


def named_rows(raw: DataFrame, layout: DelimitedFormat) -> DataFrame:
    values = other_columns(raw, [layout.entity_column, layout.timestamp_column, LINE])
    line = [LINE] if LINE in raw.columns else []
    return raw.select(
        F.col(layout.entity_column).alias("entity"),
        F.col(layout.timestamp_column).cast("timestamp").cast(NTZ).alias("timestamp"),
        *line,
        *[F.coalesce(F.col(name), F.lit("")).alias(name) for name in values],
    )


def route_columns(rows: DataFrame, parts: Mapping[str, Sequence[str]], key: Sequence[str] = KEY) -> dict[str, DataFrame]:
    """Rows per part with the part's trends; a trend of several parts goes to each of them.

    Columns no part knows are ignored, and so are parts without any column in the file.
    """
    line = [LINE] if LINE in rows.columns else []
    routed = {}
    for part, trends in parts.items():
        matched = [name for name in rows.columns if name in set(trends)]
        if matched:
            routed[part] = rows.select(*key, *line, *matched)
    return routed


def typed_columns(
    rows: DataFrame, types: Mapping[str, str], layout: DelimitedFormat = DelimitedFormat(), lenient: bool = False
) -> DataFrame:
    """Text columns parsed to their declared types.

    Strict parsing fails the job on a bad value, lenient parsing makes it NULL.
    """
    values = {}
    for name, kind in types.items():
        if name not in rows.columns:
            continue
        if kind.endswith("[]"):
            element = spark_type(kind).removeprefix("array<").removesuffix(">")
            values[name] = parse_array_literal(name, element, ",", layout.array_prefix, layout.array_postfix)
        else:
            values[name] = parse_lenient(name, kind) if lenient else parse_strict(name, kind, layout.null_token)
    return rows.withColumns(values) if values else rows


def part_batch(rows: DataFrame, part: TrendStorePart, layout: DelimitedFormat = DelimitedFormat(), lenient: bool = False) -> DataFrame | None:
    """The rows of one part, typed; None when the file has none of its trends."""
    routed = route_columns(rows, {part.name: part.trend_names})
    if part.name not in routed:
        return None
    return typed_columns(routed[part.name], {trend.name: trend.data_type for trend in part.trends}, layout, lenient)


def package_batch(rows: DataFrame, timestamp: Column, trends: Sequence[str]) -> DataFrame:
    """Rows of a package (``entity_id, values[]`` in the order of ``trends``), all of one timestamp."""
    values = [F.get("values", F.lit(index)).alias(name) for index, name in enumerate(trends)]
    return rows.select("entity_id", timestamp.alias("timestamp"), *values)
