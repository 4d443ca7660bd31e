"""Declared data types: order, widening, parsing and coercion."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.functions.arrays import array_to_text
from tidegauge.functions.columns import Col, as_column

# Declared type names from narrow to wide.
TYPE_ORDER = (
    "smallint",
    "integer",
    "bigint",
    "real",
    "double precision",
    "numeric",
    "timestamp without time zone",
    "smallint[]",
    "integer[]",
    "numeric[]",
    "text[]",
    "text",
)

SPARK_TYPES = {
    "boolean": "boolean",
    "smallint": "smallint",
    "integer": "int",
    "bigint": "bigint",
    "real": "float",
    "double precision": "double",
    "numeric": "decimal(38,18)",
    "timestamp": "timestamp_ntz",
    "timestamp without time zone": "timestamp_ntz",
    "text": "string",
    "text[]": "array<string>",
    "smallint[]": "array<smallint>",
    "integer[]": "array<int>",
    "numeric[]": "array<decimal(38,18)>",
}

INTEGER_TYPES = ("smallint", "integer", "bigint")
NUMERIC_TYPES = (*INTEGER_TYPES, "real", "double precision", "numeric")


_PRECISE = re.compile(r"numeric\((\d+)(?:,\s*(\d+))?\)(\[\])?")


def spark_type(declared: str) -> str:
    """The Spark type of a declared one. ``numeric(p, s)`` keeps its precision and scale; plain ``numeric`` holds 20 whole and 18
    decimal digits, so declare the precision of anything wider."""
    if precise := _PRECISE.fullmatch(declared):
        precision, scale = int(precise[1]), int(precise[2] or 0)
        if not 0 <= scale <= precision <= 38 or not precision:
            raise ValueError(f"unsupported data type: {declared}")
        return f"array<decimal({precision},{scale})>" if precise[3] else f"decimal({precision},{scale})"
    try:
        return SPARK_TYPES[declared]
    except KeyError:
        raise ValueError(f"unsupported data type: {declared}") from None


def base_type(declared: str) -> str:
    """The declared type without precision."""
    return re.sub(r"^numeric\([\d, ]*\)", "numeric", declared)


def declared_type(spark_name: str) -> str:
    """Declared name of a Spark type as given by ``DataType.simpleString()``."""
    if spark_name.startswith("decimal"):
        return "numeric"
    if spark_name.startswith("array<decimal"):
        return "numeric[]"
    names = {spark: name for name, spark in SPARK_TYPES.items() if name != "timestamp"}
    return {"timestamp": "timestamp without time zone", **names}.get(spark_name, "text")


def data_type_order(name: Col) -> Column:
    """Rank of a type name; NULL stays NULL and an unknown name raises."""
    column = F.regexp_replace(as_column(name), r"^numeric\([\d, ]*\)", "numeric")
    ranks = F.create_map(*[F.lit(x) for pair in zip(TYPE_ORDER, range(1, 13)) for x in pair])
    unknown = F.raise_error(F.concat(F.lit("unsupported data type: "), column)).cast("int")
    return F.when(column.isNotNull(), F.coalesce(F.try_element_at(ranks, column), unknown))


def greatest_data_type(left: Col, right: Col) -> Column:
    """The wider of two type names; the first on a tie or where one side is NULL."""
    a, b = as_column(left), as_column(right)
    return F.when(data_type_order(b) > data_type_order(a), b).otherwise(a)


def wider_type(left: str, right: str) -> str:
    """Driver-side twin of :func:`greatest_data_type` for schema work."""
    return right if TYPE_ORDER.index(base_type(right)) > TYPE_ORDER.index(base_type(left)) else left


def is_integer(text: Col) -> Column:
    """True for a positive whole number without leading zero."""
    return as_column(text).rlike("^[1-9][0-9]*$")


def parse_strict(text: Col, declared: str, null_token: str = "") -> Column:
    """The null token becomes NULL; any other text must parse or the job fails."""
    column = as_column(text)
    return F.when(column != null_token, column).cast(spark_type(declared))


def parse_lenient(text: Col, declared: str) -> Column:
    """Numeric text that does not parse becomes NULL."""
    return as_column(text).try_cast(spark_type(declared))


# Conversions the loader supports between declared types.
COERCIONS = frozenset(
    {(source, target) for source in NUMERIC_TYPES for target in NUMERIC_TYPES} - {("double precision", "real")}
    | {("text", "text"), ("text[]", "text[]"), ("text[]", "text"), ("timestamp", "timestamp")}
)

_WRAP = {"integer": 1 << 32, "smallint": 1 << 16}


def coerce(value: Col, source: str, target: str) -> Column:
    """Convert between declared types; an unsupported pair is refused when the plan is built.

    bigint to integer wraps around; a real number out of an integer's range becomes NULL.
    """
    if (base_type(source), base_type(target)) not in COERCIONS:
        raise ValueError(f"cannot convert {source} to {target}")
    column = as_column(value)
    if source == "text[]" and target == "text":
        return array_to_text(column)
    if source in INTEGER_TYPES and target in _WRAP:
        span = _WRAP[target]
        half = F.lit(span // 2)
        wide = column.cast("bigint")
        wrapped = F.when(wide.between(-half, half - 1), wide).otherwise(
            F.pmod(wide, F.lit(span)) - F.when(F.pmod(wide, F.lit(span)) >= half, F.lit(span)).otherwise(0)
        )
        return wrapped.cast(spark_type(target))
    return column.try_cast(spark_type(target))
