"""Scalar and array functions; everything stays in built-in JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.functions.columns import Col, as_column


def safe_division(numerator: Col, denominator: Col, on_zero: Col | None = None, *, integral: bool = False) -> Column:
    """``numerator / denominator``; division by zero gives ``on_zero`` (default NULL).

    ``integral=True`` is for two integer columns, whose quotient is truncated.
    """
    n, d = as_column(numerator), as_column(denominator)
    divisor = F.nullif(d, F.lit(0))
    quotient = F.call_function("div", n, divisor) if integral else n / divisor
    if on_zero is None:
        return quotient
    return F.when(d == 0, as_column(on_zero)).otherwise(quotient)


def _zip_shortest(left: Col, right: Col, combine) -> Column:
    a, b = as_column(left), as_column(right)
    length = F.least(F.size(a), F.size(b))
    return F.zip_with(F.slice(a, F.lit(1), length), F.slice(b, F.lit(1), length), combine)


def _nonempty(array: Column) -> Column:
    return F.when(F.size(array) > 0, array)


def add_array(left: Col, right: Col) -> Column:
    """Element-wise sum over the shorter length; NULL when either side is NULL."""
    return _nonempty(_zip_shortest(left, right, lambda x, y: x + y))


def divide_array(array: Col, divisor: Col, *, integral: bool = False) -> Column:
    """Element-wise division by another array; a zero divisor gives a NULL element."""
    return _nonempty(_zip_shortest(array, divisor, lambda x, y: safe_division(x, y, integral=integral)))


def divide_array_by(array: Col, scalar: Col, *, integral: bool = False) -> Column:
    """Every element divided by one scalar; division by zero raises."""
    divisor = as_column(scalar)
    if integral:
        return _nonempty(F.transform(as_column(array), lambda x: F.call_function("div", x, divisor)))
    return _nonempty(F.transform(as_column(array), lambda x: x / divisor))


def array_sum(array: Col, data_type: str) -> Column:
    """Sum of the non-NULL elements as ``data_type``; NULL when there are none."""
    present = F.filter(as_column(array), lambda x: x.isNotNull())
    total = F.aggregate(present, F.lit(0).cast(data_type), lambda acc, x: (acc + x).cast(data_type))
    return F.when(F.size(present) > 0, total)


def array_to_text(array: Col) -> Column:
    """Elements joined by a comma; NULL elements are left out."""
    return F.array_join(as_column(array), ",")


def to_pdf(text: Col) -> Column:
    """Comma-separated counts to an integer array; an empty item is NULL, an empty text is NULL."""
    column = as_column(text)
    items = F.transform(F.split(column, ","), lambda x: F.nullif(x, F.lit("")).cast("int"))
    return F.when(column != "", items)


def to_array(value: Col) -> Column:
    """One-element array; NULL stays NULL."""
    column = as_column(value)
    return F.when(column.isNotNull(), F.array(column))


def parse_array_literal(
    text: Col, data_type: str, separator: str = ",", prefix: str = "{", postfix: str = "}"
) -> Column:
    """Cell such as ``{0,0,5}`` to an array; unparsable elements are NULL."""
    column = as_column(text)
    start = F.lit(len(prefix) + 1)
    body = F.substring(column, start, F.length(column) - len(prefix) - len(postfix))
    items = F.split(body, F.lit("\\Q" + separator + "\\E"))
    wrapped = column.startswith(prefix) & column.endswith(postfix)
    empty = F.array().cast(f"array<{data_type}>")
    parsed = F.when(body == "", empty).otherwise(F.transform(items, lambda x: F.trim(x).try_cast(data_type)))
    return F.when(wrapped, parsed)


def null_timestamp() -> Column:
    """Placeholder used where a numeric column is redeclared as a timestamp."""
    return F.lit(None).cast("timestamp_ntz")
