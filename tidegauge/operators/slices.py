"""Ordered operators that survive a key holding a large share of all rows.

A plain window over ``key ORDER BY time`` sorts every row of a key in one task. Here the rows of a *hot* key are cut into
time slices; the window runs per (key, slice), and what has to travel between slices is carried by a second window over
*one row per slice*. Other keys are one slice, so they cost what a plain window costs; the join reuses the (key, slice)
partitioning, so the large input is shuffled once.

With ``width`` ``AUTO`` all of that is one plan, and building it runs nothing: a key is hot if it has more than its share, all rows /
``slices``, so there are fewer hot keys than slices; the slices' bounds are quantiles of the times of rows drawn by
hash, so that no (key, slice) has much more than that share either. Both are the same whenever they are computed again. The
input is read for its keys and times beside the rows themselves; hand in a written table where it is costly. ``width`` may
also be a slice length for all keys, or None for plain windows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.columns import names
from tidegauge.functions.timeaxis import Interval, epoch_micros

AUTO = "auto"
#: Slices at least; otherwise as many as the session has shuffle partitions. Rows drawn per slice for its bounds.
LEAST_SLICES, DRAWN = 64, 16
_SLICE = "__slice"


def slice_number(order: str, width_micros: int) -> Column:
    return F.floor(epoch_micros(order) / F.lit(width_micros)).cast("bigint")


def slice_count(df: DataFrame) -> int:
    return max(LEAST_SLICES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _quoted(names_: Sequence[str], prefix: str = "") -> list[str]:
    return [f"`{prefix}{name}`" for name in names_]


def _micros(order: str) -> str:
    return f"unix_micros(CAST(`{order}` AS TIMESTAMP))"


def hot_keys(df: DataFrame, keys: Sequence[str], slices: int) -> DataFrame:
    """Keys with more than 1 / ``slices`` of all rows, named with ``__hot_``; fewer than ``slices``."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.coalesce(F.sum("__n"), F.lit(0))).scalar()
    return counts.filter(F.col("__n") * slices > total).selectExpr(*[f"`{key}` AS `__hot_{key}`" for key in keys])


def time_bounds(tables: Sequence[DataFrame], keys: Sequence[str], order: str, slices: int) -> Column:
    """``slices - 1`` ascending times (microseconds) between any two of which no table has much more than its share of rows, as a
    scalar subquery. The share of a single table is one in ``slices``, that of n tables n times as many.

    They are quantiles of the rows with the smallest hashes, a fixed number per slice and table.
    """
    drawn = None
    for df in tables:
        times = df.selectExpr(*_quoted(keys), f"{_micros(order)} AS __at").filter("__at IS NOT NULL")
        hashed = F.expr(f"xxhash64({', '.join(_quoted(keys))}, __at)")
        own = times.orderBy(hashed, "__at", *keys).limit(DRAWN * slices).select("__at")
        drawn = own if drawn is None else drawn.unionByName(own)
    picked = f"transform(sequence(1, {slices - 1}), i -> get(at, CAST(floor(i * size(at) / {slices}) AS INT)))"
    return drawn.selectExpr("sort_array(collect_list(__at)) AS at").selectExpr(picked).scalar()


def bound_number(at: str, slices: int) -> str:
    """SQL text: how many of the ascending ``__bounds`` are at or before ``at``, by halving; 0 for null."""
    steps = ", ".join(str(1 << k) for k in reversed(range(slices.bit_length())))
    halve = "CASE WHEN get(__bounds, found + step - 1) <= " + at + " THEN found + step ELSE found END"
    return f"aggregate(array({steps}), 0, (found, step) -> {halve})"


def same_key(keys: Sequence[str], prefix: str) -> str:
    """SQL text: equal keys, null being one; the other side's are named with ``prefix``."""
    return " AND ".join(f"`{key}` <=> `{prefix}{key}`" for key in keys)


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of all other keys, and rows of the ``hot`` ones, which are fewer than there are slices."""
    named, same = F.broadcast(hot), F.expr(same_key(keys, "__hot_"))
    return df.join(named, same, "left_anti"), df.join(named, same, "left_semi")


def sliced_evenly(hot_rows: DataFrame, order: str, bounds: Column, slices: int) -> DataFrame:
    """Hot rows with the number of their slice."""
    number = f"CAST({bound_number(_micros(order), slices)} AS BIGINT) AS {_SLICE}"
    return hot_rows.withColumn("__bounds", bounds).selectExpr(*_quoted(hot_rows.columns), number)


def _by_heat(
    df: DataFrame, keys: list[str], order: str, width, plain: Callable[[DataFrame], DataFrame], sliced: Callable[[DataFrame], DataFrame],
    slices: int | None = None,
) -> DataFrame:
    """``plain`` of the rows of ordinary keys and ``sliced`` of the others, which have a slice number.

    Where no key is hot, Spark finds that out when it has counted, and drops the second branch before it runs.
    """
    if width is None:
        return plain(df)
    if width != AUTO:
        return sliced(df.withColumn(_SLICE, slice_number(order, Interval.of(width).micros)))
    slices = slices or slice_count(df)
    ordinary, warm = split_hot(df, keys, hot_keys(df, keys, slices))
    return plain(ordinary).union(sliced(sliced_evenly(warm, order, time_bounds([df], keys, order, slices), slices)))


def _carried_back(rows: DataFrame, carried: DataFrame, keys: list[str], columns: Sequence[str], name: str) -> DataFrame:
    """``columns``, and as ``name`` the rows' ``__local`` or else what was ``__carried`` to their (key, slice)."""
    named = carried.selectExpr(*[f"`{key}` AS `__to_{key}`" for key in [*keys, _SLICE]], "__carried")
    met = rows.join(named, F.expr(f"{same_key(keys, '__to_')} AND {_SLICE} = __to_{_SLICE}"), "left")
    return met.selectExpr(*_quoted(columns), f"coalesce(__local, __carried) AS `{name}`")


def _carried(
    df: DataFrame, key: list[str], order: str, width, local: Column, tail: Column,
    carry: Callable[[Column], Column], name: str, ties: Sequence[str] = (),
) -> DataFrame:
    def plain(rows: DataFrame) -> DataFrame:
        return rows.withColumn(name, local.over(Window.partitionBy(*key).orderBy(order, *ties)))

    def sliced(rows: DataFrame) -> DataFrame:
        per_slice = rows.groupBy(*key, _SLICE).agg(tail.alias("__tail"))
        earlier = Window.partitionBy(*key).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
        carried = per_slice.select(*key, _SLICE, carry(F.col("__tail")).over(earlier).alias("__carried"))
        window = Window.partitionBy(*key, _SLICE).orderBy(order, *ties)
        return _carried_back(rows.withColumn("__local", local.over(window)), carried, key, df.columns, name)

    return _by_heat(df, key, order, width, plain, sliced)


def with_previous(df: DataFrame, key, order: str, value: str, name: str = "previous", width=AUTO) -> DataFrame:
    """Add the value of the row before this one in ``order`` as a struct (NULL for the first row)."""
    keys = names(key)
    boxed = F.struct(F.col(value).alias("value"))
    return _carried(
        df, keys, order, width, local=F.lag(boxed), tail=F.max_by(boxed, order),
        carry=lambda tail: F.last(tail, ignorenulls=True), name=name,
    )


def with_last_known(
    df: DataFrame, key, order: str, value: str, name: str, ties: Sequence[str] = (), width=AUTO
) -> DataFrame:
    """Add the latest non-NULL ``value`` at or before this row."""
    keys = names(key)
    at = F.when(F.col(value).isNotNull(), F.col(order))
    return _carried(
        df, keys, order, width, local=F.last(value, ignorenulls=True), tail=F.max_by(value, at),
        carry=lambda tail: F.last(tail, ignorenulls=True), name=name, ties=ties,
    )


def with_run_start(df: DataFrame, key, order: str, value: str, name: str = "run", width=AUTO) -> DataFrame:
    """Add the ``order`` at which the row's run of equal consecutive values started.

    Inside a slice a run starts where the value differs from the row before. Whether the first
    row of a slice starts one, and where a run reaching into the slice began, follows from the
    slices' first and last values, one row each.
    """
    keys = names(key)
    boxed = F.struct(F.col(value).alias("value"))
    before = F.col("__before")
    changed = F.coalesce(F.col(value) != before["value"], F.lit(False))

    def plain(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(order)
        marked = rows.withColumn("__before", F.lag(boxed).over(window)).withColumn(
            "__start", F.when(changed | before.isNull(), F.col(order))
        )
        return marked.select(*df.columns, F.max("__start").over(window).alias(name))

    def sliced(rows: DataFrame) -> DataFrame:
        on = ", ".join(_quoted(keys))
        inside = f"PARTITION BY {on}, {_SLICE} ORDER BY `{order}`"
        boxed_ = f"struct(`{value}` AS value)"
        marked = rows.selectExpr("*", f"lag({boxed_}) OVER ({inside}) AS __before").selectExpr(
            "*", f"CASE WHEN `{value}` <> __before.value THEN `{order}` END AS __start"
        )
        per_slice = marked.groupBy(*keys, _SLICE).agg(
            F.expr(f"min(`{order}`) AS begin"), F.expr(f"min_by({boxed_}, `{order}`) AS head"), F.expr(f"max_by({boxed_}, `{order}`) AS tail"),
            F.expr("max(__start) AS last_start"),
        )
        across = f"PARTITION BY {on} ORDER BY {_SLICE}"
        opened = per_slice.selectExpr("*", f"lag(tail) OVER ({across}) AS before_tail").selectExpr(
            "*", "CASE WHEN before_tail IS NULL OR coalesce(head.value <> before_tail.value, false) THEN begin END AS opened"
        )
        earlier = f"max(coalesce(last_start, opened)) OVER ({across} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        heads = opened.selectExpr(*_quoted([*keys, _SLICE]), f"coalesce(opened, {earlier}) AS __carried")
        local = marked.selectExpr("*", f"max(__start) OVER ({inside}) AS __local")
        return _carried_back(local, heads, keys, df.columns, name)

    return _by_heat(df, keys, order, width, plain, sliced)
