"""Joins of records with dimensions, intervals and histories.

No join carries a broadcast hint: Catalyst broadcasts a side only when its size is known to
be below the session's threshold and otherwise shuffles, splitting hot keys at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import as_column, names
from tidegauge.functions.timeaxis import Interval
from tidegauge.operators.slices import (
    AUTO, bound_number, hot_keys, slice_count, slice_number, split_hot, time_bounds, with_last_known, with_previous,
)
from tidegauge.plans.spec import KEY

BIN = "__slice"


def at_timestamp(df: DataFrame, ts: Column) -> DataFrame:
    return df.filter(F.col("timestamp") == ts)


def salted_join(facts: DataFrame, dim: DataFrame, on, salts: int, how: str = "inner") -> DataFrame:
    """Equi-join that spreads every key of ``facts`` over ``salts`` tasks.

    For a key known to be hot where ``dim`` is too large to broadcast; ``dim`` is
    replicated ``salts`` times. ``how`` is inner or left, the kinds a copied right side allows.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("only the left side may be salted")
    keys = names(on)
    spread = facts.withColumn("__salt", F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int"))
    copies = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, [*keys, "__salt"], how).drop("__salt")


def entity_name_join(facts: DataFrame, entities: DataFrame) -> DataFrame:
    """Add the entity's name; filters on ``name`` reach the entity table."""
    return facts.join(entities.select(F.col("id").alias("entity_id"), "name"), "entity_id")


def relation_join(facts: DataFrame, relation: DataFrame) -> DataFrame:
    """Add the related target entity of each record."""
    return facts.join(relation.select(F.col("source_id").alias("entity_id"), "target_id"), "entity_id")


def relation_to_virtual(entities: DataFrame, virtual: DataFrame) -> DataFrame:
    """Relate every entity to the one virtual entity, such as a whole network.

    The virtual id is a scalar subquery; the job fails when ``virtual`` has more than one row, without any nothing is related.
    """
    target = virtual.select("id").scalar()
    related = entities.select(F.col("id").alias("source_id"), target.alias("target_id"))
    return related.filter(F.col("target_id").isNotNull()).distinct()


def valid_at(prefix: str, ts: str) -> Column:
    """Half-open validity: start <= ts < expires."""
    return (F.col(f"{prefix}.start") <= F.col(ts)) & (F.col(f"{prefix}.expires") > F.col(ts))


def exception_join(
    facts: DataFrame, exceptions: DataFrame, columns: Sequence[str], prefix: str = "exc_", slice_width=AUTO
) -> DataFrame:
    """Add the values of exceptions valid at the record's timestamp, NULL where there is none.

    Overlapping exceptions of an entity repeat the record. The entity is the equi-key and the validity a residual condition,
    so no pair of different entities is ever formed. Entities with more than their share of the records or of the
    exceptions are also cut into time bins, whose bounds are quantiles of the records' times and of the exceptions' own endpoints: a
    record lies in one bin, an exception in all it reaches into, so a bin has few records and only exceptions that hold
    throughout, all of which match, or few others. ``slice_width`` may also be a bin length for all entities, or None.
    """
    binned = [BIN] if BIN in exceptions.columns else []
    f, e = facts, exceptions.select("entity_id", "start", "expires", *columns, *binned)
    if slice_width is None:
        return validity_join(f, e, columns, prefix)
    if slice_width != AUTO:
        return validity_join(*_fixed_bins(f, e, Interval.of(slice_width).micros), columns, prefix).drop(BIN)
    ordinary, heavy, (bins,) = by_weight(f, [e])
    return validity_join(ordinary, e, columns, prefix).union(validity_join(heavy, bins, columns, prefix).drop(BIN))


def validity_join(records: DataFrame, valid: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    """The left join on entity and validity, and on the bin where both sides have one."""
    condition = (F.col("f.entity_id") == F.col("e.entity_id")) & valid_at("e", "f.timestamp")
    if BIN in records.columns and BIN in valid.columns:
        condition = condition & (F.col(f"f.{BIN}") == F.col(f"e.{BIN}"))
    kept = [F.col(f"f.`{name}`") for name in records.columns]
    added = [F.col(f"e.`{name}`").alias(prefix + name) for name in columns]
    return records.alias("f").join(valid.alias("e"), condition, "left").select(*kept, *added)


def _fixed_bins(f: DataFrame, e: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    low, high = f.agg(F.min("timestamp").alias("t")).scalar(), f.agg(F.max("timestamp").alias("t")).scalar()
    # Slices without records are left out, however long an exception lasts.
    bins = (
        e.withColumn("__from", F.greatest("start", low)).withColumn("__to", F.least("expires", high))
        .filter(F.col("__from") <= F.col("__to"))
        .withColumn(BIN, F.explode(F.sequence(slice_number("__from", width), slice_number("__to", width))))
    )
    return f.withColumn(BIN, slice_number("timestamp", width)), bins


def by_weight(f: DataFrame, exceptions: Sequence[DataFrame], slices: int | None = None) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Records of ordinary entities; those of entities with more than their share, with bins; and each of ``exceptions`` with bins.

    An entity's share counts by records and by endpoints of each table of exceptions; all get the same bins.
    """
    slices, key = slices or slice_count(f), ["entity_id"]
    ends = [e.select("entity_id", F.explode(F.array("start", "expires")).alias("timestamp")) for e in exceptions]
    measured = [f.select("entity_id", "timestamp"), *ends]
    either = None
    for rows in measured:
        found = hot_keys(rows, key, slices)
        either = found if either is None else either.union(found)
    either = either.distinct()
    count = len(measured) * slices
    common = time_bounds(measured, key, "timestamp", count)

    def number(at: str) -> str:
        return bound_number(f"unix_micros(CAST(`{at}` AS TIMESTAMP))", count)

    ordinary, heavy = split_hot(f, key, either)
    placed = heavy.withColumn("__bounds", common).selectExpr(*[f"`{c}`" for c in f.columns], f"{number('timestamp')} AS {BIN}")
    reached = []
    for e in exceptions:
        _, valid = split_hot(e.filter(F.col("start") < F.col("expires")), key, either)
        spans = f"explode(sequence({number('start')}, {number('expires')})) AS {BIN}"
        reached.append(valid.withColumn("__bounds", common).selectExpr(*[f"`{c}`" for c in e.columns], spans))
    return ordinary, placed, reached


def overlapping_exceptions(exceptions: DataFrame, width=AUTO) -> DataFrame:
    """Exceptions that start before the entity's previous one has expired.

    Sorted by start, exceptions overlap anywhere only if two neighbours do.
    """
    ordered = with_previous(exceptions, "entity_id", "start", "expires", "__previous", width)
    return ordered.filter(F.col("start") < F.col("__previous.value")).drop("__previous")


def as_of_latest(history: DataFrame, ts: Column | None = None, key: str = "entity_id") -> DataFrame:
    """Latest row per entity, at or before ``ts`` when given; (entity, timestamp) is unique.

    The latest timestamps are a hash aggregate over two fixed-width columns, combined map-side; the rows are fetched back by key
    and timestamp, so the wide columns are neither sorted nor carried through an aggregate.
    """
    rows = history if ts is None else history.filter(F.col("timestamp") <= ts)
    latest = rows.groupBy(F.col(key).alias("__key")).agg(F.max("timestamp").alias("__last"))
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.col("timestamp") == F.col("__last"))
    return rows.join(latest, same, "left_semi").select(*history.columns)


def as_of_join(
    facts: DataFrame, history: DataFrame, columns: Sequence[str], key: str = "entity_id", width=AUTO
) -> DataFrame:
    """Add to each record the attributes of the latest history row at or before its timestamp.

    Both inputs go through one shuffle as one sorted stream; see ``slices`` for hot entities.
    """
    fact_columns = facts.columns
    left = facts.select(key, "timestamp", F.struct(*fact_columns).alias("fact"))
    right = history.select(key, "timestamp", F.struct(*columns).alias("known"))
    stream = left.withColumn("turn", F.lit(1)).unionByName(
        right.withColumn("turn", F.lit(0)), allowMissingColumns=True
    )
    known = with_last_known(stream, key, "timestamp", "known", "as_of", ties=("turn",), width=width)
    return known.filter(F.col("turn") == 1).select(
        *[F.col(f"fact.{name}") for name in fact_columns], *[F.col(f"as_of.{name}") for name in columns]
    )


def join_parts(parts: Sequence[DataFrame], key: Sequence[str] = KEY) -> DataFrame:
    """Inner join of fact tables that share the (entity, timestamp) key."""
    joined, *rest = parts
    for part in rest:
        joined = joined.join(part, list(key))
    return joined


def dynamic_trend_data(parts: dict[str, DataFrame], entities: DataFrame, ts: Column, trends: Sequence[str]) -> DataFrame:
    """``(timestamp, entity_id, data[])`` of the named trends at one timestamp.

    Each trend is read from the first part that has it. Without names, every entity with an
    empty array.
    """
    number = "decimal(38,18)"
    if not trends:
        empty = F.array().cast(f"array<{number}>")
        return entities.select(ts.cast("timestamp_ntz").alias("timestamp"), F.col("id").alias("entity_id"), empty.alias("data"))
    wanted: dict[str, list[str]] = {}
    for trend in trends:
        part = next((name for name, df in parts.items() if trend in df.columns), None)
        if part is None:
            raise ValueError(f"no part has trend {trend!r}")
        wanted.setdefault(part, [])
        if trend not in wanted[part]:
            wanted[part].append(trend)
    slim = [at_timestamp(parts[name], ts).select(*KEY, *columns) for name, columns in wanted.items()]
    known = entities.select(F.col("id").alias("entity_id"))
    data = F.array(*[as_column(trend).cast(number) for trend in trends])
    return join_parts(slim).join(known, "entity_id").select("timestamp", "entity_id", data.alias("data"))
