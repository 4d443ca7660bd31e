"""Mixing sources to target weights along a curriculum.

Each source has a schedule: how its weight changes over the training run, as straight lines between knots on [0, 1].
Its integral is the source's cumulative token demand. A document takes the stretch of its source's token stream that
it fills; inverting the demand turns the middle of that stretch into a training position, and documents are
range-sorted by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.prefix import running_total
from tidegauge.session import cut_lineage

WEIGHTS = (5, 2, 1)
#: Per weight, its level at the knots 0, 1/2 and 1: the heaviest sources come early, the lightest late.
SCHEDULES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))
WORD = r"[^\x20\x09-\x0D]+"
REPEATS = 3
BUCKETS = 4096


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``source, source_size, turn, target`` from ``source, size``.

    Sources by code point, null last, take the weights in turn. Targets share the sum of all sizes by weight, but none
    is above ``repeats`` times its source's size; what is over goes to the others by weight. That is one water level:
    in order of size per weight, a source is full while the level computed from it on would overflow it.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy("fill", F.col("source").asc_nulls_last())
    upto, onward = (
        filling.rowsBetween(Window.unboundedPreceding, -1),
        filling.rowsBetween(Window.currentRow, Window.unboundedFollowing),
    )
    levels = (
        sums.withColumn("turn", F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights))))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("turn") + 1))
        .withColumn("room", F.col("source_size") * repeats)
        .withColumn("fill", F.col("room") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("room").over(upto), F.lit(0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(onward))
        .withColumn("open", F.col("level") <= F.col("fill"))
    )
    level = F.min(F.when(F.col("open"), F.struct("fill", "source", "level"))).over(Window.partitionBy())["level"]
    target = F.least(F.col("room").cast("double"), level * F.col("weight"))
    return levels.select("source", "source_size", "turn", F.coalesce(target, F.lit(0.0)).alias("target"))


def integrals(levels: Column) -> Column:
    """The schedule's integral up to each knot, from 0 on; ``levels`` are the weights at evenly spaced knots."""
    areas = F.transform(
        F.sequence(F.lit(1), F.size(levels) - 1),
        lambda i: (F.get(levels, i - 1) + F.get(levels, i)) / 2 / (F.size(levels) - 1),
    )
    return F.aggregate(
        areas, F.array(F.lit(0.0)), lambda ends, x: F.concat(ends, F.array(F.element_at(ends, -1) + x))
    )


def position_of(share: Column, levels: Column, ends: Column) -> Column:
    """The time at which the share of a source's demand is reached: the inverse of the schedule's integral.

    ``ends`` are its :func:`integrals`. Inside a stretch the weight is a + b t, the integral a parabola.
    """
    pieces = F.size(levels) - 1
    wanted = share * F.element_at(ends, -1)
    at = F.least(F.size(F.filter(ends, lambda e: e <= wanted)) - 1, pieces - 1)
    low, slope = F.get(levels, at), (F.get(levels, at + 1) - F.get(levels, at)) * pieces
    rest = wanted - F.get(ends, at)
    root = F.sqrt(F.greatest(low * low + 2 * slope * rest, F.lit(0.0)))
    return at / pieces + F.when(low + root == 0, 0.0).otherwise(2 * rest / (low + root))


def mix(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, repeats: int = REPEATS, key: str = "doc_id") -> DataFrame:
    """One row per input row: ``doc_id, size, source_size, target, taken, positions`` (and ``text_hash``).

    ``size`` counts the words of the text; null counts as empty. A source's stream is its documents in an order fixed by
    a hash of doc_id and text, read again from the start until the target is met: ``taken`` is the words a document
    gives in all, ``positions`` the time of each reading with its number of words, the last of which may be cut by the
    target. Null sources are one source. Rows that are equal in all are interchangeable. Empty documents take nothing.
    """
    row = docs.select(
        F.col(key).alias("doc_id"),
        F.col("source"),
        F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64("text").alias("text_hash"),
        F.xxhash64(key, "text").alias("draw"),
    )
    row = cut_lineage(row)
    levels = F.element_at(F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in schedules]), F.col("turn") + 1)
    targets = source_targets(row, weights, repeats).withColumn("levels", levels)
    # Written, so that the schedules are integrated once per source and not once per document.
    targets = cut_lineage(targets.withColumn("ends", integrals(F.col("levels"))))
    placed = running_total(
        row, "source", "size", ["draw", "doc_id", "size"], F.pmod(F.shiftright("draw", 8), F.lit(BUCKETS)), "before"
    )
    targets = targets.select(F.col("source").alias("_source"), "source_size", "target", "levels", "ends")
    placed = placed.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    demand = F.round("target").cast("long")

    def reading(i: Column) -> Column:
        start = i * F.col("source_size") + F.col("before")
        words = F.greatest(F.least(F.col("size"), demand - start), F.lit(0).cast("long"))
        share = F.least((start + words / 2) / F.greatest(F.col("target"), F.lit(1.0)), F.lit(1.0))
        return F.struct(i.cast("int").alias("epoch"), words.alias("words"), position_of(share, F.col("levels"), F.col("ends")).alias("position"))

    readings = F.filter(F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), reading), lambda x: x["words"] > 0)
    return placed.withColumn("positions", readings).select(
        "doc_id", "source", "size", "source_size", "target",
        F.aggregate("positions", F.lit(0).cast("long"), lambda a, x: a + x["words"]).alias("taken"),
        "positions", "text_hash",
    )


def in_training_order(df: DataFrame, position: str, *ties: str) -> DataFrame:
    """Range-sort by training position; rows without one come last."""
    first = F.col(position).asc_nulls_last()
    return df.repartitionByRange(first, *ties).sortWithinPartitions(first, *ties)


def schedule(docs: DataFrame, **options) -> DataFrame:
    """The documents in training order, one row per reading, with ``docs``' columns in their order.

    A reading that the target cuts below half of the document's words is left out, any other stays whole. Rows with
    the same doc_id, source and text are numbered and paired by number with what the mix gave each of them.
    """
    same = Window.partitionBy("_id", "_from", "_hash")
    mixed = mix(docs, **options).select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_from"), F.col("text_hash").alias("_hash"),
        F.col("size").alias("_size"), F.col("positions").alias("_positions"),
    )
    mixed = mixed.withColumn("_copy", F.row_number().over(same.orderBy(F.get("_positions", F.lit(0))["position"])))
    keyed = docs.withColumns(
        {"_id": F.col("doc_id"), "_from": F.col("source"), "_hash": F.xxhash64("text")}
    ).withColumn("_copy", F.row_number().over(same.orderBy("_hash")))
    m, k = mixed.alias("m"), keyed.alias("k")
    paired = k.join(
        m,
        F.col("k._hash").eqNullSafe(F.col("m._hash"))
        & F.col("k._id").eqNullSafe(F.col("m._id"))
        & F.col("k._from").eqNullSafe(F.col("m._from"))
        & (F.col("k._copy") == F.col("m._copy")),
    )
    kept = F.filter("_positions", lambda x: x["words"] * 2 >= F.col("_size"))
    readings = paired.select(*[F.col(f"k.`{n}`") for n in docs.columns], F.explode(kept).alias("_reading"))
    readings = readings.withColumn("_position", F.col("_reading.position")).withColumn("_epoch", F.col("_reading.epoch"))
    return in_training_order(readings, "_position", "doc_id").drop("_reading", "_position", "_epoch")
