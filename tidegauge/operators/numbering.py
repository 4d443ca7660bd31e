"""Gap-free numbering without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.columns import names
from tidegauge.functions.fingerprints import stamp

#: Hex digits of the md5 that name a range, at least; each range is one task's sort.
_DIGITS = 3
_MOST_DIGITS = 5


def key_hash(texts: list[Column]) -> Column:
    return F.md5(F.concat_ws("|", *texts))


def range_digits(partitions: int) -> int:
    """Leading hex digits that cut all md5 values into four ranges or more per partition; bounded, so are the ranges."""
    digits = _DIGITS
    while 16**digits < 4 * partitions and digits < _MOST_DIGITS:
        digits += 1
    return digits


def next_id(existing: DataFrame, column: str = "id") -> Column:
    """Largest id in use (0 for an empty table) as a scalar subquery."""
    return existing.select(F.coalesce(F.max(column), F.lit(0)).cast("bigint").alias("last")).scalar()


def with_dense_ids(df: DataFrame, key, after: Column | int = 0, name: str = "id", digits: int | None = None) -> DataFrame:
    """Number rows with distinct ``key`` consecutively from ``after + 1``, in the order of the keys' md5 (then the keys).

    The md5 values are cut into ranges, rows are ranked inside their range and shifted by the sizes of the ranges before.
    Ranges are leading digits of the same order, so the ids are the same for any number of them; ``digits`` follows the
    session's shuffle partitions. A recomputed task assigns the same ids; the only unpartitioned window runs over one
    row per range.
    """
    keys = names(key)
    start = F.lit(after) if isinstance(after, int) else after
    digits = digits or range_digits(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    texts = [stamp(key) if kind.startswith("timestamp") else F.col(key).cast("string")
             for key in keys for kind in [df.schema[key].dataType.simpleString()]]
    hashed = df.withColumn("__hash", key_hash(texts)).withColumn("__range", F.substring("__hash", 1, digits))
    sizes = hashed.groupBy("__range").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    rank = F.row_number().over(Window.partitionBy("__range").orderBy("__hash", *keys))
    return (
        hashed.withColumn("__rank", rank)
        .join(offsets, "__range")
        .withColumn(name, (start + F.col("__offset") + F.col("__rank")).cast("bigint"))
        .drop("__range", "__hash", "__rank", "__offset")
    )
