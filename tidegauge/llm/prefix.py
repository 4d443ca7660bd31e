"""Running totals over groups of any size, in two levels so that no task holds a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(df: DataFrame, group: str, amount: str, order: list[str], bucket: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``amount`` over the rows of the same ``group`` before this one.

    Rows are ordered by ``bucket``, then by ``order``. A window holds one bucket of one group; the totals before a
    bucket come from a second window over at most one row per bucket. Null is a group of its own. Rows that tie in
    all of ``order`` follow one another in any way.
    """
    df = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy(group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(F.col(group).alias("_group"), F.col("_bucket").alias("_at")).agg(F.sum(amount).alias("_sum"))
    across = Window.partitionBy("_group").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_group", "_at", F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_before"))
    return (
        df.join(before, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_bucket") == F.col("_at")))
        .withColumn(name, F.col("_before") + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .drop("_group", "_at", "_before", "_bucket")
    )
