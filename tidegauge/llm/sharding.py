"""Sharding by fixed virtual slots: records hash into thousands of slots, slots map to shards.

The map is a small table with versions. Version 1 deals slots out in turn; rebalancing measures the bytes of each
slot and writes the next version, in which only those slots moved that their shard had no room for.
Everything is DataFrame expressions; what is folded into one row is one entry per slot, a fixed number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.session import cut_lineage

SLOTS = 4096
#: Copies of a row that are numbered in one array.
COPIES = 1 << 16


def slot_of(*key: Column, slots: int = SLOTS) -> Column:
    """The virtual slot of a record; depends on its key only, null keys included."""
    return F.pmod(F.xxhash64(*key), F.lit(slots)).cast("int")


def slot_totals(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``virtual_slot, bytes, records`` for every slot, empty ones included. ``records`` has ``virtual_slot, size``."""
    totals = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("records"))
    every = records.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(totals, "virtual_slot", "left").fillna(0, ["bytes", "records"])


class SlotMap:
    """The versions of a slot-to-shard map below ``folder``: ``version, virtual_slot, shard``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _write(self, table: DataFrame, version: int) -> None:
        table.select("virtual_slot", "shard").coalesce(1).write.parquet(f"{self.folder}/version={version}")

    def version(self, number: int) -> DataFrame:
        return self.spark.read.schema("virtual_slot int, shard int").parquet(f"{self.folder}/version={number}")

    def create(self, shards: int, slots: int = SLOTS) -> DataFrame:
        """Version 1: slots dealt out in turn."""
        slot = F.col("id").cast("int")
        self._write(self.spark.range(slots).select(slot.alias("virtual_slot"), F.pmod(slot, F.lit(shards)).alias("shard")), 1)
        return self.version(1)

    def rebalance(self, number: int, totals: DataFrame, shards: int) -> DataFrame:
        """The version after ``number``: near-equal bytes per shard, few slots moved.

        From the largest slot to the smallest, a slot stays if its shard then has at most the mean, else it goes to the
        shard with the fewest bytes. ``shards`` may differ from before; slots of a shard that is gone move.
        """
        self._write(rebalanced(self.version(number), totals, shards), number + 1)
        return self.version(number + 1)


def rebalanced(current: DataFrame, totals: DataFrame, shards: int) -> DataFrame:
    entries = (
        current.join(totals, "virtual_slot")
        .agg(
            F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "virtual_slot", "shard"))).alias("slots"),
            F.sum("bytes").alias("total"),
        )
        .withColumn("mean", F.col("total") / shards)
    )
    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"),
        F.array().cast("array<struct<virtual_slot:int,shard:int>>").alias("chosen"),
    )

    def put(state: Column, slot: Column) -> Column:
        loads, size = state["loads"], -slot["less"]
        least = (F.array_position(loads, F.array_min(loads)) - 1).cast("int")
        room = (slot["shard"] < shards) & (F.get(loads, slot["shard"]) + size <= F.col("mean"))
        shard = F.when(room, slot["shard"]).otherwise(least)
        return F.struct(
            F.transform(loads, lambda load, i: load + F.when(i == shard, size).otherwise(F.lit(0).cast("long"))).alias("loads"),
            F.concat(state["chosen"], F.array(F.struct(slot["virtual_slot"].alias("virtual_slot"), shard.alias("shard")))).alias("chosen"),
        )

    return entries.select(F.explode(F.aggregate("slots", start, put)["chosen"]).alias("x")).select("x.virtual_slot", "x.shard")


def shard_documents(docs: DataFrame, shards: int, folder: str, slots: int = SLOTS) -> DataFrame:
    """Put every document into one of ``shards`` shards of near-equal bytes; one row per input row.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot``. ``size`` is the UTF-8 bytes of the
    text plus 1; a null text counts as empty. ``slot`` is the record's place in its shard, 0 to the shard's count - 1, by
    virtual slot, then doc_id, checksum, size and number of the copy. The law is ``bytes``, so
    ``grown_shard`` is null. The virtual slot follows from the whole record and, for equal rows, the number of the
    copy, so no id fills a slot. No rows give no rows. Other columns are not read. Both map versions stay below ``folder``.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    record = ("doc_id", "size", "text_crc32", "copy")
    # Rows that are equal in all of these differ in their copy number only, so repeated rows and null ids spread over all slots.
    records = cut_lineage(
        docs.select(
            F.col("doc_id"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        )
        .groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("first", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"), F.lit(COPIES).cast("long"))))
        .withColumn("copy", F.explode(F.sequence("first", F.least("copies", F.col("first") + COPIES - 1))))
        .select("doc_id", "size", "text_crc32", "copy", slot_of(*map(F.col, record), slots=slots).alias("virtual_slot"))
    )
    totals = cut_lineage(slot_totals(records, slots).coalesce(1))
    table = SlotMap(spark, folder)
    table.create(shards, slots)
    placed = table.rebalance(1, totals, shards).join(totals, "virtual_slot")
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.select(
        "virtual_slot", "shard", F.coalesce(F.sum("records").over(before), F.lit(0)).alias("first")
    )
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "copy")
    return records.join(F.broadcast(placed), "virtual_slot").select(  # one row per virtual slot
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first") + F.row_number().over(inside) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )
