"""The logical tables of the library, derived from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.timeaxis import ceil_to_granularity, floor_to_granularity, plus

MONEY = "decimal(18,2)"
TOTAL = "decimal(38,2)"


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def total(column: str) -> Column:
    return F.sum(F.col(column).cast(MONEY)).cast(TOTAL)


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def fact_15m(self) -> DataFrame:
        """``entity_id, timestamp, value, samples`` per quarter of an hour."""
        return self.events.groupBy(
            F.col("user_id").alias("entity_id"), ceil_to_granularity("ts", "15m").alias("timestamp")
        ).agg(total("value").alias("value"), F.count(F.lit(1)).alias("samples"))

    @property
    def fact_1d(self) -> DataFrame:
        """``entity_id, timestamp, quantity, price, samples`` per day."""
        return self.lineitem.groupBy(
            F.col("l_suppkey").alias("entity_id"),
            plus(floor_to_granularity("l_shipdate", "1d"), "1d").alias("timestamp"),
        ).agg(
            total("l_quantity").alias("quantity"), total("l_extendedprice").alias("price"),
            F.count(F.lit(1)).alias("samples"),
        )

    @property
    def records_15m(self) -> DataFrame:
        """One record per event with its quarter-hour label and kind."""
        return self.events.select(
            F.col("user_id").alias("entity_id"), ceil_to_granularity("ts", "15m").alias("timestamp"),
            F.col("event_type").alias("part"), F.col("value").cast(MONEY).alias("value"), "event_id", "ts",
        )

    @property
    def history(self) -> DataFrame:
        """Attribute history with the one attribute ``event_type``."""
        return self.events.select(
            F.col("event_id").alias("id"), F.col("ts").alias("first_appearance"), F.col("ts").alias("modified"),
            F.md5(F.col("event_type")).alias("hash"), F.col("user_id").alias("entity_id"),
            F.col("ts").alias("timestamp"), F.lit(None).cast("timestamp_ntz").alias("end"), "event_type",
        )

    @property
    def modified_log(self) -> DataFrame:
        return self.events.select(
            F.col("event_id").alias("id"), F.col("event_type").alias("part"),
            ceil_to_granularity("ts", "15m").alias("timestamp"), F.col("ts").alias("modified"),
        )

    @property
    def modified(self) -> DataFrame:
        return self.modified_log.groupBy("part", "timestamp").agg(
            F.min("modified").alias("first"), F.max("modified").alias("last")
        )

    @property
    def suppliers(self) -> DataFrame:
        return self.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))

    @property
    def customers(self) -> DataFrame:
        return self.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))

    @property
    def supplier_nation(self) -> DataFrame:
        return self.supplier.select(F.col("s_suppkey").alias("source_id"), F.col("s_nationkey").alias("target_id"))

    @property
    def customer_nation(self) -> DataFrame:
        return self.customer.select(F.col("c_custkey").alias("source_id"), F.col("c_nationkey").alias("target_id"))

    @property
    def exceptions(self) -> DataFrame:
        """Threshold exceptions of every tenth entity."""
        return self.customer.filter(F.col("c_custkey") % 10 == 0).select(
            F.col("c_custkey").alias("entity_id"), at("2024-01-10 00:00:00").alias("start"),
            at("2024-01-20 00:00:00").alias("expires"), F.lit("200").cast(MONEY).alias("max_value"),
        )


Q15 = "make_timestamp(CAST(ceil(epoch_us(ts) / 9e8) AS BIGINT) * 900000000)"

# Common table expressions matching the properties above.
F15 = f"""f15 AS (
    SELECT user_id AS entity_id, {Q15} AS "timestamp",
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS value, count(*) AS samples
    FROM events GROUP BY 1, 2)"""
D1 = """d1 AS (
    SELECT l_suppkey AS entity_id, date_trunc('day', l_shipdate) + INTERVAL 1 DAY AS "timestamp",
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS quantity,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS price, count(*) AS samples
    FROM lineitem GROUP BY 1, 2)"""
REC = f"""rec AS (
    SELECT user_id AS entity_id, {Q15} AS "timestamp", event_type AS part,
           CAST(value AS DECIMAL(18,2)) AS value, event_id, ts FROM events)"""
HIST = """hist AS (
    SELECT event_id AS id, ts AS first_appearance, ts AS modified, md5(event_type) AS hash, user_id AS entity_id,
           ts AS "timestamp", CAST(NULL AS TIMESTAMP) AS "end", event_type FROM events)"""
LOG = f"""log AS (SELECT event_id AS id, event_type AS part, {Q15} AS "timestamp", ts AS modified FROM events)"""
MOD = f"""{LOG},
    modified AS (SELECT part, "timestamp", min(modified) AS "first", max(modified) AS "last" FROM log GROUP BY 1, 2)"""
EXC = """exc AS (
    SELECT c_custkey AS entity_id, TIMESTAMP '2024-01-10 00:00:00' AS "start",
           TIMESTAMP '2024-01-20 00:00:00' AS expires, CAST(200 AS DECIMAL(18,2)) AS max_value
    FROM customer WHERE c_custkey % 10 = 0)"""
