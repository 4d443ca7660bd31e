"""The queries of this subpackage over the test tables, and their comparison SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import bktree, bytepairs, covertree, filteraudit, graphsearch, licences, metricjoin, mixing, quality, sharding, styletree, toxicity, turnrepair
from tidegauge.llm.shipping import ship
from tidegauge.session import configure, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
RANKS = "byte_bpe_multi_50k.tiktoken"


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = lambda spark, folder: build(ship(configure(spark)), folder)
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return styletree.extract(table(spark, folder, "pages"))


@query
def op2_byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    return bytepairs.digest(bytepairs.round_trip(table(spark, folder, "documents"), path, public_tokenizers.PATTERN))


@query
def op3_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(table(spark, folder, "documents"))
    return found.withColumn("licenses", F.array_join(F.array_sort("licenses"), ","))


@query
def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"), 16, scratch_path(spark, "slot-map"))


@query
def op7_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return covertree.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents")).withColumn("position", F.get("positions", F.lit(0))["position"])
    columns = ["doc_id", "size", "source_size", "target", "taken", "position"]
    return mixing.in_training_order(mixed.select(*columns), "position", "doc_id")


def _verdicts(scored: DataFrame, least: float) -> DataFrame:
    predicted = (F.col("score") >= least).cast("int").alias("predicted")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted)


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    return _verdicts(toxicity.score(docs, model, ["doc_id"]), 0.5)


@query
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.train(docs, table(spark, folder, "labels"))
    return _verdicts(quality.score(docs, model, ["doc_id"]), 0.3)


@query
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return metricjoin.linked_components(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op10_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return graphsearch.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filteraudit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op12_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return bktree.near_copies(table(spark, folder, "documents"))


@query
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turnrepair.damaged_and_repaired(table(spark, folder, "conversations"))


SQL["op11_filter_audit"] = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part,
    (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
      + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
      + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first_id, false)::INT AS mask,
    count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM texts LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS b),
orders AS (
  SELECT v.l || w.l || x.l || y.l || z.l AS filter_order, [v.b, w.b, x.b, y.b, z.b] AS bits
  FROM letters v, letters w, letters x, letters y, letters z WHERE v.b + w.b + x.b + y.b + z.b = 31
    AND len(list_distinct([v.b, w.b, x.b, y.b, z.b])) = 5),
places AS (
  SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM orders, unnest([1, 2, 3, 4, 5]) AS s(step)),
counted AS (
  SELECT part, filter_order, step, own,
    sum(n) FILTER (mask & (before | own) = 0) AS kept, sum(n) FILTER (mask & before = 0 AND mask & own > 0) AS removed,
    sum(n) FILTER (mask & before > 0 AND mask & own > 0) AS redundant, sum(n) FILTER (mask = own) AS unique_fails,
    sum(good) FILTER (mask & before = 0 AND mask & own > 0) AS good_lost, sum(toxic) FILTER (mask & before = 0 AND mask & own > 0) AS toxic_lost
  FROM cells, places GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM counted"""
