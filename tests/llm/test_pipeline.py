"""The pipeline's stages and the registered queries."""

from __future__ import annotations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tidegauge.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_operator_has_a_query():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)} and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_answer_every_row(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    number = name.split("_")[0]
    if number in ("op11", "op13"):  # a row per part, order and step; per conversation
        column, times, source = {"op11": ("lang", 600, "documents"), "op13": ("conv_id", 1, "conversations")}[number]
        assert len(rows) == times * spark.read.parquet(f"{FOLDER}/{source}.parquet").select(column).distinct().count()
        return
    source = {"op1": "pages", "op7": "embeddings", "op10": "embeddings"}.get(name.split("_")[0], "documents")
    table = spark.read.parquet(f"{FOLDER}/{source}.parquet")
    if source == "embeddings":
        step, k = (20, 20) if name.startswith("op7") else (50, 5)
        assert len(rows) == k * table.filter(F.col("vec_id") % step == 0).count()
    else:
        assert len(rows) == table.count()


def test_stages_keep_their_columns_and_decide(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    ids = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER).cache()
        assert kept.columns == DOCUMENTS, name
        own = {r.doc_id for r in kept.collect()}
        assert own and own <= ids
        docs, ids = kept, own
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert last.count() == docs.count()


@pytest.mark.parametrize("number", range(len(corpus_pipeline.STAGES)))
def test_stages_take_awkward_and_no_rows(spark, awkward, number):
    _, stage = corpus_pipeline.STAGES[number]
    docs = awkward.select(*DOCUMENTS)
    got = stage(spark, docs, FOLDER)
    assert got.count() <= 3 * docs.count()
    assert stage(spark, docs.limit(0), FOLDER).count() == 0


def test_run_is_all_stages(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 0


def test_stages_take_any_extra_columns(spark, awkward):
    """Columns with the names the stages use themselves come through unchanged."""
    docs = awkward.withColumns({n: F.lit("kept") for n in ("score", "_found", "_mean", "_kept0", "text_hash", "region", "_score", "_hash")})
    for name, stage in corpus_pipeline.STAGES[:4]:
        got = stage(spark, docs, FOLDER)
        assert got.columns == docs.columns, name
        assert {r["_found"] for r in got.select("_found").collect()} <= {"kept"}, name
    assert corpus_pipeline.STAGES[4][1](spark, docs, FOLDER).count() == docs.count()
