"""Filter interactions against filters applied one by one."""

from __future__ import annotations

import itertools
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.compare import difference, duck
from tidegauge.llm import filteraudit
from tidegauge.llm.queries import QUERIES, SQL

LABELS = "doc_id long, quality int, toxic int, source string"


def fails(docs: list[tuple], text: str, doc_id) -> set[str]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = set()
    if len(words) < 200:
        found.add("A")
    if 100 * len(set(words)) < 50 * len(words):
        found.add("B")
    if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text):
        found.add("C")
    if any(c in "#$%&*|" for c in text):
        found.add("D")
    if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, *_ in docs):
        found.add("E")
    return found


def plain(docs: list[tuple], labels: list[tuple]) -> set[tuple]:
    good = {i for i, quality, _ in labels if i is not None and quality == 1}
    toxic = {i for i, _, toxic in labels if i is not None and toxic == 1}
    parts = defaultdict(list)
    for doc_id, text, lang in docs:
        parts[lang or ""].append((doc_id, fails(docs, text or "", doc_id)))
    rows = []
    for part, own in parts.items():
        shapley = defaultdict(int)
        found = []
        for order in itertools.permutations("ABCDE"):
            left = list(own)
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                shapley[letter] += len(gone)
                every = sum(letter in f for _, f in own)
                unique = sum(f == {letter} for _, f in own)
                found.append((part, "".join(order), step, len(left), len(gone), every - len(gone), unique, sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), letter))
        rows += [(*row[:-1], shapley[row[-1]]) for row in found]
    return set(rows)


def columns(df):
    return [tuple(r) for r in df.select("part", "filter_order", "step", *filteraudit.COUNTS).collect()]


def test_every_state_of_the_walk_is_what_survives_the_subset():
    cells = {0: (5, 1), 3: (7, 2), 4: (1, 0), 6: (3, 3), 7: (2, 1)}
    states = filteraudit.walk(cells, 3)
    for subset, state in enumerate(states):
        assert state == tuple(sum(v[k] for mask, v in cells.items() if not mask & subset) for k in range(2))


def test_awkward_texts_against_loops(spark, awkward):
    long = " ".join(f"w{i}" for i in range(300))
    more = [(100, long, "en"), (101, long, "en"), (102, long + " $ ABC", None), (103, "A " * 400, "en"), (103, "A " * 400, "en"), (None, long, ""), (99, long, "de")]
    docs = awkward.select("doc_id", "text", "lang", "source", "score").unionByName(
        spark.createDataFrame(more, "doc_id long, text string, lang string"), allowMissingColumns=True
    )
    marks = [(i, i % 2, i % 3 == 0) for i in range(0, 104)] + [(100, 1, 1), (100, 0, 0), (None, 1, 1), (103, None, None)]
    marks = [(i, q, None if t is None else int(t)) for i, q, t in marks]
    labels = spark.createDataFrame([(*m, "x") for m in marks], LABELS)
    got = columns(filteraudit.audit(docs, labels))
    want = plain([(r.doc_id, r.text, r.lang) for r in docs.collect()], marks)
    assert len(got) == len(set(got)) and set(got) == want


def test_no_rows(spark, no_documents):
    labels = spark.createDataFrame([(1, 1, 1, "x")], LABELS)
    assert columns(filteraudit.audit(no_documents, labels)) == []


def test_no_labels(spark, awkward):
    got = columns(filteraudit.audit(awkward, spark.createDataFrame([], LABELS)))
    assert got and all(row[7] == row[8] == 0 for row in got)


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_query_equals_sql(spark, size):
    folder = f"/root/testdata/sf{size}"
    name = "op11_filter_audit"
    assert difference(spark, duck(folder), folder, QUERIES[name], SQL[name])[0] is None


def test_copies_of_one_text_are_looked_up_by_their_ids(spark):
    """A third of all rows being one text puts no third into one task: the look-up is dealt by text and id."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"), F.lit("en").alias("lang"))
    got = columns(filteraudit.audit(docs, spark.createDataFrame([], LABELS)))
    assert {(row[3], row[4]) for row in got if row[1].startswith("E") and row[2] == 1} == {(1, 2999)}
