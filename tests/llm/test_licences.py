"""License notices against a scan that looks at every template's wording."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidegauge.llm import licences
from tidegauge.llm.licences import TEMPLATES, Scanner, blocks, differing, words

FOLDER = "/root/testdata/sf0.01"


def plain(text):
    """All templates, without compression: per block the one whose words differ least."""
    found = []
    for block in blocks(text):
        judged = [(differing(words(wording), words(block)), name) for name, several in TEMPLATES.items() for wording in several]
        found.append({min(j for j in judged if j[0] is not None)[1]} if any(j[0] is not None for j in judged) else set())
    return found


@pytest.fixture(scope="module")
def scanner():
    return Scanner()


def test_every_template_is_found_and_named(scanner):
    for name, several in TEMPLATES.items():
        for wording in several:
            assert scanner.licenses(f"Some text before.\n{wording}\nand after") == [name]
            assert scanner.licenses(f"Some text. {wording.upper()} More text.") == [name]


@pytest.mark.parametrize(
    "text",
    ["This work is licensed under the GNU General Public License, version 7.", "A driving licence was issued.", "All wrongs reserved, copyright nobody", "Licensed under CC BY-ND 4.0.", "", None],
)
def test_other_wordings_are_not_confirmed(scanner, text):
    assert scanner.licenses(text) == []


def test_ranking_by_saved_bytes(scanner):
    best = scanner.ranked("Licensed under the Apache License, Version 2.0.")
    assert best[0][1] == "Apache-2.0" and best[0][0] > 0.5 and [b[0] for b in best] == sorted((b[0] for b in best), reverse=True)


def test_scan_of_test_documents_matches_plain_scan(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = {r.doc_id: (r.n_blocks, set(r.licenses)) for r in licences.scan(docs).collect()}
    expected = {r.doc_id: plain(r.text) for r in docs.collect()}
    assert {i: (len(e), set().union(*e)) for i, e in expected.items()} == got
    assert sum(bool(names) for _, names in got.values()) > 10


def test_notices_among_noise(scanner):
    rng = random.Random(1)
    for _ in range(200):
        name = rng.choice(list(TEMPLATES))
        noise = [" ".join(rng.choice(["ka", "lo", "mi", "license", "the"]) for _ in range(20)) for _ in range(6)]
        noise.insert(rng.randrange(6), TEMPLATES[name][0])
        assert scanner.licenses("\n".join(noise)) == [name]


def test_awkward_rows(awkward, no_documents):
    got = licences.scan(awkward).collect()
    assert len(got) == awkward.count() and all(r.licenses == [] for r in got)
    again = licences.scan(awkward.withColumn("text", F.lit("x\nAll rights reserved.\nAll rights reserved."))).collect()
    assert all(r.licenses == ["LicenseRef-all-rights-reserved"] and r.n_blocks == 2 for r in again)
    assert licences.scan(no_documents).collect() == []
