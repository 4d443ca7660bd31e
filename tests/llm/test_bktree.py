"""SimHash fingerprints, trees and components against loops."""

from __future__ import annotations

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tidegauge.llm import bktree, components
from tidegauge.session import cut_lineage

FOLDER = "/root/testdata/sf0.001"


def plain_print(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(rows: list[tuple], radius: int) -> list[int | None]:
    """The smallest id that each row reaches, by looking at all pairs again and again."""
    found = [r[0] for r in rows]
    least = lambda a, b: b if a is None else a if b is None else min(a, b)
    while True:
        before = list(found)
        for i, (_, p) in enumerate(rows):
            for j, (_, q) in enumerate(rows):
                if (p ^ q).bit_count() <= radius:
                    found[i] = least(found[i], found[j])
        if found == before:
            return found


def test_fingerprint_of_awkward_texts(awkward):
    for row in awkward.select("text").collect():
        text = None if row.text is None else row.text.encode()
        assert bktree.fingerprint(text) == plain_print(row.text)


def test_hash_is_the_one_of_spark(spark):
    text = "one Two  three"
    row = spark.range(1).select(F.hex(F.xxhash64(F.lit("one two three"))).alias("h")).first()
    assert int(row.h, 16) == bktree.fingerprint(text.encode())


@pytest.mark.parametrize("radius", [0, 1, 2, 5])
def test_tree_finds_all_within_the_radius(radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(20)]
    prints = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) for b in base for _ in range(15)}
    prints = [p & (1 << 64) - 1 for p in prints]
    tree = bktree.Tree()
    for p in dict.fromkeys(prints):
        tree.add(p)
    again = bktree.Tree(tree.prints, tree.parents, tree.edges)
    for query in [*prints[:50], *base, 0]:
        want = {p for p in prints if (p ^ query).bit_count() <= radius}
        assert {tree.prints[n] for n in tree.within(query, radius)} == want == {again.prints[n] for n in again.within(query, radius)}


def test_search_follows_only_edges_within_the_radius():
    tree = bktree.Tree()
    for p in (0, 0b1, 0b1111, 0b11111111, (1 << 40) - 1):
        tree.add(p)
    seen = []

    class Counting(dict):
        def __getitem__(self, edge):
            seen.append(edge)
            return super().__getitem__(edge)

    tree.children = [Counting(c) for c in tree.children]
    assert tree.within(0b11, 2) == [0, 2, 1] or set(tree.within(0b11, 2)) == {0, 1, 2}
    assert set(seen) == {1, 4} and set(tree.children[0]) == {1, 4, 8, 40}


def longs(prints):
    return [(p - (p >> 63 << 64),) for p in prints]


@pytest.mark.parametrize("aim, most", [(4, 16), (128, 1024)])
def test_shards_hold_every_pair(spark, aim, most):
    """A family of 500 variants of one fingerprint beside strangers: every pair within two bits shares a shard, none is too large."""
    rng = random.Random(1)
    centre = rng.getrandbits(64)
    near = {centre ^ sum({1 << rng.randrange(14) for _ in range(rng.randrange(7))}) for _ in range(500)}
    prints = sorted(near | {rng.getrandbits(64) for _ in range(500)})
    found = bktree.shards(spark.createDataFrame(longs(prints), "print long"), 2, aim, most).collect()
    assert all(2 <= len(r.prints) == len(set(r.prints)) <= most for r in found)
    together = {(a, b) for r in found for own in [set(r.prints)] for a in own for b in own if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    values = sorted(p for (p,) in longs(prints))
    assert together == {(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}


@pytest.mark.parametrize("radius", [0, 2])
def test_components_against_loops(spark, awkward, radius):
    docs = awkward.select("doc_id", "text", "score", "component")
    words = [f"w{i}" for i in range(60)]
    more = [(1000 + i, " ".join(words[: 60 - i])) for i in range(25)]
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    got = bktree.near_copies(docs, radius).collect()
    rows = [(r.doc_id, plain_print(r.text)) for r in docs.collect()]
    want = sorted((str(i), f"{p:016x}", str(c)) for (i, p), c in zip(rows, plain_components(rows, radius), strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


def test_planted_bits_link_in_chains(spark, monkeypatch):
    """Fingerprints two bits apart link, three apart don't, and chains carry the smallest id along; small shards, many levels."""
    rng = random.Random(3)
    rows = []
    for family in range(40):
        p = rng.getrandbits(64)
        for step in range(12):
            rows.append((1000 * family + step, p))
            p ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 2, 3])))
    rng.shuffle(rows)
    table = spark.createDataFrame([(i, p - (p >> 63 << 64)) for i, p in rows], "doc_id long, print long")
    monkeypatch.setattr(bktree, "fingerprints", lambda docs, width: docs.select("doc_id", "print"))
    monkeypatch.setattr(bktree, "shards", lambda prints, radius, own=bktree.shards: own(prints, radius, 4, 16))
    got = {r.doc_id: r.component_id for r in bktree.near_copies(table).collect()}
    assert got == dict(zip([i for i, _ in rows], plain_components(rows, 2), strict=True))


def test_no_rows(spark, no_documents):
    assert bktree.near_copies(no_documents).collect() == []


def test_whole_table_against_loops(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, plain_print(r.text)) for r in docs.collect()]
    want = {(i, f"{p:016x}", c) for (i, p), c in zip(rows, plain_components(rows, 2), strict=True)}
    assert {tuple(r) for r in bktree.near_copies(docs).collect()} == want


def test_links_of_a_shard_are_a_star(spark):
    """A chain of 40 fingerprints in one shard: every one is linked with the smallest, so components need no walk along the chain."""
    values = sorted((1 << i) - 1 for i in range(40))
    shard = spark.createDataFrame([(0, 0, values)], "mask long, value long, prints array<long>")
    got = {tuple(r) for r in bktree.links(bktree.trees(shard), 2).collect()}
    assert got == {(v, 0) for v in values[1:]}


def test_stars_need_no_round(spark, monkeypatch):
    """Edges that are stars already are written once; others take rounds, whichever way they are given."""
    written = []
    monkeypatch.setattr(components, "cut_lineage", lambda df: written.append(1) or cut_lineage(df))
    stars = spark.createDataFrame([(5, 1), (1, 7), (5, 1), (3, 3), (9, 8)], "a long, b long")
    assert sorted(tuple(r) for r in components.components(stars).collect()) == [(1, 1), (5, 1), (7, 1), (8, 8), (9, 8)]
    assert len(written) == 1
    chain = spark.createDataFrame([(i, i + 1) for i in range(50)], "a long, b long")
    assert {tuple(r) for r in components.components(chain).collect()} == {(i, 0) for i in range(51)}
    assert components.components(stars.limit(0)).collect() == []
