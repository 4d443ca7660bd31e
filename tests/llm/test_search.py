"""Vector searches and the similarity join against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import covertree, graphsearch, metricjoin
from tidegauge.llm.arrays import flat, mix, shingle_sets, words

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, score int, rank int, id long, v double"


def vectors(spark, values, ids=None):
    rows = [(int(i), [float(x) for x in v], 1, 1, None, None) for i, v in zip(ids if ids is not None else range(len(values)), values, strict=True)]
    rows += [(5000, None, 0, 0, 0, 0.0), (5020, [], 0, 0, 0, 0.0), (5040, [1.0, NAN, 0.0], 0, 0, 0, 0.0), (5060, [1.0, None, 0.0], 0, 0, 0, 0.0), (5080, [INF, 0.0, 0.0], 0, 0, 0, 0.0), (None, [1.0, 1.0, 1.0], 0, 0, 0, 0.0)]
    return spark.createDataFrame(rows, SCHEMA)


def best(x, ids, asks, k):
    scores = x @ x.T
    out = []
    for i in np.flatnonzero(asks):
        order = [j for j in np.lexsort((ids, -scores[i])) if ids[j] != ids[i]][:k]
        out += [(int(ids[i]), r + 1, int(ids[j]), scores[i][j]) for r, j in enumerate(order)]
    return out


@pytest.mark.parametrize("kind", ["normal", "ties", "few"])
def test_top_k_is_exact(spark, rows, monkeypatch, kind):
    monkeypatch.setattr(covertree, "DATA_ROWS", 150)
    monkeypatch.setattr(covertree, "QUERY_ROWS", 12)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(7 if kind == "few" else 600, 3)).astype(np.float32)
    if kind == "ties":
        x = np.round(x)
        x[100:350] = x[3]
    df = vectors(spark, x)
    got = covertree.top_k(df, F.col("vec_id") % 20 == 0, 20)
    whole = np.floor(64 * x.astype(float))
    expected = [(a, r, b, int(s)) for a, r, b, s in best(whole, np.arange(len(x)), np.arange(len(x)) % 20 == 0, 20)]
    assert rows(got) == sorted(expected, key=str)
    assert covertree.top_k(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_cover_tree_radii_cover():
    rng = np.random.default_rng(2)
    x = np.floor(64 * rng.normal(size=(900, 6)))
    todo, seen = [covertree.cover_tree(x, np.arange(900), 20)], 0
    while todo:
        node = todo.pop()
        seen += 1
        assert np.sqrt(((x[node.rows] - node.centre) ** 2).sum(1)).max() <= node.radius + 1e-9
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
        todo += node.children
    assert seen > 10


def test_products_of_any_size_are_exact(spark):
    """Scores beyond 2^53 in whole numbers, beyond a long as its nearer end."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 3)).astype(np.float32)
    x[::7] *= np.float32(1e6)
    x[::11] *= np.float32(1e9)
    x[5], x[20], x[40] = [1e30, 1, 0], [1e30, 2, 0], [-1e38, 0, 0]
    x[60:80] = x[60]
    whole = [[int(np.floor(64 * float(c))) for c in v] for v in x]
    expected = []
    for i in range(0, 300, 20):
        scores = [(-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(whole[i], whole[j], strict=True)))), j) for j in range(300) if j != i]
        expected += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scores)[:20])]
    got = covertree.top_k(vectors(spark, x), F.col("vec_id") % 20 == 0).select("query_id", "rank", "vec_id", "score")
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)


def test_neighbours_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(graphsearch, "SHARD_ROWS", 700)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 16)).astype(np.float32)
    x[300:900] = x[7] + 0.01 * rng.normal(size=(600, 16))
    df = vectors(spark, x)
    got = graphsearch.search(df, F.col("vec_id") % 50 == 0, 5, rounds=3).collect()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    exact = {}
    for a, _, b, s in best(unit, np.arange(2000), np.arange(2000) % 50 == 0, 5):
        exact.setdefault(a, []).append((b, s))
    hits = 0
    for query in exact:
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == query)
        assert [r for r, _, _ in own] == [1, 2, 3, 4, 5] and query not in {v for _, v, _ in own}
        assert all(s == pytest.approx(unit[query] @ unit[v], abs=1e-12) for _, v, s in own)
        assert [s for _, _, s in own] == sorted((s for _, _, s in own), reverse=True)
        hits += len({v for _, v, _ in own} & {b for b, _ in exact[query]})
    assert hits / (5 * len(exact)) >= 0.9


def test_neighbours_of_small_and_empty_tables(spark):
    df = vectors(spark, [[1, 0, 0], [0, 2, 0], [3, 3, 0], [0, 0, 0]], [0, 1, 2, 3])
    df = df.unionByName(df.filter("vec_id = 2"))
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in graphsearch.search(df, F.col("vec_id") % 50 == 0, rounds=1).collect())
    assert got == [(0, 1, 2, round(0.5**0.5, 9)), (0, 2, 1, 0.0)]
    assert graphsearch.search(df.limit(0), F.col("vec_id") % 50 == 0, rounds=1).collect() == []


def plain_set(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def plain_components(given, width, percent):
    sets = [(i, plain_set(t, width)) for i, t in given]
    parent = list(range(len(sets)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[find(a)] = find(b)
    least = {}
    for a, (i, s) in enumerate(sets):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return sorted(((i, len(s), least.get(find(a)) if s else i) for a, (i, s) in enumerate(sets)), key=str)


def near_copies(seed: int, n: int) -> list[tuple[int, str]]:
    """Chains and clouds of edited copies, and a passage that many texts share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 40
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts, bases = [], [[rng.choice(vocabulary) for _ in range(rng.choice([4, 12, 30, 90, 250]))] for _ in range(12)]
    for _ in range(n):
        kind = rng.random()
        if kind < 0.7:
            w = list(rng.choice(bases))
            for _ in range(rng.randint(0, max(1, len(w) // 40))):
                at = rng.randrange(len(w))
                w[at : at + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 2)
            if rng.random() < 0.2:
                bases.append(w)
        elif kind < 0.9:
            w = [rng.choice(vocabulary) for _ in range(rng.randint(3, 80))]
            w[rng.randrange(len(w)) :] = passage
        else:
            w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 5))]
        texts.append(" ".join(w))
    return list(enumerate(texts))


@pytest.mark.parametrize(("width", "percent", "most"), [(3, 90, 1024), (3, 90, 12), (5, 80, 1024), (5, 80, 10)])
def test_join_matches_all_pairs(spark, rows, width, percent, most):
    given = near_copies(width + most, 450)
    docs = spark.createDataFrame(given, "doc_id long, text string")
    got = metricjoin.linked_components(docs, width, percent, most).select("doc_id", "n_shingles", "component_id")
    assert rows(got) == plain_components(given, width, percent)


def test_join_of_awkward_rows(awkward, no_documents, rows):
    got = metricjoin.linked_components(awkward).select("doc_id", "n_shingles", "component_id")
    assert rows(got) == plain_components([(r.doc_id, r.text) for r in awkward.collect()], 3, 90)
    assert metricjoin.linked_components(no_documents).collect() == []
    kept = metricjoin.without_copies(awkward.select("doc_id", "text", "lang"))
    assert kept.columns == ["doc_id", "text", "lang"]
    texts = [r.text for r in kept.collect()]
    sets = [plain_set(t, 3) for t in texts if plain_set(t, 3)]
    assert len(sets) == len(set(sets)) and sum(not plain_set(t, 3) for t in texts) == sum(not plain_set(r.text, 3) for r in awkward.collect())


@pytest.mark.parametrize("percent", [70, 80, 90, 95])
def test_partners_share_a_cell(percent):
    rng, draw = np.random.default_rng(percent), random.Random(percent)
    tried = 0
    for _ in range(1500):
        n = draw.choice([1, 2, 3, 5, 8, 12, 20, 33, 60, 100, 300])
        spare = max(1, n * (100 - percent) // 100) + 1
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = np.unique(np.concatenate([a[draw.randint(0, spare) :], rng.integers(0, 2**63, draw.randint(0, spare)).astype(np.uint64)]))
        a, both = np.unique(a), len(np.intersect1d(a, b))
        if len(b) and 100 * both >= percent * (len(a) + len(b) - both):
            tried += 1
            met = rng.integers(0, 256, 1 << 10).astype(np.uint8)  # what both have is met twice, the rest may look so
            place = metricjoin._place(mix(np.intersect1d(a, b)), 4 << 10)
            np.bitwise_or.at(met, (place >> np.uint64(2)).astype(int), (1 << 2 * (place & np.uint64(3)).astype(int)).astype(np.uint8))
            assert set(metricjoin.cells(a, percent, met).tolist()) & set(metricjoin.cells(b, percent, met).tolist())
    assert tried > 200


def test_levels_follow_counts(spark):
    """Every shingle's level is that of the count at its place, however the rows are dealt."""
    given = near_copies(5, 300)
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(5)
    places = 1 << 14
    met = metricjoin.met_shingles(docs, 3, places)
    hashes = mix(np.concatenate(shingle_sets(pa.array([t for _, t in given]), 3)))
    total = np.bincount(metricjoin._place(hashes, places).astype(int), minlength=places)
    mean = np.repeat(total.reshape(metricjoin.RANGES, -1).mean(1), places // metricjoin.RANGES)
    expected = (total > 1).astype(int) + (total > 3 + 2 * mean) + (total > 7 + 4 * mean)
    got = (met[np.arange(places) // 4] >> (2 * (np.arange(places) % 4))) & 3
    assert np.array_equal(got, expected) and set(got) == {0, 1, 2, 3}


def test_a_common_passage_makes_no_region():
    """Texts that share only a passage have no cell in common as long as they have enough of their own."""
    rng = np.random.default_rng(4)
    passage = np.unique(rng.integers(0, 2**63, 60).astype(np.uint64))
    met = np.zeros(1 << 16, np.uint8)
    place = metricjoin._place(mix(passage), 4 << 16)
    np.bitwise_or.at(met, (place >> np.uint64(2)).astype(int), (3 << 2 * (place & np.uint64(3)).astype(int)).astype(np.uint8))
    own = [np.unique(np.concatenate([passage, rng.integers(0, 2**63, 40).astype(np.uint64)])) for _ in range(50)]
    found = [set(metricjoin.cells(s, 80, met).tolist()) for s in own]
    assert not any(found[i] & found[j] for i in range(50) for j in range(i))


def test_phrases_draw_no_region_in_a_large_table(spark, monkeypatch):
    """Texts with enough shingles of their own stay alone although each shares phrases with two others, also with far more shingles than places."""
    monkeypatch.setattr(metricjoin.met_shingles, "__defaults__", (1 << 10,))
    phrase = lambda i: [f"p{i}w{k}" for k in range(12)]
    texts = [[f"t{i}w{k}" for k in range(60)] + phrase(i) + phrase(i + 1) for i in range(300)]
    given = [(i, " ".join(w)) for i, w in enumerate([*texts, texts[7][:-1]])]
    handed = []
    joined = metricjoin.region_links
    monkeypatch.setattr(metricjoin, "region_links", lambda rows, *a: handed.append(rows.count()) or joined(rows, *a))
    docs = spark.createDataFrame(given, "doc_id long, text string")
    got = metricjoin.linked_components(docs, 5, 80)
    assert {r.doc_id: r.component_id for r in got.collect()} == {i: min(i, 7) if i in (7, 300) else i for i in range(301)}
    assert handed == [2]


@pytest.mark.parametrize("percent", [80, 90])
def test_single_cells_follow_counts(spark, monkeypatch, percent):
    """Rare shingles come first, exactly counted, and none that only one text has makes a cell, however the rows are dealt."""
    monkeypatch.setattr(metricjoin, "SENT", 700)
    given = list(dict.fromkeys(t for _, t in near_copies(11, 400)))
    docs = spark.createDataFrame([(t,) for t in given], "text string").repartition(5)
    sets = {metricjoin._name(s): s for s in shingle_sets(pa.array(given), 3) if len(s) and metricjoin.layered(s, percent)[1]}
    sets = {name: np.sort(mix(s)) for name, s in sets.items()}
    first = {name: len(h) - -(-percent * len(h) // 100) + 1 for name, h in sets.items()}
    sent = {name: h[: max((h < metricjoin.COUNTED).sum(), first[name])].tolist() for name, h in sets.items()}
    # Equal sets of different texts count as often as there are texts.
    times = Counter(metricjoin._name(s) for s in shingle_sets(pa.array(given), 3) if len(s))
    count = Counter()
    for name, hashes in sent.items():
        count.update(dict.fromkeys(hashes, times[name]))
    expected = {}
    for name, hashes in sent.items():
        order = sorted(hashes, key=lambda h: (h >= int(metricjoin.COUNTED), h if h >= int(metricjoin.COUNTED) else count[h], h))
        expected[name] = [h for h in order[: first[name]] if count[h] > 1]
    rows = metricjoin.single_cells(docs, 3, percent).collect()
    got = {}
    for r in rows:
        assert got.setdefault(bytes(r.name), r.cells) is r.cells or sorted(got[bytes(r.name)]) == sorted(r.cells)
    assert {n: len(c) for n, c in got.items()} == {n: len(c) for n, c in expected.items() if c}
    met = lambda lists: sorted(Counter(c for cells in lists.values() for c in set(cells)).values())
    assert met(got) == met(expected) and len(set(map(len, got.values()))) > 1


def test_repeated_rows_keep_columns_of_any_name(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (None, "g h i j k l", "x"), (None, "g h i j k l", "x"), (2, " ", "x"), (2, " ", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _hash string")
    got = metricjoin.without_copies(docs.withColumn("_key", F.lit("x")), width=5, percent=80)
    assert sorted(got.collect(), key=str) == sorted([(*rows[0], "x"), (*rows[2], "x"), (*rows[4], "x"), (*rows[5], "x")], key=str)


def test_word_hashes_follow_words():
    texts = ["Ab c", None, "", "ab C", "a bc", "x" * 3_000_000 + " ab", " c  ab "]
    hashes, heads = words(*flat(pa.array(texts)))
    own = [hashes[heads[i] : heads[i + 1]].tolist() for i in range(len(texts))]
    assert own[0] == own[3] and own[1] == own[2] == [] and own[4] != own[0]
    assert own[5][1] == own[0][0] and own[6] == own[0][::-1]
    sets = shingle_sets(pa.array(["a b", "a b c", "b c", "A  B"]), 3)
    assert [len(s) for s in sets] == [1, 1, 1, 1] and sets[0] == sets[3] and len({int(s[0]) for s in sets}) == 3


def test_walk_finds_clusters_without_an_own_row():
    """Tight clusters of more rows than a list names: no link leads in, and no fixed entry row need lie there."""
    rng = np.random.default_rng(8)
    n, d, clusters, k = 6000, 64, 120, 5
    middles = rng.normal(size=(clusters, d))
    x = middles[rng.integers(0, clusters, n)] + 0.1 * rng.normal(size=(n, d))
    asked = middles[rng.integers(0, clusters, 100)] + 0.1 * rng.normal(size=(100, d))
    x, asked = ((v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32) for v in (x, asked))
    sims = x @ x.T
    np.fill_diagonal(sims, -np.inf)
    links = np.argpartition(-sims, graphsearch.DEGREE, 1)[:, : graphsearch.DEGREE]
    found, _ = graphsearch.walk(x, links, asked, np.full(100, -1), k)
    true = np.argsort(-(asked @ x.T), 1)[:, :k]
    assert np.mean([len(set(a) & set(b)) / k for a, b in zip(found.tolist(), true.tolist(), strict=True)]) > 0.99
