"""Encoding, sharding, mixing and scoring of texts against plain loops."""

from __future__ import annotations

import base64
import hashlib
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from tidegauge.llm import bytepairs, mixing, quality, sharding, toxicity
from tidegauge.llm.queries import RANKS
from tidegauge.session import scratch_path
from tests.llm.conftest import awkward_texts

PATH = public_tokenizers.path(RANKS)


@pytest.fixture(scope="module")
def known():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bytepairs.Encoder(PATH, bytepairs.splitter(public_tokenizers.PATTERN))


def random_texts(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    bits = ["the", "don't", "'s", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "漢字", "ж", "🙂", "123", "४५", "!?", "​", "ⅷ", "　", "'LL", "-" * 9, " ", "q" * 40]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_encoder_is_the_librarys(encoder, known):
    for text in [*random_texts(3000, 1), *(t or "" for t in awkward_texts())]:
        assert encoder.encode(text) == known.encode_ordinary(text), repr(text)


def test_machine_with_a_full_table_gives_the_same(encoder):
    small = bytepairs.Transducer(encoder.machine.ranks, states=5)
    for text in random_texts(400, 2):
        for piece in encoder.split(text):
            raw = piece.encode()
            assert small.encode(raw) == encoder.machine.encode(raw) == bytepairs.merged(raw, small.ranks)


def test_lookahead_is_bounded(encoder):
    machine = encoder.machine
    raw = ("banana" * 200).encode()
    state, open_ = 0, []
    for byte in raw:
        state, _ = machine.moves[state].get(byte) or machine._move(state, byte)
        open_.append(max(sum(len(machine.tokens[t]) for t in p) for p, _ in machine.states[state][1]))
    assert max(open_) < 40


def test_decoder_streams_and_replaces_faults(encoder):
    decoder = bytepairs.Decoder(encoder.machine.tokens)
    rng = random.Random(3)
    for _ in range(3000):
        ids = [rng.randrange(50_256) if rng.random() < 0.5 else rng.randrange(256) for _ in range(rng.randint(0, 9))]
        raw = b"".join(encoder.machine.tokens[i] for i in ids)
        assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == raw.decode("utf-8", "replace")


def test_round_trip_of_awkward_rows(awkward, no_documents, known, rows):
    got = bytepairs.digest(bytepairs.round_trip(awkward, PATH, public_tokenizers.PATTERN))
    expected = []
    for row in awkward.collect():
        text = row.text or ""
        ids = known.encode_ordinary(text)
        expected.append((row.doc_id, len(ids), bytepairs.sha256_of_ids(ids), hashlib.sha256(text.encode()).hexdigest()))
    assert rows(got) == sorted(expected, key=str)
    apart = bytepairs.digest(bytepairs.decode(bytepairs.encode(awkward, PATH, public_tokenizers.PATTERN), PATH))
    assert rows(apart) == rows(got)
    assert rows(bytepairs.round_trip(no_documents, PATH, public_tokenizers.PATTERN)) == []


def check_shards(docs, got, shards):
    assert len(got) == docs.count()
    sizes = Counter((len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()), r.doc_id) for r in docs.collect())
    assert Counter((r["size"], r.text_crc32, r.doc_id) for r in got) == sizes
    for shard in range(shards):
        own = sorted(r.slot for r in got if r.shard == shard)
        assert own == list(range(len(own)))
    assert {r.law for r in got} <= {"bytes"} and all(r.grown_shard is None for r in got)


def test_sharding_of_awkward_rows(spark, awkward, no_documents):
    check_shards(awkward, sharding.shard_documents(awkward, 4, scratch_path(spark, "map"), slots=64).collect(), 4)
    assert sharding.shard_documents(no_documents, 4, scratch_path(spark, "map"), slots=64).collect() == []


def test_shards_are_near_equal_and_maps_have_versions(spark):
    rng = random.Random(1)
    docs = spark.createDataFrame([(i, "y" * rng.randint(0, 900)) for i in range(3000)], "doc_id long, text string")
    folder = scratch_path(spark, "map")
    got = sharding.shard_documents(docs, 8, folder, slots=512).collect()
    check_shards(docs, got, 8)
    load = Counter()
    for r in got:
        load[r.shard] += r["size"]
    assert max(load.values()) - min(load.values()) < 0.01 * sum(load.values()) / 8
    table = sharding.SlotMap(spark, folder)
    first, second = (dict((r.virtual_slot, r.shard) for r in table.version(n).collect()) for n in (1, 2))
    assert set(first) == set(second) == set(range(512))
    moved = sum(first[s] != second[s] for s in first)
    assert 0 < moved < 512 / 2  # most slots stay
    totals = sharding.slot_totals(docs.select(F.octet_length("text").cast("long").alias("size"), sharding.slot_of(F.col("doc_id"), slots=512).alias("virtual_slot")), 512)
    grown = dict((r.virtual_slot, r.shard) for r in table.rebalance(2, totals, 9).collect())
    assert {grown[s] for s in grown if grown[s] != second[s]} >= {8}


def plain_targets(sizes: dict, weights=(5, 2, 1)) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, target, full = sum(sizes.values()), {}, set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in sizes if s not in full)
        target = {s: 3 * sizes[s] if s in full else rest * weight[s] / share for s in sizes}
        over = {s for s in sizes if s not in full and target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def check_mix(docs, got):
    import re

    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    given = docs.collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((r.doc_id, size(r.text)) for r in given)
    sums = defaultdict(int)
    for r in given:
        sums[r.source] += size(r.text)
    target, taken = plain_targets(dict(sums)), defaultdict(int)
    for r in got:
        assert r.source_size == sums[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == sum(p.words for p in r.positions)
        assert all(0 <= p.position <= 1 for p in r.positions)
        taken[r.source] += r.taken
    for source, words in taken.items():
        assert abs(words - target[source]) <= 1


def test_mix_of_awkward_rows(awkward, no_documents):
    got = mixing.mix(awkward)
    check_mix(awkward, got.collect())
    assert mixing.mix(no_documents).collect() == []
    assert sorted(map(str, got.collect())) == sorted(map(str, mixing.mix(awkward.repartition(7)).collect()))


def test_mix_with_a_hot_source(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(0, 30), "hot" if i % 3 else f"s{i % 11}") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check_mix(docs, mixing.mix(docs).collect())


@pytest.mark.parametrize("levels", [(1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.0, 2.0), (3.0, 0.5, 0.5, 2.0)])
def test_positions_invert_the_schedule(spark, levels):
    shares = np.linspace(0, 1, 21)
    column = F.array(*map(F.lit, map(float, levels)))
    got = [r.p for r in spark.createDataFrame([(float(s),) for s in shares], "s double").select(
        mixing.position_of(F.col("s"), column, mixing.integrals(column)).alias("p")).collect()]
    fine = np.linspace(0, 1, 200_001)
    weight = np.interp(fine, np.linspace(0, 1, len(levels)), levels)
    demand = np.concatenate(([0], np.cumsum((weight[1:] + weight[:-1]) / 2)))
    assert np.allclose(np.interp(got, fine, demand / demand[-1]), shares, atol=1e-4)
    assert np.all(np.diff(got) >= 0)


def test_schedule_repeats_whole_rows_in_order(awkward):
    kept = ["doc_id", "text", "source", "lang"]
    mixed = mixing.schedule(awkward.select(*kept))
    assert mixed.columns == kept
    expected = Counter()
    for r in mixing.mix(awkward).collect():
        expected[r.doc_id] += sum(2 * p.words >= r["size"] for p in r.positions)
    assert Counter(r.doc_id for r in mixed.collect()) == +expected


@pytest.fixture(scope="module")
def labelled(spark):
    """Plain and marked texts: toxic ones hold a word of one family, bad ones are full of marks."""
    rng = random.Random(4)
    sound = ["ka", "lo", "mi", "ne", "ru", "sta", "ven", "dor", "pel", "ish"]
    rows, labels = [], []
    for i in range(2500):
        words = ["".join(rng.choice(sound) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(15, 60))]
        toxic, good = int(rng.random() < 0.2), int(rng.random() > 0.15)
        for _ in range(2 * toxic):
            words[rng.randrange(len(words))] = "zorg" + rng.choice(sound)
        text = " ".join(w if good else w.upper() + "%%%" for w in words)
        rows.append((i, text))
        if i % 2 == 0 or i % 5 == 0:
            labels.append((i, good, toxic))
    labels += [(None, 1, 1), (3, None, None), (10**9, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string").cache(), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache()


def accuracy(scored, labels, column, least):
    joined = scored.filter(toxicity.held_out()).join(labels, "doc_id").filter(F.col(column).isNotNull()).collect()
    assert len(joined) > 150
    return sum((r.score >= least) == bool(r[column]) for r in joined) / len(joined)


def test_toxicity_on_held_out_labels(labelled):
    docs, labels = labelled
    scored = toxicity.score(docs, toxicity.train(docs, labels), ["doc_id"]).cache()
    assert scored.count() == docs.count() and scored.filter("score between 0 and 1").count() == docs.count()
    assert accuracy(scored, labels, "toxic", 0.5) > 0.95


def test_toxicity_keeps_every_gram(awkward, labelled):
    """More n-grams than places, with copies and odd texts: scores are those of the whole tables."""
    docs, labels = labelled
    docs = docs.limit(600).unionByName(awkward.select(F.col("doc_id").cast("long") + 10_000, "text").toDF("doc_id", "text"))
    whole, few = (toxicity.score(docs, toxicity.train(docs, labels, **more), ["doc_id", "text"]).collect() for more in ({}, {"places": 64}))

    def order(r):
        return str(r.doc_id), r.text or ""

    assert len(whole) == len(few) == docs.count()
    for a, b in zip(sorted(whole, key=order), sorted(few, key=order), strict=True):
        assert order(a) == order(b) and a.score == pytest.approx(b.score, abs=1e-6)


def test_shared_backoff_sums_to_one(spark, labelled):
    counts = toxicity.gram_counts(labelled[0].limit(200).withColumn("toxic", F.col("doc_id") % 2), 3)
    shared = toxicity.backoff(counts, 3)
    sums = shared.groupBy(F.expr("substring(gram, 1, char_length(gram) - 1)").alias("h")).agg(F.sum("shared").alias("s")).collect()
    assert sums and all(0.2 < r.s <= 1 + 1e-9 for r in sums)  # the rest is for what never follows


def test_quality_on_held_out_labels(labelled):
    docs, labels = labelled
    scored = quality.score(docs, quality.train(docs, labels), ["doc_id"]).cache()
    assert scored.filter("score between 0 and 1").count() == docs.count()
    assert accuracy(scored, labels, "quality", 0.3) > 0.95


def test_risk_of_positives_and_unlabelled():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1.5, 1, (4000, 2)), rng.normal(-1.5, 1, (1500, 2))
    model = quality.fit(good[:2000], np.concatenate([good[2000:], bad]), prior=2000 / 3500)
    assert (model.score(good) >= 0.5).mean() > 0.9 and (model.score(bad) < 0.5).mean() > 0.9


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_scores_of_awkward_rows(spark, awkward, no_documents, labelled, operator):
    docs, labels = labelled
    model = operator.train(docs, labels)
    got = operator.score(awkward, model, ["doc_id", "text"]).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r.doc_id, r.text) for r in awkward.collect())
    assert all(0 <= r.score <= 1 for r in got)
    assert operator.score(no_documents, model, ["doc_id"]).collect() == []
    nothing = operator.train(awkward, labels.limit(0))
    assert {r.score for r in operator.score(awkward, nothing, ["doc_id"]).collect()} == {0.0 if operator is toxicity else 0.5}
    empty = operator.train(no_documents, labels)
    assert all(0 <= r.score <= 1 for r in operator.score(awkward, empty, ["doc_id"]).collect())


@pytest.mark.parametrize("kind", ["null ids", "one id", "one row"])
def test_no_id_fills_a_shard(spark, kind):
    """The law holds where ids are null or repeated, and where one row is repeated."""
    rows = [(None if kind == "null ids" else 7, "same text" if kind == "one row" else f"text {i}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard_documents(docs, 16, scratch_path(spark, "map")).collect()
    check_shards(docs, got, 16)
    load = [sum(r["size"] for r in got if r.shard == s) for s in range(16)]
    assert max(load) <= 1.05 * min(load) and len({(r.shard, r.slot) for r in got}) == 2000


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_a_repeated_id_is_collected_once(spark, labelled, operator):
    docs, labels = labelled
    known = docs.join(labels, "doc_id").filter("quality = 1 or toxic = 1").select("doc_id", "text").limit(1)
    more = docs.unionByName(spark.range(300).crossJoin(known).select("doc_id", "text"))
    assert operator.score(more, operator.train(more, labels), ["doc_id"]).count() == docs.count() + 300


def test_toxicity_of_texts_together_is_that_of_each_alone():
    """Values of a batch come from the same tables as a plain loop's, whatever is remembered and however n-grams share places."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdé🙂") for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    known = sorted({g for w in words[:200] for g in toxicity.grams(w)})
    contexts = sorted({g[:-1] for w in words[:250] for g in toxicity.grams(w)})

    def held(keys):
        tags = np.array([xxhash.xxh64_intdigest(k.encode(), 42) for k in keys], np.uint64).view(np.int64)
        order = np.argsort(tags % 50, kind="stable")
        values = np.array([rng.gauss(0, 1) for _ in keys], np.float32)
        return dict(zip(keys, values.tolist(), strict=True)), toxicity.Ratios(np.searchsorted(tags[order] % 50, np.arange(51)).astype(np.int32), tags[order], values[order])

    (grams, of_gram), (backs, of_context) = held(known), held(contexts)

    def plain(text):
        found = []
        for word, n in Counter((text or "").lower().split()).items():
            value = 0.0
            for g in toxicity.grams(word):
                value += grams.get(g, backs.get(g[:-1], 0.0))
            found.append((value, n, len(word) + 1))
        if not found:
            return [0.0] * 5
        top = sorted((v for v, _, _ in found), reverse=True)[:3]
        mean = sum(n * v for v, n, _ in found) / sum(n * s for _, n, s in found)
        return [mean, *top, *[min(0.0, top[-1])] * (3 - len(top)), max(v / s for v, _, s in found)]

    texts = [None, "", " ", words[0], "x" * 300_000, *[" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(50)]]
    scorer = toxicity.Scorer(of_gram, of_context)
    for _ in range(2):
        assert scorer.describe(texts) == pytest.approx(np.array([plain(t) for t in texts]), rel=1e-12)
    assert scorer.describe([]).shape == (0, 5)
    assert (scorer.describe(texts) == np.concatenate([toxicity.Scorer(of_gram, of_context).describe([t]) for t in texts])).all()


def test_counting_ngrams_takes_little_memory():
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abcdefghijklmnopqrst") for _ in range(7)) for _ in range(500)) for _ in range(40)]
    tracemalloc.start()
    counts = toxicity._count(texts, [i % 2 for i in range(40)], 6)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 230 * len(counts)
    want = Counter((g, i % 2) for i, t in enumerate(texts) for w in t.split() for g in toxicity.grams(w))
    assert counts == {g: want[g, 0] + (want[g, 1] << 40) for g, _ in want}
