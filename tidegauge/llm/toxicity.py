"""Toxicity by two language models: how likely a text is as toxic and as ordinary writing.

The models are interpolated Kneser-Ney over the characters of a word. The longest n-grams are counted per class, and
what a class has not seen is left to one backoff distribution that both share, built from continuation counts of both.
Where neither class knows an n-gram the shared part cancels, so a model is two tables: the log ratio of each n-gram
seen, and of each context's weight of backing off. Both are kept whole; tasks hold them while they are small, else the
distinct n-grams of the texts are joined with them.

A word's score is its log ratio per character; a document is described by its mean over all characters and by its
strongest words, and a logistic curve, fitted on labelled texts the counts have not seen, turns that into a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.arrays import slices
from tidegauge.llm.names import held_aside
from tidegauge.llm.workers import kept, release
from tidegauge.session import cut_lineage

ORDER = 6
DISCOUNT = 0.75
#: Tables of up to so many entries (16 bytes each) are broadcast whole; larger ones are joined, with the same results.
PLACES = 1 << 23
#: Up to so many labels (an id and a mark each) are broadcast to the texts; more are joined by a shuffle, with the same results.
LABELS = 4_000_000
#: At most so many labelled texts fit the logistic curve.
CALIBRATION_ROWS = 20_000
_PAD = "\x02"
_MEMO = 1 << 17
_WIDE = 40  # a batch has fewer n-grams than so many bits can count
_TOGETHER = 1 << 17  # n-grams looked up at once


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels are kept for measuring; a null key is one of them."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def calibrating(key: str = "doc_id") -> Column:
    return F.pmod(F.xxhash64(key), F.lit(5)) == 0


def grams(word: str, order: int = ORDER) -> list[str]:
    """The n-grams of a word between pads; each predicts its last character."""
    padded = _PAD * (order - 1) + word + _PAD
    return [padded[i : i + order] for i in range(len(word) + 1)]


def _count(texts: list[str | None], marks: list[int], order: int) -> dict[str, int]:
    """How often each n-gram is in toxic texts, ``_WIDE`` bits up, and in ordinary ones, below: one number takes a third of a pair's memory."""
    words: tuple[Counter, Counter] = (Counter(), Counter())
    for text, toxic in zip(texts, marks, strict=True):
        words[toxic].update((text or "").lower().split())
    counts: dict[str, int] = {}
    for toxic, seen in enumerate(words):
        while seen:  # words go as their n-grams come
            word, n = seen.popitem()
            n <<= _WIDE * toxic
            for gram in grams(word, order):
                counts[gram] = counts.get(gram, 0) + n
    return counts


def gram_counts(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, toxic, ordinary`` from ``text, toxic``: counts over all words of all texts, in lower case."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0, 16 << 20):
                counts = _count(part.column(0).to_pylist(), part.column(1).to_pylist(), order)
                toxic, ordinary = [n >> _WIDE for n in counts.values()], [n & (1 << _WIDE) - 1 for n in counts.values()]
                columns = [pa.array(counts, pa.string()), pa.array(toxic, pa.int64()), pa.array(ordinary, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["gram", "toxic", "ordinary"])

    partial = texts.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        run, "gram string, toxic long, ordinary long"
    )
    return partial.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def backoff(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, shared``: the shared Kneser-Ney probability of the last character after the shorter context.

    Level by level, from single characters up: the n-grams of a level are the endings of those above, each counted once
    per character that stands before it, whichever class it came from.
    """
    levels = [counts.select("gram")]
    for _ in range(order - 1):
        levels.append(levels[-1].select(F.expr("substring(gram, 2)").alias("gram")).distinct())
    below: DataFrame | None = None
    for n in range(order - 1, 0, -1):  # n characters dropped, the shortest first
        tail = F.expr("substring(gram, 2)")
        follows = levels[n - 1].groupBy(tail.alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        context = F.expr("substring(gram, 1, char_length(gram) - 1)")
        sums = follows.groupBy(context.alias("context")).agg(F.sum("n").alias("sum"), F.count(F.lit(1)).alias("types"))
        joined = follows.withColumn("context", context).join(sums, "context")
        if below is None:
            lower = F.lit(1.0) / F.lit(float(1 << 16))
        else:
            joined = joined.withColumn("tail", tail).join(below.withColumnsRenamed({"gram": "tail", "shared": "lower"}), "tail")
            lower = F.col("lower")
        value = (F.col("n") - DISCOUNT + DISCOUNT * F.col("types") * lower) / F.col("sum")
        below = cut_lineage(joined.select("gram", value.alias("shared")))
    return below


@dataclass
class Ratios:
    """One model table in memory: entries in order of their place, ``heads`` holds where each place begins."""

    heads: np.ndarray
    tags: np.ndarray
    values: np.ndarray


def tables(counts: DataFrame, order: int = ORDER) -> tuple[DataFrame, DataFrame]:
    """``gram, ratio``, written: the log ratios toxic : ordinary of all n-grams, and of backing off from all contexts."""
    contexts = cut_lineage(
        counts.groupBy(F.expr(f"substring(gram, 1, {order - 1})").alias("context")).agg(
            *[F.sum(c).alias(f"{c}_sum") for c in ("toxic", "ordinary")],
            *[F.sum((F.col(c) > 0).cast("long")).alias(f"{c}_types") for c in ("toxic", "ordinary")],
        )
    )

    def weight(c: str) -> Column:
        return F.when(F.col(f"{c}_sum") == 0, 1.0).otherwise(DISCOUNT * F.col(f"{c}_types") / F.col(f"{c}_sum"))

    def chance(c: str) -> Column:
        seen = F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.greatest(F.col(f"{c}_sum"), F.lit(1))
        return seen + weight(c) * F.col("shared")

    of_gram = (
        counts.withColumn("context", F.expr(f"substring(gram, 1, {order - 1})"))
        .join(contexts, "context")
        .withColumn("tail", F.expr("substring(gram, 2)"))
        .join(backoff(counts, order).withColumnRenamed("gram", "tail"), "tail")
        .select("gram", F.log(chance("toxic") / chance("ordinary")).cast("float").alias("ratio"))
    )
    of_context = contexts.select(
        F.col("context").alias("gram"),
        F.log(weight("toxic") / weight("ordinary")).cast("float").alias("ratio"),
    )
    return cut_lineage(of_gram), cut_lineage(of_context)


def _collected(ratios: DataFrame) -> Ratios:
    """All entries, for tables of at most ``PLACES``; there are as many places, and those that share one lie side by side."""
    rows = ratios.select(F.xxhash64("gram").alias("tag"), "ratio").toArrow()
    tags, values = rows["tag"].to_numpy(), rows["ratio"].to_numpy()
    size = max(1, len(tags))
    order = np.argsort(tags % size, kind="stable")
    tags, values = tags[order], values[order]
    return Ratios(np.searchsorted(tags % size, np.arange(size + 1)).astype(np.int32), tags, values)


class Scorer:
    """Describes texts by the two tables, those of a batch together; remembers short words, twice ``_MEMO`` and a batch's at most."""

    NAMES = ("mean", "first", "second", "third", "steepest")

    def __init__(self, of_gram: Ratios, of_context: Ratios, order: int = ORDER):
        self.table, self.context_table, self.order = of_gram, of_context, order
        self.known: dict[str, float] = {}
        self.before: dict[str, float] = {}

    @staticmethod
    def _find(table: Ratios, grams_: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The value of each n-gram, and which are in the table."""
        digest = xxhash.xxh64_intdigest
        tags = np.array([digest(gram.encode(), 42) for gram in grams_], np.uint64).view(np.int64)
        place = tags % (len(table.heads) - 1)
        at, end = table.heads[place], table.heads[place + 1]
        found, known = np.zeros(len(tags)), np.zeros(len(tags), bool)
        rest = np.flatnonzero(at < end)
        while len(rest):
            hit = table.tags[at[rest]] == tags[rest]
            known[rest[hit]] = True
            found[rest[hit]] = table.values[at[rest[hit]]]
            rest = rest[~hit]
            at[rest] += 1
            rest = rest[at[rest] < end[rest]]
        return found, known

    def ratios(self, words: list[str]) -> np.ndarray:
        """The log ratios of whole words."""
        total = np.zeros(len(words))
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.flatnonzero(np.diff(np.cumsum(sizes) // _TOGETHER, prepend=0)) + 1
        first = 0
        for last in (*ends.tolist(), len(words)):
            if last > first:
                found_in = [gram for word in words[first:last] for gram in grams(word, self.order)]
                value, known = self._find(self.table, found_in)
                unseen = np.flatnonzero(~known)
                value[unseen] = self._find(self.context_table, [found_in[i][:-1] for i in unseen.tolist()])[0]
                # Sums from left to right, so that a word's ratio doesn't depend on its neighbours.
                total[first:last] = np.bincount(np.repeat(np.arange(last - first), sizes[first:last]), value, last - first)
                first = last
        return total

    def describe(self, texts: list[str | None]) -> np.ndarray:
        """A row per text: mean log ratio per character, the three strongest words, and the strongest per character; zeros if empty."""
        counted = [Counter((text or "").lower().split()) for text in texts]
        known, before = self.known, self.before
        new = {word: before.get(word) for words in counted for word in words if word not in known}
        unseen = [word for word, value in new.items() if value is None]
        new.update(zip(unseen, self.ratios(unseen).tolist(), strict=True))
        lengths = np.fromiter(map(len, counted), np.int64, len(counted))
        n = int(lengths.sum())
        values = np.fromiter((known[w] if w in known else new[w] for words in counted for w in words), float, n)
        times = np.fromiter((c for words in counted for c in words.values()), np.int64, n)
        sizes = np.fromiter((len(w) for words in counted for w in words), np.int64, n) + 1
        if len(known) + len(new) > _MEMO:  # what is still in use comes over from the older half
            self.before, self.known = known, {}
        self.known.update((word, value) for word, value in new.items() if len(word) <= 32)
        described = np.zeros((len(texts), len(self.NAMES)))
        owner = np.repeat(np.arange(len(texts)), lengths)
        total, length = (np.bincount(owner, times * x, len(texts)) for x in (values, sizes))
        steep, last = values / sizes, np.cumsum(lengths)
        for i in np.flatnonzero(lengths).tolist():
            own = slice(last[i] - lengths[i], last[i])
            top = np.sort(values[own])[:-4:-1].tolist()
            top += [min(0.0, top[-1])] * (3 - len(top))
            described[i] = [total[i] / length[i], *top, steep[own].max()]
        return described


def _scorer(tables_: tuple[Ratios, Ratios], order: int) -> Scorer:
    """The worker's scorer for these tables; later tasks of the worker go on with the words it knows."""
    if (scorer := kept(tables_, lambda: Scorer(*tables_, order))).order != order:
        release()
        scorer = kept(tables_, lambda: Scorer(*tables_, order))
    return scorer


@dataclass
class Curve:
    """A logistic curve over standardised features."""

    middle: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def score(self, features: np.ndarray) -> np.ndarray:
        z = np.clip((features - self.middle) / self.scale, -8, 8)
        return 1 / (1 + np.exp(-np.clip(z @ self.weights[1:] + self.weights[0], -50, 50)))


def fit_curve(features: np.ndarray, labels: np.ndarray, ridge: float = 1.0) -> Curve:
    """Newton's method; the ridge holds where classes part completely."""
    middle, scale = features.mean(0), features.std(0) + 1e-9
    z = np.column_stack([np.ones(len(features)), np.clip((features - middle) / scale, -8, 8)])
    weights, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -50, 50)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty), z.T @ (labels - p) - penalty * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return Curve(middle, scale, weights)


@dataclass
class Model:
    of_gram: DataFrame
    of_context: DataFrame
    curve: Curve | None
    share: float
    order: int = ORDER
    shared: Broadcast | None = None  # both tables in memory, where they are small enough


def _described(docs: DataFrame, keep: list[str], model: Model) -> DataFrame:
    """``keep`` and the features of ``text``."""
    if model.shared is None:
        return _joined(docs, keep, model)
    shared, order = model.shared, model.order
    read = keep if "text" in keep else [*keep, "text"]
    text, features = read.index("text"), [f"_{name}" for name in Scorer.NAMES]
    fields = [f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep] + [f"{f} double" for f in features]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared.value, order)
        for batch in batches:
            for part in slices(batch, text, 1 << 20):
                found = scorer.describe(part.column(text).to_pylist())
                columns = [part.column(i) for i in range(len(keep))] + [pa.array(found[:, i]) for i in range(found.shape[1])]
                yield pa.RecordBatch.from_arrays(columns, [*keep, *features])

    return docs.select(*read).mapInArrow(run, ", ".join(fields))


def _joined(docs: DataFrame, keep: list[str], model: Model) -> DataFrame:
    """The same by joins: distinct n-grams with the tables, words with their n-grams, texts with their words.

    Texts and words are named by their md5, so copies of a text are described once and long words are not repeated.
    """
    order = model.order

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                rows = [(k, w, n) for k, t in zip(*(c.to_pylist() for c in part.columns), strict=True) for w, n in Counter((t or "").lower().split()).items()]
                columns = zip(*rows, strict=True) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.string(), pa.int64()), strict=True)], ["text_key", "word", "n"]
                )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, 1 << 18):
                keys, words = (c.to_pylist() for c in part.columns)
                found = [grams(w, order) for w in words]
                keys = [k for k, own in zip(keys, found, strict=True) for _ in own]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([g for own in found for g in own], pa.string())], ["word_key", "gram"])

    def named(c: str) -> Column:
        return F.unhex(F.md5(F.coalesce(F.col(c), F.lit("")).cast("binary")))

    counted = docs.select(named("text").alias("text_key"), "text").mapInArrow(count, "text_key binary, word string, n long")
    pairs = cut_lineage(counted.groupBy("text_key", "word").agg(F.max("n").alias("n")).withColumn("word_key", named("word")))
    parts = cut_lineage(pairs.select("word_key", "word").distinct().mapInArrow(split, "word_key binary, gram string"))
    context = F.expr(f"substring(gram, 1, {order - 1})")
    back = model.of_context.select(F.col("gram").alias("context"), F.col("ratio").alias("back"))
    ratios = (
        parts.select("gram").distinct().join(model.of_gram, "gram", "left").withColumn("context", context).join(back, "context", "left")
        .select("gram", F.coalesce("ratio", "back", F.lit(0.0)).cast("double").alias("ratio"))
    )
    values = parts.join(ratios, "gram").groupBy("word_key").agg(F.sum("ratio").alias("value"))
    value, size = F.col("value"), F.char_length("word") + 1
    texts = pairs.join(values, "word_key").groupBy("text_key").agg(
        (F.sum(F.col("n") * value) / F.sum(F.col("n") * size)).alias("mean"),
        F.slice(F.sort_array(F.collect_list(value), asc=False), 1, 3).alias("top"),  # at most the words of one text
        F.max(value / size).alias("steepest"),
    )
    last = F.least(F.lit(0.0), F.element_at("top", -1))
    top = [F.coalesce(F.get("top", F.lit(i)), last) for i in range(3)]
    features = dict(zip(Scorer.NAMES, ["mean", *(f"top{i}" for i in range(3)), "steepest"], strict=True))
    texts = texts.select("text_key", "mean", *[t.alias(f"top{i}") for i, t in enumerate(top)], "steepest")
    texts = texts.select(F.col("text_key").alias("_text_key"), *[F.col(c).alias(f"_{name}") for name, c in features.items()])
    own = docs.select(*keep, named("text").alias("_text_key")).join(texts, "_text_key", "left")
    return own.select(*keep, *[F.coalesce(f"_{name}", F.lit(0.0)).alias(f"_{name}") for name in Scorer.NAMES])


def train(docs: DataFrame, labels: DataFrame, order: int = ORDER, places: int = PLACES) -> Model:
    """A model from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``).

    All labelled rows that are not held out take part: four fifths are counted, the rest fits the curve (at most
    ``CALIBRATION_ROWS`` of them). Null labels and ids are left out; of several labels of one id the largest counts.
    Tables of more than ``places`` entries are joined instead of broadcast.
    """
    spark = docs.sparkSession
    usable = cut_lineage(
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    texts = docs.select("doc_id", "text").filter(~held_out() & ~calibrating())
    counted = usable.filter(~calibrating())
    if counted.count() <= LABELS:  # whole texts then stay where they are read
        counted = F.broadcast(counted)
    counts = cut_lineage(gram_counts(texts.join(counted, "doc_id"), order))
    model = Model(*tables(counts, order), None, 0.0, order)
    if max(model.of_gram.count(), model.of_context.count()) <= places:
        model.shared = spark.sparkContext.broadcast((_collected(model.of_gram), _collected(model.of_context)))
    sample = usable.filter(calibrating()).orderBy(F.xxhash64("doc_id")).limit(CALIBRATION_ROWS)
    known = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # bounded by the limit
    features = [f"_{name}" for name in Scorer.NAMES]
    # Of repeated ids one row stays, so what is collected is bounded as well.
    single = _described(known, ["doc_id", "toxic"], model).groupBy("doc_id", "toxic").agg(F.max(F.struct(*features)).alias("found"))
    rows = single.select("doc_id", "toxic", "found.*").toPandas().sort_values("doc_id")
    found, marks = rows[features].to_numpy(float), rows["toxic"].to_numpy(float)
    model.curve = fit_curve(found, marks) if len(set(marks)) == 2 else None
    model.share = float(marks.mean()) if len(marks) else 0.0
    return model


def score(docs: DataFrame, model: Model, keep: list[str], into: str = "score") -> DataFrame:
    """``keep`` and ``into``, 0 to 1, per row. Whole texts; a null text counts as empty.

    Without labels of both classes every row gets the share of toxic labels, 0 if there are none. ``keep`` may have any names
    but ``into``.
    """
    if model.curve is None:
        return docs.select(*keep, F.lit(model.share).alias(into))
    held, names = held_aside(docs, keep)
    described = _described(held, names, model)
    curve, z = model.curve, F.lit(float(model.curve.weights[0]))
    for name, middle, scale, weight in zip(Scorer.NAMES, curve.middle, curve.scale, curve.weights[1:], strict=True):
        standard = (F.col(f"_{name}") - float(middle)) / float(scale)
        z = z + F.greatest(F.least(standard, F.lit(8.0)), F.lit(-8.0)) * float(weight)
    return described.select(*[F.col(n).alias(k) for n, k in zip(names, keep, strict=True)], (1 / (1 + F.exp(-z))).alias(into))
