"""Text quality learned from positives and unlabelled text, by non-negative unbiased risk.

Trusted positives are documents labelled good; unlabelled is any web text. With the class prior p the risk of a scorer g is
p E+[l(g)] + max(0, Eu[l(-g)] - p E+[l(-g)]): what positives hide in the unlabelled text is subtracted, and where the
difference falls below zero, which is overfitting, the step goes the other way. g is a small network over the shape of
a text: kinds of characters, lengths and repetition of words and lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.arrays import flat, slices, words
from tidegauge.llm.names import held_aside
from tidegauge.llm.toxicity import held_out
from tidegauge.llm.workers import release

#: The classifier is fitted on at most so many positives and so many unlabelled texts.
SAMPLE_ROWS = 20_000
HIDDEN, ROUNDS, RATE, DECAY = 16, 600, 0.02, 1e-4

_KINDS = ["upper", "lower", "digit", "blank", "newline", "stop", "!", "%", "*", "#", "$", "&", "|", "mark", "wide", "control"]
_KIND = np.full(256, _KINDS.index("mark"), np.int64)
_KIND[:32], _KIND[127] = _KINDS.index("control"), _KINDS.index("control")
_KIND[128:] = _KINDS.index("wide")
for _chars, _name in [
    (range(65, 91), "upper"), (range(97, 123), "lower"), (range(48, 58), "digit"), (b" \t\r\v\f", "blank"), (b"\n", "newline"), (b".,;:'\"?-()", "stop"),
    *[(k.encode(), k) for k in "!%*#$&|"],
]:
    _KIND[list(_chars)] = _KINDS.index(_name)
FEATURES = len(_KINDS) + 9


def describe(column: pa.Array) -> np.ndarray:
    """One row of features per text; null and empty texts give zeros."""
    data, offsets = flat(column)
    n, out = len(offsets) - 1, np.zeros((len(offsets) - 1, FEATURES))
    lengths = np.diff(offsets)
    for first in range(0, n, 256):  # the per-byte arrays stay small
        last = min(n, first + 256)
        part = data[offsets[first] : offsets[last]]
        at = np.repeat(np.arange(last - first), lengths[first:last])
        kinds = np.bincount(at * len(_KINDS) + _KIND[part], minlength=(last - first) * len(_KINDS))
        out[first:last, : len(_KINDS)] = kinds.reshape(-1, len(_KINDS)) / np.maximum(lengths[first:last, None], 1)
    hashes, heads = words(data, offsets)
    upper = (data >= 65) & (data <= 90)
    runs = np.concatenate(([0], np.cumsum(upper[1:] & upper[:-1])))  # capitals after capitals
    lines = np.flatnonzero(data == 10)
    for i in range(n):
        own = hashes[heads[i] : heads[i + 1]]
        if not len(own):
            continue
        k = len(_KINDS)
        _, counts = np.unique(own, return_counts=True)
        pairs = own[1:] * np.uint64(3) + own[:-1] if len(own) > 1 else own
        breaks = lines[np.searchsorted(lines, offsets[i]) : np.searchsorted(lines, offsets[i + 1])]
        out[i, k:] = (
            np.log1p(len(own)),
            min(lengths[i] / len(own), 40.0),
            len(counts) / len(own),
            counts.max() / len(own),
            (counts == 1).sum() / len(own),
            1 - len(np.unique(pairs)) / len(pairs),
            len(breaks) / len(own),
            (runs[offsets[i + 1] - 1] - runs[offsets[i]]) / lengths[i],
            np.log1p(len(counts)) / np.log1p(len(own)),
        )
    return out


@dataclass
class Network:
    """Scores by one hidden layer; ``prior`` alone where there was nothing to learn from."""

    prior: float
    middle: np.ndarray | None = None
    scale: np.ndarray | None = None
    layers: tuple[np.ndarray, ...] = ()

    def raw(self, z: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return np.tanh(z @ a + b) @ c + d

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.middle is None:
            return np.full(len(features), self.prior)
        z = np.clip((features - self.middle) / self.scale, -6, 6)
        return 1 / (1 + np.exp(-np.clip(self.raw(z), -50, 50)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def fit(positives: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 7) -> Network:
    """Minimise the non-negative risk with the logistic loss, by Adam over whole samples."""
    if not len(positives) or not len(unlabelled) or not 0 < prior < 1:
        return Network(prior)
    both = np.concatenate([positives, unlabelled])
    middle, scale = both.mean(0), both.std(0) + 1e-6
    p, u = (np.clip((x - middle) / scale, -6, 6) for x in (positives, unlabelled))
    rng = np.random.default_rng(seed)
    layers = [rng.normal(0, 1 / np.sqrt(p.shape[1]), (p.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.25, HIDDEN), np.zeros(())]
    first, second = [np.zeros_like(x) for x in layers], [np.zeros_like(x) for x in layers]

    def push(x: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        """Gradients of the layers where ``slope`` is the loss's derivative by g, per row."""
        a, b, c, _ = layers
        hidden = np.tanh(x @ a + b)
        back = slope[:, None] * c * (1 - hidden**2)
        return [x.T @ back, back.sum(0), hidden.T @ slope, slope.sum()]

    best, kept = np.inf, [x.copy() for x in layers]
    for step in range(1, ROUNDS + 1):
        g_p, g_u = (np.tanh(x @ layers[0] + layers[1]) @ layers[2] + layers[3] for x in (p, u))
        hidden_risk = np.logaddexp(0, g_u).mean() - prior * np.logaddexp(0, g_p).mean()
        risk = prior * np.logaddexp(0, -g_p).mean() + max(0.0, hidden_risk)
        if risk < best:
            best, kept = risk, [x.copy() for x in layers]
        negative_p, negative_u = -prior * _sigmoid(g_p) / len(p), _sigmoid(g_u) / len(u)
        if hidden_risk >= 0:
            slope_p, slope_u = -prior * _sigmoid(-g_p) / len(p) + negative_p, negative_u
        else:
            slope_p, slope_u = -negative_p, -negative_u
        grads = [x + y for x, y in zip(push(p, slope_p), push(u, slope_u), strict=True)]
        for i, grad in enumerate(grads):
            grad = grad + DECAY * layers[i]
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.999 * second[i] + 0.001 * grad**2
            layers[i] = layers[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Network(prior, middle, scale, tuple(kept))


def _mapped(docs: DataFrame, keep: list[str], schema: str, make) -> DataFrame:
    """``keep`` and ``_found``: what ``make()`` gives for the features of each slice of texts."""
    read = keep if "text" in keep else [*keep, "text"]
    text = read.index("text")
    fields = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        work = make()
        for batch in batches:
            for part in slices(batch, text, 1 << 20):
                columns = [part.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, work(describe(part.column(text)))], [*keep, "_found"])

    return docs.select(*read).mapInArrow(run, f"{fields}, _found {schema}")


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Network:
    """A network from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, quality``).

    Only labels of rows that are not held out are read. The prior is the share of good ones among them. Positives are a
    hash sample of at most ``rows`` good documents, unlabelled text is one of all documents, whatever their label. Null
    labels and ids are left out; of several labels of one id the smallest counts.
    """
    usable = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )
    share = usable.agg(F.avg("quality")).first()[0]
    if share is None:
        return Network(0.5)
    draw = F.xxhash64("doc_id", F.lit(6))
    positives = usable.filter("quality = 1").orderBy(draw, "doc_id").limit(rows).select("doc_id", F.lit(1).alias("positive"))
    web = docs.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct().orderBy(draw, "doc_id").limit(rows)
    chosen = positives.unionByName(web.select("doc_id", F.lit(0).alias("positive")))
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by the limits
    described = _mapped(
        sample, ["doc_id", "positive"], "array<double>",
        lambda: lambda x: pa.ListArray.from_arrays(np.arange(0, x.size + 1, FEATURES, dtype=np.int32), pa.array(x.ravel())),
    )
    # Of repeated ids one row stays, so what is collected is bounded as well.
    found = described.groupBy("doc_id", "positive").agg(F.max("_found").alias("_found")).toPandas().sort_values(["doc_id", "positive"])
    features = np.array(found["_found"].tolist()).reshape(-1, FEATURES)
    marks = found["positive"].to_numpy() == 1
    return fit(features[marks], features[~marks], float(share))


def score(docs: DataFrame, model: Network, keep: list[str], into: str = "score") -> DataFrame:
    """``keep`` and ``into``, 0 to 1, per row, from whole texts; a null text counts as empty.

    Without any label the score is 0.5, with labels of one class only it is the prior. ``keep`` may
    have any names but ``into``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    held, names = held_aside(docs, keep)
    scored = _mapped(held, names, "double", lambda: lambda x: pa.array(shared.value.score(x)))
    return scored.select(*[F.col(n).alias(k) for n, k in zip(names, keep, strict=True)], F.col("_found").alias(into))
