"""Approximate nearest neighbours by cosine: a neighbour graph grown by NN-descent, searched greedily.

Rows are dealt into shards of bounded size, and each shard has a graph of its own, so a search can hold one shard in
memory while the number of shards follows the table. Every row has a list of its nearest rows so far. A round joins
the lists with the rows they name, in both directions, and lets all neighbours of a row meet: neighbours of neighbours are
often neighbours. Queries walk every shard's graph in both directions, from a few fixed rows and from the nearest rows of
the cells around them, always opening the nearest rows not opened yet; what they find is scored exactly and merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.covertree import usable
from tidegauge.session import cut_lineage

SHARD_ROWS, QUERY_ROWS = 16_384, 1024
#: Neighbours kept per row, rows that meet per round and direction, rounds, trees of the first lists, rows per first group.
DEGREE, MEETING, ROUNDS, TREES, GROUP = 24, 12, 4, 4, 64
#: Rows a search keeps, rows it opens at once, entry rows; cells of a shard whose rows are all looked at for entries.
BEAM, OPENED, ENTRIES, PROBED = 192, 8, 96, 4


def prepared(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, v`` as doubles, one row per id.

    Rows with a null id or with a vector that is null, zero or holds a null or non-finite component are left out; of several
    rows of an id the one with the smallest vector stays. Vectors are divided by the power of two below their largest
    component, which changes no digit of a cosine but keeps squares from overflowing.
    """
    fine = vectors.filter(F.col(key).isNotNull() & usable(F.col(vector))).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("raw")
    )
    fine = fine.filter(F.exists("raw", lambda x: x != 0)).groupBy("id").agg(F.min("raw").alias("raw"))
    largest = F.aggregate("raw", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x)))
    scaled = fine.withColumn("unit", F.pow(F.lit(2.0), F.floor(F.log2(largest))))
    return scaled.select("id", F.transform("raw", lambda x: x / F.col("unit")).alias("v"))


def _stacked(column: pa.Array) -> np.ndarray:
    """A list column of equally long lists as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x / np.sqrt((x * x).sum(1, keepdims=True))).astype(np.float32)


def _codes(rows: DataFrame) -> DataFrame:
    """``id, shard, code``: vectors of unit length in single precision, as bytes, for everything before the last scoring."""

    def run(batches):
        for batch in batches:
            found = _unit(_stacked(batch.column(2))) if batch.num_rows else np.zeros((0, 1), np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.tobytes() for x in found], pa.binary())], ["id", "shard", "code"])

    return rows.select("id", "shard", "v").mapInArrow(run, "id long, shard int, code binary")


def first_lists(codes: DataFrame, trees: int = TREES) -> DataFrame:
    """``u, w, sim``: pairs that meet in groups of nearby rows, several groupings.

    A grouping sorts the rows of a shard by the signs of four random projections, then by a fifth, and cuts the order into
    groups of ``GROUP`` rows.
    """

    def project(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float32).reshape(batch.num_rows, -1)
            for tree in range(trees):
                planes = np.random.default_rng(1000 + tree).normal(size=(x.shape[1], 5))
                sides = x @ planes
                cell = (sides[:, :4] > 0) @ (1 << np.arange(4))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(2), pa.array(cell + 16 * tree, pa.int32()), pa.array(sides[:, 4])],
                    ["id", "shard", "code", "cell", "place"],
                )

    placed = codes.mapInArrow(project, "id long, shard int, code binary, cell int, place double")
    order = Window.partitionBy("shard", "cell").orderBy("place", "id")
    groups = placed.withColumn("part", F.floor((F.row_number().over(order) - 1) / GROUP)).groupBy("shard", "cell", "part")
    met = groups.agg(F.sort_array(F.collect_list(F.struct("id", "code"))).alias("rows"))
    return _meet(met.select("rows"), GROUP // 4)


def _meet(groups: DataFrame, most: int) -> DataFrame:
    """``u, w, sim`` of all rows that meet in a group; each row keeps its ``most`` best of the group. Groups are small."""

    def run(batches):
        for batch in batches:
            out_u, out_w, out_s = [], [], []
            for group in batch.column(0).to_pylist():
                if len(group) < 2:
                    continue
                ids = np.array([r["id"] for r in group])
                x = np.frombuffer(b"".join(r["code"] for r in group), np.float32).reshape(len(ids), -1)
                sims = x @ x.T
                np.fill_diagonal(sims, -np.inf)
                k = min(most, len(ids) - 1)
                best = np.argpartition(-sims, k - 1, 1)[:, :k]
                out_u.append(np.repeat(ids, k))
                out_w.append(ids[best].ravel())
                out_s.append(np.take_along_axis(sims, best, 1).ravel())
            if out_u:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out_u)), pa.array(np.concatenate(out_w)), pa.array(np.concatenate(out_s).astype(np.float32))], ["u", "w", "sim"]
                )

    return groups.mapInArrow(run, "u long, w long, sim float")


def _nearest(pairs: DataFrame, degree: int = DEGREE) -> DataFrame:
    """``u, w, sim``: the ``degree`` nearest of each row."""
    order = Window.partitionBy("u").orderBy(F.col("sim").desc(), "w")
    return pairs.groupBy("u", "w").agg(F.max("sim").alias("sim")).withColumn("n", F.row_number().over(order)).filter(
        F.col("n") <= degree
    ).drop("n")


def neighbour_graph(codes: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``u, w, sim`` for every row of ``codes``, by ``rounds`` of neighbours of neighbours.

    A round takes ``MEETING`` of a row's list and as many of the lists it stands in, drawn anew each time, so a row in
    very many lists makes no large group.
    """
    graph = cut_lineage(_nearest(first_lists(codes)))
    named = codes.select(F.col("id").alias("w"), "code")
    for number in range(rounds):
        draw = F.xxhash64("u", "w", F.lit(number))

        def some(edges: DataFrame, by: Column = draw) -> DataFrame:
            order = Window.partitionBy("at").orderBy(by)
            return edges.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= MEETING)

        forward = some(graph.withColumn("at", F.col("u"))).select("at", F.col("w"))
        backward = some(graph.withColumn("at", F.col("w"))).select("at", F.col("u").alias("w"))
        met = forward.union(backward).distinct().join(named, "w").groupBy("at").agg(
            F.sort_array(F.collect_list(F.struct(F.col("w").alias("id"), "code"))).alias("rows")
        )
        graph = cut_lineage(_nearest(graph.unionByName(_meet(met.select("rows"), 4))))
    return graph


def both_ways(x: np.ndarray, links: np.ndarray) -> np.ndarray:
    """``links`` and as many columns of the nearest rows that name a row."""
    n, width = links.shape
    u, column = np.nonzero(links >= 0)
    w = links[u, column]
    sims = np.concatenate([np.einsum("ij,ij->i", x[u[i : i + 65_536]], x[w[i : i + 65_536]]) for i in range(0, len(u), 65_536)] or [np.zeros(0)])
    order = np.lexsort((u, -sims, w))
    u, w = u[order], w[order]
    place = np.arange(len(w)) - np.searchsorted(w, w)
    back = np.full((n, width), -1)
    near = place < width
    back[w[near], place[near]] = u[near]
    return np.concatenate([links, back], 1)


def entries(x: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Per query the nearest rows of the ``PROBED`` cells around it, ``ENTRIES`` each at most, -1 where there are fewer.

    A cell holds the rows nearest to one of about sqrt(n) centres; every row is in one and all rows of a cell are compared.
    """
    n, m = len(x), len(queries)
    centres = x[np.random.default_rng(6).choice(n, int(np.ceil(np.sqrt(n))), replace=False)]
    for _ in range(3):
        cell = (x @ centres.T).argmax(1)
        sums = np.stack([np.bincount(cell, x[:, j], len(centres)) for j in range(x.shape[1])], 1)
        size = np.sqrt((sums * sums).sum(1, keepdims=True))
        centres = np.where(size > 0, sums / np.maximum(size, 1e-30), centres).astype(np.float32)
    cell = (x @ centres.T).argmax(1)
    rows_of = np.split(np.argsort(cell, kind="stable"), np.cumsum(np.bincount(cell, minlength=len(centres)))[:-1])
    centres, rows_of = centres[[len(r) > 0 for r in rows_of]], [r for r in rows_of if len(r)]
    probed = np.argsort(-(queries @ centres.T), 1, kind="stable")[:, :PROBED]
    found = np.full((m, probed.shape[1], ENTRIES), -1)
    for number, rows in enumerate(rows_of):
        at, turn = np.nonzero(probed == number)
        k = min(ENTRIES, len(rows))
        for first in range(0, len(at), 256):  # a cell can hold the whole shard
            some = slice(first, first + 256)
            best = np.argpartition(-(queries[at[some]] @ x[rows].T), k - 1, 1)[:, :k]
            found[at[some], turn[some], :k] = rows[best]
    return found.reshape(m, -1)


def walk(x: np.ndarray, links: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy search of all queries at once: ``(rows, similarities)`` of the ``k`` nearest found, -1 where there are fewer.

    ``links`` holds row numbers, -1 where a list is shorter; they are followed in both directions. ``own`` is the row a query is itself, or -1: it is a good place to
    start, but no result. The walk ends when the kept rows have all been opened.
    """
    n, m = len(x), len(queries)
    links = both_ways(x, links)
    beam = min(BEAM, n)
    starts = np.random.default_rng(5).choice(n, min(n, ENTRIES), replace=False)
    seen = np.zeros((m, n), bool)
    kept = np.full((m, beam), -1)
    near = np.full((m, beam), -np.inf, np.float32)
    opened = np.ones((m, beam), bool)
    lines = np.arange(m)[:, None]

    def take(candidates: np.ndarray) -> None:
        """Merge row numbers (m, c) into what is kept; repeated and seen ones are skipped."""
        nonlocal kept, near, opened
        candidates = np.sort(candidates, 1)
        fresh = candidates >= 0
        fresh[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
        fresh &= ~seen[lines, np.maximum(candidates, 0)]
        at, column = np.nonzero(fresh)
        rows = candidates[at, column]
        seen[at, rows] = True
        sims = np.full(candidates.shape, -np.inf, np.float32)
        for first in range(0, len(at), 1 << 16):  # the gathered vectors stay small
            part = slice(first, first + (1 << 16))
            sims[at[part], column[part]] = np.einsum("ij,ij->i", queries[at[part]], x[rows[part]])
        all_near = np.concatenate([near, sims], 1)
        order = np.argsort(-all_near, 1, kind="stable")[:, :beam]
        kept = np.take_along_axis(np.concatenate([kept, np.where(fresh, candidates, -1)], 1), order, 1)
        near = np.take_along_axis(all_near, order, 1)
        opened = np.take_along_axis(np.concatenate([opened, ~fresh], 1), order, 1)

    first = np.broadcast_to(starts, (m, len(starts)))
    take(np.concatenate([first, own[:, None]], 1))
    take(entries(x, queries))
    while not opened.all():
        order = np.argsort(opened, 1, kind="stable")[:, :OPENED]  # the nearest that are not opened
        closed = ~np.take_along_axis(opened, order, 1)
        rows = np.where(closed, np.take_along_axis(kept, order, 1), -1)
        np.put_along_axis(opened, order, True, 1)
        take(np.where(rows[:, :, None] >= 0, links[np.maximum(rows, 0)], -1).reshape(m, -1))
    near[(kept == own[:, None]) & (kept >= 0)] = -np.inf
    order = np.argsort(-near, 1, kind="stable")[:, :k]
    return np.take_along_axis(np.where(np.isfinite(near), kept, -1), order, 1), np.take_along_axis(near, order, 1)


def search(vectors: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", rounds: int = ROUNDS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each row of ``queries``, itself left out.

    Score is the cosine in double precision, equal ones in order of vec_id. :func:`prepared` says which rows take part; all of
    those are indexed, vectors of other lengths apart. A table of up to ``BEAM`` rows a shard is searched whole. The result is
    approximate: recall is measured in the tests.
    """
    asks = vectors.filter(queries).select(F.col(key).cast("long").alias("id")).filter(F.col("id").isNotNull()).distinct()
    rows = cut_lineage(prepared(vectors, key, vector))
    lengths = rows.groupBy(F.size("v").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    shards = F.ceil(F.col("n") / SHARD_ROWS)
    # The shards of one length come after those of the shorter ones.
    upto = Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1)
    lengths = lengths.select("length", shards.alias("shards"), F.coalesce(F.sum(shards).over(upto), F.lit(0)).alias("base"))
    rows = cut_lineage(
        rows.withColumn("length", F.size("v")).join(lengths, "length")
        .withColumn("shard", (F.col("base") + F.pmod(F.xxhash64("id"), F.col("shards"))).cast("int"))
    )
    codes = cut_lineage(_codes(rows))
    lists = neighbour_graph(codes, rounds).groupBy("u").agg(F.sort_array(F.collect_list("w")).alias("links"))
    asked = cut_lineage(rows.join(asks, "id").select("id", "v", "base", "shards"))
    blocks = -(-asked.count() // QUERY_ROWS) or 1
    graph = codes.join(lists, codes["id"] == lists["u"], "left").select(
        "id", "shard", "code", "links", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    )
    asked_codes = asked.select(
        "id", "v", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.col("base").cast("int"), (F.col("base") + F.col("shards") - 1).cast("int"))).alias("shard"),
    )

    def greedy(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64)})
        left, right = left.sort_values("id"), right.sort_values("id")
        ids, wanted = right["id"].to_numpy(), left["id"].to_numpy()
        x = np.frombuffer(b"".join(right["code"]), np.float32).reshape(len(ids), -1)
        links = np.full((len(ids), DEGREE), -1)
        sizes = np.array([0 if w is None else len(w) for w in right["links"]])
        if sizes.sum():
            named = np.concatenate([w for w in right["links"] if w is not None])
            links[np.arange(DEGREE) < sizes[:, None]] = np.searchsorted(ids, named)
        own = np.searchsorted(ids, wanted)
        own = np.where((own < len(ids)) & (ids[np.minimum(own, len(ids) - 1)] == wanted), own, -1)
        found, _ = walk(x, links, _unit(np.stack(left["v"].to_list())), own, k + 3)
        at, column = np.nonzero(found >= 0)
        return pd.DataFrame({"query_id": wanted[at], "vec_id": ids[found[at, column]]})

    cell = ["shard", "block"]
    pairs = asked_codes.groupBy(*cell).cogroup(graph.groupBy(*cell)).applyInPandas(greedy, "query_id long, vec_id long")
    of_query = asked.select(F.col("id").alias("query_id"), F.col("v").alias("a"))
    of_row = rows.select(F.col("id").alias("vec_id"), F.col("v").alias("b"))
    def product(a: str, b: str) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    cosine = product("a", "b") / (F.sqrt(product("a", "a")) * F.sqrt(product("b", "b")))
    scored = pairs.join(of_row, "vec_id").join(of_query, "query_id").select("query_id", "vec_id", cosine.alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
