"""Exact top-k inner products by dual-tree search over cover trees.

Queries and data are dealt into blocks of bounded size; each pair of a query block and a data block is one group, in
which both sides are indexed by a cover tree and the trees are walked together. No inner product between two nodes can
exceed <q, p> + |p| Rq + |q| Rp + Rq Rp, with their centres q, p and covering radii Rq, Rp; a pair whose bound is below the
worst k-th score of the node's queries is dropped. The best of all data blocks are merged per query.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.session import cut_lineage

DATA_ROWS, QUERY_ROWS = 8192, 1024
LEAF, SHRINK, FANOUT, BATCH = 256, 0.8, 64, 2048


@dataclass
class Node:
    centre: np.ndarray
    radius: float
    rows: np.ndarray
    children: list[Node] = field(default_factory=list)


def cover_tree(vectors: np.ndarray, rows: np.ndarray, leaf: int = LEAF) -> Node:
    """A tree whose children's centres are rows, each further from the others than the radius it covers.

    Radii shrink by ``SHRINK`` per level. Centres that a level can no longer tell apart by ``FANOUT`` of them, and rows that
    are equal, end in leaves, which are scored as one matrix product.
    """
    centre = vectors[rows[0]]
    gaps = np.sqrt(((vectors[rows] - centre) ** 2).sum(1))
    root = Node(centre, float(gaps.max()) if len(rows) else 0.0, rows)
    todo = [root]
    while todo:
        node = todo.pop()
        if len(node.rows) <= leaf or node.radius == 0:
            continue
        left, reach = node.rows, node.radius * SHRINK
        parts: list[Node] = []
        while len(left) and len(parts) < FANOUT:
            gaps = np.sqrt(((vectors[left] - vectors[left[0]]) ** 2).sum(1))
            near = gaps <= reach
            parts.append(Node(vectors[left[0]], float(gaps[near].max()), left[near]))
            left = left[~near]
        if len(left):  # too spread out for this radius: the nearest centre takes the rest, with the radius it needs
            centres = np.array([p.centre for p in parts])
            gaps = ((vectors[left] ** 2).sum(1)[:, None] - 2 * vectors[left] @ centres.T) + (centres**2).sum(1)
            nearest = gaps.argmin(1)
            for i, part in enumerate(parts):
                more = left[nearest == i]
                if len(more):
                    far = np.sqrt(((vectors[more] - part.centre) ** 2).sum(1)).max()
                    part.rows, part.radius = np.concatenate([part.rows, more]), max(part.radius, float(far))
        if len(parts) == 1 and parts[0].radius >= node.radius:
            continue
        node.children = parts
        todo += [p for p in parts if len(p.rows) < len(node.rows)]
    return root


def dual_tree(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, data_ids: np.ndarray, k: int):
    """Per query the ``k`` best data rows of another id: ``(scores, ids)`` per query row, best first, ties to the smaller id."""
    found_s = np.full((len(queries), k), -np.inf)
    found_i = np.full((len(queries), k), np.iinfo(np.int64).max)
    q_root, d_root = (cover_tree(x, np.arange(len(x)), 64 if x is queries else LEAF) for x in (queries, data))

    def bounds(q: Node, nodes: list[Node]) -> np.ndarray:
        centres = np.array([n.centre for n in nodes])
        radii = np.array([n.radius for n in nodes])
        sizes = np.sqrt((centres**2).sum(1))
        best = centres @ q.centre + sizes * q.radius + np.sqrt(q.centre @ q.centre) * radii + q.radius * radii
        return best + 1e-9 * (1 + np.abs(best))  # rounding of the roots; a tie must stay

    def score(q: Node, rows: np.ndarray) -> None:
        s = queries[q.rows] @ data[rows].T
        s[query_ids[q.rows][:, None] == data_ids[rows][None, :]] = -np.inf
        all_s = np.concatenate([found_s[q.rows], s], 1)
        ids = np.concatenate([found_i[q.rows], np.broadcast_to(data_ids[rows], s.shape)], 1)
        if all_s.shape[1] > 4 * k:  # only what reaches the k-th score takes part in the exact order
            worst = np.partition(all_s, all_s.shape[1] - k, 1)[:, all_s.shape[1] - k]
            width = int((all_s >= worst[:, None]).sum(1).max())
            pick = np.argpartition(-all_s, min(width, all_s.shape[1]) - 1, 1)[:, :width]
            all_s, ids = np.take_along_axis(all_s, pick, 1), np.take_along_axis(ids, pick, 1)
        order = np.lexsort((ids, -all_s), axis=1)[:, :k]
        found_s[q.rows] = np.take_along_axis(all_s, order, 1)
        found_i[q.rows] = np.take_along_axis(ids, order, 1)

    todo = [(q_root, [d_root])]
    while todo:
        q, nodes = todo.pop()
        best = bounds(q, nodes)
        order = np.argsort(-best, kind="stable")
        if q.children:
            live = [nodes[i] for i in order if best[i] >= found_s[q.rows, -1].min()]
            opened = [c for n in live for c in (n.children or [n])]
            if opened:
                todo += [(c, opened) for c in q.children]
            continue
        deeper: list[Node] = []
        waiting: list[np.ndarray] = []  # leaves are scored together, the most promising first
        worst = found_s[q.rows, -1].min()
        for i in order:
            if best[i] < worst:
                break
            deeper += nodes[i].children
            if not nodes[i].children:
                waiting.append(nodes[i].rows)
                if sum(map(len, waiting)) >= BATCH:
                    score(q, np.concatenate(waiting))
                    waiting, worst = [], found_s[q.rows, -1].min()
        if waiting:
            score(q, np.concatenate(waiting))
        if deeper:
            todo.append((q, deeper))
    return found_s, found_i


def whole(vector: Column, scale: int = 64) -> Column:
    """``floor(scale * x)`` of every component, as doubles; from 2^52 on a double is whole already."""

    def floor(x: Column) -> Column:
        scaled = x.cast("double") * scale
        return F.when(F.abs(scaled) < 2.0**52, F.floor(scaled).cast("double")).otherwise(scaled)

    return F.transform(vector, floor)


#: The ends of a long; scores beyond are given, and ranked, as the nearer end.
_LONGS = (-(1 << 63), (1 << 63) - 1)


def exact_top(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, data_ids: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
    """Per query the ``(-score, id)`` of the ``k`` best data rows of another id, in whole numbers of any size.

    Products in double precision and a bound on their rounding leave out what cannot be among the best; the rest is multiplied exactly.
    """
    with np.errstate(all="ignore"):
        rough = queries @ data.T
        slack = (queries.shape[1] + 4) * 2.0**-52 * np.sqrt((queries**2).sum(1))[:, None] * np.sqrt((data**2).sum(1))
        low, high = np.nan_to_num(rough - slack, nan=-np.inf, neginf=-np.inf), np.nan_to_num(rough + slack, nan=np.inf, posinf=np.inf)
    whole_data: dict[int, list[int]] = {}
    found = []
    for i, query in enumerate(queries):
        others = np.flatnonzero(data_ids != query_ids[i])
        if len(others) > k:
            least = np.partition(low[i, others], len(others) - k)[len(others) - k]
            # Scores beyond a long tie, so all that may reach its end stay.
            least = min(least, 2.0**62) if least > -(2.0**62) else -np.inf
            others = others[high[i, others] >= least]
        own, best = [int(c) for c in query], []
        for j in others.tolist():
            row = whole_data.get(j) or whole_data.setdefault(j, [int(c) for c in data[j]])
            score = sum(a * b for a, b in zip(own, row, strict=True))
            best.append((-max(_LONGS[0], min(_LONGS[1], score)), int(data_ids[j])))
        found.append(sorted(best)[:k])
    return found


def block_top(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, data_ids: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
    """Per query the ``(-score, id)`` of its ``k`` best rows: trees where products are exact in doubles, :func:`exact_top` for rows too large for that."""
    limit = np.sqrt(2.0**53 / queries.shape[1])
    tame_q, tame_d = np.abs(queries).max(1) < limit, np.abs(data).max(1) < limit
    if np.abs(queries).max() * np.abs(data).max() * queries.shape[1] < 2.0**53:
        tame_q[:], tame_d[:] = True, True
    found: list[list[tuple[int, int]]] = [[] for _ in queries]
    if tame_q.any() and tame_d.any():
        scores, ids = dual_tree(queries[tame_q], query_ids[tame_q], data[tame_d], data_ids[tame_d], k)
        for i, s, own in zip(np.flatnonzero(tame_q), scores, ids, strict=True):
            fine = np.isfinite(s)
            found[i] += zip((-s[fine]).astype(np.int64).tolist(), own[fine].tolist(), strict=True)
    for asks, rows in ((tame_q, ~tame_d), (~tame_q, np.ones(len(data), bool))):
        if asks.any() and rows.any():
            for i, best in zip(np.flatnonzero(asks), exact_top(queries[asks], query_ids[asks], data[rows], data_ids[rows], k), strict=True):
                found[i] += best
    return [sorted(best)[:k] for best in found]


def usable(vector: Column) -> Column:
    """The vector is there and all its components are finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False))


def top_k(vectors: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: per row of ``queries`` its ``k`` best rows of another id, all if there are fewer.

    Scores are inner products of ``floor(64 x)``, whole numbers, equal scores in order of vec_id. Rows with a null id, a null
    or empty vector or a component that is null or not finite take no part; vectors of other lengths are no candidates. Rows
    that repeat a query's id count as its own; a query row that is repeated is answered once. Scores are exact for
    components of any size; those beyond a long are given, and ranked, as the nearer end of a long. Each query block meets each data block once; blocks have a fixed number of
    rows on average, so a task's memory doesn't grow with the tables.
    """
    kept = cut_lineage(
        vectors.filter(F.col(key).isNotNull() & usable(F.col(vector)))
        .select(F.col(key).cast("long").alias("id"), whole(F.col(vector)).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    )
    n, asking = kept.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    data_blocks, query_blocks = -(-n // DATA_ROWS) or 1, -(-asking // QUERY_ROWS) or 1
    side = [F.col("id"), F.col("v"), F.size("v").alias("length")]
    data = kept.select(*side, F.pmod(F.xxhash64("id", "v"), F.lit(data_blocks)).cast("int").alias("d")).withColumn(
        "q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    )
    asked = (
        kept.filter("asks").dropDuplicates(["id", "v"])
        .select(*side, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(query_blocks)).cast("int").alias("q"))
        .withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(data_blocks - 1))))
    )

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0, np.int64)})
        if not len(left) or not len(right):
            return empty
        left, right = left.sort_values("id"), right.sort_values("id")
        q, x = np.stack(left["v"].to_list()), np.stack(right["v"].to_list())
        ids = left["id"].to_numpy()
        rows = [(i, j, -s) for i, best in zip(ids.tolist(), block_top(q, ids, x, right["id"].to_numpy(), k), strict=True) for s, j in best]
        return pd.DataFrame(rows, columns=list(empty.columns)).astype("int64") if rows else empty

    cell = ["length", "q", "d"]
    best = asked.groupBy(*cell).cogroup(data.groupBy(*cell)).applyInPandas(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
