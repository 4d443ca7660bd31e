"""Near-duplicates by SimHash: fingerprints that differ in few bits, found in BK-trees.

Fingerprints are dealt into shards. If two differ in at most ``radius`` bits, then of ``radius + 1`` disjoint groups of bits they agree in
one; so a fingerprint goes to the shard of each group's value, and partners share a shard. A shard that is still large is dealt
again by groups of the bits that vary most in it, until every shard is small; distinct fingerprints that share all but v bits
are at most 2 ** v, so that ends, whatever the table holds.

Each shard has a BK-tree: a node's children hang on edges named by their Hamming distance to it, and as that distance is a
metric, a search follows only edges within the radius of the query's own distance. Trees are a table with one bounded row per
shard. A shard's fingerprints are the nodes of its tree, so each of them looks for partners where the tree lies.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.arrays import slices
from tidegauge.llm.components import components
from tidegauge.session import cut_lineage, delete_folder, scratch_path

#: Fingerprints of a shard: as many as are aimed at, and as many as it may hold.
AIM, MOST = 128, 1024
SEED = 42
_CHUNK = 1 << 16
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz     ")
_GAPS = re.compile(b"  +")
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """The 64-bit SimHash of a text's ``width``-word shingles, repeats included; zero for a text without words.

    A-Z are lower-cased, words are runs without ASCII white space, and a shingle is its words joined by one space. A text with
    fewer words has its whole sequence as one shingle. A bit is set if more than half of the shingles' XXH64 hashes have it.
    """
    plain = _GAPS.sub(b" ", (text or b"").translate(_PLAIN)).strip(b" ")
    if not plain:
        return 0
    gaps = np.flatnonzero(np.frombuffer(plain, np.uint8) == 32)
    starts, ends = np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(plain)]))
    width = min(width, len(starts))
    starts, ends = starts[: len(starts) - width + 1], ends[width - 1 :]
    counts, hashed = np.zeros((8, 8), np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), _CHUNK):
        pairs = zip(starts[at : at + _CHUNK].tolist(), ends[at : at + _CHUNK].tolist(), strict=True)
        octets = np.array([hashed(plain[s:e], SEED) for s, e in pairs], "<u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):
            counts[k] += np.bincount(octets[:, k], minlength=256) @ _BITS
    return int(np.packbits(2 * counts.ravel() > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id, print`` of every row of ``docs`` (``doc_id, text``): :func:`fingerprint` as a signed long. Null texts are empty."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                texts = part.column(1).cast(pa.large_binary()).to_pylist()
                prints = np.array([fingerprint(text, width) for text in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints)], ["doc_id", "print"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, print long")


class Tree:
    """A BK-tree of distinct 64-bit fingerprints."""

    def __init__(self, prints: list[int] | None = None, parents: list[int] | None = None, edges: list[int] | None = None):
        self.prints, self.parents, self.edges = prints or [], parents or [], edges or []
        self.children: list[dict[int, int]] = [{} for _ in self.prints]
        for node in range(1, len(self.prints)):
            self.children[self.parents[node]][self.edges[node]] = node

    def add(self, print_: int) -> None:
        node, parent, edge = (0 if self.prints else -1), -1, 0
        while node >= 0:
            parent, edge = node, (self.prints[node] ^ print_).bit_count()
            node = self.children[parent].get(edge, -1)
        if parent >= 0:
            self.children[parent][edge] = len(self.prints)
        self.prints.append(print_)
        self.parents.append(parent)
        self.edges.append(edge)
        self.children.append({})

    def within(self, print_: int, radius: int) -> list[int]:
        """Nodes at most ``radius`` bits away from ``print_``."""
        found, open_ = [], [0] if self.prints else []
        while open_:
            node = open_.pop()
            distance = (self.prints[node] ^ print_).bit_count()
            if distance <= radius:
                found.append(node)
            children = self.children[node]
            for edge in range(distance - radius, distance + radius + 1):
                if edge in children:
                    open_.append(children[edge])
        return found


def _unsigned(prints: list[int]) -> list[int]:
    return [p & 0xFFFFFFFFFFFFFFFF for p in prints]


def _masks(mask: int, n: int, ones: list[int], radius: int, aim: int) -> list[int]:
    """The masks a large shard of ``n`` fingerprints is dealt by, from how many of them have each bit."""
    varying = sorted((abs(2 * int(count) - n), bit) for bit, count in enumerate(ones) if 0 < count < n)
    size = min(math.ceil(math.log2(n / aim)), len(varying) // (radius + 1))
    masks = []
    for group in range(radius + 1):
        own = mask & 0xFFFFFFFFFFFFFFFF
        for _, bit in varying[group : size * (radius + 1) : radius + 1]:
            own |= 1 << bit
        masks.append(own - (own >> 63 << 64))
    return masks


def _groups(radius: int, aim: int):
    """``mask, value, masks`` of large shards (``mask, value, n, ones``)."""

    def run(frames):
        for frame in frames:
            shards_ = zip(frame["mask"], frame["value"], frame["n"], frame["ones"], strict=True)
            found = [(mask, value, _masks(mask, n, ones, radius, aim)) for mask, value, n, ones in shards_]
            yield pd.DataFrame(found, columns=["mask", "value", "masks"])

    return run


def shards(prints: DataFrame, radius: int, aim: int = AIM, most: int = MOST) -> DataFrame:
    """``mask, value, prints``, written: for every two of the distinct fingerprints ``print`` within ``radius`` a shard that has both.

    A shard holds the fingerprints that equal ``value`` in the bits of ``mask``, ``most`` or fewer. Shards of one are left out.
    ``most`` must be at least ``2 ** (radius + 1)``, so that a larger shard has a varying bit for each group.

    The first shard is the whole table: it is dealt by two sums without a shuffle, those below it by joins. ``prints`` is read several times.
    """
    spark, shard, done, path = prints.sparkSession, ["mask", "value"], [], None
    counted = F.count(F.lit(1)).alias("n")
    ones = F.array(*[F.sum(F.shiftrightunsigned("print", bit).bitwiseAND(F.lit(1))) for bit in range(64)]).alias("ones")

    def dealt_by(rows: DataFrame) -> DataFrame:
        return rows.select("mask", F.col("print").bitwiseAND(F.col("mask")).alias("value"), "print")

    whole = prints.agg(counted, ones).first()
    masks = _masks(0, whole["n"], whole["ones"], radius, aim) if whole["n"] > most else [0]
    rows = dealt_by(prints.select(F.explode(F.array(*[F.lit(mask).cast("long") for mask in masks])).alias("mask"), "print"))
    while True:
        sizes, small, deeper = rows.groupBy(*shard).agg(counted), rows, None
        if split := (sizes.agg(F.max("n")).first()[0] or 0) > most:
            large = cut_lineage(sizes.filter(F.col("n") > most).select(*shard))
            small = rows.join(large, shard, "left_anti")
        collected = small.groupBy(*shard).agg(F.collect_list("print").alias("prints"))
        done.append(cut_lineage(collected.filter(F.size("prints") > 1)))
        if split:
            known = rows.join(large, shard).groupBy(*shard).agg(counted, ones)
            dealt = cut_lineage(known.mapInPandas(_groups(radius, aim), "mask long, value long, masks array<long>"))
            deeper = scratch_path(spark, "level")
            dealt_by(rows.join(dealt, shard).select(F.explode("masks").alias("mask"), "print")).distinct().write.parquet(deeper)
        if path:
            delete_folder(spark, path)
        if not deeper:
            break
        path, rows = deeper, spark.read.schema("mask long, value long, print long").parquet(deeper)
    found = done[0]
    for level in done[1:]:
        found = found.unionByName(level)
    return found


def trees(shards_: DataFrame) -> DataFrame:
    """``mask, value, nodes, parents, edges``: the BK-tree of each shard, nodes in the order they were added."""

    def run(batches):
        for batch in batches:
            built = []
            for prints in batch.column(2).to_pylist():
                tree = Tree()
                for print_ in sorted(_unsigned(prints)):
                    tree.add(print_)
                built.append(tree)
            nodes = [np.array(tree.prints, np.uint64).view(np.int64) for tree in built]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(nodes, pa.list_(pa.int64())),
                    pa.array([tree.parents for tree in built], pa.list_(pa.int32())),
                    pa.array([tree.edges for tree in built], pa.list_(pa.int32())),
                ],
                ["mask", "value", "nodes", "parents", "edges"],
            )

    return shards_.select("mask", "value", "prints").mapInArrow(
        run, "mask long, value long, nodes array<long>, parents array<int>, edges array<int>"
    )


def links(trees_: DataFrame, radius: int) -> DataFrame:
    """``a, b``: each fingerprint with the smallest that steps within ``radius`` connect it with inside a shard, so fewer than a shard has rows."""

    def run(batches):
        for batch in batches:
            a, b = [], []
            for nodes, parents, edges in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                tree = Tree(_unsigned(nodes), parents, edges)
                leader = list(range(len(tree.prints)))

                def first(node: int, leader: list[int] = leader) -> int:
                    while leader[node] != node:
                        leader[node] = node = leader[leader[node]]
                    return node

                for own, print_ in enumerate(tree.prints):
                    for node in tree.within(print_, radius):
                        x, y = first(own), first(node)
                        if x != y:
                            leader[x] = y
                least: dict[int, int] = {}
                for node, print_ in enumerate(nodes):
                    root = first(node)
                    least[root] = min(print_, least.get(root, print_))
                for node, print_ in enumerate(nodes):
                    if print_ != (smallest := least[first(node)]):
                        a.append(print_)
                        b.append(smallest)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b)], ["a", "b"])

    return trees_.select("nodes", "parents", "edges").mapInArrow(run, "a long, b long")


def near_copies(docs: DataFrame, radius: int = 2, width: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``docs`` (``doc_id, text``): what fingerprints within ``radius`` bits connect.

    ``fingerprint`` is :func:`fingerprint` as 16 hexadecimal digits, ``component_id`` the smallest doc_id of the component. Texts
    without words (null, empty) have the fingerprint zero and link like any other. Rows with a null doc_id take part; a
    component has a null id only if all its rows do. Repeated rows share a component and all come back. No rows give no rows.
    Other columns are not read.

    After one pass over the texts only fingerprints travel: distinct ones to the trees, a row per document at the end.
    """
    own = cut_lineage(fingerprints(docs, width))
    distinct = cut_lineage(own.select("print").distinct())
    found = cut_lineage(trees(shards(distinct, radius)))
    linked = components(links(found, radius)).withColumnRenamed("node", "print")
    named = own.join(linked, "print", "left").select("doc_id", "print", F.coalesce("component", "print").alias("group"))
    least = named.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    digits = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return named.join(least, "group").select("doc_id", digits, "component_id")
