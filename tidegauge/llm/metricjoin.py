"""Similarity join of texts by the Jaccard metric of their shingle sets, exact.

d(A, B) = 1 - |A & B| / |A | B| is a metric, and two texts link when it is at most ``radius``. The join narrows regions in
three steps, each with a window that is wide enough for every partner of a text:

1. The empty set is the first pivot. Under the symmetric difference its distance to A is |A|, and partners differ by at
   most a fixed part of their sizes, so sizes fall into rings, and a text whose partners may lie in the ring below is
   replicated there.
2. In a ring two partners differ in at most t shingles. The universe of shingles is dealt into t + 1 layers by hash. In a
   layer every possible set of shingles is a pivot, and a text lies in the Voronoi cell of the pivot nearest to it, its own
   shingles of that layer. t differences cannot move a text out of its cell in all t + 1 layers, so partners share a cell.
   Where layers would be too thin, single shingles are the pivots, and a text lies with the first of its own in one order,
   rare ones first, so that what many texts share (a passage, a phrase) draws strangers together only where a text has little else.
   How often a shingle is met is counted over the whole table, so a shingle that is met once makes no cell however many there are.
   Texts that share cells, directly or through others, form one region.
3. Regions are joined with texts as pivots. Each text goes to its nearest pivot and, by the triangle inequality, to
   every other pivot that is at most twice the radius further away. Texts within the radius of a pivot are linked through
   it, pairs that both are need no look. Small regions end in one task, where pivots again rule out pairs; large ones are
   split further, and if a region doesn't get smaller it is cut into tiles, each pair of parts being one task.

Equal sets are one node from the start.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.arrays import mix, shingle_sets, slices
from tidegauge.llm.components import components
from tidegauge.llm.names import free_name, quoted
from tidegauge.llm.workers import release
from tidegauge.session import cut_lineage, delete_folder, scratch_path

#: Rows that one task joins; pivots a large region is split by; width of the size rings.
REGION_ROWS, PIVOTS, RING = 1024, 6, 0.25
#: Least shingles per layer; places at which :func:`met_shingles` counts, two bits each, which bounds what it collects, and the least ranges of places.
LAYER, PLACES, RANGES = 5, 1 << 27, 256
#: Hashes below this come first in the order of single shingles; only they are counted in every text.
COUNTED = np.uint64(1 << 63)
#: Shingles that are sent together; those that a range of places has about, if there are more than ``RANGES`` times as many.
SENT, RANGE_ROWS = 1 << 20, 1 << 20
#: Marks by which texts that lie alone are passed over before texts are shuffled; bounds a broadcast.
MARKS = 1 << 20


def rings(size: int, percent: int) -> list[tuple[int, int]]:
    """``(ring, t)`` of the rings a text of this size goes to: its own, and those below that may hold smaller partners.

    Ring r holds the sizes from ceil((1 + RING)^r); wide rings make few copies, narrow ones few layers. ``t`` is the most that a pair of which the smaller text is in the ring can
    differ by, so it depends on the ring alone.
    """
    own = _ring(size)
    least = -(-percent * size // 100)
    found = []
    for ring in range(_ring(least), own + 1):
        top = math.ceil((1 + RING) ** (ring + 1)) - 1  # the largest size in the ring, and its largest partner
        partner = top * 100 // percent
        found.append((ring, (100 - percent) * (top + partner) // (100 + percent)))
    return found


def _ring(size: int) -> int:
    ring = int(math.log(max(size, 1)) / math.log(1 + RING))
    while math.ceil((1 + RING) ** (ring + 1)) <= size:
        ring += 1
    while ring and math.ceil((1 + RING) ** ring) > size:
        ring -= 1
    return ring


def layered(shingles: np.ndarray, percent: int) -> tuple[np.ndarray, bool]:
    """Hashes of a text's cells in layers, and whether it needs cells of single shingles as well.

    Layers that hold two shingles or fewer tell little and would bring strangers together. There are a few layers more
    than t + 1, so a text may leave out its smallest ones, as many as there are more: of the layers a pair agrees in, one
    is left. Both leave out by the number of shingles, so the one that is left is left in both.
    """
    found, thin = [np.zeros(0, np.uint64)], False
    for ring, most in rings(len(shingles), percent):
        spare = (most + 1) // 6
        layers = most + 1 + spare
        name = np.uint64((ring + 1) << 32)
        if math.ceil((1 + RING) ** ring) < LAYER * layers:
            thin = True
            continue
        layer = (mix(shingles + np.uint64(ring)) % np.uint64(layers)).astype(np.int64)
        sums = np.zeros(layers, np.uint64)
        counts = np.bincount(layer, minlength=layers)
        np.add.at(sums, layer, mix(shingles))
        hashes = mix(mix(sums + mix(np.arange(layers, dtype=np.uint64) + name)) + counts.astype(np.uint64))
        left_out = np.sort(counts)[spare] - 1  # with the next number there would be too many
        found.append(hashes[counts > left_out])
    return np.concatenate(found), thin


def _first(size: int, percent: int) -> int:
    """Among how many of a text's first shingles, in whatever order all texts share, one is that a partner has too.

    At least ``percent`` of a text's shingles are its partner's.
    """
    return size - -(-percent * size // 100) + 1


def cells(shingles: np.ndarray, percent: int, met: np.ndarray) -> np.ndarray:
    """Hashes of the cells of a text, with ``met`` from :func:`met_shingles`; :func:`single_cells` needs no such table.

    Where layers would hold too few shingles, the pivots are single shingles in one order for all texts: by how often
    ``met`` shows them, then by hash. Those no other text has need no cell.
    """
    found, thin = layered(shingles, percent)
    if thin:  # these cells are the same in all rings
        hashes = mix(shingles)
        place = _place(hashes, len(met) * 4)
        often = (met[place >> np.uint64(2)] >> (2 * (place & np.uint64(3))).astype(np.uint8)) & 3
        order = np.lexsort((hashes, often))[: _first(len(shingles), percent)]
        found = np.concatenate([found, mix(hashes[order][often[order] > 0])])
    return found


def _place(hashes: np.ndarray, places: int) -> np.ndarray:
    return (hashes >> np.uint64(8)) % np.uint64(places)


def met_shingles(docs: DataFrame, width: int, places: int = PLACES) -> np.ndarray:
    """Two bits by hash: whether a shingle is met once in the table (0), or how often it is met (1 to 3).

    They only choose an order, so shingles may share a place; what counts as often grows with the shingles a place has on average,
    so common shingles stand out however large the table is. Every text counts. What travels is each batch's places as
    distances between neighbours with their counts, by range of places; a task goes through its ranges with one array of one range.
    """
    span = places // RANGES

    def send(batches):
        release()
        for batch in batches:
            for part in slices(batch, 0, 6 << 20):
                found = mix(np.concatenate([*shingle_sets(part.column(0), width), np.zeros(0, np.uint64)]))
                place, count = np.unique(_place(found, places).astype(np.int64), return_counts=True)
                edges = np.searchsorted(place, np.arange(0, places + 1, span))
                rows: list[tuple[int, bytes, bytes]] = []
                for k in np.flatnonzero(np.diff(edges)):
                    inside = slice(edges[k], edges[k + 1])
                    steps = np.diff(place[inside] - k * span, prepend=0).astype(np.uint32)
                    rows.append((int(k), steps.tobytes(), count[inside].astype(np.uint32).tobytes()))
                columns = list(zip(*rows, strict=True)) if rows else [()] * 3
                types = [pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["range", "places", "counts"])

    def gather(batches):
        now, total = None, np.zeros(0, np.int64)

        def done():
            mean = total.sum() / span
            level = sum((total > limit).astype(np.uint8) for limit in (1, 3 + 2 * mean, 7 + 4 * mean)).reshape(-1, 4)
            packed = level[:, 0] | level[:, 1] << 2 | level[:, 2] << 4 | level[:, 3] << 6
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([packed.tobytes()], pa.binary())], ["range", "levels"])

        for batch in batches:
            for number, steps, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != now:
                    if now is not None:
                        yield done()
                    now, total = number, np.zeros(span, np.int64)
                total[np.cumsum(np.frombuffer(steps, np.uint32).astype(np.int64))] += np.frombuffer(counts, np.uint32)
        if now is not None:
            yield done()

    sent = docs.select("text").mapInArrow(send, "range int, places binary, counts binary")
    held = sent.repartition("range").sortWithinPartitions("range").mapInArrow(gather, "range int, levels binary")
    met = np.zeros(places // 4, np.uint8)
    for number, raw in held.collect():  # a row per range, places / 4 bytes in all
        met[number * span // 4 : (number + 1) * span // 4] = np.frombuffer(raw, np.uint8)
    return met


def _name(shingles: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 as all their lowest bytes, all their second ones and so on, which compresses well if most are small."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _runs(batches):
    """``key, columns`` of the rows of each run of equal values in the first column, as lists."""
    now, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and row[0] != now:
                yield now, list(zip(*held, strict=True))[1:]
                held = []
            now = row[0]
            held.append(row)
    if held:
        yield now, list(zip(*held, strict=True))[1:]


def single_cells(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``name, cells``: the cells of single shingles, for texts that :func:`layered` leaves to them and that share some.

    The order of shingles is that of three numbers: whether the hash is beyond ``COUNTED``, how many texts have it, the hash. A text
    sends its hashes up to ``COUNTED``, or more if it has too few, to ranges of hashes, where they are counted. What only one text has
    sent goes no further: it comes first in the text's order and makes no cell. The rest comes back with its count, and a text
    takes as many as the order still asks for. A text with enough shingles of its own has no cells, as it has no partner.

    Hashes are cut to some bits more than it takes to number all shingles. Two that become the same are one to all
    texts, which adds cells and loses none. Texts are sent some thousand at a time, named by what they hold, so a task that runs
    again sends the same; a range holds about ``RANGE_ROWS`` hashes, so memory doesn't follow the table.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    digits = (size // 12).bit_length()  # of the number of shingles, by half of words of about six bytes
    dealt = max(RANGES.bit_length() - 1, digits - RANGE_ROWS.bit_length() + 1)
    bits = max(32, digits + 7)  # at most 32 of them lie inside a range
    inner = bits - dealt

    def send(batches):
        release()
        names: list[bytes] = []
        sent: list[np.ndarray] = []
        facts: list[tuple[int, int]] = []

        def rows():
            group = hashlib.blake2b(b"".join(names), digest_size=16).digest()
            place = (np.concatenate(sent) >> np.uint64(64 - bits)).astype(np.int64)
            text = np.repeat(np.arange(len(sent)), [len(x) for x in sent])
            order = np.argsort(place, kind="stable")
            place, text = place[order], text[order]
            edges = np.searchsorted(place, np.arange((1 << dealt) + 1) << inner)
            own = -1 - int.from_bytes(group[:4], "little") % (1 << dealt)
            found = [(own, group, b"".join(names), np.array(facts, np.int64).tobytes())]
            for k in np.flatnonzero(np.diff(edges)).tolist():
                inside = slice(edges[k], edges[k + 1])
                found.append((k, group, _packed(np.diff(place[inside] - (k << inner), prepend=0)), _packed(text[inside])))
            for x in (names, sent, facts):
                x.clear()
            types = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], ["range", "group", "places", "texts"])

        held = 0
        for batch in batches:
            for part in slices(batch, 0):
                for shingles in shingle_sets(part.column(0), width):
                    if not len(shingles) or not layered(shingles, percent)[1]:
                        continue
                    hashes, first = np.sort(mix(shingles)), _first(len(shingles), percent)
                    counted = int(np.searchsorted(hashes, COUNTED))
                    names.append(_name(shingles))
                    sent.append(hashes[: max(counted, first)])
                    facts.append((counted, first))
                    held += len(sent[-1])
                    if held >= SENT:
                        yield rows()
                        held = 0
        if names:
            yield rows()

    def count(batches):
        types = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        for number, (groups, places, texts) in _runs(batches):
            found: list[tuple] = []
            if number < 0:
                found = [(number, group, *rest, None) for group, *rest in zip(groups, places, texts, strict=True)]
            else:
                each = [np.unique(np.cumsum(_unpacked(raw)), return_counts=True) for raw in places]
                met, inverse = np.unique(np.concatenate([x for x, _ in each]), return_inverse=True)
                total = np.bincount(inverse, np.concatenate([n for _, n in each])).astype(np.int64)
                del each, inverse
                met, total = met[total > 1], total[total > 1]
                for group, raw, text in zip(groups, places, texts, strict=True) if len(met) else ():
                    place = np.cumsum(_unpacked(raw))
                    at = np.minimum(np.searchsorted(met, place), len(met) - 1)
                    shared = met[at] == place
                    if shared.any():
                        steps = np.diff(place[shared], prepend=0)
                        found.append((number, group, _packed(steps), _packed(_unpacked(text)[shared]), _packed(np.minimum(total[at[shared]], (1 << 32) - 1))))
            for first in range(0, len(found), 1024):
                columns = zip(*found[first : first + 1024], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["range", "group", "places", "texts", "counts"])

    def choose(batches):
        for _, (numbers, places, texts, counts) in _runs(batches):
            own = next(i for i, k in enumerate(numbers) if k < 0)
            names = [places[own][i : i + 16] for i in range(0, len(places[own]), 16)]
            counted, first = np.frombuffer(texts[own], np.int64).reshape(-1, 2).T
            rest = [i for i, k in enumerate(numbers) if k >= 0]
            if not rest:
                continue
            text = np.concatenate([_unpacked(texts[i]) for i in rest])
            cell = np.concatenate([np.cumsum(_unpacked(places[i])) + (numbers[i] << inner) for i in rest])
            often = np.concatenate([_unpacked(counts[i]) for i in rest])
            shared = np.bincount(text, minlength=len(names))
            # With fewer counted hashes than the order asks for, no more were sent than that, and each has its place.
            wanted = np.where(counted >= first, first - (counted - shared), shared)
            order = np.lexsort((cell, often, text))
            text, cell = text[order], cell[order]
            taken = np.arange(len(text)) - (np.cumsum(shared) - shared)[text] < wanted[text]
            text, cell = text[taken], cell[taken]
            ends = np.cumsum([0, *(n := np.bincount(text, minlength=len(names)))[n > 0]])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(mix(cell.astype(np.uint64)).view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in np.flatnonzero(n)], pa.binary()), lists], ["name", "cells"])

    sent = docs.select("text").mapInArrow(send, "range int, group binary, places binary, texts binary")
    counted = sent.repartition("range").sortWithinPartitions("range").mapInArrow(count, "range int, group binary, places binary, texts binary, counts binary")
    back = counted.select("group", "range", "places", "texts", "counts").repartition("group").sortWithinPartitions("group")
    return back.mapInArrow(choose, "name binary, cells array<long>")


def described(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``doc_id, text_hash, n_shingles, name, cells`` per row, with the cells of layers; no name for the empty set."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 2):
                sets = shingle_sets(part.column(2), width)
                names = [_name(s) if len(s) else None for s in sets]
                own = [layered(s, percent)[0].view(np.int64) if len(s) else np.zeros(0, np.int64) for s in sets]
                ends = np.cumsum([0, *map(len, own)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*own, np.zeros(0, np.int64)])))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary()), lists],
                    ["doc_id", "text_hash", "n_shingles", "name", "cells"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, f"doc_id {kind}, text_hash long, n_shingles long, name binary, cells array<long>"
    )


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """``region, name, shingles`` (8 bytes each) from ``region, name, text``; texts of another name are hash twins."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 2):
                sets = shingle_sets(part.column(2), width)
                right = [i for i, (s, n) in enumerate(zip(sets, part.column(1).to_pylist(), strict=True)) if _name(s) == n]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(right, pa.int64())), part.column(1).take(pa.array(right, pa.int64())), pa.array([sets[i].tobytes() for i in right], pa.binary())],
                    ["region", "name", "shingles"],
                )

    return texts.select("region", "name", "text").mapInArrow(run, "region binary, name binary, shingles binary")


class Region:
    """The texts of one region in memory, as one flat array of shingle numbers."""

    def __init__(self, shingles: list[bytes]):
        sets = [np.frombuffer(s, np.uint64) for s in shingles]
        self.sizes = np.array([len(s) for s in sets])
        _, flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.flat, self.width = flat, int(flat.max()) + 1
        self.ends = np.concatenate(([0], np.cumsum(self.sizes)))

    def common(self, i: int, others: np.ndarray) -> np.ndarray:
        """|A & B| of text ``i`` with each of ``others``."""
        marks = np.zeros(self.width, np.int32)
        marks[self.flat[self.ends[i] : self.ends[i + 1]]] = 1
        if 2 * len(others) > len(self.sizes):
            return np.add.reduceat(marks[self.flat], self.ends[:-1])[others]
        lengths = self.sizes[others]
        heads = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        at = np.repeat(self.ends[others] - heads, lengths) + np.arange(int(lengths.sum()))
        return np.add.reduceat(marks[self.flat[at]], heads)


def link(region: Region, percent: int, balls: np.ndarray, sides: np.ndarray | None) -> list[tuple[int, int]]:
    """Pairs that connect whatever links in the region, no more than it has texts.

    Two texts with the same ball (0 or more) are connected already. With ``sides`` only pairs from different sides are looked at.
    A text is compared with all that are not yet in its component and that no earlier pivot's distance rules out:
    |d(x, p) - d(y, p)| is at most d(x, y).
    """
    n, radius = len(region.sizes), 1 - percent / 100
    leader = np.arange(n)
    for ball in np.unique(balls[balls >= 0]):
        inside = np.flatnonzero(balls == ball)
        leader[inside] = inside[0]
    found: list[tuple[int, int]] = []
    known: list[np.ndarray] = []
    everyone = np.arange(n)
    for i in range(n):
        open_ = leader != leader[i]
        if sides is None:
            open_ &= everyone > i
        else:
            open_ &= (sides != sides[i]) & (sides[i] == 0)
        open_ &= (100 * region.sizes >= percent * region.sizes[i]) & (percent * region.sizes <= 100 * region.sizes[i])
        for distances in known:
            open_ &= np.abs(distances - distances[i]) <= radius + 1e-9
        others = np.flatnonzero(open_)
        if not len(others):
            continue
        pivot = len(known) < 8 and 4 * len(others) > n
        looked = everyone if pivot else others
        common = region.common(i, looked)
        union = region.sizes[i] + region.sizes[looked] - common
        if pivot:
            known.append(1 - common / union)
            common, union = common[others], union[others]
        for j in others[100 * common >= percent * union].tolist():
            if leader[j] != leader[i]:
                leader[leader == leader[j]] = leader[i]
                found.append((i, j))
    return found


def _joined(rows: DataFrame, percent: int, tiled: bool) -> DataFrame:
    """``a, b``: connecting links of small regions (``region, name, shingles, ball``, and ``side`` for tiles)."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("name")
        names = group["name"].tolist()
        region = Region(group["shingles"].tolist())
        pairs = link(region, percent, group["ball"].to_numpy(), group["side"].to_numpy() if tiled else None)
        return pd.DataFrame({"a": [names[i] for i, _ in pairs], "b": [names[j] for _, j in pairs]})

    return rows.groupBy("region").applyInPandas(run, "a binary, b binary")


def _near_pivots(rows: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """Split regions: ``from, region, name, shingles, ball, pivot, linked`` for each region a text goes to.

    ``linked`` marks one row per text within the radius of its nearest pivot, ``pivot`` is that pivot.
    """

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for region, name, shingles, centres in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(shingles, np.uint64)
                away = []
                for centre in centres:
                    other = np.frombuffer(centre["shingles"], np.uint64)
                    common = len(np.intersect1d(own, other, assume_unique=True))
                    away.append((1 - common / (len(own) + len(other) - common), 100 * common >= percent * (len(own) + len(other) - common)))
                home = min(range(len(away)), key=lambda i: away[i][0])
                reach = away[home][0] + 2 * (1 - percent / 100) + 1e-9
                for i, (distance, linked) in enumerate(away):
                    if distance <= reach:
                        centre = centres[i]["name"]
                        inside = hashlib.blake2b(region + centre, digest_size=16).digest()
                        out.append((region, inside, name, shingles, i if linked else -1, centre, linked and name != centre))
            types = [pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.bool_()]
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["from", "region", "name", "shingles", "ball", "pivot", "linked"]
            )

    return rows.select("region", "name", "shingles").join(pivots, "region").select("region", "name", "shingles", "pivots").mapInArrow(
        run, "from binary, region binary, name binary, shingles binary, ball int, pivot binary, linked boolean"
    )


def _stored(df: DataFrame) -> tuple[DataFrame, str]:
    """The rows from a folder in the shared place, and the folder."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "region")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def region_links(rows: DataFrame, percent: int, most: int = REGION_ROWS) -> list[DataFrame]:
    """Connecting links (``a, b``) of all regions of ``region, name, shingles``.

    Shingle sets are written once per level, and a level's folders are deleted when the next one stands.
    """
    links: list[DataFrame] = []
    spark = rows.sparkSession
    rows, folder = _stored(rows.withColumn("ball", F.lit(-1)))
    while True:
        counts = cut_lineage(rows.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("first")))
        small = rows.join(counts.filter(F.col("n") <= most).select("region"), "region")
        links.append(cut_lineage(_joined(small, percent, False)))
        large = counts.filter(F.col("n") > most)
        if large.isEmpty():
            delete_folder(spark, folder)
            return links
        big = rows.join(large, "region")
        drawn = (F.col("name") == F.col("first")) | (F.pmod(F.xxhash64("name", "region"), F.col("n")) < PIVOTS)
        centres = big.filter(drawn).groupBy("region").agg(F.sort_array(F.collect_list(F.struct("name", "shingles"))).alias("pivots"))
        split, halved = _stored(_near_pivots(big, centres.withColumn("pivots", F.slice("pivots", 1, 4 * PIVOTS)), percent))
        delete_folder(spark, folder)
        links.append(cut_lineage(split.filter("linked").select(F.col("name").alias("a"), F.col("pivot").alias("b"))))
        after = split.groupBy("from", "region").agg(F.count(F.lit(1)).alias("m"), F.min("ball").alias("outside"))
        # A region whose texts all lie within the radius of its pivot is done. One that kept most of its rows goes to tiles.
        sizes = after.join(large.select(F.col("region").alias("from"), "n"), "from").filter("outside < 0")
        sizes = cut_lineage(sizes.select("region", "m", (F.col("m") > 0.7 * F.col("n")).alias("stuck")))
        tiled = F.col("stuck") & (F.col("m") > most)
        ball = F.when(F.col("ball") >= 0, 0).otherwise(-1).alias("ball")
        stuck = split.join(sizes.filter(tiled), "region").select("region", "m", "name", "shingles", ball)
        links.append(cut_lineage(_tiles(stuck, percent, most)))
        rest = split.join(sizes.filter(~tiled).select("region"), "region")
        rows, folder = _stored(rest.select("region", "name", "shingles", ball))
        delete_folder(spark, halved)


def _tiles(rows: DataFrame, percent: int, most: int) -> DataFrame:
    """Regions cut into parts of ``most // 2`` rows; each part alone and each two parts are joined in a task of their own."""
    parts = F.ceil(F.col("m") / (most // 2)).cast("int")
    dealt = rows.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("name"), F.col("parts")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    # A part alone has both sides 0; then all its pairs are looked at.
    met = met.withColumn("alone", F.col("part") == F.col("other")).withColumn("side", (F.col("part") == high).cast("int"))
    tile = F.concat("region", F.encode(F.concat_ws("-", low.cast("string"), high.cast("string")), "utf-8"))
    met = met.withColumn("region", tile)
    columns = ["region", "name", "shingles", "ball"]
    return _joined(met.filter("alone").select(*columns), percent, False).unionByName(
        _joined(met.filter("not alone").select(*columns, "side"), percent, True)
    )


def linked_components(docs: DataFrame, width: int = 3, percent: int = 90, most: int = REGION_ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, text_hash, group`` per row of ``docs`` (``doc_id, text``): texts that links connect.

    Sets are of distinct ``width``-word shingles, words being runs without ASCII white space, A-Z lower-cased; a text with fewer
    words has its whole sequence as one shingle. Texts link when 100 |A & B| >= percent |A | B|. ``component_id`` is the
    smallest doc_id of the component; a text without words (null, empty) links with nothing and has its own doc_id. Rows with
    a null doc_id take part, but name a component only if all its ids are null. Repeated rows are equal texts. Shingles are
    compared by 64-bit hashes, sets named by 128-bit ones. ``group`` tells components apart also where ids are null; it is null for
    texts without words.
    """
    own = cut_lineage(described(docs, width, percent))
    named = own.filter(F.col("name").isNotNull())
    nodes = cut_lineage(named.groupBy("name").agg(F.min("doc_id").alias("doc_id"), F.min(F.struct("text_hash", "doc_id")).alias("row")))
    # Regions only have to hold all partners, so 64 bits of a name will do for them.
    node = F.xxhash64("name").alias("node")
    single = cut_lineage(single_cells(docs, width, percent).select(node, "cells"))
    posted = named.select(node, "cells").unionByName(single).select("node", F.explode("cells").alias("cell"))
    shared = posted.groupBy("cell").agg(F.min("node").alias("a"), F.max("node").alias("last")).filter("a < last").select("cell", "a")
    edges = posted.join(shared, "cell").select("a", F.col("node").alias("b")).filter("a <> b").distinct()
    wanted = cut_lineage(nodes.withColumn("node", node).join(components(edges), "node").select(
        F.col("row.text_hash").alias("text_hash"), F.col("row.doc_id").alias("_id"), "name", F.encode(F.hex("component"), "utf-8").alias("region")
    ))
    mark = F.pmod(F.xxhash64("text"), F.lit(MARKS)).alias("_mark")
    marks = wanted.select(F.pmod("text_hash", F.lit(MARKS)).alias("_mark")).distinct()  # at most MARKS rows
    near = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"), mark).join(F.broadcast(marks), "_mark", "left_semi")
    texts = near.join(
        wanted, (F.col("_hash") == F.col("text_hash")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    )
    links = region_links(_sets(texts, width).dropDuplicates(["region", "name"]), percent, most)
    joined = components(functools.reduce(DataFrame.unionByName, links)).withColumnRenamed("node", "name")
    grouped = nodes.select("name", "doc_id").join(joined, "name", "left").select("name", "doc_id", F.coalesce("component", "name").alias("group"))
    least = grouped.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    ids = grouped.select("name", "group").join(least, "group").select("name", "group", "component_id")
    return own.select("doc_id", "n_shingles", "text_hash", "name").join(ids, "name", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "text_hash", "group",
    )


def without_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, one per component of :func:`linked_components`: the smallest doc_id's.

    A null doc_id comes after all others. Texts without words are no one's copies and all stay. Of repeated rows one stays.
    """
    joined = cut_lineage(linked_components(docs, **options)).filter(F.col("group").isNotNull())
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_hash")
    first = joined.groupBy("group").agg(F.min(order).alias("first")).select("first.*")
    text_hash, without, key = (free_name(docs.columns, n) for n in ("_hash", "_without", "_key"))
    keys = [text_hash, without, key]  # plain columns, so that what one shuffle brings together is joined and counted there
    text_key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    kept = first.select(F.col("text_hash").alias(text_hash), F.col("without").alias(without), text_key.alias(key))
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    keyed = docs.filter(~wordless).withColumns({text_hash: F.xxhash64("text"), without: F.col("doc_id").isNull(), key: text_key})
    chosen = keyed.join(kept, keys, "left_semi").dropDuplicates(keys)
    return chosen.select(*map(quoted, docs.columns)).unionByName(docs.filter(wordless))
