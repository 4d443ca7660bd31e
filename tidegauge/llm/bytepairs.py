"""Byte-level BPE as a finite-state transducer, and streaming decoding with a UTF-8 state machine.

A token sequence is the one that merging gives exactly when every two neighbours are what merging makes of their own
bytes. So the merges compile into a machine that reads bytes along a trie of tokens and, where a token ends, may start
the next one if the pair agrees. It is nondeterministic, but for every prefix of the input at most one complete
sequence agrees. Determinised, a state is the set of sequences that still can win, without the tokens all of them
begin with: those are emitted at once, after a lookahead no longer than the open tokens. States and moves are made when
input first needs them. When the table of states is full, a piece that leaves it is read by the machine as it is,
nondeterministic: per byte it holds the one token with which a sequence that agrees ends there.
"""

from __future__ import annotations

import base64
import bisect
import gc
import hashlib
import itertools
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.arrays import slices
from tidegauge.llm.workers import release

STATES, PAIRS = 30_000, 400_000
MEMO = 300_000
MEMO_LENGTH = 32
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from lines of base64 text and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merged(text: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Plain merging: join the neighbours with the lowest rank, leftmost first, until none is left."""
    if len(text) == 1:
        return (ranks[text],)
    none, cuts = sys.maxsize, list(range(len(text) + 1))
    costs = [ranks.get(text[i : i + 2], none) for i in range(len(text) - 1)]
    while costs and (least := min(costs)) != none:
        at = costs.index(least)
        del cuts[at + 1], costs[at]
        if at < len(costs):
            costs[at] = ranks.get(text[cuts[at] : cuts[at + 2]], none)
        if at:
            costs[at - 1] = ranks.get(text[cuts[at - 1] : cuts[at + 1]], none)
    return tuple(ranks[text[i:j]] for i, j in zip(cuts, cuts[1:], strict=False))


class Transducer:
    """Encodes the bytes of one piece of text; ``ranks`` holds every single byte and each token's parts."""

    def __init__(self, ranks: dict[bytes, int], states: int = STATES):
        self.ranks, self.limit = ranks, states
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.next: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                if byte not in self.next[node]:
                    self.next[node][byte] = len(self.next)
                    self.next.append({})
                    self.ends.append(-1)
                node = self.next[node][byte]
            self.ends[node] = rank
        self._profile()
        self.agreed: dict[int, bool] = {}
        start = (-1, (((), 0),))
        self.numbers = {start: 0}
        self.states = [start]
        self.moves: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]
        self.flush: list[tuple[int, ...]] = [()]

    def _spine(self, token: bytes, right: bool) -> list[tuple[bytes, int]]:
        """The parts that stand at one end of a token while it is merged, each with the rank that absorbs it."""
        parts, found = [token[i : i + 1] for i in range(len(token))], []
        none = sys.maxsize
        while len(parts) > 1:
            costs = [self.ranks.get(x + y, none) for x, y in zip(parts, parts[1:], strict=False)]
            at = costs.index(min(costs))
            if at == (len(costs) - 1 if right else 0):
                found.append((parts[-1] if right else parts[0], costs[at]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [*found, (token, none)]

    def _profile(self) -> None:
        """Tokens that get on with the same followers share a kind: what can join the parts at their right end.

        A part keeps its place in the profile as the number of joins that come before the part is absorbed.
        """
        joins: dict[bytes, list[int]] = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                if token[:i] in self.ranks and token[i:] in self.ranks:
                    joins.setdefault(token[:i], []).append(rank)
        for ranks in joins.values():
            ranks.sort()
        kinds: dict[tuple, int] = {}
        self.kind: dict[int, int] = {}
        self.right: list[list[tuple[bytes, int]]] = []
        self.left: dict[int, list[tuple[bytes, int]]] = {}
        for token, rank in self.ranks.items():
            spine = [(part, until) for part, until in self._spine(token, True) if part in joins]
            profile = tuple((part, n) for part, until in spine if (n := bisect.bisect_left(joins[part], until)))
            if profile not in kinds:
                kinds[profile] = len(self.right)
                self.right.append(spine)
            self.kind[rank] = kinds[profile]

    def _agree(self, kind: int, token: int) -> bool:
        """Whether no merge crosses from a token of that kind into ``token``: none comes first at their border."""
        if kind < 0:  # nothing stands before
            return True
        if (known := self.agreed.get(kind << 32 | token)) is None:
            left = self.left.get(token)
            if left is None:
                left = self.left[token] = self._spine(self.tokens[token], False)
            ranks = self.ranks
            known = True
            for part, until in self.right[kind]:
                for head, absorbed in left:
                    rank = ranks.get(part + head)
                    if rank is not None and rank < until and rank <= absorbed:
                        known = False
            if len(self.agreed) >= PAIRS:
                self.agreed.clear()
            self.agreed[kind << 32 | token] = known
        return known

    def _move(self, number: int, byte: int) -> tuple[int, tuple[int, ...]]:
        before, open_ = self.states[number]
        still = []
        for pending, node in open_:
            child = self.next[node].get(byte)
            if child is None:
                continue
            kind = self.kind[pending[-1]] if pending else before
            if self.next[child]:
                still.append((pending, child))
            token = self.ends[child]
            if token >= 0 and self._agree(kind, token):
                still.append((pending + (token,), 0))
        common = 0
        shortest = min(len(p) for p, _ in still)
        while common < shortest and len({p[common] for p, _ in still}) == 1:
            common += 1
        emitted = still[0][0][:common]
        if common:
            before, still = self.kind[emitted[-1]], [(p[common:], node) for p, node in still]
        state = (before, tuple(still))
        reached = self.numbers.get(state)
        if reached is None:
            reached = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
            self.flush.append(next(p for p, node in state[1] if node == 0))
        self.moves[number][byte] = move = (reached, emitted)
        return move

    def encode(self, piece: bytes) -> tuple[int, ...]:
        state, found, moves = 0, [], self.moves
        for byte in piece:
            move = moves[state].get(byte)
            if move is None:
                if len(self.states) >= self.limit:
                    return self._run(piece)
                move = self._move(state, byte)
            state = move[0]
            if move[1]:
                found += move[1]
        return (*found, *self.flush[state])

    def _run(self, piece: bytes) -> tuple[int, ...]:
        """All branches at once: ``ends[i]`` is the last token of the one sequence over the first ``i`` bytes."""
        n = len(piece)
        ends, kinds, known = [-1] * (n + 1), [-1] * (n + 1), self.agreed
        next_, tokens, kind_of = self.next, self.ends, self.kind
        for start in range(n):
            node, kind = 0, kinds[start]
            for at in range(start, n):
                node = next_[node].get(piece[at])
                if node is None:
                    break
                token = tokens[node]
                if token >= 0 and ends[at + 1] < 0:
                    fits = kind < 0 or known.get(kind << 32 | token)
                    if fits is None:
                        fits = self._agree(kind, token)
                    if fits:
                        ends[at + 1], kinds[at + 1] = token, kind_of[token]
        found = []
        while n:
            found.append(ends[n])
            n -= len(self.tokens[ends[n]])
        return tuple(reversed(found))


def splitter(pattern: str):
    """A function from a text to its pieces by ``pattern``, a pattern of the ``regex`` library.

    Python's own engine is faster but has no letter and number classes, so they are written out as ranges. It looks up
    ranges below U+10000 in one step; texts with characters above go to ``regex``.
    """
    import regex

    def ranges(name: str) -> str:
        low = "".join(map(chr, (c for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF)))
        return "".join(rf"\u{ord(m[0][0]):04x}-\u{ord(m[0][-1]):04x}" for m in regex.finditer(rf"\p{{{name}}}+", low))

    inside = {r"\p{L}": ranges("L"), r"\p{N}": ranges("N"), r"\s": _WHITE}

    def written(m: re.Match) -> str:
        body = m[0]
        if body.startswith("["):
            for name, points in inside.items():
                body = body.replace(name, points)
            return body
        return f"[^{_WHITE}]" if body == r"\S" else f"[{inside[body]}]"

    low = re.compile(re.sub(r"\[\^?(?:\\p\{\w\}|\\s|[^\]])*\]|\\p\{[LN]\}|\\s|\\S", written, pattern))
    every, above = regex.compile(pattern), re.compile("[\U00010000-\U0010ffff]")

    def split(text: str) -> list[str]:
        return low.findall(text) if text.isascii() or not above.search(text) else every.findall(text)

    return split


class Encoder:
    """Whole texts to ids; keeps the ids of short pieces seen before, twice ``MEMO`` at most."""

    def __init__(self, path: str, split):
        self.machine, self.split = Transducer(read_ranks(path)), split
        self.known: dict[str, tuple[int, ...]] = {}
        self.before: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str) -> list[int]:
        found: list[int] = []
        known = self.known
        for piece in self.split(text):
            ids = known.get(piece)
            if ids is None:
                ids = self.before.get(piece)
                if ids is None:
                    raw = piece.encode()
                    whole = self.machine.ranks.get(raw)
                    ids = self.machine.encode(raw) if whole is None else (whole,)
                if len(piece) <= MEMO_LENGTH:
                    if len(known) >= MEMO:  # what is still in use comes over from the older half
                        self.before, known = known, {}
                        self.known = known
                    known[piece] = ids
            found += ids
        return found


def _utf8_table() -> dict[tuple[int, int, int], list[tuple[int, int, int] | None]]:
    """States (bytes still due, least and greatest next byte) and their moves over 256 bytes; None is a fault."""
    start, table = (0, 0, 0), {}
    first = {(0xE0, 2): (0xA0, 0xBF), (0xED, 2): (0x80, 0x9F), (0xF0, 3): (0x90, 0xBF), (0xF4, 3): (0x80, 0x8F)}

    def from_start(byte: int):
        if byte < 0x80:
            return start
        due = 1 if 0xC2 <= byte <= 0xDF else 2 if 0xE0 <= byte <= 0xEF else 3 if 0xF0 <= byte <= 0xF4 else 0
        return (due, *first.get((byte, due), (0x80, 0xBF))) if due else None

    todo = [start]
    while todo:
        state = todo.pop()
        if state in table:
            continue
        due, low, high = state
        follow = (due - 1, 0x80, 0xBF) if due > 1 else start
        table[state] = [
            from_start(b) if state == start else follow if low <= b <= high else None for b in range(256)
        ]
        todo += [s for s in table[state] if s is not None]
    return table


_UTF8 = _utf8_table()
_START = (0, 0, 0)


class Decoder:
    """Ids to text, as they come: a character leaves when its last byte is there, a faulty run becomes U+FFFD.

    The machine runs over bytes; its moves over whole tokens are kept, so a token seen before in the same state costs one
    lookup.
    """

    def __init__(self, tokens: dict[int, bytes], bound: int = 400_000):
        self.tokens, self.bound = tokens, bound
        self.moves: dict[bytes, dict[int, tuple[bytes, str]]] = {b"": {}}
        self.open = b""

    def _over(self, raw: bytes) -> tuple[bytes, str]:
        state, begun, text = _START, 0, []
        for i, byte in enumerate(raw):
            after = _UTF8[state][byte]
            if after is None:
                if state != _START:  # the run before is faulty; this byte may start anew
                    text.append("�")
                    begun, after = i, _UTF8[_START][byte]
                if after is None:
                    text.append("�")
                    begun, after = i + 1, _START
            state = after
            if state == _START and begun <= i:
                text.append(raw[begun : i + 1].decode())
                begun = i + 1
        return raw[begun:], "".join(text)

    def feed(self, ids) -> str:
        open_, text, moves = self.open, [], self.moves
        known = moves[open_]
        for token in ids:
            move = known.get(token)
            if move is None:
                if sum(map(len, moves.values())) > self.bound:
                    moves.clear()
                    known = moves[open_] = {}
                move = known[token] = self._over(open_ + self.tokens[token])
            text.append(move[1])
            if move[0] != open_:
                open_ = move[0]
                known = moves.setdefault(open_, {})
        self.open = open_
        return "".join(text)

    def finish(self) -> str:
        """What is left open is faulty."""
        left, self.open = self.open, b""
        self.moves.setdefault(b"", {})
        return "�" if left else ""


_held: dict[tuple, object] = {}


def _once(key: tuple, make):
    """One machine per worker process; its tables serve all batches and tasks the process gets."""
    if key not in _held:
        _held[key] = make()
    return _held[key]


def _mapped(rows: DataFrame, key: str, value: str, outputs: str, make, work) -> DataFrame:
    """``key`` and the columns that ``work(machine, values)`` gives for each slice of ``value``."""
    names = [field.split()[0] for field in outputs.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        gc.disable()  # the tables hold no cycles, and walking them again and again costs more than encoding
        try:
            machine = make()
            for batch in batches:
                for part in slices(batch, 1):
                    yield pa.RecordBatch.from_arrays([part.column(0), *work(machine, part.column(1).to_pylist())], ["key", *names])
        finally:
            gc.enable()

    kind = rows.schema[key].dataType.simpleString()
    named = rows.select(F.col(key).alias("key"), F.col(value).alias("value"))
    return named.mapInArrow(run, f"key {kind}, {outputs}").withColumnRenamed("key", key)


def _encoder(path: str, pattern: str) -> Encoder:
    return _once(("encode", path, pattern), lambda: Encoder(path, splitter(pattern)))


def _decoder(path: str) -> Decoder:
    return _once(("decode", path), lambda: Decoder({rank: token for token, rank in read_ranks(path).items()}))


def _lists(lists: list[list[int]]) -> pa.Array:
    ends = np.cumsum([0, *map(len, lists)])
    flat = np.fromiter(itertools.chain.from_iterable(lists), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids array<int>`` per row: whole texts, no special tokens. A null or empty text has no ids.

    ``path`` is a rank file every executor can open, ``pattern`` splits a text into pieces that are encoded apart. Rows
    are worked on one by one in Arrow batches, without a shuffle, so repeated keys, rows and null keys stay as they are.
    """

    def work(machine: Encoder, texts: list):
        return [_lists([machine.encode(t or "") for t in texts])]

    return _mapped(docs, key, text, "ids array<int>", lambda: _encoder(path, pattern), work)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, ids, text`` per row: the ids' text; null ids give an empty text, an unknown id fails the task."""

    def work(machine: Decoder, lists: list):
        return [_lists([x or [] for x in lists]), pa.array([machine.feed(x or ()) + machine.finish() for x in lists], pa.string())]

    return _mapped(encoded, key, ids, "ids array<int>, text string", lambda: _decoder(path), work)


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids, text``: :func:`encode` and then :func:`decode`, in one pass over the rows."""

    def work(machines: tuple[Encoder, Decoder], texts: list):
        encoder, decoder = machines
        lists = [encoder.encode(t or "") for t in texts]
        return [_lists(lists), pa.array([decoder.feed(x) + decoder.finish() for x in lists], pa.string())]

    return _mapped(docs, key, text, "ids array<int>, text string", lambda: (_encoder(path, pattern), _decoder(path)), work)


def sha256_of_ids(ids) -> str:
    """Hex digest of the decimal ids joined by commas, for tests; queries compute it in SQL."""
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def digest(decoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` of ids and the text they decode to."""
    return decoded.select(
        key,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
