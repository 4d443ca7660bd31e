"""Conversation repair against enumerated edits, a shortest-path search and plain loops."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from tidegauge.llm import turnrepair
from tidegauge.llm.queries import QUERIES

WANTED = re.compile(r"(s?(ua)+)?")
FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def enumerated(rows: list[tuple[str, bool, bool]], inserts: int) -> tuple[int, str]:
    """The cheapest edits of ``(initial, must_go, truncated)``, by trying all with at most ``inserts`` insertions."""
    found = []
    options = [["Du"] if must_go else ["D", "K", "Ru", "Ra"] for _, must_go, _ in rows]
    for edits in itertools.product(*options):
        for count in range(inserts + 1):
            for places in itertools.combinations_with_replacement(range(len(rows) + 1), count):
                for kinds in itertools.product("ua", repeat=count):
                    out, audit, cost, left = "", "", 0, list(zip(places, kinds, strict=True))
                    for k in range(len(rows) + 1):
                        while left and left[0][0] == k:
                            out, audit, cost = out + left.pop(0)[1], audit + "I", cost + 3
                        if k < len(rows):
                            initial, _, truncated = rows[k]
                            edit = edits[k]
                            audit += edit[0]
                            if edit[0] == "D":
                                cost += 4
                            else:
                                out += initial if edit == "K" else edit[1]
                                cost += (3 if edit[0] == "R" else 0) + (3 if truncated else 0)
                    if WANTED.fullmatch(out):
                        found.append((cost, audit))
    return min(found)


def shortest(rows: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """The same by always going on from the least (cost, audit)."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, last = heapq.heappop(heap)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            return cost, audit
        for role in "ua":
            if role in follows[last]:
                heapq.heappush(heap, (cost + 3, audit + "I", at, role))
        if at < len(rows):
            initial, must_go, truncated = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, last))
            if not must_go:
                more = 3 if truncated else 0
                if initial and initial in follows[last]:
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, initial))
                for role in "ua":
                    if role in follows[last]:
                        heapq.heappush(heap, (cost + 3 + more, audit + "R", at + 1, role))
    raise AssertionError("no repair")


def random_rows(rng: random.Random, n: int) -> list[tuple[str, bool, bool]]:
    return [(rng.choice("suuuaaa t"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(n)]


def parsed(rows):
    return turnrepair.best(turnrepair.parse([turnrepair.row_cell(*row) for row in rows]))


@pytest.mark.parametrize("n", range(5))
def test_parse_equals_all_edits_tried(n):
    rng = random.Random(n)
    for _ in range(40 if n < 4 else 6):
        rows = random_rows(rng, n)
        assert parsed(rows) == enumerated(rows, 4 if n < 4 else 3) == shortest(rows), rows


def test_parse_equals_shortest_path():
    rng = random.Random(9)
    for _ in range(300):
        rows = random_rows(rng, rng.randrange(1, 40))
        assert parsed(rows) == shortest(rows), rows


def test_one_split_gives_the_cell_of_all_splits():
    """The full chart, every interval and every split, has the same cells."""
    rng = random.Random(4)
    rows = random_rows(rng, 9)
    chart = {(i, i + 1): turnrepair.row_cell(*row) for i, row in enumerate(rows)}
    for length in range(2, len(rows) + 1):
        for i in range(len(rows) - length + 1):
            options = [turnrepair.combine(chart[i, k], chart[k, i + length]) for k in range(i + 1, i + length)]
            assert all(option == options[0] for option in options)
            chart[i, i + length] = options[0]
    assert turnrepair.parse([turnrepair.row_cell(*row) for row in rows]) == chart[0, len(rows)]


def test_deleted_rows_in_one_cell():
    cells = [turnrepair.row_cell("u", True, False)] * 5
    assert turnrepair.parse(cells) == turnrepair.deleted_cell(5)


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def plain_report(rows, every):
    """One tuple per conversation of ``every``, by loops over damaged rows."""
    found = []
    for conv in every:
        own = [r[1:] for r in rows if r[0] == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        seen, faults, cells = set(), [0, 0, 0], []
        for _, role, text in own:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            kind = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else None
            seen.add((role, text))
            if kind is not None:
                faults[kind] += 1
            cells.append((role[:1], kind in (0, 1), kind == 2))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit = shortest(cells)
        lines, last, left = [], "", list(own)
        for letter in audit:
            row = None if letter == "I" else left.pop(0)
            if letter == "D":
                continue
            role = row[1] if letter == "K" else "assistant" if last == "u" else "user"
            last = role[:1]
            lines.append(f"{role}:{row[2] if row else ''}")
        found.append((conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return found


def as_rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_query_against_loops(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = plain_report(plain_damage(rows), {r[0] for r in rows})
    assert as_rows(QUERIES["op13_conversation_repair"](spark, FOLDER)) == sorted(want, key=str)


def awkward_rows():
    rng = random.Random(8)
    texts = [None, "", " \t\n", "Yes.", "Yes.", "No", "Why? ", "end!\x0b", "漢字。", "🙂.", "x" * 200_000 + ".", "a\nb?"]
    roles = ["user", "assistant", "system", None, "", "tool", "User", "user", "assistant"]
    rows = [(conv, rng.choice([None, *range(6)]), rng.choice(roles), rng.choice(texts)) for conv in [None, *range(40)] for _ in range(rng.randrange(1, 12))]
    rows += [(50, t, "user" if t % 2 == 0 else "assistant", "Fine.") for t in range(60)] + [(51, 3, "user", "Again.")] * 30
    return rows


@pytest.mark.parametrize("segment", [1, 3, 4096])
def test_awkward_rows_against_loops(spark, segment):
    rows = awkward_rows()
    df = spark.createDataFrame([(*r, "other", 1) for r in rows], "conv_id long, turn long, role string, text string, digest string, n int")
    want = plain_report(plain_damage(rows), {r[0] for r in rows})
    assert as_rows(turnrepair.damaged_and_repaired(df, segment)) == sorted(want, key=str)


def test_undamaged_report_and_repaired_rows(spark):
    rows = [r for r in awkward_rows() if r[2] is not None and r[3] is not None]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    reports = turnrepair.report(df).cache()
    want = plain_report(rows, {r[0] for r in rows})
    assert as_rows(turnrepair.digests(df, reports)) == sorted(want, key=str)
    lines = {}
    for r in sorted(turnrepair.repaired(df, reports).collect(), key=lambda r: (str(r.conv_id), r.place)):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        assert r.place == len(lines[r.conv_id]) - 1
    for conv, *_, digest in want:
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == digest


def test_dropped_conversation_and_no_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    conv = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = as_rows(turnrepair.damaged_and_repaired(spark.createDataFrame([(conv, 0, "user", "Hi.")], schema)))
    assert got == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert turnrepair.damaged_and_repaired(spark.createDataFrame([], schema)).collect() == []
