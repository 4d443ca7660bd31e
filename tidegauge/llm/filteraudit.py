"""How filters of a corpus overlap: what each removes at each place of every order they could be applied in.

A document is reduced to the set of filters it fails, one bit each, so a table of any size becomes at most ``2 ** filters`` cells
per part. A walk over all subsets of filters in Gray-code order then toggles one filter at a time: every cell keeps the
number of active filters that it fails, and the running survivors change only by cells whose number leaves or reaches zero.
The states the walk leaves, one per subset, answer every order: a step is the difference of two of them.
"""

from __future__ import annotations

import itertools
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.session import cut_lineage, written_once

SPACES = r"[\x20\x09-\x0D]+"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def walk(cells: dict[int, tuple[int, ...]], filters: int) -> list[tuple[int, ...]]:
    """What survives each subset of ``filters`` filters, by the subset's bits.

    ``cells`` has amounts (documents, and any further counts) by the bits of the filters that they fail.
    """
    failed = dict.fromkeys(cells, 0)
    running = [sum(amounts) for amounts in zip(*cells.values(), strict=True)]
    states = [tuple(running)] * (1 << filters)
    subset = 0
    for step in range(1, 1 << filters):
        toggled = step & -step  # neighbours in Gray code differ in the lowest bit of the step
        subset ^= toggled
        change = 1 if subset & toggled else -1
        for mask, amounts in cells.items():
            if mask & toggled:
                failed[mask] += change
                if failed[mask] == max(change, 0):
                    running = [total - change * amount for total, amount in zip(running, amounts, strict=True)]
        states[subset] = tuple(running)
    return states


def steps(states: list[tuple[int, ...]], letters: str) -> list[tuple]:
    """``(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)`` of every order, from :func:`walk`'s states."""
    n, every = len(letters), len(states) - 1
    kept = [state[0] for state in states]
    alone = [kept[0] - kept[1 << f] for f in range(n)]
    unique = [kept[every ^ 1 << f] - kept[every] for f in range(n)]
    orders_with = [math.factorial(k) * math.factorial(n - 1 - k) for k in range(n)]  # k filters before one
    shapley = [
        sum(orders_with[s.bit_count()] * (kept[s] - kept[s | 1 << f]) for s in range(every) if not s & 1 << f) for f in range(n)
    ]
    found = []
    for order in itertools.permutations(range(n)):
        subset = 0
        for place, f in enumerate(order, 1):
            before, after = states[subset], states[subset | 1 << f]
            lost = [x - y for x, y in zip(before, after, strict=True)]
            found.append(("".join(letters[k] for k in order), place, after[0], lost[0], alone[f] - lost[0], unique[f], lost[1], lost[2], shapley[f]))
            subset |= 1 << f
    return found


def interactions(cells: DataFrame, letters: str) -> DataFrame:
    """``part, filter_order, step`` and :data:`COUNTS` from ``part, mask, documents, good, toxic``: one row per part, order and step.

    Bit k of ``mask`` stands for ``letters[k]``. A task holds the cells of one part, ``2 ** len(letters)`` at most.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        own = {row.mask: (row.documents, row.good, row.toxic) for row in group.itertuples()}
        rows = steps(walk(own, len(letters)), letters)
        return pd.DataFrame(rows, columns=["filter_order", "step", *COUNTS]).assign(part=group["part"].iloc[0])

    schema = "part string, filter_order string, step int, " + ", ".join(f"{name} long" for name in COUNTS)
    return cells.groupBy("part").applyInPandas(run, schema)


def text_failures(text: Column) -> dict[str, Column]:
    """Conditions on the text alone: few words, few distinct words, many capitals, signs of markup or code."""
    words = F.array_remove(F.split(text, SPACES), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals.cast("long") > 3 * F.length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The filters A to D of :func:`text_failures` and E (a copy of a text with a smaller doc_id), in all 120 orders.

    One row per part, order and step, see :func:`interactions`; a part is a value of ``lang``, null being the empty string.
    Null texts are empty texts. E fails where the table has the same text (compared by SHA-256) with a smaller
    ``doc_id``; a null doc_id is neither smaller nor larger, and rows that repeat text and doc_id don't fail each other.
    ``good`` and ``toxic`` count documents for which any row of ``labels`` says ``quality`` or ``toxic`` 1; a null doc_id has no
    label. No documents give no rows. Other columns are not read.

    The text is read once; afterwards a document is a digest, four bits and its id. That it is the first of its text is looked
    up by digest and id together, so copies of one text spread over all tasks.
    """
    text = F.coalesce("text", F.lit(""))
    bits = sum((F.when(failed, 1 << k).otherwise(0) for k, failed in enumerate(text_failures(text).values())), F.lit(0))
    short = docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"), bits.alias("bits"), F.unhex(F.sha2(text, 256)).alias("digest")
    )
    marks = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")
    )
    with written_once(short) as rows:
        firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
        copied = F.col("first").isNull() & F.col("doc_id").isNotNull()
        cells = (
            rows.join(firsts, ["digest", "doc_id"], "left")
            .withColumn("mask", F.col("bits") + F.when(copied, 16).otherwise(0))
            .join(marks, "doc_id", "left")
            .groupBy("part", "mask")
            .agg(
                F.count(F.lit(1)).alias("documents"),
                F.sum(F.coalesce("good", F.lit(0))).alias("good"),
                F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"),
            )
        )
        cells = cut_lineage(cells)
    return interactions(cells, "ABCDE")
