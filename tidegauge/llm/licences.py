"""License notices in texts by conditional compression.

A block that repeats a template's wording costs few bytes once the template is the compressor's dictionary. Candidate
blocks are compressed with zstandard alone and with each template as raw dictionary; templates are ranked by the share of
bytes they save, and the best are confirmed, or not, by the exact difference in words.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.arrays import slices

# Usual notices of public licenses, by identifier.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": ("Released under the MIT License.", "Licensed under the MIT license.", "This project is licensed under the terms of the MIT license."),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "You can redistribute it and/or modify it under the terms of the GNU General Public License version 3."),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "BSD-3-Clause": ("Released under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "CC0-1.0": ("Released under CC0 1.0.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "LicenseRef-all-rights-reserved": ("All rights reserved.",),
}
#: Least share of bytes saved, templates looked at per block, and greatest share of words that may differ.
SAVED, RANKED, DIFFERING = 0.15, 4, 0.1
_CUE = re.compile(r"licen[cs]|copyright|rights\s+reserved|redistribut|creative\s+commons|released\s+under", re.I)
_SENTENCE = re.compile(r"(?<=\w\w[.!?;])\s+(?=\S)")
_WORD = re.compile(r"[^\W_]+(?:\.\d+)*")


def blocks(text: str | None) -> list[str]:
    """The candidate blocks of a text: lines, and what sentence ends cut them into, that hold a cue."""
    if not text or not _CUE.search(text):
        return []
    return [piece for line in text.split("\n") if _CUE.search(line) for piece in _SENTENCE.split(line) if _CUE.search(piece)]


def words(text: str) -> tuple[str, ...]:
    return tuple(_WORD.findall(text.lower()))


def difference(template: Sequence[str], block: Sequence[str]) -> tuple[list[str], list[str]]:
    """Template words the block lacks, and words it has in between; what stands before and after doesn't count."""
    pairs = [m for m in difflib.SequenceMatcher(None, template, block, autojunk=False).get_matching_blocks() if m.size]
    if not pairs:
        return list(template), []
    missing = [w for i, w in enumerate(template) if not any(m.a <= i < m.a + m.size for m in pairs)]
    inside = range(pairs[0].b, pairs[-1].b + pairs[-1].size)
    return missing, [block[i] for i in inside if not any(m.b <= i < m.b + m.size for m in pairs)]


def differing(template: Sequence[str], block: Sequence[str]) -> int | None:
    """How many words differ; None where they are too many, or one holds a digit, so versions agree."""
    missing, more = difference(template, block)
    few = len(missing) + len(more) <= DIFFERING * len(template) and not any(c.isdigit() for w in (*missing, *more) for c in w)
    return len(missing) + len(more) if few else None


@dataclass(frozen=True)
class Finding:
    license: str
    saved: float


class Scanner:
    """Compressors with each template as dictionary; remembers short blocks."""

    def __init__(self, templates: Mapping[str, Sequence[str]] = TEMPLATES):
        self.entries = [(name, words(wording), self._compressor(wording.lower())) for name, several in templates.items() for wording in several]
        self.alone = zstandard.ZstdCompressor(level=3, write_content_size=False)
        self.remembered = lru_cache(50_000)(self.scan)

    @staticmethod
    def _compressor(wording: str) -> zstandard.ZstdCompressor:
        raw = zstandard.ZstdCompressionDict(wording.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(level=3, dict_data=raw, write_content_size=False, write_dict_id=False)

    def ranked(self, block: str) -> list[tuple[float, str, tuple[str, ...]]]:
        """Share of bytes saved by each template that saves enough, best first."""
        raw = block.lower().encode()
        plain = len(self.alone.compress(raw))
        saved = [(1 - len(c.compress(raw)) / plain, name, own) for name, own, c in self.entries]
        return sorted((s for s in saved if s[0] >= SAVED), key=lambda s: (-s[0], s[1]))[:RANKED]

    def scan(self, block: str) -> Finding | None:
        """Of the ranked templates the one with the fewest differing words, of those the one that saves most."""
        own = words(block)
        judged = [(differing(template, own), -saved, name) for saved, name, template in self.ranked(block)]
        best = min((j for j in judged if j[0] is not None), default=None)
        return best and Finding(best[2], -best[1])

    def licenses(self, text: str | None) -> list[str]:
        """Identifiers of all notices of a text, in order of first appearance."""
        found = [self.remembered(b) if len(b) <= 1000 else self.scan(b) for b in blocks(text)]
        return list(dict.fromkeys(f.license for f in found if f))


def scan(docs: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES, key: str = "doc_id") -> DataFrame:
    """``key, n_blocks, licenses`` per row of ``docs``, from whole texts, without a shuffle.

    ``n_blocks`` is the number of candidate blocks, ``licenses`` the identifiers of confirmed notices, each once. A null or empty
    text has none. Templates that save the same are taken by name. Repeated rows are scanned apart; other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            for part in slices(batch, 1):
                texts = part.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(blocks(t)) for t in texts], pa.int64()), pa.array([scanner.licenses(t) for t in texts], pa.list_(pa.string()))],
                    ["key", "n_blocks", "licenses"],
                )

    named = docs.select(F.col(key).alias("key"), F.col("text").alias("text"))
    return named.mapInArrow(run, f"key {kind}, n_blocks long, licenses array<string>").withColumnRenamed("key", key)
