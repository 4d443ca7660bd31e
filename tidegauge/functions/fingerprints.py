"""Hashes and canonical fingerprint texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.functions.arrays import array_to_text
from tidegauge.functions.columns import Col, as_column

STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def attribute_hash(attributes: Sequence[str], arrays: Sequence[str] = (), separator: str = "") -> Column:
    """md5 over the attributes' texts, NULL counting as empty; 'Q' without attributes.

    Without separator two neighbouring values can run together; pass one to tell them apart.
    """
    if not attributes:
        return F.lit("Q")
    texts = [array_to_text(name) if name in arrays else F.col(name).cast("string") for name in attributes]
    return F.md5(F.concat_ws(separator, *[F.coalesce(text, F.lit("")) for text in texts]))


def stamp(ts: Col) -> Column:
    """Timestamp as fixed-width text."""
    return F.date_format(as_column(ts), STAMP_FORMAT)


def fingerprint_text(keys: Col, values: Col) -> Column:
    """Aggregate to ``{"key":"value",...}`` ordered by key; a NULL value gives empty text.

    Two fingerprints are equal exactly when their texts are. The group holds one entry per
    source timestamp of one target period (at most period / source granularity) or one per
    source part, never raw records.
    """
    entry = F.struct(as_column(keys).alias("k"), F.coalesce(as_column(values), F.lit("")).alias("v"))
    ordered = F.array_sort(F.collect_list(entry))
    pairs = F.transform(ordered, lambda e: F.concat(F.lit('"'), e["k"], F.lit('":"'), e["v"], F.lit('"')))
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))
