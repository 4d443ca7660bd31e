from __future__ import annotations

import random

import pytest

#: Extra columns whose names the operators use themselves.
EXTRA = ["score", "size", "slot", "name", "node", "component", "ids", "key", "found", "position", "cut", "host", "target"]


@pytest.fixture(scope="session")
def spark(spark):
    from tidegauge.llm.shipping import ship

    return ship(spark)


def awkward_texts() -> list[str | None]:
    rng = random.Random(5)
    words = ["the", "of", "Ärger", "naïve", "漢字", "🙂", "x" * 50, "don't", "a.b", "10,000", "%%%", "stupid"]
    plain = [" ".join(rng.choice(words) for _ in range(n)) for n in (1, 2, 3, 9, 40, 200)]
    return [None, "", " \t\n\x0b\x0c\r ", *plain, plain[4], plain[4], plain[5] + " end", "\x00\x01   \xa0nbsp", " ".join(rng.choice(words) for _ in range(40_000))]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls, empty, blank, repeated and very long texts, repeated rows and clashing extra columns."""
    rows = [(i, t, None if i % 4 == 0 else "en", None if i % 5 == 0 else f"src{i % 3}", None) for i, t in enumerate(awkward_texts())]
    rows += [rows[5], rows[5], (None, "no id here at all", "en", "src1", 3), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in EXTRA:
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit("other"))
    return df.cache()


@pytest.fixture(scope="session")
def no_documents(awkward):
    return awkward.limit(0)
