from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def odd_docs(spark):
    """Nulls everywhere, empty and very long texts, repeated rows and keys, a column that clashes by case and name."""
    long = " ".join(f"word{i % 977} thing{i % 131}" for i in range(30_000))
    rows = [(1, "one two three four five six seven", "en", "a", 33), (1, "one two three four five six seven", "en", "a", 33),
            (2, None, None, None, None), (None, "une deux trois quatre cinq six", "fr", "b", 3), (3, "", "en", "a", 0),
            (4, long, "en", "a", len(long)), (5, "  \n\t ", "fr", None, 5), (6, "x" * 50_000, None, "a", 50_000),
            (7, "été ñandú 数据 \U0001f600 o'clock... 12,5 ▁a  b", "es", "b", 9), (3, "other text of key three", "en", "a", 1),
            (8, "<s></s><|endoftext|> [INST] \\</s>", "en", "a", 1)]
    return spark.createDataFrame([(*r, "extra", 1.5) for r in rows], DOCS + ", `_key` string, `Score` double")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
