from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows, clashing extra columns."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    long_text = " ".join(rng.choice(words) for _ in range(30_000))
    texts = [
        None, "", " \n\t ", "one", "Two words", "A line.\nA line.\n\nA line.", long_text, long_text + " end",
        "mail bob@example.com or +1 (743) 555-3824, 10.0.0.1, 4111 1111 1111 1111", "<|endoftext|> é 日本語  x",
        "###$$$ %%% |||", "you idiot clown", "a b c d e f g h a b c d e f g h",
    ]
    rows = [(i, t, None if i % 3 else "en", f"src{i % 2}", None) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, "no id", None, None, None), (None, None, None, None, None), (3, "other text", "en", "s", 1)]
    extra = {c: F.lit(1) for c in ("score", "fp", "_key", "gram", "kind", "rank", "key", "size", "bucket")}
    return spark.createDataFrame(rows, DOCS).withColumns(extra)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
