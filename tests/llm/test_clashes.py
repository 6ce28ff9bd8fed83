"""Columns of the caller that are named like inner ones, and white space beyond ASCII's."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wardmart.llm import decontam, pii, simhash

NAMES = ("_key", "_spans", "_more", "_fp", "_nth", "key", "more", "spans", "row", "node", "nth", "fp", "text_", "a.b")


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [
        (1, "write to bob@example.com now please"),
        (2, "write to bob@example.com now please"),
        (3, "something that is quite another text altogether"),
        (None, "a text without any id at all"),
        (None, "a text without any id at all"),
        (4, None),
        (5, "call +1 (743) 555-3824 or mail a.b@c.org, or a.b@c.org"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    values = {n: F.concat(F.lit(f"{n} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for n in NAMES}
    return docs.withColumns(values)


def values_stay(rows):
    for row in rows:
        number = "none" if row["doc_id"] is None else row["doc_id"]
        assert [row[n] for n in NAMES] == [f"{n} of {number}" for n in NAMES]


def test_redact_leaves_other_columns(clashing):
    done = pii.redact(clashing)
    assert done.schema == clashing.schema
    rows = done.collect()
    values_stay(rows)
    texts = {(r["doc_id"], r["text"]) for r in rows}
    assert (1, "write to [EMAIL] now please") in texts
    assert (5, "call [PHONE] or mail [EMAIL], or [EMAIL]") in texts
    assert (4, None) in texts
    assert len(rows) == 7


def test_near_duplicates_leave_other_columns(clashing):
    done = simhash.without_near_duplicates(clashing)
    assert done.columns == clashing.columns
    rows = done.collect()
    values_stay(rows)
    assert sorted((r["doc_id"] or 0) for r in rows) == [0, 1, 3, 4, 5]


ITEM = "Which river runs through the old town of Varna and ends there? The answer is the quiet Provadiya."
SPACES = ["\u00a0", "\u3000", "\x85", "\x1c", "\u2009"]


@pytest.mark.parametrize("space", SPACES)
@pytest.mark.parametrize("where", ["both", "item", "document"])
def test_any_white_space_parts_words(spark, space, where):
    odd = ITEM.replace(" town ", f"{space}town{space}").replace(" answer ", f" answer{space}")
    item, said = (odd, odd) if where == "both" else (odd, ITEM) if where == "item" else (ITEM, odd)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"Before it. {said} After it."), (2, "A clean text about rivers and towns.")], "doc_id long, text string")
    assert [r["doc_id"] for r in decontam.hits(docs, items).collect()] == [1]
