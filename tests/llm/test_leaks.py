"""Leaks that are not one contiguous copy."""

from __future__ import annotations

import random
from collections import Counter

import pyarrow as pa

from wardmart.llm import decontam


def index_of(items: list[tuple[int, str]]) -> decontam.Index:
    units = [u for _, t in items for u in decontam.units_of(sum(decontam.question_and_answer(t), []))]
    return decontam.Index(items, Counter(w for u in units for w in set(u)), len(units), sum(map(len, units)) / len(units))


def brute_hits(text: str, items: list[tuple[int, str]]) -> set[int]:
    words = [w for w in map(decontam.normal, text.split()) if w]
    have, grams = set(words), decontam.shingles(words, decontam.SHINGLE)
    found = set()
    for item_id, item in items:
        question, answer = decontam.question_and_answer(item)
        own = decontam.shingles(question + answer, decontam.SHINGLE)
        parts = [len(have & set(p)) / len(set(p)) if p else 1 for p in (question, answer)]
        if len(own & grams) / len(own) >= decontam.CONTAINED and min(parts) >= decontam.PART:
            found.add(item_id)
    return found


def test_question_and_answer_far_apart(spark):
    question = " ".join(f"q{i}" for i in range(25)) + "."
    answer = " ".join(f"a{i}" for i in range(25)) + "."
    filler = " ".join(f"f{i}" for i in range(300))
    docs = [(1, f"{question} {filler} {answer}"), (2, f"{answer} {filler} {question} {filler}"), (3, f"{question} {filler}"), (4, filler)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(7, f"{question} {answer}"), (8, "f5 q3 f8 a2 z1 z2 z3.")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.hits(docs, items).collect()} == {(1, 7), (2, 7)}
    assert {r.doc_id for r in decontam.without_leaks(docs, items).collect()} == {3, 4}


def test_no_scattered_item_is_lost():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    items = [(i, ". ".join(" ".join(rng.choices(words, weights, k=rng.randint(5, 60))) for _ in range(rng.randint(1, 4)))) for i in range(60)]
    docs = []
    for _ in range(600):
        item, pieces, at = rng.choice(items)[1].split(), [], 0
        while at < len(item):
            size = rng.randint(5, 40)
            pieces.append(item[at : at + size])
            at += size - rng.choice((0, 0, 3, 4, 4, -1))
        rng.shuffle(pieces)
        docs.append(" ".join(w for p in pieces for w in [*p, *rng.choices(words, weights, k=rng.choice((1, 300)))]))
    wanted = {(d, i) for d, text in enumerate(docs) for i in brute_hits(text, items)}
    index = index_of(items)
    assert len(wanted) > 100 and {(r, item.item_id) for r, item, *_ in index.search(pa.array(docs))} == wanted


def test_short_items_need_a_whole_line():
    index = index_of([(1, "Yes."), (2, "Forty two"), (3, "no\nway")])
    docs = ["yes we can", "well\n yes!\nthat", "YES", "it is forty two now", "a\r\nforty two.\nb", "two forty", "no\nway", "no way out"]
    found = {(r, item.item_id): numbers for r, item, *numbers in index.search(pa.array(docs))}
    assert found.keys() == {(1, 1), (2, 1), (4, 2), (6, 3)} and {tuple(n[1:]) for n in found.values()} == {(1.0, 1.0, 1.0)}


def test_repeated_items_are_one(spark, monkeypatch):
    monkeypatch.setattr(decontam, "SHARD_WORDS", 100)
    texts = [" ".join(f"i{i}w{k}" for k in range(20)) for i in range(6)]
    items = spark.createDataFrame([(0, texts[0])] * 50 + list(enumerate(texts)), "item_id long, text string")
    docs = spark.createDataFrame([(5, f"before {texts[0]} after {texts[3]}")], "doc_id long, text string")
    assert sorted(tuple(r)[:2] for r in decontam.hits(docs, items).collect()) == [(5, 0), (5, 3)]
    sizes = [len(make().items) for make in decontam.indexes(items)]
    assert sum(sizes) == 6 and len(sizes) == 2
