"""Tokenizer alignment against both libraries and a plain search for common token ends."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wardmart.llm import align as L
from wardmart.llm.base import text_slices
from wardmart.llm.encode import byte_vocabulary, piece_vocabulary

A, B = (public_tokenizers.path(name) for name in (L.VOCABULARY_A, L.VOCABULARY_B))
ODD = [
    "", " ", "  x", " a", "a ", "a\n b", "x<|endoftext|>y", "<|endoftext|>", "é 日本語  x", "a▁b", "<s> </s> <0x41>",
    "don't we'll 'tis it's", "a\tb\r\n\r\nc", "\x00 \x1c", "a b　c", "😀😀 x", "_a__b ", "ﬁ ①", "x" * 3000, " " * 500,
    "1234 a1b2", "<|endoftext|><|endoftext|> <|endoftext|>", "a_b-c.d@e.f 12ab34", "a\nb c\td 1\n", "Ã×÷ é×a naïve café-x",
]


@lru_cache
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def token_bytes(a, b):
    byte, piece = byte_vocabulary(A), libraries()[1]
    of_a = [byte.bytes[byte.start[i] : byte.start[i] + byte.length[i]].tobytes() for i in a]
    names = [(i, piece.id_to_piece(i)) for i in b]
    of_b = [bytes([int(p[3:5], 16)]) if piece.is_byte(i) else p.replace("▁", " ").encode() for i, p in names]
    return of_a, of_b


def brute(rows):
    docs = []
    for number, text in rows:
        groups, a, b = [], [], []
        if text:
            byte, piece = libraries()
            a, b = byte.encode(" " + text, add_special_tokens=False).ids, piece.encode(text)
            of_a, of_b = token_bytes(a, b)
            if b"".join(of_a) != f" {text}".encode() or b"".join(of_b) != f" {text}".encode():
                a, b = [], []
            else:
                ends_a, ends_b = np.cumsum([len(x) for x in of_a]), np.cumsum([len(x) for x in of_b])
                cuts = np.intersect1d(ends_a, ends_b)
                groups = [([], []) for _ in cuts]
                for side, (ids, ends) in enumerate(((a, ends_a), (b, ends_b))):
                    for i, at in zip(ids, np.searchsorted(cuts, ends)):
                        groups[at][side].append(i)
        docs.append((number, a, b, groups))
    count = Counter()
    for *_, groups in docs:
        count.update({(x, y) for p, q in groups for x in p for y in q})
    highest = defaultdict(int)
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    result = []
    for number, a, b, groups in docs:
        links = [(x, y) for p, q in groups for x in p for y in q]
        best = sum(count[x] == highest[x[0]] for x in links)
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        result.append((number, len(a), len(b), len(groups), len(links), best, sum(count[x] for x in links), digest))
    return sorted(result, key=str)


def test_odd_texts(spark, odd_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()] + list(enumerate(ODD, 100))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, L.align(docs).collect()), key=str) == brute(rows)


def test_other_columns_are_left_alone(odd_docs, spark):
    clash = {c: odd_docs["doc_id"] for c in ("slice", "pair", "pairs", "n_a", "count", "best", "a")}
    rows = L.align(odd_docs.withColumns(clash))
    assert sorted(map(tuple, rows.collect()), key=str) == brute([tuple(r) for r in odd_docs.select("doc_id", "text").collect()])


def test_empty_table(no_docs):
    assert L.align(no_docs).collect() == []


def test_a_text_above_a_slice(monkeypatch):
    """Small slices, so that a text is one of its own and pairs are counted across slices."""
    monkeypatch.setattr(L, "SLICE_BYTES", 40)
    texts = pa.array([x for x in ODD if x])
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    parts = list(text_slices([batch], size=L.SLICE_BYTES))
    assert sum(s.num_rows for s in parts) == len(texts)
    assert len(parts) > 5


def test_pairs_in_small_blocks(monkeypatch):
    texts = pa.array(["a" + "日本" * 40 + " ".join(ODD), *ODD])
    a, b, groups = L.aligned_slice(texts, byte_vocabulary(A), piece_vocabulary(B))
    whole = L.links(a, b, groups)
    monkeypatch.setattr(L, "PAIRS_AT_ONCE", 7)
    assert all(np.array_equal(x, y) for x, y in zip(whole, L.links(a, b, groups), strict=True))
    assert whole[2].sum() == (groups.n_a * groups.n_b).sum()


@given(st.lists(st.sampled_from(ODD + ["word", "日本", "\n", "'s", "12", "é", "?!"]), max_size=12).map("".join))
@settings(deadline=None, max_examples=150)
def test_any_text_has_the_ids_of_the_libraries(text):
    byte, piece = libraries()
    ids, counts = byte_vocabulary(A).encode(pa.array([text, "x", text]), special=False)
    wanted = byte.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == wanted + byte.encode("x").ids + wanted
    assert counts.sum() == len(ids)
    plain = Tokenizer.from_file(A)
    assert byte_vocabulary(A).encode(pa.array([text]), special=True)[0].tolist() == plain.encode(text).ids
    assert piece_vocabulary(B).encode(pa.array([text, "x"]))[0].tolist() == piece.encode(text) + piece.encode("x")


@pytest.mark.parametrize("cuts", [([3, 5, 9], [3, 4, 9]), ([1, 2, 3, 8], [8]), ([2, 4, 6, 7], [1, 3, 5, 7])])
def test_chains_end_where_both_end(cuts):
    a, b = map(np.array, cuts)
    end_a, end_b = L.terminals(a, b)
    common = np.intersect1d(a, b)
    assert a[end_a].tolist() == [common[np.searchsorted(common, x)] for x in a]
    assert a[end_b].tolist() == [common[np.searchsorted(common, x)] for x in b]
