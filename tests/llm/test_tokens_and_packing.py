"""Token counts and ids against the library; packing as an exact partition."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wardmart.llm import packing, tokens
from wardmart.llm.base import table

BYTE = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
WORD = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
TEXTS = st.text(st.one_of(st.sampled_from(" \n\t\u00a0\u3000'.,!<|>aAbßÉé1"), st.characters(codec="utf-8")), max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=8))
def test_any_text_is_counted_like_the_library(texts):
    texts = [*texts, "<|endoftext|>a <|endoftext|>", "aaaaaaaaaaaaaa  a", "don't we'll"]
    model = tokens.merge_table(public_tokenizers.path(tokens.VOCABULARY))
    found = tokens.count_batch(pa.array(texts, pa.string()), model)
    assert found.tolist() == [len(e.ids) for e in BYTE.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=8))
def test_any_text_gets_the_ids_of_the_library(texts):
    texts = [*texts, "<|endoftext|>a <|ENDOFTEXT|>", "Ça va!!, don't"]
    found = packing.document_ids(pa.array(texts, pa.string()), public_tokenizers.path(packing.VOCABULARY))
    assert [f.tolist() for f in found] == [e.ids for e in WORD.encode_batch(texts, add_special_tokens=False)]


def test_counts_of_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, table(spark, SF_DIR, "documents")):
        wanted = sorted(
            (-1 if i is None else i, len((t or "").encode()), len(BYTE.encode(t or "", add_special_tokens=False).ids))
            for i, t in docs.select("doc_id", "text").collect()
        )
        rows = tokens.token_counts(docs).collect()
        assert sorted((-1 if r[0] is None else r[0], r[1], r[2]) for r in rows) == wanted
        assert all(r.over_limit == (r.n_tokens > 512) for r in rows)
    assert tokens.token_counts(no_docs).count() == 0


def test_every_id_is_packed_once(spark, odd_docs):
    for docs in (odd_docs.where("doc_id is not null and doc_id not in (3, 4)"), table(spark, SF_DIR, "documents")):
        placed = packing.pack(docs).toPandas()
        for doc_id, text in docs.select("doc_id", "text").collect():
            ids = np.array([*WORD.encode(text or "", add_special_tokens=False).ids, packing.END], "<u4")
            own = placed[placed.doc_id == doc_id].sort_values("start")
            assert own.length.sum() == len(ids) and (own.doc_tokens == len(ids)).all()
            assert own.start.tolist() == (own.length.cumsum() - own.length).tolist()
            for p in own.itertuples():
                assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
        for _, s in placed.sort_values("offset").groupby("sequence_id"):
            assert s.offset.tolist() == (s.length.cumsum() - s.length).tolist()
            assert s.length.sum() <= packing.SEQUENCE
        sequences = placed.sequence_id.nunique()
        assert placed.length.sum() >= 0.98 * packing.SEQUENCE * (sequences - 1)


def test_repeated_and_missing_rows_are_packed_each(odd_docs, no_docs):
    assert packing.pack(odd_docs).where("start = 0").count() == odd_docs.count()
    assert packing.pack(no_docs).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 10**9), max_size=20))
def test_patterns_hold_the_histogram(histogram):
    patterns = packing.shortest_pack_first(histogram, 64)
    held: dict[int, int] = {}
    for number, lengths in patterns:
        assert number > 0 and sum(lengths) <= 64
        for length in lengths:
            held[length] = held.get(length, 0) + number
    assert held == histogram
