"""Token files against the library, and the grammar as an exact round trip."""

from __future__ import annotations

import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wardmart.llm import tokenfile
from wardmart.llm.encode import merge_all
from wardmart.llm.grammar import SHORT, Grammar, _bits, _unbits, repair
from wardmart.llm.tokens import merge_table
from wardmart.session import table_root

PATH = public_tokenizers.path(tokenfile.VOCABULARY)


def brute(rows):
    """By ascending id, null first; among rows of one id any order has the same lengths summed up."""
    library, at, result = Tokenizer.from_file(PATH), 0, []
    for number, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        result.append((number, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return result


@pytest.mark.parametrize("block_ids", [1, 5000, 1 << 20])
def test_odd_tables(spark, odd_docs, block_ids):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    path = f"{table_root(spark)}/files"
    tokenfile.write(odd_docs, path, block_ids=block_ids)
    got = sorted(map(tuple, tokenfile.read(spark, path).collect()), key=lambda r: r[1])
    wanted = brute(rows)
    assert sorted((g[0] is not None, g[0], *g[2:]) for g in got if g[0] is not None) == sorted(
        (w[0] is not None, w[0], *w[2:]) for w in wanted if w[0] is not None
    )
    assert sorted(g[2:] for g in got) == sorted(w[2:] for w in wanted)
    assert [g[0] for g in got] == [w[0] for w in wanted]
    assert [g[1] for g in got] == np.cumsum([0, *[g[2] for g in got]])[:-1].tolist()


def test_unique_ids_have_exact_places(spark):
    docs = spark.range(400).select(
        ((F.col("id") * 7919) % 400 - 200).alias("doc_id"),
        F.concat_ws(" ", F.array_repeat(F.concat(F.lit("Word"), F.col("id") % 9), (F.col("id") % 50).cast("int"))).alias("text"),
    )
    path = f"{table_root(spark)}/files"
    tokenfile.write(docs, path, block_ids=3000)
    wanted = brute([tuple(r) for r in docs.collect()])
    assert sorted(map(tuple, tokenfile.read(spark, path).collect())) == wanted
    some = sorted(map(tuple, tokenfile.read(spark, path, -20, 35).collect()))
    assert some == [w for w in wanted if -20 <= w[0] <= 35]
    assert sorted(map(tuple, tokenfile.read(spark, path, low=190).collect())) == [w for w in wanted if w[0] >= 190]


def test_empty_table(no_docs):
    assert tokenfile.written_and_read(no_docs).collect() == []


def test_a_mass_of_equal_rows_spreads_over_shards(spark):
    docs = spark.range(3000).select(F.lit(1).alias("doc_id"), F.lit("same text").alias("text"))
    path = f"{table_root(spark)}/files"
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tokenfile.write(docs, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert tokenfile.blocks(spark, path).groupBy("shard").count().count() > 1
    assert tokenfile.read(spark, path).agg(F.max("start")).first()[0] == 2999 * 3


@st.composite
def corpora(draw):
    words = draw(st.lists(st.lists(st.integers(0, 6), min_size=1, max_size=5), min_size=1, max_size=4))
    return draw(st.lists(st.lists(st.sampled_from(words), max_size=30).map(lambda x: sum(x, [])), max_size=8))


@given(corpora(), st.integers(2, 6))
@settings(deadline=None, max_examples=200)
def test_grammar_is_a_round_trip(docs, least):
    ends = np.cumsum([len(d) for d in docs]).astype(np.int64)
    ids = np.array(sum(docs, []), np.int64)
    made = Grammar.unpack(repair(ids, ends, 7, least).pack())
    assert made.decode().tolist() == ids.tolist()
    assert made.document_lengths().tolist() == [len(d) for d in docs]
    for k, doc in enumerate(docs):
        assert made.decode(k, k + 1).tolist() == doc


def test_frequent_pairs_become_rules():
    ids = np.tile([3, 1, 4, 1, 5], 2000)
    made = repair(ids, np.array([len(ids)]), 9)
    assert len(made.symbols) < 100
    assert made.spans.max() > 100
    assert len(made.pack()) < 1000


def test_a_run_of_one_id_halves():
    made = repair(np.zeros(1 << 14, np.int64), np.array([1 << 14]), 1)
    assert len(made.symbols) <= 16
    assert made.decode().tolist() == [0] * (1 << 14)


def cpu_seconds(*runs) -> list[float]:
    """Of the fastest of five times, in turn."""
    spent = []
    for run in runs * 5:
        start = time.process_time()
        run()
        spent.append(time.process_time() - start)
    return [min(spent[k :: len(runs)]) for k in range(len(runs))]


def test_a_round_costs_what_may_still_be_frequent():
    """Twelve more rounds, for a run of one id, each cost less than to copy a long block of rare pairs."""
    block = np.random.default_rng(3).integers(1, 50_000, 3_000_000)
    run = np.append(block, np.zeros(1 << 15, np.int64))
    other = run > 0
    alone, both, copy = cpu_seconds(
        lambda: repair(block, np.array([len(block)]), 50_000),
        lambda: repair(run, np.array([len(run)]), 50_000),
        lambda: run[other],
    )
    assert repair(run, np.array([len(run)]), 50_000).spans.max() >= 1 << 11
    assert both - alone < 12 * copy


def test_documents_of_long_rules_are_decoded_one_by_one():
    rng = np.random.default_rng(4)
    phrase = rng.integers(0, 50, 3000)
    docs = [np.tile(phrase, k) for k in (1, 30, 0, 2)] + [np.zeros(5000, np.int64), phrase[:700]]
    ids, ends = np.concatenate(docs), np.cumsum([len(d) for d in docs])
    made = Grammar.unpack(repair(ids, ends, 50).pack())
    assert made.spans.max() > SHORT
    assert made.decode().tolist() == ids.tolist()
    for k, doc in enumerate(docs):
        assert made.decode(k, k + 1).tolist() == doc.tolist()


@pytest.mark.parametrize("width", range(1, 33))
def test_numbers_of_any_width(width):
    for count in (0, 1, 7, 8, 1000):
        numbers = np.random.default_rng(count).integers(0, 1 << width, count)
        data = b"..." + _bits(numbers, width)
        assert _unbits(data, 3, count, width).tolist() == numbers.tolist()


def test_pre_tokens_of_any_length_are_merged_alike():
    table, rng = merge_table(PATH), np.random.default_rng(5)
    for letters in (b"aeinrst", b"a", bytes(range(256))):
        lengths = rng.integers(0, 45, 500)
        ids = table.byte[rng.choice(np.frombuffer(letters, np.uint8), lengths.sum())]
        for some in (slice(0, 0), slice(0, 1), slice(None)):
            part = ids[: lengths[some].sum()]
            wanted = table.encode(part, lengths[some])
            for got, other in zip(merge_all(table, part, lengths[some]), wanted, strict=True):
                assert got.tolist() == other.tolist()
