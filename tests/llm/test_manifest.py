"""The Merkle manifest against a plain tree built in memory, and its statement in SQL."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from wardmart.llm import manifest as M
from wardmart.llm.queries import ORACLE

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, lower=False):
    text = row["text"]
    if lower and text is not None:
        text = "".join(x.lower() if "A" <= x <= "Z" else x for x in text)
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([h(*found[-1][i : i + 16]) for i in range(0, len(found[-1]), 16)])
    return found


def path(tree, i):
    for nodes in tree[:-1]:
        start = i // 16 * 16
        run = nodes[start : start + 16]
        yield run[: i - start], run[i - start + 1 :]
        i //= 16


def brute(rows):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row["source"]].append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source, some in by_source.items():
        some.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[source] = levels([leaf(r) for r in some])
    top = levels([trees[s][-1][0] for s in sources])
    result = []
    for k, source in enumerate(sources):
        for i, row in enumerate(by_source[source]):
            steps = [*path(trees[source], i), *path(top, k)]
            tampered = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0
            node = leaf(row, tampered)
            for left, right in steps:
                node = h(*left, node, *right)
            proof = h(*[x for left, right in steps for x in left + right])
            subroot, root = trees[source][-1][0], top[-1][0]
            result.append((row["doc_id"], leaf(row), subroot, root, proof, node, node == root))
    return sorted(result, key=str)


def check(docs):
    got = sorted(map(tuple, M.manifest(docs).collect()), key=str)
    assert got == brute([r.asDict() for r in docs.select(*M.FIELDS).collect()])
    return got


def test_odd_tables(odd_docs):
    rows = check(odd_docs)
    assert len(rows) == odd_docs.count()


def test_empty_table(no_docs):
    assert M.manifest(no_docs).collect() == []


def test_one_document_is_its_own_root(spark):
    ((_, node, subroot, root, proof, _, _),) = check(spark.createDataFrame([(1, "A", None, None, None)], DOCS))
    assert node == subroot == root
    assert proof == hashlib.sha256(b"").hexdigest()


def test_many_sources_scattered_ids_and_a_mass_of_copies(spark):
    """More than 256 sources, ids over the whole range of a long, one source and one id with a third of the rows."""
    rows = spark.range(1500).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.xxhash64("id")).alias("doc_id"),
        F.concat(F.lit("Text "), F.col("id") % 40).alias("text"),
        F.lit("en").alias("lang"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("é"), F.col("id") % 601)).alias("source"),
        F.lit(1).cast("long").alias("n_chars"),
    )
    check(rows)


def test_neighbouring_ids_fill_words(spark):
    ids = [-(2**63), -1, 0, 62, 63, 64, 65, 127, 128, 2**63 - 1, *range(1000, 1300)]
    check(spark.createDataFrame([(i, f"T{i}", "en", "s", 1) for i in ids], DOCS))


def test_tampering_shows(spark, odd_docs):
    for row in M.manifest(odd_docs).collect():
        tampered = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0
        assert row.verified or tampered


@pytest.mark.parametrize("rows", [17, 300])
def test_same_as_sql(spark, rows):
    docs = spark.range(rows).select(
        (F.col("id") * 3).alias("doc_id"),
        F.when(F.col("id") % 9 != 0, F.concat(F.lit("Ab é "), "id")).alias("text"),
        F.lit(None).cast("string").alias("lang"),
        F.when(F.col("id") % 4 != 0, F.concat(F.lit("s"), F.col("id") % 20)).alias("source"),
        F.col("id").alias("n_chars"),
    )
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    assert sorted(map(tuple, M.manifest(docs).collect())) == sorted(con.execute(ORACLE["op12_manifest"]).fetchall())
