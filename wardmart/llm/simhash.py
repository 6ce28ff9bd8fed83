"""SimHash near-duplicates by covering locality-sensitive hashing.

A family of bit masks is covering for a radius r if any r bit positions are all left
out by some mask. Two fingerprints that differ in r bits at most are then equal under
that mask, so they meet in its table: no pair is missed. The masks come from the
vectors of a small binary space: each bit position has a nonzero vector m, each mask
a nonzero vector v of r + 1 bits, and the mask keeps the positions where v.m is odd.
Any r vectors m lie in a plane that some v is orthogonal to.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmart.llm.base import on_batches, stored, text_slices
from wardmart.llm.components import components

BITS = 64
RADIUS = 3
SHINGLE = 3
SEED = 42
AT_ONCE = 200_000
"""Shingles hashed at once."""

CROWDED = 4096
"""Fingerprints compared within one table's bucket; a larger bucket is split by more masks."""

UNNAMED = 1 << 62
"""Ids from here on stand for fingerprints that only rows without a doc_id have."""


def fingerprint(text: bytes) -> int:
    """64-bit SimHash of the lower-cased three-word shingles, repeats included; none: 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(SHINGLE, len(words))
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(first), AT_ONCE):
        spans = zip(first[at : at + AT_ONCE], last[at : at + AT_ONCE], strict=True)
        h = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    set_bits = np.packbits(2 * ones > len(first), bitorder="little")
    return int(set_bits.view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) of every whole text; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = pc.fill_null(batch.column("text").cast(pa.binary()), b"")
            found = [fingerprint(t.as_py()) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "fp"])

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return on_batches(rows, run, "doc_id long, fp long")


def covering_masks(positions: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over these bit positions, one of which leaves out any ``radius`` of them.

    A mask keeps about half of the positions. With no more than ``radius`` positions
    the empty mask alone is covering.
    """
    if len(positions) <= radius:
        return [0]
    space = range(1, 1 << (radius + 1))
    vector = {p: 1 + i % len(space) for i, p in enumerate(positions)}
    return sorted({sum(1 << p for p in positions if (v & vector[p]).bit_count() % 2) for v in space})


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def mask_levels(radius: int = RADIUS, at_most: int = 256) -> list[list[tuple[int, ...]]]:
    """For each level the masks as paths: a mask of the level before, and what it adds.

    The first level has one mask per table. Each further level splits a crowded
    bucket by the bits that its mask left out, half of them at a time, until so few
    bits are free that no bucket can hold more than ``crowded`` different fingerprints.
    """
    levels, masks = [], [0]
    while any(1 << (BITS - m.bit_count()) > at_most for m in masks):
        rows = []
        for before in masks:
            free = [p for p in range(BITS) if not before >> p & 1]
            rows += [(before, before | m) for m in covering_masks(free, radius)]
        rows = sorted(set(rows))
        levels.append(rows)
        masks = sorted({m for _, m in rows})
    return levels


def _forest(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links that connect what lies within ``radius`` in each bucket, a star per cluster."""
    for batch in batches:
        a: list[int] = []
        b: list[int] = []
        for members in batch.column("members").to_pylist():
            fp = np.array([m["fp"] for m in members], np.int64).view(np.uint64)
            ids = np.array([m["id"] for m in members], np.int64)
            open_ = np.arange(len(fp))
            while len(open_) > 1:
                cluster, frontier, open_ = [open_[:1]], open_[:1], open_[1:]
                while len(frontier) and len(open_):
                    near = np.zeros(len(open_), bool)
                    for x in fp[frontier]:
                        near |= np.bitwise_count(fp[open_] ^ x) <= radius
                    frontier, open_ = open_[near], open_[~near]
                    cluster.append(frontier)
                linked = ids[np.concatenate(cluster)]
                root = int(linked.min())
                others = linked[linked != root].tolist()
                a += others
                b += [root] * len(others)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def links(nodes: DataFrame, radius: int = RADIUS, crowded: int = CROWDED) -> DataFrame:
    """(a, b) pairs of ids that connect exactly what links of ``radius`` bits connect.

    ``nodes`` has one row (fp, id) per fingerprint. Buckets of up to ``crowded``
    fingerprints are compared in one task and give a spanning star per cluster, not
    all pairs. A larger bucket is never gathered: its members get the masks of the
    next level, which is again covering, so none of its pairs is lost either.
    """
    spark = nodes.sparkSession
    members = nodes.withColumn("mask", F.lit(0).cast("long"))
    found = spark.createDataFrame([], "a long, b long")
    levels = mask_levels(radius)
    for depth, paths in enumerate(levels):
        last = depth == len(levels) - 1
        after: dict[int, list[int]] = {}
        for before, mask in paths:
            after.setdefault(_signed(before), []).append(_signed(mask))
        choices = F.create_map(
            *[
                part
                for before, masks in after.items()
                for part in (F.lit(before).cast("long"), F.array(*[F.lit(m).cast("long") for m in masks]))
            ]
        )
        rows = members.select("fp", "id", F.explode(choices[F.col("mask")]).alias("mask"))
        rows = rows.withColumn("bucket", F.col("fp").bitwiseAND(F.col("mask")))
        if depth:
            rows = rows.distinct()
        # A stored table, so that adaptive execution may split the rows of a crowded bucket.
        sizes = stored(rows.groupBy("mask", "bucket").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
        rows = stored(rows.join(sizes, ["mask", "bucket"]), "buckets")
        small = (rows if last else rows.where(F.col("size") <= crowded)).groupBy("mask", "bucket")
        small = small.agg(F.collect_list(F.struct("fp", "id")).alias("members")).select("members")
        found = found.union(on_batches(small, lambda batches: _forest(batches, radius), "a long, b long"))
        members = rows.where(F.col("size") > crowded).select("fp", "id", "mask")
        if last or members.isEmpty():
            break
    return found


def _node_id(doc_id: Column, fp: Column) -> Column:
    return F.coalesce(doc_id, F.lit(UNNAMED) + F.shiftrightunsigned(fp, 2))


def roots(prints: DataFrame, radius: int = RADIUS, crowded: int = CROWDED) -> DataFrame:
    """(fp, root) for every fingerprint: the smallest id of its component.

    Copies meet in one row per fingerprint first. A fingerprint that only rows
    without an id have gets an id from UNNAMED on.
    """
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("id")).select("fp", _node_id(F.col("id"), F.col("fp")).alias("id"))
    nodes = stored(nodes, "nodes")
    # Rows that share an id are one document, also if their texts differ.
    twice = prints.where("doc_id is not null").join(nodes, "fp").where("doc_id <> id")
    same = twice.select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    same = same.union(nodes.where(F.col("id") < UNNAMED).select(F.col("id").alias("a"), F.col("id").alias("b")))
    shared = same.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high")).where("low <> high")
    shared = shared.join(same, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    parts = components(links(nodes, radius, crowded).union(shared))
    joined = nodes.join(parts, "id", "left")
    return joined.select("fp", F.coalesce("root", "id").alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document.

    Texts without words (null, empty) have fingerprint zero and link like any other.
    Rows without an id take part; their component_id is null if no row of the
    component has an id. Repeated rows give one row each; rows that share an id are
    one document. Other columns are not read; an empty table gives no rows. Only
    (doc_id, fingerprint) is shuffled, never a text.
    """
    prints = stored(fingerprints(docs, doc_id, text), "prints")
    joined = prints.join(roots(prints), "fp")
    return joined.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("root") < UNNAMED, F.col("root")).alias("component_id"),
    )


def without_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id.

    Of rows that share this id one stays, the first by hash of the text and then by the
    text. If no row of a component has an id, one of them stays all the same. All columns
    travel inside one struct, so no name of theirs can clash. Texts are shuffled once.
    """
    prints = stored(fingerprints(docs, doc_id, text), "prints")
    kept = roots(prints).select(F.col("root").alias("node")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), docs[doc_id].cast("long").alias("node"))
    unnamed = _with_fingerprint(rows.where("node is null").select("row", F.col("row")[text].alias("text")))
    unnamed = unnamed.select("row", _node_id(F.lit(None).cast("long"), F.col("fp")).alias("node"))
    rows = rows.where("node is not null").unionByName(unnamed)
    first = Window.partitionBy("node").orderBy(F.xxhash64(F.col("row")[text]), F.col("row")[text])
    best = rows.join(kept, "node", "left_semi").withColumn("nth", F.row_number().over(first))
    return best.where("nth = 1").select("row.*")


def _with_fingerprint(rows: DataFrame) -> DataFrame:
    """(row, text, fp)"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = pc.fill_null(batch.column("text").cast(pa.binary()), b"")
            found = pa.array([fingerprint(t.as_py()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], ["row", "text", "fp"])

    return on_batches(rows, run, rows.withColumn("fp", F.lit(0).cast("long")).schema)
