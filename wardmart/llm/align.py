"""Alignment of two tokenizers over the bytes of a text, by pointer jumping.

Both token sequences of a text cover the same bytes. Every token points to the token
of the other sequence that overlaps it and reaches farthest to the right; where both
end at the same byte, the first sequence's token is the end of the chain. Doubling the
pointers (each takes over its target's target) finds every token's terminal in a
number of steps that grows with the logarithm of the longest chain. Tokens with the
same terminal are a group: the least pieces that both sequences agree on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmart.llm.base import on_batches, ranges, stored, text_slices, texts_of
from wardmart.llm.encode import byte_vocabulary, piece_vocabulary

c = F.col

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
SLICE_BYTES = 2_000_000
"""Text that is aligned at once: each byte of it takes some 200 in arrays."""

PAIRS_AT_ONCE = 1_000_000

DOCUMENT = (
    "slice long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs binary, weights binary, found binary, documents binary"
)
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Side:
    """The tokens of a slice by one vocabulary: ``ids`` of all texts, ``counts`` per text."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, vocabulary):
        self.ids, self.counts, self.vocabulary = ids, counts, vocabulary

    def covers(self, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which texts have tokens whose bytes together are the text's bytes in ``data``."""
        length = self.vocabulary.length[self.ids]
        row = np.repeat(np.arange(len(sizes)), self.counts)
        same = np.bincount(row, length, len(sizes)).astype(np.int64) == sizes
        kept = same[row]
        mine = self.vocabulary.bytes[ranges(self.vocabulary.start[self.ids[kept]], length[kept])]
        bounds = np.cumsum(sizes) - sizes
        other = data[ranges(bounds[same], sizes[same])]
        wrong = np.repeat(np.flatnonzero(same), sizes[same])[mine != other]
        same[wrong] = False
        return same

    def only(self, rows: np.ndarray) -> Side:
        kept = np.repeat(rows, self.counts)
        return Side(self.ids[kept], np.where(rows, self.counts, 0), self.vocabulary)

    def ends(self) -> np.ndarray:
        return np.cumsum(self.vocabulary.length[self.ids])


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every token of both sequences, the token of the first where its group ends."""
    count = len(ends_a)
    to_b = np.searchsorted(ends_b, ends_a)
    level = ends_b[to_b] == ends_a
    pointer = np.concatenate(
        [np.where(level, np.arange(count), count + to_b), np.searchsorted(ends_a, ends_b)]
    )
    while True:
        jumped = pointer[pointer]
        if np.array_equal(jumped, pointer):
            return pointer[:count], pointer[count:]
        pointer = jumped


class Groups:
    """Groups of a slice: the group of each token, and the counts of each group."""

    def __init__(self, a: Side, b: Side):
        end_a, end_b = terminals(a.ends(), b.ends())
        last = np.flatnonzero(end_a == np.arange(len(end_a)))
        number = np.zeros(len(end_a), np.int64)
        number[last] = np.arange(len(last))
        self.of_a, self.of_b = number[end_a], number[end_b]
        self.n_a = np.bincount(self.of_a, minlength=len(last))
        self.n_b = np.bincount(self.of_b, minlength=len(last))
        self.doc = np.repeat(np.arange(len(a.counts)), a.counts)[last]


def links(a: Side, b: Side, groups: Groups) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, pair, weight): how many links each id pair has in each text.

    Equal tokens of a group are counted first, so pairs are formed between the
    different ids of a group only, PAIRS_AT_ONCE at a time. A pair is a * size + b.
    """
    size_a, size_b = a.vocabulary.size, b.vocabulary.size
    left, times_a = np.unique(groups.of_a * size_a + a.ids, return_counts=True)
    right, times_b = np.unique(groups.of_b * size_b + b.ids, return_counts=True)
    group = left // size_a
    kinds = np.bincount(right // size_b, minlength=len(groups.doc))
    first = (np.cumsum(kinds) - kinds)[group]
    width = kinds[group]
    step = (np.cumsum(width) - width) // PAIRS_AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(step)) + 1), len(left)]
    found: list[tuple[np.ndarray, ...]] = []
    for start, stop in zip(cuts, cuts[1:]):
        part = slice(start, stop)
        partner = ranges(first[part], width[part])
        mine = np.repeat(np.arange(start, stop), width[part])
        pair = (left[mine] % size_a) * size_b + right[partner] % size_b
        found.append(_summed(groups.doc[group[mine]], pair, times_a[mine] * times_b[partner], size_a * size_b))
    row, pair, weight = (np.concatenate(x) for x in zip(*found, strict=True))
    return _summed(row, pair, weight, size_a * size_b) if len(found) > 1 else (row, pair, weight)


def _summed(row: np.ndarray, pair: np.ndarray, weight: np.ndarray, pairs: int) -> tuple[np.ndarray, ...]:
    key = row * pairs + pair
    order = np.argsort(key)
    key = key[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    sums = np.add.reduceat(weight[order], starts) if len(starts) else weight[:0]
    return key[starts] // pairs, key[starts] % pairs, sums


def written_groups(a: Side, b: Side, groups: Groups) -> list[bytes]:
    """`a1,a2|b1;a3|b2,b3` of every text, ids in order."""
    total = len(a.ids) + len(b.ids)
    before_a = np.cumsum(groups.n_a) - groups.n_a
    before_b = np.cumsum(groups.n_b) - groups.n_b
    at_a = np.arange(len(a.ids)) + before_b[groups.of_a]
    at_b = np.arange(len(b.ids)) + (before_a + groups.n_a)[groups.of_b]
    ids = np.zeros(total, np.int64)
    ids[at_a], ids[at_b] = a.ids, b.ids
    sign = np.full(total, ord(","), np.uint8)
    close_a = before_a + before_b + groups.n_a - 1
    close_b = close_a + groups.n_b
    sign[close_a], sign[close_b] = ord("|"), ord(";")
    digits = len(str(max(a.vocabulary.size, b.vocabulary.size) - 1))
    table = np.zeros((total, digits + 1), np.uint8)
    rest = ids.copy()
    for place in range(digits - 1, -1, -1):
        table[:, place] = rest % 10 + 48
        rest //= 10
    shown = np.ones((total, digits + 1), bool)
    for place in range(digits - 1):
        shown[:, place] = ids >= 10 ** (digits - 1 - place)
    table[:, digits] = sign
    tokens = a.counts + b.counts
    sizes = np.append(0, np.cumsum(shown.sum(1)))[np.append(0, np.cumsum(tokens))]
    data = table[shown].tobytes()
    return [data[start : max(start, end - 1)] for start, end in zip(sizes, sizes[1:])]


def aligned_slice(texts: pa.Array, model_a, model_b) -> tuple[Side, Side, Groups]:
    """The tokens of both vocabularies over space and text, and their groups."""
    spaced = pc.binary_join_element_wise(" ", texts, "")
    full = pc.not_equal(texts, "").to_numpy(zero_copy_only=False)
    a = Side(*model_a.encode(spaced, special=False), model_a)
    b = Side(*model_b.encode(texts), model_b)
    sizes = pc.binary_length(spaced).to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.frombuffer(spaced.buffers()[1], np.int32)[spaced.offset]
    data = np.frombuffer(spaced.buffers()[2], np.uint8)[first : first + sizes.sum()]
    good = full & a.covers(data, sizes) & b.covers(data, sizes)
    a, b = a.only(good), b.only(good)
    return a, b, Groups(a, b)


def _describe(path_a: str | None, path_b: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_a = byte_vocabulary(path_a or public_tokenizers.path(VOCABULARY_A))
        model_b = piece_vocabulary(path_b or public_tokenizers.path(VOCABULARY_B))
        number = TaskContext.get().partitionId() << 32
        for batch in text_slices(batches, size=SLICE_BYTES):
            texts = texts_of(batch)
            rows = len(texts)
            a, b, groups = aligned_slice(texts, model_a, model_b)
            row, pair, weight = links(a, b, groups)
            cuts = np.searchsorted(row, np.arange(rows + 1))
            linked = np.bincount(groups.doc, groups.n_a * groups.n_b, rows).astype(np.int64)
            known, documents = np.unique(pair, return_counts=True)
            pairs, weights = pair.astype("<i8"), weight.astype("<i8")
            columns = [
                pa.array(np.full(rows, number)),
                batch.column("doc_id"),
                pa.array(a.counts),
                pa.array(b.counts),
                pa.array(np.bincount(groups.doc, minlength=rows)),
                pa.array(linked),
                pa.array([hashlib.sha256(x).hexdigest() if x else "" for x in written_groups(a, b, groups)], pa.string()),
                pa.array([pairs[i:j].tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary()),
                pa.array([weights[i:j].tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary()),
                # The slice's different pairs, in its first row.
                pa.array([known.astype("<i8").tobytes()] + [None] * (rows - 1), pa.binary()),
                pa.array([documents.astype("<i8").tobytes()] + [None] * (rows - 1), pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in DOCUMENT.split(", ")])
            number += 1

    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different pairs of each slice, and the documents of the slice that have them."""
    for batch in batches:
        for number, pairs, documents in zip(*(batch.column(n) for n in ("slice", "found", "documents")), strict=True):
            pair = np.frombuffer(pairs.as_buffer(), "<i8")
            if len(pair):
                columns = [np.full(len(pair), number.as_py()), pair, np.frombuffer(documents.as_buffer(), "<i8")]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["slice", "pair", "documents"])


def _scored(texts: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of a slice with the corpus-wide counts of its pairs."""
    pair = pairs.column("pair").to_numpy()
    order = np.argsort(pair)
    pair = pair[order]
    count, best = pairs.column("count").to_numpy()[order], pairs.column("best").to_numpy()[order]
    n_best, count_sum = [], []
    for mine, weights in zip(texts.column("pairs"), texts.column("weights"), strict=True):
        at = np.searchsorted(pair, np.frombuffer(mine.as_buffer(), "<i8"))
        weight = np.frombuffer(weights.as_buffer(), "<i8")
        n_best.append(int(weight[best[at]].sum()))
        count_sum.append(int((weight * count[at]).sum()))
    more = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
    names = [part.split()[0] for part in RESULT.split(", ")]
    return pa.table({name: more[name] if name in more else texts.column(name) for name in names})


def align(
    docs: DataFrame,
    vocabulary_a: str | None = None,
    vocabulary_b: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Tokens, groups and links of every document, and how its links stand corpus-wide.

    Columns doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. A
    text that is null, empty or changed by a vocabulary has no tokens: zeros and ''.
    Rows with a null or repeated id are documents of their own, and each counts; other
    columns are not read; an empty table gives no rows.

    A slice of texts is aligned in one pass. Its links are kept as one entry per
    document and different id pair, and its different pairs are listed once for the
    whole slice. Only these lists are shuffled to be counted, and the counts come back
    to the slice that asked, so a pair that every document has is one row per slice.
    """
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    described = stored(on_batches(rows, _describe(vocabulary_a, vocabulary_b), DOCUMENT), "aligned")
    lists = described.where("found is not null").select("slice", "found", "documents")
    asked = stored(on_batches(lists, _listed, "slice long, pair long, documents long"), "pairs")

    size_b = piece_vocabulary(vocabulary_b or public_tokenizers.path(VOCABULARY_B)).size
    counts = asked.groupBy("pair").agg(F.sum("documents").alias("count"))
    counts = stored(counts.withColumn("a", F.expr(f"pair div {size_b}")), "pair_counts")
    highest = stored(counts.groupBy("a").agg(F.max("count").alias("highest")), "highest")
    known = stored(
        counts.join(highest, "a").select("pair", "count", (c("count") == c("highest")).alias("best")), "known_pairs"
    )
    answers = asked.join(known, "pair").select("slice", "pair", "count", "best")
    texts = described.drop("found", "documents")
    return texts.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(_scored, RESULT)
