"""Packing documents into sequences, shortest pack first, over the histogram of lengths.

Documents become token ids and are cut into pieces of at most one sequence. How many
pieces there are of each length is all that the packing needs: lengths are placed
longest first, each into the packs that are shortest so far, as counts of identical
packs. The patterns that come out are joined back to the pieces by their rank within
their length.
"""

from __future__ import annotations

import heapq
import os
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardmart.llm.base import on_batches, ranges, stored, text_slices, texts_of, Words
from wardmart.llm.tokens import easy_words, merge_table, stems_and_tails

VOCABULARY = "word_bpe_49k.json"
SEQUENCE = 4096
END = 2
ENCODE_AT_ONCE = 4_000

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task int, nth long"


@lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


def library_ids(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after the other, and how many each has."""
    ids: list[np.ndarray] = []
    for at in range(0, len(words), ENCODE_AT_ONCE):
        some = words[at : at + ENCODE_AT_ONCE]
        ids += [np.array(e.ids, "<u4") for e in tokenizer(path).encode_batch_fast(some, add_special_tokens=False)]
    return np.concatenate(ids or [np.zeros(0, "<u4")]), np.fromiter(map(len, ids), np.int64, len(ids))


class Ragged:
    """Ids of many words: ``store[start[i] : start[i] + size[i]]``."""

    def __init__(self, words: int):
        self.parts, self.used = [], 0
        self.start, self.size = np.zeros(words, np.int64), np.zeros(words, np.int64)

    def put(self, which: np.ndarray, ids: np.ndarray, sizes: np.ndarray, index: np.ndarray | None = None) -> None:
        """Words ``which`` get entry ``index`` (their own by default) of these ids."""
        starts = np.cumsum(sizes) - sizes + self.used
        index = np.arange(len(sizes)) if index is None else index
        self.start[which], self.size[which] = starts[index], sizes[index]
        self.parts.append(ids.astype("<u4"))
        self.used += len(ids)

    def take(self, codes: np.ndarray) -> np.ndarray:
        """Ids of these words, one after the other."""
        store = np.concatenate(self.parts or [np.zeros(0, "<u4")])
        return store[ranges(self.start[codes], self.size[codes])]


def document_ids(texts: pa.Array, path: str) -> Iterator[np.ndarray]:
    """Ids of each text of a slice.

    The vocabulary drops white space and never joins across it, so the ids of a text
    are those of its words one after the other, and each distinct word is encoded
    once: Latin words by array merging with the vocabulary's own merges, all others
    by the library. Marks after a word are ids of their own.
    """
    words, model = Words(texts), merge_table(path)
    easy = easy_words(words.distinct)
    stem, tail = Ragged(len(easy)), Ragged(len(easy))
    rest = np.flatnonzero(~easy)
    stem.put(rest, *library_ids(words.distinct.take(pa.array(rest)).to_pylist(), path))
    easy = np.flatnonzero(easy)
    stems, tails = stems_and_tails(words.distinct.take(pa.array(easy)))
    symbols, lengths = model.bytes_of(pc.utf8_lower(stems.dictionary), word_end=True)
    stem.put(easy, *model.encode(symbols, lengths), stems.indices.to_numpy())
    tail.put(easy, *library_ids(tails.dictionary.to_pylist(), path), tails.indices.to_numpy())

    both = Ragged(0)
    both.parts = [*stem.parts, *tail.parts]
    both.start = np.stack([stem.start, tail.start + stem.used], 1)[words.codes].ravel()
    both.size = np.stack([stem.size, tail.size], 1)[words.codes].ravel()
    ends = np.append(0, np.cumsum(both.size))[2 * words.offsets]
    ids = both.take(np.arange(len(both.size)))
    for row in range(len(texts)):
        yield ids[ends[row] : ends[row + 1]]


def pieces(docs: DataFrame, vocabulary: str, sequence: int, doc_id: str, text: str) -> DataFrame:
    """The pieces of every document, numbered by length within each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), Counter()
        for batch in text_slices(batches):
            rows: list[tuple] = []
            ids_of = document_ids(texts_of(batch), vocabulary)
            for number, ids in zip(batch.column("doc_id").to_pylist(), ids_of, strict=True):
                data = ids.tobytes() + END.to_bytes(4, "little")
                total = len(data) // 4
                for start in range(0, total, sequence):
                    length = min(sequence, total - start)
                    crc = zlib.crc32(data[4 * start : 4 * (start + length)])
                    rows.append((number, start, length, crc, total, task, seen[length]))
                    seen[length] += 1
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            names = [part.split()[0] for part in PIECE.split(", ")]
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return on_batches(rows, run, PIECE)


def shortest_pack_first(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, tuple[int, ...]]]:
    """(number of packs, lengths in each) that hold all pieces of the histogram.

    Longest length first. A piece goes to a pack that is shortest so far, if it fits
    there, else to a new one. Packs of equal content are one entry with a count, so
    the work depends on the number of lengths, not on the number of pieces.
    """
    heap: list[tuple[int, int, tuple[int, ...]]] = []  # (used, number, lengths), shortest first
    full: list[tuple[int, tuple[int, ...]]] = []
    smallest = min(histogram, default=0)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if heap and heap[0][0] + length <= sequence:
                used, number, lengths = heapq.heappop(heap)
                taken = min(left, number)
                if number > taken:
                    heapq.heappush(heap, (used, number - taken, lengths))
            else:
                # As many new packs as the pieces of this length fill one after the other.
                used, lengths, taken = 0, (), -(-left // (sequence // length))
            left -= taken
            used, lengths = used + length, (*lengths, length)
            if used + smallest > sequence:
                full.append((taken, lengths))
            else:
                heapq.heappush(heap, (used, taken, lengths))
    return full + [(number, lengths) for _, number, lengths in heap]


def slots(patterns: list[tuple[int, tuple[int, ...]]]) -> np.ndarray:
    """One row (length, first rank, first sequence, offset) for each slot of a pattern.

    A slot takes as many pieces of its length, by rank, as its pattern has packs.
    """
    rank: Counter[int] = Counter()
    rows, sequence = [], 0
    for number, lengths in patterns:
        offset = 0
        for length in lengths:
            rows.append((length, rank[length], sequence, offset))
            rank[length] += number
            offset += length
        sequence += number
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    sequence: int = SEQUENCE,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every document cut into pieces, and each piece's place in a sequence.

    Columns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null
    or empty text is one piece with the end id alone. Rows with a null or repeated id
    are packed each on its own; other columns are not read; an empty table gives no
    rows. The pieces, some 50 bytes each, are written once, so ranks stay what they
    were if a task runs again. To the driver come the counts by length, at most
    ``sequence`` rows; the slots made of them go out by broadcast and depend on the
    lengths alone. A frequent length is counted per task, never gathered.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    cut = stored(pieces(docs, path, sequence, doc_id, text), "pieces")
    per_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    counts = {row.length: row.n for row in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    placed = docs.sparkSession.sparkContext.broadcast(slots(shortest_pack_first(counts, sequence)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = placed.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            # Last slot of this length that starts at or before the rank.
            key = table[:, 0] * (1 << 48) + table[:, 1]
            at = np.searchsorted(key, length * (1 << 48) + rank, "right") - 1
            columns = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            columns += [pa.array(table[at, 2] + rank - table[at, 1]), pa.array(table[at, 3])]
            yield pa.RecordBatch.from_arrays(columns, PACKED)

    ranked = cut.join(base, ["length", "task"]).withColumn("rank", F.col("base") + F.col("nth")).drop("base", "nth", "task")
    return on_batches(ranked, place, ", ".join(f"{name} long" for name in PACKED))


PACKED = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
