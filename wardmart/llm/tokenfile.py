"""Token ids of a corpus as grammar-compressed shards, in order of document id.

A shard is a range of documents; its rows are blocks, each one file image of its own
(`grammar`): rules, expansion lengths, where documents end, and the symbols. Lengths
and places of documents follow from the expansion lengths, so a document is decoded
without its neighbours.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardmart.llm.base import on_batches, stored, text_slices, texts_of
from wardmart.llm.encode import byte_vocabulary
from wardmart.llm.grammar import LEAST, Grammar, repair
from wardmart.session import table_root

c = F.col

VOCABULARY = "byte_bpe_50k.json"
END = 0
BLOCK_IDS = 1 << 20
"""A block is closed when it has so many ids; a longer document is a block of its own."""

BLOCK = (
    "shard int, block int, first long, n_ids long, low_id long, high_id long, base int, doc_ids array<bigint>, data binary"
)
DOCUMENT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def encoded(docs: DataFrame, vocabulary: str | None, end: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, ids): the ids of each text and the end id, two bytes each where the vocabulary allows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_vocabulary(vocabulary or public_tokenizers.path(VOCABULARY))
        kind = _kind(model.size)
        for batch in text_slices(batches):
            ids, counts = model.encode(texts_of(batch), special=True)
            ends = np.cumsum(counts)
            ids = np.insert(ids.astype(kind), ends, end)
            offsets = np.append(0, ends + np.arange(1, len(ends) + 1)) * kind.itemsize
            data = pa.Array.from_buffers(
                pa.large_binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids)]
            )
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), data.cast(pa.binary())], ["doc_id", "ids"])

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return on_batches(rows, run, "doc_id long, ids binary")


def _kind(size: int) -> np.dtype:
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


def _blocks(vocabulary: str | None, block_ids: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = byte_vocabulary(vocabulary or public_tokenizers.path(VOCABULARY)).size
        kind = _kind(base)
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        numbers: list[int | None] = []
        parts: list[np.ndarray] = []
        waiting = 0

        def closed() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            ends = np.cumsum([len(part) for part in parts])
            data = repair(ids, ends, base, least).pack()
            known = [n for n in numbers if n is not None]
            low, high = (known[0], known[-1]) if known else (None, None)
            row = (shard, block, first, len(ids), low, high, base, numbers, data)
            kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.int32(), pa.list_(pa.int64()), pa.binary()]
            names = [part.split()[0] for part in BLOCK.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        for batch in batches:
            for number, data in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                ids = np.frombuffer(data.as_buffer(), kind)
                if parts and waiting + len(ids) > block_ids:
                    yield closed()
                    block, first, numbers, parts, waiting = block + 1, first + waiting, [], [], 0
                numbers.append(number)
                parts.append(ids)
                waiting += len(ids)
        if parts:
            yield closed()

    return run


def write(
    docs: DataFrame,
    path: str,
    vocabulary: str | None = None,
    end: int = END,
    block_ids: int = BLOCK_IDS,
    least: int = LEAST,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Write the ids of all documents, in ascending order of id (null first), as shards below ``path``.

    A null text is empty: the end id alone. Rows of the same id are documents of their
    own, in the order of their ids and then of the rows. Other columns are not read.
    An empty table gives a file without blocks. Texts are not moved: each is encoded
    where it is read, and the ids, some two bytes each, are ordered by range. The
    row number as last sort column lets even a mass of equal rows spread over shards.
    A task holds one block at a time.
    """
    rows = stored(encoded(docs, vocabulary, end, doc_id, text), "token_ids").withColumn(
        "_row", F.monotonically_increasing_id()
    )
    order = [c("doc_id").asc_nulls_first(), F.xxhash64("ids"), c("_row")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    on_batches(ordered, _blocks(vocabulary, block_ids, least), BLOCK).write.parquet(path)


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``start``, the ids of the whole corpus before each."""
    files = spark.read.schema(BLOCK).parquet(path)
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = files.groupBy("shard").agg(F.sum("n_ids").alias("_n"))
    # One row per shard, and the shuffle's settings decide how many shards there are.
    base = sizes.select("shard", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return files.join(F.broadcast(base), "shard").withColumn("start", c("_before") + c("first")).drop("_before")


def read(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files.

    With ``low`` and ``high`` only the documents with ids in between: blocks beyond
    are not read, and of the others only these documents are expanded.
    """
    found = blocks(spark, path)
    if low is not None:
        found = found.where(c("high_id") >= low)
    if high is not None:
        found = found.where(c("low_id") <= high)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for numbers, data, start in zip(*(batch.column(n) for n in ("doc_ids", "data", "start")), strict=True):
                grammar = Grammar.unpack(data.as_buffer())
                numbers = numbers.values
                known = numbers.fill_null(-(1 << 63)).to_numpy()
                first = int(numbers.null_count) if low is not None or high is not None else 0
                first = max(first, int(np.searchsorted(known, low)) if low is not None else 0)
                stop = int(np.searchsorted(known, high, "right")) if high is not None else len(known)
                if first >= stop:
                    continue
                lengths = grammar.document_lengths()
                starts = np.cumsum(lengths) - lengths
                ids = grammar.decode(first, stop)
                at = starts - starts[first]
                crcs = [zlib.crc32(ids[at[k] : at[k] + lengths[k]]) for k in range(first, stop)]
                columns = [
                    numbers.slice(first, stop - first),
                    pa.array(start.as_py() + starts[first:stop]),
                    pa.array(lengths[first:stop]),
                    pa.array(crcs, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in DOCUMENT.split(", ")])

    return on_batches(found.select("doc_ids", "data", "start"), run, DOCUMENT)


def written_and_read(docs: DataFrame) -> DataFrame:
    """The documents of a corpus as its files have them."""
    spark = docs.sparkSession
    path = f"{table_root(spark)}/token_files"
    write(docs, path)
    return read(spark, path)
