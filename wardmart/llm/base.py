"""What the operators share: tables, stored intermediates and words of Arrow batches."""

from __future__ import annotations

import os
import tempfile
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmart.session import table_root

SLICE_BYTES = 6_000_000
"""Text that a task works on at once. A longer text is a slice of its own."""

SAMPLE_ROWS = 8_000
"""Labelled rows that a classifier is fitted on, at most."""

SAMPLE_CHARS = 20_000
"""Longer texts are left out of the sample that a classifier is fitted on (never of scoring)."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here.

    What reads it survives lost executors and does not compute it again.
    """
    spark = df.sparkSession
    path = f"{table_root(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def on_batches(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` with this package sent along, for executors that lack it."""
    _ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def _ship(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp()), "wardmart.zip")
    with zipfile.ZipFile(path, "w") as file:
        for folder, _, names in os.walk(package):
            for name in (n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                file.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)  # the driver serves it, so its own folder will do
    _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int | None = None
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` (SLICE_BYTES) bytes of text each."""
    size = size or SLICE_BYTES
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        share = (np.cumsum(sizes, dtype=np.int64) - sizes) // size
        cuts = np.flatnonzero(np.diff(share)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(start, end - start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The texts with null as empty."""
    return pc.fill_null(batch.column(column).cast(pa.string()), "")


class Words:
    """Words of a slice of texts, `[^\\x20\\x09-\\x0D]+`, each distinct word once.

    ``distinct``: the words; ``codes``: one index into it per word in text order;
    ``doc``: the row of each word; ``offsets``: where each row's words start.
    """

    def __init__(self, texts: pa.Array):
        pieces = pc.ascii_split_whitespace(texts)
        flat = pieces.flatten()
        rows = np.repeat(np.arange(len(texts)), pc.list_value_length(pieces).to_numpy(zero_copy_only=False))
        full = pc.not_equal(flat, "")
        flat, rows = flat.filter(full), rows[full.to_numpy(zero_copy_only=False)]
        encoded = flat.dictionary_encode()
        self.distinct: pa.Array = encoded.dictionary
        self.codes: np.ndarray = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.doc: np.ndarray = rows
        self.counts: np.ndarray = np.bincount(rows, minlength=len(texts))
        self.offsets: np.ndarray = np.concatenate([[0], np.cumsum(self.counts)])


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair, one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)


def held_out(doc_id: int | None) -> bool:
    """Rows whose labels are kept for evaluation; a row without an id is one."""
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 3 == 1


def held_out_column(doc_id: str = "doc_id"):
    return F.coalesce(F.expr(f"crc32(cast({doc_id} as string)) % 3 = 1"), F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled documents that are not held out.

    The choice is by a hash of the id among documents of at most SAMPLE_CHARS characters,
    so it is the same each time and long texts do not shrink it. A repeated id has the
    smallest of its texts and the largest of its labels. Ids and labels alone are
    shuffled; only the chosen ids, at most ``rows``, are broadcast to the texts.
    """
    marked = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out_column())
        .groupBy("doc_id")
        .agg(F.max(label).cast("double").alias("_label"))
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= SAMPLE_CHARS)
    usable = texts.select("doc_id").distinct()
    chosen = marked.join(usable, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return (
        texts.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "_label")
        .agg(F.min("text").alias("text"))
        .select("doc_id", "text", "_label")
    )
