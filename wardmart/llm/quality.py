"""Quality classifier: gradient-boosted trees over statistics of a document.

Trees are grown on histograms of the binned statistics and kept as complete binary
trees in flat arrays, so that scoring is the same few array steps for all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from wardmart.llm.base import SAMPLE_ROWS, Words, held_out, labelled_sample, on_batches, text_slices, texts_of

TREES = 80
DEPTH = 4
BINS = 64
RATE = 0.15
LEAST_WEIGHT = 3.0
RIDGE = 1.0

STATISTICS = [
    "log_bytes",
    "log_words",
    "mean_word",
    "longest_word",
    "different_words",
    "different_pairs",
    "most_frequent_word",
    "upper",
    "digit",
    "stop",
    "symbol",
    "exclamation",
    "bar",
    "non_ascii",
    "line_ends",
    "repeated_lines",
    "mean_line",
    "short_words",
]


def _among(marks: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in marks]] = True
    return table


CLASSES = {
    "upper": _among("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "digit": _among("0123456789"),
    "stop": _among(".,;:?"),
    "symbol": _among("#*$%&<>"),
    "exclamation": _among("!"),
    "bar": _among("|"),
    "non_ascii": np.arange(256) > 127,
    "line_ends": _among("\n"),
}


def different(group: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Which rows are the first of their group with these keys."""
    order = np.lexsort((*keys[::-1], group))
    change = np.zeros(len(order), bool)
    if len(order):
        change[0] = True
        for key in (group, *keys):
            change[1:] |= np.diff(key[order]) != 0
    first = np.zeros(len(order), bool)
    first[order] = change
    return first


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text; shares are 0 where there is nothing to share."""
    n = len(texts)
    words = Words(texts)
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    per_byte = np.maximum(size, 1)
    count = np.maximum(words.counts, 1)
    values = np.zeros((n, len(STATISTICS)))
    put = lambda name, column: values.__setitem__((slice(None), STATISTICS.index(name)), column)
    width = pc.utf8_length(words.distinct).to_numpy(zero_copy_only=False)[words.codes]
    put("log_bytes", np.log1p(size))
    put("log_words", np.log1p(words.counts))
    put("mean_word", np.bincount(words.doc, width, n) / count)
    longest = np.zeros(n)
    np.maximum.at(longest, words.doc, width)
    put("longest_word", np.log1p(longest))
    put("short_words", np.bincount(words.doc, width <= 3, n) / count)
    order = np.lexsort((words.codes, words.doc))
    doc, code = words.doc[order], words.codes[order]
    starts = np.flatnonzero(np.append(True, (np.diff(doc) != 0) | (np.diff(code) != 0))) if len(doc) else doc
    times = np.diff(np.append(starts, len(doc)))
    put("different_words", np.bincount(doc[starts], minlength=n) / count)
    most = np.zeros(n)
    np.maximum.at(most, doc[starts], times)
    put("most_frequent_word", most / count)
    inside = np.flatnonzero(words.doc[1:] == words.doc[:-1])
    pair = words.codes[inside] * (len(words.distinct) + 1) + words.codes[inside + 1]
    first = different(words.doc[inside], pair)
    put("different_pairs", np.bincount(words.doc[inside], first, n) / np.maximum(words.counts - 1, 1))

    raw = np.frombuffer(b"".join(texts.cast(pa.binary()).to_pylist()), np.uint8)
    owner = np.repeat(np.arange(n), size)
    for name, table in CLASSES.items():
        at = table[raw]
        put(name, np.bincount(owner[at], minlength=n) / per_byte)
    lines = pc.split_pattern(texts, "\n")
    line_doc = np.repeat(np.arange(n), pc.list_value_length(lines).to_numpy(zero_copy_only=False))
    encoded = lines.flatten().dictionary_encode()
    line_code = encoded.indices.to_numpy(zero_copy_only=False)
    repeated = ~different(line_doc, line_code)
    number = np.maximum(np.bincount(line_doc, minlength=n), 1)
    put("repeated_lines", np.bincount(line_doc, repeated, n) / number)
    put("mean_line", np.log1p(size / number))
    return values


@dataclass
class Trees:
    """Complete trees of DEPTH levels; node i has the children 2i + 1 and 2i + 2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            margin += leaf[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-margin))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost TREES trees for the log-loss. ``x`` is a bounded sample, one row per text."""
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    share = (y.sum() + 1) / (len(y) + 2)
    trees = Trees(float(np.log(share / (1 - share))), *(np.zeros((TREES, k)) for k in (inner, inner, leaves)))
    trees.feature = trees.feature.astype(np.int64)
    trees.threshold[:] = np.inf
    if not len(y):
        return trees
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], 1)  # bin b: value <= edge b
    columns = np.arange(x.shape[1])
    margin = np.full(len(y), trees.base)
    for number in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        slope, weight = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for depth in range(DEPTH):
            first, width = 2**depth - 1, 2**depth
            cell = ((node - first)[:, None] * x.shape[1] + columns) * BINS + binned
            shape = (width, x.shape[1], BINS)
            g, h = (
                np.bincount(cell.ravel(), np.repeat(v, x.shape[1]), np.prod(shape)).reshape(shape) for v in (slope, weight)
            )
            left_g, left_h = g.cumsum(2), h.cumsum(2)
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE) - all_g**2 / (all_h + RIDGE)
            gain[(left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT)] = 0
            best = gain.reshape(width, -1).argmax(1)
            for k in range(width):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-9:
                    trees.feature[number, first + k], trees.threshold[number, first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), trees.feature[number, node]] > trees.threshold[number, node])
        at = node - inner
        g, h = np.bincount(at, slope, leaves), np.bincount(at, weight, leaves)
        trees.leaf[number] = RATE * g / (h + RIDGE)
        margin += trees.leaf[number][at]
    return trees


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Trees:
    """Fit on at most ``rows`` labelled rows that are not held out.

    Their statistics are worked out by Spark; the numbers alone come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            x = statistics(texts_of(batch))
            arrays = [batch.column("doc_id"), batch.column("_label"), *[pa.array(c) for c in x.T]]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "y", *STATISTICS])

    schema = "doc_id long, y double, " + ", ".join(f"{name} double" for name in STATISTICS)
    found = on_batches(labelled_sample(docs, labels, "quality", rows), run, schema).toPandas().sort_values("doc_id")
    return fit(found[STATISTICS].to_numpy(float), (found["y"].to_numpy() > 0.5).astype(float))


def quality(docs: DataFrame, trees: Trees, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text.

    Inputs are statistics of the text alone. A null or empty text has all statistics 0
    and is scored like others. Repeated rows and rows without an id (held out) give one row
    each; other columns are not read; an empty table gives no rows. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            score = shared.value.score(statistics(texts_of(batch)))
            held = [held_out(i) for i in batch.column("doc_id").to_pylist()]
            columns = [batch.column("doc_id"), pa.array(held), pa.array(score), pa.array(score >= 0.5).cast(pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return on_batches(rows, run, "doc_id long, held_out boolean, score double, predicted int")
