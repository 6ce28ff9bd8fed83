"""Toxic spans by a linear-chain conditional random field over the words of a text.

Labels are of documents, so words are labelled first: a word, a beginning of words or a
pair of neighbours that stands far more often in toxic documents than chance allows, in
many different contexts, marks its words as toxic where such a document has it. The
field does not see this evidence. It has two states and learns these labels from the
word itself, its beginnings and its shape, the words before and after it, and the state
of the word before. So it may call the same word toxic beside one neighbour and clean
beside another. Forward-backward gives each word's marginal; their maximum and sum make
the document's score, and words of at least one half make the offending spans.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmart.llm.base import Words, held_out, labelled_sample, on_batches, text_slices, texts_of
from wardmart.llm.decontam import normal

REJECT = 0.7
SEGMENT = 128
"""Words that one vector step walks through; longer texts are several segments, joined exactly."""

CHANCE = 0.01
"""Chance that any word at all is called toxic without cause."""

PRECISION = 0.7
"""Share of toxic documents among the contexts of what marks a word as toxic, at least."""

PREFIXES = (4, 5, 6, 7)
"""Lengths of word beginnings that are looked at like words."""

SAMPLE = 2_000
"""Labelled rows that the model is fitted on, at most; their texts come to the driver."""

TRAIN_TOKENS = 200_000
"""Words of the sample that the field's weights are fitted on, at most: toxic and clean texts in turn."""

STEPS = 100
PENALTY = 0.1
WORD = re.compile(r"[^\x20\x09-\x0D]+")

WEIGHTS = 1 << 18
"""Places that features are hashed to. The first stands for no feature and has weight zero."""

CONSTANT = 1
OWN = len(PREFIXES) + 2
"""Features of a word on its own: itself, its beginnings, its shape."""


@dataclass
class Model:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(WEIGHTS))
    transition: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    score: np.ndarray = field(default_factory=lambda: np.zeros(4))


def _place(feature: str) -> int:
    return 2 + zlib.crc32(feature.encode("utf-8", "surrogatepass")) % (WEIGHTS - 2)


def _shape(word: str) -> str:
    case = "a" if word.islower() else "A" if word.isupper() else "Aa" if word.istitle() else "0" if word.isnumeric() else "?"
    return f"{case}{min(len(word), 12)}"


def places(word: str) -> list[int]:
    """Where the weights of a word's features stand: OWN of its own, as neighbour before, as neighbour after."""
    name = normal(word)
    beginnings = [_place(f"{w}:{name[:w]}") if len(name) > w else 0 for w in PREFIXES]
    own = [_place("w:" + name), *beginnings, _place("s:" + _shape(word))]
    return [*own, _place("<:" + name), _place(">:" + name)]


class Features:
    """The features of the words of a slice, by distinct word, and how they add up along the texts."""

    def __init__(self, words: Words):
        distinct = words.distinct.to_pylist()
        flat = [place for word in distinct for place in places(word)]
        self.places = np.array(flat, np.int64).reshape(len(distinct), OWN + 2)
        self.codes = words.codes
        self.follows = np.flatnonzero(words.doc[1:] == words.doc[:-1]) + 1
        """Words that have a word before them in their text."""

    def emission(self, weights: np.ndarray) -> np.ndarray:
        """Each word's score for the toxic state."""
        of = weights[self.places]
        own, before, after = of[:, :OWN].sum(1), of[:, OWN], of[:, OWN + 1]
        total = own[self.codes] + weights[CONSTANT]
        total[self.follows] += before[self.codes[self.follows - 1]]
        total[self.follows - 1] += after[self.codes[self.follows]]
        return total

    def gathered(self, values: np.ndarray) -> np.ndarray:
        """The sum of each word's value at every place that the word's features stand at."""
        n = len(self.places)
        per_word = np.empty((n, OWN + 2))
        per_word[:, :OWN] = np.bincount(self.codes, values, n)[:, None]
        per_word[:, OWN] = np.bincount(self.codes[self.follows - 1], values[self.follows], n)
        per_word[:, OWN + 1] = np.bincount(self.codes[self.follows], values[self.follows - 1], n)
        result = np.bincount(self.places.ravel(), per_word.ravel(), WEIGHTS)
        result[0], result[CONSTANT] = 0.0, values.sum()
        return result


class Chains:
    """The words of all texts of a slice, laid out in segments of equal length."""

    def __init__(self, counts: np.ndarray):
        parts = -(-counts // SEGMENT)
        self.first = np.cumsum(parts) - parts  # a text's first segment
        self.parts = parts
        self.rows = int(parts.sum())
        doc = np.repeat(np.arange(len(counts)), counts)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.place = (self.first[doc] + at // SEGMENT) * SEGMENT + at % SEGMENT

    def lay(self, values: np.ndarray, empty: float) -> np.ndarray:
        """One row per step, one column per segment."""
        flat = np.full(self.rows * SEGMENT, empty)
        flat[self.place] = values
        return np.ascontiguousarray(flat.reshape(self.rows, SEGMENT).T)

    def marginals(self, emission: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each word's probability of being toxic, and the expected number of each transition.

        A text starts as if the word before it were clean. Where a segment has no word
        its step is the identity.
        """
        if not self.rows:
            return np.zeros(0), np.zeros((2, 2))
        toxic = self.lay(np.exp(emission), 0.0)
        real = self.lay(np.ones(len(emission)), 0.0) > 0
        t = np.exp(transition)

        def step(v0, v1, k):
            n0, n1 = v0 * t[0, 0] + v1 * t[1, 0], (v0 * t[0, 1] + v1 * t[1, 1]) * toxic[k]
            n0, n1 = np.where(real[k], n0, v0), np.where(real[k], n1, v1)
            scale = n0 + n1
            return n0 / scale, n1 / scale, scale

        # What a segment does to a vector that comes in: its two rows, one scale for both.
        one, none = np.ones(self.rows), np.zeros(self.rows)
        a0, a1, b0, b1 = one, none, none, one
        for k in range(SEGMENT):
            x0, x1, xs = step(a0, a1, k)
            y0, y1, ys = step(b0, b1, k)
            both = np.maximum(xs, ys)
            a0, a1, b0, b1 = x0 * xs / both, x1 * xs / both, y0 * ys / both, y1 * ys / both
        enter0, enter1 = one.copy(), none.copy()
        leave0, leave1 = one.copy(), one.copy()
        longest = int(self.parts.max())
        for n in range(longest - 1):
            s = self.first[self.parts > n + 1] + n
            v0, v1 = enter0[s] * a0[s] + enter1[s] * b0[s], enter0[s] * a1[s] + enter1[s] * b1[s]
            enter0[s + 1], enter1[s + 1] = v0 / (v0 + v1), v1 / (v0 + v1)
        for n in range(longest - 1, 0, -1):
            s = self.first[self.parts > n] + n
            w0, w1 = a0[s] * leave0[s] + a1[s] * leave1[s], b0[s] * leave0[s] + b1[s] * leave1[s]
            leave0[s - 1], leave1[s - 1] = w0 / (w0 + w1), w1 / (w0 + w1)

        ahead = np.empty((SEGMENT, self.rows))  # probability of toxic given what came before
        came = np.empty((SEGMENT, self.rows))
        v0, v1 = enter0, enter1
        for k in range(SEGMENT):
            came[k] = v1
            v0, v1, _ = step(v0, v1, k)
            ahead[k] = v1
        result = np.empty((SEGMENT, self.rows))
        moves = np.zeros((2, 2))
        w0, w1 = leave0, leave1
        for k in range(SEGMENT - 1, -1, -1):
            p = ahead[k] * w1
            result[k] = p / (p + (1 - ahead[k]) * w0)
            x0, x1 = w0, toxic[k] * w1
            joint = [(1 - came[k]) * t[0, 0] * x0, (1 - came[k]) * t[0, 1] * x1, came[k] * t[1, 0] * x0, came[k] * t[1, 1] * x1]
            total = np.where(real[k], sum(joint), 1.0)
            moves += np.array([np.sum(j / total * real[k]) for j in joint]).reshape(2, 2)
            n0, n1 = t[0, 0] * x0 + t[0, 1] * x1, t[1, 0] * x0 + t[1, 1] * x1
            scale = n0 + n1
            w0, w1 = np.where(real[k], n0 / scale, w0), np.where(real[k], n1 / scale, w1)
        return result.T.ravel()[self.place], moves


def _marked(key: np.ndarray, context: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each occurrence whether its key (-1: none) is proven toxic, and the key's share of toxic contexts.

    A key counts once for each context that it has, so copies of a text do not add up.
    The bound on chance is Chernoff's, corrected for the number of keys.
    """
    real = key >= 0
    kinds = key.max(initial=-1) + 1
    width = context.max(initial=0) + 1
    seen = np.unique((key[real] * width + context[real]) * 2 + label[real])
    of, toxic = seen // 2 // width, seen % 2
    t, c = (np.bincount(of[toxic == k], minlength=kinds).astype(float) for k in (1, 0))
    base = t.sum() / max(1.0, t.sum() + c.sum())
    with np.errstate(divide="ignore", invalid="ignore"):
        share = np.where(t + c > 0, t / (t + c), 0)
        rest = np.where(share < 1, (1 - share) * np.log((1 - share) / (1 - base)), 0)
        proof = np.nan_to_num((t + c) * (share * np.log(share / base) + rest))
    proven = (proof >= np.log(max(1, kinds) * (len(PREFIXES) + 2) / CHANCE)) & (share >= PRECISION)
    shares = np.append(share, 0.0)[key]
    return np.append(proven, False)[key], shares


def toxic_words(words: Words, toxic: np.ndarray) -> np.ndarray:
    """Which words of toxic texts are labelled toxic, by evidence from all the labelled texts."""
    names = [normal(w) for w in words.distinct.to_pylist()]
    number: dict[str, int] = {"": 0}
    of_word = np.array([number.setdefault(n, len(number)) for n in names], np.int64)
    code, label = of_word[words.codes], toxic[words.doc].astype(np.int64)
    size = len(number) + 1
    follows = words.doc[1:] == words.doc[:-1]

    def shifted(by: int) -> np.ndarray:
        """The code of the word ``by`` places away in the same text."""
        result = np.full(len(code), size - 1)
        if by < 0:
            same = words.doc[-by:] == words.doc[:by]
            result[-by:][same] = code[:by][same]
        else:
            same = words.doc[by:] == words.doc[:-by]
            result[:-by][same] = code[by:][same]
        return result

    if len(code) < 2:
        return np.zeros(len(code), bool)
    before, after = shifted(-1), shifted(1)
    context = np.unique(before * size + after, return_inverse=True)[1]
    tagged, shares = _marked(np.where(code > 0, code, -1), context, label)
    for width in PREFIXES:
        beginnings: dict[str, int] = {}
        of = [beginnings.setdefault(n[:width], len(beginnings)) if len(n) > width else -1 for n in number]
        tagged |= _marked(np.array(of)[code], context, label)[0]
    # Of a proven pair that no word of it explains, the word that is the more toxic one by itself.
    around = np.unique(shifted(-2) * size + after, return_inverse=True)[1]
    pair = np.unique(before * size + code, return_inverse=True)[1]
    pair[np.append(True, ~follows)] = -1
    second = np.flatnonzero(_marked(pair, around, label)[0] & ~tagged & ~np.append(False, tagged[:-1]))
    tagged[np.where(shares[second - 1] > shares[second], second - 1, second)] = True
    return tagged & toxic[words.doc]


def fit(texts: list[str], toxic: np.ndarray) -> Model:
    """The field and the score from labelled texts, in memory: a bounded sample."""
    model = Model()
    if not len(texts) or toxic.all() or not toxic.any():
        model.weights[CONSTANT] = -20.0
        share = (toxic.sum() + 0.5) / (len(texts) + 1)
        model.score[0] = np.log(share / (1 - share)) if len(texts) else -5.0
        return model
    words = Words(pa.array(texts, pa.string()))
    truth = toxic_words(words, toxic)
    # Toxic and clean texts in turn, as many as the bound on words takes.
    order = np.argsort(np.concatenate([np.arange((toxic == k).sum()) for k in (1, 0)]), kind="stable")
    order = np.concatenate([np.flatnonzero(toxic), np.flatnonzero(~toxic)])[order]
    chosen = np.zeros(len(texts), bool)
    chosen[order[np.cumsum(words.counts[order]) <= TRAIN_TOKENS]] = True
    truth = truth[chosen[words.doc]]
    some = Words(pa.array([t for t, c in zip(texts, chosen, strict=True) if c], pa.string()))
    seen, chains = Features(some), Chains(some.counts)
    starts = np.append(True, some.doc[1:] != some.doc[:-1])[: len(truth)]
    from_toxic = np.where(starts, False, np.append(False, truth[:-1])[: len(truth)])
    real_moves = np.array([np.sum((from_toxic == a) & (truth == b)) for a in (0, 1) for b in (0, 1)], float)
    weights = np.zeros(WEIGHTS + 4)
    mean, square = np.zeros(WEIGHTS + 4), np.zeros(WEIGHTS + 4)
    for n in range(1, STEPS + 1):  # Adam on the regularised log-likelihood
        p, moves = chains.marginals(seen.emission(weights[:WEIGHTS]), weights[WEIGHTS:].reshape(2, 2))
        slope = np.append(seen.gathered(truth - p), real_moves - moves.ravel()) - PENALTY * weights
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        weights = weights + 0.1 * (mean / (1 - 0.9**n)) / (np.sqrt(square / (1 - 0.99**n)) + 1e-8)
    model.weights, model.transition = weights[:WEIGHTS], weights[WEIGHTS:].reshape(2, 2)
    inputs = document_inputs(marginals(model, words), words)
    model.score = _logistic(inputs, toxic.astype(float))
    return model


def marginals(model: Model, words: Words) -> np.ndarray:
    return Chains(words.counts).marginals(Features(words).emission(model.weights), model.transition)[0]


def document_inputs(p: np.ndarray, words: Words) -> np.ndarray:
    """Constant, largest marginal, logarithm of the expected number of toxic words, and of their share."""
    largest = np.zeros(len(words.counts))
    np.maximum.at(largest, words.doc, p)
    total = np.bincount(words.doc, p, len(words.counts))
    share = np.log((total + 0.1) / (words.counts + 10.0))
    return np.stack([np.ones(len(largest)), largest, np.log1p(total), share], 1)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (y - p) - 0.1 * w
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), slope)
    return w


def score_slice(model: Model, texts: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Score of each text, and its spans as ``start:end`` in code points."""
    words = Words(texts)
    p = marginals(model, words)
    score = 1 / (1 + np.exp(-document_inputs(p, words) @ model.score))
    spans: dict[int, list[int]] = defaultdict(list)
    for i in np.flatnonzero(p >= 0.5).tolist():
        spans[int(words.doc[i])].append(i - int(words.offsets[words.doc[i]]))
    written = [""] * len(texts)
    for row, at in spans.items():
        bounds = [m.span() for m in WORD.finditer(texts[row].as_py())]
        written[row] = ",".join(f"{bounds[i][0]}:{bounds[i][1]}" for i in at)
    return score, written


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on at most SAMPLE labelled rows that are not held out."""
    rows = labelled_sample(docs, labels, "toxic", SAMPLE).toPandas().sort_values("doc_id")
    return fit(rows["text"].tolist(), rows["_label"].to_numpy() > 0.5)


def toxicity(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, spans) of every whole text.

    ``spans`` are the words whose marginal is one half at least. A null or empty text
    has no words and gets the score of a text without toxic words. Repeated rows and
    rows without an id (held out) give one row each; other columns are not read; an
    empty table gives no rows. No shuffle; the model (WEIGHTS numbers, whatever the
    data) goes out by broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            score, spans = score_slice(shared.value, texts_of(batch))
            held = [held_out(i) for i in batch.column("doc_id").to_pylist()]
            predicted = pa.array(score >= REJECT).cast(pa.int32())
            columns = [batch.column("doc_id"), pa.array(held), pa.array(score), predicted, pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted", "spans"])

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return on_batches(rows, run, "doc_id long, held_out boolean, score double, predicted int, spans string")


def without_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with a score below REJECT, with all their columns. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text):
            score, _ = score_slice(shared.value, texts_of(batch, text))
            yield batch.filter(pa.array(score < REJECT))

    return on_batches(docs, run, docs.schema)
