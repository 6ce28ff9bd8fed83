"""Benchmark decontamination: documents query an inverted BM25 index of the test items.

Test items are cut into units of even length and indexed. Impacts are BM25 weights,
divided by the unit's score against itself, so that a score runs from 0 to 1. The
terms of every whole document are a query: their upper bound rules out documents, the
bounds per block of units (block-max) most of the rest, and only blocks that can
reach a threshold are scored. The bounds are WAND's; they are worked out for all
documents of a slice at once, as array operations. Every unit has a threshold of its
own, which follows from what verification asks (`least_scores`), so retrieval loses
no item that verification against the whole document would accept.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmart.llm.base import Words, on_batches, ranges, stored, text_slices, texts_of

UNIT = 64
"""Words of an indexed unit, at most."""

BLOCK = 8
K1, B = 1.2, 0.75
SHINGLE = 5
CONTAINED = 0.8
PART = 0.5
SHARD_WORDS = 500_000
"""Words of test items that one index holds; more items are searched in several passes."""

PAIRS_AT_ONCE = 2_000_000

# White space beyond ASCII's, as str.split() has it; documents are cut there as items are.
ODD_SPACE = r"[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

HIT = "doc_id long, item_id long, score double, containment double, question_overlap double, answer_overlap double"


def normal(word: str) -> str:
    return word.lower().strip(string.punctuation)


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of a test item up to its last sentence, and of its last sentence."""
    raw = text.split()
    ends = [i for i, word in enumerate(raw[:-1]) if word[-1] in ".?!"]
    cut = ends[-1] + 1 if ends else 0
    question, answer = ([w for w in map(normal, part) if w] for part in (raw[:cut], raw[cut:]))
    return question, answer


@dataclass
class Item:
    item_id: int
    question: list[int]
    answer: list[int]

    @property
    def words(self) -> list[int]:
        return self.question + self.answer


def shingles(words: list[int] | tuple[int, ...], width: int) -> set[tuple[int, ...]]:
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def least_scores(words: list[int], units: list[dict[int, float]]) -> list[float]:
    """For each unit of an item a score that holds the item: in a document with CONTAINED
    of the item's shingles, at least one of its units scores that much.

    Each different shingle belongs to the unit where it first starts. Of the shingles
    that may be missing, some unit misses no more than its share. A term that is not in
    the document makes all shingles with it missing, and a shingle has SHINGLE terms at
    most, so the missing terms of that unit stand in so many of its shingles at most
    SHINGLE times. The heaviest terms within that (fractional knapsack) are what can be lost.
    """
    width = min(SHINGLE, len(words))
    first: dict[tuple[int, ...], int] = {}
    for i in range(len(words) - width + 1):
        first.setdefault(tuple(words[i : i + width]), i)
    missing = max(m for m in range(len(first)) if (len(first) - m) / len(first) >= CONTAINED)
    ends = np.cumsum([len(unit) for unit in units_of(words)])
    costs: list[Counter] = [Counter() for _ in units]
    own = [0] * len(units)
    for shingle, i in first.items():
        unit = int(np.searchsorted(ends, i, "right"))
        own[unit] += 1
        costs[unit].update(set(shingle))
    least = []
    for weights, cost, count in zip(units, costs, own, strict=True):
        room, lost = width * (missing * count // len(first)), 0.0
        for term, weight in sorted(weights.items(), key=lambda w: cost[w[0]] / w[1]):
            part = min(1.0, room / cost[term]) if cost[term] else 1.0
            lost += part * weight
            room -= part * cost[term]
        least.append(1 - lost if count else math.inf)
    return least


class Index:
    """Postings of the units of one shard, grouped by term and block."""

    def __init__(self, items: list[tuple[int, str]], frequency: dict[str, int], units: int, mean: float):
        """``frequency``, ``units`` and ``mean`` describe all units, also those of other shards."""
        self.vocabulary: dict[str, int] = {}
        self.items: list[Item] = []
        known = self.vocabulary
        postings: list[tuple[int, int, float]] = []
        owner: list[int] = []
        least: list[float] = []
        for item_id, text in items:
            question, answer = question_and_answer(text)
            numbers = [[known.setdefault(w, len(known)) for w in part] for part in (question, answer)]
            self.items.append(Item(item_id, *numbers))
            own: list[dict[int, float]] = []
            for unit in units_of(question + answer):
                weights = {}
                for word, times in Counter(unit).items():
                    rarity = math.log(1 + (units - frequency[word] + 0.5) / (frequency[word] + 0.5))
                    norm = K1 * (1 - B + B * len(unit) / mean)
                    weights[known[word]] = rarity * times * (K1 + 1) / (times + norm)
                total = sum(weights.values())
                own.append({term: w / total for term, w in weights.items()})
                postings += [(term, len(owner), w) for term, w in own[-1].items()]
                owner.append(len(self.items) - 1)
            if own:
                least += least_scores(self.items[-1].words, own)
        self.owner = np.array(owner, np.int64)
        self.least = np.array(least)
        self.blocks = -(-len(owner) // BLOCK)
        postings.sort()
        term, unit, self.impact = (np.array(c) for c in zip(*postings, strict=True)) if postings else (np.zeros(0),) * 3
        term, self.unit = term.astype(np.int64), unit.astype(np.int64)
        # An entry is the run of postings of one term in one block.
        key = term * max(1, self.blocks) + self.unit // BLOCK
        self.entry_start = np.flatnonzero(np.diff(key, prepend=-1))
        self.entry_size = np.diff(np.append(self.entry_start, len(key)))
        self.entry_block = self.unit[self.entry_start] // BLOCK
        self.entry_max = np.maximum.reduceat(self.impact, self.entry_start) if len(key) else np.zeros(0)
        entry_term = term[self.entry_start]
        self.term_start = np.searchsorted(entry_term, np.arange(len(known)))
        self.term_size = np.bincount(entry_term, minlength=len(known))
        self.term_max = np.zeros(len(known))
        np.maximum.at(self.term_max, entry_term, self.entry_max)

    def retrieve(self, doc: np.ndarray, term: np.ndarray, threshold: float | np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, unit, score) with a score of the (unit's) threshold at least.

        Input are the different terms of each document, sorted by document.
        """
        slack = np.broadcast_to(threshold, len(self.owner)) - 1e-9
        block_slack = np.minimum.reduceat(slack, np.arange(0, len(slack), BLOCK))
        bound = np.bincount(doc, self.term_max[term])
        alive = bound[doc] >= slack.min()
        doc, term = doc[alive], term[alive]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        work = np.cumsum(self.term_size[term])
        work[first] += self.blocks * np.arange(len(first))
        # Cut between documents: a part has a bounded number of entries, and of documents x blocks.
        part = (work[first] // PAIRS_AT_ONCE) if len(first) else first
        cuts = [*first[np.flatnonzero(np.diff(part, prepend=-1))], len(doc)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            found.append(self._score(doc[a:b], term[a:b], slack, block_slack))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def _score(self, doc: np.ndarray, term: np.ndarray, slack: np.ndarray, block_slack: np.ndarray) -> tuple[np.ndarray, ...]:
        entry = ranges(self.term_start[term], self.term_size[term])
        changes = np.diff(doc, prepend=-1) != 0
        names, local = doc[changes], np.cumsum(changes) - 1
        pair = np.repeat(local, self.term_size[term]) * self.blocks + self.entry_block[entry]
        able = np.bincount(pair, self.entry_max[entry])[pair] >= block_slack[self.entry_block[entry]]
        entry, pair = entry[able], pair[able]
        posting = ranges(self.entry_start[entry], self.entry_size[entry])
        key = np.repeat(pair // self.blocks, self.entry_size[entry]) * len(self.owner) + self.unit[posting]
        keys, at = np.unique(key, return_inverse=True)
        score = np.bincount(at, self.impact[posting], len(keys))
        good = score >= slack[keys % len(self.owner)]
        return names[keys[good] // len(self.owner)], keys[good] % len(self.owner), score[good]

    def search(self, texts: pa.Array) -> Iterator[tuple[int, Item, float, float, float, float]]:
        """(row, item, score, containment, question and answer overlap) of verified items."""
        words = Words(pc.replace_substring_regex(texts, ODD_SPACE, " "))
        terms = [normal(w) for w in words.distinct.to_pylist()]
        number = np.fromiter((self.vocabulary.get(t, -1) if t else -2 for t in terms), np.int64, len(terms))
        code = number[words.codes]
        real = code != -2  # marks alone are no words
        code, doc = code[real], words.doc[real]
        starts = np.append(0, np.cumsum(np.bincount(doc, minlength=len(texts))))
        known = code >= 0
        size = max(1, len(self.vocabulary))
        key = doc[known] * size + code[known]
        key.sort()
        key = key[np.diff(key, prepend=-1) != 0]
        if not len(key):
            return
        row, unit, score = self.retrieve(key // size, key % size, self.least)
        best: dict[tuple[int, int], float] = {}
        for r, i, s in zip(row.tolist(), self.owner[unit].tolist(), score.tolist(), strict=True):
            best[r, i] = max(s, best.get((r, i), 0.0))
        grams: dict[int, set] = {}
        lines: dict[int, set] = {}
        for (r, i), s in sorted(best.items()):
            item, text = self.items[i], code[starts[r] : starts[r + 1]]
            if len(item.words) < SHINGLE:
                if r not in lines:
                    lines = {r: self._short_lines(texts[r].as_py())}
                if tuple(item.words) in lines[r]:
                    yield r, item, s, 1.0, 1.0, 1.0
                continue
            if r not in grams:
                grams = {r: shingles(tuple(text.tolist()), SHINGLE)}
            own = shingles(item.words, SHINGLE)
            contained = len(own & grams[r]) / len(own)
            have = set(text.tolist())
            asked, answered = (
                len(have & set(part)) / len(set(part)) if part else 1.0 for part in (item.question, item.answer)
            )
            if contained >= CONTAINED and asked >= PART and answered >= PART:
                yield r, item, s, contained, asked, answered

    def _short_lines(self, text: str) -> set[tuple[int, ...]]:
        """The lines, and the whole text, that have fewer than SHINGLE words."""
        lines = ([w for w in map(normal, line.split()) if w] for line in (text, *text.splitlines()))
        return {tuple(self.vocabulary.get(w, -1) for w in line) for line in lines if len(line) < SHINGLE}


def units_of(words: list[str]) -> list[list[str]]:
    """Words cut into the fewest parts of at most UNIT words, of even length."""
    parts = -(-len(words) // UNIT)
    cuts = [len(words) * i // parts for i in range(parts + 1)] if parts else [0]
    return [words[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def indexes(items: DataFrame, item_id: str = "item_id", text: str = "text") -> list[Callable[[], Index]]:
    """A maker for each shard's index, so that one shard at a time is in memory.

    Repeated rows of an item are one item. Statistics cover all items and come from
    Spark. A shard holds about SHARD_WORDS words: that is what is collected, and what
    goes out by broadcast.
    """
    rows = items.select(items[item_id].cast("long").alias("item_id"), F.coalesce(items[text], F.lit("")).alias("text"))
    rows = stored(rows.distinct(), "items")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            out: list[tuple[str, int]] = []
            for value in batch.column("text").to_pylist():
                for unit in units_of(sum(question_and_answer(value), [])):
                    out += [(word, int(i == 0)) for i, word in enumerate(sorted(set(unit)))]
                    out.append(("", len(unit)))
            arrays = [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["word", "n"])

    words = on_batches(rows, split, "word string, n long")
    total = words.where("word = ''").agg(F.count("*").alias("units"), F.sum("n").alias("words")).first()
    if not total.units:
        return []
    shards = -(-total.words // SHARD_WORDS)
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(shards))

    def make(number: int) -> Index:
        own = rows.where(shard == number)
        mine = on_batches(own, split, "word string, n long").select("word").distinct()
        frequency = words.join(mine, "word", "left_semi").groupBy("word").agg(F.count("*").alias("n")).collect()
        texts = [(row.item_id, row.text) for row in own.collect()]
        return Index(texts, {row.word: row.n for row in frequency}, total.units, total.words / total.units)

    return [lambda n=n: make(n) for n in range(shards)]


def hits(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, score, containment, question_overlap, answer_overlap) of leaked items.

    One row for each document row and different test item (id and text) that it holds:
    SHINGLE-word shingles of the item are in the document by CONTAINED at least, and so
    are the words of both question and answer (the last sentence) by PART. Case and
    punctuation around words do not count, nor does which white space is between them. An item of fewer than SHINGLE words is held
    only by a document with a line, or a whole text, of just these words in their order.
    Clean documents give no row, nor do null or empty texts or items. Rows with a null
    or repeated id are searched like others; other columns are not read. No shuffle of
    documents.
    """
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    found = docs.sparkSession.createDataFrame([], HIT)
    for make in indexes(items):
        index = docs.sparkSession.sparkContext.broadcast(make())

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches):
                ids = batch.column("doc_id")
                out = [(ids[r].as_py(), item.item_id, *numbers) for r, item, *numbers in index.value.search(texts_of(batch))]
                if out:
                    kinds = [pa.int64()] * 2 + [pa.float64()] * 4
                    arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in HIT.split(", ")])

        found = found.union(on_batches(rows, run, HIT))
    return found


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The documents that hold no test item, with all their columns. No shuffle."""
    for make in indexes(items):
        index = docs.sparkSession.sparkContext.broadcast(make())

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches, text):
                keep = np.ones(batch.num_rows, bool)
                keep[[hit[0] for hit in index.value.search(texts_of(batch, text))]] = False
                yield batch.filter(pa.array(keep))

        docs = on_batches(docs, run, docs.schema)
    return docs
