"""Quality rules whose cutoffs come with a guarantee.

Base rules have fixed limits. Further rules compare a statistic of the text with a
cutoff that is chosen on labelled documents, per stratum of length. One half of the
labelled texts orders the cutoffs of all rules into one path, each step making one rule
stricter. The other half tests the path: a step is safe if an exact binomial test shows
that all rules of the stratum together reject no more than ALPHA of the good texts.
Testing stops at the first step that fails (fixed sequence), and strata share the error
level DELTA (Bonferroni). So with probability 1 - DELTA no stratum loses more than ALPHA
of its good texts to the cutoffs in use.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmart.llm.base import Words, on_batches, stored, text_slices, texts_of

LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent
ALPHA = 0.02
DELTA = 0.05
PRICE = 3.0
"""How many rejected bad documents make up for one rejected good one."""

STRATA = (150, 400, 1000)
"""Upper bounds of n_words of the strata but the last."""

# Rules reject values above the cutoff; cutoffs from the most lenient on.
GRID = {
    "symbol_share": [round(0.5 * 0.8**i, 6) for i in range(24)],
    "bar_share": [round(0.5 * 0.8**i, 6) for i in range(24)],
    "exclamation_share": [round(0.5 * 0.8**i, 6) for i in range(24)],
    "upper_share": [round(0.95 - 0.05 * i, 6) for i in range(19)],
    "dup_line_share": [round(0.95 - 0.05 * i, 6) for i in range(19)],
    "repeat_share": [round(0.48 - 0.03 * i, 6) for i in range(16)],
    "mean_word": [float(30 - i) for i in range(24)],
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_lines", "n_bars", "n_marks", "n_upper"]


def counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS of each whole text of a slice."""
    n = len(texts)
    words = Words(texts)
    found = {"n_words": words.counts}
    width = pc.utf8_length(words.distinct).to_numpy(zero_copy_only=False).astype(np.int64)
    found["word_chars"] = np.bincount(words.doc, width[words.codes], n).astype(np.int64)
    for name, pattern in (("n_symbols", "[#*$%&|<>]"), ("n_bars", "[|]"), ("n_marks", "!"), ("n_upper", r"\p{Lu}")):
        found[name] = pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)
    found["n_chars"] = pc.utf8_length(texts).to_numpy(zero_copy_only=False)

    lines = pc.split_pattern(texts, "\n")
    doc = np.repeat(np.arange(n), pc.list_value_length(lines).to_numpy(zero_copy_only=False))
    encoded = lines.flatten().dictionary_encode()
    full = pc.match_substring_regex(encoded.dictionary, r"[^ \t\n\x0b\f\r]").to_numpy(zero_copy_only=False)
    code = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    real = full[code] if len(code) else code.astype(bool)
    code, doc = code[real], doc[real]
    seen_before = pd.Series(code * n + doc).duplicated().to_numpy()
    found["n_lines"] = np.bincount(doc, minlength=n)
    found["n_dup_lines"] = np.bincount(doc[seen_before], minlength=n)

    # Windows of three words get a number step by step: pairs, pairs and a word, and the text.
    at = np.flatnonzero(words.doc[2:] == words.doc[:-2]) if len(words.doc) > 2 else np.zeros(0, np.int64)
    size = len(words.distinct) + 1
    pair = pd.factorize(words.codes[at] * size + words.codes[at + 1])[0]
    window = pd.factorize(pair * size + words.codes[at + 2])[0]
    twice = at[pd.Series(window * n + words.doc[at]).duplicated(keep=False).to_numpy()]
    covered = np.zeros(len(words.doc), bool)
    for shift in range(3):
        covered[twice + shift] = True
    found["n_repeat_words"] = np.bincount(words.doc[covered], minlength=n)
    return found


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, COUNTS) of every whole text. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = counts(texts_of(batch))
            arrays = [batch.column("doc_id"), batch.column("text_hash"), *[pa.array(found[c].astype(np.int64)) for c in COUNTS]]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_hash", *COUNTS])

    rows = docs.select(
        docs[doc_id].cast("long").alias("doc_id"), F.xxhash64(docs[text]).alias("text_hash"), docs[text].alias("text")
    )
    return on_batches(rows, run, "doc_id long, text_hash long, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def rule_values() -> dict[str, Column]:
    share = lambda part, whole: F.col(part) / F.greatest(F.col(whole), F.lit(1))
    return {
        "symbol_share": share("n_symbols", "n_words"),
        "bar_share": share("n_bars", "n_words"),
        "exclamation_share": share("n_marks", "n_words"),
        "upper_share": share("n_upper", "n_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "mean_word": share("word_chars", "n_words"),
    }


def stratum() -> Column:
    below = [(F.col("n_words") > bound).cast("int") for bound in STRATA]
    return sum(below[1:], below[0])


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X of n trials with chance p, exactly; k is at most the mean."""
    log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    total, term = 0.0, 1.0
    for i in range(k, -1, -1):
        total += term
        if term < 1e-18 * total:  # the rest falls faster than geometrically
            break
        term *= i / (n - i + 1) * (1 - p) / p
    return min(1.0, math.exp(log) * total)


Cells = dict[int, list[int]]
"""How many [bad, good] labelled texts fail from an index on."""


def order_steps(passed: dict[str, Cells]) -> list[tuple[str, int]]:
    """The path of one stratum: (rule, index of its cutoff), each stricter for its rule than before.

    ``passed[rule][i]`` counts the texts that fail exactly the cutoffs of the rule from
    i on. Of the steps whose bad texts outweigh PRICE times their good ones, the one
    with the fewest good texts per bad one comes next, so the safest are tested first.
    """
    sums = {
        rule: np.cumsum([[0, 0], *[cells.get(i, [0, 0]) for i in range(len(GRID[rule]))]], axis=0)
        for rule, cells in sorted(passed.items())
    }
    reached = dict.fromkeys(sums, -1)
    path = []
    while True:
        options = []
        for rule, at in reached.items():
            for i in range(at + 1, len(GRID[rule])):
                bad, good = (sums[rule][i + 1] - sums[rule][at + 1]).tolist()
                if bad > PRICE * good:
                    options.append((good / bad, -bad, i, rule))
        if not options:
            return path
        *_, i, rule = min(options)
        reached[rule] = i
        path.append((rule, i))


def safe_steps(failing: Cells, steps: int, alpha: float = ALPHA, delta: float = DELTA) -> int:
    """How many steps of a path are safe.

    ``failing[s]`` counts the texts that the first s steps pass and step s (from 0)
    rejects; all others have an index of ``steps``.
    """
    good = sum(c[1] for c in failing.values())
    level = delta / (len(STRATA) + 1)
    rejected = 0
    for step in range(steps):
        rejected += failing.get(step, [0, 0])[1]
        # Above its mean the tail is about one half or more, so no test is needed.
        if not good or rejected > alpha * good or binomial_tail(rejected, good, alpha) > level:
            return step
    return steps


def calibrate(stats: DataFrame, labels: DataFrame) -> dict[tuple[int, str], float]:
    """Cutoffs from all labelled documents that pass the base rules.

    A text counts once, however many documents share it, and as good if one of their
    labels says so; a hash of the text also says which half it belongs to. What comes
    to the driver are counts per stratum, rule and cutoff, and then per stratum and step.
    """
    marks = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = stats.where(~base_failed()).join(marks, "doc_id")
    rows = rows.groupBy("text_hash", *COUNTS).agg((F.max("quality") == 1).cast("int").alias("good"))
    firsts = {rule: sum((value <= c).cast("int") for c in GRID[rule]) for rule, value in rule_values().items()}
    rows = rows.select(
        stratum().alias("layer"), "good", (F.col("text_hash") % 2 == 0).alias("orders"), *[f.alias(r) for r, f in firsts.items()]
    )
    rows = stored(rows, "labelled")

    cells = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(rule).alias("first")) for rule in GRID])
    ordering = rows.where("orders").select("layer", "good", F.explode(cells).alias("c"))
    passed: dict[int, dict[str, Cells]] = defaultdict(lambda: defaultdict(lambda: defaultdict(lambda: [0, 0])))
    for row in ordering.groupBy("layer", "c.rule", "c.first", "good").agg(F.count("*").alias("n")).collect():
        passed[row.layer][row.rule][row.first][row.good] += row.n
    paths = {layer: order_steps(of) for layer, of in sorted(passed.items())}
    if not any(paths.values()):
        return {}

    step = F.lit(None).cast("int")
    for layer, path in paths.items():
        step = F.when(F.col("layer") == layer, _first_step(path)).otherwise(step)
    testing = rows.where(~F.col("orders")).select("layer", "good", step.alias("step")).where("step is not null")
    failing: dict[int, Cells] = defaultdict(lambda: defaultdict(lambda: [0, 0]))
    for row in testing.groupBy("layer", "step", "good").agg(F.count("*").alias("n")).collect():
        failing[row.layer][row.step][row.good] += row.n
    # The last safe step of a rule is its strictest.
    return {
        (layer, rule): GRID[rule][i]
        for layer, path in paths.items()
        for rule, i in path[: safe_steps(failing[layer], len(path))]
    }


def _first_step(path: list[tuple[str, int]]) -> Column:
    """The first step of the path that rejects a text, or its length if none does."""
    steps = [F.when(F.col(rule) <= i, F.lit(at)) for at, (rule, i) in enumerate(path)]
    return F.coalesce(*steps, F.lit(len(path)))


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept).

    A null or empty text has no words and fails the base rules. Repeated rows and rows
    without an id give one row each; other columns are not read; an empty table gives
    no rows; without labels no cutoff is safe and the base rules decide alone, also in
    a stratum with too few good texts to prove anything (less than 217 in the testing
    half). Texts are read once; their counts are written and joined with the labels.
    """
    stats = stored(measured(docs, doc_id, text), "counts")
    values = rule_values()
    rejected = F.lit(False)
    for (layer, rule), cutoff in sorted(calibrate(stats, labels).items()):
        rejected = rejected | ((stratum() == layer) & (values[rule] > cutoff))
    contract = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return stats.select(*contract, base_failed().alias("base_failed"), (~base_failed() & ~rejected).alias("kept"))
