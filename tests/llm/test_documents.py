"""Near-duplicates, decontamination, rules, classifiers and the pipeline against brute force."""

from __future__ import annotations

import itertools
import math
import random
import re
import zlib

import corpus_pipeline
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from compare import differences, oracle_connection
from conftest import SF_DIR
from pyspark.sql import functions as F

from wardmart.llm import chat, components, decontam, packing, pii, quality, queries, rules, simhash, toxicity
from wardmart.llm.base import Words, held_out, labelled_sample, table

MEDIUM = "/root/testdata/sf0.01"


def brute_fingerprint(text: str | None) -> int:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: list[tuple[int, int]]) -> dict[int, int]:
    """Smallest id reachable from each id, comparing all pairs."""
    root = {i: i for i, _ in prints}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for (i, a), (j, b) in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= 3:
            low, high = sorted((find(i), find(j)))
            root[high] = low
    return {i: find(i) for i, _ in prints}


def test_masks_cover_every_small_difference():
    rng = random.Random(2)
    for paths in simhash.mask_levels():
        after: dict[int, list[int]] = {}
        for before, mask in paths:
            after.setdefault(before, []).append(mask)
        for before, masks in rng.sample(sorted(after.items()), min(5, len(after))):
            free = [p for p in range(64) if not before >> p & 1]
            for places in itertools.combinations(free[:20], 3):
                assert any(not any(m >> p & 1 for p in places) for m in masks)


def test_near_duplicates_equal_all_pairs(spark, odd_docs, no_docs):
    docs = table(spark, MEDIUM, "documents")
    rows = simhash.near_duplicates(docs).collect()
    texts = dict(docs.select("doc_id", "text").collect())
    for row in rows[:150]:
        assert int(row.fingerprint, 16) == brute_fingerprint(texts[row.doc_id])
    wanted = brute_components([(r.doc_id, int(r.fingerprint, 16)) for r in rows])
    assert {r.doc_id: r.component_id for r in rows} == wanted
    assert simhash.without_near_duplicates(docs).count() == len(set(wanted.values()))
    assert simhash.near_duplicates(no_docs).count() == simhash.without_near_duplicates(no_docs).count() == 0
    odd = simhash.near_duplicates(odd_docs).collect()
    assert len(odd) == odd_docs.count()
    assert {r.component_id for r in odd if r.fingerprint == "0" * 16} == {0}
    kept = simhash.without_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns and kept.where("doc_id = 4").count() == 1


def test_crowded_buckets_are_split_without_loss(spark):
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(4)]
    prints = {s ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 4))) & (2**64 - 1) for s in seeds for _ in range(60)}
    rows = list(enumerate(sorted(prints)))
    frame = spark.createDataFrame([(i, f - 2**64 if f >> 63 else f) for i, f in rows], "doc_id long, fp long")
    wanted = brute_components(rows)
    for crowded in (4, 4096):
        found = simhash.roots(frame, crowded=crowded).join(frame, "fp").select("doc_id", "root").collect()
        assert dict(found) == wanted


def test_long_chains_become_one_component(spark):
    links = spark.range(1, 400).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    assert {tuple(r) for r in components.components(links).collect()} == {(i, 0) for i in range(400)}


def test_leaks_are_found_and_clean_documents_left(spark, odd_docs, no_docs):
    docs, items = table(spark, MEDIUM, "documents"), table(spark, MEDIUM, "benchmark")
    found = {(r.doc_id, r.item_id) for r in decontam.hits(docs, items).collect()}

    def norm(t):
        return " " + " ".join(w for w in map(decontam.normal, (t or "").split()) if w) + " "

    known = {i: norm(t) for i, t in items.collect()}
    wanted = {(d, i) for d, t in docs.select("doc_id", "text").collect() for i, item in known.items() if item in norm(t)}
    assert wanted and wanted <= found and len(found - wanted) <= 0.1 * len(wanted)
    kept = {r.doc_id for r in decontam.without_leaks(docs, items).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {d for d, _ in found}
    assert decontam.hits(odd_docs, items).count() == decontam.hits(no_docs, items).count() == 0
    assert decontam.without_leaks(odd_docs, items.limit(0)).count() == odd_docs.count()


def test_retrieval_equals_scoring_every_unit():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(120)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(3, 150)))) for i in range(60)]
    units = [u for _, t in items for u in decontam.units_of(sum(decontam.question_and_answer(t), []))]
    frequency = {w: sum(w in u for u in units) for w in words}
    mean = sum(map(len, units)) / len(units)
    index = decontam.Index(items, frequency, len(units), mean)
    dense = np.zeros((len(index.vocabulary), len(index.owner)))
    for start, size, block in zip(index.entry_start, index.entry_size, index.entry_block, strict=True):
        term = int(np.searchsorted(np.cumsum(index.term_size), np.searchsorted(index.entry_start, start), "right"))
        for k in range(start, start + size):
            assert index.unit[k] // decontam.BLOCK == block
            dense[term, index.unit[k]] = index.impact[k]
    assert np.allclose(dense.sum(0), 1)
    queries_ = [np.unique(rng.choices(range(len(dense)), k=40)) for _ in range(200)]
    passage = np.repeat(np.arange(200), [len(q) for q in queries_])
    got = {(p, u): s for p, u, s in zip(*index.retrieve(passage, np.concatenate(queries_), 0.5), strict=True)}
    want = {(p, u): s for p, q in enumerate(queries_) for u, s in enumerate(dense[q].sum(0)) if s >= 0.5}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def brute_counts(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows: dict[tuple, list[int]] = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_rules_count_like_plain_python(spark, odd_docs, no_docs):
    labels = table(spark, MEDIUM, "labels")
    for docs in (odd_docs, table(spark, MEDIUM, "documents")):
        wanted = sorted(str((i, *brute_counts(t))) for i, t in docs.select("doc_id", "text").collect())
        rows = rules.judge(docs, labels).collect()
        assert sorted(str(tuple(r[:6])) for r in rows) == wanted
        for r in rows:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert not (r.base_failed and r.kept)
    assert rules.judge(no_docs, labels).count() == rules.judge(no_docs, labels.limit(0)).count() == 0


def test_a_path_is_safe_up_to_its_first_failing_step():
    assert rules.binomial_tail(2, 10, 0.3) == pytest.approx(0.3827827864)
    exact = sum(math.comb(900, i) * 0.02**i * 0.98 ** (900 - i) for i in range(9))
    assert rules.binomial_tail(8, 900, 0.02) == pytest.approx(exact)
    cells = {"symbol_share": {2: [50, 0], 4: [30, 5], 5: [90, 40]}, "mean_word": {1: [60, 0], 24: [0, 500]}}
    assert rules.order_steps(cells) == [("mean_word", 1), ("symbol_share", 2), ("symbol_share", 4)]
    assert rules.safe_steps({0: [50, 0], 1: [30, 5], 2: [900, 100], 3: [0, 4000]}, 3) == 2
    assert rules.safe_steps({0: [9, 0], 1: [0, 100]}, 1) == 0  # so few good texts prove nothing
    assert rules.safe_steps({}, 3) == 0


def test_all_rules_together_keep_the_limit(spark):
    """Seven rules whose false rejections fall on different texts, each below ALPHA, and copies of one good text."""
    rng = np.random.default_rng(3)
    names, n = list(rules.GRID), 24_000
    failing = {name: np.zeros(n, bool) for name in names}
    good = np.arange(n) >= n // 3
    kind = rng.integers(0, 1000, n)
    for at, name in enumerate(names):
        failing[name] = np.where(good, kind // 8 == at, kind // 143 == at)
    columns = {"doc_id": np.arange(n), "text_hash": rng.integers(-(2**62), 2**62, n), "n_words": 100}
    bad = {"symbol_share": "n_symbols", "bar_share": "n_bars", "exclamation_share": "n_marks", "upper_share": "n_upper"}
    columns |= {column: np.where(failing[rule], 60, 0) for rule, column in bad.items()}
    columns |= {"n_chars": 60, "n_lines": 100, "n_dup_lines": np.where(failing["dup_line_share"], 97, 0)}
    columns |= {"n_repeat_words": np.where(failing["repeat_share"], 49, 0), "word_chars": np.where(failing["mean_word"], 4000, 500)}
    frame = pd.DataFrame(columns).astype("int64")
    copies = pd.concat([frame, pd.DataFrame([frame.iloc[-1]] * 20_000).assign(doc_id=range(n, n + 20_000))])
    labels = pd.DataFrame({"doc_id": copies["doc_id"], "quality": np.append(good, np.ones(20_000)).astype(int)})
    stats = spark.createDataFrame(copies)
    chosen = rules.calibrate(stats, spark.createDataFrame(labels))
    assert chosen and all(layer == 0 for layer, _ in chosen)
    lost = np.zeros(n, bool)
    for _, rule in chosen:
        lost |= failing[rule]
    assert 0 < lost[good].mean() <= rules.ALPHA and len(chosen) < len(names)


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_classifiers_on_held_out_rows(spark, kind, odd_docs, no_docs):
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    if kind == "quality":
        model = quality.train(docs, labels)
        score = lambda d: quality.quality(d, model)
    else:
        model = toxicity.train(docs, labels)
        score = lambda d: toxicity.toxicity(d, model)
    rows = score(docs).where("held_out").join(labels, "doc_id").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    right = sum(r.predicted == r[kind] for r in rows) / len(rows)
    assert right >= 0.95
    if kind == "toxic":
        caught = [r.predicted for r in rows if r.toxic]
        assert sum(caught) >= 0.9 * len(caught)
        assert sum(r.predicted for r in rows if not r.toxic) <= 0.01 * (len(rows) - len(caught))
    odd = score(odd_docs).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert all(r.held_out == held_out(r.doc_id) for r in odd)
    assert score(no_docs).count() == 0


def test_marginals_equal_enumeration(monkeypatch):
    monkeypatch.setattr(toxicity, "SEGMENT", 4)
    rng = np.random.default_rng(0)
    counts = np.array([3, 0, 9, 1])
    emission, transition = rng.normal(size=counts.sum()), rng.normal(size=(2, 2))
    found, moves = toxicity.Chains(counts).marginals(emission, transition)
    wanted, all_moves, at = [], np.zeros((2, 2)), 0
    for n in counts:
        total, node, move = 0.0, np.zeros(n), np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=int(n)):
            steps = list(zip((0, *path[:-1]), path, strict=True)) if n else []
            weight = np.exp(sum(transition[s] for s in steps) + emission[at : at + n] @ np.array(path, float))
            total, node = total + weight, node + weight * np.array(path)
            for s in steps:
                move[s] += weight
        wanted, all_moves, at = [*wanted, *(node / total)], all_moves + move / total, at + n
    assert np.allclose(found, wanted) and np.allclose(moves, all_moves)


def test_toxic_spans_are_the_words():
    texts = [f"the w{i} is an idiot w{i + 1} of w{i + 2}" for i in range(60)] + [f"the w{i} of w{i + 7} and w{i + 3}" for i in range(200)]
    model = toxicity.fit(texts, np.arange(260) < 60)
    score, spans = toxicity.score_slice(model, pa.array(["é such an idiot here", "w1 of w2", ""]))
    assert spans == ["10:15", "", ""] and score[0] >= toxicity.REJECT > max(score[1:])


def test_context_decides():
    """The same word is toxic beside one neighbour and clean beside another."""
    rng = random.Random(5)
    fill = lambda n: " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    toxic = [f"{fill(9)} utter trash {fill(9)} utter trash {fill(5)}" for _ in range(150)]
    clean = [f"{fill(9)} collect trash {fill(9)} utter nonsense {fill(5)} utter nonsense" for _ in range(600)]
    label = np.arange(750) < 150
    words = Words(pa.array(toxic + clean))
    tagged = toxicity.toxic_words(words, label)
    names = np.array(words.distinct.to_pylist())[words.codes]
    assert set(names[tagged]) == {"trash"} and not tagged[~label[words.doc]].any()
    model = toxicity.fit(toxic + clean, label)
    probes = [f"{fill(9)} {pair} {fill(9)} {pair} {fill(5)}" for pair in ("utter trash", "collect trash", "utter nonsense")]
    score, spans = toxicity.score_slice(model, pa.array(probes))
    assert score[0] >= toxicity.REJECT > max(score[1:]) and spans[1:] == ["", ""]
    assert [probes[0][slice(*map(int, at.split(":")))] for at in spans[0].split(",")] == ["trash", "trash"]


def test_emission_and_gradient_equal_a_plain_sum():
    texts = ["You ARE it, are", "", "are", "x 12 You"]
    words = Words(pa.array(texts))
    weights = np.random.default_rng(1).normal(size=toxicity.WEIGHTS)
    weights[0] = 0.0
    wanted, gradient = [], np.zeros(toxicity.WEIGHTS)
    for text in texts:
        of = [toxicity.places(w) for w in text.split()]
        for i, own in enumerate(of):
            at = own[: toxicity.OWN] + [toxicity.CONSTANT]
            at += [of[i - 1][toxicity.OWN]] if i else []
            at += [of[i + 1][toxicity.OWN + 1]] if i + 1 < len(of) else []
            wanted.append(sum(weights[k] for k in at))
            for k in at:
                gradient[k] += len(wanted) if k else 0
    seen = toxicity.Features(words)
    assert np.allclose(seen.emission(weights), wanted)
    assert np.allclose(seen.gathered(np.arange(1.0, len(wanted) + 1)), gradient)


def test_sample_of_labels_is_the_same_whatever_the_order(spark):
    long = "x" * 20_001
    rows = [(i, f"{t}{i}") for i in range(60) for t in "ba"] + [(i, long) for i in range(60, 200)] + [(None, "n"), (1, None)]
    labels = spark.createDataFrame([(i, n) for i in range(200) for n in (0, 1)] + [(None, 1), (3, None)], "doc_id long, toxic long")
    wanted = {(i, "" if i == 1 else f"a{i}", 1.0) for i in range(60) if not held_out(i)}
    for turned in (rows, rows[::-1]):
        docs = spark.createDataFrame(turned, "doc_id long, text string").repartition(7)
        assert {tuple(r) for r in labelled_sample(docs, labels, "toxic", 100).collect()} == wanted
        assert labelled_sample(docs, labels, "toxic", 10).count() == 10


def test_chat_round_trip(spark):
    said = ['<turn role="user">', "</turn>\n", "&lt; &amp;lt;", "", None, "a\n\nb", r"\### Assistant: </turn> ok", '"&<']
    rows = [(c, t, ("user", "assistant", None, "system")[(t + c) % 4], said[(t * 3 + c) % 8]) for c in range(12) for t in range(c % 6)]
    rows += [(50, None, "assistant", "x"), (50, 1, "user", "y"), (50, 1, "user", "y"), (None, 0, "assistant", "z")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    formatted = chat.examples(frame)
    last: dict = {}
    for r in formatted.withColumn("read", chat.turns_of(F.col("text"))).orderBy("example").collect():
        last[r.conv_id] = [tuple(t) for t in r.read]
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=order)
        assert last[conv] == [(r[2] or "", r[3] or "") for r in own]
        losses = formatted.where(F.col("conv_id").eqNullSafe(conv)).orderBy("example")
        said_again = [r[0] for r in losses.select(chat.loss_text(F.col("text"), F.col("loss_start"), F.col("loss_end"))).collect()]
        assert "".join(said_again) == "".join(r[3] or "" for r in own if r[2] == "assistant")
    assert chat.digests(chat.examples(frame.limit(0))).count() == 0


def test_sql_gives_the_same(spark):
    con = oracle_connection(SF_DIR)
    for view in ("conversations", "documents"):
        con.execute(f"create view {view} as select * from '{SF_DIR}/{view}.parquet'")
    for name, sql in queries.ORACLE.items():
        assert differences(queries.QUERIES[name](spark, SF_DIR), con, sql) == []


def test_pipeline_applies_each_stage_to_what_is_left(spark):
    docs, labels, items = (table(spark, MEDIUM, n) for n in ("documents", "labels", "benchmark"))
    model = toxicity.train(docs, labels)
    left = {d: t for d, t in docs.select("doc_id", "text").collect()}
    score, _ = toxicity.score_slice(model, pa.array(list(left.values()), pa.string()))
    left = {d: t for (d, t), s in zip(left.items(), score, strict=True) if s < toxicity.REJECT}
    roots = brute_components([(d, brute_fingerprint(t)) for d, t in left.items()])
    left = {d: t for d, t in left.items() if roots[d] == d}
    leaks = {r.doc_id for r in decontam.hits(docs, items).collect()}
    left = {d: t for d, t in left.items() if d not in leaks}
    packed = corpus_pipeline.run(spark, MEDIUM)
    assert packed.columns == packing.PACKED
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == left.keys()
    tokens_ = {r.doc_id: r.doc_tokens for r in packed.select("doc_id", "doc_tokens").distinct().collect()}
    clean = spark.createDataFrame(list(left.items()), "doc_id long, text string")
    alone = packing.pack(pii.redact(clean)).select("doc_id", "doc_tokens").distinct().collect()
    assert tokens_ == {r.doc_id: r.doc_tokens for r in alone}
