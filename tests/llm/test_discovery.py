"""Identifiers in groups of digits, and chains of contexts."""

from __future__ import annotations

from wardmart.llm import pii


def test_grouped_numbers_are_found_whole(spark):
    seen = [(i, f"note {'abcdefghij'[i % 10]} please call me at +1 (555) 210-{1000 + i} today") for i in range(30)]
    forms = ["(415) 555-1234", "555 123 4567", "415 (555) 1234", "4111 1111 1111 1112", "555-1234", "(555)1234567"]
    new = [(100 + i, f"note please call me at {form} today") for i, form in enumerate(forms)]
    # A valid IP address beside a run is a base span of its own.
    new += [(200, "note 10.0.0.1 555 123 4568 end"), (201, "call me on 12 34 today"), (202, "the years 2001 2002 2003 were")]
    docs = spark.createDataFrame(seen + new, "doc_id long, text string")
    redacted = dict(pii.redact(docs).collect())
    assert [redacted[100 + i] for i in range(len(forms))] == ["note please call me at [PHONE] today"] * len(forms)
    assert [redacted[i] for i in (200, 201, 202)] == ["note [IP] 555 123 4568 end", new[-2][1], new[-1][1]]
    texts = spark.createDataFrame([(new[6][1],)], "text string")
    runs = texts.select(pii._strings(texts.text, pii.base_spans(texts.text))).first()[0]
    assert [(r.start, r.end, r.value) for r in runs if r.end - r.start > 8] == [(14, 26, "555 123 4568")]


def test_rounds_go_on_until_nothing_is_added(spark):
    groups = [[f"s{i}@mail.example.com" for i in range(500)]]
    groups += [[f"{'abcd'[k]}{i}@intranet" for i in range(n)] for k, n in enumerate((170, 45, 11, 2))]
    texts = [
        f"{a}left {a}last {value} {a}right"
        for a, first, second in zip("wxyz", groups[:-1], groups[1:], strict=True)
        for value in first + second
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = [r.text for r in pii.redact(docs).orderBy("doc_id").collect()]
    assert out == [f"{t.split()[0]} {t.split()[1]} [EMAIL] {t.split()[3]}" for t in texts]
