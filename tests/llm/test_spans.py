"""Personal data and URLs against plain Python."""

from __future__ import annotations

import hashlib
import random
import re

from conftest import SF_DIR
from pyspark.sql import functions as F

from wardmart.llm import pii, urls
from wardmart.llm.base import table

# Fixed values of the task.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute_spans(text: str | None) -> list[str]:
    found = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


def test_base_spans_equal_plain_search(spark, odd_docs):
    rng = random.Random(1)
    noise = ["".join(rng.choice("12 -+().@ab4\n") for _ in range(80)) for _ in range(300)]
    odd = ["a@b.c@d.e", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8.9", "256.1.1.1 0001.2.3.255", "é@b.c 😀 4111111111111111",
           "4222222222222-4111111111111111 2", "4111--1111", "++12345678+12345678", "1" * 5000, None, ""]
    docs = spark.createDataFrame(list(enumerate(noise + odd)), "doc_id long, text string")
    for frame in (docs, odd_docs.where("doc_id is not null and doc_id <> 3"), table(spark, SF_DIR, "documents")):
        texts = dict(frame.select("doc_id", "text").collect())
        rows = pii.find(frame).collect()
        assert len(rows) == frame.count()
        for row in rows:
            spans = brute_spans(texts[row.doc_id])
            assert row.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
            assert [row[f"n_{k}"] for k in BASE] == [sum(s.startswith(k) for s in spans) for k in BASE]
            assert set(spans) <= set(row.spans.split(",")) | {""}


def test_contexts_find_more_and_noise_does_not(spark):
    seen = [(i, f"hello word{i} write to agent alice{i}@mail.example.com now") for i in range(20)]
    new = [(100 + i, f"hello other{i} write to agent bob{i}@intranet now please") for i in range(5)]
    plain = [(200 + i, f"the part number{i} is x{i}@y of many") for i in range(5)]
    docs = spark.createDataFrame(seen + new + plain, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    assert all(found[100 + i] == "email:28:41" for i in range(5))
    assert all(found[200 + i] == "" for i in range(5))
    redacted = dict(pii.redact(docs).collect())
    assert redacted[101] == "hello other1 write to agent [EMAIL] now please"


def test_redaction_keeps_everything_else(spark, odd_docs, no_docs):
    out = pii.redact(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    texts = {r.doc_id: r.text for r in out.where("doc_id in (0, 8)").collect()}
    assert texts == {0: None, 8: "mail [EMAIL] or [PHONE], [IP], [CARD]"}
    assert pii.redact(no_docs).count() == pii.find(no_docs).count() == 0


def brute_rule(host: str, path: str) -> str | None:
    fits = [
        (len(h + p), h + p)
        for _, h, p in urls.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1] if fits else None


def test_hosts_paths_and_rules(spark):
    odd = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/1?x#y", "a://b://c/d", "http://x.com?q=/fr/",
           "https://myexample.org/es/", "http://com/de/#x", "http://É.com/fr/é", "http://a.example.org/en/1\n2"]
    pages = spark.createDataFrame(list(enumerate(odd)), "page_id long, url string")
    pages = pages.union(table(spark, SF_DIR, "pages").selectExpr("page_id + 1000", "url")).withColumn("score", F.lit(0))
    raw = {r.page_id: r.url or "" for r in pages.collect()}
    rows = urls.judge(pages).collect()
    assert len(rows) == len(raw)
    verdicts = {h + p: v for v, h, p in urls.RULES}
    for row in rows:
        _, there, rest = raw[row.page_id].partition("://")
        host = re.match(r"[^/?#]*", rest)[0] if there else ""
        path = re.match(r"[^?#]*", rest[len(host):])[0] if there else ""
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        assert (row.host, row.path, row.rule) == (host, path, brute_rule(host, path))
        assert row.verdict == verdicts.get(row.rule, "allow" if row.score >= row.cut else "block")


def test_models_tell_accepted_from_rejected(spark):
    urls_ = [f"http://{'abcdefgh'[i % 8]}{i}.example.com/{'fr' if i % 2 else 'de'}/{i}" for i in range(400)]
    urls_ += [f"http://z{i}.example.net/{'fr' if i % 2 else 'de'}/{i}" for i in range(60)]
    pages = spark.createDataFrame(list(enumerate(urls_)), "page_id long, url string")
    rows = urls.judge(pages).where("rule is null").collect()
    assert sum((r.verdict == "allow") == ("/fr/" in r.path) for r in rows) >= 0.95 * len(rows) == 57
    assert urls.judge(pages.limit(0)).count() == 0
