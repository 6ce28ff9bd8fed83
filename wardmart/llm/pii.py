"""Personal data: base patterns, and more of the same found by their contexts.

Base spans (emails, IP addresses, card and phone numbers) are seeds. The words around
them induce lexical patterns. Patterns and identifier-like strings form a graph, which
is scored in rounds: a pattern by the share of known identifiers among all strings it
holds, a string by the patterns that hold it. Strings with a high score become known
and score patterns in the next round, until a round changes nothing. Only SQL functions are
used.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmart.llm.base import stored

KINDS = ("email", "ip", "card", "phone")
PATTERN_SUPPORT = 3
PATTERN_CONFIDENCE = 0.7
INSTANCE_CONFIDENCE = 0.85
SCORE_DIGITS = 3
"""Decimals of the scores that a round hands on: they only rise, so the rounds come to an end."""

CONTEXT = 64
"""Characters on either side of a string that its context words are taken from."""

# Each base pattern, written so that it looks at a run of its characters once: it starts
# at the beginning of a run or where the last match ended, and never gives back.
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"

# Strings that may be identifiers: word characters with a digit or an at sign.
TOKEN = r"(?<![A-Za-z0-9@_.+-])(?=[A-Za-z_.+-]*+[0-9@])[A-Za-z0-9@_.+-]++"
# Groups of digits joined by one space, hyphen or dot, or by brackets. A valid IP address is not part of a run.
OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|(?<=0))(?![0-9])"
GROUP = rf"(?!{OCTET}(?:\.{OCTET}){{3}})[0-9]++(?![A-Za-z_@])"
JOINT = r"(?:\)[ .-]?\(?|[ .-]\(?|\()"
RUN = rf"(?:\+?\((?=[0-9]++\))|(?<![A-Za-z0-9@_+])(?<![A-Za-z0-9@_][.-])\+?){GROUP}(?:{JOINT}{GROUP})++"
LEAST_DIGITS = 6

SPAN = "struct<kind:string,start:bigint,end:bigint,value:string>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)

    def worth(i: Column) -> Column:
        d = F.substring(turned, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + worth(i)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(OCTETS)
    if kind == "card":
        return _luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def spans(text: Column, kind: str | None, pattern: str) -> Column:
    """Array of (kind, start, end, value) of the matches, in code points."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("bigint"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{SPAN}>").alias("found"))

    def step(acc: Column, hit: Column) -> Column:
        begin = acc["at"] + hit["gap"]
        end = begin + F.length(hit["value"])
        span = F.struct(F.lit(kind).cast("string").alias("kind"), begin.alias("start"), end.alias("end"), hit["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(span)).alias("found"))

    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
    return F.aggregate(pairs, start, step, lambda acc: acc["found"])


def base_spans(text: Column) -> Column:
    """All base spans, by kind as listed and then by start."""
    return F.concat(*[_base_spans_of(kind, text) for kind in KINDS])


def _base_spans_of(kind: str, text: Column) -> Column:
    found = F.filter(spans(text, kind, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))
    return F.when(text.rlike(NEEDS[kind]), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def _strings(text: Column, base: Column) -> Column:
    """Identifier-like strings that no base span touches; their kind is null.

    They are single words, and runs of digit groups that reach beyond one such word. A
    word inside a run is a string as well.
    """

    def apart(found: Column) -> Column:
        return F.filter(
            found,
            lambda s: (F.contains(s["value"], F.lit("@")) | (F.length(_digits(s["value"])) >= LEAST_DIGITS))
            & ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
        )

    none = F.array().cast(f"array<{SPAN}>")
    runs = F.filter(spans(text, None, RUN), lambda s: s["value"].rlike("[ ()]"))
    return F.concat(
        F.when(text.rlike("[0-9@]"), apart(spans(text, None, TOKEN))).otherwise(none),
        F.when(text.rlike(rf"[0-9]{JOINT}[0-9]"), apart(runs)).otherwise(none),
    )


def _placed(text: Column, span: Column) -> Column:
    """A span with its contexts: the two words before, and the words on either side."""
    begin = F.greatest(span["start"] - CONTEXT, F.lit(0))
    before = F.substring(text, (begin + 1).cast("int"), (span["start"] - begin).cast("int"))
    after = F.substring(text, (span["end"] + 1).cast("int"), F.lit(CONTEXT))
    squeeze = lambda s: F.regexp_replace(F.regexp_replace(F.lower(s), "[0-9]", "0"), r"\s+", " ")
    left = F.split(F.rtrim(squeeze(before)), " ")
    right = F.element_at(F.split(F.trim(squeeze(after)), " "), 1)
    last = F.element_at(left, -1)
    two = F.when(F.size(left) > 1, F.concat_ws(" ", F.element_at(left, -2), last))
    return F.struct(
        span["kind"].alias("kind"),
        span["start"].alias("start"),
        span["end"].alias("end"),
        F.lower(span["value"]).alias("value"),
        F.filter(
            F.array(F.concat(two, F.lit(" _")), F.concat(last, F.lit(" _ "), right)), lambda p: p.isNotNull()
        ).alias("contexts"),
    )


def row_key(doc_id: Column, text: Column) -> Column:
    """The same for rows with equal id and text, which have equal spans."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(text))


def marks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, doc_id, base, strings) of every text; strings have their contexts too."""
    rows = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    rows = rows.withColumn("base", base_spans(F.col("text")))
    rows = rows.withColumn("rest", _strings(F.col("text"), F.col("base")))
    return rows.select(
        row_key(F.col("doc_id"), F.col("text")).alias("key"),
        "doc_id",
        F.transform("base", lambda s: s.dropFields("value")).alias("base"),
        F.transform(F.concat("base", "rest"), lambda s: _placed(F.col("text"), s)).alias("strings"),
    )


def _suits(kind: Column, value: Column) -> Column:
    return F.when(kind == "email", F.contains(value, F.lit("@"))).otherwise(F.length(_digits(value)) >= LEAST_DIGITS)


def discovered(strings: DataFrame, rounds: int | None = None) -> DataFrame:
    """(value, kind, score) of strings that patterns have made known, beyond the seeds.

    ``strings`` has rows (kind, value, contexts), kind null where no base pattern
    matched. Copies of an occurrence count once: a pattern's support is in different
    strings. Every sum is combined before its shuffle. A string that is known keeps its
    kind, so known strings and scores only grow, and rounds go on (up to ``rounds``, if
    given) until one changes neither.
    """
    edges = strings.select("value", "kind", F.explode("contexts").alias("pattern")).distinct()
    edges = stored(edges, "edges")
    seeds = strings.where("kind is not null").select("value", "kind").distinct().withColumn("score", F.lit(1.0))
    seeds = stored(seeds, "known")
    known, new, state = seeds, seeds.limit(0), (0, None)
    holds = stored(edges.groupBy("pattern").agg(F.countDistinct("value").alias("holds")), "holds")
    for _ in itertools.count() if rounds is None else range(rounds):
        supported = (
            edges.select("pattern", "value").distinct().join(known, "value")
            .groupBy("pattern", "kind")
            .agg(F.round(F.sum("score"), 6).alias("support"))
            .where(F.col("support") >= PATTERN_SUPPORT)
        )
        patterns = (
            supported.join(holds, "pattern")
            .withColumn("confidence", F.col("support") / (F.col("holds") + 1))
            .where(F.col("confidence") >= PATTERN_CONFIDENCE)
            .select("pattern", F.col("kind").alias("found"), "confidence")
        )
        doubt = F.exp(F.round(F.sum(F.log(1 - F.col("confidence"))), 6))
        sure = (
            edges.where("kind is null").join(patterns, "pattern")
            .where(_suits(F.col("found"), F.col("value")))
            .groupBy("value", F.col("found").alias("kind"))
            .agg((1 - doubt).alias("score"))
            .where(F.col("score") >= INSTANCE_CONFIDENCE)
            .withColumn("score", F.round("score", SCORE_DIGITS))
        )
        # One kind for each string: the one it has, else the surest, then the first by name.
        sure = sure.join(new.select("value", F.col("kind").alias("has")), "value", "left")
        order = F.struct(F.coalesce(F.col("has") == F.col("kind"), F.lit(False)), "score", "kind")
        sure = sure.groupBy("value").agg(F.max_by(F.struct("kind", "score"), order).alias("best"))
        new = stored(sure.select("value", "best.kind", "best.score"), "new")
        known = seeds.union(new.join(seeds.select("value"), "value", "left_anti"))
        before, state = state, tuple(new.agg(F.count("*"), F.sum(F.round(F.col("score") * 10**SCORE_DIGITS).cast("long"))).first())
        if state == before:
            break
    return new


def found_spans(marked: DataFrame, rounds: int | None = None) -> DataFrame:
    """(key, more): for texts with discovered identifiers, their spans."""
    occurrences = marked.select("key", F.explode("strings").alias("s")).select("key", "s.*")
    known = discovered(occurrences, rounds)
    hits = occurrences.where("kind is null").drop("kind").join(known, "value")
    return hits.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("kind", "start", "end"))).alias("more"))


def _in_order(spans_: Column) -> Column:
    """By kind as listed, then start."""
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    ranked = F.transform(
        spans_, lambda s: F.struct(rank[s["kind"]].alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    )
    return F.array_sort(ranked)


def _joined(spans_: Column) -> Column:
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every whole text.

    Base spans are leftmost and do not overlap within a kind; discovered ones are added
    to them in ``spans``. A null or empty text has none. Repeated rows and rows without
    an id give one row each; other columns are not read; an empty table gives no rows.
    Texts are never shuffled: a table of spans and strings is written, and all rounds
    run on it.
    """
    marked = stored(marks(docs, doc_id, text), "marks")
    more = stored(found_spans(marked, rounds), "more")
    rows = marked.select("key", "doc_id", "base").join(more, "key", "left")
    every = F.concat("base", F.coalesce("more", F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(_in_order(every)).alias("spans"),
    )


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int | None = None) -> DataFrame:
    """The same rows with every span of the text replaced by its kind, like ``[EMAIL]``.

    Spans that overlap become one, named after the first. Null texts stay null. The
    other columns stay as they are: all travel inside one struct, so no name of theirs
    can clash. Texts meet the discovered spans only, which Spark broadcasts if their
    written table is small.
    """
    more = stored(found_spans(stored(marks(docs, doc_id, text), "marks"), rounds), "more")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    key = row_key(docs[doc_id], F.coalesce(docs[text], F.lit(""))).alias("key")
    rows = docs.select(whole, key).join(more.select("key", "more"), "key", "left")
    said = F.col("row")[text]
    plain = "array<struct<kind:string,start:bigint,end:bigint>>"
    base = F.transform(base_spans(F.coalesce(said, F.lit(""))), lambda s: s.dropFields("value"))
    every = F.array_sort(
        F.transform(
            F.concat(base, F.coalesce("more", F.array().cast(plain))),
            lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
        )
    )
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))
    piece = lambda a, b: F.substring(said, (a + 1).cast("int"), (b - a).cast("int"))

    def step(acc: Column, s: Column) -> Column:
        apart = s["start"] >= acc["at"]
        name = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        out = F.when(apart, F.concat(acc["out"], F.array(piece(acc["at"], s["start"]), name))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    rest = F.length(said).cast("bigint")
    rows = rows.withColumn("spans", every)
    new = F.aggregate("spans", start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), piece(acc["at"], rest)))
    changed = F.when(F.size("spans") > 0, new).otherwise(said)
    columns = [(changed if c == text else F.col("row")[c]).alias(c) for c in docs.columns]
    return rows.select(*columns)
