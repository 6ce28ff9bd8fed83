"""URL filter by the likelihood ratio of two character models.

Two variable-order Markov models over characters are counted, one from accepted and
one from rejected URLs. A character's probability after a context of up to ORDER
characters is smoothed with that of the next shorter context (Witten-Bell), down to a
uniform one. A URL's score is the log-likelihood difference by character; the cut
between allow and block is calibrated on labelled URLs that no model has counted.
Only SQL functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmart.llm.base import stored

ORDER = 4
ALPHABET = 256
"""Characters that the uniform model at the bottom spreads over."""

CALIBRATION = 5
"""One in so many labelled URLs is kept from the models to calibrate the cut."""

SCORE_BINS = 400
SCORE_LIMIT = 4.0
"""Calibration looks at scores from -SCORE_LIMIT to SCORE_LIMIT in SCORE_BINS steps; those outside go to the ends."""

START = "\u0002"

# (verdict, host, path start) - fixed values of the task.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def _after_scheme(url: Column) -> Column:
    return F.substring(url, F.instr(url, "://") + 3, F.length(url))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(_after_scheme(url), r"\A[^/?#]*", 0), upper, lower)
    return F.when(F.contains(url, F.lit("://")), host).otherwise("")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    path = F.regexp_extract(_after_scheme(url), r"\A[^/?#]*([^?#]*)", 1)
    return F.when(F.contains(url, F.lit("://")), path).otherwise("")


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule (host and path) that fits as a struct (rule, verdict), else null."""
    fits = None
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        hit = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        fits = F.when(hit, value) if fits is None else fits.when(hit, value)
    return fits


def windows(urls: DataFrame, carried: str = "url_id") -> DataFrame:
    """(carried, gram) for every character: it and the ORDER characters before it."""
    padded = F.concat(F.lit(START * ORDER), F.col("url"))
    spots = F.sequence(F.lit(1), F.length("url"))
    grams = F.transform(spots, lambda i: F.substring(padded, i, F.lit(ORDER + 1)))
    return urls.where(F.length("url") > 0).select(carried, F.explode(grams).alias("gram"))


def model(labelled_grams: DataFrame) -> DataFrame:
    """The counts of both models: (gram, accepted, rejected) of every length up to ORDER + 1.

    Shorter grams are added up from the longest ones, which are counted first, so the
    table of all characters is shuffled once, already summed within each task.
    """
    counts = labelled_grams.groupBy("gram").agg(
        F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected")
    )
    shorter = F.array(*[F.expr(f"right(gram, {n})") for n in range(1, ORDER + 2)])
    tails = counts.select(F.explode(shorter).alias("gram"), "accepted", "rejected")
    return tails.groupBy("gram").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))


def gram_scores(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """(gram, ratio): log probability of the last character, accepted less rejected.

    ``grams`` are distinct. Context totals and numbers of different followers come from
    the same counts; each order is one join on the gram and one on its context.
    """
    counts = counts.withColumn("context", F.expr("left(gram, length(gram) - 1)"))
    sums = [
        e
        for m in ("accepted", "rejected")
        for e in (F.sum(m).alias(f"{m}_all"), F.count_if(F.col(m) > 0).alias(f"{m}_kinds"))
    ]
    contexts = counts.groupBy("context").agg(*sums)
    scored = grams.withColumns({f"{m}_p": F.lit(1.0 / ALPHABET) for m in ("accepted", "rejected")})
    joined = counts.select(F.col("gram").alias("_gram"), "accepted", "rejected")
    for n in range(1, ORDER + 2):
        scored = scored.withColumns({"_gram": F.expr(f"right(gram, {n})"), "context": F.expr(f"left(right(gram, {n}), {n - 1})")})
        scored = scored.join(joined, "_gram", "left").join(contexts, "context", "left").na.fill(0)
        smoothed = {
            f"{m}_p": F.when(
                F.col(f"{m}_all") > 0,
                (F.col(m) + F.col(f"{m}_kinds") * F.col(f"{m}_p")) / (F.col(f"{m}_all") + F.col(f"{m}_kinds")),
            ).otherwise(F.col(f"{m}_p"))
            for m in ("accepted", "rejected")
        }
        scored = scored.withColumns(smoothed).select("gram", "accepted_p", "rejected_p")
    # In millionths: sums of whole numbers do not depend on the order of tasks.
    micros = F.round((F.log("accepted_p") - F.log("rejected_p")) * 1e6).cast("long")
    return scored.select("gram", micros.alias("ratio"))


def cut(scores: DataFrame) -> DataFrame:
    """One row (cut): the score that best parts accepted from rejected labelled URLs.

    Best is the largest sum of the shares on the right side. Of the cuts between the
    same two bins that hold URLs the middle one is taken, of equal others the lowest.
    With no labelled URL of one kind all is allowed. Counts are per score bin.
    """
    width = 2 * SCORE_LIMIT / SCORE_BINS
    step = F.floor((F.greatest(F.lit(-SCORE_LIMIT), F.least(F.lit(SCORE_LIMIT), F.col("score"))) + SCORE_LIMIT) / width)
    bins = scores.groupBy(step.alias("bin")).agg(
        F.count_if("accepted").alias("good"), F.count_if(~F.col("accepted")).alias("bad")
    )
    # At most SCORE_BINS + 1 rows meet here, each with its bins below.
    listed = bins.agg(F.sort_array(F.collect_list(F.struct("bin", "good", "bad"))).alias("b"))
    all_good = F.aggregate("b", F.lit(0).cast("long"), lambda a, x: a + x.good)
    all_bad = F.aggregate("b", F.lit(0).cast("long"), lambda a, x: a + x.bad)
    listed = listed.withColumns({"all_good": all_good, "all_bad": all_bad})

    def gain(at: Column) -> Column:
        kept = F.aggregate("b", F.lit(0).cast("long"), lambda a, x: a + F.when(x.bin >= at, x.good).otherwise(0))
        dropped = F.aggregate("b", F.lit(0).cast("long"), lambda a, x: a + F.when(x.bin < at, x.bad).otherwise(0))
        return kept / F.col("all_good") + dropped / F.col("all_bad")

    best = F.array_max(F.transform("b", lambda x: F.struct(gain(x.bin).alias("gain"), (-x.bin).alias("bin"))))
    at = -best["bin"]
    below = F.array_max(F.filter(F.transform("b", lambda x: x.bin), lambda bin_: bin_ < at)) + 1
    middle = (at + F.coalesce(below, at)) / 2 * width - SCORE_LIMIT
    found = F.when((F.col("all_good") > 0) & (F.col("all_bad") > 0), middle)
    return listed.select(F.coalesce(found, F.lit(float("-inf"))).alias("cut"))


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] = RULES,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, cut) of every page.

    URLs that a rule decides are the labels: allowed ones are accepted, blocked ones
    rejected. Every URL they name is counted once, whatever its number of pages. The
    models read the URL after its scheme. A null URL or one without ``://`` has empty
    host and path and score 0. Repeated rows give one row each; other columns are not
    read; an empty table gives no rows. Models are tables that grow with the URLs:
    nothing of them is collected or broadcast by hint.
    """
    rows = pages.select(
        pages[page_id].alias("page_id"), F.coalesce(pages[url], F.lit("")).alias("full")
    ).select("page_id", "full", host_of(F.col("full")).alias("host"), path_of(F.col("full")).alias("path"))
    rows = rows.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    once = rows.groupBy("full").agg(F.first("fit").alias("fit"))
    once = once.select(
        F.xxhash64("full").alias("url_id"),
        F.when(F.contains("full", F.lit("://")), _after_scheme(F.col("full"))).otherwise(F.col("full")).alias("url"),
        (F.col("fit.verdict") == "allow").alias("accepted"),
        "full",
    )
    once = stored(once, "urls")
    used = F.pmod("url_id", F.lit(CALIBRATION)) != 0
    grams = stored(windows(once).groupBy("url_id", "gram").agg(F.count("*").alias("times")), "grams")
    labelled = windows(once.where(F.col("accepted").isNotNull() & used), "accepted")
    counts = stored(model(labelled), "model")
    ratios = gram_scores(grams.select("gram").distinct(), counts)
    summed = grams.join(ratios, "gram").groupBy("url_id").agg(
        (F.sum(F.col("ratio") * F.col("times")) / F.sum("times") / 1e6).alias("score")
    )
    scored = once.join(summed, "url_id", "left").select("full", "accepted", "url_id", F.coalesce("score", F.lit(0.0)).alias("score"))
    scored = stored(scored, "scores")
    found = cut(scored.where(F.col("accepted").isNotNull() & ~used))
    judged = rows.join(scored.select("full", "score"), "full").crossJoin(F.broadcast(found))  # one row
    method = F.when(F.col("score") >= F.col("cut"), "allow").otherwise("block")
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", method).alias("verdict"),
        "score",
        "cut",
    )
