"""Chat formatting: every assistant turn becomes a training example of its own.

An example is the conversation up to and including one assistant turn, all earlier
turns being context; the loss covers that reply alone. Turns are marked

    <turn role="assistant">
    text</turn>

and inside roles and texts ``&``, ``<`` and ``"`` are written as ``&amp;``, ``&lt;`` and
``&quot;``, so no text can hold a marker, and reading back gives the text as it was.
Only SQL functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = '<turn role="', '">\n', "</turn>\n"


def escape(text: Column) -> Column:
    for plain, written in (("&", "&amp;"), ("<", "&lt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in (('"', "&quot;"), ("<", "&lt;"), ("&", "&amp;")):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def examples(conversations: DataFrame, trainable: str = "assistant") -> DataFrame:
    """(conv_id, example, text, loss_start, loss_end) from rows (conv_id, turn, role, text).

    ``example`` counts from 0. ``loss_start`` and ``loss_end`` are code points in ``text``,
    the end exclusive. Turns after the last reply, or a conversation without a reply,
    come in one more example that trains nothing (both offsets are its length), so
    that the output holds every turn. Null role or text is empty. Rows are ordered by turn
    (null first), then role, then text, so repeated rows and ties have one order. Rows
    without a conv_id are one conversation. Other columns are not read. One conversation
    is gathered in one row; its examples repeat its beginning, as the format asks.
    """
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("said"),
    )
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "said"))).alias("turns"))
    written = turns.select(
        "conv_id",
        F.transform(
            "turns",
            lambda t: F.struct(
                t.role.alias("role"),
                F.concat(F.lit(OPEN), escape(t.role), F.lit(MIDDLE)).alias("head"),
                F.concat(escape(t.said), F.lit(CLOSE)).alias("body"),
            ),
        ).alias("turns"),
    )
    ends = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: F.element_at("turns", i).role == trainable)
    last = F.size("turns")
    ends = F.when(F.array_contains(ends, last), ends).otherwise(F.concat(ends, F.array(last)))
    numbered = written.select("conv_id", "turns", F.posexplode(ends).alias("example", "end"))
    final = F.element_at("turns", F.col("end"))
    context = F.array_join(
        F.transform(F.slice("turns", F.lit(1), F.col("end") - 1), lambda t: F.concat(t.head, t.body)), ""
    )
    parts = numbered.select(
        "conv_id",
        F.col("example").cast("long").alias("example"),
        F.concat(context, final["head"]).alias("before"),
        final["body"].alias("body"),
        (final["role"] == trainable).alias("trains"),
    )
    whole = F.concat("before", "body")
    start = F.when(F.col("trains"), F.length("before")).otherwise(F.length(whole)).cast("long")
    end = (F.length(whole) - F.when(F.col("trains"), F.lit(len(CLOSE))).otherwise(F.lit(0))).cast("long")
    return parts.select("conv_id", "example", whole.alias("text"), start.alias("loss_start"), end.alias("loss_end"))


def turns_of(text: Column) -> Column:
    """The turns (role, said) of an example, read back from its text."""
    # The limit keeps the empty string after the last marker; it is no turn.
    pieces = F.split(text, CLOSE.replace("\n", "\\n"), -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    head = len(OPEN)
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substring(p, F.lit(head + 1), F.instr(p, MIDDLE) - head - 1)).alias("role"),
            unescape(F.substring(p, F.instr(p, MIDDLE) + len(MIDDLE), F.length(p))).alias("said"),
        ),
    )


def loss_text(text: Column, start: Column, end: Column) -> Column:
    """What is under the loss mask, as it was said."""
    return unescape(F.substring(text, (start + 1).cast("int"), (end - start).cast("int")))


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its examples.

    n_turns and turns_sha256 come from the longest (last) example, loss_chars and
    loss_sha256 from what each example trains, in order; formatted_chars counts all.
    """
    per_example = formatted.select(
        "conv_id",
        F.struct("example", "text").alias("entry"),
        F.struct("example", loss_text(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("said")).alias("loss"),
        F.length("text").cast("long").alias("chars"),
    )
    grouped = per_example.groupBy("conv_id").agg(
        F.max_by("entry", "entry.example").alias("last"),
        F.sort_array(F.collect_list("loss")).alias("losses"),
        F.sum("chars").alias("formatted_chars"),
    )
    read = grouped.select(
        "conv_id",
        turns_of(F.col("last.text")).alias("turns"),
        F.array_join(F.transform("losses", lambda x: x.said), "").alias("trained"),
        "formatted_chars",
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.said, F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2(F.col("trained"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
