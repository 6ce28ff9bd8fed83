"""A Merkle manifest of a document table, with every leaf's place found by bitmap ranks.

Per source, the ids that occur are a compressed bitmap: only 64-bit words with a bit
set are kept, merged by bitwise or, each with the number of rows before it (a rank
directory of four levels, so that no level numbers more than 65,536 entries at once).
A document's leaf coordinate is the directory entry of its word plus the bits below
its own: the documents themselves are never sorted. From there on nodes meet under
(source, coordinate / 16), each in its slot; a run's slots become one node of the next
level until a source has one node left, and the sources' nodes become the root the
same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmart.functions.keys import dense_key
from wardmart.llm.base import stored
from wardmart.session import table_root
from wardmart.sources.store import TableStore

c = F.col

FANOUT = 16
_BITS = 6
_LEVEL = 16
_DIGEST = 32
_COPIES = 65_536
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(data: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(data, 256))


def parent(slots: Column) -> Column:
    """The node above a run: the digest over its digests written as lowercase hex."""
    return digest(F.lower(F.hex(slots)))


def leaf_of(fields: dict[str, Column]) -> Column:
    """Digest over all fields: `-` for null, else byte count, colon and value."""
    parts = []
    for name in FIELDS:
        value = fields[name].cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return digest(F.concat(*parts))


def is_tampered(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(g, id, word, bit, leaf, tampered): one row per document.

    ``g`` is the source as a string that sorts null first. A null id has a word of its
    own before all others. ``tampered`` is null where the leaf stays as it is.
    """
    fields = {name: docs[name] for name in FIELDS}
    lowered = fields | {"text": F.translate(docs["text"], _UPPER, _LOWER)}
    rows = docs.select(
        F.coalesce(F.concat(F.lit("s"), fields["source"].cast("string")), F.lit("")).alias("g"),
        fields["doc_id"].cast("long").alias("id"),
        leaf_of(fields).alias("leaf"),
        F.when(is_tampered(fields["doc_id"]), leaf_of(lowered)).alias("tampered"),
    )
    before_all = F.lit(-(1 << 57) - 1)
    return rows.withColumns(
        {
            "word": F.coalesce(F.shiftright("id", _BITS), before_all),
            "bit": F.coalesce(c("id").bitwiseAND(F.lit((1 << _BITS) - 1)), F.lit(0)).cast("int"),
        }
    )


def bitmap(rows: DataFrame) -> DataFrame:
    """(g, word, bits, n): the words with a bit set, and the rows in each."""
    one = F.expr("shiftleft(1L, bit)")
    return rows.groupBy("g", "word").agg(F.bit_or(one).alias("bits"), F.count("*").alias("n"))


def with_ranks(words: DataFrame) -> DataFrame:
    """``before``: the rows of the same source in earlier words.

    Each directory level sums at most 65,536 entries of the level below and is
    numbered within its own parent, so no source is ever in one task.
    """
    levels = [words]
    for level in (1, 2, 3):
        key = F.shiftright("word", _LEVEL * level)
        rows = words.select("g", key.alias("word"), "n")
        levels.append(rows.groupBy("g", "word").agg(F.sum("n").alias("n")))
    above = None
    for level, entries in reversed(list(enumerate(levels))):
        inside = ["g"] if above is None else ["g", "up"]
        entries = entries.withColumn("up", F.shiftright("word", _LEVEL))
        earlier = Window.partitionBy(*inside).orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
        entries = entries.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        if above is not None:
            base = above.select("g", c("word").alias("up"), c("before").alias("base"))
            entries = entries.join(base, ["g", "up"]).withColumn("before", c("before") + c("base")).drop("base")
        above = entries.drop("up")
    return above


def coordinates(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(g, pos, n, id, leaf, tampered) of all leaves, and (g, n) of all sources.

    ``rows`` and what comes of the bitmap are stored: a source or word that holds many
    rows is then a skewed join of two files, which adaptive execution splits. Rows
    that share an id are ordered by leaf; equal ones are counted and dealt out again.
    """
    words = stored(with_ranks(stored(bitmap(rows), "bitmap")), "ranks")
    sizes = stored(words.groupBy("g").agg(F.sum("n").alias("size")), "sources")
    single = c("n") == F.bit_count("bits")
    below = F.expr("bit_count(bits & ~shiftleft(-1L, bit))")
    ranked = rows.join(words.where(single), ["g", "word"]).withColumn("pos", c("before") + below)
    ranked = ranked.select("g", "pos", "id", "leaf", "tampered")
    shared = stored(words.where(~single).select("g", "word", "before"), "shared_ids")
    if not shared.isEmpty():
        ranked = ranked.union(_shared(rows, shared))
    return ranked, sizes


def _shared(rows: DataFrame, words: DataFrame) -> DataFrame:
    """Coordinates of the rows in words where an id occurs more than once.

    Equal rows shrink to a count before the shuffle. Ids are ordered within their
    word (64 at most) and leaves within an id by their first two bytes (65,536 at
    most) and then among those that share them.
    """
    mine = rows.join(words.select("g", "word"), ["g", "word"], "left_semi")
    leaf = ["g", "word", "bit", "head", "leaf"]
    counted = (
        mine.withColumn("head", F.substring("leaf", 1, 2))
        .groupBy(*leaf, "id")
        .agg(F.count("*").alias("n"), F.first("tampered").alias("tampered"))
    )
    counted = stored(counted, "shared_rows")
    tables = [counted]
    for depth in (4, 3):
        tables.append(tables[-1].groupBy(*leaf[:depth]).agg(F.sum("n").alias("n")))
    above = words
    for depth, entries in zip((2, 3, 4), reversed(tables), strict=True):
        earlier = Window.partitionBy(*leaf[:depth]).orderBy(leaf[depth]).rowsBetween(Window.unboundedPreceding, -1)
        entries = entries.withColumn("inside", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        entries = entries.join(above.select(*leaf[:depth], "before"), leaf[:depth])
        above = entries.withColumn("before", c("before") + c("inside")).drop("inside")
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), c("n") - 1, F.lit(_COPIES).cast("long")))
    copies = F.sequence(c("chunk"), F.least(c("n") - 1, c("chunk") + (_COPIES - 1)))
    dealt = above.withColumn("chunk", chunks).withColumn("copy", F.explode(copies))
    return dealt.select("g", (c("before") + c("copy")).alias("pos"), "id", "leaf", "tampered")


class Tree:
    """Runs of every level, and the node that remains of every group.

    ``runs[k]``: (g, run, n, slots): the digests of a run one after the other, and how
    many nodes its group has at this level. ``tops``: (g, node). ``runs[0]`` also has
    ``members``, what came with the leaves, in slot order.
    """

    def __init__(self, nodes: DataFrame, largest: int, members: list[str]):
        """``nodes``: (g, pos, n, node, *members); ``largest``: the most nodes of a group."""
        self.runs: list[DataFrame] = []
        self.lone = nodes.where("n = 1")
        done = [self.lone]
        carried = [F.array_sort(F.collect_list(F.struct("pos", *members))).alias("members")] if members else []
        while largest > 1:
            slots = F.expr("listagg(node) within group (order by pos)").alias("slots")
            runs = nodes.where("n > 1").groupBy("g", F.shiftright("pos", 4).alias("run"), "n").agg(slots, *carried)
            self.runs.append(stored(runs, "runs"))
            above = F.shiftright(c("n") + (FANOUT - 1), 4)
            nodes = self.runs[-1].select("g", c("run").alias("pos"), above.alias("n"), parent(c("slots")).alias("node"))
            done.append(nodes.where("n = 1"))
            largest, carried = -(-largest // FANOUT), []
        self.tops = done[0].select("g", "node")
        for rest in done[1:]:
            self.tops = self.tops.union(rest.select("g", "node"))

    def paths(self, above: DataFrame) -> DataFrame | None:
        """``runs[0]`` with the path from each run to the root, bottom up.

        ``above``: (g, path, *more) for every group: what lies above its last node. A
        path is an array of (slot, slots). It is handed down level by level, so a
        node's path is joined once for its run and not once for each document.
        """
        lower = None
        more = [name for name in above.columns if name != "g"]
        for runs in reversed(self.runs):
            last = runs.where(f"n <= {FANOUT}").join(above, "g")
            if lower is None:
                lower = last
                continue
            upper = lower.select(
                "g", c("run").alias("_up"), F.struct(F.lit(0).alias("slot"), "slots").alias("_run"), *more
            )
            inner = runs.where(f"n > {FANOUT}").withColumn("_up", F.shiftright("run", 4)).join(upper, ["g", "_up"])
            slot = c("run").bitwiseAND(F.lit(FANOUT - 1)).cast("int")
            step = F.struct(slot.alias("slot"), c("_run.slots").alias("slots"))
            inner = inner.withColumn("path", F.concat(F.array(step), "path")).drop("_run", "_up")
            lower = last.unionByName(inner.select(*last.columns))
        return lower


def left_of(slot: Column, slots: Column) -> Column:
    return F.substring(slots, F.lit(1), slot * _DIGEST)


def right_of(slot: Column, slots: Column) -> Column:
    return F.substring(slots, slot * _DIGEST + (_DIGEST + 1), F.length(slots))


def siblings(step: Column) -> Column:
    return F.concat(left_of(step["slot"], step["slots"]), right_of(step["slot"], step["slots"]))


def folded(path: Column, node: Column) -> Column:
    """The root that follows from a node and the original siblings on its path."""

    def up(below: Column, step: Column) -> Column:
        return parent(F.concat(left_of(step["slot"], step["slots"]), below, right_of(step["slot"], step["slots"])))

    return F.aggregate(path, node, up)


def _text(node: Column, name: str) -> Column:
    return F.lower(F.hex(node)).alias(name)


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one row per document.

    Sources come in UTF-8 byte order with null first, documents by id with null first;
    rows with the same id are ordered by leaf, and equal rows are leaves of their own.
    A table of one document has its leaf as root, and the proof of a node without any
    sibling is the digest of nothing. An empty table gives no rows. Nulls in any column
    count as such; other columns than the five are not read. Rows move three times, as
    digests of 32 bytes; texts never do.
    """
    spark = docs.sparkSession
    rows = stored(leaves(docs), "leaves")
    placed, sizes = coordinates(rows)
    largest, sources = sizes.agg(F.coalesce(F.max("size"), F.lit(0)), F.count("*")).first()
    nodes = placed.join(sizes, "g").select("g", "pos", c("size").alias("n"), c("leaf").alias("node"), "id", "tampered")
    tree = Tree(nodes, largest, ["id", "tampered"])

    store = TableStore(spark, table_root(spark))
    tops = dense_key(store, "subroots", tree.tops.select("g", c("node").alias("subroot")), ["g"], "nth")
    tops = stored(tops, "subroots")
    nodes = tops.select(
        F.lit("").alias("g"), (c("nth") - 1).alias("pos"), F.lit(sources).cast("long").alias("n"),
        c("subroot").alias("node"), c("g").alias("id"),
    )
    upper = Tree(nodes, sources, ["id"])
    nothing = F.expr("cast(array() as array<struct<slot:int,slots:binary>>)")
    root = upper.tops.select("g", nothing.alias("path"), c("node").alias("root"))
    if upper.runs:
        runs = upper.paths(root).withColumn("member", F.explode("members"))
        above = runs.select(c("member.id").alias("g"), _own_path(c("member.pos")).alias("path"), "root")
    else:
        above = upper.lone.join(root, "g").select(c("id").alias("g"), "path", "root")
    above = stored(above.join(tops.select("g", "subroot"), "g"), "above")

    alone = tree.lone.join(above, "g").select("id", c("node").alias("leaf"), "tampered", "path", "subroot", "root")
    result = alone
    if tree.runs:
        upper_part = F.aggregate(c("path"), F.lit(b""), lambda done, step: F.concat(done, siblings(step)))
        runs = tree.paths(above).withColumn("rest", upper_part).withColumn("member", F.explode("members"))
        slot = c("member.pos").bitwiseAND(F.lit(FANOUT - 1)).cast("int")
        member = F.substring(c("slots"), slot * _DIGEST + 1, F.lit(_DIGEST))
        inside = runs.select(
            c("member.id").alias("id"), member.alias("leaf"), c("member.tampered").alias("tampered"),
            _own_path(c("member.pos")).alias("path"), "subroot", "root",
        )
        result = alone.union(inside)
    proof = F.aggregate(c("path"), F.lit(b""), lambda done, step: F.concat(done, siblings(step)))
    result = result.withColumn("_folded", folded(c("path"), F.coalesce("tampered", "leaf")))
    return result.select(
        c("id").alias("doc_id"),
        _text(c("leaf"), "leaf"),
        _text(c("subroot"), "subroot"),
        _text(c("root"), "root"),
        F.sha2(F.lower(F.hex(proof)), 256).alias("proof_sha256"),
        _text(c("_folded"), "folded_root"),
        (c("_folded") == c("root")).alias("verified"),
    )


def _own_path(pos: Column) -> Column:
    """The path of a member of a run whose own run's path is at hand."""
    slot = pos.bitwiseAND(F.lit(FANOUT - 1)).cast("int")
    return F.concat(F.array(F.struct(slot.alias("slot"), c("slots").alias("slots"))), c("path"))
