"""Prefix trie of sequences, built by cutting it at half depth again and again.

A trie of depth 2^k is an upper trie of depth 2^(k-1) and, under each of its deepest nodes,
lower ones of the same depth. So every sequence is cut in the middle; equal first halves
under the same root get one name, the smallest id among them; the named first halves, each
once and with the number of sequences it stands for, go on as the upper trie, and the second
halves as a forest under the names. All pieces of a size are cut in one pass, whether upper
or lower, so a trie of depth d takes log2(d) passes, and what is shared by many sequences is
a single row from the first cut below it. When pieces are one long, they are the nodes.

Halves are compared by digests, made from the turns' digests by halving positions. Sums over
subtrees go the other way: the sums of a piece are those of its upper half and of the lower
ones grafted on it, from the smallest pieces to the largest; then every cut takes over what
lies below its piece, from the largest to the smallest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendfall.llm.numbering import numbered
from spendfall.llm.store import small_batches, stored

#: Ids that are joined to one piece of text before a digest runs over them.
ENDS = 4096


def turn_rows(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, pos, key, chars, total): every turn's place in its conversation, digest and code points.

    Turns are ordered by ``turn``, null first; equal ones by role, then by the turn's digest.
    A null role or text is empty. Repeated rows are turns of their own. Rows without a
    conversation belong to none and are left out. Conversations may be of any length.
    """
    who, what = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, what), 256))
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), who.alias("role"), key.alias("key"), F.length(what).cast("long").alias("chars")
    )
    placed = numbered(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("key")])
    return placed.select("conv_id", F.col("idx").alias("pos"), "key", "chars", "total")


def _digests(turns: DataFrame, rounds: int) -> list[DataFrame]:
    """(conv_id, at, key) of the stretches of 1, 2, 4, ... turns that start at multiples of their length."""
    out = [turns.select("conv_id", F.col("pos").alias("at"), "key")]
    for _ in range(1, rounds):
        even = F.col("at") % 2 == 0
        halves = out[-1].groupBy("conv_id", F.floor(F.col("at") / 2).alias("to")).agg(F.max(F.when(even, F.col("key"))).alias("left"), F.max(F.when(~even, F.col("key"))).alias("right"))
        whole = halves.where("right is not null").select("conv_id", F.col("to").alias("at"), F.unhex(F.sha2(F.concat("left", "right"), 256)).alias("key"))
        out.append(stored(whole, "trie-digests"))
    return out


def prefix_trie(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie's nodes and the node at which every conversation ends.

    ``turns`` are (conv_id, pos, key, chars), positions from 0 without gaps; ``convs`` are
    (conv_id, len), one row for each conversation, also those without turns. Nodes are
    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens): a node goes
    by its smallest member and its depth, the root has no parent. ``n_leaves`` and
    ``saved_tokens`` are sums over the subtree, its top included; what a node saves is its
    turn's code points for all members but one. Ends are (conv_id, depth, node). No
    conversations make no nodes. Other columns are not looked at.
    """
    convs = stored(convs.select("conv_id", F.col("len").cast("long").alias("len")), "trie-convs")
    turns = stored(turns.select("conv_id", "pos", "key", "chars"), "trie-turns")
    first, n_convs, longest = convs.agg(F.min("conv_id"), F.count("*"), F.coalesce(F.max("len"), F.lit(0))).first()
    rounds = int(longest).bit_length()  # 2 ** rounds is above every length, so every depth is cut at once
    digests = _digests(turns, rounds)
    pieces = convs.where("len > 0").select("conv_id", F.lit(0).cast("long").alias("start"), F.lit(first).cast("long").alias("root"), F.lit(1).cast("long").alias("n"), F.col("len").alias("left"), F.lit(True).alias("tail"))
    ends = [convs.where("len = 0").select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(first).cast("long").alias("node"))]
    cuts, spans = [], []
    for k in range(rounds, 0, -1):
        half = 1 << (k - 1)
        halves = digests[k - 1].select("conv_id", (F.col("at") * half).alias("start"), "key")
        cut = pieces.where(f"left >= {half}").join(halves, ["conv_id", "start"])
        # one row for each cut prefix: the smallest member names it, all members' weights add up
        named = stored(cut.groupBy("start", "root", "key").agg(F.min("conv_id").alias("name"), F.sum("n").alias("n")), "trie-cuts")
        of = stored(cut.select("conv_id", "start", "root", "key", "n", "left", "tail").join(named.drop("n"), ["start", "root", "key"]).drop("key"), "trie-pieces")
        cuts.append(named.select("start", "root", (F.col("start") + half).alias("depth"), "name", "n"))
        ends.append(of.where(f"tail and left = {half}").select("conv_id", (F.col("start") + half).alias("depth"), F.col("name").alias("node")))
        # a piece that goes on to its very end stands for a cut prefix of an earlier pass
        spans.append(of.where(f"left = {2 * half}").select("conv_id", (F.col("start") + 2 * half).alias("depth"), (F.col("start") + half).alias("above"), "name"))
        upper = named.select(F.col("name").alias("conv_id"), "start", "root", "n", F.lit(half).cast("long").alias("left"), F.lit(False).alias("tail"))
        short = pieces.where(f"left < {half}")
        lower = of.where(f"left > {half}").select("conv_id", (F.col("start") + half).alias("start"), F.col("name").alias("root"), "n", (F.col("left") - half).alias("left"), "tail")
        pieces = stored(upper.union(short).union(lower), "trie-pieces")
    turn = turns.select("conv_id", F.col("pos").alias("start"), "chars")
    nodes = pieces.join(turn, ["conv_id", "start"]).select("conv_id", (F.col("start") + 1).alias("depth"), F.col("root").alias("parent_conv_id"), F.col("n").alias("n_convs"), ((F.col("n") - 1) * F.col("chars")).alias("saved"))
    children = nodes.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = stored(nodes.join(children, ["conv_id", "depth"], "left").fillna({"n_children": 0}), "trie-nodes")
    below = _grafted(nodes, cuts, spans, rounds)
    made = nodes.join(below, ["conv_id", "depth"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        (F.expr("if(n_children = 0, 1L, 0L)") + F.coalesce("leaves", F.lit(0))).alias("n_leaves"),
        (F.col("saved") + F.coalesce("under", F.lit(0))).alias("saved_tokens"),
    )
    if first is None:
        return made, ends[0]
    made = stored(made, "trie")
    number = lambda name, value: F.lit(value).cast("long").alias(name)
    top = made.where("depth = 1").agg(F.count("*").alias("n_children"), F.coalesce(F.sum("n_leaves"), F.lit(1)).alias("n_leaves"), F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("saved_tokens"))
    top = top.select(number("conv_id", first), number("depth", 0), number("parent_conv_id", None), number("n_convs", n_convs), "n_children", "n_leaves", "saved_tokens")
    return made.union(top), reduce(DataFrame.union, ends)


def _grafted(nodes: DataFrame, cuts: list[DataFrame], spans: list[DataFrame], rounds: int) -> DataFrame:
    """(conv_id, depth, leaves, under): sums over what lies below every node that is not a leaf.

    ``cuts`` and ``spans`` are of the passes from the largest pieces to the smallest.
    """
    sums = F.sum("leaves").alias("leaves"), F.sum("under").alias("under")
    own = nodes.select(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"), F.expr("if(n_children = 0, 1L, 0L)").alias("leaves"), F.col("saved").alias("under"))
    # what stands in the pieces of 1, 2, 4, ... turns that begin under a node
    within = [stored(own.groupBy("conv_id", "depth").agg(*sums), "trie-sums")]
    for k in range(1, rounds):
        lower = cuts[rounds - k].join(within[-1].withColumnRenamed("conv_id", "name"), ["name", "depth"])
        grafts = lower.select(F.col("root").alias("conv_id"), F.col("start").alias("depth"), "leaves", "under")
        within.append(stored(within[-1].where(f"depth % {1 << k} = 0").union(grafts).groupBy("conv_id", "depth").agg(*sums), "trie-sums"))
    # the piece under a cut, and what lies below the nodes at that piece's end
    below = within[0].where("false")
    for k in range(rounds, 0, -1):
        here = within[k - 1].where(f"depth % {1 << k} = {1 << (k - 1)}")
        further = spans[rounds - k].join(below, ["conv_id", "depth"]).select(F.col("name").alias("conv_id"), F.col("above").alias("depth"), "leaves", "under")
        below = below.union(stored(here.union(further).groupBy("conv_id", "depth").agg(*sums), "trie-below"))
    return below


def end_digests(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256): SHA-256 of the ids, ascending and joined by commas, that end at each node.

    Ids are numbered by ranges and joined to texts of ``ENDS`` at most. Only where more end
    at one node do its texts pass through one task, one after another, as a digest asks.
    """
    small_batches(ends.sparkSession)
    placed = numbered(ends.select("conv_id", "depth", "node"), ["depth", "node"], [F.col("conv_id")])
    blocks = placed.groupBy("depth", "node", F.floor(F.col("idx") / ENDS).alias("block"), (F.col("total") <= ENDS).alias("whole"))
    texts = stored(blocks.agg(F.array_join(F.sort_array(F.collect_list(F.struct("idx", F.col("conv_id").cast("string").alias("id"))))["id"], ",").alias("ids")), "trie-ends")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"depth": pa.array([at[0]], pa.int64()), "node": pa.array([at[1]], pa.int64()), "ends_sha256": [digest.hexdigest()]})

        at, digest = None, None
        for batch in batches:
            for depth, node, ids in zip(*(batch.column(name).to_pylist() for name in ("depth", "node", "ids")), strict=True):
                if at == (depth, node):
                    digest.update(b",")
                elif at is not None:
                    yield done()
                if at != (depth, node):
                    at, digest = (depth, node), hashlib.sha256()
                digest.update(ids.encode())
        if at is not None:
            yield done()

    many = texts.where("not whole").repartition("depth", "node").sortWithinPartitions("depth", "node", "block")
    found = texts.where("whole").select("depth", "node", F.sha2("ids", 256).alias("ends_sha256")).union(many.mapInArrow(run, "depth long, node long, ends_sha256 string"))
    return found.select(F.col("node").alias("conv_id"), "depth", "ends_sha256")


def with_shared_starts(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths of the conversations that begin with turns of the last one divisible by ``every``.

    Conversation c takes the first h turns of conversation c - c % every (the sign of c stays,
    as in SQL), all if there are fewer, none if there is no such conversation, and then its
    own after its first h; h is crc32(c) % ``most``. ``turns`` come from :func:`turn_rows`.
    """
    turns = stored(turns, "trie-rows")
    lead = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    base = F.col("conv_id") - F.col("conv_id") % every
    whole = turns.where("pos = 0").select("conv_id", "total")
    lengths = whole.select(F.col("conv_id").alias("base"), F.col("total").alias("given"))
    convs = whole.withColumn("lead", lead).withColumn("base", base).join(lengths, "base", "left").withColumn("taken", F.least("lead", F.coalesce("given", F.lit(0))))
    heads = turns.where(f"pos < {most - 1} and conv_id % {every} = 0").select(F.col("conv_id").alias("base"), "pos", "key", "chars")
    first = convs.join(heads, "base").where("pos < lead").select("conv_id", "pos", "key", "chars")
    own = turns.withColumn("lead", lead).where("pos >= lead").join(convs.select("conv_id", "taken"), "conv_id")
    rest = own.select("conv_id", (F.col("pos") - F.col("lead") + F.col("taken")).alias("pos"), "key", "chars")
    return first.union(rest), convs.select("conv_id", (F.col("taken") + F.greatest(F.col("total") - F.col("lead"), F.lit(0))).alias("len"))
