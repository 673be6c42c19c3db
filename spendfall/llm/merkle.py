"""Merkle manifest of a dataset: one hash tree per group of rows, one over the groups' roots.

Every row is a leaf; runs of three consecutive nodes become their parent until one is left.
Leaves are numbered by ranges (:mod:`spendfall.llm.numbering`), so that four levels at a time
come out of blocks of 81 neighbours and no group of rows meets in one task, however large.

Proofs come by pointer jumping. Every node begins with its parent as ancestor and with the
segment of its own siblings; each round joins the table with itself, ancestor to node, which
doubles the distance and appends the ancestor's segment, until every leaf points at the root.
Only every 2^r-th level is still somebody's ancestor after round r, so only those go on. A
node is the ancestor of 3^distance leaves, but there are as many times fewer such nodes: a
key has a large share of the rows only where the other side is a handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendfall.llm.numbering import numbered
from spendfall.llm.store import dropped, stored

FAN = 3
#: Levels that one pass makes of its blocks of FAN ** LEVELS nodes.
LEVELS = 4
#: Name of the tree over the groups; those of the groups' own trees are empty or start with a dot.
TOP = "top"
KEY, TO = ["tree", "level", "idx"], ["to_tree", "to_level", "to_idx"]


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*fields: Column) -> Column:
    """Lower-case hex SHA-256 of the fields, each with its length."""
    return F.sha2(F.concat(*(field(value) for value in fields)), 256)


def _hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf (hex) gives with the siblings to its left and right, level by level."""
    return F.aggregate(proof, leaf, lambda at, s: F.sha2(F.concat(_hex(s["left"]), at, _hex(s["right"])), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of the hex digests of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(_hex(s["left"]), _hex(s["right"]))), ""), 256)


def _height(total: Column) -> Column:
    """Levels above the leaves: the powers of FAN below the number of leaves."""
    powers = F.array(*(F.lit(FAN**k).cast("long") for k in range(39)))
    return F.size(F.filter(powers, lambda p: p < total))


def _above(nodes: Column) -> Column:
    """Digests (hex) of the runs of FAN nodes."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(nodes, i * FAN + 1, FAN), ""), 256))


def _siblings(nodes: Column, level: int, first: Column) -> Column:
    """For every node its level, index and the siblings on either side, as bytes."""

    def one(_: Column, i: Column) -> Column:
        place = i % FAN
        left = F.unhex(F.array_join(F.slice(nodes, i - place + 1, place), ""))
        right = F.unhex(F.array_join(F.slice(nodes, i + 2, F.lit(FAN - 1) - place), ""))
        return F.struct(F.lit(level).alias("level"), (first + i).alias("idx"), left.alias("left"), right.alias("right"))

    return F.transform(nodes, one)


def _built(base: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """The trees over leaves (tree, idx, digest, total).

    Returns the siblings (tree, height, level, idx, left, right) of all nodes below the tops,
    the tops (tree, height, digest), and the greatest height (0 without leaves).
    """
    now = base.withColumn("height", _height(F.col("total"))).select("tree", "height", "idx", "digest")
    most = now.agg(F.max("height")).first()[0] or 0
    tops = now.where("height = 0").select("tree", "height", "digest")
    nodes = None
    for start in range(0, max(most, 1), LEVELS):
        blocks = now.where(f"height > {start}").groupBy("tree", "height", F.floor(F.col("idx") / FAN**LEVELS).alias("block"))
        made = blocks.agg(F.sort_array(F.collect_list(F.struct("idx", "digest")))["digest"].alias("n0"))
        for k in range(LEVELS):
            made = made.withColumn(f"n{k + 1}", _above(F.col(f"n{k}")))
        made = stored(made, "merkle-blocks")
        for k in range(LEVELS):
            found = _siblings(F.col(f"n{k}"), start + k, F.col("block") * FAN ** (LEVELS - k))
            part = made.where(f"height > {start + k}").select("tree", "height", F.explode(found).alias("x")).select("tree", "height", "x.*")
            nodes = part if nodes is None else nodes.union(part)
            tops = tops.union(made.where(f"height = {start + k + 1}").select("tree", "height", F.col(f"n{k + 1}")[0].alias("digest")))
        now = made.select("tree", "height", F.col("block").alias("idx"), F.col(f"n{LEVELS}")[0].alias("digest"))
    return nodes, tops, most


def _steps(nodes: DataFrame) -> DataFrame:
    """Every node with its parent and the segment of its own siblings."""
    path = F.array(F.struct("left", "right")).alias("path")
    return nodes.select(*KEY, F.col("tree").alias("to_tree"), (F.col("level") + 1).alias("to_level"), F.floor(F.col("idx") / FAN).alias("to_idx"), path)


def _jumped(steps: DataFrame, longest: int) -> DataFrame:
    """(tree, idx, path) of the leaves, with the segments of all their ancestors below the root."""
    leaf = f"level = 0 and tree <> '{TOP}'"
    distance = 1
    while distance < longest:
        distance *= 2
        # what stays an ancestor is a whole number of distances above the leaves; in the upper tree that may be any node
        going = steps.where(leaf if distance >= longest else f"tree = '{TOP}' or level % {distance} = 0")
        further = steps.select(*(F.col(a).alias(f"at_{a}") for a in KEY), *(F.col(a).alias(f"next_{a}") for a in TO), F.col("path").alias("more"))
        joined = going.join(further, [F.col(t) == F.col(f"at_{a}") for t, a in zip(TO, KEY, strict=True)], "left")
        arrived = F.col("more").isNull()
        moved = joined.select(
            *KEY,
            *(F.when(arrived, F.col(t)).otherwise(F.col(f"next_{t}")).alias(t) for t in TO),
            F.when(arrived, F.col("path")).otherwise(F.concat("path", "more")).alias("path"),
        )
        then = stored(moved, "merkle-steps")
        dropped(steps)
        steps = then
    return steps.where(leaf).select("tree", "idx", "path")


def manifest(leaves: DataFrame, group: str, order: str, leaf: str = "leaf", carried: Sequence[str] = ()) -> DataFrame:
    """(group, order, leaf, carried columns, subroot, root, proof) for every row of ``leaves``.

    ``leaf`` is a row's digest in lower-case hex (see :func:`leaf_digest`), never null. In a
    group the rows ascend by ``order`` (null first), then by digest; groups ascend by name
    (null first, bytewise). ``proof`` lists, from the leaf to the root, the siblings to the
    left and to the right as bytes, digest after digest; :func:`fold` gives the root from it.

    Rows equal in all these columns are counted first and dealt out by their number, so a
    row that is repeated very often is sorted by many tasks; each has a place and a proof of
    its own. A null group is a group. A single row is its own subroot; with no other group
    it is the root, too, and its proof is empty. An empty table has no rows. Other columns,
    whatever their names, are not looked at.
    """
    own = [f"c{k}" for k in range(len(carried))]
    rows = leaves.select(F.col(group).alias("a"), F.col(order).alias("b"), F.col(leaf).alias("digest"), *(F.col(c).alias(k) for k, c in zip(own, carried, strict=True)))
    counted = rows.groupBy("a", "b", "digest", *own).agg(F.count("*").alias("copies"))
    tree = F.when(F.col("a").isNull(), F.lit("")).otherwise(F.concat(F.lit("."), F.col("a").cast("string")))
    dealt = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).withColumn("tree", tree).drop("copies")
    placed = stored(numbered(dealt, ["tree"], [F.col("b").asc_nulls_first(), F.col("digest"), *(F.col(c) for c in own), F.col("copy")]).drop("copy"), "merkle-leaves")

    nodes, tops, height = _built(placed)
    subroots = stored(numbered(tops.withColumn("all", F.lit(TOP)), ["all"], [F.col("tree")]), "merkle-subroots")
    upper, roots, above = _built(subroots.select(F.lit(TOP).alias("tree"), "idx", "digest", "total"))
    root = roots.first()
    # the lowest nodes of the upper tree are the tops of the others, and go by those names
    named = subroots.select(F.col("tree").alias("of"), F.col("height").alias("top"), "idx")
    bridges = _steps(upper.where("level = 0")).join(named, "idx").select(F.col("of").alias("tree"), F.col("top").alias("level"), F.lit(0).cast("long").alias("idx"), *TO, "path")
    steps = stored(_steps(nodes).union(bridges).union(_steps(upper.where("level > 0"))), "merkle-steps")
    paths = _jumped(steps, height + above)

    found = placed.join(paths, ["tree", "idx"], "left").join(subroots.select("tree", F.col("digest").alias("subroot")), "tree")
    nothing = F.array().cast("array<struct<left:binary,right:binary>>")
    return found.select(
        F.col("a").alias(group),
        F.col("b").alias(order),
        F.col("digest").alias(leaf),
        *(F.col(k).alias(c) for k, c in zip(own, carried, strict=True)),
        "subroot",
        F.lit(root.digest if root else None).cast("string").alias("root"),
        F.coalesce("path", nothing).alias("proof"),
    )
