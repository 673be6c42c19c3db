"""Near-duplicate embeddings: all pairs above a cosine, by dual traversal of cover trees.

Unit vectors with a cosine of t or more are at most sqrt(2 - 2t) apart, so two balls whose
centres are farther apart than that and both radii hold no pair. A cover tree is a nest of
such balls: the centres of a level are more than its radius apart, every point lies within
the radius of one of them, and radii halve from level to level.

The tree of a label is built top down. Cells of more than ``LEAF`` vectors are split by Spark:
a net is chosen from a bounded sample of the cell, level by level until ``FAN`` centres are
found, and every vector goes to the nearest. A cell that no net can split is dealt out by
hash. Radii are measured over all vectors, so no result depends on the samples. Cells that are
small enough get the rest of their tree in a task, as flat arrays.

Traversal goes down in pairs of nodes, first of cells by joins, then within the tasks that
have two cells each. A pair of nodes goes if the balls are too far apart for any link, counts
in full if they are so close that everything is linked, and otherwise is split; at the
bottom the exact products are taken. A task of two cells returns how many links each vector
has and a spanning forest, not all its pairs, so near copies of one vector in any number make
no more rows than there are tasks times vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendfall.llm.components import components
from spendfall.llm.store import small_batches, stored

#: Vectors of a cell that one task takes; sampled vectors and centres of a cell that is split.
LEAF = 1024
SAMPLE = 256
FAN = 16
#: Vectors of a block that is held against a cell's centres, and rows of such size that are handed to Python at once.
BLOCK = 4096
LARGE_ROWS = 16
#: Nodes of so few vectors are not split further; a pair of nodes costs as much as so many products.
BOTTOM = 16
PAIR_COST = 4096
#: Slack of the bounds, for rounding.
SLACK = 1e-6


@contextmanager
def _large_rows(spark: SparkSession) -> Iterator[None]:
    """Hand rows to Python in very small batches for as long as this lasts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(LARGE_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def unit_vectors(vectors: DataFrame, id_col: str, vector: str, label: str) -> DataFrame:
    """(id, tree, unit): every row's vector at length one, as bytes, and its width and label.

    ``tree`` and ``unit`` are null for rows that cannot have links.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            lengths = np.asarray(column.value_lengths().fill_null(0))
            flat = np.asarray(column.flatten().cast(pa.float64()).fill_null(np.nan))
            starts = np.concatenate(([0], np.cumsum(lengths)))
            trees, units = [], []
            for k, (i, name) in enumerate(zip(batch.column("id").to_pylist(), batch.column("label").to_pylist(), strict=True)):
                values = flat[starts[k] : starts[k + 1]]
                most = np.abs(values).max(initial=0)
                sound = i is not None and name is not None and np.isfinite(values).all() and most > 0
                trees.append(f"{len(values)}:{name}" if sound else None)
                # scaled first, so that squares neither overflow nor vanish; + 0.0 makes -0.0 zero
                scaled = values / most if sound else values
                units.append((scaled / np.sqrt((scaled * scaled).sum()) + 0.0).tobytes() if sound else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(trees, pa.string()), pa.array(units, pa.binary())], names=["id", "tree", "unit"])

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    return rows.mapInArrow(run, "id long, tree string, unit binary")


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of bytes of one length as a matrix of doubles."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def _distance(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Distances between the rows of two matrices of unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (left @ right.T), 0))


def net(points: np.ndarray, most: int) -> np.ndarray:
    """Centres among ``points``: nested nets of halving radii, up to ``most`` centres, the coarsest first."""
    chosen = [0]
    apart = _distance(points, points[:1])[:, 0]
    radius = apart.max()
    while len(chosen) < most and radius > SLACK:
        radius /= 2
        while len(chosen) < most and (far := np.flatnonzero(apart > radius)).size:
            chosen.append(int(far[0]))
            np.minimum(apart, _distance(points, points[far[:1]])[:, 0], out=apart)
    return np.array(chosen)


class CoverTree:
    """A cover tree over the rows of a matrix, as arrays: nodes are ranges of the reordered rows.

    Node k has the centre ``centre[k]``, all its rows ``start[k]:end[k]`` within ``radius[k]``
    of it, and the nodes ``first[k]:last[k]`` as children. Children are within half the radius.
    """

    FIELDS = ("centre", "start", "end", "first", "last", "radius")

    def __init__(self, **arrays: np.ndarray) -> None:
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, points: np.ndarray) -> tuple[CoverTree, np.ndarray]:
        """The tree and the order of the rows in it."""
        order = np.arange(len(points))
        centre, start, end, first, last, radius = [0], [0], [len(points)], [0], [0], [0.0]
        at = [0]  # the row in ``points`` that is each node's centre
        k = 0
        while k < len(at):
            rows = order[start[k] : end[k]].copy()
            apart = _distance(points[rows], points[at[k]][None])[:, 0]
            radius[k] = float(apart.max())
            first[k] = last[k] = len(at)
            if len(rows) > BOTTOM and radius[k] > SLACK:
                # the node's own centre is a centre of the next level, too
                half, place, of, rest = radius[k] / 2, start[k], at[k], rows
                while len(rest):
                    near = apart <= half
                    near[rest == of] = True
                    order[place : place + near.sum()] = rest[near]
                    at.append(int(of))
                    for field, value in ((centre, 0), (start, place), (end, place + int(near.sum())), (first, 0), (last, 0), (radius, 0.0)):
                        field.append(value)
                    place += int(near.sum())
                    rest = rest[~near]
                    if len(rest):
                        of = rest[0]
                        apart = _distance(points[rest], points[of][None])[:, 0]
                last[k] = len(at)
            k += 1
        back = np.empty(len(points), np.int64)
        back[order] = np.arange(len(points))
        whole = {"start": start, "end": end, "first": first, "last": last}
        return cls(centre=back[np.array(at)], radius=np.array(radius), **{name: np.array(x) for name, x in whole.items()}), order


def dual_traversal(a: CoverTree, x: np.ndarray, b: CoverTree | None, y: np.ndarray, cosine: float) -> tuple[list[tuple], list[tuple]]:
    """Links between the rows of x and y, or, without ``b``, those among the rows of x, each once.

    Returns pieces (rows of x, rows of y, cosines) of single links, and ranges (start, end of
    x, start, end of y) of which every row is linked with every other.
    """
    reach = sqrt(max(2 - 2 * cosine, 0))
    same = b is None
    b = a if same else b
    links, blocks, stack = [], [], [(0, 0)]
    while stack:
        p, q = stack.pop()
        rows, others = slice(a.start[p], a.end[p]), slice(b.start[q], b.end[q])
        down, across = (np.arange(t.first[n], t.last[n]) if t.last[n] > t.first[n] else np.array([n]) for t, n in ((a, p), (b, q)))
        bottom = len(down) == 1 == len(across)
        if not bottom:
            apart = _distance(x[a.centre[down]], y[b.centre[across]])
            radii = a.radius[down][:, None] + b.radius[across][None]
            may = apart - radii <= reach + SLACK
            must = apart + radii <= reach - SLACK
            if same and p == q:
                may &= np.arange(len(down))[:, None] <= np.arange(len(across))[None]
                np.fill_diagonal(must, False)
            bottom = (may & ~must).sum() * PAIR_COST >= (rows.stop - rows.start) * (others.stop - others.start)
        if bottom:
            product = x[rows] @ y[others].T
            linked = product >= cosine
            if same and p == q:
                linked &= np.arange(len(linked))[:, None] < np.arange(len(linked))[None]
            i, j = np.nonzero(linked)
            links.append((i + rows.start, j + others.start, product[i, j]))
            continue
        for i, j in np.argwhere(may & must):
            blocks.append((a.start[down[i]], a.end[down[i]], b.start[across[j]], b.end[across[j]]))
        stack.extend((down[i], across[j]) for i, j in np.argwhere(may & ~must))
    return links, blocks


def _least(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest node that each of n nodes reaches over the edges u-v."""
    label = np.arange(n)
    while len(u):
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        while (label[label] != label).any():
            label = label[label]
        if (label == before).all():
            break
    return label


def _counted(links: list[tuple], blocks: list[tuple], a_n: np.ndarray, b_n: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Links that every row has, weighted, and the smallest row it reaches; rows of the second side follow the first's."""
    same, size = b_n is None, len(a_n)
    weight = a_n if same else np.concatenate((a_n, b_n))
    shift = 0 if same else size
    count = np.zeros(len(weight), np.int64)
    us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, j, _ in links:
        j = j + shift
        np.add.at(count, i, weight[j])
        np.add.at(count, j, weight[i])
        us.append(i)
        vs.append(j)
    for s, e, t, f in blocks:
        t, f = t + shift, f + shift
        count[s:e] += weight[t:f].sum()
        count[t:f] += weight[s:e].sum()
        # all of both ranges hang together by the first row of each
        us.extend((np.arange(s, e), np.full(f - t, s)))
        vs.extend((np.full(e - s, t), np.arange(t, f)))
    return count, _least(len(weight), np.concatenate(us), np.concatenate(vs))


def _split(points: DataFrame, sizes: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """Points (tree, cell, id, n, unit, apart) of the cells that are too large, in the cells below, and the latter's centres."""
    large = sizes.where(f"size > {LEAF}").select("tree", "cell", "size")
    inside = points.join(large, ["tree", "cell"])
    drawn = inside.where(F.pmod(F.xxhash64("id", F.lit(depth)), F.lit(1 << 40)) < F.lit(float(SAMPLE) * (1 << 40)) / F.col("size"))
    samples = drawn.groupBy("tree", "cell").agg(F.sort_array(F.collect_list(F.struct("id", "unit")))["unit"].alias("units"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centres = []
            for units in batch.column("units"):
                found = _matrix(units.values)
                centres.append([row.tobytes() for row in found[net(found, FAN)]])
            yield pa.RecordBatch.from_arrays([batch.column("tree"), batch.column("cell"), pa.array(centres, pa.list_(pa.binary()))], names=["tree", "cell", "centres"])

    nets = stored(samples.mapInArrow(choose, "tree string, cell string, centres array<binary>"), "cover-nets")
    blocks = inside.groupBy("tree", "cell", "size", F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / BLOCK).cast("long")).alias("block")).agg(F.collect_list(F.struct("id", "n", "unit")).alias("rows"))
    held = blocks.join(nets, ["tree", "cell"]).select("tree", "cell", "size", F.col("rows.id").alias("ids"), F.col("rows.n").alias("ns"), F.col("rows.unit").alias("units"), "centres")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                tree, cell, size = (batch.column(name)[k].as_py() for name in ("tree", "cell", "size"))
                ids, ns, units = (batch.column(name)[k].values for name in ("ids", "ns", "units"))
                centres = _matrix(batch.column("centres")[k].values)
                apart = _distance(_matrix(units), centres)
                to = apart.argmin(1)
                if len(centres) == 1:
                    # nothing to tell them apart by: as many cells as they need
                    to = np.asarray(ids) * 0x9E3779B1 % (2 * size // LEAF + 1)
                least = apart.min(1)
                yield pa.RecordBatch.from_arrays([pa.array([tree] * len(ids)), pa.array([f"{cell}.{j:x}" for j in to]), ids, ns, units, pa.array(least), pa.array(np.minimum(to, len(centres) - 1))], names=["tree", "cell", "id", "n", "unit", "apart", "centre"])

    moved = stored(held.mapInArrow(assign, "tree string, cell string, id long, n long, unit binary, apart double, centre long"), "cover-moved")
    below = moved.groupBy("tree", "cell", "centre").agg(F.max("apart").alias("radius"))
    parent = F.regexp_replace("cell", r"\.[0-9a-f]+$", "")
    centres = below.withColumn("parent", parent).join(nets.withColumnRenamed("cell", "parent"), ["tree", "parent"])
    made = centres.select("tree", "parent", "cell", F.element_at("centres", (F.col("centre") + 1).cast("int")).alias("centre"), "radius")
    untouched = points.join(nets.select("tree", "cell"), ["tree", "cell"], "left_anti")
    return untouched.union(moved.drop("centre")), stored(made, "cover-cells")


def _packed(points: DataFrame) -> DataFrame:
    """One row for each cell: its vectors and the arrays of their tree."""
    cells = points.groupBy("tree", "cell").agg(F.sort_array(F.collect_list(F.struct("id", "n", "unit"))).alias("rows"))
    names = [f"t_{name}" for name in CoverTree.FIELDS]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, ns, units = (batch.column(name)[k].values for name in ("ids", "ns", "units"))
                matrix = _matrix(units)
                tree, order = CoverTree.build(matrix)
                arrays = [pa.array([x], pa.list_(kind)) for x, kind in ((np.asarray(ids)[order], pa.int64()), (np.asarray(ns)[order], pa.int64()))]
                fields = [pa.array([getattr(tree, name)], pa.list_(pa.float64() if name == "radius" else pa.int64())) for name in CoverTree.FIELDS]
                yield pa.RecordBatch.from_arrays([batch.column("tree").slice(k, 1), batch.column("cell").slice(k, 1), *arrays, pa.array([matrix[order].tobytes()]), *fields], names=["tree", "cell", "ids", "ns", "matrix", *names])

    kinds = ", ".join(f"{name} array<{'double' if name == 't_radius' else 'long'}>" for name in names)
    rows = cells.select("tree", "cell", F.col("rows.id").alias("ids"), F.col("rows.n").alias("ns"), F.col("rows.unit").alias("units"))
    return stored(rows.mapInArrow(pack, f"tree string, cell string, ids array<long>, ns array<long>, matrix binary, {kinds}"), "cover-trees")


def _near_cells(cells: DataFrame, leaves: DataFrame, depth: int, reach: float) -> DataFrame:
    """(tree, a, b) of the leaf cells, a <= b, whose balls are close enough for a link.

    ``cells`` are (tree, parent, cell, centre, radius) below the roots. From level to level,
    pairs go over to the pairs of their children; a leaf stays what it is.
    """
    whole = leaves.select("tree", F.col("cell").alias("parent"), "cell").join(cells.select("tree", "cell", "centre", "radius"), ["tree", "cell"], "left")
    kids = stored(cells.select("tree", "parent", "cell", "centre", "radius").union(whole.select("tree", "parent", "cell", "centre", "radius")), "cover-kids")
    pairs = leaves.select("tree").distinct().select("tree", F.lit("").alias("a"), F.lit("").alias("b"))
    side = lambda s: kids.select("tree", F.col("parent").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("cell", "centre", "radius")))
    for _ in range(max(depth, 1)):
        both = pairs.join(side("a"), ["tree", "a"]).join(side("b"), ["tree", "b"]).where("cell_a <= cell_b")
        columns = both.select("tree", "cell_a", "cell_b", "centre_a", "centre_b", "radius_a", "radius_b")

        def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a, b = batch.column("cell_a").to_pylist(), batch.column("cell_b").to_pylist()
                keep = []
                for k, (left, right) in enumerate(zip(a, b, strict=True)):
                    if left == right:
                        keep.append(True)
                        continue
                    x, y = (np.frombuffer(batch.column(f"centre_{s}")[k].as_py()) for s in "ab")
                    radii = batch.column("radius_a")[k].as_py() + batch.column("radius_b")[k].as_py()
                    keep.append(bool(_distance(x[None], y[None])[0, 0] - radii <= reach + SLACK))
                yield pa.RecordBatch.from_arrays([batch.column(name) for name in ("tree", "cell_a", "cell_b")], names=["tree", "a", "b"]).filter(pa.array(keep, pa.bool_()))

        pairs = stored(columns.mapInArrow(close, "tree string, a string, b string"), "cover-pairs")
    return pairs


def _traversed(classes: DataFrame, cosine: float, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Trees over classes (node, tree, unit, n); ``run`` gets every pair of cells that may hold a link."""
    spark = classes.sparkSession
    points = stored(classes.select("tree", F.lit("").alias("cell"), F.col("node").alias("id"), "n", "unit", F.lit(None).cast("double").alias("apart")), "cover-points")
    cells, depth = points.where("false").select("tree", F.col("cell").alias("parent"), "cell", F.col("unit").alias("centre"), F.col("apart").alias("radius")), 0
    with _large_rows(spark):
        while True:
            sizes = stored(points.groupBy("tree", "cell").agg(F.count("*").alias("size")), "cover-sizes")
            if sizes.where(f"size > {LEAF}").isEmpty():
                break
            depth += 1
            points, made = _split(points, sizes, depth)
            cells = cells.union(made)
        trees = _packed(points)
    pairs = _near_cells(cells, sizes.select("tree", "cell"), depth, sqrt(max(2 - 2 * cosine, 0)))
    side = lambda s: trees.select("tree", F.col("cell").alias(s), *(F.col(c).alias(f"{s}_{c}") for c in trees.columns[2:]))
    with _large_rows(spark):
        return stored(pairs.join(side("a"), ["tree", "a"]).join(side("b"), ["tree", "b"]).mapInArrow(run, schema), "cover-links")


def _tile(batch: pa.RecordBatch, k: int, cosine: float) -> tuple:
    """Ids and weights of both sides (the second's are None where a cell meets itself), their vectors and links."""
    sides = []
    for s in "ab":
        ids, ns = (np.asarray(batch.column(f"{s}_{name}")[k].values) for name in ("ids", "ns"))
        matrix = np.frombuffer(batch.column(f"{s}_matrix")[k].as_py()).reshape(len(ids), -1)
        tree = CoverTree(**{name: np.asarray(batch.column(f"{s}_t_{name}")[k].values) for name in CoverTree.FIELDS})
        sides.append((ids, ns, matrix, tree))
        if s == "a" and batch.column("a")[k] == batch.column("b")[k]:
            break
    ids, ns, x, a = sides[0]
    other, weights, y, b = sides[-1] if len(sides) > 1 else (None, None, x, None)
    return ids, ns, other, weights, x, y, *dual_traversal(a, x, b, y, cosine)


def _classes(rows: DataFrame) -> DataFrame:
    """Equal unit vectors of a tree as one: (tree, unit, id, n, node) with the smallest id, the number of ids and a number."""
    same = rows.where("unit is not null").distinct().groupBy("tree", "unit").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    return stored(same.withColumn("node", F.monotonically_increasing_id()), "cover-classes")


def cover_tree_pairs(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = 0.93) -> tuple[DataFrame, DataFrame]:
    """(u, v, cosine) of all linked pairs of classes of equal directions, and (id, class_id) of the members.

    A class goes by the smallest id in it. Nulls and other cases are as in
    :func:`near_embeddings`; rows that cannot have links are in neither.
    """
    small_batches(vectors.sparkSession)
    rows = stored(unit_vectors(vectors, id_col, vector, label), "cover-units")
    classes = _classes(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, _, other, _, x, y, links, blocks = _tile(batch, k, cosine)
                other = ids if other is None else other
                for s, e, t, f in blocks:
                    i, j = (m.ravel() for m in np.meshgrid(np.arange(s, e), np.arange(t, f), indexing="ij"))
                    links.append((i, j, (x[s:e] @ y[t:f].T).ravel()))
                for i, j, value in links:
                    yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(other[j]), pa.array(value)], names=["a", "b", "cosine"])

    pairs = _traversed(classes, cosine, run, "a long, b long, cosine double")
    name = lambda node, to: classes.select(F.col("node").alias(node), F.col("id").alias(to))
    named = pairs.join(name("a", "p"), "a").join(name("b", "q"), "b").select(F.least("p", "q").alias("u"), F.greatest("p", "q").alias("v"), "cosine")
    return named, rows.join(classes.select("tree", "unit", F.col("id").alias("class_id")), ["tree", "unit"]).select(F.col("id").alias(id_col), "class_id")


def near_embeddings(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = 0.93) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``.

    Vectors of one label are linked if the cosine of their angle, in double precision, is
    ``cosine`` or more; only vectors of one width are compared. ``n_links`` counts the other
    vectors that one is linked with, ``component_id`` is the smallest id it reaches, itself
    included, and ``kept`` whether that is its own. Vectors that are null, empty, zero or have
    a null or non-finite component, and those without a label or an id, are linked with
    nothing; a row without an id has no component and is kept. Rows that repeat id, label and
    direction are one vector and share a result; other vectors under the same id are vectors
    of their own. An empty table has no rows. Other columns are not looked at.
    """
    small_batches(vectors.sparkSession)
    rows = stored(unit_vectors(vectors, id_col, vector, label), "cover-units")
    classes = _classes(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, ns, other, weights, _, _, links, blocks = _tile(batch, k, cosine)
                count, least = _counted(links, blocks, ns, weights)
                nodes = ids if other is None else np.concatenate((ids, other))
                some = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(nodes[least[some]]), pa.array(count[some])], names=["u", "v", "links"])

    found = _traversed(classes, cosine, run, "u long, v long, links long")
    links = found.groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    reached = components(found.select("u", "v"))
    grouped = stored(classes.join(links, "node", "left").join(reached, "node", "left").withColumn("component", F.coalesce("component", "node")), "cover-groups")
    least = grouped.groupBy("component").agg(F.min("id").alias("component_id"))
    known = grouped.join(least, "component").select("tree", "unit", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.join(known, ["tree", "unit"], "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
