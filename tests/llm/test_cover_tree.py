"""Cover trees against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from spendfall.llm import cover_tree
from spendfall.llm.cover_tree import CoverTree, cover_tree_pairs, dual_traversal, near_embeddings
from spendfall.llm.queries import op11_near_embeddings

ROWS = "vec_id long, embedding array<double>, label int"


def clustered(seed: int, n: int, dims: int, spread: float) -> np.ndarray:
    """Unit vectors, two thirds of them round a few others."""
    draw = np.random.default_rng(seed)
    points = draw.normal(size=(n, dims))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    near = draw.integers(0, max(n // 20, 1), 2 * n // 3)
    points[n - len(near) :] = points[near] + spread * draw.normal(size=(len(near), dims)) / np.sqrt(dims)
    return points / np.linalg.norm(points, axis=1, keepdims=True)


def model(rows: list[tuple], cosine: float = 0.93) -> list[tuple]:
    """(vec_id, n_links, component_id, kept) of all rows, from all pairs of different (id, label, direction)."""
    unit = []
    for i, values, label in rows:
        x = np.array([np.nan if v is None else v for v in values or []], float)
        sound = i is not None and label is not None and len(x) and np.isfinite(x).all() and np.abs(x).max() > 0
        unit.append(x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) if sound else None)
    nodes = {}
    for (i, _, label), x in zip(rows, unit, strict=True):
        if x is not None:
            nodes.setdefault((i, label, (x + 0.0).tobytes()), len(nodes))
    keys = list(nodes)
    linked = {k: set() for k in range(len(keys))}
    for a, (_, label, x) in enumerate(keys):
        for b, (_, other, y) in enumerate(keys):
            if a != b and label == other and len(x) == len(y) and np.frombuffer(x) @ np.frombuffer(y) >= cosine:
                linked[a].add(b)
    least = {}
    for k in sorted(linked, key=lambda k: keys[k][0]):
        todo = [] if k in least else [k]
        while todo:
            at = todo.pop()
            if at not in least:
                least[at] = keys[k][0]
                todo += linked[at]
    out = []
    for (i, _, label), x in zip(rows, unit, strict=True):
        k = None if x is None else nodes[i, label, (x + 0.0).tobytes()]
        low = i if k is None else least[k]
        out.append((i, 0 if k is None else len(linked[k]), low, i is None or low == i))
    return sorted(out, key=str)


def found(frame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


@pytest.mark.parametrize(("dims", "spread", "cosine"), [(2, 0.3, 0.93), (3, 0.05, 0.999), (64, 0.3, 0.93), (8, 0.5, 0.9), (64, 0.05, 0.93), (16, 0.0, 0.5)])
def test_traversal_finds_exactly_the_close_pairs(dims, spread, cosine):
    points = clustered(dims, 700, dims, spread)
    trees = []
    for part in (points[::2], points[1::2]):
        tree, order = CoverTree.build(part)
        assert sorted(order) == list(range(len(part)))
        part = part[order]
        for k in range(len(tree.start)):
            apart = np.linalg.norm(part[tree.start[k] : tree.end[k]] - part[tree.centre[k]], axis=1)
            assert apart.max() <= tree.radius[k] + 1e-7
            kids = range(tree.first[k], tree.last[k])
            assert all(tree.radius[c] <= tree.radius[k] / 2 + 1e-7 for c in kids)
            assert not len(kids) or [(tree.start[c], tree.end[c]) for c in kids][0][0] == tree.start[k]
            centres = part[tree.centre[list(kids)]]
            for c in range(len(centres)):
                others = np.delete(np.arange(len(centres)), c)
                assert (np.linalg.norm(centres[others] - centres[c], axis=1) > tree.radius[k] / 2 - 1e-7).all()
        trees.append((tree, part))
    (a, x), (b, y) = trees
    for links, blocks, product, upper in ((*dual_traversal(a, x, b, y, cosine), x @ y.T, False), (*dual_traversal(a, x, None, x, cosine), x @ x.T, True)):
        seen = np.zeros(product.shape, int)
        for i, j, value in links:
            np.add.at(seen, (i, j), 1)
            assert np.allclose(value, product[i, j])
        for s, e, t, f in blocks:
            seen[s:e, t:f] += 1
        assert seen.max(initial=0) <= 1
        if upper:
            seen = seen + seen.T
            np.fill_diagonal(product, -1)
        assert (seen == (product >= cosine)).all()


def test_groups_of_cells_that_are_split(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "LEAF", 40)
    monkeypatch.setattr(cover_tree, "SAMPLE", 30)
    monkeypatch.setattr(cover_tree, "FAN", 4)
    monkeypatch.setattr(cover_tree, "BLOCK", 64)
    points = np.concatenate((clustered(5, 260, 6, 0.2), clustered(6, 1, 6, 0) * np.linspace(1, 3, 110)[:, None]))
    rows = [(k * 3 % 1009, [float(v) for v in x], k % 2 if k % 7 else 0) for k, x in enumerate(points)]
    frame = spark.createDataFrame(rows, ROWS).repartition(3)
    assert found(near_embeddings(frame)) == model(rows)
    pairs, members = cover_tree_pairs(frame)
    of = {r.vec_id: r.class_id for r in members.collect()}
    links = {(r.u, r.v) for r in pairs.collect()}
    unit = {i: (label, np.array(x) / np.linalg.norm(x)) for i, x, label in rows}
    expected = {tuple(sorted((of[a], of[b]))) for a, (la, x) in unit.items() for b, (lb, y) in unit.items() if a < b and of[a] != of[b] and la == lb and x @ y >= 0.93}
    assert links == expected


def test_odd_rows(spark):
    e, f = [1.0, 0.0, 0.0], [0.99, 0.1, 0.0]
    rows = [
        (1, e, 0), (2, f, 0), (3, f, 1), (4, [2.0, 0.0, 0.0], 0), (5, [-1.0, 0.0, 0.0], 0),
        (6, None, 0), (7, [], 0), (8, [0.0, 0.0, 0.0], 0), (9, [1.0, None, 0.0], 0), (10, [float("nan"), 1.0, 0.0], 0), (11, [float("inf"), 0.0, 0.0], 0),
        (12, e, None), (None, e, 0), (13, [1.0, 0.0], 0), (14, [1e300, -0.0, 0.0], 0), (15, [1e-310, 0.0, 0.0], 0), (16, [0.93, float(np.sqrt(1 - 0.93**2)) * 1.001, 0.0], 0),
        (2, f, 0), (2, f, 0), (5, e, 1), (-3, f, 1),
    ]
    assert found(near_embeddings(spark.createDataFrame(rows, ROWS))) == model(rows)


def test_empty_table_and_clashing_columns(spark):
    assert found(near_embeddings(spark.createDataFrame([], ROWS))) == []
    rows = [(k, [1.0, 0.01 * k], 0) for k in range(9)]
    frame = spark.createDataFrame(rows, ROWS)
    wide = frame.selectExpr("*", *(f"1 as {name}" for name in ("id", "tree", "unit", "node", "n", "cell", "component", "links", "n_links", "kept", "vector")))
    assert found(near_embeddings(wide)) == model(rows)


def test_query_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert found(op11_near_embeddings(spark, folder)) == model(rows)
