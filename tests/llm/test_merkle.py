"""Merkle manifest against a tree built row by row."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from helpers import DOCS
from pyspark.sql import functions as F

from spendfall.llm.merkle import leaf_digest, manifest
from spendfall.llm.queries import op12_merkle_manifest, tampered_manifest


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value: object) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Top and, for every leaf, the siblings to the left and right, level by level."""
    paths, now, at = [[] for _ in leaves], leaves, list(range(len(leaves)))
    while len(now) > 1:
        for k, place in enumerate(at):
            run = place // 3 * 3
            paths[k].append(("".join(now[run:place]), "".join(now[place + 1 : run + 3])))
        now = [h(*now[k : k + 3]) for k in range(0, len(now), 3)]
        at = [place // 3 for place in at]
    return now[0], paths


def model(rows: list[tuple]) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows (doc_id, text, lang, source, n_chars)."""
    sources: dict = {}
    for i, text, lang, source, n in rows:
        changed = text.replace("\n", "") if text is not None and i is not None and zlib.crc32(str(i).encode()) % 2 == 0 else text
        leaf, other = (h(*map(encoded, (i, source, lang, n, t))) for t in (text, changed))
        sources.setdefault(source, []).append((i is not None, i or 0, leaf, other, i))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: tree([x[2] for x in sorted(sources[s], key=lambda x: x[:4])]) for s in order}
    root, upper = tree([own[s][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for (_, _, leaf, other, i), path in zip(sorted(sources[s], key=lambda x: x[:4]), own[s][1], strict=True):
            path = path + upper[k]
            folded = other
            for left, right in path:
                folded = h(left, folded, right)
            out.append((i, leaf, own[s][0], root, h(*(a + b for a, b in path)), folded, folded == root))
    return out


def found(frame) -> list[tuple]:
    return [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in frame.collect()]


def same(spark, rows):
    frame = spark.createDataFrame(rows, DOCS).repartition(5)
    assert sorted(found(tampered_manifest(frame)), key=str) == sorted(model(rows), key=str)


@pytest.mark.parametrize("sizes", [[1], [2], [3, 4, 1], [1, 9, 10, 27, 28, 82, 244]])
def test_trees_of_any_height(spark, sizes):
    draw = random.Random(sum(sizes))
    rows = [(n * 100 + k * 7, f"line {k}\n{draw.random()}", "en", f"s{n}", k) for n, size in enumerate(sizes) for k in range(size)]
    same(spark, rows)


def test_nulls_repeats_ties_and_long_texts(spark):
    rows = [
        (None, "a\nb", "en", None, 3),
        (None, None, None, None, None),
        (4, "a\nb", "en", "", 3),
        (4, "c\n", "en", "", 2),
        (4, "", None, "", 0),
        (4, None, None, "", None),
        (-5, "ü\n" * 100_000, "de", "ß", 200_000),
        (10, "x", "en", "z", 1),
        (9, "x", "en", "z", 1),
        *[(7, "same\n", "en", "hot", 5)] * 200,
        *[(k, f"{k}\n", "en", "hot", 2) for k in range(100)],
    ]
    same(spark, rows)


def test_an_untampered_row_verifies_and_any_change_of_a_field_is_found(spark):
    rows = [(k, f"{k}\n", "en", f"s{k % 3}", 2) for k in range(40)]
    out = {r[0]: r for r in found(tampered_manifest(spark.createDataFrame(rows, DOCS)))}
    for k, r in out.items():
        assert r[6] == (zlib.crc32(str(k).encode()) % 2 == 1)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], DOCS)
    assert found(tampered_manifest(empty)) == []
    names = ["tree", "idx", "level", "path", "digest", "a", "copies", "place", "leaf", "root"]
    frame = spark.createDataFrame([(k, "x\ny", "en", "s", k) for k in range(12)], DOCS)
    wide = frame.selectExpr("*", *(f"1 as {name}" for name in names))
    assert sorted(found(tampered_manifest(wide))) == sorted(found(tampered_manifest(frame)))


def test_fields_cannot_be_shifted_into_each_other(spark):
    row = spark.range(1).select(leaf_digest(F.lit("ab"), F.lit("c")).alias("x"), leaf_digest(F.lit("a"), F.lit("bc")).alias("y")).first()
    assert row.x == h("2:ab", "1:c") and row.y == h("1:a", "2:bc")


def test_operator_on_other_columns(spark):
    frame = spark.createDataFrame([(f"k{k}", None if k < 4 else "g", h(str(k))) for k in range(9)], "key string, part string, sum string")
    out = manifest(frame, "part", "key", "sum")
    top, _ = tree([tree([h(str(k)) for k in range(4)])[0], tree([h(str(k)) for k in range(4, 9)])[0]])
    assert {r.root for r in out.collect()} == {top}


def test_query_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()]
    assert sorted(found(op12_merkle_manifest(spark, folder))) == sorted(model(rows))
