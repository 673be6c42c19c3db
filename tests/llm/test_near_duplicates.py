"""Near-duplicate groups against all pairs."""

from __future__ import annotations

import numpy as np
import pytest
from helpers import DOCS, prose, groups, shingle_set

from spendfall.llm.components import components
from spendfall.llm.near_duplicates import drop_near_duplicates, near_duplicates, super_minhash


def _edited(text: str, k: int, every: int) -> str:
    words = text.split(" ")
    for place in range(k % every, len(words), every):
        words[place] = f"new{k}x{place}"
    return " ".join(words)


def _texts() -> dict[int, str | None]:
    """Copies, families of edits on both sides of the limit, chains, short, empty and null texts."""
    base, other = prose(1, 120), prose(2, 400)
    texts = {k: _edited(base, k, 60) for k in range(10, 25)}
    texts |= {k: _edited(other, k, 25) for k in range(30, 42)}
    texts |= {5: base, 6: base.upper(), 7: base + " tail end", 8: None, 9: "", 50: " \n ", 51: "one", 52: "ONE", 53: "one two", 54: prose(9, 3000), 55: prose(9, 3000) + " x"}
    chain = prose(3, 100).split(" ")
    for k in range(6):
        texts[60 + k] = " ".join(chain[2 * k : 80 + 2 * k])
    return texts


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_groups_equal_those_of_all_pairs(spark, width, percent):
    texts = _texts()
    frame = spark.createDataFrame([(k, t, "n") for k, t in texts.items()], "doc_id long, text string, n_shingles string")
    rows = near_duplicates(frame, width=width, percent=percent).collect()
    assert {r.doc_id: r.component_id for r in rows} == groups(texts, width, percent)
    assert {r.doc_id: r.n_shingles for r in rows} == {k: len(shingle_set(t, width)) for k, t in texts.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_repeated_rows_missing_ids_and_no_rows(spark):
    schema = "doc_id long, text string"
    rows = near_duplicates(spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "a b c d")], schema)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in rows) == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False)]
    assert near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_one_of_each_group_stays_with_its_columns(spark):
    frame = spark.createDataFrame([(k, t, None, "s", 1) for k, t in _texts().items()], DOCS)
    kept = drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, low in groups(_texts(), 5, 80).items() if k == low}


def test_signatures_estimate_similarity_with_less_spread():
    draw = np.random.default_rng(5)
    found = []
    for _ in range(60):
        common, left, right = (draw.integers(0, 1 << 63, n).astype(np.uint64) for n in (160, 20, 20))
        both = super_minhash(np.concatenate((common, left, common, right)), np.repeat([0, 1], 180), 2)
        found.append((both[0] == both[1]).mean())
    assert abs(np.mean(found) - 0.8) < 0.015
    assert np.std(found) < (0.8 * 0.2 / 128) ** 0.5


def test_signature_of_one_element_has_every_rank_once():
    one = super_minhash(np.array([7], np.uint64), np.array([0]), 1, 16)
    assert sorted(np.floor(one[0])) == list(range(16))


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 199), (200, 199), (None, 3)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{k: 0 for k in range(1, 41)}, **{k: 100 for k in range(101, 160)}, 200: 199}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
