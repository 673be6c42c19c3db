"""Exact top-k, URL rules and licence digests against plain models."""

from __future__ import annotations

from pathlib import Path

import math
import random

import pytest
from helpers import DOCS
from pyspark.sql import functions as F

from spendfall.llm import exact_topk as topk
import spendfall.llm.license_scan as license_scan_module
from spendfall.llm.license_scan import KNOWN, check_known, license_scan
from spendfall.llm.queries import RULES
from spendfall.llm.url_filter import judge_urls, normal_form, page_edges


def _expected(vectors: list[tuple], k: int) -> set[tuple]:
    sound = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in {(i, tuple(v)) for i, v in sound if i % 5 == 0}:
        best = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in sound if i != q and len(b) == len(a))[:k]
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("block, shard", [(1024, 4096), (3, 7)])
def test_topk_with_ties_hot_vectors_and_odd_rows(spark, monkeypatch, block, shard):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "MERGED", 2)
    draw = random.Random(4)
    vectors = [(i, [round(draw.uniform(-1, 1), 1) for _ in range(4)]) for i in range(60)]
    vectors += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(60, 100)]
    vectors += [(200, None), (205, [0.1, None, 0.2, 0.3]), (210, [float("nan"), 1.0, 1.0, 1.0]), (215, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.0, 1.0]), (220, []), (225, [1.0, 2.0]), (226, [3.0, 2.0])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id long, embedding array<double>, rank string")
    whole = frame.select("vec_id", topk.scaled(F.col("embedding")).alias("vector"), "rank")
    rows = topk.exact_topk(whole.where("vec_id % 5 = 0"), whole, "vec_id", "vector", 5).collect()
    assert {tuple(r) for r in rows} == _expected(vectors, 5)
    assert len(rows) == len(_expected(vectors, 5))


def test_tiles_go_to_several_tasks_and_copies_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 8)
    monkeypatch.setattr(topk, "SHARD", 8)
    vectors = [(i, [i % 7, 1]) for i in range(64)] + [(100, [50, 50])] * 400
    frame = spark.createDataFrame(vectors, "i long, v array<long>")
    rows = topk.exact_topk(frame.where("i < 64"), frame, "i", "v", 5).collect()
    assert len(rows) == 64 * 5 and {r.i for r in rows if r.query_id % 7} == {100}
    pieces = spark.createDataFrame([(2, b, [b], [0, 0]) for b in range(8)], "dims int, block long, own array<long>, asked array<long>")
    shards = spark.createDataFrame([(2, s, [s], [0, 0]) for s in range(8)], "dims int, shard long, ids array<long>, values array<long>")
    tasks = topk._dealt(pieces, shards, 16).select("block", "shard", F.spark_partition_id().alias("task")).collect()
    assert len({(r.block, r.shard) for r in tasks}) == len(tasks) == 64
    assert len({r.task for r in tasks}) > 8


def test_topk_of_large_numbers_and_of_nothing(spark):
    frame = spark.createDataFrame([(0, [2**31, 2**31]), (1, [2**30, 3]), (2, [2**31, -1])], "i long, v array<long>")
    rows = topk.exact_topk(frame.where("i = 0"), frame, "i", "v", 5).collect()
    assert [(r.rank, r.i, r.score) for r in sorted(rows, key=lambda r: r.rank)] == [(1, 2, 2**62 - 2**31), (2, 1, 2**61 + 3 * 2**31)]
    assert topk.exact_topk(frame.limit(0), frame, "i", "v").count() == 0
    assert topk.exact_topk(frame, frame.limit(0), "i", "v").count() == 0


def test_rules_and_aliases(spark):
    pages = [
        (1, "https://A.Example.ORG/es/x?q#f", None),
        (2, "http://b.org/es/", None),
        (3, "https://shop.net/a", None),
        (4, "https://www.shop.net/a.html?utm_source=z", '<link rel="canonical" href="https://x.com/de/1">'),
        (5, "https://y.net/", "<meta http-equiv='refresh' content='0; url=https://x.com/de/2'>"),
        (6, "https://y.net/?utm_medium=1#top", '<link href="https://free.org/ok" rel=canonical>'),
        (7, None, "<html>"),
        (8, "no-scheme.com/de/", None),
        (9, "https://notexample.org/en/1", None),
        (10, "https://example.org/en/12", None),
        (3, "https://shop.net/a", None),
        (11, "https://lone.net/?page=2&ref=x", ""),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("verdict", F.lit("old"))
    rows = judge_urls(frame, page_edges(frame), RULES).collect()
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert len(rows) == 12
    assert found == {
        1: ("a.example.org", "/es/x", "example.org/es/", "block"),
        2: ("b.org", "/es/", "org/", "allow"),
        3: ("shop.net", "/a", None, "block"),
        4: ("www.shop.net", "/a.html", None, "block"),
        5: ("y.net", "/", None, "allow"),
        6: ("y.net", "/", None, "allow"),
        7: ("", "", None, "allow"),
        8: ("", "", None, "allow"),
        9: ("notexample.org", "/en/1", "org/", "allow"),
        10: ("example.org", "/en/12", "example.org/en/1", "block"),
        11: ("lone.net", "/", None, "allow"),
    }
    assert frame.where("page_id = 11").select(normal_form(F.col("url"))).first()[0] == "https://lone.net?page=2"
    assert judge_urls(frame.limit(0), page_edges(frame.limit(0)), RULES).count() == 0


def test_columns_of_pages_stay_what_they_are(spark):
    pages = spark.createDataFrame([(1, "https://a.com/de/x"), (2, "https://www.a.com/de/x"), (3, None)], "page_id long, url string")
    names = ["own", "by_alias", "node", "component", "page", "allowed", "blocked"]
    wide = pages.selectExpr("*", *(f"page_id * 10 as {name}" for name in names))
    edges = spark.createDataFrame([("https://a.com/de/x", "https://b.net/")], "u string, v string")
    rows = judge_urls(wide, edges, RULES).collect()
    assert len(rows) == 3 and all(r[name] == r.page_id * 10 for r in rows for name in names)
    assert {r.page_id: r.verdict for r in rows} == {1: "block", 2: "block", 3: "allow"}


def test_licences_whatever_case_marks_and_spelling(spark):
    mit = KNOWN["MIT"][-1]
    texts = {
        1: "Copyright (c) 2020 Someone\n\n" + mit.upper(),
        2: "** " + mit.replace("MIT License", "The   MIT -- Licence").replace(", ", " , ").replace("The   MIT", "MIT"),
        3: mit + " and more",
        4: "Text.\n  released under the MIT LICENCE!\nmore\n© 2001 X\nLicensed under CC BY-NC 4.0.",
        5: None,
        6: "",
        7: "Copyright 2020 A\nAll rights reserved.",
        8: "Released under the MIT License.",
        9: "word " * 30000,
    }
    frame = spark.createDataFrame([(k, t, "e", "s", 1) for k, t in texts.items()] * 2, DOCS).withColumn("license", F.lit(1))
    rows = license_scan(frame).collect()
    found = {r.doc_id: (r.license, list(r.line_licenses)) for r in rows}
    assert len(rows) == 18
    assert found[1][0] == found[2][0] == found[8][0] == "MIT" and found[8][1] == ["MIT"]
    assert found[3][0] is None and found[4] == (None, ["CC-BY-NC-4.0", "MIT"])
    assert [r.text_digest for r in rows if r.doc_id in (5, 6, 7)] == [None] * 6
    assert found[5] == found[6] == found[7] == found[9] == (None, [])
    assert license_scan(frame.limit(0)).count() == 0
    with pytest.raises(ValueError, match="none of"):
        check_known({"X": ["do what you want"]})


def test_whole_texts_and_headers_of_common_licences(spark):
    """Every text of the data files is found, reflowed and with a copyright line before it; another text is not."""
    files = {f.stem: f.read_text().split("\n%%\n") for f in (Path(license_scan_module.__file__).parent / "licenses").glob("*.txt")}
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "AGPL-3.0", "LGPL-2.1", "Unlicense", "Zlib"} <= set(files)
    texts = [(name, text) for name, several in files.items() for text in several]
    frame = spark.createDataFrame([(k, "Copyright (c) 2020 A\n\n" + text.replace("\n", "\n * ") if k % 2 else text) for k, (_, text) in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r.license for r in license_scan(frame).collect()}
    assert [found[k] for k in range(len(texts))] == [name for name, _ in texts]
