"""Queries against SQL, and the pipeline stage by stage."""

from __future__ import annotations

import os

import corpus_pipeline
import duckdb
import pandas as pd
import pytest
from helpers import WORD, base_counts, groups, repeated_words

import __spark_entry__
from spendfall.llm.queries import llm_oracle, llm_queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations"):
        path = f"{FOLDER}/{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path + '/*' if os.path.isdir(path) else path}')")
    return connection


def _plain(frame: pd.DataFrame) -> list[list[str]]:
    """Rows in order, whole numbers as such whatever the column's type makes of nulls."""
    show = lambda v: "" if pd.isna(v) else str(int(v)) if isinstance(v, float) and v.is_integer() else str(v)
    return sorted([show(v) for v in row] for row in frame.astype(object).values.tolist())


@pytest.mark.parametrize("name", sorted(llm_oracle()))
def test_queries_equal_their_sql(spark, tables, name):
    rows = llm_queries()[name](spark, FOLDER).toPandas()
    same = tables.execute(llm_oracle()[name]).fetchdf()
    columns = sorted(rows.columns)
    assert columns == sorted(same.columns)
    assert _plain(rows[columns]) == _plain(same[columns])


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert {int(name[2:].split("_")[0]) for name in names if name.startswith("op") and name[2].isdigit()} == set(range(1, 14))
    assert set(llm_oracle()) <= set(names)


def test_base_counts_of_whole_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    for r in llm_queries()["op6_quality_rules"](spark, FOLDER).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_counts(texts[r.doc_id])


def test_groups_of_whole_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    found = {r.doc_id: r.component_id for r in llm_queries()["op9_near_duplicates"](spark, FOLDER).collect()}
    assert found == groups(texts, 3, 85)


def test_stages_follow_their_rules(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    now = {r.doc_id: r.text for r in docs.collect()}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == columns
        rows = out.collect()
        after = {r.doc_id: r.text for r in rows}
        assert set(after) <= set(now)
        if name == "line dedup":
            expected = repeated_words(now, 50)
            for key, gone in expected.items():
                left = [w for w, x in zip(WORD.findall(now[key]), gone, strict=True) if not x]
                # a stretch of one or two alternating words may hold no wrap
                assert WORD.findall(after.get(key, "")) == left or len(set(WORD.findall(now[key]))) * 3 < len(gone)
            assert all(r.n_chars == len(r.text) for r in rows if r.text != now[r.doc_id])
        else:
            assert all(after[key] == now[key] for key in after)
        if name == "near-dedup":
            assert set(after) == {k for k, low in groups(now, 5, 80).items() if k == low}
        docs, now = spark.createDataFrame(rows, docs.schema), after
    placed = corpus_pipeline.STAGES[4][1](spark, docs, FOLDER).toPandas()
    assert placed["size"].sum() == sum(len(WORD.findall(t)) for t in now.values())
    assert set(placed["doc_id"]) == set(now)


def test_run_is_the_stages_in_turn(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "line dedup", "near-dedup", "packing"]
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
