"""Toxicity: held-out accuracy on made-up and given texts, odd rows."""

from __future__ import annotations

import random

from helpers import DOCS, prose
from pyspark.sql import functions as F

from spendfall.llm.queries import HELD_OUT, op1_toxicity
from spendfall.llm.toxicity import Model, Settings, fit, passage_words, score, toxic_windows, train_dictionaries

INSULTS = ["grobnik", "fulpast", "wertzag", "skumbol"]


def _toxic(seed: int) -> str:
    draw = random.Random(seed)
    words = prose(seed, 150).split(" ")
    for place in range(5, len(words), 20):
        words[place] = draw.choice(INSULTS)
    return " ".join(words)


def _rows(toxic: int, ordinary: int) -> list[tuple]:
    return [(k, _toxic(k) if k < toxic else prose(k, 150), "e", "s", 1) for k in range(toxic + ordinary)]


def test_passages_are_found_and_scored(spark):
    rows = _rows(90, 200)
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(k, 1, int(k < 90)) for k in range(290)], "doc_id long, quality int, toxic int")
    model = fit(docs, labels, learn="doc_id % 2 = 0")
    found = {r.doc_id: r.score for r in score(docs, model).collect()}
    odd = [k for k in range(290) if k % 2]
    right = sum((found[k] >= 0.3) == (k < 90) for k in odd)
    assert right >= 0.95 * len(odd)
    assert all(0 <= x <= 1 for x in found.values())


def test_copies_of_a_passage_are_no_evidence():
    copied = [prose(1, 60) for _ in range(40)]
    ordinary = [prose(k, 60) for k in range(100, 200)]
    assert passage_words(copied, ordinary, Settings()) == set()
    assert {word.encode() for word in INSULTS} <= passage_words([_toxic(k) for k in range(60)], ordinary, Settings())


def test_odd_rows_and_missing_labels(spark):
    data = [(1, None, None, None, None), (2, "", "e", "s", 0), (None, "x", "e", "s", 1), (3, "word " * 60000, "e", "s", 1), (2, "", "e", "s", 0)]
    docs = spark.createDataFrame(data, DOCS).withColumn("score", F.lit("old"))
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fit(docs, nothing).weights == ()
    rows = score(docs, Model(prior=0.25)).collect()
    assert [r.score for r in rows] == [0.25] * 5 and rows[0].text is None
    model = fit(spark.createDataFrame(_rows(60, 120), DOCS), spark.createDataFrame([(k, 1, int(k < 60)) for k in range(180)], "doc_id long, quality int, toxic int"))
    some = {r.doc_id: r.score for r in score(docs, model).collect()}
    assert some[1] == some[2] < 0.3 and len(some) == 4
    assert score(docs.limit(0), model).count() == 0


def test_given_documents_held_out(spark):
    """At least nine in ten held-out labels are right on the smallest given tables."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = op1_toxicity(spark, folder).where("held_out").join(labels.where(HELD_OUT), "doc_id").collect()
    assert rows and sum(r.predicted == r.toxic for r in rows) >= 0.9 * len(rows)


def _with(phrase: str, seed: int) -> str:
    words = prose(seed, 60).split()
    return " ".join([*words[:30], phrase, *words[30:]])


def test_phrases_of_ordinary_words_and_copied_passages_are_learned():
    """Words that ordinary text has too; a pair in new contexts each time, and a passage copied among documents."""
    half = [_with("verka loqui", k) for k in range(15)]
    pair = [_with(f"{'verka' if k % 2 else 'loqui'} and", 100 + k) for k in range(60)]
    passage = prose(7, 12).replace("\n", " ")
    ordinary = [*pair, *(" ".join(reversed(passage.split())) + " " + prose(200 + k, 60) for k in range(60))]
    toxic = [*half, *(_with(passage, 300 + k) for k in range(15))]
    windows = toxic_windows(toxic, ordinary, Settings())
    assert sum(b"verka loqui" in w for w in windows) == 15 and b"verka loqui" in train_dictionaries(toxic, ordinary, Settings())[1]
    assert all(any(word.encode() in w.split() for w in windows) for word in passage.split())
    assert sum(len(w.split()) for w in windows) < 15 * 40


def test_few_labels_still_tell_texts_apart(spark):
    """Where nothing marks passages all toxic text is used."""
    passage = prose(8, 30)
    rows = [(k, _with(passage, k) if k < 6 else prose(k, 90), "e", "s", 1) for k in range(40)]
    labels = spark.createDataFrame([(k, 1, int(k < 6)) for k in range(40)], "doc_id long, quality int, toxic int")
    model = fit(spark.createDataFrame(rows, DOCS), labels)
    assert model.toxic and model.weights
    found = {r.doc_id: r.score for r in score(spark.createDataFrame(rows, DOCS), model).collect()}
    # six labels do not part the texts cleanly
    assert sum(found[k] for k in range(6)) / 6 > 2 * sum(found[k] for k in range(6, 40)) / 34


def test_many_texts_under_one_labelled_id_count_once(spark):
    rows = [(1, f"bad word {k}") for k in range(500)] + [(k, f"good day number {k}") for k in range(2, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, int(k < 4)) for k in range(1, 12)], "doc_id long, toxic int")
    model = fit(docs, labels)
    assert model.prior == 3 / 11 and score(docs, model).count() == len(rows)
