"""Repeated passages against a look at every run of words."""

from __future__ import annotations

from helpers import DOCS, prose, WORD, repeated_words

from spendfall.llm.line_dedup import fingerprints, line_dedup


def _texts() -> dict[int, str]:
    passage, short = prose(77, 70), prose(78, 40)
    texts = {k: prose(k, 150 + 10 * k) for k in range(1, 9)}
    for k in (2, 3, 5, 8):
        words = texts[k].split(" ")
        texts[k] = " ".join(words[:37]) + " " + passage + " " + " ".join(words[37:])
    texts[4] += " " + short
    texts[6] = short + "\n" + texts[6]
    texts[20] = texts[1]
    texts[21] = prose(21, 60) + "\n" + prose(22, 90) + "\n" + prose(21, 60) + "\nend"
    texts[22] = prose(23, 6000) + " " + passage
    return texts


def test_every_repeated_run_goes_and_nothing_else(spark):
    texts = _texts()
    frame = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "doc_id long, text string, runs string")
    rows = {r.doc_id: r for r in line_dedup(frame).collect()}
    expected = repeated_words(texts, 50)
    assert any(expected[8]) and all(expected[20]) and not any(expected[6])
    for k, text in texts.items():
        deleted = [False] * rows[k].n_words
        for run in rows[k].runs:
            deleted[run.start : run.end] = [True] * (run.end - run.start)
        assert deleted == expected[k], k
        assert WORD.findall(rows[k].text) == [w for w, gone in zip(WORD.findall(text), deleted, strict=True) if not gone]
        assert rows[k].n_deleted == sum(deleted)
    assert rows[1].text == texts[1] and rows[20].text == ""


def test_missing_values_repeated_rows_and_no_rows(spark):
    long = prose(5, 80)
    data = [(None, long, "en", "s", 1), (None, long, "en", "s", 1), (1, None, None, None, None), (2, "", "en", "s", 0), (3, long, "en", "s", 1), (3, long, "en", "s", 1)]
    out = line_dedup(spark.createDataFrame(data, DOCS))
    rows = out.collect()
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_words", "n_deleted", "runs"]
    assert len(rows) == 6 and sum(r.text == long for r in rows) == 4 and all(r.n_deleted == 0 for r in rows)
    assert line_dedup(spark.createDataFrame([], DOCS)).count() == 0


def _deleted(spark, texts: dict[int, str]) -> dict[int, list[bool]]:
    found = {}
    for r in line_dedup(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect():
        found[r.doc_id] = [False] * r.n_words
        for run in r.runs:
            found[r.doc_id][run.start : run.end] = [True] * (run.end - run.start)
        assert r.n_deleted == sum(found[r.doc_id])
    return found


def test_a_part_of_the_passage_stands_first(spark):
    """An earlier document with 40 words of a passage hides none of its copies from each other."""
    texts = {}
    for k in range(150):
        passage = prose(1000 + k, 55).split()
        texts[3 * k] = " ".join([*prose(2000 + k, 20).split(), *passage[:40], *prose(3000 + k, 20).split()])
        texts[3 * k + 1] = " ".join([*prose(4000 + k, 20).split(), *passage, *prose(5000 + k, 20).split()])
        texts[3 * k + 2] = " ".join([*prose(6000 + k, 25).split(), *passage, *prose(7000 + k, 15).split()])
    expected = repeated_words(texts, 50)
    assert all(sum(expected[3 * k + 2]) >= 55 for k in range(150))
    assert _deleted(spark, texts) == expected


def test_line_feeds_and_places_do_not_matter(spark):
    """Passages of just 50 words, each copy broken into lines otherwise."""
    texts = {}
    for k in range(400):
        passage = prose(10_000 + k, 50).split()
        for copy in range(2):
            broken = "".join(w + ("\n" if (p + k) % (7 + 5 * copy) == 0 else "  " if copy else " ") for p, w in enumerate(passage))
            texts[2 * k + copy] = prose(20_000 + 2 * k + copy, k % 30) + " " + broken + " " + prose(30_000 + 2 * k + copy, 10)
    expected = repeated_words(texts, 50)
    assert all(sum(expected[2 * k + 1]) >= 50 for k in range(400))
    assert _deleted(spark, texts) == expected


def test_rows_grow_with_the_words_and_not_with_repeats_or_sharers(spark):
    """A periodic text, one of a single word, and a passage in many documents make few rows."""
    period = prose(1, 20).split()
    texts = {1: " ".join(period * 400), 2: " ".join(["word"] * 8000), 3: " ".join(period * 200)}
    passage = prose(2, 60)
    texts |= {10 + k: prose(100 + k, 30) + " " + passage + " " + prose(300 + k, 30) for k in range(100)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    marks = fingerprints(frame, "doc_id", "text", 50)
    assert marks.where("id < 4").count() <= 20
    found, expected = _deleted(spark, texts), repeated_words(texts, 50)
    assert found == expected and sum(found[1]) == 8000 - 20 and sum(found[2]) == 8000 - 1 and all(found[3])


def test_rows_of_one_id_are_cut_each_by_its_own_repeats(spark):
    passage, other = prose(3, 60), prose(4, 30)
    rows = [(1, passage + " " + other + " " + passage), (1, other + " " + passage), (1, passage + " " + other + " " + passage)]
    out = line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.n_words, r.n_deleted) for r in out) == [(90, 0), (150, 60), (150, 60)]
