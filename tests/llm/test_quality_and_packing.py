"""Quality rules against plain counts, and packing against its own promises."""

from __future__ import annotations

import numpy as np
from helpers import DOCS, prose, base_counts
from hypothesis import given, settings
from hypothesis import strategies as st

from spendfall.llm.packing import Plan, pack, pack_shard
from spendfall.llm.quality_rules import jensen_shannon, quality_rules


def _documents() -> list[tuple]:
    rows = [(k, prose(k, 120), "xx", "s", 1) for k in range(80)]
    rows += [(100 + k, prose(k + 500, 120).upper().replace(" ", "!! "), "xx", "s", 1) for k in range(3)]
    rows += [(200, None, "xx", "s", 1), (201, "", None, "s", 1), (202, "ä b\nä b\n\n #x a b c d e a b c d e", "xx", "s", 1), (203, "few words only", "xx", "s", 1)]
    rows += [(204, prose(9, 40), None, "s", 1), (205, "same words again here now " * 9, "xx", "s", 1), (205, "same words again here now " * 9, "xx", "s", 1)]
    return rows


def test_counts_and_verdicts(spark):
    data = _documents()
    rows = quality_rules(spark.createDataFrame(data, DOCS)).collect()
    texts = {d[0]: d[1] for d in data}
    assert len(rows) == len(data)
    for r in rows:
        counts = base_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (r.kept and r.base_failed)
    kept = {r.doc_id: r.kept for r in rows}
    assert all(kept[k] for k in range(80)) and not any(kept[k] for k in (100, 101, 102, 200, 201, 203, 205))
    # below the least length nothing is compared
    short = next(r for r in rows if r.doc_id == 202)
    assert short.class_distance is None and short.word_distance is None


def _greek(seed: int) -> str:
    return prose(seed, 120).translate(str.maketrans("abcdefghijklmnopqrstuvwxyz", "αβψδεφγηιξκλμνοπρστθωςχυζϊ"))


def test_rare_languages_are_not_judged_by_others(spark):
    """Sixty clean documents among many, ten of a language with few others, and many without a language."""
    data = [(k, prose(k, 40), None if k % 2 else "xx", "s", 1) for k in range(70_000, 70_400)]
    data += [(k, _greek(k), "el", "s", 1) for k in range(60)] + [(100 + k, _greek(100 + k), "gr", "s", 1) for k in range(10)]
    data += [(200, prose(200, 120).upper().replace(" ", "!! "), "el", "s", 1)]
    rows = {r.doc_id: r for r in quality_rules(spark.createDataFrame(data, DOCS)).collect()}
    assert all(rows[k].kept and rows[k].class_distance < 0.2 for k in range(60)) and not rows[200].kept
    assert all(rows[100 + k].kept and rows[100 + k].class_distance < 0.2 for k in range(10))


def test_nothing_jumps_with_the_size_of_a_language(spark):
    """The same odd document among 40 to 60 others, and alone: distances and verdicts follow the size step by step."""
    odd = prose(200, 120).upper().replace(" ", "!! ")
    data = [(n * 1000 + k, prose(k, 120), f"x{n}", "s", 1) for n in (40, 49, 50, 60) for k in range(n)] + [(n * 1000 + 999, odd, f"x{n}", "s", 1) for n in (0, 40, 49, 50, 60)]
    rows = {r.doc_id: r for r in quality_rules(spark.createDataFrame(data, DOCS)).collect()}
    far = [rows[n * 1000 + 999].class_distance for n in (40, 49, 50, 60)]
    assert max(far) - min(far) < 0.02 and not any(rows[n * 1000 + 999].kept for n in (40, 49, 50, 60))
    assert rows[999].class_distance < 1e-6 and rows[999].kept
    assert all(rows[n * 1000 + k].kept for n in (40, 49, 50, 60) for k in range(n))


def test_a_small_share_of_the_documents_is_enough_for_a_reference(spark):
    """A language of 60 documents among 60,060 is judged as it is by itself."""
    many = spark.range(1000, 61_000).selectExpr("id as doc_id", "repeat('ka lo mi ner sha tu ', 6) as text", "'xx' as lang")
    few = spark.createDataFrame([(k, _greek(k), "el") for k in range(60)], "doc_id long, text string, lang string")
    alone, among = ({r.doc_id: (r.class_distance, r.kept) for r in quality_rules(d).where("lang = 'el'").collect()} for d in (few, few.union(many)))
    assert all(abs(alone[k][0] - among[k][0]) < 1e-9 and among[k][1] for k in range(60))


def test_equal_rows_do_not_meet_in_one_shard(spark):
    data = [(7, "same words again", "e", "s", 1)] * 2000 + [(k, prose(k, 3), "e", "s", 1) for k in range(2000)]
    frame = pack(spark.createDataFrame(data, DOCS), plan=Plan(shard_words=1000)).toPandas()
    assert len(frame) == 4000
    sizes = frame.groupby("shard")["size"].sum()
    assert len(sizes) >= 10 and sizes.max() < 3 * sizes.median()


def test_no_rows(spark):
    assert quality_rules(spark.createDataFrame([], DOCS)).count() == 0


def test_distance_of_equal_and_disjoint_shares():
    p = np.array([[0.5, 0.5, 0.0], [1.0, 0.0, 0.0]])
    q = np.array([[0.5, 0.5, 0.0], [0.0, 0.0, 1.0]])
    assert jensen_shannon(p, q).tolist() == [0.0, 1.0]


def test_every_word_has_one_place(spark):
    data = [(k, prose(k, 1 + 37 * k), "e", "s", 1) for k in range(60)] + [(70, prose(1, 9001), "e", "s", 1), (71, None, "e", "s", 1), (72, " ", "e", "s", 1), (3, prose(3, 112), "e", "s", 1), (None, "a b", "e", "s", 1)]
    frame = pack(spark.createDataFrame(data, DOCS), plan=Plan(shard_words=8000)).toPandas()
    assert frame["size"].sum() == sum(len((d[1] or "").split()) for d in data)
    assert frame["shard"].nunique() > 1
    for _, one in frame.groupby(["shard", "sequence"]):
        one = one[one["size"] > 0].sort_values("offset")
        assert (one["offset"].to_numpy() == np.cumsum(one["size"]) - one["size"]).all()
        if len(one):
            length, content = one["length"].iloc[0], one["size"].sum()
            assert content == one["content"].iloc[0] and length in Plan().lengths and length == min(x for x in Plan().lengths if x >= content)
    cut = frame[frame["doc_id"] == 70].sort_values("piece")
    assert cut["start"].tolist() == [0, 4096, 8192] and cut["size"].tolist() == [4096, 4096, 809]
    assert pack(spark.createDataFrame([], DOCS)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=60))
def test_shards_are_packed_no_worse_than_one_length(sizes):
    plan = Plan(lengths=(16, 32, 64), fixed=1.0, knee=1000.0)
    sizes = np.sort(np.array(sizes))[::-1]
    sequence, offset, length, content = pack_shard(sizes, plan)
    for k in np.unique(sequence):
        own = sequence == k
        assert sizes[own].sum() == content[own][0] <= length[own][0]
        assert sorted(zip(offset[own], sizes[own], strict=True))[0][0] == 0
    cost = sum(plan.cost(int(length[sequence == k][0])) for k in np.unique(sequence))
    full = []
    for size in sizes:
        room = [(64 - used - size, k) for k, used in enumerate(full) if used + size <= 64]
        if room:
            full[min(room)[1]] += size
        else:
            full.append(size)
    assert cost <= len(full) * plan.cost(64) + 1e-9
