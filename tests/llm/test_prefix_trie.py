"""Prefix trie against one built prefix by prefix."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

from spendfall.llm import prefix_trie as trie
from spendfall.llm.queries import op13_prefix_trie, rebuilt_trie

ROWS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def key(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def model(rows: list[tuple]) -> list[tuple]:
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, role.encode(), key(role, text), role, text))
    own = {c: [(x[4], x[5]) for x in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 6, c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for prefix, ids in members.items():
        inside = [p for p in members if p[: len(prefix)] == prefix]
        parents = {p[:-1] for p in members if p}
        ends = ",".join(str(c) for c in sorted(c for c in ids if len(rebuilt[c]) == len(prefix)))
        out.append((
            min(ids), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(ids), sum(p[:-1] == prefix for p in members if p),
            sum(p not in parents for p in inside), sum((len(members[p]) - 1) * len(p[-1][1]) for p in inside if p), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(frame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=str)


def made(seed: int) -> list[tuple]:
    """Conversations that share starts of many lengths, turns out of order."""
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-30, 430), 120):
        length = draw.choice([0, 1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17])
        rows += [(c, t, draw.choice(["user", "assistant"]) if draw.random() < 0.1 else "user", draw.choice("ab") if draw.random() < 0.2 else "ü") for t in range(length)]
    draw.shuffle(rows)
    return rows


def test_nodes_equal_those_of_all_prefixes(spark):
    rows = made(1)
    assert found(rebuilt_trie(spark.createDataFrame(rows, ROWS).repartition(4))) == model(rows)


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [
        (0, None, None, "first"),
        (0, 3, "user", None),
        (0, 3, "user", ""),
        (0, 3, "assistant", "ab" * 100_000),
        (0, 3, "assistant", "ab" * 100_000),
        (1, None, "", "first"),
        (None, 0, "user", "lost"),
        (5, 1, "user", "x"),
        (5, 1, "user", "x"),
        (300, 9, "a", "bc"),
        (301, 9, "ab", "c"),
        (302, 9, "a", "bc"),
    ]
    assert found(rebuilt_trie(spark.createDataFrame(rows, ROWS))) == model(rows)


def test_many_ends_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(trie, "ENDS", 7)
    rows = [(c, t, "user", "same") for c in range(1, 60) for t in range(8)] + [(c, 0, "user", f"{c}") for c in range(200, 260)]
    assert found(rebuilt_trie(spark.createDataFrame(rows, ROWS).repartition(3))) == model(rows)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], ROWS)
    assert found(rebuilt_trie(empty)) == []
    frame = spark.createDataFrame([(c, t, "user", f"{t}") for c in (0, 7) for t in range(3)], ROWS)
    wide = frame.selectExpr("*", *(f"1 as {name}" for name in ("pos", "key", "chars", "total", "idx", "len", "n", "root", "start", "place", "depth")))
    assert found(rebuilt_trie(wide)) == found(rebuilt_trie(frame))


def test_conversations_without_turns_end_at_the_root(spark):
    turns = spark.createDataFrame([], "conv_id long, pos long, key binary, chars long")
    nodes, ends = trie.prefix_trie(turns, spark.createDataFrame([(3, 0), (9, 0)], "conv_id long, len long"))
    assert [tuple(r) for r in nodes.collect()] == [(3, 0, None, 2, 0, 1, 0)]
    assert sorted(tuple(r) for r in ends.collect()) == [(3, 0, 3), (9, 0, 3)]


def test_query_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(op13_prefix_trie(spark, folder)) == model(rows)
