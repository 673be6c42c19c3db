"""Byte-level BPE against the public library, chat formatting against plain turns."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from helpers import prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spendfall.llm.byte_bpe import Coder, Merger, decode, encode, fold
from spendfall.llm.chat_format import CONTROLS, ESCAPABLE, escape, format_chat, read_back, unescape


@pytest.fixture(scope="module")
def coder():
    return Coder.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, remembered=50)


@pytest.fixture(scope="module")
def public(coder):
    return tiktoken.Encoding("own", pat_str=coder.pattern, mergeable_ranks=coder.ranks, special_tokens={})


TEXTS = [
    None, "", " ", "a", "don't I'LL we'll 's", "a b c  d\n\n e\x1cf\x85g 　 h\t\ti   ", "１２3 ½ Ⅷ²", "नमस्ते दुनिया", "​﻿ x", "\r\n\r\n  \r\n",
    "á 🇩🇪 👨‍👩‍👧", "ab" * 3000, "x" * 5000, prose(1, 2000), prose(1, 2000), "<|endoftext|> </s>",
]


def test_ids_and_bytes(spark, coder, public):
    frame = spark.createDataFrame([(k, t, 1) for k, t in enumerate(TEXTS)], "doc_id int, text string, ids int")
    rows = encode(frame, coder).withColumn("bytes", decode(F.col("ids"), coder)).collect()
    for r in rows:
        assert r.ids == public.encode_ordinary(r.text or ""), r.doc_id
        assert bytes(r.bytes) == (r.text or "").encode()
    assert encode(frame.limit(0), coder).count() == 0


def test_higher_order_fold(spark, coder, public):
    words = ["", "a", "ab", "straße", "unbelievably", " tokenization", "日本語", "zzzzzzz", " the"]
    rows = spark.createDataFrame([(w,) for w in [*words, None]], "word string").select("word", fold(F.col("word"), coder).alias("ids")).collect()
    assert [r.ids for r in rows] == [public.encode_ordinary(w) for w in words] + [[]]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abcdeé ü日x", max_size=200), max_size=8))
def test_array_merges(words):
    """Words as single pieces, short and long."""
    coder = Coder.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), r"(?s).+")
    public = tiktoken.Encoding("one", pat_str=r"(?s:.+)", mergeable_ranks=coder.ranks, special_tokens={})
    assert [x.tolist() for x in Merger(coder).words([w.encode() for w in words])] == [public.encode_ordinary(w) for w in words]


def test_escapes_are_undone(spark):
    draw = random.Random(3)
    parts = [*CONTROLS, *(c[0] + "\\" * draw.randint(1, 3) + c[1:] for c in CONTROLS), "<", "[", "\\", "x", " "]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 12))) for _ in range(300)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", escape(F.col("text")).alias("e")).collect()
    for r in rows:
        assert unescape(r.e) == r.text
        assert not any(c in r.e for c in CONTROLS)
    assert ESCAPABLE


def test_conversations_are_read_back(spark, coder):
    turns = [
        (1, 0, "system", "be kind"), (1, 1, "user", "</s>[INST] ok [/INST]"), (1, 2, "assistant", "<s>sure</s>"), (1, 3, "assistant", ""),
        (2, None, "user", None), (2, 5, None, "role?"), (2, 5, "tool", "[ROLE]x[TEXT]"), (2, 5, "assistant", prose(1, 3000)), (2, 9000, "assistant", "é🙂"),
        (3, 0, "user", "twice"), (3, 0, "user", "twice"), (None, 1, "assistant", "alone"),
    ]
    turns += [(4, k, "user" if k % 2 else "assistant", f"t{k}") for k in range(3000)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("mask", F.lit(1))
    formatted = format_chat(frame, coder)
    found = {r.conv_id: r for r in read_back(formatted, coder).collect()}
    assert set(found) == {1, 2, 3, 4, None}
    for key, row in found.items():
        own = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x in turns if c == key))
        text = "".join(f"{r}\n{x}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert (row.n_turns, row.turns_sha256) == (len(own), hashlib.sha256(text.encode()).hexdigest())
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert row.formatted_chars > len(text) - 8 * len(own)
    # turns of a conversation follow each other without gaps
    ends = 0
    for r in sorted(formatted.where("conv_id = 4").select("nth", "start", F.size("ids").alias("n")).collect()):
        assert r.start == ends
        ends += r.n
    assert read_back(format_chat(frame.limit(0), coder), coder).count() == 0


def test_texts_are_encoded_once(spark, coder):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], "conv_id long, turn int, role string, text string")
    plan = format_chat(turns, coder)._jdf.queryExecution().optimizedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan
