"""Chat formatting at the level of tokens.

Every turn becomes segments: an opening control id, the text's ids and a closing control id
(a role without markers of its own is spelled out between two more). Texts are encoded by
themselves, the reserved ids of the controls are spliced in between, so nothing in a text can
become a control token. Control strings in a text are escaped all the same, for readers of
the plain form: a backslash goes after their first character, and one more if there are some
already, which makes it reversible. Masks come from prefix sums over segment lengths.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from spendfall.llm.byte_bpe import Coder, encode
from spendfall.llm.store import small_batches, stored

#: Control strings; their place in this list is their reserved id above the vocabulary.
CONTROLS = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[ROLE]", "[TEXT]", "[/TEXT]"]
#: Opening and closing control of each role that has its own; any other is spelled out.
MARKERS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER = ("[ROLE]", "[TEXT]", "[/TEXT]")
LEARNED = "assistant"


#: A control string, or one with backslashes after its first character.
ESCAPABLE = "|".join(f"{re.escape(first)}(?=\\\\*(?:{'|'.join(re.escape(c[1:]) for c in CONTROLS if c[0] == first)}))" for first in sorted({c[0] for c in CONTROLS}))
ESCAPED = "|".join(f"(?<={re.escape(first)})\\\\(?=\\\\*(?:{'|'.join(re.escape(c[1:]) for c in CONTROLS if c[0] == first)}))" for first in sorted({c[0] for c in CONTROLS}))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, f"({ESCAPABLE})", r"$1\\")


def unescape(text: str) -> str:
    return re.sub(ESCAPED, "", text)


def format_chat(turns: DataFrame, coder: Coder, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn: conversation, nth, start, ids and mask.

    ``ids`` are the turn's token ids with reserved ones from the vocabulary's size on,
    ``mask`` tells which of them are learned (an assistant's text), ``start`` is the place
    of the first in the conversation. Turns are ordered by turn, then role and text; null
    turns come first. Null texts and roles are empty ones. Repeated rows are turns of their
    own. Rows without a conversation form one. Other columns are not looked at.

    Turns are encoded once and stored, as they are read for their lengths and for themselves.
    Running counts are taken over blocks of 1024 turn numbers and over the blocks, so that a
    long conversation is not one task's work.
    """
    small_batches(turns.sparkSession)
    base = len(coder.pieces)
    reserved = {c: base + k for k, c in enumerate(CONTROLS)}
    rows = turns.select(F.col(conversation).alias("conversation"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    coded = encode(encode(rows.withColumn("plain", escape("text")), coder, "plain", "content"), coder, "role", "spelled")

    def by_role(pick: int) -> Column:
        out = F.array(F.lit(reserved[OTHER[2]])) if pick else F.concat(F.array(F.lit(reserved[OTHER[0]])), F.col("spelled"), F.array(F.lit(reserved[OTHER[1]])))
        for name, pair in MARKERS.items():
            out = F.when(F.col("role") == name, F.array(F.lit(reserved[pair[pick]]))).otherwise(out)
        return out

    segments = coded.withColumn("opening", by_role(0)).withColumn("closing", by_role(1))
    n = F.size("opening") + F.size("content") + F.size("closing")
    # where the text begins and where it ends: prefix sums of the segments
    begin, end = F.size("opening"), F.size("opening") + F.size("content")
    learned = F.col("role") == LEARNED
    built = segments.select(
        "conversation", "turn", "role", "text",
        F.concat("opening", "content", "closing").alias("ids"),
        F.transform(F.sequence(F.lit(0), n - 1), lambda i: learned & (i >= begin) & (i < end)).alias("mask"),
        n.alias("n"),
        F.floor(F.col("turn") / 1024).alias("block"),
    )
    built = stored(built, "turns")
    blocks = built.groupBy("conversation", "block").agg(F.sum("n").alias("tokens"), F.count("*").alias("turns"))
    ahead = Window.partitionBy("conversation").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("conversation").alias("c"), F.col("block").alias("b"), F.coalesce(F.sum("tokens").over(ahead), F.lit(0)).alias("tokens"), F.coalesce(F.sum("turns").over(ahead), F.lit(0)).alias("turns")
    )
    within = Window.partitionBy("conversation", "block").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = built.withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0))).withColumn("nth", F.count("*").over(within))
    joined = placed.join(blocks, F.col("conversation").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b")))
    return joined.select("conversation", (F.col("turns") + F.col("nth")).alias("nth"), (F.col("tokens") + F.col("before")).alias("start"), "ids", "mask").withColumnRenamed("conversation", conversation)


def _read_turn(ids: np.ndarray, mask: np.ndarray, pieces: list[bytes | None]) -> tuple[str, str, str, str]:
    """Role, text, learned text and plain form of a formatted turn."""
    base = len(pieces)

    def spelled(part: np.ndarray) -> str:
        return b"".join(pieces[k] or b"" for k in part).decode("utf-8", "replace")

    controls = np.flatnonzero(ids >= base)
    first, last = CONTROLS[ids[controls[0]] - base], int(controls[-1])
    roles = {pair[0]: name for name, pair in MARKERS.items()}
    if first in roles:
        role, begin, head = roles[first], 1, first
    else:
        begin = int(controls[1]) + 1
        role = spelled(ids[1 : begin - 1])
        head = first + role + CONTROLS[ids[begin - 1] - base]
    content = spelled(ids[begin:last])
    learned = spelled(ids[np.flatnonzero(mask & (ids < base))])
    return role, unescape(content), unescape(learned), head + content + CONTROLS[ids[last] - base]


def read_back(formatted: DataFrame, coder: Coder, conversation: str = "conv_id") -> DataFrame:
    """Per conversation, read from the formatted turns: n_turns, digests and lengths.

    A digest of a whole conversation has to see its turns in order; they pass through one
    task as a stream of which it holds one turn and the state of the digests.
    """
    pieces = coder.pieces
    key_type = to_arrow_type(formatted.schema[conversation].dataType)
    ordered = formatted.repartition(conversation).sortWithinPartitions(conversation, "nth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [conversation, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        now = None

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * 6
            types = [key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        def closed() -> tuple:
            return now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]

        for batch in batches:
            done = []
            keys, ids, masks = (batch.column(name) for name in (conversation, "ids", "mask"))
            for row, key in enumerate(keys.to_pylist()):
                if now is None or now[0] != key:
                    if now is not None:
                        done.append(closed())
                    now = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text, learned, plain = _read_turn(np.asarray(ids[row].values), np.asarray(masks[row].values.to_numpy(zero_copy_only=False)), pieces)
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
                now[3] += len(learned)
                now[4].update(learned.encode())
                now[5] += len(plain)
            yield out(done)
        if now is not None:
            yield out([closed()])

    kind = formatted.schema[conversation].dataType.simpleString()
    return ordered.select(conversation, "ids", "mask").mapInArrow(run, f"`{conversation}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

