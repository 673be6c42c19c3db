"""Best-fit packing of texts into training sequences of several permitted lengths.

Texts longer than the largest length are cut into pieces of it and a rest. Pieces are dealt
to shards of about equal content by a hash of their text and place, so that no shard depends
on a document's key, and each shard is packed by itself: longest piece first, into the open
sequence it fills best. When none has room, a sequence is opened at the length with the
least cost for each word it can be filled with. Each shard is packed for every permitted
largest length, with sequences opened by cost and all at that length, and the plan of least
cost is taken; finally every sequence is cut
down to the smallest permitted length that holds its content.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendfall.llm.store import small_batches, stored
from spendfall.llm.textbytes import Texts, slices


@dataclass(frozen=True)
class Plan:
    """Permitted sequence lengths in words, and the cost of a sequence: ``fixed + length + length**2 / knee``."""

    lengths: tuple[int, ...] = (256, 512, 1024, 2048, 4096)
    fixed: float = 16.0
    knee: float = 65536.0
    #: Words in a shard; each of a shard's pieces counts as one word at least.
    shard_words: int = 1_000_000

    def cost(self, length: int) -> float:
        return self.fixed + length + length * length / self.knee


def _pack(sizes: np.ndarray, plan: Plan, largest: int, by_cost: bool) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Sequence and offset of each piece (sizes descending), and the words in each sequence."""
    lengths = [x for x in plan.lengths if x <= largest]
    waiting = int(sizes.sum())
    # sequences by room left; a bit of ``has`` tells where there is one
    by_room: list[list[int]] = [[] for _ in range(largest + 1)]
    has = 0
    used: list[int] = []
    sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for k, size in enumerate(sizes.tolist()):
        fitting = has >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            own = by_room[room].pop()
            if not by_room[room]:
                has ^= 1 << room
        else:
            fill = max(1, waiting)
            room = min((plan.cost(x) / min(x, fill), x) for x in lengths if x >= size)[1] if by_cost else largest
            own = len(used)
            used.append(0)
        sequence[k], offset[k] = own, used[own]
        used[own] += size
        waiting -= size
        if room > size:
            by_room[room - size].append(own)
            has |= 1 << (room - size)
    return sequence, offset, used


def pack_shard(sizes: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sequence, offset, permitted length and content for each piece; ``sizes`` must descend."""
    best = None
    for largest in sorted(plan.lengths, reverse=True):
        if len(sizes) and sizes[0] > largest:
            break
        for by_cost in (True, False):
            sequence, offset, used = _pack(sizes, plan, largest, by_cost)
            fits = np.array(sorted(plan.lengths))[np.searchsorted(sorted(plan.lengths), used)]
            total = sum(plan.cost(int(x)) for x in fits)
            if best is None or total < best[0]:
                best = total, sequence, offset, fits[sequence], np.array(used)[sequence]
    return best[1:] if best else (np.zeros(0, np.int64),) * 4


def pieces(docs: DataFrame, id_col: str, text: str, largest: int) -> DataFrame:
    """(id, piece, start, size, mark): word ranges of at most ``largest`` words that make up each text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                texts = Texts.of(part.column(text))
                n = texts.counts(texts.words()[0])
                marks = texts.hashes(texts.offsets[:-1], texts.offsets[1:])
                times = np.maximum(1, -(-n // largest))
                row = np.repeat(np.arange(len(n)), times)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                start = piece * largest
                size = np.minimum(largest, n[row] - start)
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col).cast(pa.int64()).take(pa.array(row)), *(pa.array(x.astype(np.int32)) for x in (piece, start, size)), pa.array(marks[row].view(np.int64))],
                    names=["id", "piece", "start", "size", "mark"],
                )

    return docs.select(id_col, text).mapInArrow(run, "id long, piece int, start int, size int, mark long")


def pack(docs: DataFrame, id_col: str = "doc_id", text: str = "text", plan: Plan | None = None) -> DataFrame:
    """One row per piece: where it comes from (id, piece, start, size) and where it goes.

    ``shard`` and ``sequence`` name the training sequence, ``offset`` is the place in it,
    ``length`` its permitted length and ``content`` the words it holds. Null, empty and
    wordless texts, for which there is nothing to train on, are one piece of no words that
    takes a place but no room. Repeated rows are packed as often as they occur; rows
    without an id too. The result does not depend on the order of the rows but for which
    of two equal pieces of one id comes first. Other columns are not looked at.
    """
    plan = plan or Plan()
    # equal pieces are counted and dealt out by their number, so that they do not meet in one shard
    key = ["id", "piece", "start", "size", "mark"]
    counted = pieces(docs, id_col, text, max(plan.lengths)).groupBy(*key).agg(F.count("*").alias("copies"))
    cut = stored(counted.select(*key, F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")), "pieces")
    total = cut.agg(F.sum(F.greatest("size", F.lit(1)))).first()[0] or 0
    shards = max(1, -(-total // plan.shard_words))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "mark", "id", "piece"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        some = int((frame["size"] > 0).sum())
        sequence, offset, length, content = (np.zeros(len(frame), np.int64) for _ in range(4))
        if some:
            for store, values in zip((sequence, offset, length, content), pack_shard(frame["size"].to_numpy()[:some], plan), strict=True):
                store[:some] = values
        # pieces of no words go to the end of the last sequence, or to an empty one of the least length
        last = int(sequence[:some].max()) if some else 0
        sequence[some:] = last
        at = sequence[:some] == last
        offset[some:] = content[some:] = int(content[:some][at][0]) if some else 0
        length[some:] = int(length[:some][at][0]) if some else min(plan.lengths)
        return frame.assign(sequence=sequence, offset=offset, length=length, content=content)[["shard", "sequence", "offset", "length", "content", "id", "piece", "start", "size"]]

    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("mark", "id", "piece", "copy"), F.lit(shards)))
    packed = dealt.drop("copy").groupBy("shard").applyInPandas(run, "shard long, sequence long, offset long, length long, content long, id long, piece int, start int, size int")
    return packed.withColumnRenamed("id", id_col)
