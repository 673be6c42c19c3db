"""Repeated passages across documents, by winnowing over windows of words.

Every run of ``least`` words chooses, among the windows of half as many words inside it, the
one with the smallest hash (the last of equal ones) as its fingerprint. The choice depends on
nothing but the run's own words: wherever the run stands and however it is broken into lines,
its copies choose the same window, so none can be missed. Runs that follow each other mostly
choose the same window; together they are its stretch of words.

Runs are then looked up by what they say, never by pairs of documents: a stretch that equals
one of a smaller id is deleted as a whole. Where a fingerprint has stretches that differ, the
runs of the first stretch of each kind are looked up one by one. Repeats inside a document
are found where its fingerprints are made. Work and rows grow with the words, whatever number
of documents share a passage and however often a document repeats itself.

Equal means equal hashes of 128 bits. A deleted word always points to an equal, strictly
earlier one, hence the first of each passage stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendfall.llm.store import dropped, small_batches, stored
from spendfall.llm.textbytes import Texts, run_hashes, slices

#: Schema of fingerprints; without a print it is a range of words that repeats earlier ones of its document.
MARKS = "print long, context long, id long, doc long, start int, size int"


def _repeats(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the ranges of one text that are runs of ``least`` words standing further up."""
    begin = np.arange(len(words) - least + 1)
    later = np.ones(len(begin), bool)
    later[np.unique(run_hashes(words, begin, begin + least), return_index=True)[1]] = False
    edges = np.diff(np.concatenate(([0], later.view(np.int8), [0])))
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return start, end - start + least - 1


def _fingerprints(column: pa.Array, least: int) -> tuple[np.ndarray, ...]:
    """Prints, hashes of their stretches, texts, first words and sizes; then texts, first words and sizes of own repeats.

    Of equal stretches in one text only the first is given, the others are own repeats.
    """
    texts = Texts.of(column)
    starts, ends = texts.words()
    counts = texts.counts(starts)
    none = np.zeros(0, np.int64)
    if not (counts >= least).any():
        return (none,) * 8
    words = texts.hashes(starts, ends)
    owner = np.repeat(np.arange(len(texts)), counts)
    first = np.cumsum(counts) - counts
    half = (least + 1) // 2
    span = least - half + 1
    begin = np.arange(len(words) - half + 1)
    hashes = run_hashes(words, begin, begin + half)
    begin = np.flatnonzero(owner[: len(words) - least + 1] == owner[least - 1 :])
    at = (span - 1 - sliding_window_view(hashes, span)[:, ::-1].argmin(1))[begin] + begin
    new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    low, stop = begin[new], begin[np.append(new[1:], len(begin)) - 1] + least
    prints, context, of = hashes[at[new]], run_hashes(words, low, stop), owner[low]
    order = np.lexsort((context, prints, of))
    p, c, o = prints[order], context[order], of[order]
    again = (p[1:] == p[:-1]) & (o[1:] == o[:-1])
    keep = order[np.concatenate(([True], ~(again & (c[1:] == c[:-1]))))]
    own: tuple[list, list, list] = ([], [], [])
    for text in np.unique(o[1:][again]):
        for part, values in zip(own[1:], _repeats(words[first[text] : first[text] + counts[text]], least), strict=True):
            part.append(values)
        own[0].append(np.full(len(own[1][-1]), text))
    return prints[keep].view(np.int64), context[keep].view(np.int64), of[keep], (low - first[of])[keep], (stop - low)[keep], *(np.concatenate([none, *part]) for part in own)


def fingerprints(docs: DataFrame, id_col: str, text: str, least: int) -> DataFrame:
    """Fingerprints with their stretches, and the ranges that repeat earlier words of the same row (without a print).

    ``doc`` tells rows of one id with different texts apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                prints, context, of, start, size, own, own_start, own_size = _fingerprints(part.column("text"), least)
                rows = pa.array(np.concatenate((of, own)))
                no = pa.nulls(len(own), pa.int64())
                keys = [pa.concat_arrays([pa.array(x), no]) for x in (prints, context)]
                places = [pa.array(np.concatenate(x).astype(np.int32)) for x in ((start, own_start), (size, own_size))]
                yield pa.RecordBatch.from_arrays([*keys, part.column("id").take(rows), part.column("doc").take(rows), *places], names=["print", "context", "id", "doc", "start", "size"])

    return _keyed(docs, id_col, text).mapInArrow(run, MARKS)


def _keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("doc"), F.col(text).alias("text"))


def _packed() -> Column:
    """A range of words as one number: its start, then its size."""
    return F.shiftleft(F.col("start").cast("long"), 32).bitwiseOR(F.col("size").cast("long"))


def _unpacked(ranges: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    values = np.asarray(ranges, np.int64)
    return values >> 32, values & 0xFFFFFFFF


def _single_runs(docs: DataFrame, wanted: DataFrame, id_col: str, text: str, least: int) -> DataFrame:
    """(run, half, id, doc, start): every run of ``least`` words in the wanted stretches, by hashes of all and half of it.

    ``wanted`` has one row per document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                flat = Texts.of(batch.column("text").slice(row, 1))
                words = flat.hashes(*flat.words())
                low, size = _unpacked(batch.column("ranges")[row].values)
                n = size - least + 1
                begin = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
                ids = [pa.array(np.full(len(begin), batch.column(name)[row].as_py(), np.int64)) for name in ("id", "doc")]
                hashes = [pa.array(run_hashes(words, begin, begin + k).view(np.int64)) for k in (least, (least + 1) // 2)]
                yield pa.RecordBatch.from_arrays([*hashes, *ids, pa.array(begin.astype(np.int32))], names=["run", "half", "id", "doc", "start"])

    return _keyed(docs, id_col, text).join(wanted, ["id", "doc"]).mapInArrow(run, "run long, half long, id long, doc long, start int")


def _without(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    """The text without these ranges of words, which are in order. A line that keeps words keeps its end."""
    flat = Texts(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    starts, ends = flat.words()
    out, done = [], 0
    for a, b in runs:
        out.append(text[done : starts[a]])
        done = int(starts[b]) if b < len(starts) else len(text)
        left = int(ends[a - 1]) if a else 0
        if a and b < len(starts) and b"\n" not in text[left : starts[a]] and b"\n" in text[ends[b - 1] : done]:
            out[-1] = out[-1].rstrip(b" \t") + b"\n"
    out.append(text[done:])
    return b"".join(out).rstrip() if runs and done == len(text) else b"".join(out)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = 50) -> DataFrame:
    """All rows of ``docs``, with ``text`` less the repeated runs, n_words, n_deleted and runs.

    A run of ``least`` words or more (words in order, whatever white space is between them,
    line feeds too) that equals one in a document with a smaller id, or one further up in the
    same document, is deleted; ``runs`` has the deleted word ranges (start, end), those that
    meet as one, ``n_words`` the words before. Texts without words, shorter texts, null texts
    and rows without an id stay as they are. Rows of the same id are not compared with each
    other. Other columns stay; existing ones named like the three new ones are replaced. Ids
    are integers.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("n_words", "n_deleted", "runs")
    marks = stored(fingerprints(docs, id_col, text, least), "marks")
    # most fingerprints stand once and go first, by a count that shuffles nothing but them
    often = marks.where("print is not null").groupBy("print").agg(F.count("*").alias("n"), (F.min("context") < F.max("context")).alias("several")).where("n > 1")
    shared = stored(marks.join(often.drop("n"), "print"), "shared")
    first = shared.groupBy("print", "context").agg(F.min("id").alias("first"))
    placed = shared.join(first, ["print", "context"])
    whole = placed.where("id > first").select("id", "doc", _packed().alias("range"))
    # the first of each kind has every run that its later copies have
    wanted = placed.where("id = first and several").groupBy("id", "doc").agg(F.collect_list(_packed()).alias("ranges"))
    single = stored(_single_runs(docs, wanted, id_col, text, least), "runs")
    earliest = single.groupBy("run", "half").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("last > first")
    partly = single.join(earliest, ["run", "half"]).where("id > first").select("id", "doc", F.col("start"), F.lit(least).alias("size"))
    own = marks.where("print is null").select("id", "doc", _packed().alias("range"))
    every = whole.unionAll(partly.select("id", "doc", _packed().alias("range"))).unionAll(own)
    ranges = stored(every.groupBy("id", "doc").agg(F.collect_list("range").alias("ranges")), "ranges")
    dropped(marks, shared, single)
    found = docs.join(ranges, (docs[id_col] == ranges["id"]) & (F.xxhash64(docs[text]) == ranges["doc"]), "left")
    return _cleaned(found.select(*(docs[name] for name in docs.columns), ranges["ranges"]), docs.schema, text)


def _merged(ranges: pa.Array) -> list[tuple[int, int]]:
    """Ranges of words in order, those that meet as one."""
    start, size = _unpacked(ranges)
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate((start + size)[order])
    new = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
    return list(zip(start[new].tolist(), end[np.append(new[1:], len(end)) - 1].tolist(), strict=True))


def _cleaned(docs: DataFrame, schema: T.StructType, text: str) -> DataFrame:
    """Take the ranges, the last column of ``docs``, out of the texts."""
    names = schema.names
    spans = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    out = T.StructType([*schema.fields, *(T.StructField(name, T.IntegerType()) for name in ("n_words", "n_deleted")), T.StructField("runs", spans)])
    place = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns[: len(names)]
            texts, ranges = columns[place], batch.column(len(names))
            kept, cut, deleted = None, [[] for _ in range(len(texts))], np.zeros(len(texts), np.int32)
            for row in np.flatnonzero(np.asarray(ranges.is_valid())):
                kept = texts.to_pylist() if kept is None else kept
                cut[row] = _merged(ranges[row].values)
                kept[row] = _without(kept[row].encode(), cut[row]).decode()
                deleted[row] = sum(b - a for a, b in cut[row])
            flat = Texts.of(texts)
            n_words = flat.counts(flat.words()[0])
            if kept is not None:
                columns[place] = pa.array(kept, texts.type)
            lists = pa.array([[{"start": a, "end": b} for a, b in x] for x in cut], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_words.astype(np.int32)), pa.array(deleted), lists], names=out.names)

    return docs.mapInArrow(run, out)
