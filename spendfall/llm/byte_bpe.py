"""Byte-level BPE: ranked merges folded over distinct words, decoding by binary pieces.

A rank file becomes a literal map from pairs of token ids to the id (= rank) of what they
merge into, split over many small maps so that a look-up reads one or two entries. ``fold``
encodes a word with Spark's higher-order functions: in every step the pair of least rank,
leftmost first, becomes one token, until no pair has a rank.

A corpus is encoded word by word, each distinct word of a slice once, by the same merges
over all its words at a time as arrays (``Merger``): the higher-order functions take 136
microseconds a word, and their literal map brings a driver to 1.5 GB, which is more than a
corpus with millions of rare words allows. No text and no word is shuffled. Decoding looks
up every id in a literal array of pieces and concatenates them.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendfall.llm.store import small_batches

#: Fixed value: white space as Unicode defines it, which the splitting pattern means by \\s.
WHITE = r"\t-\r \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: More than any id.
NONE = 1 << 30
SMALL_MAPS = 1 << 16


def java_pattern(pattern: str) -> str:
    """The splitting pattern for Java, whose \\s is ASCII only."""
    return pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"(?!\S)", f"(?![^{WHITE}])").replace(r"\s", f"[{WHITE}]")


@dataclass(frozen=True)
class Coder:
    """A rank file and its splitting pattern."""

    ranks: dict[bytes, int]
    pattern: str
    #: Words whose ids a Python worker keeps for its next slices.
    remembered: int = 400_000

    @classmethod
    def load(cls, path: str, pattern: str, **more: int) -> Coder:
        """Read a rank file (base64 token and rank in each line) on the driver."""
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        return cls(ranks, pattern, **more)

    @cached_property
    def merges(self) -> dict[tuple[int, int], int]:
        """What each pair of tokens merges into."""
        return {
            (left, right): rank
            for token, rank in self.ranks.items()
            for k in range(1, len(token))
            if (left := self.ranks.get(token[:k])) is not None and (right := self.ranks.get(token[k:])) is not None
        }

    @cached_property
    def pieces(self) -> list[bytes | None]:
        out: list[bytes | None] = [None] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            out[rank] = token
        return out


def _merge_maps(coder: Coder) -> str:
    """The maps as JSON; parsing it is folded into a literal when a plan is optimised."""
    small: list[list[str]] = [[] for _ in range(SMALL_MAPS)]
    for (left, right), merged in coder.merges.items():
        key = left * 65536 + right
        small[_small_map(left, right)].append(f'"{key}":{merged}')
    return "[" + ",".join("{" + ",".join(entries) + "}" for entries in small) + "]"


def _small_map(left: int, right: int) -> int:
    return (left * 31 + right * 17) % SMALL_MAPS


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once: as the argument of a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fold(word: Column, coder: Coder) -> Column:
    """Ids of a word (string column) as an array of ints; null and empty words have none.

    Its bytes are merged pair by pair; a word that is a token itself is that token.
    The state of the fold is the ids and the rank of each with its right neighbour.
    """
    maps = F.from_json(F.lit(_merge_maps(coder)), "array<map<string,int>>").cast("array<map<bigint,int>>")
    single = F.array(*(F.lit(coder.ranks[bytes([k])]) for k in range(256)))

    def rank(left: Column, right: Column) -> Column:
        small = F.get(maps, (left * 31 + right * 17) % SMALL_MAPS)
        return F.coalesce(F.try_element_at(small, left.cast("bigint") * 65536 + right), F.lit(NONE))

    def merge(state: Column, at: Column, least: Column) -> Column:
        """Put ``least`` in the place of the ids ``at`` and after it."""
        ids, ranks, n = state["ids"], state["ranks"], F.size(state["ids"])
        before = F.when(at > 1, F.array(rank(F.get(ids, at - 2), least))).otherwise(F.array().cast("array<int>"))
        after = F.when(at + 1 < n, F.array(rank(least, F.get(ids, at + 1)))).otherwise(F.array().cast("array<int>"))
        return F.struct(
            F.concat(F.slice(ids, F.lit(1), at - 1), F.array(least), F.slice(ids, at + 2, F.greatest(n - at - 1, F.lit(0)))).alias("ids"),
            F.concat(F.slice(ranks, F.lit(1), F.greatest(at - 2, F.lit(0))), before, after, F.slice(ranks, at + 2, F.greatest(n - at - 2, F.lit(0)))).alias("ranks"),
        )

    def step(state: Column, _: Column) -> Column:
        merged = _bound(F.array_min(state["ranks"]), lambda least: F.when(F.coalesce(least, F.lit(NONE)) == NONE, state).otherwise(_bound(F.array_position(state["ranks"], least).cast("int"), lambda at: merge(state, at, least))))
        return merged

    def run(letters: Column) -> Column:
        start = F.transform(F.sequence(F.lit(1), F.length(letters)), lambda i: F.get(single, F.ascii(F.substring(letters, i, F.lit(1)))))
        return _bound(
            start,
            lambda ids: F.aggregate(
                F.sequence(F.lit(2), F.size(ids)),
                F.struct(ids.alias("ids"), F.zip_with(F.slice(ids, F.lit(1), F.size(ids) - 1), F.slice(ids, F.lit(2), F.size(ids) - 1), rank).alias("ranks")),
                step,
                lambda state: state["ids"],
            ),
        )

    letters = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
    one = F.array(F.get(single, F.ascii(letters)))
    return F.when(F.coalesce(F.length(word), F.lit(0)) == 0, F.array().cast("array<int>")).when(F.octet_length(word) == 1, one).otherwise(_bound(letters, run))


class Merger:
    """The same merges over many words at once, as arrays."""

    #: Words of more bytes are merged one by one, all places of a pair at a time.
    LONG = 128

    def __init__(self, coder: Coder) -> None:
        keys = np.array([left << 32 | right for left, right in coder.merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.merged = np.append(keys[order], np.iinfo(np.int64).max), np.append(np.array(list(coder.merges.values()), np.int64)[order], NONE)
        self.single = np.array([coder.ranks[bytes([k])] for k in range(256)], np.int64)
        self.remembered = coder.remembered
        self._forget()

    def _forget(self) -> None:
        self.code: dict[str, int] = {}
        self.flat, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def coded(self, words: list[str]) -> np.ndarray:
        """Numbers of the words in the memory of this worker: ``size[n]`` ids of ``flat`` for word n."""
        new = [word for word in words if word not in self.code]
        if len(self.code) + len(new) > self.remembered:
            self._forget()
            new = words
        if new:
            found = self.words([word.encode() for word in new])
            self.code.update(zip(new, range(len(self.code), len(self.code) + len(new)), strict=True))
            self.flat = np.concatenate((self.flat, *found))
            self.size = np.append(self.size, np.fromiter(map(len, found), np.int64, len(found)))
        return np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.merged[at], NONE)

    def words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for k in np.flatnonzero(sizes > self.LONG):
            out[k] = self._long(words[k])
        order = np.argsort(sizes, kind="stable")
        order = order[(sizes[order] > 0) & (sizes[order] <= self.LONG)]
        for part in np.array_split(order, max(1, len(order) // 4096)):
            if len(part):
                self._matrix([words[k] for k in part], part, out)
        return out

    def _matrix(self, words: list[bytes], part: np.ndarray, out: list[np.ndarray]) -> None:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        width = int(sizes.max())
        ids = np.full((len(words), width), -1, np.int64)
        ids[np.arange(width) < sizes[:, None]] = self.single[np.frombuffer(b"".join(words), np.uint8)]
        ranks = np.full((len(words), width + 1), NONE, np.int64)
        ranks[:, : width - 1] = self.rank(ids[:, :-1], ids[:, 1:])
        left = sizes.copy()
        live = np.arange(len(words))
        while True:
            best = ranks[live].min(1)
            live = live[best < NONE]
            if not len(live):
                break
            best = best[best < NONE]
            at = ranks[live].argmin(1)
            row = np.arange(len(live))
            own, rank = ids[live], ranks[live]
            shift = np.arange(width - 1)
            after = shift + (shift > at[:, None])
            own[:, :-1] = np.take_along_axis(own, after, 1)
            own[:, -1] = -1
            own[row, at] = best
            rank[:, : width - 1] = np.take_along_axis(rank, after, 1)
            rank[row, at] = np.where(at + 1 < width, self.rank(best, own[row, np.minimum(at + 1, width - 1)]), NONE)
            some = at > 0
            rank[row[some], at[some] - 1] = self.rank(own[row[some], at[some] - 1], best[some])
            ids[live], ranks[live] = own, rank
            left[live] -= 1
        for k, place in enumerate(part):
            out[place] = ids[k, : left[k]].astype(np.int32)

    def _long(self, word: bytes) -> np.ndarray:
        """A pair that has been merged can only form pairs of higher rank, so all its places may go at once."""
        ids = self.single[np.frombuffer(word, np.uint8)]
        while len(ids) > 1:
            ranks = self.rank(ids[:-1], ids[1:])
            best = ranks.min()
            if best >= NONE:
                break
            at = np.flatnonzero(ranks == best)
            # in a row of places that overlap, every other one
            first = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            ids[at] = best
            ids = np.delete(ids, at + 1)
        return ids.astype(np.int32)


def split(text: Column, coder: Coder) -> Column:
    """The pieces of a text that are encoded each for itself; none for a null or empty text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(java_pattern(coder.pattern)), F.lit(0))


def encode(docs: DataFrame, coder: Coder, text: str = "text", to: str = "ids") -> DataFrame:
    """Add the ids of every text as array<int>; null and empty texts get none.

    No special tokens; a control string in a text is ordinary text. An existing column
    ``to`` is replaced, the others stay.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop(to)
    names, pieces = docs.columns, "".join(["_pieces", *docs.columns])
    tables = docs.sparkSession.sparkContext.broadcast(Merger(coder))  # a few MB, as large as the rank file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = tables.value
        for batch in batches:
            column = batch.column(len(names))
            # pieces of about a slice at a time
            offsets = np.asarray(column.offsets)
            start = 0
            while start < len(column):
                stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + 400_000, "right")) - 1)
                words = column.values.slice(offsets[start], offsets[stop] - offsets[start]).dictionary_encode()
                codes = merger.coded(words.dictionary.to_pylist())[np.asarray(words.indices)]
                at = np.cumsum(merger.size) - merger.size
                counts = merger.size[codes]
                ends = np.cumsum(counts)
                ids = merger.flat[np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts) + np.repeat(at[codes], counts)]
                edges = np.concatenate(([0], ends))[offsets[start : stop + 1] - offsets[start]]
                lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(start, stop - start) for k in range(len(names))), lists], names=[*names, to])
                start = stop

    out = T.StructType([*docs.schema.fields, T.StructField(to, T.ArrayType(T.IntegerType()))])
    return docs.withColumn(pieces, split(F.col(text), coder)).mapInArrow(run, out)


def decode(ids: Column, coder: Coder) -> Column:
    """The bytes of an array of ids, as binary. Ids that the file does not have give nothing."""
    table = F.split(F.lit(",".join("" if piece is None else piece.hex() for piece in coder.pieces)), ",")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.coalesce(F.get(table, i), F.lit(""))), ""))
