"""Whole columns of text as flat byte arrays: words, lines and their hashes by numpy alone.

A batch of texts is one byte array with offsets (the form Arrow already has it in), so a
word, a line or a passage is a pair of positions and its hash is a difference of prefix
sums. No Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Odd base of the polynomial hash, and the seed of the random values of the 256 bytes.
BASE = U64(0x9E3779B97F4A7C15)
INVERSE = U64(pow(int(BASE), -1, 1 << 64))
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
#: Word separators: space and the ASCII controls from tab to carriage return.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
#: Batches are worked through in slices of about so many bytes; one longer text is a slice of its own.
SLICE_BYTES = 1_000_000

_powers = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def _power(kind: str, n: int) -> np.ndarray:
    """Powers 0..n-1 of the base (``up``) or of its inverse (``down``), kept between calls."""
    if len(_powers[kind]) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), BASE if kind == "up" else INVERSE, U64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps, dtype=U64)
    return _powers[kind][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits (finaliser of splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Texts:
    """Some texts as one byte array. ``offsets`` has one entry more than there are texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data = data
        self.offsets = offsets
        self._prefix: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        """Texts of an Arrow string column; a null is an empty text."""
        column = column.cast(pa.large_binary())
        if column.null_count:
            column = column.fill_null(b"")
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset)
        start, end = (int(offsets[0]), int(offsets[-1])) if len(column) else (0, 0)
        flat = np.frombuffer(data, np.uint8)[start:end] if data is not None and end > start else np.zeros(0, np.uint8)
        return cls(flat, offsets - start)

    def lowered(self) -> Texts:
        """The same with A-Z in lower case."""
        return Texts(ASCII_LOWER[self.data], self.offsets)

    def texts_of(self, positions: np.ndarray) -> np.ndarray:
        """The text each byte position lies in."""
        return np.searchsorted(self.offsets, positions, "right") - 1

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the longest runs of marked bytes; none crosses a text's end."""
        n = len(self.data)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        borders = np.zeros(n + 1, bool)
        borders[self.offsets] = True
        before = np.concatenate(([False], inside))
        after = np.concatenate((inside, [False]))
        starts = np.flatnonzero(after[:-1] & (~before[:-1] | borders[:-1]))
        ends = np.flatnonzero(before[1:] & (~after[1:] | borders[1:])) + 1
        return starts, ends

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words."""
        return self.spans(~IS_SPACE[self.data])

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the lines: a text with n line feeds has n + 1, an empty text one."""
        feeds = np.flatnonzero(self.data == 10)
        starts = np.sort(np.concatenate((self.offsets[:-1], feeds + 1)), kind="stable")
        ends = np.sort(np.concatenate((self.offsets[1:], feeds)), kind="stable")
        return starts, ends

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of the spans' bytes."""
        if self._prefix is None:
            self._prefix = np.zeros(len(self.data) + 1, U64)
            np.cumsum(BYTE_VALUES[self.data] * _power("up", len(self.data)), out=self._prefix[1:])
        value = (self._prefix[ends] - self._prefix[starts]) * _power("down", len(self.data) + 1)[starts]
        return mix(value + (ends - starts).astype(U64))

    def counts(self, starts: np.ndarray) -> np.ndarray:
        """How many of the sorted span starts each text has."""
        return np.diff(np.searchsorted(starts, self.offsets))

    def code_points(self) -> np.ndarray:
        """Prefix counts of code points over the bytes."""
        return np.concatenate(([0], np.cumsum((self.data & 0xC0) != 0x80)))


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Cut a batch into pieces of at most ``SLICE_BYTES`` of the text column, one row at least."""
    texts = batch.column(column)
    if not len(texts):
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64()))
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def shingles(texts: Texts, width: int, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words and the text of each, repeats included.

    A text with fewer words gives one hash of all of them, a text without words none.
    """
    words = texts.hashes(starts, ends)
    n = texts.counts(starts)
    owner = np.repeat(np.arange(len(texts)), n)
    if len(words) >= width:
        run = np.zeros(len(words) - width + 1, U64)
        for k in range(width):
            run = mix(run * BASE + words[k : len(words) - width + 1 + k])
        inside = owner[: len(run)] == owner[width - 1 :]
        run, of = run[inside], owner[: len(inside)][inside]
    else:
        run, of = np.zeros(0, U64), np.zeros(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        first = np.searchsorted(starts, texts.offsets[short])
        value = np.zeros(len(short), U64)
        for k in range(width - 1):
            has = n[short] > k
            value[has] = mix(value[has] * BASE + words[first[has] + k])
        value = mix(value ^ U64(0x5851F42D4C957F2D) ^ n[short].astype(U64))
        run, of = np.concatenate((run, value)), np.concatenate((of, short))
        order = np.argsort(of, kind="stable")
        run, of = run[order], of[order]
    return run, of


def distinct(values: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text, sorted within it; ``of`` must ascend."""
    values = values.copy()
    bounds = np.flatnonzero(np.diff(of)) + 1
    for a, b in zip([0, *bounds], [*bounds, len(values)], strict=True):
        values[a:b].sort()
    if len(values):
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
        values, of = values[new], of[new]
    return values, of


def list_column(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """An Arrow list column from flat values and the length of each list."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(values))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of runs of values, from the positions where they start and end."""
    n = len(values)
    prefix = np.zeros(n + 1, U64)
    np.cumsum(values * _power("up", n), out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * _power("down", n + 1)[starts] + (ends - starts).astype(U64))
