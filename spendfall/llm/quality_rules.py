"""Quality rules: plain counts, and how far a text's histograms are from its language's.

The language references are taken from the corpus itself: for every language the most
frequent words of all its documents with their shares, and the shares of character classes,
each document weighing the same however long it is. A document is compared with its
language's reference by the Jensen-Shannon distance of both histograms. Short documents have
ragged histograms, so the limits widen as 1/sqrt(words) and below a least length nothing is
compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendfall.llm.store import dropped, small_batches, stored
from spendfall.llm.textbytes import Texts, run_hashes, slices

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 10
REPEAT_PERCENT = 20
REPEAT_WINDOW = 5

#: Character classes: lower case, upper case, digit, end marks, other marks, symbols, quotes and brackets, letters beyond ASCII, space, line feed.
CLASSES = 10


def _class_table() -> np.ndarray:
    table = np.full(256, 4, np.int64)
    for k, members in enumerate((range(97, 123), range(65, 91), range(48, 58), b".,;:!?")):
        table[list(members)] = k
    table[list(SYMBOLS)] = 5
    table[list(b"'\"()[]{}")] = 6
    table[128:] = 7
    table[[32, 9, 11, 12, 13]] = 8
    table[10] = 9
    return table


CLASS_OF = _class_table()


@dataclass(frozen=True)
class Limits:
    """Distances are between 0 and 1. A limit is ``base + slack / sqrt(words) + few / sqrt(documents of the language)``."""

    least_words: int = 30
    class_base: float = 0.16
    class_slack: float = 0.8
    word_base: float = 0.30
    word_slack: float = 1.5
    common_words: int = 60
    few: float = 1.0


def _repeats(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text: words covered by windows that the text has twice or more."""
    out = np.zeros(len(counts), np.int64)
    if len(words) < REPEAT_WINDOW:
        return out
    begin = np.arange(len(words) - REPEAT_WINDOW + 1)
    owner = np.repeat(np.arange(len(counts)), counts)
    begin = begin[owner[begin] == owner[begin + REPEAT_WINDOW - 1]]
    hashes = run_hashes(words, begin, begin + REPEAT_WINDOW)
    size = np.maximum(counts - REPEAT_WINDOW + 1, 0)
    edges = np.concatenate(([0], np.cumsum(size)))
    covered = np.zeros(len(words) + 1, np.int64)
    for text in np.flatnonzero(size > 1):
        a, b = edges[text], edges[text + 1]
        order = np.argsort(hashes[a:b], kind="stable")
        ranked = hashes[a:b][order]
        equal = ranked[1:] == ranked[:-1]
        if equal.any():
            twice = np.zeros(b - a, bool)
            twice[order[1:][equal]] = True
            twice[order[:-1][equal]] = True
            start = begin[a:b][twice]
            np.add.at(covered, start, 1)
            np.add.at(covered, start + REPEAT_WINDOW, -1)
    inside = np.cumsum(covered[:-1]) > 0
    return np.bincount(owner, inside, len(counts)).astype(np.int64)


def _repeated_lines(texts: Texts, starts: np.ndarray) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line of it."""
    begin, end = texts.lines()
    worded = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
    begin, end = begin[worded], end[worded]
    of = np.searchsorted(texts.offsets, begin, "right") - 1
    hashes = texts.hashes(begin, end)
    order = np.lexsort((hashes, of))
    equal = (hashes[order][1:] == hashes[order][:-1]) & (of[order][1:] == of[order][:-1])
    return np.bincount(of[order][1:][equal], minlength=len(texts))


def base_counts(texts: Texts) -> dict[str, np.ndarray]:
    """The plain counts of each text, and hidden ones that the histograms share."""
    starts, ends = texts.words()
    counts = texts.counts(starts)
    points = texts.code_points()
    owner = np.repeat(np.arange(len(texts)), counts)
    symbol = np.concatenate(([0], np.cumsum(CLASS_OF[texts.data] == 5)))
    words = texts.hashes(starts, ends)
    return {
        "n_words": counts,
        "word_chars": np.bincount(owner, points[ends] - points[starts], len(texts)).astype(np.int64),
        "n_symbols": np.diff(symbol[texts.offsets]),
        "n_dup_lines": _repeated_lines(texts, starts),
        "n_repeat_words": _repeats(words, counts),
    }


def class_histograms(texts: Texts) -> np.ndarray:
    """Characters of each text by class."""
    lead = (texts.data & 0xC0) != 0x80
    size = np.diff(texts.offsets)
    owner = np.repeat(np.arange(len(texts)), size)
    cell = owner * CLASSES + CLASS_OF[texts.data]
    return np.bincount(cell[lead], minlength=len(texts) * CLASSES).reshape(len(texts), CLASSES).astype(float)


def word_histograms(texts: Texts, languages: np.ndarray, common: dict[int, np.ndarray], size: int) -> np.ndarray:
    """Words of each text by place in its language's common words (hashes, sorted); all others come last."""
    starts, ends = texts.words()
    hashes = texts.hashes(starts, ends)
    owner = np.repeat(np.arange(len(texts)), texts.counts(starts))
    place = np.full(len(hashes), size)
    spoken = languages[owner]
    for language, known in common.items():
        own = np.flatnonzero(spoken == language)
        if len(own) and len(known):
            at = np.minimum(np.searchsorted(known, hashes[own]), len(known) - 1)
            hit = known[at] == hashes[own]
            place[own[hit]] = at[hit]
    return np.bincount(owner * (size + 1) + place, minlength=len(texts) * (size + 1)).reshape(len(texts), size + 1).astype(float)


def _shares(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(1, keepdims=True)
    return counts / np.maximum(total, 1)


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distance (square root of the divergence to base 2) of the rows of p and q."""
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0).sum(1)
        right = np.where(q > 0, q * np.log2(q / middle), 0).sum(1)
    return np.sqrt(np.clip((left + right) / 2, 0, 1))


@dataclass(frozen=True)
class Reference:
    """What a language looks like: class shares, and hashes and shares of its common words (the last share: all others)."""

    classes: np.ndarray
    words: np.ndarray
    shares: np.ndarray


WORD, CLASS, DOCUMENTS, WORDS = range(4)
#: Shares are summed as whole numbers, so that sums do not depend on the order of rows.
UNIT = 1 << 24
#: Word counts are summed in each task up to so many entries, then handed on.
HELD = 1_500_000


def _language_index(column: pa.Array) -> tuple[list[str], np.ndarray]:
    coded = column.cast(pa.string()).fill_null("").dictionary_encode()
    return coded.dictionary.to_pylist(), np.asarray(coded.indices)


def _summed(languages: list[np.ndarray], keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    language, key, value = map(np.concatenate, (languages, keys, values))
    order = np.lexsort((key, language))
    language, key, value = language[order], key[order], value[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (language[1:] != language[:-1])
    at = np.flatnonzero(new)
    return language[at], key[at], np.add.reduceat(value, at) if len(at) else value


def histogram_sums(docs: DataFrame, text: str, lang: str, limits: Limits) -> DataFrame:
    """(lang, kind, key, value): sums over all documents of ``least_words`` words or more."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        held: tuple[list, list, list] = ([], [], [])
        sums: dict[tuple[int, int, int], int] = {}

        def words_out() -> pa.RecordBatch:
            language, key, value = _summed(*held)
            for part in held:
                part.clear()
            return _batch(np.array(list(names), object)[language], np.full(len(key), WORD), key.view(np.int64), value)

        for batch in batches:
            for part in slices(batch, text):
                texts = Texts.of(part.column(text))
                found, index = _language_index(part.column(lang))
                language = np.array([names.setdefault(name, len(names)) for name in found] or [0], np.int64)[index]
                starts, ends = texts.words()
                counts = texts.counts(starts)
                enough = counts >= limits.least_words
                shares = np.rint(_shares(class_histograms(texts)) * UNIT).astype(np.int64)
                for code in np.unique(language[enough]):
                    own = enough & (language == code)
                    for kind, key, value in [(DOCUMENTS, 0, own.sum()), (WORDS, 0, counts[own].sum()), *((CLASS, k, v) for k, v in enumerate(shares[own].sum(0)))]:
                        sums[code, kind, key] = sums.get((code, kind, key), 0) + int(value)
                words = texts.hashes(starts, ends)
                owner = np.repeat(np.arange(len(texts)), counts)
                use = enough[owner]
                some = _summed([language[owner[use]]], [words[use]], [np.ones(use.sum(), np.int64)])
                for store, values in zip(held, some, strict=True):
                    store.append(values)
                if sum(map(len, held[1])) > HELD:
                    some = _summed(*held)
                    for store, values in zip(held, some, strict=True):
                        store[:] = [values]
                    if len(some[1]) > HELD // 2:
                        yield words_out()
        if sum(map(len, held[1])):
            yield words_out()
        if sums:
            code, kind, key = map(np.array, zip(*sums, strict=True))
            yield _batch(np.array(list(names), object)[code], kind, key, np.array(list(sums.values())))

    return docs.select(text, lang).mapInArrow(run, "lang string, kind int, key long, value long")


def _batch(lang: np.ndarray, kind: np.ndarray, key: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(kind.astype(np.int32)), pa.array(key.astype(np.int64)), pa.array(value.astype(np.int64))], names=["lang", "kind", "key", "value"])


def references(docs: DataFrame, text: str = "text", lang: str = "lang", limits: Limits | None = None) -> DataFrame:
    """(language, documents, classes, common): the reference of every language, from its documents of ``least_words`` words or more."""
    limits = limits or Limits()
    sums = stored(histogram_sums(docs, text, lang, limits).groupBy("lang", "kind", "key").agg(F.sum("value").alias("value")), "histograms")
    large = stored(
        sums.where(f"kind in ({DOCUMENTS}, {WORDS})")
        .groupBy("lang")
        .agg(F.sum(F.when(F.col("kind") == DOCUMENTS, F.col("value"))).alias("documents"), F.sum(F.when(F.col("kind") == WORDS, F.col("value"))).alias("words")),
        "languages",
    )
    # a common word is a thousandth of the words or more, hence at most a thousand a language
    some = sums.join(large, "lang").where(f"kind = {CLASS} or (kind = {WORD} and value >= words / 1000)")
    classes = F.when(F.col("kind") == CLASS, F.struct("key", (F.col("value") / UNIT / F.col("documents")).alias("share")))
    common = F.when(F.col("kind") == WORD, F.struct((-F.col("value")).alias("minus"), "key", (F.col("value") / F.col("words")).alias("share")))
    found = some.groupBy(F.col("lang").alias("language"), "documents").agg(
        F.collect_list(classes).alias("classes"), F.slice(F.array_sort(F.collect_list(common)), 1, limits.common_words).alias("common")
    )
    found = stored(found, "references")
    dropped(sums, large)
    return found


def _reference(classes: pa.Scalar, common: pa.Scalar) -> Reference:
    shares = np.zeros(CLASSES)
    for entry in classes.as_py():
        shares[entry["key"]] = entry["share"]
    words = sorted((entry["key"] % 2**64, entry["share"]) for entry in common.as_py())
    of_words = np.array([share for _, share in words])
    return Reference(shares, np.array([key for key, _ in words], np.uint64), np.append(of_words, max(0.0, 1 - of_words.sum())))


def judge(docs: DataFrame, known: DataFrame, text: str = "text", lang: str = "lang", limits: Limits | None = None) -> DataFrame:
    """All rows of ``docs`` with the base counts, base_failed, class_distance, word_distance and kept.

    A null or empty text has no words, fails the base rules and is not kept. A null language
    counts as one of its own. Distances are null where the text has fewer than
    ``least_words`` words; they then reject nothing. Limits are the wider the fewer documents
    the language has, so that a small one is not judged by the chance of its few texts. Columns of
    ``docs`` named like the new ones are replaced, all others stay.
    """
    small_batches(docs.sparkSession)
    limits = limits or Limits()
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    docs = docs.drop(*counts, "base_failed", "class_distance", "word_distance", "kept")
    names = docs.columns
    out = T.StructType(
        [*docs.schema.fields, *(T.StructField(name, T.LongType()) for name in counts), T.StructField("base_failed", T.BooleanType())]
        + [T.StructField(name, T.DoubleType()) for name in ("class_distance", "word_distance")]
        + [T.StructField("kept", T.BooleanType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                texts = Texts.of(part.column(text))
                found = base_counts(texts)
                n = found["n_words"]
                failed = (n < LEAST_WORDS) | (100 * found["n_repeat_words"] > REPEAT_PERCENT * n)
                _, index = _language_index(part.column(lang))
                classes, words, documents = (np.full(len(texts), x) for x in (np.nan, np.nan, 1.0))
                histogram = _shares(class_histograms(texts))
                enough = n >= limits.least_words
                own_classes, own_common = part.column(len(names)), part.column(len(names) + 1)
                first = dict(zip(*np.unique(index, return_index=True), strict=True))
                known = {k: _reference(own_classes[int(row)], own_common[int(row)]) for k, row in first.items() if own_classes[int(row)].is_valid}
                common = {k: reference.words for k, reference in known.items() if len(reference.words)}
                by_word = word_histograms(texts, index, common, limits.common_words)
                for k, reference in known.items():
                    rows = np.flatnonzero(enough & (index == k))
                    if not len(rows):
                        continue
                    documents[rows] = part.column(len(names) + 2)[int(first[k])].as_py()
                    classes[rows] = jensen_shannon(histogram[rows], reference.classes[None])
                    if k in common:
                        size = len(reference.words)
                        own = by_word[rows][:, [*range(size), limits.common_words]]
                        words[rows] = jensen_shannon(_shares(own), reference.shares[None])
                root, few = 1 / np.sqrt(np.maximum(n, 1)), limits.few / np.sqrt(documents)
                far = (classes > limits.class_base + limits.class_slack * root + few) | (words > limits.word_base + limits.word_slack * root + few)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(names)], *(pa.array(found[name].astype(np.int64)) for name in counts), pa.array(failed), pa.array(classes, from_pandas=True), pa.array(words, from_pandas=True), pa.array(~failed & ~far)],
                    names=out.names,
                )

    # as in ``_language_index``, no language is the empty one
    joined = docs.join(known, F.coalesce(docs[lang].cast("string"), F.lit("")) == known["language"], "left")
    return joined.select(*(docs[name] for name in names), known["classes"], known["common"], known["documents"]).mapInArrow(run, out)


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", limits: Limits | None = None) -> DataFrame:
    """Judge ``docs`` by references taken from ``docs`` itself; see :func:`judge`."""
    return judge(docs, references(docs, text, lang, limits), text, lang, limits)
