"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, one on toxic passages. A text
is cut into windows of a few words and every window is compressed with the ordinary
dictionary and with the toxic one (which has the ordinary one behind it, so that text which
is merely unusual costs the same in both). The bytes that a window saves through the toxic
dictionary are compared with thresholds; the shares of windows beyond each threshold are
calibrated to a probability by a logistic fit on labelled rows that trained no dictionary.

Labels are of whole documents, toxic passages are short. Training therefore first looks for
words and word pairs that turn up in many more *different* contexts (word before, word after)
of toxic documents than of ordinary ones, and for runs of words that stand in many more
different toxic documents; copies of a whole document count once. The toxic dictionary is
trained on the windows of toxic text round these, or on all windows if there are none.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendfall.llm.store import small_batches
from spendfall.llm.textbytes import Texts, slices

#: Windows gain so many bytes or more.
GAINS = (1, 2, 3, 4, 6)
NO_WORDS = b""


@dataclass(frozen=True)
class Settings:
    """Every bound of the training; scoring has none."""

    #: Labelled rows of each class that are brought to the driver at most, two thirds of them for dictionaries.
    toxic_rows: int = 3000
    ordinary_rows: int = 4500
    #: Longer texts are not used for training.
    train_chars: int = 20_000
    window_words: int = 8
    toxic_bytes: int = 4096
    ordinary_bytes: int = 32768
    #: A word belongs to toxic passages if so many contexts, such a multiple, and so many deviations speak for it.
    least_contexts: int = 8
    least_ratio: float = 4.0
    least_deviations: float = 6.0
    #: Words before and after a mark that belong to its passage, and words of a run that is counted by documents.
    around: int = 2
    run_words: int = 4


@dataclass(frozen=True)
class Model:
    settings: Settings = field(default_factory=Settings)
    ordinary: bytes = b""
    toxic: bytes = b""
    weights: tuple[float, ...] = ()
    #: The score where nothing could be learned.
    prior: float = 0.0


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split()


def _contexts(texts: list[str]) -> Counter[bytes]:
    """How many different contexts each word has."""
    found = set()
    for text in texts:
        words = [NO_WORDS, *_words(text), NO_WORDS]
        found.update(zip(words, words[1:], words[2:], strict=False))
    return Counter(word for _, word, _ in found)


def passage_words(toxic: list[str], ordinary: list[str], settings: Settings) -> set[bytes]:
    """Words that mark toxic passages."""
    has, lacks = _contexts(toxic), _contexts(ordinary)
    scale = max(1, has.total()) / max(1, lacks.total())
    chosen = set()
    for word, n in has.items():
        if _speaks(n, scale * (lacks[word] + 1), settings):
            chosen.add(word)
    return chosen


def _speaks(n: int, expected: float, settings: Settings) -> bool:
    return n >= settings.least_contexts and n > settings.least_ratio * expected and (n - expected) / expected**0.5 > settings.least_deviations


def _runs(text: str, width: int) -> list[tuple[bytes, ...]]:
    words = _words(text)
    return list(zip(*(words[k:] for k in range(width)), strict=False))


def _pair_contexts(texts: list[str], only: set | None = None) -> Counter[tuple[bytes, ...]]:
    """How many different contexts each word pair has."""
    found = set()
    for text in texts:
        words = [NO_WORDS, *_words(text), NO_WORDS]
        found.update(x for x in zip(words, words[1:], words[2:], words[3:], strict=False) if only is None or x[1:3] in only)
    return Counter(x[1:3] for x in found)


def passage_runs(toxic: list[str], ordinary: list[str], settings: Settings) -> set[tuple[bytes, ...]]:
    """Word pairs that mark toxic passages by their contexts, and longer runs that do by their documents.

    A toxic document of whose runs four fifths stand in others before it is a copy of these
    and does not count.
    """
    has = {pair: n for pair, n in _pair_contexts(toxic).items() if n >= settings.least_contexts}
    lacks = _pair_contexts(ordinary, set(has))
    scale = max(1, sum(len(_words(text)) for text in toxic)) / max(1, sum(len(_words(text)) for text in ordinary))
    chosen = {pair for pair, n in has.items() if _speaks(n, scale * (lacks[pair] + 1), settings)}
    documents: Counter[tuple[bytes, ...]] = Counter()
    for text in toxic:
        runs = set(_runs(text, settings.run_words))
        if 5 * sum(run in documents for run in runs) <= 4 * len(runs):
            documents.update(runs)
    often = {run: n for run, n in documents.items() if n >= settings.least_contexts}
    common: Counter[tuple[bytes, ...]] = Counter()
    for text in ordinary:
        common.update(often.keys() & set(_runs(text, settings.run_words)))
    scale = max(1, len(toxic)) / max(1, len(ordinary))
    return chosen | {run for run, n in often.items() if _speaks(n, scale * (common[run] + 1), settings)}


def _window(words: list[bytes]) -> bytes:
    return b" " + b" ".join(words) + b" "


def toxic_windows(toxic: list[str], ordinary: list[str], settings: Settings) -> list[bytes]:
    """Windows of the toxic texts round what marks passages; all windows if nothing does."""
    marks, runs = passage_words(toxic, ordinary, settings), passage_runs(toxic, ordinary, settings)
    found, width = [], settings.window_words
    for text in toxic:
        words = _words(text)
        inside = np.array([word in marks for word in words], bool)
        for size in (2, settings.run_words):
            for k, run in enumerate(_runs(text, size)):
                if run in runs:
                    inside[k : k + size] = True
        edges = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
        for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True):
            low, high = max(0, a - settings.around), min(len(words), b + settings.around)
            found += [_window(words[k : min(k + width, high)]) for k in range(low, high, width)]
    return found or [_window(words[k : k + width]) for words in map(_words, toxic) for k in range(0, len(words), width)]


def _trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """A trained dictionary; of too few samples for that, the samples themselves."""
    try:
        return zstd.train_dictionary(size, samples, k=segment, d=6, level=3).as_bytes()
    except zstd.ZstdError:
        return b"".join(dict.fromkeys(samples))[:size]


def train_dictionaries(toxic: list[str], ordinary: list[str], settings: Settings) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary; empty ones if either class has no words."""
    passages = toxic_windows(toxic, ordinary, settings)
    plain: dict[bytes, None] = {}
    for text in ordinary:
        words = _words(text)
        for k in range(0, len(words), settings.window_words):
            plain[_window(words[k : k + settings.window_words])] = None
    if not passages or not plain:
        return b"", b""
    # weighted three times, as short samples alone are too little for the trainer
    return _trained(list(plain), settings.ordinary_bytes, 48), _trained(passages * 3, settings.toxic_bytes, 16)


def _compressor(dictionary: bytes) -> zstd.ZstdCompressor:
    """Lazy matching from four bytes on, no frame extras, so that small windows differ by their content."""
    how = zstd.ZstdCompressionParameters.from_level(
        3, source_size=64, dict_size=len(dictionary), strategy=zstd.STRATEGY_LAZY2, min_match=4,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    content = zstd.ZstdCompressionDict(dictionary, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    content.precompute_compress(compression_params=how)
    return zstd.ZstdCompressor(compression_params=how, dict_data=content)


def _lengths(compressor: zstd.ZstdCompressor, data: bytes, segments: np.ndarray) -> np.ndarray:
    done = compressor.multi_compress_to_buffer(zstd.BufferWithSegments(data, segments.tobytes()))
    return np.fromiter((len(done[i]) for i in range(len(done))), np.int64, len(done))


def features(texts: Texts, model: Model, pair: tuple[zstd.ZstdCompressor, zstd.ZstdCompressor]) -> np.ndarray:
    """A row per text: shares of windows by gain, mean and largest gain, length. Texts without words have zeros."""
    texts = texts.lowered()
    starts, ends = texts.words()
    counts = texts.counts(starts)
    out = np.zeros((len(texts), len(GAINS) + 4))
    if not len(starts):
        return out
    width = model.settings.window_words
    first = np.repeat(np.cumsum(counts) - counts, counts)
    opens = (np.arange(len(starts)) - first) % width == 0
    closes = np.append(opens[1:], True)
    begin, end = starts[opens], ends[closes]
    owner = np.repeat(np.arange(len(texts)), counts)[opens]
    begin = begin - (begin > texts.offsets[owner])
    segments = np.stack((begin, end - begin), 1).astype(np.uint64)
    data = texts.data.tobytes()
    gain = _lengths(pair[0], data, segments) - _lengths(pair[1], data, segments)
    windows = np.bincount(owner, minlength=len(texts))
    some = windows > 0
    for k, least in enumerate(GAINS):
        out[:, k] = np.bincount(owner, gain >= least, len(texts))
    out[:, len(GAINS)] = np.bincount(owner, np.maximum(gain, 0), len(texts))
    out[some, : len(GAINS) + 1] /= windows[some, None] + 1.0
    largest = np.full(len(texts), -1)
    np.maximum.at(largest, owner, gain)
    out[:, len(GAINS) + 1] = np.clip(largest, 0, 12) / 4
    out[:, len(GAINS) + 2] = np.log1p(windows) / 4
    out[:, len(GAINS) + 3] = out[:, 1] * np.log1p(windows)
    out[~some] = 0
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted logistic regression by Newton steps; the last weight is the intercept."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    keep = np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(40):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep), x.T @ (weight * (y - p)) - keep * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, learn: str = "true") -> Model:
    """Train on labelled rows for which the SQL condition ``learn`` on ``doc_id`` holds.

    Rows are drawn by a hash of the id, at most as many as ``settings`` says; of several texts
    under one id the first in order is used. Rows with a
    null id, label or text are not used. Without two texts of each class the model scores
    every text with the share of toxic labels.
    """
    settings = settings or Settings()
    usable = labels.where(f"doc_id is not null and toxic in (0, 1) and {learn}").select("doc_id", "toxic").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return Model(settings, prior=1.0 if totals.get(1) else 0.0)
    draw = F.xxhash64("doc_id")
    chosen = usable.where("toxic = 1").orderBy(draw, "doc_id").limit(settings.toxic_rows).union(usable.where("toxic = 0").orderBy(draw, "doc_id").limit(settings.ordinary_rows))
    # at most toxic_rows + ordinary_rows ids, and one text of each
    rows = (
        docs.select("doc_id", "text")
        .where(f"text is not null and length(text) <= {settings.train_chars}")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))
        .collect()
    )
    rows = sorted({r["text"]: (r["doc_id"], r["toxic"], r["text"]) for r in sorted(rows)}.values())
    # every third row calibrates, of two rows the second
    every = {label: min(3, max(2, sum(r[1] == label for r in rows))) for label in (0, 1)}
    by = {(label, held): [r[2] for k, r in enumerate(x for x in rows if x[1] == label) if (k % every[label] == every[label] - 1) == held] for label in (0, 1) for held in (False, True)}
    ordinary, toxic = train_dictionaries(by[1, False], by[0, False], settings)
    model = Model(settings, ordinary, toxic, prior=totals[1] / (totals[0] + totals[1]))
    held = [*by[0, True], *by[1, True]]
    if not toxic or not by[1, True] or not by[0, True]:
        return model
    x = features(Texts.of(pa.array(held, pa.large_string())), model, (_compressor(ordinary), _compressor(toxic + ordinary)))
    y = np.repeat([0.0, 1.0], [len(by[0, True]), len(by[1, True])])
    # every class weighs as much as it has labels
    weight = np.where(y == 1, totals[1] / y.sum(), totals[0] / (len(y) - y.sum()))
    return Model(settings, ordinary, toxic, tuple(_fit(x, y, weight * len(y) / weight.sum()).tolist()), model.prior)


def score(docs: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    """Add the probability that a text is toxic. Null and empty texts score as texts without windows do.

    An existing column ``to`` is replaced; all other columns stay as they are.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop(to)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = None
        for batch in batches:
            for part in slices(batch, text):
                if model.weights:
                    pair = pair or (_compressor(model.ordinary), _compressor(model.toxic + model.ordinary))
                    x = features(Texts.of(part.column(text)), model, pair)
                    value = _sigmoid(x @ np.array(model.weights[:-1]) + model.weights[-1])
                else:
                    value = np.full(part.num_rows, model.prior)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(value)], names=[*names, to])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(to, T.DoubleType())]))
