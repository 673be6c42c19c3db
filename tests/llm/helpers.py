"""Made-up texts, and plain models of the operators, row by row."""

from __future__ import annotations

import random
import re
from collections import defaultdict

#: Columns of ``documents``.
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingle_set(text: str | None, width: int) -> set[tuple[str, ...]]:
    words = WORD.findall(ascii_lower(text or ""))
    if not words:
        return set()
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} or {tuple(words)}


def groups(texts: dict[int, str | None], width: int, percent: int) -> dict[int, int]:
    """Smallest id that each text is linked with, over all pairs."""
    sets = {i: shingle_set(t, width) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                same = len(sets[a] & sets[b])
                if 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                    low, high = sorted((root(a), root(b)))
                    parent[high] = low
    return {i: root(i) for i in ids}


def base_counts(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    where = defaultdict(list)
    for k in range(len(words) - 4):
        where[tuple(words[k : k + 5])].append(k)
    repeated = {p for places in where.values() if len(places) > 1 for k in places for p in range(k, k + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)


def repeated_words(texts: dict[int, str], least: int) -> dict[int, list[bool]]:
    """Which words of each text are in a run of ``least`` words that stands earlier."""
    seen, out = set(), {}
    for i in sorted(texts):
        words = WORD.findall(texts[i])
        out[i] = [False] * len(words)
        for k in range(len(words) - least + 1):
            run = tuple(words[k : k + least])
            if run in seen:
                out[i][k : k + least] = [True] * least
            seen.add(run)
    return out


def prose(seed: int, n: int) -> str:
    """Words of two or three syllables with sentence ends, some line feeds."""
    draw = random.Random(seed)
    syllables = ["ka", "lo", "mi", "ner", "sha", "tu", "ver", "zo", "pin", "dra", "el", "qui"]
    words = []
    for k in range(n):
        word = "".join(draw.choice(syllables) for _ in range(draw.randint(1, 3)))
        words.append(word + ("." if draw.random() < 0.1 else ""))
    return "".join(w + ("\n" if draw.random() < 0.03 else " ") for w in words).strip()
