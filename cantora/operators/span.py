"""The best span of timed words for an expected text.

Candidates -- ranges of words, possibly with some misheard first words put back -- are numpy arrays; time and duration sift all of them at once. What is left is
scored in order: similarities of edge words are remembered, and the longest common subsequence with the expected text goes on from
one end of a range to the next. The result is an ordered fold: a challenger's exact score is held against the rounded best, so a later one may win with slightly less.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cantora.functions.fuzzy import ratio_of
from cantora.functions.numbers_vi import clean_text_of, needs_cleaning

_NOT_SPOKEN = re.compile(r"[^\w\sÀ-ỹ]")


def spoken(text: str) -> list[str]:
    """Words of a text in lower case, without signs."""
    return _NOT_SPOKEN.sub(" ", text.lower()).split()


def expected_words(text: str) -> list[str]:
    """As ``spoken``, after the factory's cleaning: numbers in words; none for a text that cleaning refuses."""
    return spoken(clean_text_of(text))


@dataclass(frozen=True)
class SpanSearch:
    """What a span must keep to. ``first`` and ``last``: least similarity of the edge words (None: not asked). ``dear``: similarity of an edge word under which ``penalty`` is taken."""

    skips: int = 2
    first: float | None = 85
    last: float | None = 65
    dear: float = 0
    penalty: float = 0
    words_apart: int | None = None
    cleaned: bool = True
    counted: bool = True
    margin: float = 1.0


CURRENT = SpanSearch()
#: Edge words count little, and cost something.
OLDER = SpanSearch(skips=0, first=30, last=30, dear=75, penalty=15, counted=False)
#: Words of the forced alignment: no edge words, no cleaning.
ALIGNED = SpanSearch(skips=0, first=None, last=None, cleaned=False, counted=False)

FIELDS = (
    ("matched_text", "string"), ("score", "double"), ("text_score", "double"), ("core_text_score", "double"), ("first_word_score", "double"), ("last_word_score", "double"),
    ("prefix_skip", "int"), ("matched_core_text", "string"), ("avg_word_probability", "double"), ("max_word_gap", "double"), ("word_start_index", "int"), ("word_core_start_index", "int"),
    ("word_end_index", "int"), ("relative_start", "double"), ("relative_end", "double"), ("span_duration", "double"), ("expected_duration", "double"), ("word_count", "int"),
    ("expected_word_count", "int"), ("reason", "string"),
)
SPAN = T.StructType([T.StructField(n, {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType()}[k]) for n, k in FIELDS])


class Heard:
    """The words found, and the normal form of any range of them."""

    def __init__(self, found: list[str], normal: Callable[[str], list[str]], cleaned: bool):
        self.found, self.normal = found, normal
        #: Words can be normalized one by one where cleaning has nothing to do.
        self.apart = not (cleaned and needs_cleaning(" ".join(found)))
        self.each = [normal(w) for w in found] if self.apart else []
        self.known: dict[tuple[int, int], list[str]] = {}

    def words(self, i: int, j: int) -> list[str]:
        if self.apart:
            return [t for w in self.each[i:j] for t in w]
        if (i, j) not in self.known:
            self.known[i, j] = self.normal(" ".join(self.found[i:j]))
        return self.known[i, j]


class Similarity:
    """Ratios to one text; common subsequences are carried on where a text only grows."""

    def __init__(self, text: str):
        self.size, self.masks = len(text), {}
        for i, ch in enumerate(text):
            self.masks[ch] = self.masks.get(ch, 0) | 1 << i
        self.full = (1 << len(text)) - 1
        self.state: tuple[str, int] = ("", self.full)

    def ratio(self, other: str) -> float:
        total = self.size + len(other)
        if not total:
            return 100.0
        seen, rows = self.state
        if not other.startswith(seen):
            seen, rows = "", self.full
        for ch in other[len(seen) :]:
            hit = rows & self.masks.get(ch, 0)
            rows = (rows + hit | rows - hit) & self.full
        self.state = other, rows
        return 200.0 * (self.size - rows.bit_count()) / total


def candidates(count: int, skip: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): ranges of ``low`` to ``high`` of ``count`` words, by i and then j, that leave ``skip`` words before them."""
    i = np.repeat(np.arange(skip, max(skip, count)), high - low + 1)
    j = i + np.tile(np.arange(low, high + 1), len(i) // (high - low + 1))
    return i[j <= count], j[j <= count]


def search(text: str, found: list[str], starts: list[float], ends: list[float], odds: list[float | None], start: float | None, end: float | None, how: SpanSearch = CURRENT) -> tuple:
    """One row of FIELDS; without a span only ``reason`` is set."""
    nothing = lambda why: (*[None] * (len(FIELDS) - 1), why)
    normal = expected_words if how.cleaned else spoken
    target = normal(text)
    if not target:
        return nothing("EMPTY_EXPECTED_TEXT")
    if not found:
        return nothing("NO_WORDS")
    if start is None or end is None or start != start or end != end:
        return nothing("BAD_EXPECTED_TIME")
    length = end - start
    if length <= 0:
        return nothing("BAD_EXPECTED_DURATION")
    heard, s, e = Heard(found, normal, how.cleaned), np.asarray(starts, float), np.asarray(ends, float)
    whole, edges = Similarity(" ".join(target)), {}
    refused = dict.fromkeys(("FIRST_WORD", "LAST_WORD", "TIME", "DURATION"), 0)

    def edge(a: str, b: str) -> float:
        if (a, b) not in edges:
            edges[a, b] = ratio_of(a, b)
        return edges[a, b]

    best = None
    for skip in range(min(how.skips, len(target) - 1) + 1):
        core = target[skip:]
        i, j = candidates(len(found), skip, max(1, int(len(core) * 0.75)), max(1, int(len(core) * 1.25)))
        if how.words_apart is not None:
            close = np.abs(j - i - len(core)) <= how.words_apart
            i, j = i[close], j[close]
        near = (s[i - skip] >= max(0.0, start - how.margin)) & (e[j - 1] <= end + how.margin)
        refused["TIME"] += int((~near).sum())
        i, j = i[near], j[near]
        lasts = e[j - 1] - s[i - skip]
        fits = (lasts >= length * 0.70) & (lasts <= length * 1.30)
        refused["DURATION"] += int((~fits).sum())
        for a, b in zip(i[fits].tolist(), j[fits].tolist(), strict=True):
            words = heard.words(a, b)
            first, last = (edge(core[0], words[0]), edge(core[-1], words[-1])) if words else (0.0, 0.0)
            if how.first is not None and first < how.first:
                refused["FIRST_WORD"] += 1
            elif how.last is not None and last < how.last:
                refused["LAST_WORD"] += 1
            else:
                at = a - skip
                alike = whole.ratio(" ".join(heard.words(at, b)))
                off = 10 * abs(s[at] - start) + 10 * abs(e[b - 1] - end) + 8 * abs(e[b - 1] - s[at] - length)
                score = float(alike - off - 3 * skip - how.penalty * ((first < how.dear) + (last < how.dear)))
                if best is None or score > best[0]:
                    best = round(score, 2), alike, first, last, skip, at, a, b
    if best is None:
        return nothing("NO_GOOD_SPAN" + "".join(f"|{k}_REJECT={v}" for k, v in refused.items()) * how.counted)
    score, alike, first, last, skip, at, a, b = best
    known = [p for p in odds[at:b] if p is not None and p == p] if odds else []
    gaps = s[at + 1 : b] - e[at : b - 1]
    core_alike = ratio_of(" ".join(target[skip:]), " ".join(heard.words(a, b)))
    return (
        " ".join(found[at:b]), score, round(alike, 2), round(core_alike, 2), round(first, 2), round(last, 2), skip, " ".join(found[a:b]),
        round(sum(known) / len(known), 4) if known else None, round(float(gaps.max()), 3) if len(gaps) else 0.0, at, a, b - 1, float(s[at]), float(e[b - 1]),
        round(float(e[b - 1] - s[at]), 3), round(length, 3), len(heard.words(at, b)), len(target), None,
    )


def span_udf(how: SpanSearch = CURRENT) -> Callable:
    """An Arrow function of (expected text, words, starts, ends, probabilities, expected start, expected end) that gives a struct of FIELDS."""

    @F.pandas_udf(SPAN)
    def best_span(frames: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for columns in frames:
            rows = [search(text or "", *(list(x) if x is not None else [] for x in lists), start, end, how) for text, *lists, start, end in zip(*columns, strict=True)]
            yield pd.DataFrame(rows, columns=[n for n, _ in FIELDS]).astype({n: "Int32" for n, k in FIELDS if k == "int"})

    return best_span
