"""Fuzzy test whether a heading is boilerplate (contents, index, references ...).

Nearly all headings are settled natively: a keyword inside the heading, or the
heading inside a keyword, scores 100. Only the rest reaches the scorer, which
computes longest common subsequences with bit vectors, for all windows of all
distinct headings of an Arrow batch at once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
FILTER_KEYWORDS = [
    "content",
    "contents",
    "table of contents",
    "index",
    "summary",
    "preface",
    "foreword",
    "acknowledgement",
    "acknowledgment",
    "acknowledgements",
    "acknowledgments",
    "references",
    "reference",
    "bibliography",
    "",
    "about",
    "about this",
    "revision history",
    "change log",
    "version history",
    "glossary",
    "abbreviations",
    "disclaimer",
    "nomenclature",
    "notation",
    "list of figures",
    "list of tables",
    "list of symbols",
    "figure",
]
TECHNICAL_KEYWORDS = [
    "analysis",
    "calculation",
    "model",
    "method",
    "theory",
    "equation",
    "performance",
    "flow",
    "physics",
    "aerodynamic",
    "dynamics",
    "component",
    "system",
    "design",
    "optimization",
    "simulation",
]
THRESHOLD = 85
TECHNICAL_THRESHOLD_WORDS = 90
TECHNICAL_THRESHOLD_OTHER = 97

_KEYWORDS = [k for k in FILTER_KEYWORDS if k]
_WORDS = [frozenset(k.split()) for k in _KEYWORDS]
_ALPHABET = sorted(set("".join(_KEYWORDS)))
# Letter number of a code point; 0 for a character that no keyword has.
_LETTER = np.zeros(129, dtype=np.int16)
_LETTER[[ord(c) for c in _ALPHABET]] = np.arange(1, len(_ALPHABET) + 1)
_GAP = max(map(len, _KEYWORDS)) - 1
# ratio >= 85 needs len(heading) <= (200/85 - 1) * len(keyword)
_RATIO_MAX = int((200 / THRESHOLD - 1) * (_GAP + 1))


def is_technical(normalized: Column) -> Column:
    """One of the technical words occurs anywhere, also inside another word."""
    return normalized.rlike("|".join(TECHNICAL_KEYWORDS))


def settled_boilerplate(normalized: Column) -> Column:
    """Containment either way scores 100, above every threshold."""
    keyword_inside = normalized.rlike("|".join(_KEYWORDS))
    inside_keyword = F.instr(F.lit("\n".join(_KEYWORDS)), normalized) > 0
    return keyword_inside | inside_keyword


def is_boilerplate(normalized: Column) -> Column:
    settled = settled_boilerplate(normalized)
    scored = _score_udf(F.when(~settled, normalized), is_technical(normalized))
    return settled | F.coalesce(scored, F.lit(False))


def _letters(codes: np.ndarray) -> np.ndarray:
    return _LETTER[np.minimum(codes, 128)]


def _grid(texts: list[str], width: int) -> np.ndarray:
    """Letter numbers of texts of at most ``width`` characters, a row each, padded with 0."""
    return _letters(np.array(texts, dtype=f"U{width}").view(np.uint32).reshape(len(texts), width))


def _masks(patterns: np.ndarray) -> np.ndarray:
    """Per pattern (row of letters) and letter number, the bit set of its positions."""
    masks = np.zeros((len(patterns), len(_ALPHABET) + 1), dtype=np.int32)
    rows = np.arange(len(patterns))
    for bit in range(patterns.shape[1]):
        masks[rows, patterns[:, bit]] |= 1 << bit
    masks[:, 0] = 0
    return masks


def _advance(state: np.ndarray, masks: np.ndarray, full: np.ndarray) -> np.ndarray:
    """One text character of the bit-vector LCS recurrence (Hyyro 2004)."""
    hit = state & masks
    return ((state + hit) | (state - hit)) & full


class _Texts:
    """Texts laid end to end, with gaps that no window can bridge."""

    def __init__(self, texts: list[str]):
        gap = "\0" * _GAP
        joined = gap + "".join(text + gap for text in texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        self.letters = _letters(codes)
        self.seen = np.concatenate([[0], np.cumsum(codes != 0)])
        self.lengths = np.array([len(t) for t in texts])
        # a text's share of the windows begins with the gap before it
        self.bounds = np.concatenate([[0], np.cumsum(self.lengths + _GAP)])

    def letter_counts(self) -> np.ndarray:
        """How often each text (row) has each letter."""
        size = len(_ALPHABET) + 1
        owner = np.repeat(np.arange(len(self.lengths)), self.lengths + _GAP)
        cells = owner * size + self.letters[: len(owner)]
        counts = np.bincount(cells, minlength=len(self.lengths) * size)
        return counts.reshape(-1, size)[:, 1:].astype(np.int32)

    def _widths(self, size: int) -> np.ndarray:
        return self.seen[size:] - self.seen[:-size]

    def best_of_one(self, pattern: str) -> np.ndarray:
        """Best window score of a pattern in each text; 0 where none can reach the threshold."""
        size, widths = len(pattern), self._widths(len(pattern))
        grid = _grid([pattern], size)
        masks = _masks(grid)[0]
        # a window cannot have more in common than letters that the pattern has
        known = np.concatenate([[0], np.cumsum((masks != 0)[self.letters])])
        at = np.flatnonzero(known[size:] - known[:-size] >= _NEEDED * (size + widths))
        full = np.int32((1 << size) - 1)
        state = np.full(len(at), full, dtype=np.int32)
        for offset in range(size):
            state = _advance(state, masks[self.letters[at + offset]], full)
        scores = np.zeros(len(widths))
        scores[at] = 200.0 * (size - np.bitwise_count(state).astype(np.int32)) / (size + widths[at])
        return np.maximum.reduceat(scores, self.bounds[:-1])

    def best_of_many(self, patterns: list[str], size: int) -> np.ndarray:
        """Best window score of each pattern (row, all of one size) in each text."""
        widths = self._widths(size)
        masks = _masks(_grid(patterns, size))
        full = np.int32((1 << size) - 1)
        state = np.full((len(patterns), len(widths)), full, dtype=np.int32)
        for offset in range(size):
            state = _advance(state, masks[:, self.letters[offset : offset + len(widths)]], full)
        common = size - np.bitwise_count(state).astype(np.int32)
        return np.maximum.reduceat(200.0 * common / (size + widths), self.bounds[:-1], axis=1)


_NEEDED = THRESHOLD / 200
_KEYWORD_TEXTS = _Texts(_KEYWORDS)
_KEYWORD_LENGTHS = _KEYWORD_TEXTS.lengths
_KEYWORD_COUNTS = _KEYWORD_TEXTS.letter_counts()


def candidates(headings: list[str]) -> np.ndarray:
    """Headings that share enough letters with some keyword to reach the threshold.

    A score of 85 needs 0.425 * (shorter + window) letters in common, and the
    window has at least those: 0.425 / 0.575 of the shorter side.
    """
    texts = _Texts(headings)
    shared = np.minimum(texts.letter_counts()[:, None, :], _KEYWORD_COUNTS[None, :, :]).sum(2)
    shorter = np.minimum(texts.lengths[:, None], _KEYWORD_LENGTHS[None, :])
    return (shared >= _NEEDED / (1 - _NEEDED) * shorter - 1e-9).any(axis=1)


def keyword_scores(headings: list[str]) -> np.ndarray:
    """max(ratio, partial_ratio) of each non-empty heading with each keyword.

    Exact from the threshold on; a lower score may come out lower still.
    """
    texts = _Texts(headings)
    lengths = texts.lengths
    scores = np.zeros((len(headings), len(_KEYWORDS)))
    # The keyword is the shorter side: slide it over the headings.
    for column, keyword in enumerate(_KEYWORDS):
        scores[:, column] = np.where(lengths >= len(keyword), texts.best_of_one(keyword), 0)
    # The heading is the shorter side: slide it over the keywords.
    for size in sorted(set(lengths[lengths <= _GAP + 1].tolist())):
        rows = np.flatnonzero(lengths == size)
        found = _KEYWORD_TEXTS.best_of_many([headings[r] for r in rows], size)
        scores[rows] = np.maximum(scores[rows], np.where(_KEYWORD_LENGTHS >= size, found, 0))
    # Both sides whole.
    rows = np.flatnonzero(lengths <= _RATIO_MAX)
    if len(rows):
        letters = _grid([headings[r] for r in rows], _RATIO_MAX)
        masks = _masks(_grid(_KEYWORDS, _GAP + 1))
        full = ((1 << _KEYWORD_LENGTHS) - 1).astype(np.int32)[:, None]
        state = np.repeat(full, len(rows), axis=1)
        for offset in range(_RATIO_MAX):
            state = _advance(state, masks[:, letters[:, offset]], full)
        common = _KEYWORD_LENGTHS[:, None] - np.bitwise_count(state).astype(np.int32)
        whole = 200.0 * common / (_KEYWORD_LENGTHS[:, None] + lengths[rows][None, :])
        scores[rows] = np.maximum(scores[rows], whole.T)
    return scores


def passes(headings: list[str], technical: list[bool]) -> np.ndarray:
    """Whether any keyword reaches the threshold that holds for the heading."""
    verdicts = np.zeros(len(headings), dtype=bool)
    rows = np.flatnonzero(candidates(headings))
    if not len(rows):
        return verdicts
    limits = np.full((len(rows), len(_KEYWORDS)), float(THRESHOLD))
    for i, row in enumerate(rows):
        if technical[row]:
            words = set(headings[row].split())
            limits[i] = [
                TECHNICAL_THRESHOLD_WORDS if need <= words else TECHNICAL_THRESHOLD_OTHER
                for need in _WORDS
            ]
    verdicts[rows] = (keyword_scores([headings[r] for r in rows]) >= limits).any(axis=1)
    return verdicts


def _blocks(headings: list[str], limit: int = 200_000):
    """Runs of headings whose laid-out text stays near ``limit`` characters."""
    begin, size = 0, 0
    for i, heading in enumerate(headings):
        if size and size + len(heading) + _GAP > limit:
            yield begin, i
            begin, size = i, 0
        size += len(heading) + _GAP
    yield begin, len(headings)


@F.pandas_udf(T.BooleanType())
def _score_udf(heading: pd.Series, technical: pd.Series) -> pd.Series:
    todo = pd.DataFrame({"h": heading, "t": technical}).dropna(subset=["h"])
    out = pd.Series([None] * len(heading), index=heading.index, dtype="object")
    if todo.empty:
        return out
    distinct = todo.drop_duplicates("h")
    headings, flags = distinct["h"].tolist(), distinct["t"].tolist()
    verdicts = np.concatenate([passes(headings[a:b], flags[a:b]) for a, b in _blocks(headings)])
    out[todo.index] = todo["h"].map(dict(zip(headings, verdicts.tolist())))
    return out
