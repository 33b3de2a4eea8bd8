"""Fuzzy match of headings with any number of keywords.

A score of 85 bounds the letters that must be put in or taken out to get from the shorter
text to a stretch of the longer one, by 0.3 per letter of the shorter, and each of them
breaks two of its pairs of neighbouring letters. So some 0.4 of the shorter text's pairs
occur within one stretch of the longer text. An index of the keywords by pairs finds those
that have enough in common with a heading; the places of the common pairs tell the
stretches that can reach the score; only these are scored, exactly, with longest common
subsequences by bit vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np

from docloom.functions.boilerplate import (
    TECHNICAL_THRESHOLD_OTHER,
    TECHNICAL_THRESHOLD_WORDS,
    THRESHOLD,
)


def pairs_needed(shorter: np.ndarray | int) -> np.ndarray:
    """Pairs of a text of this length that a stretch must have to score 85."""
    return np.maximum(1, np.ceil(0.4 * np.asarray(shorter) - 1 - 1e-9)).astype(np.int64)


def _pairs(text: str) -> list[str]:
    return [text[i : i + 2] for i in range(len(text) - 1)]


class Pattern:
    """A text with the bit sets of the places of its letters."""

    def __init__(self, text: str) -> None:
        self.text, self.size = text, len(text)
        self.full = (1 << self.size) - 1
        self.masks: dict[str, int] = {}
        for i, letter in enumerate(text):
            self.masks[letter] = self.masks.get(letter, 0) | 1 << i
        self.pairs = set(_pairs(text))

    def score(self, other: str) -> float:
        """Share of letters in common, in order, in both texts whole: 0 to 100."""
        state, masks = self.full, self.masks
        for letter in other:
            hit = state & masks.get(letter, 0)
            state = ((state + hit) | (state - hit)) & self.full
        return 200.0 * (self.size - state.bit_count()) / (self.size + len(other))

    def slides(self, longer: str, limit: float) -> bool:
        """Whether a stretch of ``longer`` as long as this text, or shorter at its ends, scores
        ``limit``, which is 85 at least."""
        size, needed = self.size, int(pairs_needed(self.size))
        known = [0, *accumulate(p in self.pairs for p in _pairs(longer))]
        for start in range(1 - size, len(longer)):
            begin, end = max(start, 0), min(start + size, len(longer))
            if size > 1 and (end - begin < 2 or known[end - 1] - known[begin] < needed):
                continue
            if self.score(longer[begin:end]) >= limit:
                return True
        return False


def matches(heading: Pattern, keyword: Pattern, limit: float) -> bool:
    """Whether the whole texts, or the shorter and a stretch of the longer, score ``limit``."""
    if keyword.text in heading.text or heading.text in keyword.text:
        return True
    most = (200.0 / THRESHOLD - 1) * min(heading.size, keyword.size)
    if max(heading.size, keyword.size) <= most and keyword.score(heading.text) >= limit:
        return True
    if keyword.size <= heading.size and keyword.slides(heading.text, limit):
        return True
    return heading.size <= keyword.size and heading.slides(keyword.text, limit)


class KeywordIndex:
    """Keywords by the pairs of letters they have; empty ones don't count."""

    def __init__(self, keywords: list[str]) -> None:
        distinct = sorted({k for k in keywords if k})
        self.patterns = [Pattern(k) for k in distinct]
        self.words = [frozenset(k.split()) for k in distinct]
        self.lengths = np.array([p.size for p in self.patterns], np.int64)
        self.needed = pairs_needed(self.lengths)
        self.letters = set("".join(distinct))
        self.single = {k for k in distinct if len(k) == 1}
        places: dict[str, list[int]] = {}
        for number, keyword in enumerate(distinct):
            for pair in _pairs(keyword):
                places.setdefault(pair, []).append(number)
        # a keyword is listed as often as it has the pair
        self.listed = {pair: np.array(numbers, np.int64) for pair, numbers in places.items()}
        self.once = {pair: np.unique(numbers) for pair, numbers in self.listed.items()}

    def candidates(self, heading: str) -> np.ndarray:
        """Keywords that have enough pairs in common with a heading of two letters or more."""
        found = [p for p in _pairs(heading) if p in self.listed]
        if not found:
            return np.zeros(0, np.int64)
        size = len(self.patterns)
        # as many places of the heading have a pair of the keyword
        here = np.bincount(np.concatenate([self.once[p] for p in found]), minlength=size)
        fits = (self.lengths <= len(heading)) & (here >= self.needed)
        longer = self.lengths >= len(heading)
        if longer.any():
            there = np.bincount(np.concatenate([self.listed[p] for p in set(found)]), minlength=size)
            fits |= longer & (there >= pairs_needed(len(heading)))
        return np.flatnonzero(fits)

    def passes(self, heading: str, technical: bool) -> bool:
        """Whether any keyword reaches the threshold that holds for the heading."""
        if not self.patterns:
            return False
        if not self.single.isdisjoint(heading):
            return True
        if len(heading) < 2:
            return heading in self.letters or not heading
        pattern, words = Pattern(heading), set(heading.split()) if technical else set()
        for number in self.candidates(heading):
            limit = THRESHOLD
            if technical:
                inside = self.words[number] <= words
                limit = TECHNICAL_THRESHOLD_WORDS if inside else TECHNICAL_THRESHOLD_OTHER
            if matches(pattern, self.patterns[number], limit):
                return True
        return False


def verdicts(index: KeywordIndex, headings: Iterator[tuple[str, bool]]) -> list[bool]:
    """``passes`` of each heading; a repeated one is looked at once."""
    known: dict[tuple[str, bool], bool] = {}
    out = []
    for key in headings:
        if key not in known:
            known[key] = index.passes(*key)
        out.append(known[key])
    return out
