"""Rolling hashes over whole Arrow batches of texts.

The polynomial hash of any stretch of bytes or words comes from two prefix sums, so
that the hashes of all windows of a batch are a handful of vector operations. The sums
are modulo 2**64 with an odd base, whose powers have inverses.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes that one round of vector operations takes in; longer texts go in slices. A round
#: holds some fifteen numbers for each byte, and a worker keeps the room that it once took.
ROUND_BYTES = 1 << 18

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_SEEDS = (20240611, 771)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as far as needed so far."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self._up = self._down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            size = max(n, 2 * len(self._up))
            for name, base in (("_up", self.base), ("_down", self.inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self._up[:n], self._down[:n]


_POWERS = tuple(Powers(b) for b in _BASES)
_BYTES = tuple(np.random.default_rng(s).integers(1, 1 << 63, 256, dtype=np.uint64) for s in _SEEDS)


class Rolling:
    """Hashes of stretches of a sequence of 64-bit values; ``kind`` picks one of two
    independent hash functions."""

    def __init__(self, values: np.ndarray, kind: int = 0) -> None:
        up, self._down = _POWERS[kind].upto(len(values) + 1)
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=self._sums[1:])

    @classmethod
    def of_bytes(cls, data: np.ndarray, kind: int = 0) -> Rolling:
        return cls(_BYTES[kind][data], kind)

    def every(self, width: int) -> np.ndarray:
        """Hashes of all windows of ``width`` values."""
        n = max(0, len(self._sums) - width)
        return (self._sums[width:] - self._sums[:n]) * self._down[:n]

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the stretches from ``start`` up to ``end``."""
        return (self._sums[end] - self._sums[start]) * self._down[start]


@dataclass
class Round:
    """Texts, or one slice of a long text, laid end to end.

    ``row`` is the batch's row of each text, ``begin`` and ``end`` are its bounds in
    ``data``, ``shift`` is what to add to a place in ``data`` to get the place in the
    text. Places from ``own_from`` up to ``own_to`` belong to this round; the rest of a
    slice is there to look at.
    """

    data: np.ndarray
    row: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    shift: np.ndarray
    own_from: int
    own_to: int


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", np.uint8), bounds


def rounds(column: pa.Array, halo: int, size: int = ROUND_BYTES) -> Iterator[Round]:
    """Cut a batch into rounds of about ``size`` bytes.

    A text of more than ``size`` bytes is cut into slices that overlap by ``halo``
    bytes on either side.
    """
    data, bounds = buffers(column)
    lengths = np.diff(bounds)
    first = 0
    while first < len(lengths):
        if lengths[first] > size:
            lo, hi = int(bounds[first]), int(bounds[first + 1])
            for at in range(lo, hi, size):
                left, right = max(lo, at - halo), min(hi, at + size + halo)
                yield Round(
                    data[left:right],
                    np.array([first]),
                    np.array([0]),
                    np.array([right - left]),
                    np.array([left - lo]),
                    at - left,
                    min(hi, at + size) - left,
                )
            first += 1
            continue
        last = int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1
        last = max(first + 1, min(last, len(lengths)))
        too_long = np.flatnonzero(lengths[first:last] > size)
        if len(too_long):
            last = first + int(too_long[0])
        base = int(bounds[first])
        begin, end = bounds[first:last] - base, bounds[first + 1 : last + 1] - base
        text = data[base : int(bounds[last])]
        yield Round(text, np.arange(first, last), begin, end, -begin, 0, len(text))
        first = last


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers ``start[i], start[i] + 1, ...``, ``count[i]`` of them, end to end."""
    total = int(count.sum())
    ends = np.cumsum(count)
    return np.arange(total) - np.repeat(ends - count, count) + np.repeat(start, count)


#: Low bits that hold a place within a round, above the largest round with its halos.
_PLACE_BITS = np.uint64(22)
_PLACE_MASK = np.uint64((1 << 22) - 1)


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of each ``width`` neighbours, the last one of equals.

    Values are compared by their upper 42 bits.
    """
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    backwards = _PLACE_MASK - np.arange(len(values), dtype=np.uint64)
    best = (values & ~_PLACE_MASK) | backwards
    reach = 1
    while 2 * reach <= width:  # the minimum of 1, 2, 4, ... neighbours
        best = np.minimum(best[: len(best) - reach], best[reach:])
        reach *= 2
    best = np.minimum(best[:n], best[width - reach : width - reach + n])
    return (_PLACE_MASK - (best & _PLACE_MASK)).astype(np.int64)


#: The white space that separates words: space and \x09 to \x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_bounds(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; a word ends where the next text begins."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = _SPACE[data]
    starts = ~space
    starts[1:] &= space[:-1]
    first = begin[begin < len(data)]
    starts[first] = ~space[first]
    ends = ~space
    ends[:-1] &= space[1:]
    ends[-1] = not space[-1]
    before = first[first > 0] - 1
    ends[before] = ~space[before]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


@dataclass
class Words:
    """Words of some rows of a batch.

    Row ``row[i]`` has the words from ``begin[i]`` up to ``end[i]``; every word has a
    hash and its bounds in the batch's bytes.
    """

    row: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    start: np.ndarray
    stop: np.ndarray


def _hash_words(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, ...]:
    start, stop = word_bounds(data, begin)
    return mix(Rolling.of_bytes(data, 0).between(start, stop)), start, stop


def words(column: pa.Array, size: int = ROUND_BYTES) -> Iterator[Words]:
    """Words of a batch, some whole texts at a time.

    A text of more than ``size`` bytes is hashed in slices that end at white space, so
    that no word is cut.
    """
    data, bounds = buffers(column)
    lengths = np.diff(bounds)
    first = 0
    while first < len(lengths):
        lo = int(bounds[first])
        if lengths[first] > size:
            hi, parts, at = int(bounds[first + 1]), [], lo
            while at < hi:
                cut = min(hi, at + size)
                while cut < hi and not _SPACE[data[cut]]:
                    near = np.flatnonzero(_SPACE[data[cut : cut + size]])
                    cut = min(hi, cut + (int(near[0]) if len(near) else size))
                hashes, start, stop = _hash_words(data[at:cut], np.zeros(1, np.int64))
                parts.append((hashes, start + at, stop + at))
                at = cut
            hashes, start, stop = (np.concatenate(x) for x in zip(*parts))
            one = np.array([first])
            yield Words(one, np.array([0]), np.array([len(hashes)]), hashes, start, stop)
            first += 1
            continue
        last = int(np.searchsorted(bounds, lo + size, "right")) - 1
        last = max(first + 1, min(last, len(lengths)))
        too_long = np.flatnonzero(lengths[first:last] > size)
        if len(too_long):
            last = first + int(too_long[0])
        begin = bounds[first:last] - lo
        hashes, start, stop = _hash_words(data[lo : int(bounds[last])], begin)
        edges = np.searchsorted(start, np.append(begin, int(bounds[last]) - lo), "left")
        yield Words(np.arange(first, last), edges[:-1], edges[1:], hashes, start + lo, stop + lo)
        first = last
