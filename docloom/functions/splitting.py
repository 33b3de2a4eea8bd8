"""Cutting a long text into overlapping pieces at natural boundaries.

The cursor of each piece depends on where the previous one ended, so no window
expression can place the cuts. A text that fits its budget never gets here: the
caller passes null for it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Boundary, how far back from the window end it is sought, and how
# many characters of the boundary stay with the piece. Tried in this order.
BOUNDARIES = [
    (re.compile(r"[.!?](?=\s)"), 200, 1),
    (re.compile(r"\n(?=\n)"), 200, 2),
    (re.compile(r"\n"), 100, 1),
    (re.compile(r"\s"), 50, 1),
]


def cut_before(text: str, start: int, limit: int) -> int:
    """Cut position for a piece that starts at ``start`` and has to end by ``limit``.

    The last boundary of a kind counts, unless it lies exactly at the limit; then
    the next kind is tried. A blank line across the limit cuts one past it.
    """
    for pattern, reach, kept in BOUNDARIES:
        first = max(start, limit - reach) + 1
        # two characters past the limit, for the patterns that look ahead
        found = [m.start() for m in pattern.finditer(text, first, limit + 1) if m.start() < limit]
        if found and found[-1] + kept != limit:
            return found[-1] + kept
    return limit


def spans(text: str, budget: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Half-open ranges of the pieces; a range shorter than the overlap advances by one."""
    start, size = 0, len(text)
    while start < size:
        limit = start + budget
        end = cut_before(text, start, limit) if limit < size else limit
        yield start, end
        if end >= size:
            return
        start = max(start + 1, end - overlap)


def pieces(text: str, budget: int, overlap: int) -> list[str]:
    stripped = (text[a:b].strip() for a, b in spans(text, budget, overlap))
    return [piece for piece in stripped if piece]


@F.pandas_udf(T.ArrayType(T.StringType()))
def _pieces_udf(text: pd.Series, budget: pd.Series, overlap: pd.Series) -> pd.Series:
    return pd.Series(
        [
            None if t is None else pieces(t, int(b), int(o))
            for t, b, o in zip(text, budget, overlap)
        ],
        index=text.index,
        dtype="object",
    )


def split_column(text: Column, budget: Column, overlap: int) -> Column:
    """Pieces of a text; a text within its budget stays whole, even when empty.

    Python only sees the texts that are too long.
    """
    long_text = F.when(F.length(text) > budget, text)
    return F.coalesce(_pieces_udf(long_text, budget, F.lit(overlap)), F.array(text))
