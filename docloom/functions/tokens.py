"""Token counting with a pluggable counter."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A run of word characters is one token, any other visible character is one.
TOKEN = r"(?U)[\p{L}\p{N}_]++|[^\p{L}\p{N}_\s\x1c-\x1f]"


class PythonCounter:
    """A counter made of a function of one text; a text it fails on counts 0.

    Of a ``monotone`` counter a text never counts less than a beginning of it. Packing then
    looks for the end of a segment by doubling and halving, with a few calls a segment in
    place of one a part.
    """

    def __init__(self, count: Callable[[str], int], monotone: bool = False):
        self._count, self.monotone = count, monotone

    def of_text(self, text: str | None) -> int:
        try:
            return int(self._count(text)) if text is not None else 0
        except Exception:
            return 0

    def __call__(self, texts: Column) -> Column:
        @F.pandas_udf(T.LongType())
        def run(rows: pd.Series) -> pd.Series:
            return pd.Series([self.of_text(t) for t in rows], index=rows.index, dtype="int64")

        return run(texts)


# Maps a text column to a count column: a built-in expression or a PythonCounter.
Counter = Callable[[Column], Column]


def token_count(c: Column | str, counter: Counter | None = None) -> Column:
    """Tokens of a text; a null text, or a counter that yields null, counts 0."""
    c = F.col(c) if isinstance(c, str) else c
    counted = counter(c) if counter else F.regexp_count(c, F.lit(TOKEN))
    return F.coalesce(counted.cast("bigint"), F.lit(0).cast("bigint"))


def count_parts(parts: Column, counter: Counter | None = None) -> Column:
    return F.transform(parts, lambda p: token_count(p, counter))


def count_lists(lists: Column, counter: Counter | None = None) -> Column:
    return F.transform(lists, lambda parts: count_parts(parts, counter))
