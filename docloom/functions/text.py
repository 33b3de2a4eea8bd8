"""Text helpers that follow Python's Unicode rules on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters for which str.isspace() holds; the last one is U+3000.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# Java's Unicode \s lacks the four separators U+001C to U+001F.
SPACE = r"[\s\x1c-\x1f]"
BETWEEN_WORDS = rf"(?U){SPACE}++"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim all Unicode white space; touches only the two ends of the text."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def word_count(c: Column | str) -> Column:
    """Words of a text that has no white space at its ends; cheaper than matching them."""
    words = F.size(F.split(_col(c), BETWEEN_WORDS))
    return F.when(_col(c) == "", 0).otherwise(words)


def unify_newlines(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"\r\n?", "\n")


def stem(c: Column | str) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(_col(c), r"(?s)(?<=.)\.[^.]+\z", "")


def clean_title(c: Column | str) -> Column:
    """Title part of a chunk id: letters, digits, '-', '_', at most 30 characters."""
    kept = F.trim(F.regexp_replace(_col(c), r"[^\p{L}\p{N} _-]", ""))
    return F.left(F.translate(kept, " ", "_"), F.lit(30))


def normalize_heading(c: Column | str) -> Column:
    """Lower case, punctuation to blanks, white space collapsed."""
    spaced = F.regexp_replace(F.lower(_col(c)), r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f]", " ")
    return F.trim(F.regexp_replace(spaced, f"(?U){SPACE}+", " "))


def preview(c: Column | str, size: int = 200) -> Column:
    return F.concat(F.left(_col(c), F.lit(size)), F.lit("..."))


def tail(c: Column | str, size: Column) -> Column:
    """Last ``size`` characters for ``size`` > 0; the whole text when shorter."""
    return F.right(_col(c), size)
