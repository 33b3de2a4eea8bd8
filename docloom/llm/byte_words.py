"""Words of UTF-8 texts by a table of bytes.

A word is a run of anything but \\x00 to \\x2F, \\x3A to \\x60 and \\x7B to \\x7F, after A to Z
became a to z: digits, small letters, and every character beyond ASCII.
"""

from __future__ import annotations

from collections.abc import Iterator

#: Bytes of a text that are split at a time; a long text is never held as one list.
SLICE_BYTES = 1 << 20


def _table() -> bytes:
    kept = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
    return bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in kept else 0x20 for b in range(256))


TABLE = _table()


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TABLE).split()


def slices(
    text: bytes | None, overlap: int, size: int = SLICE_BYTES
) -> Iterator[tuple[list[bytes], int]]:
    """Lists of the text's words, and how many of their first ones were last in the list before.

    Those are up to ``overlap`` words, so that every run of ``overlap`` + 1 words is whole in
    one of the lists. Slices end at separators, so that no word is cut.
    """
    data = (text or b"").translate(TABLE)
    carried: list[bytes] = []
    at = 0
    while at < len(data):
        cut = data.find(b" ", at + size) if at + size < len(data) else -1
        cut = len(data) if cut < 0 else cut
        found = carried + data[at:cut].split()
        if len(found) > len(carried):
            yield found, len(carried)
            carried = found[-overlap:] if overlap else []
        at = cut
