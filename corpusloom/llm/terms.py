"""Terms of whole texts as UTF-8 bytes, with bounded memory for texts of any length."""

from __future__ import annotations

from collections.abc import Iterator

# Terms cut from a text at once.
SLICE_BYTES = 1 << 22


def cutter(digits: bool) -> bytes:
    """A byte table: A-Z to a-z, ASCII that is no letter (nor digit, if ``digits``) to a blank.

    Bytes above 7F belong to characters beyond ASCII and stay.
    """
    inside = set(b"abcdefghijklmnopqrstuvwxyz") | (set(b"0123456789") if digits else set())
    return bytes(b if b > 0x7F or b in inside else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


LETTERS = cutter(digits=False)
LETTERS_AND_DIGITS = cutter(digits=True)


def terms(text: bytes, table: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists; a list holds the terms of a few megabytes."""
    if len(text) <= SLICE_BYTES:
        yield text.translate(table).split()
        return
    at, text = 0, text.translate(table)
    while at < len(text):
        end = text.find(b" ", at + SLICE_BYTES)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end
