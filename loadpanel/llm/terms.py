"""Terms of texts as UTF-8 bytes."""

from __future__ import annotations


def separators(*ranges: tuple[int, int]) -> bytes:
    """A table for ``bytes.translate``: the bytes of the ranges are spaces, A-Z are in lower case, all else stays.

    ``text.translate(table).split()`` then gives the maximal runs of all other bytes. Every byte of a character
    beyond ASCII is above 0x7F, so runs of bytes are runs of characters.
    """
    out = bytearray(range(256))
    for c in range(ord("A"), ord("Z") + 1):
        out[c] = c + 32
    for low, high in ranges:
        out[low : high + 1] = b" " * (high + 1 - low)
    return bytes(out)


#: Letters and all that is not ASCII.
LETTERS = separators((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
#: The same with digits.
LETTERS_AND_DIGITS = separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
