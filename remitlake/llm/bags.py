"""Terms of a text by one translation of its bytes and a split at the blanks that it leaves."""

from __future__ import annotations

from collections.abc import Iterator

#: Bytes of a text whose terms are held as a list at once.
PIECE_BYTES = 4 << 20


def translate_table(digits: bool) -> bytes:
    """For ``bytes.translate``: A-Z become a-z, every separator a blank, what belongs to a term stays.

    Terms consist of ASCII letters, of digits if ``digits``, and of every character beyond ASCII, whose
    UTF-8 bytes are all above 0x7F.
    """
    table = bytearray(b" " * 128) + bytes(range(128, 256))
    for low in range(ord("a"), ord("z") + 1):
        table[low] = table[low - 32] = low
    if digits:
        for digit in range(ord("0"), ord("9") + 1):
            table[digit] = digit
    return bytes(table)


def terms(text: bytes | None, table: bytes, most: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists from pieces of about ``most`` bytes; null has none."""
    clean = (text or b"").translate(table)
    low = 0
    while low < len(clean):
        high = clean.find(b" ", low + most)
        high = len(clean) if high < 0 else high
        yield clean[low:high].split()
        low = high
