"""Word rules shared by the operators, on UTF-8 bytes (ASCII classes are the same on bytes as on code points)."""

from __future__ import annotations

_UPPER = bytes(range(65, 91))
_KEEP = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
_LOWER = bytes(c + 32 if c in _UPPER else c for c in range(256))
_ALNUM = bytes(_LOWER[c] if _LOWER[c] in _KEEP else 32 for c in range(256))


def alnum_words(text: bytes | None) -> list[bytes]:
    """A-Z lowered; maximal runs of 0-9, a-z and all non-ASCII characters."""
    return text.translate(_ALNUM).split() if text else []


def space_words(text: bytes | None) -> list[bytes]:
    """A-Z lowered; maximal runs of anything but space and U+0009 to U+000D."""
    return text.translate(_LOWER).split() if text else []


def ascii_lower(text: bytes) -> bytes:
    return text.translate(_LOWER)
