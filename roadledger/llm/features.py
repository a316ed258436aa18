"""Statistics of whole texts as numbers, by array operations on their bytes."""

from __future__ import annotations

import numpy as np

# Symbols that prose rarely has, and the white space that parts words.
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
SPACE = np.zeros(256, dtype=bool)
SPACE[list(b"\x20\x09\x0a\x0b\x0c\x0d")] = True

# Character classes of a histogram: one number for each byte. Bytes that continue a code point
# belong to no class, so that each code point counts once.
CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "mark", "symbol", "wide", "other")
_CLASS = np.full(256, CLASSES.index("other"), dtype=np.intp)
for _name, _chars in (
    ("lower", b"abcdefghijklmnopqrstuvwxyz"), ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("digit", b"0123456789"), ("space", b" \t"), ("line", b"\n\r\x0b\x0c"), ("stop", b".,"),
    ("mark", b"!?;:'\"()-"), ("symbol", b"#*$%&|<>"),
):
    _CLASS[list(_chars)] = CLASSES.index(_name)
_CLASS[0xC0:] = CLASSES.index("wide")
_CONTINUES = np.zeros(256, dtype=bool)
_CONTINUES[0x80:0xC0] = True


def class_counts(data: bytes) -> np.ndarray:
    """Code points in each of ``CLASSES``."""
    by_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    by_byte[_CONTINUES] = 0
    return np.bincount(_CLASS, weights=by_byte, minlength=len(CLASSES)).astype(np.int64)


def points(data: bytes) -> int:
    """Code points of UTF-8."""
    b = np.frombuffer(data, np.int8)
    return int((b >= -64).sum())


def word_numbers(words: list[bytes]) -> np.ndarray:
    """A number for each different word, in order of first sight."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def repeated_words(numbers: np.ndarray) -> int:
    """Words within 3-word windows that the text has at least twice, the first included."""
    if len(numbers) < 4:
        return 0
    n = np.uint64(numbers.max() + 1)
    k = numbers.astype(np.uint64)
    if int(n) ** 3 < 1 << 64:
        windows = (k[:-2] * n + k[1:-1]) * n + k[2:]
    else:  # pairs first, so that three numbers always fit
        _, pairs = np.unique(k[:-1] * n + k[1:], return_inverse=True)
        windows = pairs[:-1].astype(np.uint64) * n + k[2:]
    order = np.argsort(windows)
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(windows), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.zeros(len(numbers), dtype=bool)
    for shift in range(3):
        hit[shift:shift + len(windows)] |= twice
    return int(hit.sum())


def repeated_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line of the text."""
    lines = [line for line in data.split(b"\n") if not _blank(line)]
    return len(lines) - len(set(lines))


def _blank(line: bytes) -> bool:
    return not line.strip(b"\x20\x09\x0a\x0b\x0c\x0d")


def base_counts(data: bytes) -> tuple[list[bytes], np.ndarray, tuple[int, int, int, int]]:
    """Words, their numbers, and (word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    words = data.split()
    numbers = word_numbers(words)
    raw = np.frombuffer(data, np.uint8)
    symbols = int(SYMBOLS[raw].sum())
    chars = points(data) - int(SPACE[raw].sum())
    return words, numbers, (chars, symbols, repeated_lines(data), repeated_words(numbers))
