"""Token ids of whole texts, word by word from a bounded cache.

Both vocabularies split a text at white space before merging, so the ids of a text are the ids
of its pieces one after the other as long as every cut is one the tokenizer makes anyway. Texts
are cut only at a lone space or line feed between two characters that are no white space; all
else (runs of white space, tabs, texts that begin or end with white space) stays in one piece.
A piece that the cache lacks is put together from its runs of letters, digits and marks, which
both tokenizers split too and which repeat far more than whole pieces do; the library is asked
for each new run, and for pieces with anything else in them.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable

END_ID = 1
# Pieces and runs kept in each of the two generations of a worker's caches.
CACHE_PIECES, CACHE_RUNS = 100_000, 400_000

# White space other than the space and the line feed, and runs of those two.
_UNUSUAL = ("\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "  ", "\n\n", " \n", "\n ")
_UNUSUAL_WIDE = ("\x85", "\xa0", "\u1680", *map(chr, range(0x2000, 0x200b)), "\u2028", "\u2029",
                 "\u202f", "\u205f", "\u3000")
# Latin letters (but the one whose lower case is two characters), digits, and ASCII marks but the
# apostrophe, which begins contractions: runs of one kind are split from each other wherever they stand.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
_MARKS = r"!-&(-/:-@\[-`{-~"
_PLAIN = re.compile(f"[{_LETTERS}0-9{_MARKS}]+")
_RUNS = re.compile(f"[{_LETTERS}]+|[0-9]+|[{_MARKS}]+")
# Texts of nothing else, and their runs: with the space before them, or digit by digit.
_PLAIN_TEXT = re.compile(f"[{_LETTERS}0-9{_MARKS} \n]+")
_SPACED_RUNS = re.compile(f" ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+|\n")
_BARE_RUNS = re.compile(f"[{_LETTERS}]+|[0-9]|[{_MARKS}]+")


class _Cache(dict):
    """Ids of strings; the least recently made generation goes when the newer one is full."""

    def __init__(self, encode: Callable[[str], bytes], size: int):
        self.encode, self.size, self.old = encode, size, {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        ids = self.old.get(key)
        if ids is None:
            ids = self.encode(key)
        self[key] = ids
        return ids


def byte_alphabet() -> dict[int, str]:
    """The byte-level vocabularies' character for each byte: printable ones of Latin-1 stand for
    themselves, the others are numbered from 256 on."""
    kept = {*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)}
    others = [b for b in range(256) if b not in kept]
    return {b: chr(256 + k) for k, b in enumerate(others)}


class Encoder:
    """encode(texts): ids as little-endian unsigned 32-bit bytes, the end id included.

    ``spaces``: the vocabulary keeps a word's leading space and the line feeds (byte-level);
    otherwise white space is dropped and letters are lower-cased.
    """

    _loaded: dict[tuple[str, bool], "Encoder"] = {}

    @classmethod
    def of(cls, path: str, spaces: bool) -> "Encoder":
        """One encoder per worker process."""
        if (path, spaces) not in cls._loaded:
            cls._loaded[path, spaces] = cls(path, spaces)
        return cls._loaded[path, spaces]

    def __init__(self, path: str, spaces: bool):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.spaces = spaces
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model, self.alphabet = self.tokenizer.model, byte_alphabet()
        self.runs = _Cache(self._run, CACHE_RUNS)
        self.known = _Cache(self._spaced if spaces else self._piece, CACHE_PIECES)
        self.feed = self._whole("\n")
        self.end = END_ID.to_bytes(4, "little")

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _run(self, run: str) -> bytes:
        """Ids of a run of one kind, straight from the merges (digits without spaces come one by one)."""
        text = run if self.spaces else run.lower()
        text = text.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [x.id for x in self.model.tokenize(text)]).tobytes()

    def _piece(self, piece: str, before: str = "") -> bytes:
        """Ids of a piece; ``before`` goes with its first run."""
        if not _PLAIN.fullmatch(piece):
            return self._whole(before + piece)
        found = (_RUNS if self.spaces else _BARE_RUNS).findall(piece)
        found[0] = before + found[0]
        return b"".join(map(self.runs.__getitem__, found))

    def _spaced(self, piece: str) -> bytes:
        """A piece that begins with a line feed stands after one; any other after a space."""
        if piece[0] == "\n":
            return self.feed + (self._piece(piece[1:]) if len(piece) > 1 else b"")
        return self._piece(piece, " ")

    def _careful(self, text: str) -> bytes:
        """Cut only before a space that stands between two other characters."""
        parts = re.split(r"(?<=\S)(?= \S)", text)
        return b"".join(map(self._whole, parts))

    def _one(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.spaces:
            if _PLAIN_TEXT.fullmatch(text):
                return b"".join(map(self.runs.__getitem__, _BARE_RUNS.findall(text)))
            # Python splits at these four controls, the tokenizer does not.
            if any(x in text for x in ("\x1c", "\x1d", "\x1e", "\x1f")):
                return self._whole(text)
            return b"".join(map(self.known.__getitem__, text.split()))
        if (text[0] in " \n" or text[-1] in " \n" or any(x in text for x in _UNUSUAL)
                or not text.isascii() and any(x in text for x in _UNUSUAL_WIDE)):
            return self._careful(text)
        if _PLAIN_TEXT.fullmatch(text):
            return b"".join(map(self.runs.__getitem__, _SPACED_RUNS.findall(text)))
        ids = b"".join(map(self.known.__getitem__, f"\n{text}".replace("\n", " \n").split(" ")[1:]))
        return ids[len(self.feed):]  # the line feed put in front

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each text (none for null or empty ones), then the end id."""
        return [self._one(t) + self.end for t in texts]
