"""Licence recognition: sentences to identifiers, identifier sequences to licences.

The published passages are cut by the rule that cuts the documents, so each of their sentences,
clauses that end with a colon or semicolon included, is an identifier and each passage a rule.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .licence_texts import NAMES, PASSAGES, REPLACED, STATEMENTS

_PLAIN = bytes.maketrans(b"\1\2", b"  ")
_LEAD = re.compile(rb"\n[^a-z0-9\n]+")
_VERSION = re.compile(rb"([^a-z0-9])v\.")
_LATER = re.compile(rb"([0-9])\+")
# A whole run of signs that holds an end mark: each run is looked at once.
_END = re.compile(rb"(?<![^a-z0-9 \t\n\r\f\v])[^a-z0-9 \t\n\r\f\v.!?;:]*+[.!?;:][^a-z0-9 \t\n\r\f\v]*+(?:[ \t\n\r\f\v]|\Z)")
_BLANK = re.compile(rb"\n\n+")
_OTHER = re.compile(rb"[^a-z0-9\1\2]+")


def units(text: str) -> list[list[bytes]]:
    """Sentences of a text, each as its lines: ASCII words in lower case with single spaces.

    A sentence ends at ``.``, ``!``, ``?``, ``;`` or ``:``, closing marks after it included,
    before white space or the end, and at a line without a letter or digit. A line feed alone does
    not end it. Marks that begin a line (comment signs, bullets) do not count, nor does the point
    of ``v.`` or the colon after ``identifier``; a plus after a digit reads ``or later``.
    """
    low = b"\n" + text.encode("utf-8", "surrogatepass").lower().translate(_PLAIN)
    low = _LEAD.sub(b"\n", low).replace(b"identifier:", b"identifier ")
    low = _LATER.sub(rb"\1 or later ", _VERSION.sub(rb"\1v ", low))
    low = _BLANK.sub(b"\1", _END.sub(b"\1", low)).replace(b"\n", b"\2")
    found = ([line.strip() for line in unit.split(b"\2")] for unit in _OTHER.sub(b" ", low).split(b"\1"))
    return [lines for lines in ([x for x in unit if x] for unit in found) if lines]


def whole_sentences(text: str) -> list[bytes]:
    return [b" ".join(lines) for lines in units(text)]


class Rules:
    """Known sentences with their identifiers, and the identifier sequences that state a licence.

    Statements ("Released under the ...", SPDX lines and expressions of two licences) have the
    identifier ``<licence>-ref``; sentences of passages ``<licence>-<number>``.
    """

    def __init__(self):
        self.known: dict[bytes, tuple[str, ...]] = {}
        self.licence_of: dict[tuple[str, ...], str] = {}
        spdx = {name: name for name in NAMES} | REPLACED
        for licence, names in NAMES.items():
            self.licence_of[f"{licence}-ref",] = licence
            for name in names:
                for start in STATEMENTS:
                    for the in ("", "the "):
                        self._add(f"{start} {the}{name}", licence)
        for name, licence in spdx.items():
            self._add(f"SPDX-License-Identifier: {name}", licence)
            for other, second in spdx.items():
                for word in ("OR", "AND"):
                    self._add(f"SPDX-License-Identifier: {name} {word} {other}", licence, second)
        counts = Counter()
        for licence, passage in PASSAGES:
            sequence = []
            for s in whole_sentences(passage):
                if s not in self.known:
                    counts[licence] += 1
                    self.known[s] = (f"{licence}-{counts[licence]}",)
                sequence += self.known[s]
            self.licence_of.setdefault(tuple(sequence), licence)
        self.longest = max(map(len, self.licence_of))
        self.prefixes = {p for s in self.known for p in self._prefixes(s)}
        self.triggers = self._triggers()

    def _add(self, sentence: str, *licences: str) -> None:
        self.known.setdefault(whole_sentences(sentence)[0], tuple(f"{x}-ref" for x in licences))

    @staticmethod
    def _prefixes(sentence: bytes):
        words = sentence.split()
        return (b" ".join(words[:k]) for k in range(1, len(words) + 1))

    def _triggers(self) -> list[bytes]:
        """Words of which each known sentence has one: a text without them has no known sentence."""
        left = []
        for s in self.known:
            words = set(s.split())
            left.append({w for w in words if len(w) > 6} or {max(words, key=lambda w: (len(w), w))})
        out = []
        while left:
            counts = Counter(w for words in left for w in words)
            out.append(max(counts, key=lambda w: (counts[w], len(w), w)))
            left = [words for words in left if out[-1] not in words]
        return out

    def sentence_ids(self, text: str) -> list[str]:
        """Identifiers of the known sentences of a text, in order.

        A known sentence is a run of whole lines of one sentence; the longest from the left is
        taken and its lines are used up. Linear in the text.
        """
        low = text.encode("utf-8", "surrogatepass").lower()
        if not any(w in low for w in self.triggers):
            return []
        found = []
        for lines in units(text):
            i = 0
            while i < len(lines):
                run, j, best = lines[i], i, i
                ids: tuple[str, ...] = ()
                while run in self.prefixes:
                    j += 1
                    if run in self.known:
                        ids, best = self.known[run], j
                    if j == len(lines):
                        break
                    run += b" " + lines[j]
                found += ids
                i = max(best, i + 1)
        return found

    def licences(self, ids: list[str]) -> list[str]:
        """Licences that a sequence of identifiers states: rules in order of length, from the left."""
        found, i = [], 0
        while i < len(ids):
            for n in range(min(self.longest, len(ids) - i), 0, -1):
                licence = self.licence_of.get(tuple(ids[i:i + n]))
                if licence:
                    found.append(licence)
                    break
            i += n
        return found


@cache
def rules() -> Rules:
    return Rules()


def licences(docs: DataFrame) -> DataFrame:
    """(doc_id, sentence_ids, licences, n_licences) of every document.

    A rule matches where its identifiers follow one another among the text's known sentences
    (other sentences may stand between); the longest from the left is taken and its sentences are
    used up. ``licences`` is sorted, each once, comma-joined; n_licences counts matches. Null and
    empty texts have none. Row by row without a shuffle; equal rows give equal rows, rows without
    a doc_id stay, an empty table gives no rows, and no other column is read.
    """
    small_batches(docs.sparkSession)
    schema = "doc_id long, sentence_ids string, licences string, n_licences long"

    def work(batches):
        table = rules()
        for batch in batches:
            ids = [table.sentence_ids(t) if t else [] for t in batch.column("text").to_pylist()]
            found = [table.licences(x) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([" ".join(x) for x in ids], pa.string()),
                 pa.array([",".join(sorted(set(x))) for x in found], pa.string()),
                 pa.array([len(x) for x in found], pa.int64())],
                names=["doc_id", "sentence_ids", "licences", "n_licences"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, schema)
