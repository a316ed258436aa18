"""Sequences of at most a window of tokens, filled by subset sums."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .tokens import Encoder

WINDOW = 2048
# Remainders a task holds before it closes windows; the rest waits for the next ones.
HELD = 4096
CHUNK = 128
# A worker numbers its sequences from its partition's number times this.
PER_PARTITION = 1 << 40

SCHEMA = ("doc_id long, start long, length long, ids array<int>, doc_tokens long, "
          "sequence_id long, offset long")


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths (with at most ``counts`` of each) whose sum is the largest that
    is at most ``room``: length -> how many.

    Subset sums as the bits of one integer: after a length, bit s tells whether s can be
    reached. A count c enters as parts 1, 2, 4, ... and a rest, so the work grows with its
    logarithm. Going back through the stored bits gives the counts.
    """
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted(counts, reverse=True):
        if length > room or counts[length] <= 0:
            continue
        left, part = min(counts[length], room // length), 1
        while left:
            n = min(part, left)
            steps.append((length, n, reach))
            reach |= (reach << (n * length)) & mask
            left, part = left - n, part * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, n, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + n
            total -= n * length
    return chosen


class Packer:
    """Deals remainders (pieces shorter than the window) to windows.

    A window starts with the longest remainder held and is filled by ``best_fill``. If what is
    held cannot fill it (many equal lengths, say), one more remainder is cut to fill the slack
    and its end is held again, so that every window but the last is full. The last one's tokens
    are cut to windows of powers of two, which need no padding.
    """

    def __init__(self, window: int):
        self.window, self.held, self.counts, self.n, self.tokens = window, {}, {}, 0, 0

    def add(self, length: int, piece: tuple) -> None:
        self.held.setdefault(length, []).append(piece)
        self.counts[length] = self.counts.get(length, 0) + 1
        self.n, self.tokens = self.n + 1, self.tokens + length

    def _take(self, length: int) -> tuple:
        piece = self.held[length].pop()
        self.n, self.tokens = self.n - 1, self.tokens - length
        if self.counts[length] == 1:
            del self.counts[length], self.held[length]
        else:
            self.counts[length] -= 1
        return piece

    def _cut(self, length: int, at: int) -> tuple:
        doc, start, _ = piece = self._take(length)
        self.add(length - at, (doc, start + at, length - at))
        return (*piece[:2], at)

    def close(self) -> list[tuple]:
        """One full window: pieces (document, start, length) in order. Needs a window's tokens."""
        longest = max(self.counts)
        out, room = [self._take(longest)], self.window - longest
        for length, n in best_fill(self.counts, room).items():
            for _ in range(n):
                out.append(self._take(length))
                room -= length
        if room:
            out.append(self._cut(min(x for x in self.counts if x > room), room))
        return out

    def rest(self) -> list[list[tuple]]:
        """What is left, less than a window's tokens, in windows of powers of two."""
        out, pieces = [], [p for length in sorted(self.held, reverse=True) for p in self.held[length]]
        while pieces:
            room = 1 << (sum(p[2] for p in pieces).bit_length() - 1)
            line = []
            while room:
                doc, start, length = pieces.pop(0)
                if length > room:
                    pieces.insert(0, (doc, start + room, length - room))
                    length = room
                line.append((doc, start, length))
                room -= length
            out.append(line)
        return out


def pack(docs: DataFrame, tokenizer: str, *, spaces: bool = True, window: int = WINDOW,
         checksums: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and place in it; with ``checksums`` the crc32
    of each piece's ids (``ids_crc32``) in place of the ids, which then stay in the task.

    Each task packs the documents it reads: whole windows of a document first, then the
    remainders by minimum bin slack over the multiset of lengths held. Nothing is shuffled, and
    a task holds at most ``HELD`` remainders and one batch of texts. The tail of a task is cut
    into powers of two, so no sequence needs padding: all have ``window`` tokens or a power of
    two.

    Null or empty text has the end id alone. Rows with equal or null doc_id are packed each on
    its own. An empty table gives no rows; other columns than doc_id and text are not read.
    Pieces of one document keep their order by ``start``.
    """
    small_batches(docs.sparkSession)
    schema = SCHEMA.replace("ids array<int>", "ids_crc32 long") if checksums else SCHEMA
    names = [f.split()[0] for f in schema.split(", ")]

    def deal(batches):
        from pyspark import TaskContext

        encoder, packer = Encoder.of(tokenizer, spaces), Packer(window)
        sequence = TaskContext.get().partitionId() * PER_PARTITION
        rows: list[tuple] = []

        def place(line):
            nonlocal sequence
            at = 0
            for (doc_id, ids, n), start, length in line:
                rows.append((doc_id, start, length, ids[4 * start:4 * (start + length)], n, sequence, at))
                at += length
            sequence += 1

        def out():
            columns = list(zip(*rows)) or [()] * len(names)
            rows.clear()
            if checksums:
                columns[3] = [zlib.crc32(ids) for ids in columns[3]]
                return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)
            sizes = np.array(columns[2], dtype=np.int64)
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            flat = pa.array(np.frombuffer(b"".join(columns[3]), dtype="<i4"))
            return pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays(ends, flat) if k == 3 else pa.array(c, pa.int64())
                for k, c in enumerate(columns)], names=names)

        for batch in batches:
            for k in range(0, batch.num_rows, CHUNK):
                part = batch.slice(k, CHUNK)
                coded = encoder.encode(part.column("text").to_pylist())
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), coded):
                    n = len(ids) // 4
                    doc = (doc_id, ids, n)
                    for start in range(0, n - window + 1, window):
                        place([(doc, start, window)])
                    if n % window:
                        # The remainder alone is held, not the whole document.
                        start = n - n % window
                        packer.add(n - start, ((doc_id, _Tail(ids[4 * start:], start), n), start, n - start))
                while packer.n > HELD and packer.tokens >= window:
                    place(packer.close())
                yield out()
        while packer.tokens >= window:
            place(packer.close())
            if len(rows) > HELD:
                yield out()
        for line in packer.rest():
            place(line)
        yield out()

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(deal, schema)


class _Tail:
    """The last bytes of an id string, addressed as in the whole string."""

    def __init__(self, data: bytes, start: int):
        self.data, self.first = data, 4 * start

    def __getitem__(self, at: slice) -> bytes:
        return self.data[at.start - self.first:at.stop - self.first]


def sequences(pieces: DataFrame) -> DataFrame:
    """The token ids of each sequence, whole: rows (sequence_id, ids, doc_ids)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
