"""Repeated word windows across documents, by super-k-mers dealt to the bucket of their minimiser.

Every window of ``LENGTH`` words has a minimiser, the least hash among its runs of ``GRAM``
words. Equal windows have equal minimisers, and neighbouring windows mostly share theirs, so a
run of windows with one minimiser is one super-k-mer and travels as one packed string of words
to its bucket, where the windows are sorted and compared word by word.

What can be told from a string's key alone stays narrow: equal strings are joined before
anything moves, a string that a smaller document has too goes whole, and a bucket travels only
if it holds different strings of different documents. A bucket with more than ``BUCKET``
different strings (a phrase in very many contexts) is cut once more, to single windows, whose
least document is a partial aggregate.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, small_batches, with_row_key, written

LENGTH = 50
GRAM = 10  # words of a minimiser
RUN = 64  # windows of one packed string at most
BUCKET = 2048  # different strings compared in one bucket; larger buckets go by window
PIECE, CHUNK = 1 << 22, 1 << 18  # bytes of text split at once; words worked on at once
LONG = 32  # bytes; a longer word travels as its 128-bit hash
KNOWN = 500_000  # words whose hash a worker remembers

_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
STRING = ("mini", "h1", "h2")  # a packed string: its bucket and 128 bits of its content


def text_words(text: str | None) -> list[bytes]:
    """Words as UTF-8: what stands between spaces and the controls 9 to 13."""
    return (text or "").encode().split()


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _pieces(text: str | None, length: int) -> Iterator[tuple[int, list[bytes]]]:
    """(place of the first word, words) of parts of a text; each repeats the last ``length`` - 1
    words of the one before, so that every window stands in just one part."""
    data, at, first, tail = (text or "").encode(), 0, 0, []
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and not data[end:end + 1].isspace():
            end += 1
        words = tail + data[at:end].split()
        yield first, words
        keep = min(length - 1, len(words))
        first, tail, at = first + len(words) - keep, words[len(words) - keep:], end


def minimisers(hashes: np.ndarray, length: int, gram: int) -> np.ndarray:
    """The minimiser of the window from each place on (as if the words never ended)."""
    n = len(hashes)
    padded = np.concatenate([hashes, np.zeros(length, np.uint64)])
    grams = np.zeros(n + length - gram, np.uint64)
    for k in range(gram):
        grams = grams * _P + padded[k:k + len(grams)]
    grams ^= grams >> np.uint64(29)
    grams *= _Q
    grams ^= grams >> np.uint64(32)
    # Least of ``length - gram + 1`` neighbours, by doubling.
    want, have, least = length - gram + 1, 1, grams
    while have < want:
        step = min(have, want - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least[:n]


def cut(units: list[tuple], length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Super-k-mers of word lists: (unit, first window, windows, minimiser) as arrays."""
    sizes = np.array([len(words) for *_, words in units])
    hashes = _cut_hashes(units, int(sizes.sum()))
    least = minimisers(hashes, length, gram)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    unit = np.repeat(np.arange(len(units)), sizes)
    place = np.arange(len(hashes)) - starts[unit]
    at = np.flatnonzero(place <= sizes[unit] - length)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    unit, place, least = unit[at], place[at], least[at]
    new = np.ones(len(at), bool)
    new[1:] = (unit[1:] != unit[:-1]) | (least[1:] != least[:-1])
    # Runs longer than ``RUN`` windows are cut from their beginning on.
    opens = np.flatnonzero(new)
    since = np.arange(len(at)) - np.repeat(opens, np.diff(np.append(opens, len(at))))
    opens = np.flatnonzero(since % RUN == 0)
    count = np.diff(np.append(opens, len(at)))
    return unit[opens], place[opens], count, least[opens].view(np.int64)


_hashes = _Hashes()


def _cut_hashes(units: list[tuple], n: int) -> np.ndarray:
    get = _hashes.__getitem__
    return np.fromiter((get(w) for *_, words in units for w in words), np.uint64, n)


def packed(words: list[bytes]) -> bytes:
    """Words in one string, long ones by their hash (which is longer than any word kept as is)."""
    return b" ".join([w if len(w) <= LONG else b"\0" + xxhash.xxh3_128_hexdigest(w).encode() for w in words])


def _halves(digests: list[bytes]) -> tuple[pa.Array, pa.Array]:
    both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return pa.array(both[:, 0]), pa.array(both[:, 1])


def cuts(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """One narrow row per super-k-mer: its document, place, number of windows, and string key."""
    def deal(batches):
        def out(units):
            unit, place, count, mini = cut(units, length, gram)
            digests = [xxhash.xxh3_128_digest(packed(units[u][-1][p:p + n + length - 1]))
                       for u, p, n in zip(unit.tolist(), place.tolist(), count.tolist())]
            h1, h2 = _halves(digests)
            rows = [units[u] for u in unit.tolist()]
            return pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.int64()),
                pa.array(np.array([r[3] for r in rows], np.int64) + place), pa.array(count, pa.int64()),
                pa.array(mini, pa.int64()), h1, h2], names=["doc_id", *ROW, "start", "n", *STRING])

        units, n = [], 0
        for batch in batches:
            ids = [batch.column(c).to_pylist() for c in ("doc_id", *ROW)]
            for doc_id, r1, r2, text in zip(*ids, batch.column("text").to_pylist()):
                for first, words in _pieces(text, length):
                    if len(words) >= length:
                        units.append((doc_id, r1, r2, first, words))
                        n += len(words)
                    if n >= CHUNK:
                        yield out(units)
                        units, n = [], 0
        if units:
            yield out(units)

    schema = f"doc_id long, {ROW[0]} long, {ROW[1]} long, start long, n long, mini long, h1 long, h2 long"
    return keyed.where("doc_id is not null").select("doc_id", *ROW, "text").mapInArrow(deal, schema)


def _classes(ids: np.ndarray, length: int) -> np.ndarray:
    """A number for the ``length`` words from each place on, equal just where they are equal."""
    ranks, have = ids, 1
    while have < length:
        step = min(have, length - have)
        ahead = np.concatenate([ranks[step:], np.zeros(step, np.int64)])
        ranks = np.unique(ranks << 32 | ahead, return_inverse=True)[1].astype(np.int64)
        have += step
    return ranks


def repeated_runs(strings: list[tuple[bytes, int]], length: int) -> Iterator[tuple[int, int, int]]:
    """Of (packed string, document) pairs: (string, from, to) of windows that also start in a
    string of a smaller document."""
    numbers: dict[bytes, int] = {}
    lists = [s.split(b" ") for s, _ in strings]
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in lists for w in ws), np.int64)
    sizes = np.array([len(ws) for ws in lists])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    string = np.repeat(np.arange(len(lists)), sizes)
    place = np.arange(len(ids)) - starts[string]
    at = np.flatnonzero(place <= sizes[string] - length)
    group = _classes(ids, length)[at]
    string, place = string[at], place[at]
    doc = np.array([d for _, d in strings], np.int64)[string]
    order = np.argsort(group, kind="stable")
    first = np.flatnonzero(np.diff(group[order], prepend=-1))
    least = np.empty(len(at), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(doc[order], first), np.diff(np.append(first, len(at))))
    gone = np.flatnonzero(least < doc)
    if not len(gone):
        return
    breaks = (np.diff(string[gone], prepend=-1) != 0) | (np.diff(place[gone], prepend=-2) != 1)
    opens = np.flatnonzero(breaks)
    for k, n in zip(opens, np.diff(np.append(opens, len(gone)))):
        yield int(string[gone[k]]), int(place[gone[k]]), int(place[gone[k]] + n)


def squeezed(rows: DataFrame) -> DataFrame:
    """The same rows with their text as zlib bytes: whole texts are shuffled at half the size."""
    others, types = [c for c in rows.columns if c != "text"], dict(rows.dtypes)

    def squeeze(batches):
        for batch in batches:
            texts = [None if t is None else zlib.compress(t.encode(), 1) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others], pa.array(texts, pa.binary())], names=[*others, "text"])

    return rows.mapInArrow(squeeze, ", ".join([*[f"`{c}` {types[c]}" for c in others], "text binary"]))


def unsqueezed(data: bytes | None) -> str | None:
    return None if data is None else zlib.decompress(data).decode()


def _travelling(keyed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The packed strings of the ``wanted`` super-k-mers: rows (mini, h1, h2, low, large, string)."""
    one = F.struct("start", "n", *STRING, "large")
    lists = wanted.groupBy(*ROW).agg(F.first("doc_id").alias("low"), F.collect_set(one).alias("parts"))

    def pack(batches):
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for text, low, parts in zip(*(batch.column(c).to_pylist() for c in ("text", "low", "parts"))):
                words, seen = text_words(unsqueezed(text)), set()
                for p in parts:
                    key = tuple(p[c] for c in STRING)
                    if key not in seen:
                        seen.add(key)
                        rows.append((*key, low, p["large"], packed(words[p["start"]:p["start"] + p["n"] + length - 1])))
                        size += len(rows[-1][-1])
                if size > PIECE:
                    yield out(rows)
                    rows, size = [], 0
            if rows:
                yield out(rows)

    def out(rows):
        types = [pa.int64()] * 4 + [pa.bool_(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[*STRING, "low", "large", "string"])

    texts = squeezed(keyed.select(*ROW, "text")).join(lists.hint("merge"), list(ROW)).select("text", "low", "parts")
    return texts.mapInArrow(pack, "mini long, h1 long, h2 long, low long, large boolean, string binary")


def _by_bucket(strings: DataFrame, length: int) -> DataFrame:
    """Runs of repeated windows within each bucket: rows (mini, h1, h2, a, b)."""
    def compare(batches):
        def out(held):
            runs = list(repeated_runs([h[1:] for h in held], length))
            keys = [held[s][0] for s, *_ in runs]
            columns = [*zip(*keys)] if keys else [()] * 3
            return pa.RecordBatch.from_arrays([
                *[pa.array(c, pa.int64()) for c in columns],
                pa.array([a for _, a, _ in runs], pa.int64()), pa.array([b for *_, b in runs], pa.int64())],
                names=[*STRING, "a", "b"])

        held, size, last = [], 0, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*STRING, "string", "low")]
            for *key, string, low in zip(*columns):
                if tuple(key) == last:
                    continue  # an equal row was there twice
                if size >= CHUNK and key[0] != last[0]:
                    yield out(held)
                    held, size = [], 0
                last = tuple(key)
                held.append((last, string, low))
                size += string.count(b" ") + 1
        if held:
            yield out(held)

    dealt = strings.where("not large").select(*STRING, "string", "low").repartition("mini").sortWithinPartitions(*STRING)
    return dealt.mapInArrow(compare, "mini long, h1 long, h2 long, a long, b long")


def _by_window(strings: DataFrame, length: int) -> DataFrame:
    """The same for large buckets: each window by 128 bits of its words, its least document found
    by partial aggregates."""
    def windows(batches):
        for batch in batches:
            for *key, string, low in zip(*(batch.column(c).to_pylist() for c in (*STRING, "string", "low"))):
                words = string.split(b" ")
                n = len(words) - length + 1
                w1, w2 = _halves([xxhash.xxh3_128_digest(b" ".join(words[a:a + length])) for a in range(n)])
                yield pa.RecordBatch.from_arrays(
                    [w1, w2, pa.array([low] * n, pa.int64()), *[pa.array([k] * n, pa.int64()) for k in key],
                     pa.array(np.arange(n))], names=["w1", "w2", "low", *STRING, "a"])

    schema = "w1 long, w2 long, low long, mini long, h1 long, h2 long, a long"
    each = written(strings.where("large").select(*STRING, "string", "low").mapInArrow(windows, schema), "windows")
    least = each.groupBy("w1", "w2").agg(F.min("low").alias("least"), F.max("low").alias("most")).where("least < most")
    return each.join(least.hint("merge"), ["w1", "w2"]).where("least < low").select(
        *STRING, "a", (F.col("a") + 1).alias("b"))


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept): ``kept`` is the words left, one space between.

    A word goes if a window of ``length`` words that covers it also starts in a document with a
    smaller doc_id, judged on the input. Null text has no words; texts shorter than a window lose
    none. Rows without a doc_id lose nothing and count for nothing. Rows that share a doc_id are
    one document as causes (neither removes from the other) and are judged each on its own text.
    Very long texts are split in parts, very long words travel by hash. An empty table gives no
    rows; other columns than doc_id and text are not read.
    """
    small_batches(docs.sparkSession)
    keyed = with_row_key(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    found = written(cuts(keyed, length, gram), "super-kmers")
    strings = found.groupBy(*STRING).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    # Buckets with strings of different least documents; a bucket of one string is settled by it.
    open_ = strings.groupBy("mini").agg(F.min("low").alias("_a"), F.max("low").alias("_b"), F.count("*").alias("_n")).where("_a < _b")
    strings = strings.join(open_.select("mini", (F.col("_n") > BUCKET).alias("large")).hint("merge"), "mini", "left")
    # Only strings that something is decided by: the others stand in one document, alone in their bucket.
    strings = strings.where("low < high or large is not null").drop("high")
    told = written(
        found.join(strings.hint("merge"), list(STRING)).where("doc_id > low or large is not null"), "super-kmers-told")
    wanted = told.where("doc_id = low")
    moving = written(_travelling(keyed, wanted, length), "super-kmer-strings")
    runs = _by_bucket(moving, length).unionAll(_by_window(moving, length))
    partly = wanted.select(*STRING, *ROW, "start").distinct().join(runs.hint("merge"), list(STRING)).select(
        *ROW, (F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b")).alias("b"))
    wholly = told.where("doc_id > low").select(*ROW, F.col("start").alias("a"), (F.col("start") + F.col("n")).alias("b"))
    spans = wholly.unionAll(partly).groupBy(*ROW).agg(F.collect_set(F.struct("a", "b")).alias("spans"))

    def remove(batches):
        for batch in batches:
            sizes, gone, kept = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = text_words(unsqueezed(text))
                change = np.zeros(len(words) + 1, np.int32)
                for s in spans or ():
                    change[s["a"]] += 1
                    change[s["b"] + length - 1] -= 1
                left = np.cumsum(change[:-1]) == 0
                sizes.append(len(words))
                gone.append(len(words) - int(left.sum()))
                kept.append(b" ".join([words[k] for k in np.flatnonzero(left)] if gone[-1] else words).decode())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    whole = squeezed(keyed).join(spans.hint("merge"), list(ROW), "left").select("doc_id", "text", "spans")
    return whole.mapInArrow(remove, "doc_id long, n_words long, n_removed long, kept string")
