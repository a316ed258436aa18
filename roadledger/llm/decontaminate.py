"""Benchmark decontamination as a prefix-filtered join on shingles, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, table, with_row_key, without, written

WINDOW = 13  # words of an item that must occur one after the other
SHINGLE = 4  # words of a token of the join
SHARE = 20  # contaminated from one hit word in this many

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of ASCII letters and digits and of anything beyond ASCII; A-Z lower-cased."""
    # Only ASCII letters change case. lower() does that for ASCII texts at a fraction of the cost.
    ascii_only = F.octet_length(text) == F.char_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.filter(F.split(F.coalesce(low, F.lit("")), _BETWEEN), lambda w: w != "")


def _shingles(ws: str, size: int) -> Column:
    """Hashes of all ``size`` consecutive words, in order; none for shorter lists."""
    def at(i):
        return F.xxhash64(*[F.get(ws, i + k) for k in range(size)])

    n = F.size(ws) - size
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), n), at))


def _occurrences(rows: DataFrame, keep: list[str], sizes: list[int]) -> DataFrame:
    """One row for each shingle of each size: keep, size, at (first word), token."""
    out = None
    for size in sizes:
        part = rows.select(*keep, F.lit(size).alias("size"),
                           F.posexplode(_shingles("ws", size)).alias("at", "token"))
        out = part if out is None else out.unionAll(part)
    return out


def items_of(benchmark: DataFrame) -> DataFrame:
    """Items with words: (item, item_id, ws, w) with the length w of a window of the item. ``item``
    tells rows of one item_id with different texts apart; equal rows are one item."""
    ws = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("ws"))
    known = ws.where(F.size("ws") > 0).withColumn("item", F.xxhash64(F.col("item_id").isNull(), "item_id", "ws"))
    return known.dropDuplicates(["item"]).withColumn("w", F.least(F.size("ws"), F.lit(WINDOW)))


def prefixes(item_tokens: DataFrame, frequency: DataFrame) -> DataFrame:
    """The tokens by which windows are found, with the width w of the window: of each window the
    rarest of its shingles.

    All shingles of a window must occur where the window does, so one is enough: the first in
    the order by number of occurrences in the corpus, then by hash. Neighbouring windows often
    share it. A shingle that never occurs rules its windows out.
    """
    rarity = item_tokens.join(frequency, ["size", "token"], "left").select(
        "item", "n_words", "w", "size", "at", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token").alias("rank"))
    # The shingles of the window that begins at word a begin at a .. a + w - size.
    starts = rarity.select("*", F.explode(F.sequence(
        F.greatest(F.lit(0), F.col("at") - F.col("w") + F.col("size")),
        F.least("at", F.col("n_words") - F.col("w")))).alias("window"))
    first = starts.groupBy("item", "window", "w", "size").agg(F.min("rank").alias("r"))
    return first.where("r.n > 0").select("size", "w", F.col("r.token").alias("token")).distinct()


def _keys(width: int, at) -> list[Column]:
    """128 bits of the ``width`` words of ``ws`` from ``at`` on."""
    return [F.xxhash64(F.lit(seed), *[F.get("ws", at + k) for k in range(width)]).alias(f"h{seed}") for seed in (1, 2)]


def item_windows(items: DataFrame, widths: list[int]) -> DataFrame:
    """Each different window of each item: (w, h1, h2, item_id)."""
    out = None
    for width in widths:
        keys = F.transform(F.sequence(F.lit(0), F.size("ws") - width), lambda a: F.struct(*_keys(width, a)))
        part = items.where(F.col("w") == width).select("item_id", F.lit(width).alias("w"), F.explode(F.array_distinct(keys)).alias("k"))
        out = part if out is None else out.unionAll(part)
    return out.select("w", "k.h1", "k.h2", "item_id").distinct()


def _places(width: int) -> Column:
    """Windows of the document that can hold a prefix token at one of the places found for the
    width: they begin so that the token is inside, and end within the document."""
    size = min(width, SHINGLE)
    last = F.size("ws") - width

    def around(p):
        low, high = F.greatest(F.lit(0), p - (width - size)), F.least(p, last)
        return F.when(high >= low, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    ats = F.flatten(F.filter("found", lambda f: f["w"] == width)["ats"])
    starts = F.array_distinct(F.flatten(F.transform(ats, around)))
    return F.transform(starts, lambda a: F.struct(F.lit(width).alias("w"), a.alias("a"), *_keys(width, a)))


def _covered(spans: str) -> Column:
    """Words under sorted (a, e) spans, e being the word after the last one."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(spans, start, lambda done, x: F.struct(
        (done["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["a"], done["upto"]))).cast("long").alias("n"),
        F.greatest(done["upto"], x["e"]).alias("upto")))["n"]


def decontaminate(docs: DataFrame, benchmark: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated) for every document, and its
    ``carried`` columns.

    ``items`` lists, sorted as strings, the ids of the items that have an occurring window.
    Documents and items without words (null text included) hit nothing. Rows with equal or
    null doc_id are judged each by its own text. Items with equal texts are all listed; rows of
    one item_id with different texts all count for it. Items with null id hit words like others,
    but have no id to list. An empty benchmark or table leaves nothing hit. Texts and items of one
    word over and over make as many windows as they have words, not pairs of places. Other
    columns are not read.

    The corpus is read twice: once for the occurrences of benchmark shingles, a narrow table,
    and once for the windows around those that are prefixes, which are compared with the items'
    by 128 bits of their words. Spark broadcasts the benchmark's tokens if they are under its
    limit and shuffles both sides, hot tokens split at run time, if not.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *carried)
    keyed = source.withColumn("doc", F.xxhash64("doc_id", "text"))
    items = written(items_of(benchmark), "items")
    widths = sorted(r[0] for r in items.select("w").distinct().collect())
    if not widths:
        none = F.lit(0).cast("long")
        return source.select("doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"), none.alias("n_hit"),
                             none.alias("n_items"), F.array().cast("array<string>").alias("items"),
                             F.lit(False).alias("contaminated"), *carried)
    sizes = sorted({min(w, SHINGLE) for w in widths})
    measured = items.withColumn("n_words", F.size("ws"))
    item_tokens = written(_occurrences(measured, ["item", "n_words", "w", "ws"], sizes).where(
        F.col("size") == F.least("w", F.lit(SHINGLE))).drop("ws"), "item-tokens")
    wanted = item_tokens.select("size", "token").distinct()
    split = keyed.select("doc", words(F.col("text")).alias("ws"))
    found = written(_occurrences(split, ["doc"], sizes).join(wanted, ["size", "token"]), "occurrences")
    frequency = found.groupBy("size", "token").agg(F.count(F.lit(1)).alias("n"))
    near = found.join(prefixes(item_tokens, frequency), ["size", "token"])
    by_doc = near.groupBy("doc", "w").agg(F.collect_set("at").alias("ats")).groupBy("doc").agg(
        F.collect_list(F.struct("w", "ats")).alias("found"))
    held = keyed.select("doc", "text").join(by_doc, "doc").select("doc", words(F.col("text")).alias("ws"), "found")
    windows = held.select("doc", F.explode(F.concat(*[_places(w) for w in widths])).alias("x")).select("doc", "x.*")
    known = written(item_windows(items, widths), "item-windows")
    hits = written(windows.join(known.select("w", "h1", "h2").distinct(), ["w", "h1", "h2"], "left_semi").distinct(), "hits")
    spans = hits.groupBy("doc").agg(F.sort_array(F.collect_list(
        F.struct("a", (F.col("a") + F.col("w")).alias("e")))).alias("spans")).select("doc", _covered("spans").alias("n_hit"))
    listed = hits.select("doc", "w", "h1", "h2").distinct().join(known.where("item_id is not null"), ["w", "h1", "h2"]).groupBy(
        "doc").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    sized = keyed.select("doc", "doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"), *carried)
    counted = sized.join(spans, "doc", "left").join(listed, "doc", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), *carried)
    return counted.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
                          ((F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), *carried)


def keep_clean(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not contaminated, with their columns. Each row goes or stays by its
    own text, whatever other rows have its doc_id or none."""
    keyed = with_row_key(docs)
    judged = decontaminate(keyed, table(spark, sf_dir, "benchmark"), ROW)
    return without(keyed, judged.where("contaminated"))
