"""Quality by distribution: histograms of a document against references of its language."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written
from .features import CLASSES, base_counts, class_counts

# Frequent function words of each language (fixed values).
COMMON_WORDS = {
    "en": "the of and to in a is that for it was on are as with be by this from at",
    "fr": "le de la et les des en un une du que qui dans pour est au sur par pas avec",
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als für",
    "es": "de la que el en y los del se las por un para con una su al es no lo",
}
_WORDS = {lang: {w.encode(): k for k, w in enumerate(words.split())} for lang, words in COMMON_WORDS.items()}
_PLACES = max(map(len, _WORDS.values()))

MIN_WORDS = 50  # fewer fail the base rules
MIN_CHARS = 200  # a character histogram of fewer points decides nothing
MIN_COMMON_WORDS = 200  # nor does a word histogram of fewer words
CHAR_LIMIT = 0.30  # Jensen-Shannon distances (base 2, 0 to 1) above which a text is rejected
WORD_LIMIT = 0.33

SCHEMA = ("doc_id long, lang string, n_words long, word_chars long, n_symbols long, "
          "n_dup_lines long, n_repeat_words long, chars array<long>, common array<long>")


def document_counts(docs: DataFrame) -> DataFrame:
    """Per document the base counts and both histograms.

    Null text has no words and empty histograms; a null or unknown language has no common
    words. Rows with equal doc_id are counted each on its own. Columns other than doc_id, text
    and lang are not read.
    """
    small_batches(docs.sparkSession)
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def count(batches):
        for batch in batches:
            rows = []
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                data = (text or "").encode("utf-8", "surrogatepass")
                words, numbers, base = base_counts(data)
                places = _WORDS.get(lang, {})
                common = [0] * (_PLACES + 1)
                if places and words:
                    # One lookup for each different word, then their numbers.
                    first = np.unique(numbers, return_index=True)[1]
                    for k, n in zip(first, np.bincount(numbers)):
                        common[places.get(words[k].lower().strip(b".,"), _PLACES)] += int(n)
                rows.append((len(words), *base, class_counts(data).tolist(), common))
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("lang"),
                *[pa.array(c, pa.int64()) for c in columns[:5]],
                *[pa.array(c, pa.list_(pa.int64())) for c in columns[5:]]], names=names)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                         F.col("lang").cast("string").alias("lang"))
    return source.mapInArrow(count, SCHEMA)


def _shares(counts: str, n: int) -> list:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return [F.when(total > 0, F.get(counts, F.lit(k)) / total).otherwise(0.0) for k in range(n)]


def references(counts: DataFrame) -> DataFrame:
    """Per language the mean histogram of all its documents that pass the base rules.

    Each document weighs the same however long it is. Aggregated before the shuffle: a task
    gives one row per language. Means are rounded, so the order of summing leaves no trace.
    """
    chars = [F.avg(c) for c in _shares("chars", len(CLASSES))]
    common = [F.avg(c) for c in _shares("common", _PLACES + 1)]
    return counts.where(~_base_failed()).groupBy("lang").agg(
        F.transform(F.array(*chars), lambda x: F.round(x, 9)).alias("ref_chars"),
        F.transform(F.array(*common), lambda x: F.round(x, 9)).alias("ref_common"))


def _base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def distance(counts: str, reference: str):
    """Jensen-Shannon distance of a histogram of counts to reference shares; null without either."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    norm = F.aggregate(reference, F.lit(0.0), lambda a, x: a + x)

    def part(p, m):
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)

    def term(x, r):
        p, q = x / total, r / norm
        return part(p, (p + q) / 2) / 2 + part(q, (p + q) / 2) / 2

    divergence = F.aggregate(F.zip_with(counts, reference, term), F.lit(0.0), lambda a, x: a + x)
    return F.when((total > 0) & (norm > 0), F.sqrt(F.greatest(divergence, F.lit(0.0))))


def judge(docs: DataFrame, known_references: DataFrame | None = None, *,
          char_limit: float = CHAR_LIMIT, word_limit: float = WORD_LIMIT) -> DataFrame:
    """Base counts, both distances, base_failed and kept for every document.

    A text is kept unless it fails the base rules or lies further from its language's
    reference than a limit. ``known_references``: what :func:`references` gave for a trusted corpus,
    as a table kept apart; without them all of ``docs`` gives them. Guards: below ``MIN_CHARS`` code points (``MIN_COMMON_WORDS``
    words) the character (word) distance does not judge, and neither does a language
    without reference or word list. Null text fails by its length. An empty table gives no rows.
    """
    if known_references is None:
        counts = written(document_counts(docs), "histograms")
        known_references = references(counts)
    else:  # one pass, nothing is read twice
        counts = document_counts(docs)
    # Documents of no language have no reference; the left join leaves their distances null.
    judged = counts.join(known_references.select("lang", "ref_chars", "ref_common"), "lang", "left")
    points = F.aggregate("chars", F.lit(0).cast("long"), lambda a, x: a + x)
    known = F.aggregate("ref_common", F.lit(0.0), lambda a, x: a + x) - F.get("ref_common", F.lit(_PLACES))
    by_chars = F.when(points >= MIN_CHARS, distance("chars", "ref_chars"))
    by_words = F.when((F.col("n_words") >= MIN_COMMON_WORDS) & (known > 0), distance("common", "ref_common"))
    far = (F.coalesce(F.col("char_distance") > char_limit, F.lit(False))
           | F.coalesce(F.col("word_distance") > word_limit, F.lit(False)))
    return (judged.withColumn("char_distance", by_chars).withColumn("word_distance", by_words)
            .withColumn("base_failed", _base_failed())
            .select("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "char_distance", "word_distance", "base_failed",
                    (~F.col("base_failed") & ~far).alias("kept")))
