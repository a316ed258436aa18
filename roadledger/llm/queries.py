"""The operators as queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bwt_dedup, chat_trees, decontaminate, divergence, licences, ngram_join, packing, pseudonyms, quality, repair, resampling, sql, super_kmers, token_files
from .common import table

# The key of the sample tables; users pass their own.
SAMPLE_KEY = "sample-tables"
LITERAL = f"{chat_trees.END}{chat_trees.START}assistant ok"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op5_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), checksums=True)


@query
def op8_token_files(spark, sf_dir):
    return token_files.token_rows(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op3_divergence(spark, sf_dir):
    judged = divergence.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "char_distance", "word_distance")


@query
def op9_quality(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_chat_trees(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    literal = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(LITERAL).alias("text"))
    return chat_trees.digests(chat_trees.format_paths(chat_trees.thread(rows.unionByName(literal))))


@query
def op2_pseudonyms(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymize(docs, SAMPLE_KEY, counted=True)


@query
def op4_decontamination(spark, sf_dir):
    judged = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", "n_words", "n_hit", "n_items",
                         F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


@query
def op6_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), ngram_join.CONTRACT)


@query
def op10_licences(spark, sf_dir):
    return licences.licences(table(spark, sf_dir, "documents"))


@query
def op7_bwt_dedup(spark, sf_dir):
    left = bwt_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_super_kmers(spark, sf_dir):
    left = super_kmers.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op12_resampling(spark, sf_dir):
    ranked = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op13_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return repair.repair_report(rows, repair.damage(rows))


ORACLE |= {"op1_chat_trees": sql.OP1, "op4_decontamination": sql.OP4, "op6_ngram_join": sql.OP6,
           "op7_bwt_dedup": sql.OP7, "op10_licences": sql.OP10,
           "op11_super_kmers": sql.OP11, "op12_resampling": sql.OP12, "op13_repair": sql.OP13}
