"""Queries of the training-data operators over the given tables, with their
DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import sql
from .chat_format import conversation_digests, format_windows
from .common import stored, table, utf8_bytes
from .decontamination import contained_items
from .exact_dedup import exact_dedup
from .lexical_search import ranked_search
from .line_dedup import line_dedup
from .mixing import document_rows, mix, taken_words
from .near_dedup import near_dedup
from .prefix_trie import prefix_trie, rebuilt_conversations
from .quality import score_quality
from .secret_scan import scan_secrets
from .sharding import shard_balanced
from .substring_dedup import remove_repeated_spans
from .token_output import read_token_files, vocabulary_path, write_token_files


def op1_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 23 of near equal bytes; equal texts are linked."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = stored(docs.select("doc_id", (utf8_bytes(F.col("text")) + 8).alias("size"),
                              F.crc32(F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))).cast("long").alias("text_crc32"),
                              F.sha2("text", 256).alias("link"))
                  .withColumn("row", F.monotonically_increasing_id()), "documents")
    links = rows.filter("link is not null").select("row", "link")
    out = shard_balanced(rows.drop("link"), links, n_shards=24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))


def op2_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, spans = mix(document_rows(table(spark, sf_dir, "documents")))
    return (rows.join(taken_words(spans), "row", "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def op3_co_trained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "p_content", "p_meta", "score", "accepted")


def op4_minhash_hamming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op7_budgeted_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -7, whose texts are control strings."""
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return conversation_digests(format_windows(turns))


def op8_extendible_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_containment_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("row")


def op10_bit_plane_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_token_files(table(spark, sf_dir, "documents"), vocabulary_path())
    return read_token_files(spark, path)


def op11_best_position_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_super_kmer_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_spans(table(spark, sf_dir, "documents"), width=50, with_text=False).drop("kept_text")


def op13_collapsed_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt_conversations(table(spark, sf_dir, "conversations"))).drop("node", "parent")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_label_propagation_shards, op2_weighted_mix, op3_co_trained_quality, op4_minhash_hamming_dedup,
             op5_line_dedup, op6_secret_forest, op7_budgeted_chat_windows, op8_extendible_hash_dedup,
             op9_containment_decontamination, op10_bit_plane_token_files, op11_best_position_search,
             op12_super_kmer_substring_dedup, op13_collapsed_prefix_trie]
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = {"op4_minhash_hamming_dedup": sql.NEAR_DEDUP, "op5_line_dedup": sql.LINE_DEDUP,
             "op8_extendible_hash_dedup": sql.EXACT_DEDUP, "op9_containment_decontamination": sql.CONTAINED_ITEMS,
             "op11_best_position_search": sql.RANKED_SEARCH, "op12_super_kmer_substring_dedup": sql.REPEATED_SPANS,
             "op13_collapsed_prefix_trie": sql.PREFIX_TRIE}
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
