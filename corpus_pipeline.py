"""A training corpus from documents: quality, near duplicates, benchmark
passages, source weights, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet in the shared folder and reads it as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwspark.llm.common import row_identity, stored, table, word_count
from dwspark.llm.decontamination import decontaminate
from dwspark.llm.mixing import mix, mixed_texts
from dwspark.llm.near_dedup import one_of_each
from dwspark.llm.quality import score_quality
from dwspark.llm.token_output import read_token_files, vocabulary_path, write_token_files

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    return score_quality(docs.select(COLUMNS), table(spark, sf_dir, "labels")).filter("accepted").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each(docs.select(COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: a row per document and pass, its text cut to the words taken, n_chars following it."""
    numbered = stored(docs.select(COLUMNS).withColumn("size", word_count(F.col("text")))
                      .withColumn("order", F.xxhash64(row_identity(F.col("doc_id"), F.col("text"))))
                      .withColumn("row", F.monotonically_increasing_id()), "mix-documents")
    _, spans = mix(numbered.select("row", "order", "size", "source"))
    taken = mixed_texts(numbered.drop("order"), spans)
    return taken.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the corpus, and what they hold of each document."""
    return read_token_files(spark, write_token_files(docs, vocabulary_path()))


STAGES = [("quality classifier", quality), ("MinHash near-dedup", near_duplicates),
          ("benchmark decontamination", decontamination), ("mixing to target weights", mixing),
          ("token-id output", token_files)]

#: A trained classifier and pseudorandom draws have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
