"""From raw documents to packed training sequences: five stages, each on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.llm import decontam, line_dedup, packing, simhash, toxicity
from rowmill.llm.common import by_name, by_place, stored, table


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"), limit=0.7)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines that five or more documents hold stay in the last of them; n_chars follows the text."""
    plain, names = by_place(docs, ("doc_id", "text", "n_chars"))
    cleaned = line_dedup.dedup_lines(plain)
    chars = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(plain.schema["n_chars"].dataType)
    return by_name(cleaned.withColumn("n_chars", chars).select(*plain.columns), names)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHash fingerprints (three words, two bits) link up, the first stays."""
    return simhash.keep_one(docs, shingle=3, max_distance=2)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a question and answer of the benchmark, or most of an item as a whole, go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), whole=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), window=2048, end_id=1)


STAGES = [("toxicity", toxic_documents), ("line dedup", repeated_lines), ("near copies", near_copies),
          ("decontamination", benchmark_leaks), ("packing", packed)]

# Learned scores, fingerprints and token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
