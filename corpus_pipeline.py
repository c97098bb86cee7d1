"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet under
the shared checkpoint folder and hands the stored rows to the next. All stages but the last return
the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perptide.llm import decontaminate, jaccard, line_dedup, packing, quality
from perptide.llm.common import fold, fresh, materialized


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. It learns from the labels outside fold 0."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = quality.train(quality.examples(docs, labels, fold(F.col("doc_id")) != 0))
    return quality.filtered(docs, weights)


def remove_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites go, but for their first place; a document left without text goes too."""
    (before,) = fresh(docs, "text_before")
    cleaned = line_dedup.dedup_lines(docs.withColumn(before, F.xxhash64("text")), drop_emptied=True)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.xxhash64("text") != F.col(before)
        cleaned = cleaned.withColumn(
            "n_chars", F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col("n_chars"))
        )
    return cleaned.drop(before)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose shingles are 80 % alike, the one of the smallest identifier stays."""
    return jaccard.keep_one(docs)


def remove_benchmark_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their places in sequences."""
    return packing.packed(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality classifier", reject_low_quality),
    ("line dedup", remove_boilerplate),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", remove_benchmark_documents),
    ("best-fit packing", pack_sequences),
]

#: The classifier and the packing are no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialized(stage(spark, docs, sf_dir))
    return docs
