"""The registered queries of this folder: thin forms of the operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perptide.llm import (
    bpe,
    cover_tree,
    decontaminate,
    filter_audit,
    jaccard,
    licenses,
    line_dedup,
    lm,
    packing,
    quality,
    sharding,
    url_filter,
    whitening,
)
from perptide.llm import queries_sql as sql
from perptide.llm.common import fold
from perptide.plans.registry import Registry

query = Registry()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Callable]:
    return dict(query.queries)


def oracle_sql() -> dict[str, str]:
    return dict(query.sql)


@query("op1_line_dedup", sql.LINE_DEDUP)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, the removed ones, and size and MD5 of what stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    cleaned = line_dedup.dedup_lines(docs, report=("n_lines", "n_removed"))
    return cleaned.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.octet_length("text").cast("long").alias("kept_bytes"),
        F.md5(F.col("text").cast("binary")).alias("kept_md5"),
    )


@query("op5_url_filter", sql.URL_FILTER)
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL under the standing rules; ``pattern`` names the pattern that decided."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge(pages, url_filter.standing_rules(spark))
    return judged.select(
        "page_id",
        "host",
        "path",
        F.when(F.col("tier") == 0, F.col("rule")).alias("rule"),
        "verdict",
        F.when(F.col("tier") == 1, F.col("rule")).alias("pattern"),
    )


@query("op7_license_scan", sql.LICENSES)
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license: of the whole text, and of each of its lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan(docs, licenses.known_digests(spark))
    return found.select(
        "doc_id",
        "license",
        F.array_join("line_licenses", ",").alias("line_licenses"),
        F.col("license_lines").cast("long").alias("license_lines"),
    )


@query("op2_benchmark_decontamination", sql.DECONTAMINATION)
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its words, those inside a benchmark window, and the items that occur in it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.found_in(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, span: n + span["length"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def quality_weights(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """The model that labels of four folds of five teach, over the texts of ``docs``."""
    labels = table(spark, sf_dir, "labels")
    return quality.train(quality.examples(docs, labels, fold(F.col("doc_id")) != 0))


@query("op3_quality_classifier")
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.scored(docs, quality_weights(spark, docs, sf_dir), keep=["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


@query("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.packed(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op4_exact_top_k", sql.TOP_K)
def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every row whose identifier is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return cover_tree.search(vectors, F.pmod("vec_id", F.lit(100)) == 0)


@query("op6_sharding")
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


@query("op9_ngram_jaccard_join", sql.JACCARD)
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of documents that are at least 80 % alike."""
    found = jaccard.component_ids(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query("op10_lm_scoring")
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability under the model and under plain word counts."""
    return lm.scores(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's coordinates along the leading components, scaled to variance one."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors)
    error = whitening.identity_error(vectors, model)
    explained = F.lit(model.explained).cast("array<double>")
    rows = whitening.whitened(vectors, model, keep=["vec_id"])
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


@query("op12_filter_interaction_audit", sql.FILTER_AUDIT)
def op12_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source, order of the five filters and step: what the step's filter keeps, removes and loses."""
    return filter_audit.audit(filter_audit.counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


@query("op13_bpe_encoding_and_decoding")
def op13_bpe_encoding_and_decoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the number and digest of its ids, and the digest of the text they decode to."""
    ids = bpe.encoded(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return bpe.decoded(ids).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
