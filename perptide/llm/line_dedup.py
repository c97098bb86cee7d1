"""Line deduplication by the spread of a line over sites.

Every non-blank line (trimmed) is hashed. One aggregation per line hash merges a
HyperLogLog sketch of its sites; lines whose estimate lies near the threshold get an
exact distinct count of sites before anything is removed. A line on at least
``min_sites`` sites is boilerplate: it stays at its first place (smallest document,
then position) and is removed everywhere else.

Only built-in functions run here. The aggregations combine before their shuffle, so a
line that stands in a third of all documents costs one row per task. Only positions
of removed lines travel back to the documents.

Defined results
* NULL text stays NULL and holds no line; an empty or blank line is never removed.
* A NULL site is one site of its own; a NULL document identifier sorts first.
* A document whose lines all go keeps an empty text (``drop_emptied`` drops it).
* A line repeated inside one document keeps its first place there if that is the first of all.
* Repeated rows of one identifier and text are cleaned alike and all stay.
* An empty table gives an empty result. Other columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perptide.llm.common import fresh, left_by, materialized

MIN_SITES = 8
#: log2 of the registers of a sketch; its relative standard error is 1.04 / 2 ** (LG_K / 2).
LG_K = 12
#: Standard errors around the threshold inside which sites are counted exactly.
BAND = 6


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """The identity of a line: NULL when nothing but white space is left."""
    trimmed = F.regexp_replace(line, r"^[ \t\r]+|[ \t\r]+$", "")
    return F.when(trimmed != "", F.xxhash64(trimmed))


def exploded_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """(doc, digest, site, at, line) of every non-blank line; the line as its hash."""
    return (
        docs.select(
            F.col(doc_id).alias("doc"),
            F.xxhash64(F.col(text)).alias("digest"),
            F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
            F.posexplode(F.transform(lines_of(F.col(text)), line_key)).alias("at", "line"),
        )
        .where(F.col("line").isNotNull())
    )


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(line, first_doc, first_digest, first_at) of the lines on at least ``min_sites`` sites."""
    sketched = lines.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("about"),
        F.min(F.struct("doc", "digest", "at")).alias("first"),
    )
    margin = max(1, int(BAND * 1.04 / 2 ** (LG_K / 2) * min_sites) + 1)
    candidates = materialized(sketched.where(F.col("about") >= min_sites - margin))
    near = candidates.where(F.col("about") <= min_sites + margin)
    exact = (
        lines.join(near.select("line"), "line", "left_semi")
        .select("line", "site")
        .distinct()
        .groupBy("line")
        .agg(F.count("*").alias("sites"))
        .where(F.col("sites") >= min_sites)
    )
    sure = candidates.where(F.col("about") > min_sites + margin)
    kept = sure.unionByName(near.join(exact.select("line"), "line", "left_semi"))
    return kept.select(
        "line",
        F.col("first.doc").alias("first_doc"),
        F.col("first.digest").alias("first_digest"),
        F.col("first.at").alias("first_at"),
    )


def removed_lines(docs: DataFrame, min_sites: int = MIN_SITES, **columns: str) -> DataFrame:
    """(doc, digest, removed): the positions of the lines that go, one row per affected document."""
    lines = exploded_lines(docs, **columns)
    spread = materialized(boilerplate(lines, min_sites))
    first = (
        F.col("doc").eqNullSafe(F.col("first_doc"))
        & (F.col("digest") == F.col("first_digest"))
        & (F.col("at") == F.col("first_at"))
    )
    return (
        lines.select("doc", "digest", "at", "line")
        .join(spread, "line")
        .where(~first)
        .groupBy("doc", "digest")
        .agg(F.sort_array(F.collect_set("at")).alias("removed"))
    )


def dedup_lines(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    doc_id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    drop_emptied: bool = False,
    report: tuple[str, str] | None = None,
) -> DataFrame:
    """``docs`` with the text cleaned; ``report`` names columns for the lines and the removed lines."""
    digest, removed, lines = fresh(docs, "text_digest", "removed_lines", "all_lines")
    gone = removed_lines(docs, min_sites, doc_id=doc_id, text=text, site=site)
    gone = gone.withColumnsRenamed({"doc": doc_id, "digest": digest, "removed": removed})
    joined = left_by(docs.withColumn(digest, F.xxhash64(F.col(text))), gone, [doc_id, digest])
    taken = F.coalesce(F.size(removed), F.lit(0))
    left = F.filter(F.col(lines), lambda _, i: ~F.array_contains(F.col(removed), i))
    cleaned = joined.withColumn(lines, lines_of(F.col(text))).withColumn(
        text, F.when(taken > 0, F.array_join(left, "\n")).otherwise(F.col(text))
    )
    if drop_emptied:
        cleaned = cleaned.where((taken == 0) | (F.trim(F.regexp_replace(text, r"\s+", "")) != ""))
    if report:
        cleaned = cleaned.withColumns(
            {report[0]: F.coalesce(F.size(lines), F.lit(0)).cast("long"), report[1]: taken.cast("long")}
        )
    return cleaned.drop(digest, removed, lines)
