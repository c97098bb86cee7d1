"""Source health, run summaries, silence and freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perptide.operators.carry import chunk_of, running
from perptide.operators.quantiles import exact_quantiles

SOURCE_KEY = ["venue", "capability", "transport"]


def source_health(outcomes: DataFrame) -> DataFrame:
    """Last success, its latency, last error class, failures since the last success."""
    failed = ~F.col("ok")
    summary = outcomes.groupBy(*SOURCE_KEY).agg(
        F.max(F.when(F.col("ok"), F.col("at_ms"))).alias("last_ok_ms"),
        F.max_by("latency_ms", F.when(F.col("ok"), F.col("at_ms"))).alias("latency_ms"),
        F.max_by("error_class", F.when(failed, F.col("at_ms"))).alias("last_error_class"),
        F.max_by("ok", "at_ms").alias("ok"),
    )
    per_minute = outcomes.filter(failed).select(*SOURCE_KEY, "at_ms")
    since = (
        per_minute.join(summary.select(*SOURCE_KEY, "last_ok_ms"), SOURCE_KEY)
        .filter(F.col("last_ok_ms").isNull() | (F.col("at_ms") > F.col("last_ok_ms")))
        .groupBy(*SOURCE_KEY)
        .agg(F.count("*").alias("consecutive_fail"))
    )
    return summary.join(since, SOURCE_KEY, "left").withColumn(
        "consecutive_fail", F.coalesce("consecutive_fail", F.lit(0))
    )


def run_summary(runs: DataFrame) -> DataFrame:
    """Per lane: rounds, rows, errors, time, and rounds that never finished."""
    return runs.groupBy("lane").agg(
        F.count("*").alias("rounds"),
        F.sum("rows_written").alias("rows_written"),
        F.sum("errors").alias("errors"),
        F.sum("duration_ms").alias("duration_ms"),
        F.max("duration_ms").alias("longest_ms"),
        F.count_if(F.col("status") == "running").alias("unfinished"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )


def silences(writes: DataFrame, limit_ms: int = 600_000) -> DataFrame:
    """Spans between successive writes of a source that are longer than the limit.

    One alert belongs to each span and one recovery notice to its end. The write
    before a write is the largest earlier instant.
    """
    instants = writes.select("source", "at_ms").distinct()
    prior = running(
        instants,
        ["source"],
        ["at_ms"],
        F.col("at_ms"),
        "last_ms",
        chunk=chunk_of(F.col("at_ms"), 3_600_000),
        inclusive=False,
    )
    return prior.filter(F.col("at_ms") - F.col("last_ms") > limit_ms).select(
        "source",
        F.col("last_ms").alias("last_write_ms"),
        (F.col("last_ms") + limit_ms).alias("alert_ms"),
        F.col("at_ms").alias("recovered_ms"),
    )


def freshness(latest: DataFrame, budgets: DataFrame, as_of_ms: Column) -> DataFrame:
    """Promised age against actual age per (venue, face)."""
    return latest.join(budgets, "face", "left").select(
        "venue",
        "face",
        "budget_s",
        ((as_of_ms - F.col("latest_ms")) / 1000).alias("age_s"),
        F.coalesce((as_of_ms - F.col("latest_ms")) <= F.col("budget_s") * 1000, F.lit(False)).alias(
            "within_budget"
        ),
    )


def latest_per_face(market: DataFrame, faces: dict[str, str]) -> DataFrame:
    """Newest instant per (venue, face); ``faces`` maps a face to its time column."""
    wide = market.groupBy("venue").agg(
        *[F.max(F.unix_millis(column)).alias(face) for face, column in faces.items()]
    )
    return wide.select(
        "venue",
        F.inline(
            F.array(
                *[F.struct(F.lit(f).alias("face"), F.col(f).alias("latest_ms")) for f in faces]
            )
        ),
    )


def delay_gate(delays: DataFrame) -> DataFrame:
    """P95 collection delay per source: a shown window must end that long ago."""
    return exact_quantiles(delays, ["source"], "delay_ms", {"p95_delay_ms": 0.95})


def settled_window(df: DataFrame, gate: DataFrame, as_of_ms: Column) -> DataFrame:
    """Rows old enough to be shown: at least the source's P95 delay before ``as_of``."""
    return df.join(gate.select("source", "p95_delay_ms"), "source").filter(
        F.col("at_ms") <= as_of_ms - F.col("p95_delay_ms")
    ).drop("p95_delay_ms")
