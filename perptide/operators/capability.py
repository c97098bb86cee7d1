"""Capability gate and availability matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perptide.functions import scalars as C

# What each venue publishes, (capability, mode, completeness).
BINANCE_SHEET = (
    ("instruments", "poll_snapshot", "full"),
    ("mark_price", "poll_snapshot", "full"),
    ("funding_rate", "poll_snapshot", "full"),
    ("open_interest", "poll_snapshot", "full"),
    ("long_short_ratio", "poll_history", "full"),
    ("taker_ratio", "poll_history", "full"),
    ("klines", "poll_history", "full"),
    ("ticker_24h", "poll_snapshot", "full"),
    ("mark_price_stream", "push_stream", "full"),
    ("liquidation_stream", "push_stream", "lower_bound"),
    ("trade_stream", None, None),
    ("book_l2", None, None),
    ("spot", None, None),
)
HYPERLIQUID_SHEET = (
    ("instruments", "poll_snapshot", "full"),
    ("mark_price", "poll_snapshot", "full"),
    ("funding_rate", "poll_snapshot", "full"),
    ("open_interest", "poll_snapshot", "full"),
    ("long_short_ratio", None, None),
    ("taker_ratio", None, None),
    ("klines", "poll_history", "partial_history"),
    ("ticker_24h", "poll_snapshot", "full"),
    ("mark_price_stream", "push_stream", "full"),
    ("liquidation_stream", None, None),
    ("trade_stream", None, None),
    ("book_l2", None, None),
    ("spot", None, None),
)
# Which endpoint family a capability needs.
REST_FAMILY = {"binance": "binance:fapi", "hyperliquid": "hyperliquid:info"}
STREAM_FAMILY = {"binance": "binance:ws_market", "hyperliquid": "hyperliquid:ws"}
GEO_REFUSED = 451
# Features and the (venue, capability) pairs they need.
FEATURES = {
    "coin_list": (("binance", "instruments"), ("hyperliquid", "instruments")),
    "minute_collection": (
        ("binance", "mark_price"),
        ("binance", "funding_rate"),
        ("binance", "open_interest"),
        ("hyperliquid", "mark_price"),
        ("hyperliquid", "funding_rate"),
        ("hyperliquid", "open_interest"),
    ),
    "unit_alignment": (("binance", "instruments"), ("hyperliquid", "funding_rate")),
    "liquidation_feed": (("binance", "liquidation_stream"),),
}
SHEET_SCHEMA = (
    "venue string, capability string, supported boolean, mode string, completeness string, "
    "throttled_source boolean, family string"
)


def sheet(spark: SparkSession) -> DataFrame:
    """Every capability of both venues, declared exactly once."""
    rows = []
    for venue, declared in (("binance", BINANCE_SHEET), ("hyperliquid", HYPERLIQUID_SHEET)):
        for capability, mode, completeness in declared:
            supported = mode is not None
            family = STREAM_FAMILY if mode == "push_stream" else REST_FAMILY
            rows.append(
                (
                    venue,
                    capability,
                    supported,
                    mode or "not_applicable",
                    completeness or "not_applicable",
                    supported and capability == "liquidation_stream",
                    family[venue] if supported else None,
                )
            )
    return spark.createDataFrame(rows, SHEET_SCHEMA)


def feature_requirements(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(f, v, c) for f, needs in FEATURES.items() for v, c in needs],
        "feature string, venue string, capability string",
    )


def capability_of_ratio(kind: Column) -> Column:
    """The taker kind needs its own capability, the other two share one."""
    return F.when(kind == "taker_long_short", "taker_ratio").otherwise("long_short_ratio")


def gate(df: DataFrame, declared: DataFrame) -> DataFrame:
    """Rows whose (venue, capability) is declared supported."""
    return df.join(declared.filter("supported"), ["venue", "capability"], "left_semi")


def refused(df: DataFrame, declared: DataFrame) -> DataFrame:
    """Rows of unsupported or undeclared pairs, the gate's other side."""
    return df.join(declared.filter("supported"), ["venue", "capability"], "left_anti")


def latest_outcomes(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("family").agg(
        F.max_by(F.struct("status_code", "error_class", "latency_ms"), "at_ms").alias("o")
    ).select("family", "o.*")


def availability_matrix(declared: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Declaration against the latest outcome of the family a capability needs.

    A capability the venue does not publish is a certain answer, so it is green.
    """
    answered = F.col("status_code").between(200, 299)
    probed = F.col("probed").isNotNull()
    latest = latest_outcomes(outcomes).withColumn("probed", F.lit(True))
    status = (
        F.when(~F.col("supported"), "green")
        .when(~probed, "unknown")
        .when(F.coalesce(answered, F.lit(False)), "green")
        .otherwise("red")
    )
    wording = (
        F.when(~F.col("supported"), "not_published")
        .when(~probed, "unknown")
        .when(F.coalesce(answered, F.lit(False)), "available")
        .when(F.col("status_code") == GEO_REFUSED, "restricted")
        .otherwise("unavailable")
    )
    return declared.join(latest, "family", "left").select(
        "venue",
        "capability",
        "supported",
        "mode",
        "completeness",
        "family",
        status.alias("status"),
        wording.alias("availability"),
        F.when(F.col("supported") & ~probed, "unverified")
        .when(F.col("supported"), "measured")
        .otherwise("official")
        .alias("weakest_tag"),
    )


def feature_verdicts(requirements: DataFrame, matrix: DataFrame) -> DataFrame:
    """A feature is as good as the worst pair it needs; a missing pair is unknown."""
    needed = requirements.join(
        matrix.select("venue", "capability", "status", "supported"), ["venue", "capability"], "left"
    )
    worst = C.worst_status(F.coalesce("status", F.lit("unknown")))
    return (
        needed.groupBy("feature")
        .agg(
            worst.alias("status"),
            F.bool_or(~F.coalesce("supported", F.lit(True))).alias("needs_unpublished"),
        )
        .select(
            "feature",
            "status",
            F.when((F.col("status") == "green") & ~F.col("needs_unpublished"), "available")
            .when(F.col("status") == "unknown", "unknown")
            .otherwise("unavailable")
            .alias("verdict"),
        )
    )


def derived_provenance(parts: DataFrame) -> DataFrame:
    """Per derived figure: the weakest input's tag, all caveats, all inputs.

    ``parts`` is (figure, tag, qualifiers, input), one row per input.
    """
    caveats = (
        parts.select("figure", F.explode("qualifiers").alias("q"))
        .distinct()
        .groupBy("figure")
        .agg(F.array_sort(F.collect_list("q")).alias("qualifiers"))
    )
    head = parts.groupBy("figure").agg(
        C.tag_of_strength(F.min(C.tag_strength(F.col("tag")))).alias("effective"),
        F.count("*").alias("inputs"),
    )
    return head.join(caveats, "figure", "left").withColumn(
        "qualifiers", F.coalesce("qualifiers", F.array().cast("array<string>"))
    )
