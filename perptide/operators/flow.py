"""Trades, book snapshots and spot prices of the listed coins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perptide.functions import scalars as C
from perptide.operators.carry import trailing_sums

DAY_MS = 86_400_000
TRADE_KEY = ["venue", "symbol", "at_ms", "buyer_is_maker", "price", "size", "buyer", "seller"]
DEPTH_BAND = 0.005
TICK_DAYS = 7
# The documented example turns 0.12 % into 4.4 % a year: 365 days over ten.
BASIS_DAYS = 10


def distinct_trades(trades: DataFrame) -> DataFrame:
    """Trades once each, by a key of their own content.

    The venue's hash can be all zero and its trade number repeats, so neither
    identifies a trade. Copies collapse before the shuffle.
    """
    return trades.dropDuplicates(TRADE_KEY)


def minute_flow(trades: DataFrame) -> DataFrame:
    """Taker buys minus taker sells per (venue, coin, minute)."""
    signed = F.when(F.col("buyer_is_maker"), -F.col("size")).otherwise(F.col("size"))
    return trades.groupBy(
        "venue", "symbol", C.floor_ms(F.col("at_ms"), 60_000).alias("minute_ms")
    ).agg(F.sum(signed).alias("delta"), F.count("*").alias("trades"))


def cumulative_flow(minutes: DataFrame) -> DataFrame:
    """Trailing 24-hour sum per minute that has trades; venues stay apart."""
    return trailing_sums(
        minutes.select("venue", "symbol", "minute_ms", F.col("delta").alias("cvd_24h")),
        ["venue", "symbol"],
        "minute_ms",
        DAY_MS,
        ["cvd_24h"],
    )


def flow_points(cvd: DataFrame) -> DataFrame:
    return cvd.select(
        C.scope(F.col("venue"), F.col("symbol")).alias("scope"),
        F.lit("cvd_24h").alias("metric"),
        F.timestamp_millis("minute_ms").alias("ts"),
        F.col("cvd_24h").cast("double").alias("value"),
        F.lit(60).alias("grid_s"),
        F.lit(False).alias("backfilled"),
    )


def book_depth(snapshots: DataFrame, band: float = DEPTH_BAND) -> DataFrame:
    """Bid and ask notional within the band around mid, one snapshot per minute.

    ``bids`` and ``asks`` are arrays of (px, sz), best first. A side whose deepest
    level lies inside the band does not reach it, and its sum is withheld.
    """
    minute = C.floor_ms(F.col("at_ms"), 60_000)
    latest = (
        snapshots.groupBy("venue", "symbol", minute.alias("minute_ms"))
        .agg(F.max_by(F.struct("bids", "asks"), "at_ms").alias("book"))
        .select("venue", "symbol", "minute_ms", "book.*")
    )
    mid = (F.get("bids", F.lit(0))["px"] + F.get("asks", F.lit(0))["px"]) / 2
    priced = latest.withColumn("mid", mid)

    def notional(side: str, inside) -> Column:
        kept = F.filter(side, inside)
        return F.aggregate(kept, F.lit(0.0), lambda total, x: total + x["px"] * x["sz"])

    low, high = F.col("mid") * (1 - band), F.col("mid") * (1 + band)
    reaches_bid = F.element_at("bids", -1)["px"] <= low
    reaches_ask = F.element_at("asks", -1)["px"] >= high
    return priced.select(
        "venue",
        "symbol",
        "minute_ms",
        "mid",
        F.when(reaches_bid, notional("bids", lambda x: x["px"] >= low)).alias("bid_usd"),
        F.when(reaches_ask, notional("asks", lambda x: x["px"] <= high)).alias("ask_usd"),
        reaches_bid.alias("bid_reaches_band"),
        reaches_ask.alias("ask_reaches_band"),
    )


def spot_basis(perp: DataFrame, spot: DataFrame, spot_source: str) -> DataFrame:
    """Perpetual mark over spot, in percent and per year; no pair is a labelled absence."""
    pct = (F.col("mark") - F.col("spot")) / F.col("spot") * 100
    return perp.join(spot, ["symbol", "minute_ms"], "left").select(
        "venue",
        "symbol",
        "minute_ms",
        "mark",
        "spot",
        pct.alias("basis_pct"),
        (pct * 365 / BASIS_DAYS).alias("basis_pct_per_year"),
        F.when(F.col("spot").isNull(), "no_spot_pair").otherwise(spot_source).alias("spot_source"),
    )


def retained_ticks(trades: DataFrame, as_of_ms: Column, days: int = TICK_DAYS) -> DataFrame:
    """Raw trades of the last days; the derived series are other tables."""
    return trades.filter(
        (F.col("at_ms") > as_of_ms - days * DAY_MS) & (F.col("at_ms") <= as_of_ms)
    )


def earliest_ticks(trades: DataFrame, as_of_ms: Column, days: int = TICK_DAYS) -> DataFrame:
    """Oldest raw trade per venue and whether it has outlived the retention."""
    return trades.groupBy("venue").agg(F.min("at_ms").alias("earliest_ms")).withColumn(
        "overdue", F.col("earliest_ms") <= as_of_ms - days * DAY_MS
    )
