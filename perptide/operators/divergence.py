"""Cross-venue metrics, their percentiles and coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perptide.functions import scalars as C
from perptide.operators.asof import with_multiplier

FIRST, SECOND = "binance", "hyperliquid"
MID_PRICE_SOURCE = "hyperliquid_ws_all_mids"
METRICS = ("funding_spread_8h", "mark_spread_bps", "oi_share_bn", "vol_share_bn")
WINDOW_DAYS = 30
MIN_N = 30


def divergence_1m(market: DataFrame, segments: DataFrame) -> DataFrame:
    """Four metrics per (coin, minute); all NULL unless both venues have the minute."""
    priced = with_multiplier(market, segments)
    per_coin = priced.select(
        "symbol",
        "ts",
        "venue",
        C.funding_8h(F.col("funding_rate"), F.col("funding_interval_h")).cast("double").alias("r8"),
        F.when(
            F.col("source") != MID_PRICE_SOURCE, F.col("mark").cast("double") / F.col("mult").cast("double")
        ).alias("price"),
        F.col("oi_usd").cast("double").alias("oi"),
        F.col("vol24h_usd").cast("double").alias("vol"),
    )

    def side(name: str, venue: str) -> Column:
        return F.max(F.when(F.col("venue") == venue, F.col(name)))

    paired = per_coin.groupBy("symbol", "ts").agg(
        *[side(c, FIRST).alias(f"{c}_b") for c in ("r8", "price", "oi", "vol")],
        *[side(c, SECOND).alias(f"{c}_h") for c in ("r8", "price", "oi", "vol")],
        (
            F.bool_or(F.col("venue") == FIRST).cast("int")
            + F.bool_or(F.col("venue") == SECOND).cast("int")
        ).alias("n_venues"),
    )
    both = F.col("n_venues") == 2

    def share(name: str) -> Column:
        total = F.col(f"{name}_b") + F.col(f"{name}_h")
        return F.when(both & (total > 0), F.col(f"{name}_b") / total)

    middle = (F.col("price_b") + F.col("price_h")) / 2
    return paired.select(
        "symbol",
        "ts",
        F.when(both, F.col("r8_b") - F.col("r8_h")).alias("funding_spread_8h"),
        F.when(
            both & (middle > 0), (F.col("price_b") - F.col("price_h")) * 10000 / middle
        ).alias("mark_spread_bps"),
        share("oi").alias("oi_share_bn"),
        share("vol").alias("vol_share_bn"),
        "n_venues",
    )


def divergence_points(divergence: DataFrame, grid_s: int = 60) -> DataFrame:
    """Long form (scope, metric, ts, value, grid_s, backfilled) of the four metrics."""
    return divergence.select(
        C.scope(F.lit("x"), F.col("symbol")).alias("scope"),
        "ts",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                    for m in METRICS
                ]
            )
        ),
        F.lit(grid_s).alias("grid_s"),
        F.lit(False).alias("backfilled"),
    )


def market_points(market: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long form of single-venue series, one scope per (venue, coin)."""
    return market.select(
        C.scope(F.col("venue"), F.col("symbol")).alias("scope"),
        "ts",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
                    for c in columns
                ]
            )
        ),
        "grid_s",
        "backfilled",
    )


def percentiles(points: DataFrame, as_of: Column, window_days: int = WINDOW_DAYS) -> DataFrame:
    """Where the latest value of each (scope, metric) stands in its own window.

    ``pctl`` is the share of the window strictly below the value and stays NULL
    under 30 observations. Only points on the latest point's grid are counted.
    The latest points are one row per series; the join back carries no hint, so
    Spark broadcasts them only while they measure small.
    """
    span = F.expr(f"INTERVAL {window_days} DAYS")
    window = points.filter(
        (F.col("ts") > as_of - span) & (F.col("ts") <= as_of) & F.col("value").isNotNull()
    )
    latest = (
        window.groupBy("scope", "metric")
        .agg(F.max_by(F.struct("value", "grid_s", "ts"), "ts").alias("now"))
        .select(
            "scope",
            "metric",
            F.col("now.value").alias("current"),
            F.col("now.grid_s").alias("grid_s"),
            F.col("now.ts").alias("latest_ts"),
        )
    )
    counted = window.select("scope", "metric", "grid_s", "value").join(
        latest, ["scope", "metric", "grid_s"]
    )
    n = F.col("n")
    return (
        counted.groupBy("scope", "metric", "grid_s", "current", "latest_ts")
        .agg(F.count("*").alias("n"), F.count_if(F.col("value") < F.col("current")).alias("below"))
        .select(
            "scope",
            "metric",
            F.col("current").alias("value"),
            F.when(n >= MIN_N, F.col("below") / n).alias("pctl"),
            "n",
            (as_of - span).alias("window_from"),
            as_of.alias("window_to"),
            "grid_s",
            F.col("latest_ts").alias("updated"),
        )
    )


def coverage(points: DataFrame, as_of: Column) -> DataFrame:
    """How much history each (scope, metric) has, and where it came from."""
    known = points.filter(F.col("value").isNotNull())
    days = F.floor((F.unix_micros(as_of) - F.unix_micros("first_ts")) / F.lit(86_400_000_000))
    return (
        known.groupBy("scope", "metric")
        .agg(
            F.min("ts").alias("first_ts"),
            F.min(F.when(~F.col("backfilled"), F.col("ts"))).alias("self_from"),
            F.min(F.when(F.col("backfilled"), F.col("ts"))).alias("backfill_from"),
            F.min("grid_s").alias("grid_s_min"),
        )
        .withColumn("days_available", days.cast("int"))
        .withColumn("enough", F.col("days_available") >= WINDOW_DAYS)
    )


def market_funding_median(market: DataFrame, venues: Sequence[str] = (FIRST, SECOND)) -> DataFrame:
    """One exact median over the coins per minute, each coin at its mean over venues."""
    per_coin = (
        market.filter(F.col("venue").isin(*venues))
        .withColumn("r8", C.funding_8h(F.col("funding_rate"), F.col("funding_interval_h")))
        .filter(F.col("r8").isNotNull())
        .groupBy("symbol", "ts")
        .agg(F.avg(F.col("r8").cast("double")).alias("rate"))
    )
    return per_coin.groupBy("ts").agg(
        F.percentile("rate", F.lit(0.5)).alias("value"), F.count("*").alias("n_coins")
    ).select(
        F.lit("x:*").alias("scope"),
        F.lit("market_funding_median").alias("metric"),
        "ts",
        "value",
        "n_coins",
    )


def change_over(divergence: DataFrame, column: str, minutes: int) -> DataFrame:
    """Level minus the level ``minutes`` earlier; a missing minute gives NULL."""
    earlier = divergence.select(
        "symbol",
        (F.col("ts") + F.expr(f"INTERVAL {minutes} MINUTES")).alias("ts"),
        F.col(column).alias("_earlier"),
    )
    return divergence.join(earlier, ["symbol", "ts"], "left").select(
        "symbol", "ts", (F.col(column) - F.col("_earlier")).alias("change")
    )


def touched_minutes(backfill_stage: DataFrame) -> DataFrame:
    """(symbol, month) spans that a backfill batch makes stale."""
    ts = C.epoch_ms(F.col("ts_ms"))
    return (
        backfill_stage.filter("backfilled")
        .groupBy("symbol", C.month_of(ts).alias("month"))
        .agg(F.min(C.minute(ts)).alias("from_ts"), F.max(C.minute(ts)).alias("to_ts"))
    )


def touched_scopes(backfill_stage: DataFrame) -> DataFrame:
    """(scope, from_ts, to_ts) of each series that a backfill batch makes stale, month by month."""
    ts = C.epoch_ms(F.col("ts_ms"))
    return (
        backfill_stage.filter("backfilled")
        .groupBy(C.scope(F.col("venue"), F.col("symbol")).alias("scope"), C.month_of(ts).alias("month"))
        .agg(F.min(C.minute(ts)).alias("from_ts"), F.max(C.minute(ts)).alias("to_ts"))
        .drop("month")
    )


def recompute(
    stored: DataFrame, market: DataFrame, segments: DataFrame, touched: DataFrame
) -> DataFrame:
    """Divergence after a backfill: touched spans computed again, the rest kept."""
    def inside(df: DataFrame, how: str) -> DataFrame:
        spans = touched.select(
            F.col("symbol").alias("_s"), F.col("month").alias("_m"), "from_ts", "to_ts"
        )
        hit = (
            (F.col("symbol") == F.col("_s"))
            & (C.month_of(F.col("ts")) == F.col("_m"))
            & (F.col("ts") >= F.col("from_ts"))
            & (F.col("ts") <= F.col("to_ts"))
        )
        return df.join(spans, hit, how)

    fresh = divergence_1m(inside(market, "left_semi"), segments)
    kept = inside(stored, "left_anti")
    return kept.select(*fresh.columns).unionByName(fresh)
