"""Shared pieces of the query catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perptide.operators import merge
from perptide.plans import bridge


def r6(column: Column | str, name: str | None = None) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value.cast("double"), 6).alias(name or column)


def big(column: Column | str, name: str | None = None) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return value.cast("bigint").alias(name or column)


def ms(column: str, name: str) -> Column:
    return F.unix_millis(column).alias(name)


def market_out(df: DataFrame, *extra: str) -> DataFrame:
    """The minute table with instants in milliseconds and numbers as rounded doubles."""
    return df.select(
        "venue",
        "symbol",
        ms("ts", "ts_ms"),
        ms("obs_ts_fast", "obs_fast_ms"),
        ms("obs_ts_slow", "obs_slow_ms"),
        ms("next_funding_ts", "next_funding_ms"),
        ms("ingest_ts", "ingest_ms"),
        big("funding_interval_h"),
        big("grid_s"),
        "backfilled",
        "semantic",
        "source",
        *[
            r6(c)
            for c in (
                "mark",
                "index_px",
                "premium",
                "funding_rate",
                "oi_base",
                "oi_usd",
                "vol24h_usd",
                "chg24h_pct",
            )
        ],
        *extra,
    )


def replayed(spark: SparkSession, sf_dir: str, time: str = "obs_ms") -> DataFrame:
    """The minute table after the whole bridge log, in batch order."""
    return merge.replay(bridge.stage(spark, sf_dir, time), bridge.segments(spark, sf_dir))


def market(spark: SparkSession, sf_dir: str, time: str = "obs_ms") -> DataFrame:
    """The same table as the permanent one that downstream jobs scan."""
    return bridge.stored(
        spark, sf_dir, f"market-{time}", lambda: replayed(spark, sf_dir, time)
    )


def stage_out(df: DataFrame) -> DataFrame:
    """Staged records in comparable form."""
    return df.select(
        "venue",
        "symbol",
        "ts_ms",
        big("ingest_ts_ms", "ingest_ms"),
        "source",
        "semantic",
        *[
            r6(c)
            for c in (
                "mark",
                "index_px",
                "premium",
                "funding_rate",
                "oi_base",
                "vol24h_usd",
                "chg24h_pct",
            )
        ],
        big("funding_interval_h"),
        big("next_funding_ts_ms", "next_funding_ms"),
        big("obs_ts_fast_ms", "obs_fast_ms"),
        big("obs_ts_slow_ms", "obs_slow_ms"),
        big("grid_s"),
        "backfilled",
    )
