"""Market inputs derived from the provided tables.

Every input has two spellings of one rule: a DataFrame here and, for the check
against another engine, SQL text in ``bridge_sql``. The time axis of ``events`` is
compressed sixty times, so that an hour becomes a minute and minutes collide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perptide import schemas as S
from perptide.operators import history
from perptide.operators.asof import multiplier_segments
from perptide.sources.materialize import materialized

T0 = 1_704_067_200_000  # 2024-01-01 UTC
HOUR = 3_600_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _raw_ms() -> F.Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with raw_ms, obs_ms, venue, symbol, sym_no and the decimal value px."""
    sym_no = F.col("user_id") % 5
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        _raw_ms().alias("raw_ms"),
        (F.lit(T0) + F.floor((_raw_ms() - F.lit(T0)) / F.lit(60))).cast("bigint").alias("obs_ms"),
        F.when(F.col("event_id") % 2 == 0, "binance").otherwise("hyperliquid").alias("venue"),
        F.concat(F.lit("C"), sym_no.cast("string")).alias("symbol"),
        sym_no.alias("sym_no"),
        F.col("value").cast(S.PX).alias("px"),
    )


def interval_h() -> F.Column:
    return (
        F.when(F.col("venue") == "hyperliquid", 1).when(F.col("sym_no") == 3, 4).otherwise(8)
    ).cast("int")


def stage(spark: SparkSession, sf_dir: str, time: str = "obs_ms") -> DataFrame:
    """Staged records plus batch_seq, late_seq and event_id."""
    e = events(spark, sf_dir).filter(F.col("event_type") != "error")
    at = F.col(time)
    eid = F.col("event_id")
    live_fast = F.col("event_type").isin("click", "view")
    live_slow = F.col("event_type") == "purchase"
    back = F.col("event_type") == "signup"
    fast = live_fast | (back & (eid % 3 != 1))
    slow = live_slow | (back & (eid % 3 != 0))
    source = F.when(back, "binance_rest_klines").when(
        (F.col("venue") == "hyperliquid") & (eid % 10 == 1), "hyperliquid_ws_all_mids"
    ).otherwise("bridge_live")
    mark = F.when(eid % 17 != 0, F.col("px"))
    staged = S.conform(
        e,
        {**S.STAGE, "batch_seq": "bigint", "late_seq": "bigint", "event_id": "bigint"},
        ts_ms=at,
        ingest_ts_ms=at + 250 + eid % 500,
        source=source,
        semantic=F.when(back, "candle_close").otherwise("mark_price"),
        mark=F.when(fast, mark),
        index_px=F.when(live_fast, F.col("px") + (eid % 7).cast("decimal(10,0)")),
        premium=F.when(
            live_fast & (F.col("venue") == "hyperliquid"),
            (eid % 11 - 5).cast("decimal(10,0)") * F.lit("0.0001").cast("decimal(6,4)"),
        ),
        funding_rate=F.when(
            live_fast,
            (eid % 201 - 100).cast("decimal(10,0)") * F.lit("0.000001").cast("decimal(8,6)"),
        ),
        funding_interval_h=F.when(live_fast, interval_h()),
        next_funding_ts_ms=F.when(
            live_fast,
            (F.floor(at / (interval_h() * HOUR)) + 1).cast("bigint") * interval_h() * HOUR,
        ),
        oi_base=F.when(slow, F.col("px") * 100),
        vol24h_usd=F.when(live_slow, F.col("px") * 1000),
        chg24h_pct=F.when(live_slow, (eid % 400 - 200).cast("decimal(10,0)") / F.lit(10).cast("decimal(2,0)")),
        obs_ts_fast_ms=F.when(fast, at),
        obs_ts_slow_ms=F.when(slow, at),
        grid_s=F.when(back, 60 * (1 + eid % 5)),
        backfilled=back,
        batch_seq=F.floor(eid / 500),
        late_seq=(eid * 7919) % 20,
    )
    return staged


def instrument_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One contract snapshot per (venue, coin, compressed hour) that has events.

    Coin C0 is a 1000-lot contract in even six-hour spans; contract metadata
    changes over time and a coin can leave the list for a while.
    """
    seen = (
        events(spark, sf_dir)
        .withColumn("hour_no", F.floor((F.col("obs_ms") - T0) / HOUR).cast("bigint"))
        .groupBy("venue", "symbol", "sym_no", "hour_no")
        .agg(F.count("*").alias("n"))
    )
    listed = seen.filter((F.col("sym_no") != 4) | (F.col("hour_no") % 5 != 2))
    thousand = (F.col("sym_no") == 0) & (F.floor(F.col("hour_no") / 3) % 2 == 0)
    return listed.select(
        "venue",
        F.concat(F.col("symbol"), F.when(F.col("venue") == "binance", "USDT").otherwise("")).alias(
            "venue_symbol"
        ),
        F.timestamp_millis(F.lit(T0) + F.col("hour_no") * HOUR).alias("ts"),
        "symbol",
        F.when(thousand, 1000).otherwise(1).cast(S.MULT).alias("mult"),
        interval_h().alias("funding_interval_h"),
        F.lit("0.01").cast(S.PX).alias("tick"),
        F.when((F.col("sym_no") == 2) & (F.col("hour_no") >= 6), "suspended")
        .otherwise("trading")
        .alias("status"),
    )


_STORED: dict[tuple[str, str, str], DataFrame] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A table that jobs read as stored: written once per session, then scanned."""
    slot = (spark.sparkContext.applicationId, sf_dir, name)
    if slot not in _STORED:
        _STORED[slot] = materialized(build())
    return _STORED[slot]


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(
        spark,
        sf_dir,
        "instruments",
        lambda: history.scd2_history(
            instrument_snapshots(spark, sf_dir),
            ["venue", "venue_symbol"],
            ["symbol", "mult", "funding_interval_h", "tick", "status"],
            clock=["venue"],
        ),
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(
        spark,
        sf_dir,
        "segments",
        lambda: multiplier_segments(instruments(spark, sf_dir)),
    )
