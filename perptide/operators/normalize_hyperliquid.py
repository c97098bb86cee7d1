"""Landed payloads of venue ``hyperliquid`` to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perptide import schemas as S
from perptide.functions import scalars as C
from perptide.operators.normalize_binance import (
    FAIL_FAST,
    documents,
    elements,
    exploded,
    grid_of,
    instant,
    parsed,
    scheduled,
)
from perptide.operators.symbols import resolve

VENUE = "hyperliquid"

# Source tags, the venue's own key, its settlement interval.
SOURCES = {
    "meta": "hyperliquid_rest_meta",
    "meta_and_asset_ctxs": "hyperliquid_rest_meta_and_asset_ctxs",
    "predicted_fundings": "hyperliquid_rest_predicted_fundings",
    "funding_history": "hyperliquid_rest_funding_history",
    "candle_snapshot": "hyperliquid_rest_candle_snapshot",
    "ws_all_mids": "hyperliquid_ws_all_mids",
}
OWN_VENUE_KEY = "HlPerp"
INTERVAL_H = 1

META = "struct<universe:array<struct<name:string,szDecimals:int,maxLeverage:int>>>"


def _listed(raw: DataFrame) -> DataFrame:
    return parsed(raw, "meta", META, VENUE).select(
        "venue", "observed_ms", "ingest_ms", F.inline(C.required(F.col("doc.universe"), "universe"))
    )


def instruments(raw: DataFrame) -> DataFrame:
    """No server instant on this endpoint: the observation clock is the instant."""
    return S.conform(
        _listed(raw),
        S.INSTRUMENT,
        symbol=C.hyperliquid_symbol(C.required(F.col("name"), "name")),
        ts_ms=F.col("observed_ms"),
        ingest_ts_ms=F.col("ingest_ms"),
        source=F.lit(SOURCES["meta"]),
        venue_symbol=F.col("name"),
        mult=C.hyperliquid_mult(F.col("name")),
        funding_interval_h=F.lit(INTERVAL_H),
    )


def asset_metadata(raw: DataFrame) -> DataFrame:
    return _listed(raw).select(
        "venue",
        "observed_ms",
        C.required(F.col("name"), "name").alias("venue_symbol"),
        C.required(F.col("szDecimals"), "szDecimals").alias("sz_decimals"),
        F.col("maxLeverage").alias("max_leverage"),
    )


def meta_and_asset_ctxs_entries(raw: DataFrame) -> DataFrame:
    """Coins and contexts are paired by position; a length mismatch fails the job."""
    context = (
        "struct<funding:string,openInterest:string,markPx:string,oraclePx:string,"
        "premium:string,dayNtlVlm:string>"
    )
    halves = documents(raw, "meta_and_asset_ctxs", VENUE).withColumn(
        "halves", F.from_json("payload", "array<string>", FAIL_FAST)
    )
    paired = halves.select(
        "venue",
        "observed_ms",
        "ingest_ms",
        F.from_json(
            F.get("halves", F.lit(0)), "struct<universe:array<struct<name:string>>>", FAIL_FAST
        )["universe"].alias("coins"),
        F.from_json(F.get("halves", F.lit(1)), f"array<{context}>", FAIL_FAST).alias("ctxs"),
        F.size("halves").alias("n_halves"),
    )
    sound = (F.col("n_halves") == 2) & (F.size("coins") == F.size("ctxs"))
    zipped = F.when(sound, F.arrays_zip("coins", "ctxs")).otherwise(
        F.raise_error(F.lit("coins and contexts do not pair up")).cast(
            f"array<struct<coins:struct<name:string>,ctxs:{context}>>"
        )
    )
    return exploded(paired, zipped, "pair").select(
        "venue",
        C.required(F.col("pair.coins.name"), "name").alias("venue_symbol"),
        F.col("observed_ms").alias("ts_ms"),
        F.col("ingest_ms").alias("ingest_ts_ms"),
        C.decimal_text(F.col("pair.ctxs.markPx"), S.PX).alias("mark"),
        C.decimal_text(F.col("pair.ctxs.oraclePx"), S.PX).alias("index_px"),
        C.decimal_text(F.col("pair.ctxs.premium"), S.RATE).alias("premium"),
        C.decimal_text(F.col("pair.ctxs.funding"), S.RATE).alias("funding_rate"),
        C.decimal_text(F.col("pair.ctxs.openInterest"), S.QTY).alias("contracts"),
        C.decimal_text(F.col("pair.ctxs.dayNtlVlm"), S.QTY).alias("vol24h_usd"),
    )


def meta_and_asset_ctxs(raw: DataFrame, dim: DataFrame) -> DataFrame:
    """One row per coin that carries both lanes at one instant."""
    return S.conform(
        resolve(meta_and_asset_ctxs_entries(raw), dim),
        S.STAGE,
        source=F.lit(SOURCES["meta_and_asset_ctxs"]),
        semantic=F.lit("mark_price"),
        funding_interval_h=F.lit(INTERVAL_H),
        oi_base=C.to_base_units(F.col("contracts"), F.col("mult")),
        obs_ts_fast_ms=F.col("ts_ms"),
        obs_ts_slow_ms=F.col("ts_ms"),
        backfilled=F.lit(False),
    )


def predicted_funding_entries(raw: DataFrame) -> DataFrame:
    """One row per (coin, venue key), whoever the key belongs to."""
    def two(value, what):
        return F.when(F.size(value) == 2, value).otherwise(
            F.raise_error(F.lit(f"{what} must have two elements")).cast("array<string>")
        )

    coins = elements(raw, "predicted_fundings", "array<string>", VENUE).withColumn(
        "row", two(F.col("e"), "a coin row")
    )
    keyed = exploded(
        coins.withColumn("venue_symbol", C.required(F.get("row", F.lit(0)), "coin")),
        F.from_json(F.get("row", F.lit(1)), "array<array<string>>", FAIL_FAST),
        "pair",
    )
    prediction = F.from_json(
        F.get("pair", F.lit(1)), "struct<fundingRate:string,nextFundingTime:string>", FAIL_FAST
    )
    predicted = exploded(
        keyed.withColumn("pair", two(F.col("pair"), "a venue pair")), F.array(prediction), "p"
    )
    return predicted.select(
        "venue",
        "venue_symbol",
        F.col("observed_ms").alias("ts_ms"),
        F.col("ingest_ms").alias("ingest_ts_ms"),
        F.get("pair", F.lit(0)).alias("venue_key"),
        C.decimal_text(F.col("p.fundingRate"), S.RATE).alias("funding_rate"),
        scheduled(F.col("p.nextFundingTime")).alias("next_funding_ts_ms"),
    )


def predicted_fundings(raw: DataFrame, dim: DataFrame) -> DataFrame:
    own = predicted_funding_entries(raw).filter(F.col("venue_key") == OWN_VENUE_KEY)
    return S.conform(
        resolve(own, dim),
        S.STAGE,
        source=F.lit(SOURCES["predicted_fundings"]),
        semantic=F.lit("mark_price"),
        funding_interval_h=F.lit(INTERVAL_H),
        obs_ts_fast_ms=F.col("ts_ms"),
        backfilled=F.lit(False),
    )


def predicted_fundings_other_venues(raw: DataFrame) -> DataFrame:
    """How many predictions were left out because they are another venue's."""
    return (
        predicted_funding_entries(raw)
        .filter(F.col("venue_key") != OWN_VENUE_KEY)
        .groupBy("venue_key")
        .agg(F.count("*").alias("rows"))
    )


def funding_history(raw: DataFrame) -> DataFrame:
    """Hourly settled funding; the unified symbol is the request's."""
    schema = "struct<fundingRate:string,premium:string,time:string>"
    return S.conform(
        elements(raw, "funding_history", schema, VENUE),
        S.STAGE,
        symbol=F.col("request_symbol"),
        ts_ms=instant(F.col("e.time"), "time"),
        ingest_ts_ms=F.col("ingest_ms"),
        source=F.lit(SOURCES["funding_history"]),
        semantic=F.lit("mark_price"),
        funding_rate=C.required(C.decimal_text(F.col("e.fundingRate"), S.RATE), "fundingRate"),
        premium=C.decimal_text(F.col("e.premium"), S.RATE),
        funding_interval_h=F.lit(INTERVAL_H),
        obs_ts_fast_ms=instant(F.col("e.time"), "time"),
        grid_s=F.lit(INTERVAL_H * 3600),
        backfilled=F.lit(True),
    )


def candle_snapshot(raw: DataFrame, now_ms: int) -> DataFrame:
    """Closed bars; ``t`` and ``T`` differ only by case, so bars are read as maps."""
    bars = elements(raw, "candle_snapshot", "map<string,string>", VENUE).withColumn(
        "grid_s", grid_of(F.col("interval"))
    )
    stated = C.decimal_text(F.try_element_at("e", F.lit("T")), "bigint")
    opened = instant(F.try_element_at("e", F.lit("t")), "t")
    closed = bars.withColumn(
        "ts_ms", F.coalesce(stated, opened + F.col("grid_s").cast("bigint") * 1000 - 1)
    ).filter(F.col("ts_ms") < now_ms)
    return S.conform(
        closed,
        S.STAGE,
        symbol=F.col("request_symbol"),
        ingest_ts_ms=F.col("ingest_ms"),
        source=F.lit(SOURCES["candle_snapshot"]),
        semantic=F.lit("candle_close"),
        mark=C.required(C.decimal_text(F.try_element_at("e", F.lit("c")), S.PX), "c"),
        obs_ts_fast_ms=F.col("ts_ms"),
        backfilled=F.lit(True),
    )


def channel_frames(frames: DataFrame, channel: str) -> DataFrame:
    """One socket carries every channel: keep the wanted one, drop acknowledgements."""
    return frames.filter(F.get_json_object("payload", "$.channel") == channel).withColumn(
        "payload", F.get_json_object("payload", "$.data")
    )


def ws_all_mids_entries(frames: DataFrame) -> DataFrame:
    wanted = channel_frames(documents(frames, "ws_all_mids", VENUE), "allMids")
    mids = F.from_json("payload", "struct<mids:map<string,string>>", FAIL_FAST)["mids"]
    return wanted.select(
        "venue",
        F.col("observed_ms").alias("ts_ms"),
        F.col("ingest_ms").alias("ingest_ts_ms"),
        F.explode_outer(mids).alias("venue_symbol", "price"),
    ).filter(F.col("venue_symbol").isNotNull()).withColumn("mark", C.decimal_text(F.col("price"), S.PX))


def ws_all_mids(frames: DataFrame, dim: DataFrame) -> DataFrame:
    """Fast-lane rows whose price is a mid; the source tag is what says so."""
    return S.conform(
        resolve(ws_all_mids_entries(frames), dim),
        S.STAGE,
        source=F.lit(SOURCES["ws_all_mids"]),
        semantic=F.lit("mark_price"),
        funding_interval_h=F.lit(INTERVAL_H),
        obs_ts_fast_ms=F.col("ts_ms"),
        backfilled=F.lit(False),
    )
