"""Landed payloads of venue ``binance`` to typed rows.

Each job takes the raw payload relation (one document per response) and explodes
it. Payload JSON is parsed against a closed schema in fail-fast mode, so a
structural surprise is an error and not a silent drop. Numbers are read as text
and never pass through a binary float.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perptide import schemas as S
from perptide.functions import scalars as C
from perptide.operators.symbols import resolve

FAIL_FAST = {"mode": "FAILFAST"}

# Source tags and grids.
SOURCES = {
    "exchange_info": "binance_rest_exchange_info",
    "premium_index": "binance_rest_premium_index",
    "open_interest": "binance_rest_open_interest",
    "ticker_24h": "binance_rest_ticker_24h",
    "klines": "binance_rest_klines",
    "funding_rate": "binance_rest_funding_rate",
    "ws_mark_price": "binance_ws_mark_price",
    "ws_force_order": "binance_ws_force_order",
    "global_long_short_account": "binance_rest_global_long_short_account_ratio",
    "top_long_short_position": "binance_rest_top_long_short_position_ratio",
    "taker_long_short": "binance_rest_taker_long_short_ratio",
}
GRID_SECONDS = {"1m": 60, "1h": 3600, "1d": 86400}
LS_PERIOD_S = 300
DEFAULT_INTERVAL_H = 8


def documents(raw: DataFrame, endpoint: str, venue: str = "binance") -> DataFrame:
    return raw.filter((F.col("venue") == venue) & (F.col("endpoint") == endpoint))


def parsed(raw: DataFrame, endpoint: str, schema: str, venue: str = "binance") -> DataFrame:
    return documents(raw, endpoint, venue).withColumn(
        "doc", F.from_json("payload", schema, FAIL_FAST)
    )


def exploded(df: DataFrame, array: Column | str, out: str) -> DataFrame:
    """One row per array element.

    A plain explode makes the optimizer test the array's size in a filter below it,
    which would parse the JSON a second time; the outer form is tested afterwards.
    """
    return (
        df.select("*", F.posexplode_outer(array).alias("_pos", out))
        .filter(F.col("_pos").isNotNull())
        .drop("_pos")
    )


def elements(raw: DataFrame, endpoint: str, schema: str, venue: str = "binance") -> DataFrame:
    """One row per element of an array payload (a lone object is one element)."""
    array = F.from_json("payload", f"array<{schema}>", FAIL_FAST)
    return exploded(documents(raw, endpoint, venue), array, "e")


def instant(text: Column, field: str) -> Column:
    return C.required(C.decimal_text(text, "bigint"), field)


def scheduled(text: Column) -> Column:
    """A settlement instant; the venue writes 0 for "none scheduled"."""
    return F.nullif(C.decimal_text(text, "bigint"), F.lit(0).cast("bigint"))


def grid_of(interval: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in GRID_SECONDS.items() for x in pair])
    return F.coalesce(
        F.try_element_at(table, interval),
        F.raise_error(F.concat(F.lit("unknown bar interval "), interval)).cast("int"),
    )


# -- contract list -------------------------------------------------------------
def funding_intervals(raw: DataFrame) -> DataFrame:
    """(list_ms, venue_symbol, hours) of the contracts off the default grid, list by list; the last
    entry of a list wins. An entry without a name or without hours is an error."""
    e = parsed(raw, "funding_info", "array<struct<symbol:string,fundingIntervalHours:int>>").select(
        F.col("observed_ms").alias("list_ms"), F.posexplode("doc").alias("pos", "e")
    )
    return e.groupBy("list_ms", C.required(F.col("e.symbol"), "symbol").alias("venue_symbol")).agg(
        F.max_by(C.required(F.col("e.fundingIntervalHours"), "fundingIntervalHours"), "pos").alias("hours")
    )


def interval_lists(raw: DataFrame) -> DataFrame:
    """(observed_ms, list_ms): the interval list that holds for each contract list, the nearest not after
    it, or the first one where none came before. One row per list, so the window is small."""
    at = [
        documents(raw, endpoint).select("observed_ms").distinct().withColumn("is_list", F.lit(mark))
        for endpoint, mark in (("exchange_info", False), ("funding_info", True))
    ]
    listed = F.when(F.col("is_list"), F.col("observed_ms"))
    order = Window.orderBy("observed_ms", F.desc("is_list"))
    known = at[0].unionByName(at[1]).select(
        "observed_ms",
        "is_list",
        F.coalesce(
            F.last(listed, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)),
            F.first(listed, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing)),
        ).alias("list_ms"),
    )
    return known.where(~F.col("is_list")).select("observed_ms", "list_ms")


def instruments(raw: DataFrame) -> DataFrame:
    schema = (
        "struct<serverTime:string,symbols:array<struct<symbol:string,contractType:string,"
        "status:string,baseAsset:string,filters:array<struct<filterType:string,tickSize:string>>>>>"
    )
    listed = (
        parsed(raw, "exchange_info", schema)
        .select(
            "venue",
            "observed_ms",
            "ingest_ms",
            instant(F.col("doc.serverTime"), "serverTime").alias("server_ms"),
            F.inline(C.required(F.col("doc.symbols"), "symbols")),
        )
        .filter(F.col("contractType") == "PERPETUAL")
        .withColumnRenamed("symbol", "venue_symbol")
        .withColumns(
            {c: C.required(F.col(c), c) for c in ("venue_symbol", "baseAsset")}
        )
    )
    known = listed.join(interval_lists(raw), "observed_ms", "left")
    return S.conform(
        known.join(funding_intervals(raw), ["list_ms", "venue_symbol"], "left"),
        S.INSTRUMENT,
        symbol=C.binance_symbol(F.col("baseAsset")),
        ts_ms=F.col("server_ms"),
        ingest_ts_ms=F.col("ingest_ms"),
        source=F.lit(SOURCES["exchange_info"]),
        mult=C.binance_mult(F.col("baseAsset")),
        funding_interval_h=F.coalesce(F.col("hours"), F.lit(DEFAULT_INTERVAL_H)),
        tick=C.price_tick(F.col("filters")),
        status=C.contract_status(F.col("status")),
    )


# -- fast lane -----------------------------------------------------------------
def premium_index_entries(raw: DataFrame) -> DataFrame:
    schema = (
        "struct<symbol:string,markPrice:string,indexPrice:string,lastFundingRate:string,"
        "nextFundingTime:string,time:string>"
    )
    return elements(raw, "premium_index", schema).select(
        "venue",
        C.required(F.col("e.symbol"), "symbol").alias("venue_symbol"),
        instant(F.col("e.time"), "time").alias("ts_ms"),
        F.col("ingest_ms").alias("ingest_ts_ms"),
        C.decimal_text(F.col("e.markPrice"), S.PX).alias("mark"),
        C.decimal_text(F.col("e.indexPrice"), S.PX).alias("index_px"),
        C.decimal_text(F.col("e.lastFundingRate"), S.RATE).alias("funding_rate"),
        scheduled(F.col("e.nextFundingTime")).alias("next_funding_ts_ms"),
    )


def ws_mark_price_entries(frames: DataFrame) -> DataFrame:
    """Streamed mark frames; works on a batch or a streaming frame relation."""
    schema = "struct<s:string,p:string,i:string,r:string,T:string,E:string>"
    return elements(unwrap_frames(frames), "ws_mark_price", schema).select(
        "venue",
        C.required(F.col("e.s"), "s").alias("venue_symbol"),
        instant(F.col("e.E"), "E").alias("ts_ms"),
        F.col("ingest_ms").alias("ingest_ts_ms"),
        C.decimal_text(F.col("e.p"), S.PX).alias("mark"),
        C.decimal_text(F.col("e.i"), S.PX).alias("index_px"),
        C.decimal_text(F.col("e.r"), S.RATE).alias("funding_rate"),
        scheduled(F.col("e.T")).alias("next_funding_ts_ms"),
    )


def unwrap_frames(frames: DataFrame) -> DataFrame:
    """Accept the combined envelope {stream, data} and a bare payload alike."""
    inner = F.when(
        F.get_json_object("payload", "$.stream").isNotNull(),
        F.get_json_object("payload", "$.data"),
    )
    return frames.withColumn("payload", F.coalesce(inner, F.col("payload")))


def fast_records(entries: DataFrame, dim: DataFrame, source: str) -> DataFrame:
    return S.conform(
        resolve(entries, dim),
        S.STAGE,
        source=F.lit(source),
        semantic=F.lit("mark_price"),
        obs_ts_fast_ms=F.col("ts_ms"),
        backfilled=F.lit(False),
    )


def premium_index(raw: DataFrame, dim: DataFrame) -> DataFrame:
    return fast_records(premium_index_entries(raw), dim, SOURCES["premium_index"])


def ws_mark_price(frames: DataFrame, dim: DataFrame) -> DataFrame:
    return fast_records(ws_mark_price_entries(frames), dim, SOURCES["ws_mark_price"])


def funding_rate_entries(raw: DataFrame) -> DataFrame:
    schema = "struct<symbol:string,fundingRate:string,fundingTime:string>"
    return elements(raw, "funding_rate", schema).select(
        "venue",
        C.required(F.col("e.symbol"), "symbol").alias("venue_symbol"),
        instant(F.col("e.fundingTime"), "fundingTime").alias("ts_ms"),
        F.col("ingest_ms").alias("ingest_ts_ms"),
        C.required(C.decimal_text(F.col("e.fundingRate"), S.RATE), "fundingRate").alias(
            "funding_rate"
        ),
    )


def funding_rate(raw: DataFrame, dim: DataFrame) -> DataFrame:
    """Settled funding history, one backfill row per settlement."""
    return S.conform(
        resolve(funding_rate_entries(raw), dim),
        S.STAGE,
        source=F.lit(SOURCES["funding_rate"]),
        semantic=F.lit("mark_price"),
        obs_ts_fast_ms=F.col("ts_ms"),
        grid_s=F.col("funding_interval_h") * 3600,
        backfilled=F.lit(True),
    )


# -- slow lane -----------------------------------------------------------------
def slow_records(resolved: DataFrame, source: str, **values: Column) -> DataFrame:
    return S.conform(
        resolved.drop("funding_interval_h"),
        S.STAGE,
        source=F.lit(source),
        semantic=F.lit("mark_price"),
        obs_ts_slow_ms=F.col("ts_ms"),
        backfilled=F.lit(False),
        **values,
    )


def open_interest_entries(raw: DataFrame) -> DataFrame:
    schema = "struct<symbol:string,openInterest:string,time:string>"
    document = F.array(F.from_json("payload", schema, FAIL_FAST))
    return exploded(documents(raw, "open_interest"), document, "e").select(
        "venue",
        C.required(F.col("e.symbol"), "symbol").alias("venue_symbol"),
        instant(F.col("e.time"), "time").alias("ts_ms"),
        F.col("ingest_ms").alias("ingest_ts_ms"),
        C.decimal_text(F.col("e.openInterest"), S.QTY).alias("contracts"),
    )


def open_interest(raw: DataFrame, dim: DataFrame) -> DataFrame:
    return slow_records(
        resolve(open_interest_entries(raw), dim),
        SOURCES["open_interest"],
        oi_base=C.to_base_units(F.col("contracts"), F.col("mult")),
    )


def ticker_24h_entries(raw: DataFrame) -> DataFrame:
    schema = "struct<symbol:string,priceChangePercent:string,quoteVolume:string,closeTime:string>"
    return elements(raw, "ticker_24h", schema).select(
        "venue",
        C.required(F.col("e.symbol"), "symbol").alias("venue_symbol"),
        instant(F.col("e.closeTime"), "closeTime").alias("ts_ms"),
        F.col("ingest_ms").alias("ingest_ts_ms"),
        C.decimal_text(F.col("e.quoteVolume"), S.QTY).alias("vol24h_usd"),
        C.decimal_text(F.col("e.priceChangePercent"), S.RATE).alias("chg24h_pct"),
    )


def ticker_24h(raw: DataFrame, dim: DataFrame) -> DataFrame:
    return slow_records(resolve(ticker_24h_entries(raw), dim), SOURCES["ticker_24h"])


# -- ratios --------------------------------------------------------------------
def ls_ratio(raw: DataFrame) -> DataFrame:
    """Three ratio kinds; the unified symbol is the request's, not the payload's."""
    schema = "struct<longAccount:string,buyVol:string,sellVol:string,timestamp:string>"
    points = exploded(
        raw.filter((F.col("venue") == "binance") & F.col("endpoint").isin(*S.LS_KINDS)),
        F.from_json("payload", f"array<{schema}>", FAIL_FAST),
        "e",
    ).withColumnRenamed("endpoint", "kind")
    tags = F.create_map(*[F.lit(x) for kind in S.LS_KINDS for x in (kind, SOURCES[kind])])
    taker = C.taker_share(
        C.decimal_text(F.col("e.buyVol"), S.QTY), C.decimal_text(F.col("e.sellVol"), S.QTY)
    )
    return S.conform(
        points,
        S.LS_RATIO,
        symbol=F.col("request_symbol"),
        ts_ms=instant(F.col("e.timestamp"), "timestamp"),
        ingest_ts_ms=F.col("ingest_ms"),
        source=F.try_element_at(tags, F.col("kind")),
        period=F.lit(LS_PERIOD_S),
        long_share=F.when(F.col("kind") == "taker_long_short", taker).otherwise(
            C.decimal_text(F.col("e.longAccount"), S.SHARE)
        ),
    )


# -- history -------------------------------------------------------------------
def klines(raw: DataFrame, now_ms: int) -> DataFrame:
    """Closed bars only, from positional rows: 4 is the close, 6 the close instant."""
    bars = elements(raw, "klines", "array<string>").select(
        "venue",
        F.col("request_symbol").alias("symbol"),
        F.col("ingest_ms").alias("ingest_ts_ms"),
        grid_of(F.col("interval")).alias("grid_s"),
        F.col("e").alias("bar"),
    )
    wide_enough = F.when(F.size("bar") >= 7, F.col("bar")).otherwise(
        F.raise_error(F.lit("a bar needs at least 7 columns")).cast("array<string>")
    )
    closed = (
        bars.withColumn("bar", wide_enough)
        .withColumn("ts_ms", instant(F.get("bar", F.lit(6)), "closeTime"))
        .filter(F.col("ts_ms") < now_ms)
    )
    return S.conform(
        closed,
        S.STAGE,
        source=F.lit(SOURCES["klines"]),
        semantic=F.lit("candle_close"),
        mark=C.required(C.decimal_text(F.get("bar", F.lit(4)), S.PX), "close"),
        obs_ts_fast_ms=F.col("ts_ms"),
        backfilled=F.lit(True),
    )


# -- forced orders ---------------------------------------------------------------
def force_order_entries(frames: DataFrame) -> DataFrame:
    """Forced-order frames. Key names differ only by case, so the order is a map."""
    order = elements(
        unwrap_frames(frames), "ws_force_order", "struct<E:string,o:map<string,string>>"
    ).withColumn("o", C.required(F.col("e.o"), "o"))

    def field(name: str) -> Column:
        return F.try_element_at("o", F.lit(name))

    return order.select(
        "venue",
        C.required(field("s"), "o.s").alias("venue_symbol"),
        instant(field("T"), "o.T").alias("ts_ms"),
        F.col("ingest_ms").alias("ingest_ts_ms"),
        field("S").alias("order_side"),
        C.decimal_text(field("p"), S.PX).alias("order_price"),
        C.decimal_text(field("q"), S.QTY).alias("order_qty"),
        C.decimal_text(field("ap"), S.PX).alias("average_price"),
        C.decimal_text(field("z"), S.QTY).alias("filled_qty"),
    )


def force_order(frames: DataFrame, dim: DataFrame) -> DataFrame:
    """The five attributes every record has; the trade instant, not the frame's."""
    return resolve(force_order_entries(frames), dim).select(
        "venue", "symbol", "ts_ms", "ingest_ts_ms", F.lit(SOURCES["ws_force_order"]).alias("source")
    )
