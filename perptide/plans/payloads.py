"""Venue payload documents built from the bridge, so the parsers run at scale."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perptide.operators import normalize_binance as NB
from perptide.operators import normalize_hyperliquid as NH
from perptide.operators.symbols import symbol_dimension
from perptide.operators.symbols import symbol_history as history_of
from perptide.plans import bridge

PER_DOCUMENT = 50  # entries of one response document
INTERVALS = ("1m", "1h", "1d")


def text(column: Column) -> Column:
    return column.cast("string")


def binance_name() -> Column:
    """The venue's contract name; every thirteenth event is of an unlisted contract."""
    return (
        F.when(F.col("event_id") % 13 == 0, "NEWUSDT")
        .when(F.col("sym_no") == 0, "1000C0USDT")
        .otherwise(F.concat("symbol", F.lit("USDT")))
    )


def hyperliquid_name() -> Column:
    return (
        F.when(F.col("event_id") % 13 == 0, "NEW")
        .when(F.col("sym_no") == 0, "kC0")
        .otherwise(F.col("symbol"))
    )


def rate() -> Column:
    return (F.col("event_id") % 201 - 100).cast("decimal(10,0)") * F.lit("0.000001").cast(
        "decimal(8,6)"
    )


def documents(
    df: DataFrame, venue: str, endpoint: str, entry: Column, per: int = PER_DOCUMENT, *by: str
) -> DataFrame:
    """Pack rows into array documents of at most ``per`` entries."""
    grouped = df.groupBy(F.floor(F.col("event_id") / F.lit(per)).alias("block"), *by).agg(
        F.collect_list(entry).alias("entries"), F.max("obs_ms").alias("observed_ms")
    )
    return raw(grouped, venue, endpoint, F.to_json("entries"), *by)


def raw(df: DataFrame, venue: str, endpoint: str, payload: Column, *by: str) -> DataFrame:
    def attribute(name: str) -> Column:
        return (F.col(name) if name in by else F.lit(None).cast("string")).alias(name)

    return df.select(
        F.lit(venue).alias("venue"),
        F.lit(endpoint).alias("endpoint"),
        attribute("request_symbol"),
        attribute("interval"),
        "observed_ms",
        (F.col("observed_ms") + 250).alias("ingest_ms"),
        payload.alias("payload"),
    )


def side(spark: SparkSession, sf_dir: str, venue: str, *types: str) -> DataFrame:
    e = bridge.events(spark, sf_dir).filter(F.col("venue") == venue)
    return e.filter(F.col("event_type").isin(*types)) if types else e


def _hours(spark: SparkSession, sf_dir: str, venue: str) -> DataFrame:
    hour = F.floor((F.col("obs_ms") - bridge.T0) / bridge.HOUR).cast("bigint")
    return side(spark, sf_dir, venue).select(
        "sym_no", "symbol", (F.lit(bridge.T0) + hour * bridge.HOUR).alias("observed_ms")
    ).distinct()


def exchange_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.when(F.col("sym_no") == 0, "1000C0").otherwise(F.col("symbol"))
    status = F.element_at(
        F.array(*[F.lit(s) for s in ("TRADING", "SETTLING", "CLOSE", "TRADING", "ODD")]),
        (F.col("sym_no") + 1).cast("int"),
    )
    filters = F.array(
        F.struct(F.lit("LOT_SIZE").alias("filterType"), F.lit("1").alias("tickSize")),
        F.struct(F.lit("PRICE_FILTER").alias("filterType"), F.lit("0.10").alias("tickSize")),
    )
    contracts = F.array(
        *[
            F.struct(
                F.concat(base, F.lit(suffix)).alias("symbol"),
                F.lit(kind).alias("contractType"),
                status.alias("status"),
                base.alias("baseAsset"),
                (filters if kind == "PERPETUAL" else F.lit(None)).alias("filters"),
            )
            for suffix, kind in (("USDT", "PERPETUAL"), ("USDT_Q", "CURRENT_QUARTER"))
        ]
    )
    per_hour = _hours(spark, sf_dir, "binance").groupBy("observed_ms").agg(
        F.flatten(F.collect_list(contracts)).alias("symbols")
    )
    return raw(
        per_hour,
        "binance",
        "exchange_info",
        F.to_json(F.struct(F.col("observed_ms").alias("serverTime"), "symbols")),
    )


def funding_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.struct(
        F.concat("symbol", F.lit("USDT")).alias("symbol"), F.lit(4).alias("fundingIntervalHours")
    )
    per_hour = (
        _hours(spark, sf_dir, "binance")
        .filter("sym_no = 3")
        .groupBy("observed_ms")
        .agg(F.collect_list(entry).alias("entries"))
    )
    return raw(per_hour, "binance", "funding_info", F.to_json("entries"))


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    coin = F.struct(
        F.when(F.col("sym_no") == 0, "kC0").otherwise(F.col("symbol")).alias("name"),
        F.col("sym_no").alias("szDecimals"),
        F.when(F.col("sym_no") != 4, 50 - F.col("sym_no")).alias("maxLeverage"),
    )
    per_hour = _hours(spark, sf_dir, "hyperliquid").groupBy("observed_ms").agg(
        F.collect_list(coin).alias("universe")
    )
    return raw(per_hour, "hyperliquid", "meta", F.to_json(F.struct("universe")))


#: How often either venue's list is fetched, and how far its clock is from the other's.
LIST_EVERY = {"binance": 600_000, "hyperliquid": 900_000}
LIST_OFFSET = {"binance": 0, "hyperliquid": 433_000}


def _listing(spark: SparkSession, sf_dir: str, venue: str) -> DataFrame:
    """(sym_no, symbol, k, observed_ms) of the coins on list number k; either venue drops one for a while."""
    every, offset = LIST_EVERY[venue], LIST_OFFSET[venue]
    k = F.floor((F.col("obs_ms") - bridge.T0 - offset) / every).cast("bigint")
    gone = (
        (F.col("sym_no") == 4) & (F.col("k") % 5 == 2)
        if venue == "binance"
        else (F.col("sym_no") == 1) & (F.col("k") % 4 == 1)
    )
    seen = side(spark, sf_dir, venue).select("sym_no", "symbol", k.alias("k")).distinct()
    return seen.filter(~gone).withColumn("observed_ms", F.lit(bridge.T0 + offset) + F.col("k") * every)


def list_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Contract lists of both venues on clocks of their own; the second venue states no status."""
    base = F.when(F.col("sym_no") == 0, "1000C0").otherwise(F.col("symbol"))
    status = (
        F.when((F.col("sym_no") == 2) & (F.col("k") % 7).isin(3, 4), "SETTLING")
        .when((F.col("sym_no") == 3) & (F.col("k") % 11 == 5), "ODD")
        .otherwise("TRADING")
    )
    tick = F.array(F.struct(F.lit("PRICE_FILTER").alias("filterType"), F.lit("0.10").alias("tickSize")))
    contract = F.struct(
        F.concat(base, F.lit("USDT")).alias("symbol"),
        F.lit("PERPETUAL").alias("contractType"),
        status.alias("status"),
        base.alias("baseAsset"),
        tick.alias("filters"),
    )
    first = _listing(spark, sf_dir, "binance").groupBy("observed_ms").agg(F.collect_list(contract).alias("symbols"))
    coin = F.struct(
        F.when(F.col("sym_no") == 0, "kC0").otherwise(F.col("symbol")).alias("name"),
        F.col("sym_no").alias("szDecimals"),
        F.lit(50).alias("maxLeverage"),
    )
    second = _listing(spark, sf_dir, "hyperliquid").groupBy("observed_ms").agg(F.collect_list(coin).alias("universe"))
    return (
        raw(first, "binance", "exchange_info",
            F.to_json(F.struct(F.col("observed_ms").alias("serverTime"), "symbols"))),
        raw(second, "hyperliquid", "meta", F.to_json(F.struct("universe"))),
    )


def lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the parsers of both contract lists make of ``list_documents``, with ``ts``."""
    first, second = list_documents(spark, sf_dir)
    rows = NB.instruments(first.unionByName(funding_info(spark, sf_dir))).unionByName(NH.instruments(second))
    return rows.withColumn("ts", F.timestamp_millis("ts_ms"))


def interval_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An interval list with each contract list of venue 1; two contracts change their interval now and then."""
    hours = (
        F.when((F.col("sym_no") == 3) & (F.floor(F.col("k") / 4) % 2 == 0), 4)
        .when((F.col("sym_no") == 1) & (F.col("k") % 9 < 3), 1)
    )
    entry = F.struct(F.concat("symbol", F.lit("USDT")).alias("symbol"), hours.alias("fundingIntervalHours"))
    listed = _listing(spark, sf_dir, "binance").groupBy("observed_ms").agg(
        F.collect_list(F.when(hours.isNotNull(), entry)).alias("entries")
    )
    return raw(listed, "binance", "funding_info", F.to_json("entries"))


def symbol_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The symbol dimension over time, from every contract and interval list of both venues."""
    def build() -> DataFrame:
        first, second = list_documents(spark, sf_dir)
        both = first.unionByName(interval_documents(spark, sf_dir))
        rows = NB.instruments(both).unionByName(NH.instruments(second))
        return history_of(rows.withColumn("ts", F.timestamp_millis("ts_ms")))

    return bridge.stored(spark, sf_dir, "symbol-history", build)


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = exchange_info(spark, sf_dir).unionByName(funding_info(spark, sf_dir))
    return NB.instruments(both).unionByName(NH.instruments(meta(spark, sf_dir)))


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The symbol dimension of the newest contract list of each venue."""
    def build() -> DataFrame:
        rest = ["symbol", "mult", "funding_interval_h", "tick", "status"]
        newest = (
            instruments(spark, sf_dir)
            .groupBy("venue", "venue_symbol")
            .agg(F.max_by(F.struct(*rest), "ts_ms").alias("r"))
            .select("venue", "venue_symbol", "r.*")
        )
        return symbol_dimension(newest)

    return bridge.stored(spark, sf_dir, "symbols", build)


def premium_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.struct(
        binance_name().alias("symbol"),
        text(F.col("px")).alias("markPrice"),
        text(F.col("px") + 1).alias("indexPrice"),
        F.when(F.col("event_id") % 9 == 0, "").otherwise(text(rate())).alias("lastFundingRate"),
        F.when(F.col("event_id") % 10 == 0, 0)
        .otherwise(F.col("obs_ms") + 28_800_000)
        .alias("nextFundingTime"),
        F.col("obs_ms").alias("time"),
    )
    return documents(side(spark, sf_dir, "binance", "click"), "binance", "premium_index", entry)


def ws_mark_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames in the combined envelope and bare ones; ``P`` differs from ``p`` by case."""
    entry = F.to_json(
        F.struct(
            F.lit("markPriceUpdate").alias("kind"),
            F.col("obs_ms").alias("E"),
            binance_name().alias("s"),
            text(F.col("px")).alias("p"),
            text(F.col("px") + 1).alias("i"),
            text(rate()).alias("r"),
            (F.col("obs_ms") + 28_800_000).alias("T"),
        )
    )
    with_estimate = F.regexp_replace(entry, r"\}$", ',"P":"0.5","e":"markPriceUpdate"}')
    packed = (
        side(spark, sf_dir, "binance", "view")
        .groupBy(F.floor(F.col("event_id") / F.lit(PER_DOCUMENT)).alias("block"))
        .agg(
            F.concat(F.lit("["), F.array_join(F.collect_list(with_estimate), ","), F.lit("]")).alias("data"),
            F.max("obs_ms").alias("observed_ms"),
        )
    )
    enveloped = F.concat(F.lit('{"stream":"!markPrice@arr@1s","data":'), F.col("data"), F.lit("}"))
    return raw(
        packed,
        "binance",
        "ws_mark_price",
        F.when(F.col("block") % 2 == 0, enveloped).otherwise(F.col("data")),
    )


def bad_mark_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One faulty frame beside each block of sound ones: cut off, nameless, without an instant, with a word
    for a price, and with a price below zero."""
    blocks = (
        side(spark, sf_dir, "binance", "view")
        .groupBy(F.floor(F.col("event_id") / F.lit(PER_DOCUMENT)).alias("block"))
        .agg(F.max("obs_ms").alias("observed_ms"))
    )
    at = text(F.col("observed_ms"))
    payload = F.element_at(
        F.array(
            F.lit('{"stream":"x","data":[{"E":'),
            F.concat(F.lit('[{"p":"1","E":'), at, F.lit("}]")),
            F.lit('{"s":"C1USDT","p":"1","E":"soon"}'),
            F.concat(F.lit('{"stream":"x","data":[{"s":"C1USDT","p":"cheap","E":'), at, F.lit("}]}")),
            F.concat(F.lit('[{"s":"C1USDT","p":"-5","E":'), at, F.lit("}]")),
        ),
        (F.col("block") % 5 + 1).cast("int"),
    )
    return raw(blocks, "binance", "ws_mark_price", payload)


def funding_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.struct(
        binance_name().alias("symbol"),
        text(rate()).alias("fundingRate"),
        F.col("obs_ms").alias("fundingTime"),
    )
    return documents(side(spark, sf_dir, "binance", "signup"), "binance", "funding_rate", entry)


def open_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = F.to_json(
        F.struct(
            binance_name().alias("symbol"),
            text(F.col("px")).alias("openInterest"),
            F.col("obs_ms").alias("time"),
        )
    )
    rows = side(spark, sf_dir, "binance", "purchase").withColumn("observed_ms", F.col("obs_ms"))
    return raw(rows, "binance", "open_interest", one)


def ticker_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.struct(
        binance_name().alias("symbol"),
        text(F.col("px") - 50).alias("priceChangePercent"),
        text(F.col("px") * 1000).alias("quoteVolume"),
        F.col("obs_ms").alias("closeTime"),
    )
    return documents(side(spark, sf_dir, "binance", "purchase"), "binance", "ticker_24h", entry)


def ls_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    from perptide.schemas import LS_KINDS

    kind = F.element_at(
        F.array(*[F.lit(k) for k in LS_KINDS]), (F.floor(F.col("event_id") / 2) % 3 + 1).cast("int")
    )
    share = (F.col("event_id") % 1001).cast("decimal(10,0)") / F.lit(1000).cast("decimal(4,0)")
    quiet = F.col("event_id") % 25 == 0
    entry = F.struct(
        text(share).alias("longAccount"),
        text(F.when(quiet, 0).otherwise(F.col("px"))).alias("buyVol"),
        text(F.when(quiet, 0).otherwise(F.col("event_id") % 90)).alias("sellVol"),
        F.col("obs_ms").alias("timestamp"),
    )
    rows = side(spark, sf_dir, "binance").withColumn("kind", kind).withColumnRenamed(
        "symbol", "request_symbol"
    )
    return reduce(
        DataFrame.unionByName,
        [
            documents(
                rows.filter(F.col("kind") == k), "binance", k, entry, PER_DOCUMENT, "request_symbol"
            )
            for k in LS_KINDS
        ],
    )


def interval() -> Column:
    return F.element_at(
        F.array(*[F.lit(i) for i in INTERVALS]), (F.floor(F.col("event_id") / 2) % 3 + 1).cast("int")
    )


def klines(spark: SparkSession, sf_dir: str) -> DataFrame:
    bar = F.array(
        text(F.col("obs_ms") - 60_000),
        F.lit("1"),
        F.lit("2"),
        F.lit("3"),
        text(F.col("px")),
        F.lit("9"),
        text(F.col("obs_ms")),
        F.lit("0"),
    )
    rows = (
        side(spark, sf_dir, "binance", "signup")
        .withColumnRenamed("symbol", "request_symbol")
        .withColumn("interval", interval())
    )
    return documents(
        rows, "binance", "klines", bar, PER_DOCUMENT, "request_symbol", "interval"
    )


def force_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One frame per order; every fifth order is pushed twice."""
    order = F.to_json(
        F.struct(
            binance_name().alias("s"),
            text(F.col("px")).alias("p"),
            text(F.col("event_id") % 90 + 1).alias("q"),
            text(F.col("px") + 1).alias("ap"),
            text(F.col("event_id") % 50 + 1).alias("z"),
            text(F.col("obs_ms")).alias("T"),
        )
    )
    selling = F.when(F.floor(F.col("event_id") / 2) % 2 == 0, "SELL").otherwise("BUY")
    with_side = F.concat(
        F.regexp_replace(order, r"\}$", ',"S":"'), selling, F.lit('","o":"LIMIT"}')
    )
    frame = F.concat(
        F.lit('{"e":"forceOrder","E":'), (F.col("obs_ms") + 40).cast("string"), F.lit(',"o":'), with_side, F.lit("}")
    )
    rows = (
        side(spark, sf_dir, "binance", "error")
        .withColumn("observed_ms", F.col("obs_ms"))
        .withColumn(
            "copy", F.explode(F.when(F.col("event_id") % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
        )
    )
    return raw(rows, "binance", "ws_force_order", frame)


def meta_and_asset_ctxs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two parallel arrays; one document per instant, of at most 50 coins."""
    ctx = F.struct(
        text(rate()).alias("funding"),
        text(F.col("px")).alias("openInterest"),
        text(F.col("px")).alias("markPx"),
        text(F.col("px") + 1).alias("oraclePx"),
        F.when(F.col("event_id") % 3 == 0, F.lit(None).cast("string"))
        .otherwise(text(rate() * 2))
        .alias("premium"),
        text(F.col("px") * 1000).alias("dayNtlVlm"),
    )
    grouped = (
        side(spark, sf_dir, "hyperliquid", "click")
        .groupBy("obs_ms", F.floor(F.col("event_id") / F.lit(PER_DOCUMENT)).alias("block"))
        .agg(F.collect_list(F.struct(hyperliquid_name().alias("name"), ctx.alias("ctx"))).alias("e"))
        .withColumn("observed_ms", F.col("obs_ms"))
    )
    coins = F.transform("e", lambda x: F.struct(x["name"].alias("name")))
    ctxs = F.transform("e", lambda x: x["ctx"])
    payload = F.concat(
        F.lit("["),
        F.to_json(F.struct(coins.alias("universe"))),
        F.lit(","),
        F.to_json(ctxs),
        F.lit("]"),
    )
    return raw(grouped, "hyperliquid", "meta_and_asset_ctxs", payload)


def predicted_fundings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[coin, [[venue key, prediction], ...]]; the other venue's key is in every row."""
    def prediction(scale: int) -> Column:
        return F.to_json(
            F.struct(
                text(rate() * scale).alias("fundingRate"),
                (F.col("obs_ms") + 3_600_000).alias("nextFundingTime"),
            )
        )

    row = F.concat(
        F.lit('["'), hyperliquid_name(), F.lit('",[["BinPerp",'), prediction(8),
        F.lit('],["HlPerp",'), prediction(1), F.lit("]]]"),
    )
    rows = side(spark, sf_dir, "hyperliquid", "view").withColumn("observed_ms", F.col("obs_ms"))
    return raw(
        rows, "hyperliquid", "predicted_fundings", F.concat(F.lit("["), row, F.lit("]"))
    )


def funding_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.struct(
        text(rate()).alias("fundingRate"), text(rate() * 2).alias("premium"), F.col("obs_ms").alias("time")
    )
    rows = side(spark, sf_dir, "hyperliquid", "signup").withColumnRenamed("symbol", "request_symbol")
    return documents(
        rows, "hyperliquid", "funding_history", entry, PER_DOCUMENT, "request_symbol"
    )


def candle_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with ``t`` and, two times in three, ``T``."""
    closing = F.when(
        F.col("event_id") % 3 != 0, F.concat(F.lit(',"T":'), text(F.col("obs_ms") + 59_999))
    ).otherwise("")
    bar = F.concat(
        F.lit('{"t":'), text(F.col("obs_ms")), closing, F.lit(',"o":"1","c":"'), text(F.col("px")), F.lit('"}')
    )
    grouped = (
        side(spark, sf_dir, "hyperliquid", "signup")
        .withColumnRenamed("symbol", "request_symbol")
        .withColumn("interval", interval())
        .groupBy(
            F.floor(F.col("event_id") / F.lit(PER_DOCUMENT)).alias("block"), "request_symbol", "interval"
        )
        .agg(F.collect_list(bar).alias("bars"), F.max("obs_ms").alias("observed_ms"))
    )
    return raw(
        grouped,
        "hyperliquid",
        "candle_snapshot",
        F.concat(F.lit("["), F.array_join("bars", ","), F.lit("]")),
        "request_symbol",
        "interval",
    )


def ws_all_mids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mid frames, with a subscription acknowledgement in between."""
    mids = F.to_json(
        F.struct(
            F.lit("allMids").alias("channel"),
            F.struct(F.create_map(hyperliquid_name(), text(F.col("px"))).alias("mids")).alias("data"),
        )
    )
    acknowledgement = F.lit('{"channel":"subscriptionResponse","data":{"method":"subscribe"}}')
    rows = side(spark, sf_dir, "hyperliquid", "click").withColumn("observed_ms", F.col("obs_ms"))
    return raw(
        rows,
        "hyperliquid",
        "ws_all_mids",
        F.when(F.col("event_id") % 7 == 0, acknowledgement).otherwise(mids),
    )
