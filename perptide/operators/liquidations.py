"""Observed liquidations. Every figure is a lower bound of one venue's feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perptide import schemas as S
from perptide.functions import scalars as C
from perptide.operators.carry import DAY_MS, chunk_of, running
from perptide.operators.history import scd2_history
from perptide.operators.normalize_binance import SOURCES
from perptide.operators.symbols import resolve

EVENT_KEY = ["venue", "symbol", "ts_ms", "event_id"]


def liquidation_rows(orders: DataFrame, dim: DataFrame) -> DataFrame:
    """Forced orders to liquidation rows, before removal of repeated frames.

    The side is the position's, opposite to the order's; an order side that is neither of
    the two is an error. Size is in base units; notional is unknown when the multiplier is.
    """
    known = resolve(orders, dim)
    identity = F.sha2(
        F.concat_ws(
            "|",
            "symbol",
            F.col("ts_ms").cast("string"),
            "order_side",
            F.col("average_price").cast("string"),
            F.col("filled_qty").cast("string"),
        ),
        256,
    )
    return S.conform(
        known,
        S.LIQUIDATION,
        event_id=identity,
        side=F.when(F.col("order_side") == "SELL", "long")
        .when(F.col("order_side") == "BUY", "short")
        .otherwise(
            F.raise_error(F.concat(F.lit("unknown order side: "), F.coalesce("order_side", F.lit("none"))))
        ),
        price=F.col("average_price"),
        size=C.to_base_units(F.col("filled_qty"), F.col("mult")),
        notional_usd=F.when(
            F.col("mult").isNotNull(), F.col("average_price") * F.col("filled_qty")
        ),
        throttled_source=F.lit(True),
        completeness=F.lit("lower_bound"),
        ingest_path=F.lit("binance_ws"),
        source=F.lit(SOURCES["ws_force_order"]),
    )


def liquidations(orders: DataFrame, dim: DataFrame) -> DataFrame:
    return liquidation_rows(orders, dim).dropDuplicates(EVENT_KEY)


def hourly_bars(rows: DataFrame) -> DataFrame:
    """Long and short bars per hour and ingest path; venues are never added up."""
    return rows.groupBy(
        "venue",
        "symbol",
        "ingest_path",
        "side",
        C.floor_ms(F.col("ts_ms"), 3_600_000).alias("hour_ms"),
    ).agg(
        F.sum("notional_usd").alias("observed_lower_bound_usd"),
        F.count("*").alias("events"),
        F.count_if(F.col("notional_usd").isNull()).alias("events_without_notional"),
        F.lit("lower_bound").alias("completeness"),
    )


#: Venues whose contract list states no status: a contract on it is trading.
WITHOUT_STATUS = ("hyperliquid",)


def tradable(snapshots: DataFrame) -> DataFrame:
    """Rows of contracts that trade. A status that the venue does not publish is not "not trading";
    one that it does publish and nobody knows is."""
    silent = F.col("venue").isin(*WITHOUT_STATUS) & F.col("status").isNull()
    return snapshots.filter(F.coalesce(F.col("status") == "trading", F.lit(False)) | silent)


def listed_on_both(instruments: DataFrame, key: Sequence[str] = ("symbol",)) -> DataFrame:
    """Coins that both venues list: per-venue distinct names, then an inner join."""
    key = list(key)
    sides = [
        instruments.filter(F.col("venue") == v).select(*key).distinct() for v in S.VENUES
    ]
    return sides[0].join(sides[1], key)


def listed_now(snapshots: DataFrame) -> DataFrame:
    """Coins that trade on the newest list of either venue, whatever its instant."""
    newest = snapshots.groupBy("venue").agg(F.max("ts").alias("ts"))
    return listed_on_both(tradable(snapshots).join(newest, ["venue", "ts"], "left_semi"))


def venue_spells(snapshots: DataFrame) -> DataFrame:
    """(venue, symbol, valid_from, valid_to): how long a coin trades on one venue, by that venue's own lists."""
    listed = tradable(snapshots).select("venue", "symbol", "ts", F.lit(True).alias("listed")).distinct()
    return scd2_history(
        listed, ["venue", "symbol"], ["listed"], ["venue"], instants=snapshots.select("venue", "ts")
    ).drop("listed")


def universe(snapshots: DataFrame) -> DataFrame:
    """Membership spells of the coins that both venues list as trading.

    Every list of either venue is a reconciliation, and the other venue's last list before it
    still holds; the venues need not list at the same instants. So a coin is in while its
    spells on both venues overlap: each spell adds one at its start and takes one at its
    end, and the running total is carried along the coin's changes by chunks.
    """
    spells = venue_spells(snapshots)
    steps = spells.select("symbol", F.unix_millis("valid_from").alias("ms"), F.lit(1).alias("d")).unionByName(
        spells.filter(F.col("valid_to").isNotNull()).select(
            "symbol", F.unix_millis("valid_to").alias("ms"), F.lit(-1).alias("d")
        )
    )
    changes = steps.groupBy("symbol", "ms").agg(F.sum("d").alias("d")).filter(F.col("d") != 0)
    counted = running(changes, ["symbol"], ["ms"], F.col("d"), "venues", how="sum", chunk=chunk_of(F.col("ms"), 30 * DAY_MS))
    # Per coin as many rows as its membership changed.
    later = Window.partitionBy("symbol").orderBy("ms")
    return (
        counted.withColumn("until", F.lead("ms").over(later))
        .filter(F.col("venues") == len(S.VENUES))
        .select(
            "symbol",
            F.timestamp_millis("ms").alias("in_from"),
            F.timestamp_millis("until").alias("in_to"),
            F.when(F.col("until").isNull(), "listed_on_both_venues").otherwise("not_on_both_venues").alias("reason"),
        )
    )
