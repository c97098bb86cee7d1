"""Request cost annotation over a request log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Prices of the venues' endpoints and their accounts.
DEFAULT_KLINE_ROWS = 500
MAX_RANGED_ROWS = 500
MARKET_WIDE_WEIGHT = {"premium_index": (1, 10), "ticker_24h": (1, 40)}
FUNDING_BUCKET_CALLS = ("funding_info", "funding_rate_history")
WEIGHT_ONE_CALLS = ("exchange_info", "open_interest")
RATIO_CALLS = (
    "global_long_short_account_ratio",
    "top_long_short_position_ratio",
    "taker_long_short_ratio",
)
INFO_WEIGHT = 20
HISTORY_ROWS_PER_WEIGHT = 20
CANDLE_ROWS_PER_WEIGHT = 60


def kline_weight(rows: Column) -> Column:
    asked = F.coalesce(rows, F.lit(DEFAULT_KLINE_ROWS))
    return (
        F.when(asked < 100, 1).when(asked < 500, 2).when(asked <= 1000, 5).otherwise(10)
    )


def ranged_weight(rows: Column, per_weight: int) -> Column:
    return F.ceil(F.coalesce(rows, F.lit(MAX_RANGED_ROWS)) / F.lit(per_weight)).cast("int")


def annotate(log: DataFrame) -> DataFrame:
    """Add ``bucket`` and ``cost`` to (venue, endpoint, symbols, rows) requests.

    ``symbols`` NULL is the market-wide form of an endpoint. A request that names
    several symbols at once, or an endpoint with no price, gets a NULL cost.
    """
    endpoint, rows = F.col("endpoint"), F.col("rows").cast("int")
    binance_cost = F.when(endpoint == "klines", kline_weight(rows))
    for call, (one, whole) in MARKET_WIDE_WEIGHT.items():
        binance_cost = binance_cost.when(
            endpoint == call,
            F.when(F.col("symbols").isNull(), whole).when(F.col("symbols") == 1, one),
        )
    binance_cost = binance_cost.when(
        endpoint.isin(*WEIGHT_ONE_CALLS, *FUNDING_BUCKET_CALLS, *RATIO_CALLS), 1
    )
    other_cost = (
        F.when(endpoint == "candle_snapshot", ranged_weight(rows, CANDLE_ROWS_PER_WEIGHT))
        .when(endpoint == "funding_history", ranged_weight(rows, HISTORY_ROWS_PER_WEIGHT))
        .otherwise(F.lit(INFO_WEIGHT))
    )
    bucket = (
        F.when(F.col("venue") == "hyperliquid", F.lit("info_weight"))
        .when(endpoint.isin(*FUNDING_BUCKET_CALLS), F.lit("funding_rate"))
        .when(endpoint.isin(*RATIO_CALLS), F.lit("futures_data"))
        .otherwise(F.lit("fapi_weight"))
    )
    return log.withColumn("bucket", bucket).withColumn(
        "cost",
        F.when(F.col("venue") == "hyperliquid", other_cost).otherwise(binance_cost).cast("int"),
    )
