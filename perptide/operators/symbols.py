"""Symbol dimension and the lookups over it.

No join here carries a broadcast hint. The dimension is small as long as the
venues list hundreds of contracts, and Spark broadcasts it then because its
measured size is under ``spark.sql.autoBroadcastJoinThreshold``; above that
size the same plan runs as a shuffled join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perptide.operators.asof import FOREVER, FOREVER_AGO, lookup
from perptide.operators.history import scd2_history

DEFAULT_INTERVAL_H = {"binance": 8, "hyperliquid": 1}


def symbol_dimension(instruments: DataFrame, quote_asset: str = "USDT", *extra: str) -> DataFrame:
    """(venue, venue_symbol) to (symbol, mult, funding_interval_h).

    Contracts of venue ``binance`` are narrowed to one quote asset so that a coin
    has one contract there.
    """
    fallback = F.when(F.col("venue") == "hyperliquid", 1).otherwise(8)
    return instruments.filter(
        (F.col("venue") != "binance") | F.col("venue_symbol").endswith(quote_asset)
    ).select(
        "venue",
        "venue_symbol",
        "symbol",
        "mult",
        F.coalesce(F.col("funding_interval_h"), fallback).alias("funding_interval_h"),
        *extra,
    )


def duplicates(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, with their counts. Empty is healthy."""
    return df.groupBy(*key).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def mapping_conflicts(dim: DataFrame) -> DataFrame:
    """Names that are ambiguous in either direction of the symbol mapping."""
    forward = duplicates(dim, "venue", "venue_symbol").select(
        "venue", F.lit("venue_symbol").alias("side"), F.col("venue_symbol").alias("name"), "rows"
    )
    backward = duplicates(dim, "venue", "symbol").select(
        "venue", F.lit("symbol").alias("side"), F.col("symbol").alias("name"), "rows"
    )
    return forward.unionByName(backward)


def one_to_one(dim: DataFrame) -> DataFrame:
    """The mapping itself, failing the job if a name is ambiguous either way."""
    conflicts = mapping_conflicts(dim).select(
        "venue", "side", "name", F.lit(True).alias("conflict")
    )
    ambiguous = conflicts.groupBy("venue").agg(F.count("*").alias("conflicts"))
    checked = dim.join(ambiguous, "venue", "left")
    return checked.filter(
        F.when(F.col("conflicts").isNull(), F.lit(True)).otherwise(
            F.raise_error(
                F.concat(F.lit("ambiguous symbol mapping on venue "), F.col("venue"))
            ).cast("boolean")
        )
    ).drop("conflicts")


def symbol_history(lists: DataFrame, quote_asset: str = "USDT") -> DataFrame:
    """The dimension as segments of time, from every contract list (with ``ts``) instead of the newest.

    A name means what the last list not after the observation says that has it; before the first such list,
    what that one says. So a delisted contract keeps its meaning for late rows.
    """
    attributes = ["symbol", "mult", "funding_interval_h"]
    versions = scd2_history(
        symbol_dimension(lists.select("venue", "venue_symbol", *attributes, "ts"), quote_asset, "ts"),
        ["venue", "venue_symbol"], attributes, ["venue"],
        instants=lists.select("venue", "ts"),
    )
    # As many rows per contract as its versions.
    by_start = Window.partitionBy("venue", "venue_symbol").orderBy("valid_from")
    start = F.unix_micros("valid_from")
    return versions.select(
        "venue",
        "venue_symbol",
        *attributes,
        F.when(F.row_number().over(by_start) == 1, FOREVER_AGO).otherwise(start).alias("seg_from_us"),
        F.lead(start, 1, FOREVER).over(by_start).alias("seg_to_us"),
    )


def resolve(entries: DataFrame, dim: DataFrame) -> DataFrame:
    """Venue names to unified names; entries nobody has mapped are left out.

    Against a history of the dimension a name is read as of the entry's ``ts_ms``.
    """
    if "seg_from_us" not in dim.columns:
        return entries.join(dim, ["venue", "venue_symbol"], "inner")
    values = ["symbol", "mult", "funding_interval_h"]
    at = F.col("ts_ms") * F.lit(1000)
    return lookup(entries, dim, ["venue", "venue_symbol"], at, values).filter(F.col("symbol").isNotNull())


def to_venue(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Unified names to venue names."""
    return df.join(dim.select("venue", "symbol", "venue_symbol"), ["venue", "symbol"], "inner")


def unknown_symbols(entries: DataFrame, dim: DataFrame) -> DataFrame:
    """Names on the feed that the dimension does not have, with their counts.

    Counting comes before the anti join, so the join sees one row per name.
    """
    seen = entries.groupBy("venue", "venue_symbol").agg(F.count("*").alias("rows"))
    return seen.join(dim, ["venue", "venue_symbol"], "left_anti")
