"""Large accounts: the sample, its boards, address pages and modelled price ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perptide.operators.quantiles import exact_quantiles
from perptide.operators.reports import HIDE_PERCENT_BELOW, HIDE_VALUE_BELOW

MIN_SAMPLE = 100


def sample(accounts: DataFrame, min_n: int = MIN_SAMPLE) -> DataFrame:
    """Accounts from the top by value until ``min_n`` of them are usable.

    The value of the ``min_n``-th usable account bounds the list. Finding it takes
    a top-k, and applying it a scalar subquery, so nothing is ranked globally.
    """
    usable = accounts.filter("usable").orderBy(F.desc("value"), F.asc("account")).limit(min_n)
    bound = usable.agg(F.min(F.struct("value", (-F.col("account")).alias("a"))).alias("edge"))
    edge = bound.select("edge").scalar()
    return accounts.filter(F.struct("value", (-F.col("account")).alias("a")) >= edge)


def boards(
    positions: DataFrame, earlier: DataFrame, liquidations: DataFrame, members: DataFrame
) -> DataFrame:
    """Long share, net change, mean leverage, most concentrated coin, liquidations.

    One row per board with its n; the coin board keeps the coin in ``item``.
    """
    chosen = members.select("account")

    def inside(df: DataFrame) -> DataFrame:
        return df.join(chosen, "account", "left_semi")

    now, before = inside(positions), inside(earlier)
    long_side = F.col("side") == "long"
    signed = F.when(long_side, F.col("notional")).otherwise(-F.col("notional"))
    totals = now.agg(
        (F.sum(F.when(long_side, F.col("notional"))) / F.sum("notional")).alias("long_share"),
        F.sum(signed).alias("net"),
        F.avg("leverage").alias("leverage"),
        F.count_distinct("account").alias("n"),
    )
    net_before = before.agg(F.coalesce(F.sum(signed), F.lit(0.0)).alias("net_before"))
    first = totals.select(
        F.lit("long_share").alias("board"), F.lit(None).cast("string").alias("item"),
        F.col("long_share").alias("value"), "n",
    ).unionByName(
        totals.select(
            F.lit("net_change").alias("board"), F.lit(None).cast("string").alias("item"),
            (F.col("net") - net_before.scalar()).alias("value"), "n",
        )
    ).unionByName(
        totals.select(
            F.lit("mean_leverage").alias("board"), F.lit(None).cast("string").alias("item"),
            F.col("leverage").alias("value"), "n",
        )
    )
    coin = (
        now.groupBy("symbol")
        .agg(F.sum("notional").alias("value"), F.count_distinct("account").alias("n"))
        .orderBy(F.desc("value"), F.asc("symbol"))
        .limit(1)
        .select(F.lit("most_concentrated_coin").alias("board"), F.col("symbol").alias("item"), "value", "n")
    )
    forced = inside(liquidations).agg(
        F.coalesce(F.sum("notional"), F.lit(0.0)).alias("value"), F.count("*").alias("n")
    ).select(
        F.lit("observed_liquidations").alias("board"),
        F.lit("lower_bound").alias("item"),
        "value",
        "n",
    )
    everything = first.unionByName(coin).unionByName(forced)
    return everything.withColumn(
        "value",
        F.when(
            (F.col("n") >= HIDE_VALUE_BELOW) | (F.col("board") == "observed_liquidations"),
            F.col("value"),
        ),
    )


def is_forced(fill_json: Column) -> Column:
    """A fill is forced when the key is there, even with a null value."""
    return F.array_contains(F.json_object_keys(fill_json), "liquidation")


def address_pages(
    positions: DataFrame, fills: DataFrame, members: DataFrame, opted_out: DataFrame
) -> DataFrame:
    """Per sampled address: open positions, results of its fills, forced fills."""
    shown = members.select("account").join(opted_out.select("account"), "account", "left_anti")
    held = positions.groupBy("account").agg(
        F.count("*").alias("open_positions"), F.sum("notional").alias("open_notional")
    )
    mine = fills.join(shown, "account", "left_semi")
    counts = mine.groupBy("account").agg(
        F.count("*").alias("fills"),
        F.count_if(is_forced(F.col("fill"))).alias("forced_fills"),
        F.count_if(F.col("realized") > 0).alias("gains"),
    )
    quantiles = exact_quantiles(
        mine, ["account"], "realized", {"p25": 0.25, "median": 0.5, "p75": 0.75}
    ).drop("n")
    results = counts.join(quantiles, "account", "left")
    n = F.coalesce("fills", F.lit(0))
    enough = n >= HIDE_VALUE_BELOW
    return (
        shown.join(held, "account", "left")
        .join(results, "account", "left")
        .select(
            "account",
            F.coalesce("open_positions", F.lit(0)).alias("open_positions"),
            F.coalesce("open_notional", F.lit(0.0)).alias("open_notional"),
            n.alias("n"),
            F.coalesce("forced_fills", F.lit(0)).alias("forced_fills"),
            F.when(enough, F.col("p25")).alias("p25_realized"),
            F.when(enough, F.col("median")).alias("median_realized"),
            F.when(enough, F.col("p75")).alias("p75_realized"),
            F.when(n >= HIDE_PERCENT_BELOW, F.col("gains") / n).alias("gain_share"),
        )
    )


def liquidation_ranges(positions: DataFrame, width_pct: float = 1.0) -> DataFrame:
    """Modelled liquidation prices by price range. Ranges only, never a single price.

    Maintenance is approximated as 1 / (2 * max leverage). A range is a step of
    ``width_pct`` percent of the coin's mark.
    """
    maintenance = 1 / (2 * F.col("max_leverage"))
    margin = 1 / F.col("leverage") - maintenance
    price = F.when(F.col("side") == "long", F.col("entry_px") * (1 - margin)).otherwise(
        F.col("entry_px") * (1 + margin)
    )
    step = F.col("mark") * width_pct / 100
    placed = positions.withColumn("bucket", F.floor(price / step).cast("bigint"))
    return placed.groupBy("symbol", "side", "bucket").agg(
        F.sum("notional").alias("notional"),
        F.count("*").alias("positions"),
        F.lit("model_estimate").alias("label"),
    )
