"""Exact quantiles of groups of any size.

The built-in exact percentile keeps every distinct value of a group in one task.
Here values are counted, their ranks are running sums carried between slices of about
equal numbers of values, and the two neighbours of each wanted rank are picked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perptide.operators.carry import running
from perptide.operators.ranks import ROWS_A_SLICE, sliced


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, wanted: dict[str, float], rows_a_slice: int = ROWS_A_SLICE
) -> DataFrame:
    """Linear-interpolation quantiles per key, plus ``n``. NULL values are left out."""
    keys = list(keys)
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_x"))
        .agg(F.count("*").alias("_f"))
    )
    totals = counted.groupBy(*keys).agg(F.sum("_f").alias("n"))
    ranked = running(
        sliced(counted, keys, F.col("_x"), rows_a_slice), keys, ["_x"], F.col("_f"), "_upto", how="sum", chunk=F.col("_slice")
    ).join(totals, keys)

    def at(rank: Column) -> Column:
        hit = (F.col("_upto") - F.col("_f") <= rank) & (rank < F.col("_upto"))
        return F.max(F.when(hit, F.col("_x")))

    sides = []
    for name, q in wanted.items():
        position = F.lit(q) * (F.col("n") - 1)
        sides += [at(F.floor(position)).alias(f"_lo_{name}"), at(F.ceil(position)).alias(f"_hi_{name}")]
    picked = ranked.groupBy(*keys, "n").agg(*sides)

    def between(name: str, q: float) -> Column:
        position = F.lit(q) * (F.col("n") - 1)
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        return (low + (high - low) * (position - F.floor(position))).alias(name)

    return picked.select(*keys, "n", *[between(name, q) for name, q in wanted.items()])
