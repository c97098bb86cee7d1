"""Multiplier as of a minute, with the nearest version as fallback.

The versions of a coin are turned into half-open segments of the time axis on
which the answer does not change. A probe then meets exactly one segment, so the
lookup emits one row per probe and needs no aggregation afterwards.

Segments are laid out by month of 30 days between the first and the last change of their key;
probes before and after meet the first and the last of these months. The join is an
equality on key and month, so a probe is compared with the segments of its month only,
however long the history of a key is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perptide import schemas as S
from perptide.functions import scalars as C

FOREVER_AGO = -(2**62)
FOREVER = 2**62


def multiplier_segments(instruments: DataFrame) -> DataFrame:
    """(venue, symbol, seg_from_us, seg_to_us, mult) from versioned instruments.

    The version covering an instant wins, the latest start first. Where nothing
    covers it, the version with the nearest start wins, the earlier one on a tie.
    Versions without a positive multiplier take no part.
    """
    versions = instruments.filter(F.col("mult") > 0).select(
        "venue",
        "symbol",
        "venue_symbol",
        F.unix_micros("valid_from").alias("f"),
        F.coalesce(F.unix_micros("valid_to"), F.lit(FOREVER)).alias("t"),
        F.col("mult").cast(S.MULT).alias("mult"),
    )
    key = ["venue", "symbol"]
    spread = versions.groupBy(*key).agg(F.min("mult").alias("lo"), F.max("mult").alias("hi"))
    constant = spread.filter(F.col("lo") == F.col("hi")).select(
        *key,
        F.lit(FOREVER_AGO).alias("seg_from_us"),
        F.lit(FOREVER).alias("seg_to_us"),
        F.col("lo").alias("mult"),
    )
    changing = versions.join(
        spread.filter(F.col("lo") != F.col("hi")).select(*key), key, "left_semi"
    )
    # One row per start; equal starts are settled by contract name.
    starts = changing.groupBy(*key, "f").agg(F.min_by("mult", "venue_symbol").alias("start_mult"))
    by_start = Window.partitionBy(*key).orderBy("f")
    midpoints = (
        starts.select(*key, "f", F.lag("f").over(by_start).alias("p"))
        .filter(F.col("p").isNotNull())
        .select(*key, (F.col("p") + F.expr("(f - p) div 2") + 1).alias("cut"))
    )
    cuts = (
        changing.select(*key, F.col("f").alias("cut"))
        .unionByName(changing.filter(F.col("t") < FOREVER).select(*key, F.col("t").alias("cut")))
        .unionByName(midpoints)
        .unionByName(changing.select(*key, F.lit(FOREVER_AGO).alias("cut")))
        .distinct()
    )
    by_cut = Window.partitionBy(*key).orderBy("cut")
    segments = cuts.select(
        *key,
        "cut",
        F.row_number().over(by_cut).alias("idx"),
        F.lead("cut", 1, FOREVER).over(by_cut).alias("seg_to_us"),
    )
    at_from = segments.select(*key, F.col("cut").alias("f"), F.col("idx").alias("first_idx"))
    at_end = segments.select(*key, F.col("seg_to_us").alias("t"), F.col("idx").alias("last_idx"))
    covering = (
        changing.join(at_from, [*key, "f"])
        .join(at_end, [*key, "t"])
        .withColumn("idx", F.explode(F.sequence("first_idx", "last_idx")))
        .groupBy(*key, "idx")
        .agg(F.min_by("mult", F.struct(-F.col("f"), "venue_symbol")).alias("cover_mult"))
    )
    placed = segments.join(
        starts.withColumnRenamed("f", "cut").withColumn(
            "start", F.struct(F.col("cut").alias("f"), F.col("start_mult").alias("mult"))
        ).select(*key, "cut", "start"),
        [*key, "cut"],
        "left",
    )
    here = F.last("start", ignorenulls=True).over(
        by_cut.rowsBetween(Window.unboundedPreceding, 0)
    )
    ahead = F.first("start", ignorenulls=True).over(
        by_cut.rowsBetween(1, Window.unboundedFollowing)
    )
    nearest = placed.select(*key, "cut", "idx", "seg_to_us", here.alias("p"), ahead.alias("n"))
    take_previous = F.col("n").isNull() | (
        F.col("p").isNotNull() & (F.col("cut") - F.col("p.f") <= F.col("n.f") - F.col("cut"))
    )
    varying = nearest.join(covering, [*key, "idx"], "left").select(
        *key,
        F.col("cut").alias("seg_from_us"),
        "seg_to_us",
        F.coalesce(
            "cover_mult",
            F.when(take_previous, F.col("p.mult")).otherwise(F.col("n.mult")),
        ).alias("mult"),
    )
    return constant.unionByName(varying)


MONTH_US = 30 * 86_400 * 1_000_000


def _month(us: Column) -> Column:
    return F.floor(us / F.lit(MONTH_US)).cast("bigint")


def by_months(segments: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(key, first_month, last_month) of each key's changes, and its segments once for each month they touch.

    A key that never changes has one row in either.
    """
    key = list(key)
    spans = segments.groupBy(*key).agg(
        F.min(_month(F.col("seg_to_us"))).alias("first_month"), F.max(_month(F.col("seg_from_us"))).alias("last_month")
    )
    never = F.col("first_month") > F.col("last_month")
    spans = spans.select(
        *key, *[F.when(never, F.lit(0)).otherwise(F.col(c)).cast("bigint").alias(c) for c in ("first_month", "last_month")]
    )
    first, last = F.col("first_month"), F.col("last_month")
    start = F.greatest(_month(F.col("seg_from_us")), first)
    start = F.least(start, last)
    end = F.greatest(F.least(_month(F.col("seg_to_us") - 1), last), start)
    laid = segments.join(spans, key).withColumn("month", F.explode(F.sequence(start, end)))
    return spans, laid.drop("first_month", "last_month")


def lookup(df: DataFrame, segments: DataFrame, key: Sequence[str], instant_us: Column, values: Sequence[str]) -> DataFrame:
    """``df`` with ``values`` of the segment of its ``key`` that holds the instant; NULL where the key has none."""
    key = list(key)
    spans, laid = by_months(segments.select(*key, "seg_from_us", "seg_to_us", *values), key)
    month = F.greatest(F.least(_month(F.col("_us")), F.col("last_month")), F.col("first_month"))
    probe = df.withColumn("_us", instant_us).join(spans, key, "left")
    probe = probe.withColumn("_month", F.when(F.col("first_month").isNotNull(), month)).drop("first_month", "last_month")
    dim = laid.select(*[F.col(k).alias(f"_k_{k}") for k in key], F.col("month").alias("_m"), "seg_from_us", "seg_to_us", *values)
    on = (F.col("_month") == F.col("_m")) & (F.col("_us") >= F.col("seg_from_us")) & (F.col("_us") < F.col("seg_to_us"))
    for k in key:
        on = on & (F.col(k) == F.col(f"_k_{k}"))
    return probe.join(dim, on, "left").drop("_us", "_month", "_m", *[f"_k_{k}" for k in key], "seg_from_us", "seg_to_us")


def with_multiplier(df: DataFrame, segments: DataFrame, ts: Column | str = "ts") -> DataFrame:
    """Add ``mult`` as of ``ts``; NULL where the coin has no usable version."""
    instant = F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)
    return lookup(df, segments, ["venue", "symbol"], instant, ["mult"]).select(*df.columns, "mult")


def with_oi_usd(df: DataFrame, segments: DataFrame) -> DataFrame:
    """Recompute ``oi_usd`` from the row's own factors and the minute's multiplier."""
    columns = df.columns if "oi_usd" in df.columns else [*df.columns, "oi_usd"]
    return (
        with_multiplier(df.drop("oi_usd"), segments)
        .withColumn("oi_usd", C.oi_usd(F.col("oi_base"), F.col("mark"), F.col("mult")))
        .select(*columns)
    )
