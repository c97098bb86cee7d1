"""Boards, digests, studies and scoreboards over the stored series."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perptide.functions import scalars as C
from perptide.operators import divergence as D
from perptide.operators.carry import islands, running
from perptide.operators.quantiles import exact_quantiles
from perptide.operators.ranks import ROWS_A_SLICE, sliced, tie_ranks

HIDE_VALUE_BELOW = 10
HIDE_PERCENT_BELOW = 30
Z95 = 1.959963984540054
DAY_MS = 86_400_000
EIGHT_HOURS_MS = 28_800_000


def _top(df: DataFrame, block: str, k: int, *order: Column) -> DataFrame:
    """The k first rows with their rank. Only k rows ever meet in one task."""
    rank = F.row_number().over(Window.partitionBy(F.lit(block)).orderBy(*order))
    return df.orderBy(*order).limit(k).select(F.lit(block).alias("block"), rank.alias("rank"), "*")


# -- boards --------------------------------------------------------------------------
def divergence_board(pctl: DataFrame, k: int = 10) -> DataFrame:
    """Coins ranked by percentile per metric, raw value second, n carried along.

    The percentile table has one row per (scope, metric), so the ranking window
    sees one row per coin.
    """
    order = Window.partitionBy("metric").orderBy(
        F.desc_nulls_last("pctl"), F.desc_nulls_last(F.abs("value")), "scope"
    )
    return (
        pctl.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("metric", "rank", "scope", "pctl", "value", "n")
    )


def display(pctl: DataFrame, coverage: DataFrame) -> DataFrame:
    """What may be shown: too few points hide the value, few hide the percentage."""
    joined = pctl.join(
        coverage.select("scope", "metric", "days_available", "enough"), ["scope", "metric"], "left"
    )
    n = F.coalesce("n", F.lit(0))
    enough = F.coalesce("enough", F.lit(False))
    return joined.select(
        "scope",
        "metric",
        "n",
        F.when(n >= HIDE_VALUE_BELOW, F.col("value")).alias("shown_value"),
        F.when((n >= HIDE_PERCENT_BELOW) & enough, F.col("pctl")).alias("shown_pctl"),
        F.when(
            ~enough,
            F.concat(
                F.lit("accumulating, "),
                F.coalesce("days_available", F.lit(0)).cast("string"),
                F.lit(" days"),
            ),
        ).alias("note"),
    )


def daily_digest(
    pctl: DataFrame, market_line: DataFrame, liquidations: DataFrame, as_of_ms: int, k: int = 3
) -> DataFrame:
    """Most unusual series, widest divergence, one market line, and the largest liquidations of the
    UTC day up to ``as_of_ms``."""
    day_ms = as_of_ms - as_of_ms % 86_400_000
    today = liquidations.filter((F.col("ts_ms") >= day_ms) & (F.col("ts_ms") <= as_of_ms))
    columns = ("block", "rank", "scope", "metric", "value", "pctl", "n")
    ranked = pctl.filter(F.col("pctl").isNotNull())
    extremity = F.abs(F.col("pctl") - 0.5)
    unusual = _top(ranked, "unusual", k, F.desc(extremity), F.asc("scope"), F.asc("metric"))
    spread = ranked.filter((F.col("metric") == "mark_spread_bps"))
    widest = _top(spread, "divergence", k, F.desc("pctl"), F.desc(F.abs("value")), F.asc("scope"))
    line = market_line.select(
        F.lit("market").alias("block"), F.lit(1).alias("rank"), "scope", "metric", "value",
        F.when(F.col("n") >= HIDE_PERCENT_BELOW, F.col("pctl")).alias("pctl"), "n",
    )
    largest = _top(
        today.filter(F.col("notional_usd").isNotNull()).select(
            C.scope(F.col("venue"), F.col("symbol")).alias("scope"),
            F.lit("observed_lower_bound_usd").alias("metric"),
            F.col("notional_usd").cast("double").alias("value"),
            F.lit(None).cast("double").alias("pctl"),
            F.lit(1).cast("bigint").alias("n"),
            "event_id",
        ),
        "liquidations", k, F.desc("value"), F.asc("scope"), F.asc("event_id"),
    )
    return (
        unusual.select(*columns)
        .unionByName(widest.select(*columns))
        .unionByName(line.select(*columns))
        .unionByName(largest.select(*columns))
    )


def liquidation_list(liquidations: DataFrame, at_least_usd: float) -> DataFrame:
    """Rows of one display tier; a row with an unknown notional is on no list."""
    return liquidations.filter(F.col("notional_usd") >= at_least_usd)


def pushes(liquidations: DataFrame, at_least_usd: float, merge_ms: int = 300_000) -> DataFrame:
    """Large liquidations merged to one message per five-minute window."""
    return (
        liquidation_list(liquidations, at_least_usd)
        .groupBy("venue", C.floor_ms(F.col("ts_ms"), merge_ms).alias("window_ms"))
        .agg(
            F.count("*").alias("events"),
            F.sum("notional_usd").alias("observed_lower_bound_usd"),
            F.max("notional_usd").alias("largest_usd"),
        )
    )


def look_back(
    points: DataFrame, liquidations: DataFrame, as_of_ms: int, hours: int, window_days: int = 30
) -> DataFrame:
    """From where to where each series moved, and what was liquidated meanwhile."""
    start_ms = as_of_ms - hours * 3_600_000
    ends = [
        D.percentiles(points, F.timestamp_millis(F.lit(at)), window_days).select(
            "scope", "metric", F.col("pctl").alias(f"{name}_pctl"), F.col("n").alias(f"{name}_n")
        )
        for name, at in (("start", start_ms), ("end", as_of_ms))
    ]
    observed = (
        liquidations.filter((F.col("ts_ms") > start_ms) & (F.col("ts_ms") <= as_of_ms))
        .groupBy("symbol")
        .agg(F.sum("notional_usd").cast("double").alias("observed_lower_bound_usd"))
    )
    return (
        ends[0]
        .join(ends[1], ["scope", "metric"], "full_outer")
        .withColumn("symbol", C.scope_symbol(F.col("scope")))
        .join(observed, "symbol", "left")
        .withColumn("change", F.col("end_pctl") - F.col("start_pctl"))
        .drop("symbol")
    )


# -- monitoring ----------------------------------------------------------------------
def daily_green_rate(status: DataFrame, green: float = 0.95, yellow: float = 0.8) -> DataFrame:
    """One cell per (venue, day): the share of minutes in which nothing was missing."""
    minute = status.groupBy("venue", "minute_ms").agg(
        F.bool_and(F.col("present") >= F.col("expected")).alias("complete")
    )
    rate = F.col("complete_minutes") / F.col("minutes")
    return (
        minute.groupBy("venue", C.floor_ms(F.col("minute_ms"), DAY_MS).alias("day_ms"))
        .agg(F.count("*").alias("minutes"), F.count_if("complete").alias("complete_minutes"))
        .withColumn("rate", rate)
        .withColumn(
            "cell", F.when(rate >= green, "green").when(rate >= yellow, "yellow").otherwise("red")
        )
    )


def rejects(log: DataFrame, as_of_ms: Column, days: int = 7) -> DataFrame:
    return (
        log.filter(
            F.col("status").isin(418, 429)
            & (F.col("at_ms") > as_of_ms - days * DAY_MS)
            & (F.col("at_ms") <= as_of_ms)
        )
        .groupBy("venue", "bucket", "status")
        .agg(F.count("*").alias("rejects"))
    )


def gap_trend(gaps: DataFrame) -> DataFrame:
    return gaps.groupBy("venue", "metric", C.floor_ms(F.col("from_ms"), DAY_MS).alias("day_ms")).agg(
        F.count("*").alias("gaps"), F.sum("minutes").cast("bigint").alias("minutes")
    )


# -- studies -------------------------------------------------------------------------
def settlement_spread(settled: DataFrame, grid_ms: int = EIGHT_HOURS_MS) -> DataFrame:
    """Two venues' 8-hour rates on common settlement instants."""
    on_grid = settled.filter(F.pmod(F.col("ts_ms"), F.lit(grid_ms)) == 0)
    first = on_grid.filter(F.col("venue") == D.FIRST).select("symbol", "ts_ms", F.col("rate_8h").alias("a"))
    second = on_grid.filter(F.col("venue") == D.SECOND).select("symbol", "ts_ms", F.col("rate_8h").alias("b"))
    return first.join(second, ["symbol", "ts_ms"]).select(
        "symbol", "ts_ms", (F.col("a") - F.col("b")).alias("spread")
    )


def study_outcomes(spread: DataFrame, threshold: float, horizon_ms: int = DAY_MS) -> DataFrame:
    """Events beyond the threshold and where the same coin stands a horizon later."""
    def group(value: Column) -> Column:
        return F.when(value >= threshold, "high").when(value <= -threshold, "low")

    later = spread.select(
        "symbol", (F.col("ts_ms") - horizon_ms).alias("ts_ms"), F.col("spread").alias("later")
    )
    return (
        spread.withColumn("grp", group(F.col("spread")))
        .filter(F.col("grp").isNotNull())
        .join(later, ["symbol", "ts_ms"], "left")
        .select(
            "symbol",
            "ts_ms",
            "grp",
            (F.col("later") - F.col("spread")).alias("change"),
            F.when(F.col("later").isNotNull(), F.coalesce(group(F.col("later")) == F.col("grp"), F.lit(False))).alias("still"),
        )
    )


def event_study(outcomes: DataFrame) -> DataFrame:
    counts = outcomes.groupBy("grp").agg(
        F.count("*").alias("n"),
        F.count("still").alias("n_with_outcome"),
        F.avg(F.col("still").cast("int")).alias("share_still"),
    )
    medians = exact_quantiles(outcomes, ["grp"], "change", {"median_change": 0.5}).drop("n")
    return counts.join(medians, "grp", "left")


def wilson(successes: Column, n: Column) -> tuple[Column, Column]:
    """Wilson 95 % interval of a share."""
    p = successes / n
    z2 = Z95 * Z95
    centre = p + z2 / (2 * n)
    half = F.sqrt(p * (1 - p) / n + z2 / (4 * n * n)) * Z95
    return (centre - half) / (1 + z2 / n), (centre + half) / (1 + z2 / n)


def scoreboard(outcomes: DataFrame) -> DataFrame:
    """Share still in the group per group, with its interval; small n shows counts only."""
    counted = outcomes.filter(F.col("still").isNotNull()).groupBy("grp").agg(
        F.count("*").alias("n"), F.count_if("still").alias("still")
    )
    low, high = wilson(F.col("still"), F.col("n"))
    shown = F.col("n") >= HIDE_PERCENT_BELOW
    return counted.select(
        "grp",
        "n",
        "still",
        F.when(shown, F.col("still") / F.col("n")).alias("share"),
        F.when(shown, low).alias("low"),
        F.when(shown, high).alias("high"),
    )


def benjamini_hochberg(tests: DataFrame, q: float = 0.05, rows_a_slice: int = ROWS_A_SLICE) -> DataFrame:
    """Adjusted p-values per family: p * m / rank, made monotone from the tail.

    Of equal p-values the last rank gives the smallest figure, and the tail minimum gives it to
    all of them. So both running values go over distinct p-values, in slices of about equal
    size; a mass of p = 1 is one row there. Ranks among equal ones are counted in slices of their own.
    """
    counted = tests.groupBy("family", "p").agg(F.count("*").alias("ties"))
    sizes = counted.groupBy("family").agg(F.sum("ties").alias("m"))
    dealt = sliced(counted, ["family"], F.col("p"), rows_a_slice)
    upto = running(dealt, ["family"], ["p"], F.col("ties"), "upto", how="sum", chunk=F.col("_slice"))
    raw = upto.join(sizes, "family").select(
        "*", (F.col("p") * F.col("m") / F.col("upto")).alias("raw"), (-F.col("p")).alias("descending")
    )
    lowest = running(raw, ["family"], ["descending"], -F.col("raw"), "negated", how="max", chunk=-F.col("_slice"))
    adjusted = lowest.select(
        "family", "p", (F.col("upto") - F.col("ties")).alias("before"), F.least(F.lit(1.0), -F.col("negated")).alias("p_adjusted")
    )
    ranked = tie_ranks(tests, ["family", "p"], "test_id", "among", rows_a_slice)
    return ranked.join(adjusted, ["family", "p"]).select(
        "family",
        "test_id",
        "p",
        (F.col("before") + F.col("among")).alias("rank"),
        "p_adjusted",
        (F.col("p_adjusted") <= q).alias("significant"),
    )


def poisson_thresholds(bits: int = 24) -> list[int]:
    """Where a uniform number of so many bits counts one more, for the Poisson law of mean one."""
    out, total, term = [], 0.0, math.exp(-1)
    for k in range(1, 12):
        total += term
        out.append(math.ceil(total * (1 << bits)))
        term /= k
    return [t for t in out if t < 1 << bits]


def block_bootstrap(
    spark: SparkSession, series: DataFrame, block: int, replicates: int, seed: int = 1
) -> DataFrame:
    """Percentile interval of a group's mean from resampled blocks.

    ``series`` is (grp, i, value) with i counting from 0. Blocks are reduced to
    (sum, count) first. In each replicate a block counts as often as a Poisson number of
    mean one says, drawn from a digest of (seed, group, replicate, block): draws are
    independent, blocks that do not exist are never drawn, and all replicates are summed in
    one aggregation that combines before its shuffle.
    """
    blocks = series.groupBy("grp", F.floor(F.col("i") / block).cast("bigint").alias("b")).agg(
        F.sum("value").alias("s"), F.count("*").alias("c")
    )
    drawn = blocks.select("*", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("r"))
    named = F.concat_ws("|", F.lit(seed).cast("string"), "grp", F.col("r").cast("string"), F.col("b").cast("string"))
    uniform = F.conv(F.substring(F.md5(named.cast("binary")), 1, 6), 16, 10).cast("bigint")
    weight = sum((uniform >= t).cast("int") for t in poisson_thresholds())
    means = (
        drawn.withColumn("w", weight)
        .where("w > 0")
        .groupBy("grp", "r")
        .agg((F.sum(F.col("s") * F.col("w")) / F.sum(F.col("c") * F.col("w"))).alias("mean"))
    )
    return means.groupBy("grp").agg(
        F.count("*").alias("replicates"),
        F.percentile("mean", F.lit(0.025)).alias("low"),
        F.percentile("mean", F.lit(0.975)).alias("high"),
    )


def state_episodes(points: DataFrame, min_minutes: int, level: float = 0.95) -> DataFrame:
    """Runs of at least ``min_minutes`` with the metric above its own P95."""
    key = ["scope", "metric"]
    limits = exact_quantiles(points, key, "value", {"limit": level})
    above = (
        points.join(limits, key)
        .filter(F.col("value") > F.col("limit"))
        .select(*key, F.unix_millis("ts").alias("minute_ms"))
    )
    runs = islands(above, key, "minute_ms")
    return (
        runs.groupBy(*key, F.col("island_ms").alias("from_ms"))
        .agg(F.count("*").alias("minutes"))
        .filter(F.col("minutes") >= min_minutes)
    )


# -- alerts --------------------------------------------------------------------------
def cooled_down(candidates: DataFrame, cooldown_ms: int = 1_800_000) -> DataFrame:
    """Candidates that are sent: the same rule at most once per cooldown.

    A candidate at least a cooldown after the one before it is always sent, so the
    candidates fall into independent runs; only inside a run does one choice hang
    on the last. A run has at most one candidate per minute.
    """
    minutes = candidates.select("rule", C.floor_ms(F.col("at_ms"), 60_000).alias("at_ms")).distinct()
    prior = running(
        minutes, ["rule"], ["at_ms"], F.col("at_ms"), "before_ms", inclusive=False
    )
    opens = F.when(
        F.col("before_ms").isNull() | (F.col("at_ms") - F.col("before_ms") >= cooldown_ms),
        F.col("at_ms"),
    )
    runs = running(prior, ["rule"], ["at_ms"], opens, "run_ms").select("rule", "run_ms", "at_ms")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            sent = []
            for at, run in zip(batch["at_ms"].to_pylist(), batch["run_ms"].to_pylist(), strict=True):
                # The first minute of a run is its name; a minute that is unknown is a run.
                take = at is None or at == run or at - last >= cooldown_ms
                sent.append(take)
                last = at if take else last
            yield batch.select(["rule", "at_ms"]).filter(pa.array(sent, pa.bool_()))

    # Runs lie one behind the other in a task, which holds a batch of them and one instant.
    ordered = runs.repartition("rule", "run_ms").sortWithinPartitions("rule", "run_ms", "at_ms")
    return ordered.mapInArrow(walk, "rule string, at_ms bigint")


def crossing_candidates(
    pctl_by_minute: DataFrame, rules: DataFrame
) -> DataFrame:
    """Minutes in which a rule's percentile condition holds.

    ``rules`` is (rule, scope, metric, above, below): above or below a level.
    """
    met = F.coalesce(F.col("pctl") >= F.col("above"), F.lit(False)) | F.coalesce(
        F.col("pctl") <= F.col("below"), F.lit(False)
    )
    return pctl_by_minute.join(rules, ["scope", "metric"]).filter(met).select("rule", "at_ms")
