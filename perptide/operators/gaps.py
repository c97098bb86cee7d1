"""Minute gaps, their causes, and availability."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perptide import schemas as S
from perptide.functions import scalars as C
from perptide.operators.carry import chunk_of, islands, merge_intervals, running

MINUTE_MS = 60_000

# Lower rank explains a minute first (ours: the whole machine before one source).
CAUSE_RANK = {cause: rank for rank, cause in enumerate((
    "power_loss",
    "host_restart",
    "egress_down",
    "egress_change",
    "ip_ban",
    "rate_limit",
    "ws_reconnect",
    "backpressure",
    "venue_error",
    "unknown",
))}


def minute_range(spark: SparkSession, from_ms: int, to_ms: int) -> DataFrame:
    """Every minute of [from_ms, to_ms), generated on the executors."""
    return spark.range(from_ms, to_ms, MINUTE_MS).select(F.col("id").alias("minute_ms"))


def expected_per_minute(
    spark: SparkSession, spells: DataFrame, from_ms: int, to_ms: int
) -> DataFrame:
    """Listed coins at every minute: a running total of joins and leaves.

    A coin counts at a minute when its spell covers the minute's start.
    """
    def first_minute_at_or_after(ts: str) -> F.Column:
        return F.greatest(
            -C.floor_ms(-F.unix_millis(ts), MINUTE_MS), F.lit(from_ms).cast("bigint")
        )

    joins = spells.select(first_minute_at_or_after("in_from").alias("minute_ms"), F.lit(1).alias("d"))
    leaves = spells.filter(F.col("in_to").isNotNull()).select(
        first_minute_at_or_after("in_to").alias("minute_ms"), F.lit(-1).alias("d")
    )
    steps = joins.unionByName(leaves).groupBy("minute_ms").agg(F.sum("d").alias("d"))
    lattice = (
        minute_range(spark, from_ms, to_ms)
        .join(steps, "minute_ms", "left")
        .withColumn("_all", F.lit(0))
    )
    return running(
        lattice, ["_all"], ["minute_ms"], F.coalesce("d", F.lit(0)), "expected", how="sum"
    ).select("minute_ms", "expected")


def among_listed(market: DataFrame, spells: DataFrame, from_ms: int, to_ms: int) -> DataFrame:
    """Minute rows of coins while they are in the universe; a coin outside it must not hide a missing one.

    Spells are laid out by day, so a minute meets the spells of its coin and day only.
    """
    start = F.greatest(F.unix_millis("in_from"), F.lit(from_ms).cast("bigint"))
    end = F.least(F.coalesce(F.unix_millis("in_to"), F.lit(to_ms).cast("bigint")), F.lit(to_ms).cast("bigint"))
    days = (
        spells.select(F.col("symbol").alias("_symbol"), start.alias("_from"), end.alias("_to"))
        .filter(F.col("_from") < F.col("_to"))
        .select("*", F.explode(F.sequence(chunk_of(F.col("_from")), chunk_of(F.col("_to") - 1))).alias("_of_day"))
    )
    ms = F.unix_millis("ts")
    inside = (
        (F.col("symbol") == F.col("_symbol"))
        & (chunk_of(ms) == F.col("_of_day"))
        & (ms >= F.col("_from"))
        & (ms < F.col("_to"))
    )
    return market.join(days, inside, "left_semi")


def present_per_minute(market: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Coins with a value, per (venue, minute, metric); one shuffle for all metrics."""
    counted = market.groupBy("venue", F.unix_millis("ts").alias("minute_ms")).agg(
        *[F.count_if(F.col(m).isNotNull()).alias(m) for m in metrics]
    )
    return counted.select(
        "venue",
        "minute_ms",
        F.inline(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("present")) for m in metrics])
        ),
    )


def minute_status(
    expected: DataFrame, market: DataFrame, metrics: Sequence[str]
) -> DataFrame:
    """(venue, metric, minute_ms, expected, present) over the whole lattice.

    ``market`` holds the rows that may count as present, see ``among_listed``.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(v).alias("venue"), F.lit(m).alias("metric"))
            for v in S.VENUES
            for m in metrics
        ]
    )
    lattice = expected.select("minute_ms", "expected", F.inline(pairs))
    return lattice.join(
        present_per_minute(market, metrics), ["venue", "metric", "minute_ms"], "left"
    ).withColumn("present", F.coalesce("present", F.lit(0)))


def gap_rows(status: DataFrame) -> DataFrame:
    """Consecutive deficient minutes of one (venue, metric) as one gap row."""
    deficient = status.filter(F.col("present") < F.col("expected"))
    labelled = islands(deficient, ["venue", "metric"], "minute_ms", MINUTE_MS)
    return labelled.groupBy("venue", "metric", F.col("island_ms").alias("from_ms")).agg(
        (F.max("minute_ms") + MINUTE_MS).alias("to_ms"),
        F.count("*").cast("int").alias("minutes"),
        F.max("expected").alias("symbols_expected"),
        F.min("present").alias("symbols_present"),
        F.lit("unknown").alias("cause"),
    )


def attribute_causes(gaps: DataFrame, causes: DataFrame) -> DataFrame:
    """Give each gap the strongest cause whose interval overlaps it.

    ``causes`` is (venue, from_ms, to_ms, cause); a NULL end is a cause that is still
    going on and reaches to the venue's last gap. A gap covers whole minutes, so an
    interval overlaps it exactly when it touches one of them: both sides meet in an
    equality join on the minute, after equal (venue, minute, cause) are united.
    """
    last = gaps.groupBy("venue").agg(F.max("to_ms").alias("last_ms"))
    causes = causes.join(last, "venue").select(
        "venue", "from_ms", F.coalesce("to_ms", "last_ms").alias("to_ms"), "cause"
    )
    ranks = F.create_map(*[F.lit(x) for pair in CAUSE_RANK.items() for x in pair])
    united = merge_intervals(
        causes.filter(F.col("to_ms") > F.col("from_ms")), ["venue", "cause"], "from_ms", "to_ms"
    )
    touched = united.select(
        "venue",
        F.col("cause").alias("found"),
        F.explode(
            F.sequence(
                C.floor_ms(F.col("span_from_ms"), MINUTE_MS),
                C.floor_ms(F.col("span_to_ms") - 1, MINUTE_MS),
                F.lit(MINUTE_MS).cast("bigint"),
            )
        ).alias("minute_ms"),
    ).distinct()
    hits = (
        gap_minutes(gaps, "from_ms")
        .join(touched, ["venue", "minute_ms"])
        .groupBy("venue", "metric", "from_ms")
        .agg(F.min_by("found", F.try_element_at(ranks, F.col("found"))).alias("found"))
    )
    return (
        gaps.join(hits, ["venue", "metric", "from_ms"], "left")
        .withColumn("cause", F.coalesce("found", "cause"))
        .drop("found")
    )


def gap_minutes(gaps: DataFrame, *extra: str) -> DataFrame:
    return gaps.select(
        "venue",
        "metric",
        "cause",
        *extra,
        F.explode(
            F.sequence("from_ms", F.col("to_ms") - MINUTE_MS, F.lit(MINUTE_MS).cast("bigint"))
        ).alias("minute_ms"),
    )


def availability(status: DataFrame, gaps: DataFrame) -> DataFrame:
    """Both measures per (venue, metric) over the minutes of ``status``.

    A leaves minutes of the four whole-machine causes out of the denominator. B
    keeps all of them and says which share of the missing ones a gap row explains.
    """
    covered = gap_minutes(gaps).groupBy("venue", "metric", "minute_ms").agg(
        F.bool_or(C.excluded_from_availability_a(F.col("cause"))).alias("excluded")
    )
    seen = status.join(covered, ["venue", "metric", "minute_ms"], "left")
    missing = F.col("present") < F.col("expected")
    out = F.coalesce("excluded", F.lit(False))
    return (
        seen.groupBy("venue", "metric")
        .agg(
            F.count("*").alias("minutes"),
            F.count_if(missing).alias("missing"),
            F.count_if(out).alias("excluded"),
            F.count_if(missing & ~out).alias("missing_in_a"),
            F.count_if(missing & F.col("excluded").isNotNull()).alias("explained"),
        )
        .withColumn("in_a", F.col("minutes") - F.col("excluded"))
        .select(
            "venue",
            "metric",
            "minutes",
            "missing",
            "excluded",
            F.when(F.col("in_a") > 0, 1 - F.col("missing_in_a") / F.col("in_a")).alias("availability_a"),
            (1 - F.col("missing") / F.col("minutes")).alias("availability_b"),
            F.when(F.col("missing") > 0, F.col("explained") / F.col("missing")).alias("explained_share"),
        )
    )
