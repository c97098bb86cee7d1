"""Request usage, budgets and throttling out of request and socket logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perptide.functions import scalars as C
from perptide.operators.carry import (
    DAY_MS,
    chunk_of,
    merge_intervals,
    running,
    trailing_sums,
)

# The log's priorities and the documented waits.
PRIORITIES = ("fast_lane", "resident", "opportunistic")
WINDOW_MS = 60_000
CONNECTION_WINDOW_MS = 300_000
FREEZE_MS = 3_600_000
BAN_WITHOUT_HEADER_MS = 3 * DAY_MS
NOTIFY_ON_429 = ("hyperliquid",)

# At most one row per millisecond and key reaches a ten-minute chunk.
CHUNK_MS = 600_000


def _running_total(df: DataFrame, keys: list[str], step: str, out: str) -> DataFrame:
    return running(
        df,
        keys,
        ["at_ms"],
        F.col(step),
        out,
        how="sum",
        chunk=chunk_of(F.col("at_ms"), CHUNK_MS),
    )


def rolling_spend(log: DataFrame) -> DataFrame:
    """Spend per bucket over (now - 60 s, now] at every instant of the log."""
    split = log.select(
        "venue",
        "bucket",
        "at_ms",
        F.col("cost").cast("bigint").alias("used"),
        *[
            F.when(F.col("priority") == p, F.col("cost")).otherwise(0).cast("bigint").alias(f"used_{p}")
            for p in PRIORITIES
        ],
    )
    return trailing_sums(
        split,
        ["venue", "bucket"],
        "at_ms",
        WINDOW_MS,
        ["used", *[f"used_{p}" for p in PRIORITIES]],
    )


def opportunistic_available(spend: DataFrame, budgets: DataFrame) -> DataFrame:
    """min(max(0, ceiling - max(reserve, resident use)), hard cap) at each instant."""
    resident = F.col("used_fast_lane") + F.col("used_resident")
    room = F.greatest(F.lit(0), F.col("ceiling") - F.greatest(F.col("reserve"), resident))
    return spend.join(budgets, ["venue", "bucket"]).select(
        "venue",
        "bucket",
        "at_ms",
        resident.alias("resident_used"),
        F.least(room, F.col("hard_cap")).alias("available"),
    )


def connection_usage(sockets: DataFrame, caps: DataFrame) -> DataFrame:
    """New connections over the trailing window, open connections and streams.

    One row per (venue, instant) of the socket log. Changes are summed per instant
    first and the running totals are carried across days.
    """
    opens = F.col("event") == "open"
    sign = F.when(opens, 1).otherwise(-1)
    changes = sockets.groupBy("venue", "at_ms").agg(
        F.count_if(opens).alias("opened"),
        F.sum(sign).alias("d_open"),
        F.sum(sign * F.col("streams")).alias("d_streams"),
    )
    recent = trailing_sums(
        changes.select("venue", "at_ms", "opened"),
        ["venue"],
        "at_ms",
        CONNECTION_WINDOW_MS,
        ["opened"],
    ).withColumnRenamed("opened", "opened_in_window")
    seats = _running_total(changes, ["venue"], "d_open", "open_connections")
    seats = _running_total(seats, ["venue"], "d_streams", "subscriptions")
    return (
        seats.join(recent, ["venue", "at_ms"])
        .join(caps, "venue", "left")
        .select(
            "venue",
            "at_ms",
            "opened_in_window",
            "open_connections",
            "subscriptions",
            (F.col("opened_in_window") > F.col("max_new_connections")).alias("rate_violated"),
            (F.col("open_connections") > F.col("max_connections")).alias("seats_violated"),
            (F.col("subscriptions") > F.col("max_subscriptions")).alias("streams_violated"),
        )
    )


def distinct_users(sockets: DataFrame) -> DataFrame:
    """Users holding at least one socket, per venue, at each instant.

    A user counts from the moment its open sockets rise above zero until they are
    back at zero.
    """
    sign = F.when(F.col("event") == "open", 1).otherwise(-1)
    per_user = sockets.groupBy("venue", "user", "at_ms").agg(F.sum(sign).alias("d"))
    held = _running_total(per_user, ["venue", "user"], "d", "held")
    before = F.col("held") - F.col("d")
    flips = held.select(
        "venue",
        "at_ms",
        ((F.col("held") > 0).cast("int") - (before > 0).cast("int")).alias("step"),
    )
    per_instant = flips.groupBy("venue", "at_ms").agg(F.sum("step").alias("step"))
    return _running_total(per_instant, ["venue"], "step", "distinct_users").select("venue", "at_ms", "distinct_users")


def reconcile_budgets(reservations: DataFrame, budgets: DataFrame) -> DataFrame:
    """Egress ceiling minus reservations is ours; then the verdict over worst cases."""
    measured = F.greatest("observed_max", "self_cap")
    asserted_zero = (
        measured.isNull() & (F.col("reserved") == 0) & F.coalesce("assertion", F.lit(False))
    )
    joined = budgets.join(reservations, ["venue", "bucket"], "left")
    held = F.col("consumer").isNotNull()
    per_bucket = joined.groupBy(
        "venue", "bucket", "egress_ceiling", "reserve", "hard_cap"
    ).agg(
        F.coalesce(F.sum("reserved"), F.lit(0)).alias("reserved"),
        F.coalesce(F.sum(F.coalesce(measured, "reserved")), F.lit(0)).alias("others_worst"),
        F.count_if(held & measured.isNull() & ~asserted_zero).alias("unmeasured"),
        F.count_if(
            (F.col("observed_max") > F.col("egress_ceiling"))
            | (F.col("self_cap") > F.col("egress_ceiling"))
        ).alias("crossings"),
    )
    ours = F.col("egress_ceiling") - F.col("reserved")
    together = F.col("others_worst") + F.col("reserve") + F.col("hard_cap")
    sound = F.when(ours >= 0, ours).otherwise(
        F.raise_error(
            F.concat_ws(":", F.lit("reservations above the egress ceiling"), "venue", "bucket")
        ).cast("bigint")
    )
    return per_bucket.select(
        "venue",
        "bucket",
        "reserved",
        sound.alias("our_ceiling"),
        "others_worst",
        together.alias("together"),
        F.when(F.col("crossings") > 0, "yellow")
        .when(F.col("unmeasured") > 0, "unknown")
        .when(together > F.col("egress_ceiling"), "yellow")
        .otherwise("green")
        .alias("verdict"),
    )


def usage_profile(log: DataFrame) -> DataFrame:
    """Exact p50, p95 and max of per-minute spend per bucket, idle minutes included.

    Minutes are counted per distinct spend first; the idle ones enter as one more
    spend of zero with its frequency.
    """
    key = ["venue", "bucket"]
    minutes = log.groupBy(*key, C.floor_ms(F.col("at_ms"), 60_000).alias("m")).agg(
        F.sum("cost").cast("bigint").alias("spend")
    )
    frequency = minutes.groupBy(*key, "spend").agg(
        F.count("*").alias("f"), F.min("m").alias("lo"), F.max("m").alias("hi")
    )
    idle = frequency.groupBy(*key).agg(
        ((F.max("hi") - F.min("lo")) / 60_000 + 1 - F.sum("f")).cast("bigint").alias("f")
    ).filter(F.col("f") > 0)
    return (
        frequency.select(*key, "spend", "f")
        .unionByName(idle.select(*key, F.lit(0).cast("bigint").alias("spend"), "f"))
        .groupBy(*key)
        .agg(
            F.percentile("spend", F.lit(0.5), F.col("f")).alias("p50"),
            F.percentile("spend", F.lit(0.95), F.col("f")).alias("p95"),
            F.max("spend").alias("max_spend"),
            F.sum("f").alias("minutes"),
        )
    )


def _ban_ms() -> Column:
    header = C.retry_after_seconds(F.col("retry_after"))
    return F.coalesce((header * 1000).cast("bigint"), F.lit(BAN_WITHOUT_HEADER_MS))


def throttle_events(log: DataFrame) -> DataFrame:
    """One row per 429 or 418 with how long it freezes and how long it halts."""
    banned = F.col("status") == 418
    until = F.col("at_ms") + _ban_ms()
    return (
        log.filter(F.col("status").isin(418, 429))
        .select(
            "venue",
            "bucket",
            "at_ms",
            F.when(banned, "ip_ban").otherwise("rate_limit").alias("cause"),
            F.when(banned, F.greatest(until, F.col("at_ms") + FREEZE_MS))
            .otherwise(F.col("at_ms") + FREEZE_MS)
            .alias("frozen_until_ms"),
            F.when(banned, until).alias("halted_until_ms"),
            F.when(~banned, C.limit_body_class(F.col("body"))).alias("body_class"),
            (banned | F.col("venue").isin(*NOTIFY_ON_429)).alias("notify"),
        )
    )


def throttle_intervals(log: DataFrame) -> DataFrame:
    """Maximal intervals per venue in which a tier stood still."""
    events = throttle_events(log)
    spans = events.select(
        "venue",
        "at_ms",
        F.inline(
            F.array(
                F.struct(F.lit("opportunistic").alias("tier"), F.col("frozen_until_ms").alias("to_ms")),
                F.struct(F.lit("all").alias("tier"), F.col("halted_until_ms").alias("to_ms")),
            )
        ),
    ).filter(F.col("to_ms").isNotNull())
    return merge_intervals(
        spans, ["venue", "tier"], "at_ms", "to_ms", F.count("*").alias("events")
    )


def throttle_gaps(log: DataFrame) -> DataFrame:
    """Gap rows owed by throttling, with whether a person must be told."""
    return throttle_events(log).select(
        "venue",
        "bucket",
        F.col("at_ms").alias("from_ms"),
        F.coalesce("halted_until_ms", "frozen_until_ms").alias("to_ms"),
        "cause",
        "notify",
    )
