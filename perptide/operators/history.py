"""Slowly changing rows, membership spells, claims, cursors and latest-only tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perptide.operators.carry import running


def _state(names: Sequence[str]) -> Column:
    return F.struct(*names)


def scd2_history(
    snapshots: DataFrame,
    key: Sequence[str],
    attributes: Sequence[str],
    clock: Sequence[str],
    at: str = "ts",
    instants: DataFrame | None = None,
) -> DataFrame:
    """Versions with ``valid_from``/``valid_to`` out of a series of full snapshots.

    A snapshot instant is one that any row of the same ``clock`` columns has, or one
    of ``instants`` (clock columns and ``at``) where that is given. A key
    missing at an instant closes its version there; a changed attribute closes one
    and opens the next. Neighbouring snapshots meet in equality joins on the
    instant, so no task has to sort one contract's whole history.
    """
    key, clock = list(key), list(clock)
    ms = F.unix_millis(at)
    points = snapshots.select(*key, ms.alias("_ms"), _state(attributes).alias("_now"))
    by_clock = Window.partitionBy(*clock).orderBy("_ms")
    instants = (
        (snapshots if instants is None else instants)
        .select(*clock, ms.alias("_ms"))
        .distinct()
        .select(
            *clock,
            "_ms",
            F.lag("_ms").over(by_clock).alias("_prev_ms"),
            F.lead("_ms").over(by_clock).alias("_next_ms"),
        )
    )
    neighbours = points.join(instants, [*clock, "_ms"])
    before = points.select(*key, F.col("_ms").alias("_prev_ms"), F.col("_now").alias("_before"))
    after = points.select(*key, F.col("_ms").alias("_next_ms"), F.col("_now").alias("_after"))
    marked = neighbours.join(before, [*key, "_prev_ms"], "left").join(
        after, [*key, "_next_ms"], "left"
    )
    # A present snapshot row has a non-NULL state, so an absent neighbour differs.
    opens = F.when(~F.col("_before").eqNullSafe(F.col("_now")), F.col("_ms"))
    opened = running(marked, key, ["_ms"], opens, "_from_ms")
    return opened.filter(~F.col("_after").eqNullSafe(F.col("_now"))).select(
        *key,
        F.timestamp_millis("_from_ms").alias("valid_from"),
        F.timestamp_millis("_next_ms").alias("valid_to"),
        *[F.col(f"_now.{a}").alias(a) for a in attributes],
    )


def scd2_apply(
    versions: DataFrame,
    snapshot: DataFrame,
    key: Sequence[str],
    attributes: Sequence[str],
    at: Column,
) -> DataFrame:
    """Apply one full snapshot taken at ``at`` to the open versions.

    Changed or vanished keys are closed, new or changed ones are opened.
    """
    key = list(key)
    closed = versions.filter(F.col("valid_to").isNotNull())
    standing = versions.filter(F.col("valid_to").isNull())
    incoming = snapshot.select(*key, _state(attributes).alias("_new"))
    both = standing.select(
        *key, "valid_from", _state(attributes).alias("_old")
    ).join(incoming, key, "full_outer")
    same = F.col("_old").eqNullSafe(F.col("_new"))
    kept = both.filter(F.col("_old").isNotNull()).select(
        *key,
        "valid_from",
        F.when(~same, at).alias("valid_to"),
        *[F.col(f"_old.{a}").alias(a) for a in attributes],
    )
    opened = both.filter(F.col("_new").isNotNull() & ~same).select(
        *key,
        at.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        *[F.col(f"_new.{a}").alias(a) for a in attributes],
    )
    columns = [*key, "valid_from", "valid_to", *attributes]
    return closed.select(*columns).unionByName(kept).unionByName(opened)


def membership_spells(
    memberships: DataFrame, key: Sequence[str] = ("symbol",), at: str = "ts"
) -> DataFrame:
    """Spells on the list out of (key, at, listed, reason) reconciliation records.

    ``listed`` true with no open spell opens one, false closes the open one. The
    last state before a record is the largest earlier ``2 * instant + listed``.
    """
    key = list(key)
    records = memberships.withColumn("_ms", F.unix_millis(at))
    coded = F.col("_ms") * 2 + F.col("listed").cast("int")
    stated = running(records, key, ["_ms"], coded, "_last", inclusive=False)
    was = F.coalesce(F.pmod(F.col("_last"), F.lit(2)) == 1, F.lit(False))
    changes = stated.withColumn("_was", was).filter(F.col("listed") != F.col("_was"))
    opened = running(changes, key, ["_ms"], F.when(F.col("listed"), F.col("_ms")), "_open_ms")
    starts = opened.filter("listed").select(*key, "_open_ms", F.col("reason").alias("_in_reason"))
    ends = opened.filter(~F.col("listed")).select(
        *key, "_open_ms", F.col("_ms").alias("_end_ms"), F.col("reason").alias("_out_reason")
    )
    return starts.join(ends, [*key, "_open_ms"], "left").select(
        *key,
        F.timestamp_millis("_open_ms").alias("in_from"),
        F.timestamp_millis("_end_ms").alias("in_to"),
        F.coalesce("_out_reason", "_in_reason").alias("reason"),
    )


def latest_by(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per key, the one that comes last in ``order``."""
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    rank = F.struct(*order) if len(order) > 1 else F.col(order[0])
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), rank).alias("_r")).select(*key, "_r.*")


def two_writer_row(
    observations: DataFrame,
    verdicts: DataFrame,
    key: Sequence[str],
    observed_order: str,
    verdict_order: str,
) -> DataFrame:
    """Join two writers' latest rows; neither touches the other's columns."""
    return latest_by(observations, key, [observed_order]).join(
        latest_by(verdicts, key, [verdict_order]), list(key), "full_outer"
    )


def claim(log: DataFrame, requests: DataFrame) -> DataFrame:
    """Insert requests whose (kind, dedupe_key) is not yet claimed, unresolved."""
    first = requests.groupBy("kind", "dedupe_key").agg(
        F.min_by(F.struct("target", "source", "ingest_ts"), "ingest_ts").alias("r")
    ).select("kind", "dedupe_key", "r.*")
    fresh = first.join(log, ["kind", "dedupe_key"], "left_anti")
    return log.unionByName(
        fresh.withColumn("ok", F.lit(None).cast("boolean")).withColumn(
            "sent_at", F.lit(None).cast("timestamp")
        )
    )


def resolve_claims(log: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Settle unresolved claims with the first outcome; settled rows stay."""
    settled = outcomes.groupBy("kind", "dedupe_key").agg(
        F.min_by("ok", "sent_at").alias("_ok"), F.min("sent_at").alias("_sent_at")
    )
    pending = F.col("ok").isNull()
    return (
        log.join(settled, ["kind", "dedupe_key"], "left")
        .withColumn("sent_at", F.when(pending, F.col("_sent_at")).otherwise(F.col("sent_at")))
        .withColumn("ok", F.when(pending, F.col("_ok")).otherwise(F.col("ok")))
        .drop("_ok", "_sent_at")
    )


def cursors(progress: DataFrame) -> DataFrame:
    """Furthest point per (job, venue, symbol, metric) and whether it is done."""
    return progress.groupBy("job", "venue", "symbol", "metric").agg(
        F.max("cursor_ts").alias("cursor_ts"), F.bool_or("done").alias("done")
    )
