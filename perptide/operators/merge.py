"""The three guarded upserts of the minute table, and their replay in bulk.

``upsert_fast``, ``upsert_slow`` and ``upsert_backfill`` apply one staged batch to
a target. ``replay`` folds a whole ordered log of batches at once. The fold has a
closed form, so it needs aggregates with map-side combine and no ordered per-key
lists:

* The first live statement of a minute always applies, and from then on no
  backfill does.
* Within a live lane the last statement to apply is the one with the largest
  observation instant, the earliest batch winning a tie. The lane that did not
  turn the row live must also beat the observation instant that backfill left.
* The shared columns belong to whichever lane winner came later in the log.
* A backfill applies while no earlier backfill of that minute had a finer grid
  and no live statement came before it. Each payload column is the last non-NULL
  one among those that applied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perptide import schemas as S
from perptide.functions import scalars as C
from perptide.operators.asof import with_oi_usd

KEY = ["venue", "symbol", "ts"]
FAST = ["mark", "index_px", "premium", "funding_rate", "funding_interval_h", "next_funding_ts"]
SLOW = ["oi_base", "vol24h_usd", "chg24h_pct"]
SHARED = ["semantic", "grid_s", "source", "ingest_ts"]
LIVE_GRID_S = 60
COLUMNS = list(S.MARKET_1M)
ORDER_OF_STATEMENTS = {"fast": 0, "slow": 1}


def staged(records: DataFrame) -> DataFrame:
    """Check a batch against the staging rules; one bad row rejects the batch."""
    required = ["venue", "symbol", "ts_ms", "ingest_ts_ms", "source", "semantic", "backfilled"]
    sound = F.col("oi_usd").isNull()
    for name in required:
        sound = sound & F.col(name).isNotNull()
    return S.conform(records, S.STAGE).filter(
        F.when(sound, F.lit(True)).otherwise(
            F.raise_error(F.lit("staged row breaks the staging rules")).cast("boolean")
        )
    )


def bucketed(stage: DataFrame, *extra: str) -> DataFrame:
    """Staged records in the minute table's columns; the bucket is taken here only."""
    return S.conform(
        stage.select(
            *[c for c in stage.columns if c not in ("oi_usd",)],
            C.minute(C.epoch_ms(F.col("ts_ms"))).alias("ts"),
            C.epoch_ms(F.col("obs_ts_fast_ms")).alias("obs_ts_fast"),
            C.epoch_ms(F.col("obs_ts_slow_ms")).alias("obs_ts_slow"),
            C.epoch_ms(F.col("next_funding_ts_ms")).alias("next_funding_ts"),
            C.epoch_ms(F.col("ingest_ts_ms")).alias("ingest_ts"),
        ),
        {**S.MARKET_1M, **{name: "bigint" for name in extra}},
    )


def empty_target(spark) -> DataFrame:
    return spark.createDataFrame([], S.ddl(S.MARKET_1M))


# -- one batch at a time -----------------------------------------------------------
def _is_live(lane: str) -> Column:
    return ~F.col("backfilled") & F.col(f"obs_ts_{lane}").isNotNull()


def _is_backfill() -> Column:
    return (
        F.col("backfilled")
        & F.col("grid_s").isNotNull()
        & (F.col("obs_ts_fast").isNotNull() | F.col("obs_ts_slow").isNotNull())
    )


def _unpack(grouped: DataFrame, *extra: str) -> DataFrame:
    return grouped.select(*KEY, *extra, "r.*")


def latest_live(rows: DataFrame, lane: str) -> DataFrame:
    """One row per minute: the newest observation of the lane, NULLs included."""
    obs = f"obs_ts_{lane}"
    payload = [*(FAST if lane == "fast" else SLOW), *SHARED, obs]
    return _unpack(
        rows.filter(_is_live(lane))
        .withColumn("grid_s", F.coalesce("grid_s", F.lit(LIVE_GRID_S)))
        .groupBy(*KEY)
        .agg(F.max_by(F.struct(*payload), F.struct(obs, "ingest_ts", "source")).alias("r"))
    )


def _backfill_rank() -> Column:
    newest = F.coalesce("obs_ts_fast", "obs_ts_slow")
    return F.struct(
        "grid_s",
        (-F.unix_micros(newest)).alias("o"),
        (-F.unix_micros("ingest_ts")).alias("i"),
        "source",
    )


def best_backfill(rows: DataFrame, *extra_key: str) -> DataFrame:
    """One backfill row per minute: the finest grid first, then the newest."""
    payload = [*FAST, *SLOW, *SHARED, "obs_ts_fast", "obs_ts_slow"]
    return _unpack(
        rows.filter(_is_backfill())
        .groupBy(*KEY, *extra_key)
        .agg(F.min_by(F.struct(*payload, *[c for c in ("stored",) if c in rows.columns]), _backfill_rank()).alias("r")),
        *extra_key,
    )


def _joined(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Target and batch side by side: columns keep their name, batch ones get ``n_``."""
    incoming = batch.select(
        *KEY,
        *[F.col(c).alias(f"n_{c}") for c in batch.columns if c not in KEY],
        F.lit(True).alias("n_present"),
    )
    existing = target.select(*COLUMNS, F.lit(True).alias("present"))
    return existing.join(incoming, KEY, "full_outer").withColumn(
        "absent", F.col("present").isNull()
    )


def _upsert_live(target: DataFrame, stage: DataFrame, segments: DataFrame, lane: str) -> DataFrame:
    obs = f"obs_ts_{lane}"
    side_by_side = _joined(target, latest_live(bucketed(stage), lane))
    guard = F.col("n_present").isNotNull() & (
        F.col("absent")
        | F.col(obs).isNull()
        | (F.col(f"n_{obs}") > F.col(obs))
        | F.col("backfilled")
    )
    written = {*(FAST if lane == "fast" else SLOW), *SHARED, obs}
    flagged = side_by_side.withColumn("applied", guard)
    merged = flagged.select(
        *KEY,
        *[
            F.when(F.col("applied"), F.col(f"n_{c}")).otherwise(F.col(c)).alias(c)
            for c in COLUMNS
            if c in written
        ],
        *[c for c in COLUMNS if c not in written and c not in (*KEY, "backfilled")],
        F.when(F.col("applied"), F.lit(False)).otherwise(F.col("backfilled")).alias("backfilled"),
        "applied",
    )
    return _revalued(merged, segments)


def _revalued(merged: DataFrame, segments: DataFrame) -> DataFrame:
    """Recompute ``oi_usd`` where a statement applied, leave it alone elsewhere."""
    fresh = with_oi_usd(merged.withColumnRenamed("oi_usd", "old_oi_usd"), segments)
    return S.conform(
        fresh,
        {**S.MARKET_1M, "applied": "boolean"},
        oi_usd=F.when(F.col("applied"), F.col("oi_usd")).otherwise(F.col("old_oi_usd")),
    )


def upsert_fast(target: DataFrame, stage: DataFrame, segments: DataFrame) -> DataFrame:
    """Target after the fast-lane statement; ``applied`` marks the rows it wrote."""
    return _upsert_live(target, stage, segments, "fast")


def upsert_slow(target: DataFrame, stage: DataFrame, segments: DataFrame) -> DataFrame:
    return _upsert_live(target, stage, segments, "slow")


def upsert_backfill(target: DataFrame, stage: DataFrame, segments: DataFrame) -> DataFrame:
    side_by_side = _joined(target, best_backfill(bucketed(stage)))
    guard = F.col("n_present").isNotNull() & (
        F.col("absent")
        | F.coalesce(F.col("backfilled") & (F.col("n_grid_s") <= F.col("grid_s")), F.lit(False))
    )
    filled = {*FAST, *SLOW, "obs_ts_fast", "obs_ts_slow"}
    flagged = side_by_side.withColumn("applied", guard)
    merged = flagged.select(
        *KEY,
        *[
            F.when(F.col("applied"), F.coalesce(F.col(f"n_{c}"), F.col(c)))
            .otherwise(F.col(c))
            .alias(c)
            for c in COLUMNS
            if c in filled
        ],
        *[
            F.when(F.col("applied"), F.col(f"n_{c}")).otherwise(F.col(c)).alias(c)
            for c in SHARED
        ],
        F.when(F.col("applied"), F.lit(True)).otherwise(F.col("backfilled")).alias("backfilled"),
        "oi_usd",
        "applied",
    )
    return _revalued(merged, segments)


# -- whole log at once ---------------------------------------------------------------
FACTS = [c for c in COLUMNS if c not in (*KEY, "oi_usd")]


def _stored_type() -> str:
    return "struct<" + ",".join(f"{c}:{S.MARKET_1M[c]}" for c in [*FACTS, "oi_usd"]) + ">"


def as_log(target: DataFrame) -> DataFrame:
    """A stored table as the batch before the first one; ``stored`` carries the row along.

    A live row is both lanes' observation at that point, a backfilled row is a
    backfill; replaying a table therefore gives the table back.
    """
    return target.select(
        *COLUMNS, F.lit(-1).cast("bigint").alias("batch_seq"), F.struct(*FACTS, "oi_usd").alias("stored")
    )


def replay(
    log: DataFrame, segments: DataFrame, target: DataFrame | None = None
) -> DataFrame:
    """The minute table after every batch of ``log`` in ``batch_seq`` order.

    ``log`` is staged records plus ``batch_seq``. Inside a batch the fast
    statement runs first, then the slow one, then the backfill one.

    Rows that no operation changed keep their stored ``oi_usd``: statements value what they write
    at the segments of their day, and a fold must not value the rest anew, or the table
    would depend on when it is compacted. The stored row travels through the
    aggregation, so the target is read and shuffled once.
    """
    ops = bucketed(log, "batch_seq").withColumn("stored", F.lit(None).cast(_stored_type()))
    if target is not None:
        ops = ops.unionByName(as_log(target))
    live = _live_winners(ops, kept="stored")
    base = _applied_backfill(ops)
    out = with_oi_usd(_settled(live.join(base, KEY, "full_outer"), kept="stored"), segments)
    if target is None:
        return out.select(*COLUMNS)
    unchanged = F.struct(*[F.col(f"stored.{c}").alias(c) for c in FACTS]) == F.struct(*FACTS)
    kept = F.when(F.col("stored").isNotNull() & unchanged, F.col("stored.oi_usd")).otherwise(F.col("oi_usd"))
    return out.withColumn("oi_usd", kept).select(*COLUMNS)


def replay_live(log: DataFrame, segments: DataFrame) -> DataFrame:
    """``replay`` for a log without backfill rows: one shuffle."""
    live = _live_winners(bucketed(log, "batch_seq"))
    no_base = live.select(
        "*", F.lit(None).cast(_base_type()).alias("base")
    )
    return with_oi_usd(_settled(no_base), segments).select(*COLUMNS)


def _base_type() -> str:
    kinds = {c: S.MARKET_1M[c] for c in [*FAST, *SLOW, *SHARED, "obs_ts_fast", "obs_ts_slow"]}
    return "struct<" + ",".join(f"{c}:{k}" for c, k in kinds.items()) + ">"


def _live_winners(ops: DataFrame, kept: str | None = None) -> DataFrame:
    """Winners of both lanes; a key has one row with ``kept`` at most, and it is passed on."""
    live = ops.filter(_is_live("fast") | _is_live("slow")).withColumn(
        "grid_s", F.coalesce("grid_s", F.lit(LIVE_GRID_S))
    )

    def winner(lane: str) -> Column:
        obs = f"obs_ts_{lane}"
        payload = [*(FAST if lane == "fast" else SLOW), *SHARED, obs, "batch_seq"]
        rank = F.when(
            F.col(obs).isNotNull(),
            F.struct(obs, (-F.col("batch_seq")).alias("b"), "ingest_ts", "source"),
        )
        return F.max_by(F.struct(*payload), rank).alias(lane)

    def first(lane: str) -> Column:
        at = F.col("batch_seq") * 2 + ORDER_OF_STATEMENTS[lane]
        return F.min(F.when(F.col(f"obs_ts_{lane}").isNotNull(), at)).alias(f"first_{lane}")

    passed = [F.first(kept, ignorenulls=True).alias(kept)] if kept else []
    return live.groupBy(*KEY).agg(winner("fast"), winner("slow"), first("fast"), first("slow"), *passed)


def _applied_backfill(ops: DataFrame) -> DataFrame:
    """(key, base): what the backfill statements left before the row turned live."""
    candidates = best_backfill(ops, "batch_seq")
    # A live statement closes a minute to backfill as a grid finer than any would.
    # Only coins and days that have backfill need looking at.
    span = ["venue", "symbol", "_day"]
    backfilled_days = (
        ops.filter(_is_backfill()).select("venue", "symbol", F.to_date("ts").alias("_day")).distinct()
    )
    live = (
        ops.filter(_is_live("fast") | _is_live("slow"))
        .select(*KEY, "batch_seq", F.to_date("ts").alias("_day"))
        .join(backfilled_days, span, "left_semi")
    )
    openings = candidates.select(*KEY, "grid_s", "batch_seq").unionByName(
        live.select(*KEY, F.lit(-1).alias("grid_s"), "batch_seq")
    )
    per_grid = openings.groupBy(*KEY, "grid_s").agg(F.min("batch_seq").alias("first_seq"))
    finer = Window.partitionBy(*KEY).orderBy("grid_s").rowsBetween(Window.unboundedPreceding, -1)
    limits = per_grid.select(*KEY, "grid_s", F.min("first_seq").over(finer).alias("closed_from"))
    applied = candidates.join(limits, [*KEY, "grid_s"]).filter(
        F.col("closed_from").isNull() | (F.col("batch_seq") < F.col("closed_from"))
    )

    def last_known(name: str) -> Column:
        return F.max_by(name, F.when(F.col(name).isNotNull(), F.col("batch_seq"))).alias(name)

    folded = applied.groupBy(*KEY).agg(
        *[last_known(c) for c in [*FAST, *SLOW, "obs_ts_fast", "obs_ts_slow"]],
        F.max_by(F.struct(*SHARED), "batch_seq").alias("s"),
        F.first("stored", ignorenulls=True).alias("base_stored"),
    )
    return folded.select(
        *KEY,
        "base_stored",
        F.struct(
            *FAST, *SLOW, *[F.col(f"s.{c}").alias(c) for c in SHARED], "obs_ts_fast", "obs_ts_slow"
        ).alias("base"),
    )


def _settled(final: DataFrame, kept: str | None = None) -> DataFrame:
    fast, slow = F.col("fast"), F.col("slow")
    live = fast.isNotNull() | slow.isNotNull()
    fast_first = F.col("first_slow").isNull() | (F.col("first_fast") < F.col("first_slow"))
    fast_wins = fast.isNotNull() & (
        fast_first
        | F.col("base.obs_ts_fast").isNull()
        | (F.col("fast.obs_ts_fast") > F.col("base.obs_ts_fast"))
    )
    slow_wins = slow.isNotNull() & (
        F.coalesce(~fast_first, F.lit(True))
        | F.col("base.obs_ts_slow").isNull()
        | (F.col("slow.obs_ts_slow") > F.col("base.obs_ts_slow"))
    )
    flagged = final.withColumn("fw", F.coalesce(fast_wins, F.lit(False))).withColumn(
        "sw", F.coalesce(slow_wins, F.lit(False))
    )
    fast_is_later = F.col("fw") & (
        ~F.col("sw") | (F.col("fast.batch_seq") > F.col("slow.batch_seq"))
    )

    def shared(name: str) -> Column:
        return (
            F.when(fast_is_later, F.col(f"fast.{name}"))
            .when(F.col("sw"), F.col(f"slow.{name}"))
            .otherwise(F.col(f"base.{name}"))
            .alias(name)
        )

    return flagged.select(
        *KEY,
        *[
            F.when(F.col("fw"), F.col(f"fast.{c}")).otherwise(F.col(f"base.{c}")).alias(c)
            for c in [*FAST, "obs_ts_fast"]
        ],
        *[
            F.when(F.col("sw"), F.col(f"slow.{c}")).otherwise(F.col(f"base.{c}")).alias(c)
            for c in [*SLOW, "obs_ts_slow"]
        ],
        *[shared(c) for c in SHARED],
        (~live).alias("backfilled"),
        *([F.coalesce(kept, f"base_{kept}").alias(kept)] if kept else []),
    )
