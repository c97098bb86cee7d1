"""Queries over staging, the three upserts, replay and the as-of multiplier."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from perptide.operators import asof, merge
from perptide.functions import scalars as C
from perptide.plans import bridge
from perptide.plans import bridge_sql as B
from perptide.plans.registry import Registry
from perptide.session import checkpoint_dir
from perptide.sources.minute_store import MinuteStore
from perptide.plans.common import big, market_out, ms, r6, replayed, stage_out

query = Registry()

STAGE_OUT_SQL = f"""
SELECT venue, symbol, ts_ms, ingest_ms, source, semantic, {B.r6('mark', 'mark')},
  {B.r6('index_px', 'index_px')}, {B.r6('premium', 'premium')},
  {B.r6('funding_rate', 'funding_rate')}, {B.r6('oi_base', 'oi_base')},
  {B.r6('vol24h_usd', 'vol24h_usd')}, {B.r6('chg24h_pct', 'chg24h_pct')},
  CAST(funding_interval_h AS BIGINT) AS funding_interval_h, next_funding_ms, obs_fast_ms,
  obs_slow_ms, CAST(grid_s AS BIGINT) AS grid_s, backfilled FROM stg"""


@query("s4_staging_relation", B.with_ctes(B.EV, B.stage()) + STAGE_OUT_SQL)
def s4(spark, sf_dir):
    return stage_out(merge.staged(bridge.stage(spark, sf_dir)))


LATEST_SQL = B.with_ctes(B.EV, B.stage("raw_ms")) + """
SELECT venue, symbol, ts AS ts_ms, {obs} AS obs_ms, ingest_ms, source, {cols} FROM stg
WHERE NOT backfilled AND {obs} IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY venue, symbol, ts
  ORDER BY {obs} DESC, ingest_ms DESC, source DESC) = 1"""


@query(
    "a1_latest_per_minute_fast",
    LATEST_SQL.format(obs="obs_fast_ms", cols=B.r6("mark", "mark") + "," + B.r6("index_px", "index_px")),
)
def a1_fast(spark, sf_dir):
    rows = merge.latest_live(merge.bucketed(bridge.stage(spark, sf_dir, "raw_ms")), "fast")
    return rows.select(
        "venue", "symbol", ms("ts", "ts_ms"), ms("obs_ts_fast", "obs_ms"), ms("ingest_ts", "ingest_ms"),
        "source", r6("mark"), r6("index_px"),
    )


@query(
    "a1_latest_per_minute_slow",
    LATEST_SQL.format(obs="obs_slow_ms", cols=B.r6("oi_base", "oi_base") + "," + B.r6("chg24h_pct", "chg24h_pct")),
)
def a1_slow(spark, sf_dir):
    rows = merge.latest_live(merge.bucketed(bridge.stage(spark, sf_dir, "raw_ms")), "slow")
    return rows.select(
        "venue", "symbol", ms("ts", "ts_ms"), ms("obs_ts_slow", "obs_ms"), ms("ingest_ts", "ingest_ms"),
        "source", r6("oi_base"), r6("chg24h_pct"),
    )


@query(
    "a2_latest_per_minute_backfill",
    B.with_ctes(B.EV, B.stage()) + f"""
SELECT venue, symbol, ts AS ts_ms, CAST(grid_s AS BIGINT) AS grid_s, obs_fast_ms, obs_slow_ms,
  {B.r6('mark', 'mark')}, {B.r6('oi_base', 'oi_base')} FROM stg WHERE backfilled
QUALIFY row_number() OVER (PARTITION BY venue, symbol, ts
  ORDER BY grid_s, coalesce(obs_fast_ms, obs_slow_ms) DESC, ingest_ms DESC, source) = 1""",
)
def a2(spark, sf_dir):
    rows = merge.best_backfill(merge.bucketed(bridge.stage(spark, sf_dir)))
    return rows.select(
        "venue", "symbol", ms("ts", "ts_ms"), big("grid_s"), ms("obs_ts_fast", "obs_fast_ms"),
        ms("obs_ts_slow", "obs_slow_ms"), r6("mark"), r6("oi_base"),
    )


def _market_sql(seq="batch_seq", where="true", time="obs_ms"):
    return B.with_ctes(*B.market_ctes(seq, where, time)) + B.MARKET_OUT + "FROM market"


def _store(spark):
    return MinuteStore(spark, f"{checkpoint_dir(spark)}/store-{uuid.uuid4().hex}")


def _chain(spark, sf_dir):
    """The bridge log as three statements: all backfill, then the fast, then the slow lane."""
    stage, seg = bridge.stage(spark, sf_dir), bridge.segments(spark, sf_dir)
    return stage, seg, merge.upsert_backfill(merge.empty_target(spark), stage, seg).drop("applied")


CHAIN_SEQ = "CASE WHEN backfilled THEN 0 ELSE 1 END"


@query("u1_fast_upsert", _market_sql(CHAIN_SEQ, "backfilled OR obs_fast_ms IS NOT NULL"))
def u1(spark, sf_dir):
    stage, seg, target = _chain(spark, sf_dir)
    return market_out(merge.upsert_fast(target, stage, seg))


@query("u2_slow_upsert", _market_sql(CHAIN_SEQ))
def u2(spark, sf_dir):
    stage, seg, target = _chain(spark, sf_dir)
    fast = merge.upsert_fast(target, stage, seg).drop("applied")
    return market_out(merge.upsert_slow(fast, stage, seg))


@query("u3_backfill_upsert", _market_sql("event_id % 4", "backfilled"))
def u3(spark, sf_dir):
    """All backfill rows in four batches, one after another."""
    stage, seg = bridge.stage(spark, sf_dir), bridge.segments(spark, sf_dir)
    target = merge.empty_target(spark)
    for batch in range(4):
        part = stage.filter(F.col("event_id") % 4 == batch)
        target = merge.upsert_backfill(target, part, seg).drop("applied")
    return market_out(target)


@query("u1_u3_upserts_into_stored_months", _market_sql(CHAIN_SEQ, time="raw_ms"))
def u1_u3_store(spark, sf_dir):
    """The three statements one after another on a stored table; each rewrites the months it touches."""
    stage, seg, store = bridge.stage(spark, sf_dir, "raw_ms"), bridge.segments(spark, sf_dir), _store(spark)
    generation = None
    for statement in ("backfill", "fast", "slow"):
        generation = store.upsert(stage, seg, statement, generation)
    return market_out(store.base(generation))


@query("u4_compaction_by_months", _market_sql("late_seq // 7", time="raw_ms"))
def u4_store(spark, sf_dir):
    """Three batches in the log: one folded alone, one over it, the last read with the base."""
    stage, seg, store = bridge.stage(spark, sf_dir, "raw_ms"), bridge.segments(spark, sf_dir), _store(spark)
    for batch in range(3):
        store.append(stage.filter(F.floor(F.col("late_seq") / 7) == batch), batch)
    generation = None
    for upto in (0, 1):
        generation = store.compact(seg, upto, generation)
    return market_out(store.read(seg, generation))


@query("u4_replay_in_arrival_order", _market_sql())
def u4(spark, sf_dir):
    return market_out(replayed(spark, sf_dir))


@query("u4_replay_late_arrivals", _market_sql("late_seq"))
def u4_late(spark, sf_dir):
    log = bridge.stage(spark, sf_dir).withColumn("batch_seq", F.col("late_seq"))
    return market_out(merge.replay(log, bridge.segments(spark, sf_dir)))


@query("t4_out_of_order_guard_live_only", _market_sql("late_seq", "NOT backfilled"))
def u4_live(spark, sf_dir):
    log = bridge.stage(spark, sf_dir).filter("NOT backfilled").withColumn(
        "batch_seq", F.col("late_seq")
    )
    return market_out(merge.replay_live(log, bridge.segments(spark, sf_dir)))


@query(
    "u4_replay_over_stored_table",
    _market_sql("late_seq"),
)
def u4_target(spark, sf_dir):
    log = bridge.stage(spark, sf_dir).withColumn("batch_seq", F.col("late_seq"))
    seg = bridge.segments(spark, sf_dir)
    stored = merge.replay(log.filter("batch_seq < 10"), seg)
    return market_out(merge.replay(log.filter("batch_seq >= 10"), seg, target=stored))


@query(
    "j3_multiplier_as_of_minute",
    B.with_ctes(B.EV, B.INSTRUMENTS) + f""",
p AS (SELECT DISTINCT venue, symbol, obs_ms - obs_ms % 60000 - 43200000 * (event_id % 2) AS ts FROM ev)
SELECT venue, symbol, ts AS ts_ms, CAST({B.mult_at('p.ts', 'p')} AS BIGINT) AS mult FROM p""",
)
def j3(spark, sf_dir):
    at = C.floor_ms(F.col("obs_ms"), 60_000) - 43_200_000 * (F.col("event_id") % 2)
    probes = (
        bridge.events(spark, sf_dir)
        .select("venue", "symbol", F.timestamp_millis(at).alias("ts"))
        .distinct()
    )
    return asof.with_multiplier(probes, bridge.segments(spark, sf_dir)).select(
        "venue", "symbol", ms("ts", "ts_ms"), big("mult")
    )


@query(
    "c11_usd_open_interest",
    B.with_ctes(B.EV, B.INSTRUMENTS) + f"""
SELECT event_id, {B.r6("px * 100 * px / " + B.mult_at('e.obs_ms', 'e'), 'oi_usd')} FROM ev e""",
)
def c11(spark, sf_dir):
    rows = bridge.events(spark, sf_dir).select(
        "event_id", "venue", "symbol", F.timestamp_millis("obs_ms").alias("ts"),
        (F.col("px") * 100).cast("decimal(24,10)").alias("oi_base"), F.col("px").alias("mark"),
    )
    return asof.with_oi_usd(rows, bridge.segments(spark, sf_dir)).select("event_id", r6("oi_usd"))


@query(
    "latest_oi_and_funding_per_coin",
    B.with_ctes(*B.market_ctes()) + f"""
SELECT venue, symbol,
  arg_max(obs_slow_ms, ts) FILTER (obs_slow_ms IS NOT NULL) AS oi_obs_ms,
  {B.r6("arg_max(oi_usd, ts) FILTER (oi_usd IS NOT NULL)", 'oi_usd')},
  {B.r6("arg_max(CAST(funding_rate AS DOUBLE) * 8 / funding_interval_h, ts) FILTER (funding_rate IS NOT NULL)", 'funding_rate_8h')},
  count(*) AS minutes FROM market GROUP BY venue, symbol""",
)
def flagship(spark, sf_dir):
    """Latest USD open interest and 8-hour funding per venue and coin."""
    rows = replayed(spark, sf_dir).withColumn(
        "r8", C.funding_8h(F.col("funding_rate"), F.col("funding_interval_h"))
    )

    def latest(column):
        return F.max_by(column, F.when(F.col(column).isNotNull(), F.col("ts")))

    return rows.groupBy("venue", "symbol").agg(
        F.unix_millis(latest("obs_ts_slow")).alias("oi_obs_ms"),
        r6(latest("oi_usd"), "oi_usd"),
        r6(latest("r8"), "funding_rate_8h"),
        F.count("*").alias("minutes"),
    )
