"""Queries over divergence, percentiles, coverage, history tables and membership."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from perptide.operators import divergence as D
from perptide.operators import history as H
from perptide.operators import liquidations as L
from perptide.operators import merge
from perptide.plans import bridge
from perptide.plans import bridge_sql as B
from perptide.plans import payloads as P
from perptide.plans.common import big, market, ms, r6
from perptide.plans.registry import Registry
from perptide.session import checkpoint_dir
from perptide.sources.materialize import materialized
from perptide.sources.point_store import PointStore, day_of

query = Registry()
DAY = 86_400_000
T0 = bridge.T0
AS_OF = T0 + DAY // 2  # end of the compressed axis
RAW_AS_OF = T0 + 20 * DAY


def instant(instant_ms: int) -> dt.datetime:
    return dt.datetime.fromtimestamp(instant_ms / 1000, dt.UTC)


def at(instant_ms: int):
    return F.timestamp_millis(F.lit(instant_ms))


DIV_CTE = f"""
priced AS (
  SELECT symbol, ts, venue, CAST(funding_rate AS DOUBLE) * 8 / funding_interval_h AS r8,
    CASE WHEN source <> 'hyperliquid_ws_all_mids'
      THEN CAST(mark AS DOUBLE) / {B.mult_at('m.ts', 'm')} END AS price,
    CAST(oi_usd AS DOUBLE) AS oi, CAST(vol24h_usd AS DOUBLE) AS vol FROM market m),
pair AS (
  SELECT coalesce(b.symbol, h.symbol) AS symbol, coalesce(b.ts, h.ts) AS ts,
    b.r8 - h.r8 AS fs, (b.price - h.price) * 10000 / ((b.price + h.price) / 2) AS msb,
    (b.price + h.price) / 2 AS mid, b.oi AS ob, b.oi + h.oi AS ot, b.vol AS vb, b.vol + h.vol AS vt,
    (CASE WHEN b.symbol IS NULL THEN 0 ELSE 1 END + CASE WHEN h.symbol IS NULL THEN 0 ELSE 1 END) AS n
  FROM (SELECT * FROM priced WHERE venue = 'binance') b
  FULL JOIN (SELECT * FROM priced WHERE venue = 'hyperliquid') h ON b.symbol = h.symbol AND b.ts = h.ts),
dv AS (
  SELECT symbol, ts, CASE WHEN n = 2 THEN fs END AS funding_spread_8h,
    CASE WHEN n = 2 AND mid > 0 THEN msb END AS mark_spread_bps,
    CASE WHEN n = 2 AND ot > 0 THEN ob / ot END AS oi_share_bn,
    CASE WHEN n = 2 AND vt > 0 THEN vb / vt END AS vol_share_bn, n AS n_venues FROM pair),
dpt AS (
  SELECT 'x:' || symbol AS scope, ts, u.metric AS metric, u.value AS value, 60 AS grid_s, false AS backfilled
  FROM dv, (SELECT unnest([{{'metric': 'funding_spread_8h', 'value': funding_spread_8h}},
    {{'metric': 'mark_spread_bps', 'value': mark_spread_bps}},
    {{'metric': 'oi_share_bn', 'value': oi_share_bn}},
    {{'metric': 'vol_share_bn', 'value': vol_share_bn}}]) AS u))"""
DIV = [*B.market_ctes(), DIV_CTE]
DIV_COLUMNS = """symbol, ts AS ts_ms, round(funding_spread_8h * 10000, 6) AS funding_spread_8h_e4,
  round(mark_spread_bps, 6) AS mark_spread_bps, round(oi_share_bn, 6) AS oi_share_bn,
  round(vol_share_bn, 6) AS vol_share_bn, CAST(n_venues AS BIGINT) AS n_venues"""


def divergence(spark, sf_dir):
    return D.divergence_1m(market(spark, sf_dir), bridge.segments(spark, sf_dir))


def divergence_out(df):
    return df.select(
        "symbol",
        ms("ts", "ts_ms"),
        r6(F.col("funding_spread_8h") * 10000, "funding_spread_8h_e4"),
        r6("mark_spread_bps"),
        r6("oi_share_bn"),
        r6("vol_share_bn"),
        big("n_venues"),
    )


@query("d1_cross_venue_metrics", B.with_ctes(*DIV) + f"SELECT {DIV_COLUMNS} FROM dv")
def d1(spark, sf_dir):
    return divergence_out(divergence(spark, sf_dir))


@query(
    "j9_two_venue_minutes",
    B.with_ctes(*DIV) + "SELECT n_venues::BIGINT AS n_venues, count(*) AS minutes FROM dv GROUP BY 1",
)
def j9(spark, sf_dir):
    return divergence(spark, sf_dir).groupBy(big("n_venues")).agg(F.count("*").alias("minutes"))


def pctl_sql(points: str, as_of: int, days: int) -> str:
    return f"""
win AS (SELECT * FROM {points} WHERE ts > {as_of} - {days * DAY} AND ts <= {as_of} AND value IS NOT NULL),
cur AS (SELECT scope, metric, arg_max(value, ts) AS v, arg_max(grid_s, ts) AS g, max(ts) AS t FROM win GROUP BY ALL),
pctl AS (
  SELECT w.scope, w.metric, c.v AS value, count(*) AS n, c.g AS grid_s, c.t AS latest_ms,
    CASE WHEN count(*) >= 30 THEN count(*) FILTER (w.value < c.v) / count(*)::DOUBLE END AS pctl
  FROM win w JOIN cur c ON c.scope = w.scope AND c.metric = w.metric AND c.g = w.grid_s
  GROUP BY w.scope, w.metric, c.v, c.g, c.t)"""


PCTL_COLUMNS = """scope, metric, round(value, 6) AS value, round(pctl, 6) AS pctl, n,
  CAST(grid_s AS BIGINT) AS grid_s, latest_ms"""


def pctl_out(df):
    return df.select(
        "scope", "metric", r6("value"), r6("pctl"), "n", big("grid_s"), ms("updated", "latest_ms")
    )


@query(
    "d2_percentiles_of_divergence",
    B.with_ctes(*DIV, pctl_sql("dpt", AS_OF, 30))
    + f"SELECT {PCTL_COLUMNS.replace('round(value, 6)', 'round(value * 10000, 6)')} FROM pctl",
)
def d2(spark, sf_dir):
    points = D.divergence_points(divergence(spark, sf_dir))
    return pctl_out(
        D.percentiles(points, at(AS_OF)).withColumn("value", F.col("value") * 10000)
    )


MARKET_POINTS = """
mpt AS (
  SELECT venue || ':' || symbol AS scope, ts, u.metric AS metric, u.value AS value, grid_s, backfilled
  FROM market, (SELECT unnest([{'metric': 'mark', 'value': CAST(mark AS DOUBLE)},
    {'metric': 'oi_base', 'value': CAST(oi_base AS DOUBLE)},
    {'metric': 'chg24h_pct', 'value': CAST(chg24h_pct AS DOUBLE)}]) AS u))"""
RAW_MARKET = B.market_ctes(time="raw_ms")
POINT_COLUMNS = ("mark", "oi_base", "chg24h_pct")


def raw_points(spark, sf_dir):
    return D.market_points(market(spark, sf_dir, "raw_ms"), POINT_COLUMNS)


@query(
    "d2_percentiles_inside_window",
    B.with_ctes(*RAW_MARKET, MARKET_POINTS, pctl_sql("mpt", RAW_AS_OF, 10))
    + f"SELECT {PCTL_COLUMNS} FROM pctl",
)
def d2_window(spark, sf_dir):
    return pctl_out(D.percentiles(raw_points(spark, sf_dir), at(RAW_AS_OF), window_days=10))


def point_store(spark, points):
    store = PointStore(spark, f"{checkpoint_dir(spark)}/points-{uuid.uuid4().hex}")
    store.write_days(points)
    return store


@query(
    "d2_percentiles_from_day_counts",
    B.with_ctes(*RAW_MARKET, MARKET_POINTS, pctl_sql("mpt", RAW_AS_OF, 10))
    + f"SELECT {PCTL_COLUMNS} FROM pctl",
)
def d2_days(spark, sf_dir):
    """The same window from stored counts of its whole days and points of the days at its ends."""
    return pctl_out(point_store(spark, raw_points(spark, sf_dir)).percentiles(instant(RAW_AS_OF), 10))


@query(
    "u5_percentiles_after_backfill",
    B.with_ctes(*RAW_MARKET, MARKET_POINTS, pctl_sql("mpt", RAW_AS_OF, 10))
    + f"SELECT {PCTL_COLUMNS} FROM pctl",
)
def u5_percentiles(spark, sf_dir):
    """Percentiles of the live rows, then all backfill: its days are rewritten, the series it touched counted anew."""
    stage, seg = bridge.stage(spark, sf_dir, "raw_ms"), bridge.segments(spark, sf_dir)
    live = merge.replay_live(stage.filter("NOT backfilled"), seg)
    store = point_store(spark, D.market_points(live, POINT_COLUMNS))
    before = store.percentiles(instant(RAW_AS_OF), 10)
    stored = materialized(before)
    touched = D.touched_scopes(stage)
    days = sorted(r["day"] for r in stage.filter("backfilled").select(day_of(F.timestamp_millis("ts_ms")).alias("day")).distinct().collect())
    after = market(spark, sf_dir, "raw_ms").filter(day_of("ts").isin(*days))
    store.write_days(D.market_points(after, POINT_COLUMNS))
    return pctl_out(store.refreshed(stored, touched, instant(RAW_AS_OF), 10))


@query(
    "s8_expiry_of_stored_days",
    B.with_ctes(*RAW_MARKET, MARKET_POINTS) + f"""
SELECT strftime(make_timestamp(ts * 1000), '%Y%m%d') AS day, count(*) AS rows FROM mpt
WHERE value IS NOT NULL AND ts >= {RAW_AS_OF} - 5 * {DAY} GROUP BY 1""",
)
def s8_stored(spark, sf_dir):
    """A stored table after the days before the last five have expired."""
    store = point_store(spark, raw_points(spark, sf_dir))
    store.expire(instant(RAW_AS_OF - 5 * DAY).strftime("%Y%m%d"))
    return store.points().groupBy("day").agg(F.count("*").alias("rows"))


def coverage_sql(points: str, as_of: int) -> str:
    return f"""
cov AS (
  SELECT scope, metric, min(ts) AS first_ms, min(ts) FILTER (NOT backfilled) AS self_from_ms,
    min(ts) FILTER (backfilled) AS backfill_from_ms, CAST(min(grid_s) AS BIGINT) AS grid_s_min,
    CAST(({as_of} - min(ts)) // {DAY} AS BIGINT) AS days_available,
    ({as_of} - min(ts)) // {DAY} >= 30 AS enough
  FROM {points} WHERE value IS NOT NULL GROUP BY ALL)"""


@query(
    "d3_history_coverage",
    B.with_ctes(*RAW_MARKET, MARKET_POINTS, coverage_sql("mpt", T0 + 30 * DAY + 3_600_000))
    + "SELECT * FROM cov",
)
def d3(spark, sf_dir):
    return D.coverage(raw_points(spark, sf_dir), at(T0 + 30 * DAY + 3_600_000)).select(
        "scope", "metric", ms("first_ts", "first_ms"), ms("self_from", "self_from_ms"),
        ms("backfill_from", "backfill_from_ms"), big("grid_s_min"), big("days_available"), "enough",
    )


MEDIAN_CTE = """
coin AS (SELECT symbol, ts, avg(CAST(funding_rate AS DOUBLE) * 8 / funding_interval_h) AS rate FROM market
  WHERE funding_rate IS NOT NULL AND funding_interval_h IS NOT NULL GROUP BY ALL),
med AS (SELECT ts, quantile_cont(rate, 0.5) AS value, count(*) AS n_coins FROM coin GROUP BY ts)"""


@query(
    "d4_market_funding_median",
    B.with_ctes(*B.market_ctes(), MEDIAN_CTE)
    + "SELECT 'x:*' AS scope, ts AS ts_ms, round(value * 10000, 6) AS value_e4, n_coins FROM med",
)
def d4(spark, sf_dir):
    return D.market_funding_median(market(spark, sf_dir)).select(
        "scope", ms("ts", "ts_ms"), r6(F.col("value") * 10000, "value_e4"), "n_coins"
    )


@query(
    "d5_share_change_over_horizon",
    B.with_ctes(*DIV) + """
SELECT a.symbol, a.ts AS ts_ms, round(a.oi_share_bn - b.oi_share_bn, 6) AS change
FROM dv a LEFT JOIN dv b ON b.symbol = a.symbol AND b.ts = a.ts - 5 * 60000""",
)
def d5(spark, sf_dir):
    return D.change_over(divergence(spark, sf_dir), "oi_share_bn", 5).select(
        "symbol", ms("ts", "ts_ms"), r6("change")
    )


@query("u5_recompute_after_backfill", B.with_ctes(*DIV) + f"SELECT {DIV_COLUMNS} FROM dv")
def u5(spark, sf_dir):
    stage, seg = bridge.stage(spark, sf_dir), bridge.segments(spark, sf_dir)
    stored = D.divergence_1m(merge.replay_live(stage.filter("NOT backfilled"), seg), seg)
    after = merge.replay(stage, seg)
    return divergence_out(D.recompute(stored, after, seg, D.touched_minutes(stage)))


INSTRUMENT_OUT = """SELECT venue, venue_symbol, symbol, vf AS valid_from_ms, vt AS valid_to_ms,
  CAST(mult AS BIGINT) AS mult, CAST(funding_interval_h AS BIGINT) AS funding_interval_h, status FROM instruments"""


def instruments_out(df):
    return df.select(
        "venue", "venue_symbol", "symbol", ms("valid_from", "valid_from_ms"), ms("valid_to", "valid_to_ms"),
        big("mult"), big("funding_interval_h"), "status",
    )


@query("u6_contract_versions", B.with_ctes(B.EV, B.INSTRUMENTS) + INSTRUMENT_OUT)
def u6(spark, sf_dir):
    return instruments_out(bridge.instruments(spark, sf_dir))


ATTRIBUTES = ["symbol", "mult", "funding_interval_h", "tick", "status"]


@query(
    "u6_apply_one_snapshot",
    B.with_ctes(B.EV, B.INSTRUMENTS) + INSTRUMENT_OUT,
)
def u6_apply(spark, sf_dir):
    """The last snapshot of all, applied to the history of all earlier ones."""
    key = ["venue", "venue_symbol"]
    snapshots = bridge.instrument_snapshots(spark, sf_dir)
    cut = snapshots.agg(F.unix_millis(F.max("ts")).alias("ms")).first()["ms"]
    cut = at(cut)
    versions = H.scd2_history(snapshots.filter(F.col("ts") < cut), key, ATTRIBUTES, ["venue"])
    now = snapshots.filter(F.col("ts") == cut)
    return instruments_out(H.scd2_apply(versions, now, key, ATTRIBUTES, cut))


LISTS = f"""
li AS (
  SELECT DISTINCT venue, symbol, sym_no, k, {bridge.T0} + off + k * every AS ts_ms FROM (
    SELECT *, CAST(floor((obs_ms - {bridge.T0} - off) / every) AS BIGINT) AS k FROM (
      SELECT *, CASE WHEN venue = 'binance' THEN 600000 ELSE 900000 END AS every,
        CASE WHEN venue = 'binance' THEN 0 ELSE 433000 END AS off FROM ev))
  WHERE NOT (venue = 'binance' AND sym_no = 4 AND k % 5 = 2)
    AND NOT (venue = 'hyperliquid' AND sym_no = 1 AND k % 4 = 1)),
tr AS (
  SELECT DISTINCT venue, symbol, ts_ms FROM li WHERE venue = 'hyperliquid'
    OR NOT ((sym_no = 2 AND k % 7 IN (3, 4)) OR (sym_no = 3 AND k % 11 = 5))),
la AS (SELECT DISTINCT venue, ts_ms FROM li)"""
UNIVERSE = LISTS + """,
ui AS (SELECT ts_ms, lead(ts_ms) OVER (ORDER BY ts_ms) AS nxt, row_number() OVER (ORDER BY ts_ms) AS k
  FROM (SELECT DISTINCT ts_ms FROM la)),
held AS (SELECT u.ts_ms, u.nxt, u.k, la.venue, max(la.ts_ms) AS list_ms
  FROM ui u JOIN la ON la.ts_ms <= u.ts_ms GROUP BY ALL),
us AS (SELECT h.ts_ms, h.nxt, h.k, t.symbol, h.k - row_number() OVER (PARTITION BY t.symbol ORDER BY h.ts_ms) AS g
  FROM held h JOIN tr t ON t.venue = h.venue AND t.ts_ms = h.list_ms
  GROUP BY h.ts_ms, h.nxt, h.k, t.symbol HAVING count(DISTINCT h.venue) = 2),
universe AS (SELECT symbol, min(ts_ms) AS in_from, CASE WHEN count(*) FILTER (nxt IS NULL) = 0 THEN max(nxt) END AS in_to
  FROM us GROUP BY symbol, g)"""


@query(
    "l3_universe_reconciliation",
    B.with_ctes(B.EV, UNIVERSE) + """
SELECT symbol, in_from AS in_from_ms, in_to AS in_to_ms,
  CASE WHEN in_to IS NULL THEN 'listed_on_both_venues' ELSE 'not_on_both_venues' END AS reason FROM universe""",
)
def l3(spark, sf_dir):
    """Both venues' parsed lists, on clocks of their own, one of them without any status."""
    return L.universe(P.lists(spark, sf_dir)).select(
        "symbol", ms("in_from", "in_from_ms"), ms("in_to", "in_to_ms"), "reason"
    )


@query(
    "j10_listed_on_both_venues",
    B.with_ctes(B.EV, LISTS) + """
SELECT symbol FROM tr WHERE (venue, ts_ms) IN (SELECT (venue, max(ts_ms)) FROM la GROUP BY venue)
GROUP BY symbol HAVING count(DISTINCT venue) = 2""",
)
def j10(spark, sf_dir):
    return L.listed_now(P.lists(spark, sf_dir))


@query(
    "u7_membership_spells",
    B.with_ctes(B.EV) + """, m AS (
  SELECT user_id, raw_ms, event_id, event_type IN ('click','view') AS listed FROM ev
  QUALIFY row_number() OVER (PARTITION BY user_id, raw_ms ORDER BY event_id) = 1),
c AS (SELECT *, coalesce(lag(listed) OVER (PARTITION BY user_id ORDER BY raw_ms), false) AS was FROM m),
d AS (SELECT user_id, raw_ms, listed, lead(raw_ms) OVER (PARTITION BY user_id ORDER BY raw_ms) AS nxt
  FROM c WHERE listed <> was)
SELECT 'U' || user_id AS symbol, raw_ms AS in_from_ms, nxt AS in_to_ms FROM d WHERE listed""",
)
def u7(spark, sf_dir):
    e = bridge.events(spark, sf_dir)
    records = (
        e.groupBy("user_id", "raw_ms")
        .agg(F.min_by("event_type", "event_id").alias("event_type"))
        .select(
            F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
            F.timestamp_millis("raw_ms").alias("ts"),
            F.col("event_type").isin("click", "view").alias("listed"),
            F.lit("reconciled").alias("reason"),
        )
    )
    return H.membership_spells(records).select(
        "symbol", ms("in_from", "in_from_ms"), ms("in_to", "in_to_ms")
    )


TRANSPORT = "CASE WHEN user_id % 2 = 0 THEN 'rest' ELSE 'ws' END"


@query(
    "u8_two_writer_row",
    B.with_ctes(B.EV) + f""", o AS (SELECT venue, event_type AS capability, {TRANSPORT} AS transport, *
    EXCLUDE (venue) FROM ev),
a AS (SELECT venue, capability, transport, max(obs_ms * 100000 + event_id) AS k,
    arg_max(event_id % 300, obs_ms * 100000 + event_id) AS latency_ms,
    arg_max(obs_ms, obs_ms * 100000 + event_id) AS last_ok_ms FROM o WHERE event_id % 3 <> 0 GROUP BY ALL),
b AS (SELECT venue, capability, transport, arg_max(event_id % 2 = 1, obs_ms * 100000 + event_id) AS ok,
    arg_max(event_id % 9, obs_ms * 100000 + event_id) AS consecutive_fail FROM o WHERE event_id % 3 = 0 GROUP BY ALL)
SELECT venue, capability, transport, latency_ms, last_ok_ms, ok, consecutive_fail
FROM a FULL JOIN b USING (venue, capability, transport)""",
)
def u8(spark, sf_dir):
    rows = bridge.events(spark, sf_dir).select(
        "venue",
        F.col("event_type").alias("capability"),
        F.when(F.col("user_id") % 2 == 0, "rest").otherwise("ws").alias("transport"),
        "event_id",
        "obs_ms",
        (F.col("obs_ms") * 100_000 + F.col("event_id")).alias("k"),
    )
    key = ["venue", "capability", "transport"]
    seen = rows.filter("event_id % 3 <> 0").select(
        *key, (F.col("event_id") % 300).alias("latency_ms"), F.col("obs_ms").alias("last_ok_ms"), "k"
    )
    judged = rows.filter("event_id % 3 = 0").select(
        *key, (F.col("event_id") % 2 == 1).alias("ok"), (F.col("event_id") % 9).alias("consecutive_fail"),
        F.col("k").alias("k2"),
    )
    return H.two_writer_row(seen, judged, key, "k", "k2").drop("k", "k2")


@query(
    "u9_two_phase_claims",
    B.with_ctes(B.EV) + """, r AS (
  SELECT event_type AS kind, symbol || '-' || (obs_ms // 600000) AS dedupe_key, min(obs_ms) AS ingest_ms
  FROM ev WHERE event_id % 2 = 0 GROUP BY ALL),
s AS (SELECT event_type AS kind, symbol || '-' || (obs_ms // 600000) AS dedupe_key, min(obs_ms) AS sent_ms,
    arg_min(event_id % 5 <> 1, obs_ms) AS ok FROM ev WHERE event_id % 2 = 1 GROUP BY ALL)
SELECT kind, dedupe_key, ingest_ms, sent_ms, ok FROM r LEFT JOIN s USING (kind, dedupe_key)""",
)
def u9(spark, sf_dir):
    rows = bridge.events(spark, sf_dir).select(
        F.col("event_type").alias("kind"),
        F.concat_ws("-", "symbol", F.floor(F.col("obs_ms") / 600_000).cast("string")).alias("dedupe_key"),
        F.timestamp_millis("obs_ms").alias("at"),
        "event_id",
    )
    requests = rows.filter("event_id % 2 = 0").select(
        "kind", "dedupe_key", F.lit("channel").alias("target"), F.lit("bridge").alias("source"),
        F.col("at").alias("ingest_ts"),
    )
    outcomes = rows.filter("event_id % 2 = 1").select(
        "kind", "dedupe_key", (F.col("event_id") % 5 != 1).alias("ok"), F.col("at").alias("sent_at")
    )
    empty = spark.createDataFrame(
        [],
        "kind string, dedupe_key string, target string, source string, ingest_ts timestamp, "
        "ok boolean, sent_at timestamp",
    )
    claimed = H.claim(H.claim(empty, requests), requests)
    return H.resolve_claims(claimed, outcomes).select(
        "kind", "dedupe_key", ms("ingest_ts", "ingest_ms"), ms("sent_at", "sent_ms"), "ok"
    )


@query(
    "u10_latest_only_rows",
    B.with_ctes(*RAW_MARKET, MARKET_POINTS) + """
SELECT scope, metric, round(arg_max(value, ts), 6) AS value, max(ts) AS updated_ms FROM mpt
WHERE value IS NOT NULL GROUP BY scope, metric""",
)
def u10(spark, sf_dir):
    points = raw_points(spark, sf_dir).filter("value IS NOT NULL")
    return H.latest_by(points, ["scope", "metric"], ["ts"]).select(
        "scope", "metric", r6("value"), ms("ts", "updated_ms")
    )


@query(
    "u11_resumable_cursors",
    B.with_ctes(B.EV) + """
SELECT 'job' || event_id % 3 AS job, venue, symbol, event_type AS metric, max(obs_ms) AS cursor_ms,
  bool_or(event_id % 400 = 0) AS done FROM ev GROUP BY ALL""",
)
def u11(spark, sf_dir):
    progress = bridge.events(spark, sf_dir).select(
        F.concat(F.lit("job"), (F.col("event_id") % 3).cast("string")).alias("job"),
        "venue",
        "symbol",
        F.col("event_type").alias("metric"),
        F.timestamp_millis("obs_ms").alias("cursor_ts"),
        (F.col("event_id") % 400 == 0).alias("done"),
    )
    return H.cursors(progress).select(
        "job", "venue", "symbol", "metric", ms("cursor_ts", "cursor_ms"), "done"
    )
