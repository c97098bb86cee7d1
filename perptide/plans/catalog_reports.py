"""Queries over boards, studies, trades, accounts, alerts and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from perptide.operators import accounts as A
from perptide.operators import divergence as D
from perptide.operators import flow as W
from perptide.operators import gaps as G
from perptide.operators import normalize_binance as NB
from perptide.operators import normalize_hyperliquid as NH
from perptide.operators import reports as R
from perptide.plans import bridge
from perptide.plans import bridge_sql as B
from perptide.plans import payloads as P
from perptide.plans.catalog_metrics import (
    AS_OF,
    DIV,
    MARKET_POINTS,
    MEDIAN_CTE,
    POINT_COLUMNS,
    at,
    coverage_sql,
    divergence,
    pctl_sql,
)
from perptide.plans.catalog_normalize import LIQ_CTE, liquidation_out, liquidation_table
from perptide.plans.catalog_normalize import query as normalize
from perptide.plans.catalog_ops import EVC, GAPS, LOG_SQL, request_log, status
from perptide.plans.common import big, market, market_out, r6, stage_out
from perptide.plans.registry import Registry
from perptide.session import checkpoint_dir
from perptide.sources import landed
from perptide.sources.minute_store import MinuteStore
from perptide.streaming import lanes, quarantine

query = Registry()
T0 = bridge.T0
HOUR = bridge.HOUR
DAY = 86_400_000
LIQ_ONLY = LIQ_CTE.split("WITH RECURSIVE", 1)[1].split(", liq AS", 1)[1]
LIQ = "liq AS" + LIQ_ONLY
#: The digest of the morning: liquidations after it are not in it.
DIGEST_AS_OF = T0 + 6 * HOUR


def r2(column, name=None):
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value.cast("double"), 2).alias(name or column)


# -- boards --------------------------------------------------------------------------
PCTL = [*DIV, pctl_sql("dpt", AS_OF, 30)]
SCALE = "CASE WHEN metric = 'funding_spread_8h' THEN 10000 ELSE 1 END"


def scaled(column="value"):
    return F.col(column) * F.when(F.col("metric") == "funding_spread_8h", 10000).otherwise(1)


def divergence_percentiles(spark, sf_dir):
    return D.percentiles(D.divergence_points(divergence(spark, sf_dir)), at(AS_OF))


@query(
    "p1_divergence_board",
    B.with_ctes(*PCTL) + f""", b AS (SELECT *, row_number() OVER (PARTITION BY metric
  ORDER BY pctl DESC NULLS LAST, abs(value) DESC NULLS LAST, scope) AS rank FROM pctl)
SELECT metric, rank, scope, round(pctl, 6) AS pctl, round(value * {SCALE}, 6) AS value, n FROM b WHERE rank <= 10""",
)
def p1(spark, sf_dir):
    return R.divergence_board(divergence_percentiles(spark, sf_dir)).select(
        "metric", big("rank"), "scope", r6("pctl"), r6(scaled(), "value"), "n"
    )


@query(
    "p2_display_rule",
    B.with_ctes(*PCTL, coverage_sql("dpt", AS_OF)) + f"""
SELECT p.scope, p.metric, n, round(CASE WHEN n >= 10 THEN p.value * {SCALE.replace('metric', 'p.metric')} END, 6) AS shown_value,
  round(CASE WHEN n >= 30 AND enough THEN pctl END, 6) AS shown_pctl,
  CASE WHEN NOT enough THEN 'accumulating, ' || days_available || ' days' END AS note
FROM pctl p JOIN cov USING (scope, metric)""",
)
def p2(spark, sf_dir):
    points = D.divergence_points(divergence(spark, sf_dir))
    shown = R.display(D.percentiles(points, at(AS_OF)), D.coverage(points, at(AS_OF)))
    return shown.select(
        "scope", "metric", "n", r6(scaled("shown_value"), "shown_value"), r6("shown_pctl"), "note"
    )


MEDIAN_POINTS = """
mdp AS (SELECT 'x:*' AS scope, 'market_funding_median' AS metric, ts, value, 60 AS grid_s FROM med)"""


@query(
    "p3_daily_digest",
    B.with_ctes(*PCTL, MEDIAN_CTE, MEDIAN_POINTS, pctl_sql("mdp", AS_OF, 30).replace("win", "win2").replace("cur", "cur2").replace("pctl AS (", "pctl2 AS ("), LIQ)
    + f""", un AS (SELECT 'unusual' AS block, row_number() OVER (ORDER BY abs(pctl - 0.5) DESC, scope, metric) AS rank, * FROM pctl WHERE pctl IS NOT NULL),
dg AS (SELECT 'divergence' AS block, row_number() OVER (ORDER BY pctl DESC, abs(value) DESC, scope) AS rank, * FROM pctl
  WHERE pctl IS NOT NULL AND metric = 'mark_spread_bps'),
lq AS (SELECT 'liquidations' AS block, row_number() OVER (ORDER BY notional DESC, symbol) AS rank, 'binance:' || symbol AS scope,
  'observed_lower_bound_usd' AS metric, CAST(notional AS DOUBLE) AS value, NULL::DOUBLE AS pctl, 1::BIGINT AS n FROM liq
  WHERE ts_ms BETWEEN {DIGEST_AS_OF - DIGEST_AS_OF % DAY} AND {DIGEST_AS_OF}),
al AS (SELECT block, rank, scope, metric, value, pctl, n FROM un UNION ALL SELECT block, rank, scope, metric, value, pctl, n FROM dg
  UNION ALL SELECT * FROM lq UNION ALL SELECT 'market', 1, scope, metric, value * 10000, pctl, n FROM pctl2)
SELECT block, rank, scope, metric, round(value * {SCALE}, 6) AS value, round(pctl, 6) AS pctl, n FROM al WHERE rank <= 3""",
)
def p3(spark, sf_dir):
    rates = D.market_funding_median(market(spark, sf_dir))
    line = D.percentiles(rates.withColumn("grid_s", F.lit(60)), at(AS_OF)).withColumn(
        "value", F.col("value") * 10000
    )
    digest = R.daily_digest(
        divergence_percentiles(spark, sf_dir), line, liquidation_table(spark, sf_dir), DIGEST_AS_OF
    )
    return digest.select(
        "block", big("rank"), "scope", "metric", r6(scaled(), "value"), r6("pctl"), "n"
    )


SETTLED = B.with_ctes(B.EV, B.stage("raw_ms")) + """, se AS (
  SELECT venue, symbol, ts_ms // 28800000 * 28800000 AS ts_ms,
    arg_max(CAST(funding_rate AS DOUBLE) * 8 / funding_interval_h, ts_ms * 100000 + event_id) AS rate_8h
  FROM stg WHERE funding_rate IS NOT NULL GROUP BY venue, symbol, ts_ms // 28800000),
sp AS (SELECT a.symbol, a.ts_ms, a.rate_8h - b.rate_8h AS spread FROM se a JOIN se b USING (symbol, ts_ms)
  WHERE a.venue = 'binance' AND b.venue = 'hyperliquid'),
oc0 AS (SELECT s.symbol, s.ts_ms, s.spread, l.spread AS later,
    CASE WHEN s.spread >= 0.0003 THEN 'high' WHEN s.spread <= -0.0003 THEN 'low' END AS grp,
    CASE WHEN l.spread >= 0.0003 THEN 'high' WHEN l.spread <= -0.0003 THEN 'low' END AS grp2
  FROM sp s LEFT JOIN sp l ON l.symbol = s.symbol AND l.ts_ms = s.ts_ms + 86400000),
oc AS (SELECT *, later - spread AS change, CASE WHEN later IS NOT NULL THEN coalesce(grp2 = grp, false) END AS still
  FROM oc0 WHERE grp IS NOT NULL)
"""


def study(spark, sf_dir):
    rows = bridge.stage(spark, sf_dir, "raw_ms").filter(F.col("funding_rate").isNotNull())
    rate = F.col("funding_rate").cast("double") * 8 / F.col("funding_interval_h")
    slot = F.col("ts_ms") - F.pmod(F.col("ts_ms"), F.lit(28_800_000))
    settled = rows.groupBy("venue", "symbol", slot.alias("slot")).agg(
        F.max_by(rate, F.col("ts_ms") * 100_000 + F.col("event_id")).alias("rate_8h")
    ).withColumnRenamed("slot", "ts_ms")
    return R.study_outcomes(R.settlement_spread(settled), 0.0003)


@query(
    "p4_event_study",
    SETTLED + """SELECT grp, count(*) AS n, count(still) AS n_with_outcome, round(quantile_cont(change, 0.5) * 10000, 6) AS median_change_e4,
  round(avg(still::INT), 6) AS share_still FROM oc GROUP BY grp""",
)
def p4(spark, sf_dir):
    return R.event_study(study(spark, sf_dir)).select(
        "grp", "n", "n_with_outcome", r6(F.col("median_change") * 10000, "median_change_e4"), r6("share_still")
    )


@query(
    "p19_scoreboard_with_wilson_interval",
    SETTLED + """, c AS (SELECT grp, count(*) AS n, count(*) FILTER (still) AS still FROM oc WHERE still IS NOT NULL GROUP BY grp),
w AS (SELECT *, still / n::DOUBLE AS p, 1.959963984540054 * 1.959963984540054 AS z2 FROM c)
SELECT grp, n, still, round(CASE WHEN n >= 30 THEN p END, 6) AS share,
  round(CASE WHEN n >= 30 THEN (p + z2 / (2 * n) - 1.959963984540054 * sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n) END, 6) AS low,
  round(CASE WHEN n >= 30 THEN (p + z2 / (2 * n) + 1.959963984540054 * sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n) END, 6) AS high
FROM w""",
)
def p19(spark, sf_dir):
    return R.scoreboard(study(spark, sf_dir)).select("grp", "n", "still", r6("share"), r6("low"), r6("high"))


TIER_USD = 3000


@query(
    "p5_liquidation_lists",
    LIQ_CTE + f"""SELECT tier, venue, symbol, ts_ms, side, {B.r6('notional', 'notional_usd')}
FROM liq, (SELECT unnest([1000, {TIER_USD}]) AS tier) WHERE notional >= tier""",
)
def p5(spark, sf_dir):
    rows = liquidation_table(spark, sf_dir)
    tiers = [
        R.liquidation_list(rows, usd).select(
            F.lit(usd).alias("tier"), "venue", "symbol", "ts_ms", "side", r6("notional_usd")
        )
        for usd in (1000, TIER_USD)
    ]
    return tiers[0].unionByName(tiers[1])


@query(
    "t6_liquidation_pushes",
    LIQ_CTE + f"""SELECT venue, ts_ms // 300000 * 300000 AS window_ms, count(*) AS events,
  {B.r6('sum(notional)', 'observed_lower_bound_usd')}, {B.r6('max(notional)', 'largest_usd')}
FROM liq WHERE notional >= {TIER_USD} GROUP BY ALL""",
)
def t6(spark, sf_dir):
    return R.pushes(liquidation_table(spark, sf_dir), TIER_USD).select(
        "venue", "window_ms", "events", r6("observed_lower_bound_usd"), r6("largest_usd")
    )


START = AS_OF - 8 * HOUR


@query(
    "p6_look_back_report",
    B.with_ctes(
        *B.market_ctes(), MARKET_POINTS, pctl_sql("mpt", AS_OF, 30),
        pctl_sql("mpt", START, 30).replace("win", "win2").replace("cur", "cur2").replace("pctl AS (", "pctl2 AS ("),
        LIQ,
    ) + f""", l AS (SELECT symbol, sum(notional) AS usd FROM liq WHERE ts_ms > {START} AND ts_ms <= {AS_OF} GROUP BY symbol)
SELECT scope, metric, round(s.pctl, 6) AS start_pctl, round(e.pctl, 6) AS end_pctl, s.n AS start_n, e.n AS end_n,
  round(CAST(l.usd AS DOUBLE), 6) AS observed_lower_bound_usd, round(e.pctl - s.pctl, 6) AS change
FROM pctl2 s FULL JOIN pctl e USING (scope, metric) LEFT JOIN l ON l.symbol = split_part(scope, ':', 2)""",
)
def p6(spark, sf_dir):
    points = D.market_points(market(spark, sf_dir), POINT_COLUMNS)
    return R.look_back(points, liquidation_table(spark, sf_dir), AS_OF, 8).select(
        "scope", "metric", r6("start_pctl"), r6("end_pctl"), "start_n", "end_n",
        r6("observed_lower_bound_usd"), r6("change"),
    )


@query(
    "p7_daily_green_rate",
    B.with_ctes(*GAPS) + """, m AS (SELECT venue, m, bool_and(present >= expected) AS ok FROM st GROUP BY ALL),
d AS (SELECT venue, m // 86400000 * 86400000 AS day_ms, count(*) AS minutes, count(*) FILTER (ok) AS complete_minutes FROM m GROUP BY ALL)
SELECT *, round(complete_minutes / minutes::DOUBLE, 6) AS rate, CASE WHEN complete_minutes / minutes::DOUBLE >= 0.95 THEN 'green'
  WHEN complete_minutes / minutes::DOUBLE >= 0.8 THEN 'yellow' ELSE 'red' END AS cell FROM d""",
)
def p7(spark, sf_dir):
    return R.daily_green_rate(status(spark, sf_dir)).withColumn("rate", r6("rate"))


@query(
    "p7_gap_trend",
    B.with_ctes(*GAPS) + """SELECT venue, metric, from_ms // 86400000 * 86400000 AS day_ms, count(*) AS gaps,
  CAST(sum(minutes) AS BIGINT) AS minutes FROM gp GROUP BY ALL""",
)
def p7_trend(spark, sf_dir):
    return R.gap_trend(G.gap_rows(status(spark, sf_dir)))


@query(
    "p7_rejects_per_source",
    EVC + LOG_SQL + f"""SELECT venue, bucket, CAST(status AS BIGINT) AS status, count(*) AS rejects FROM log
WHERE status IN (418, 429) AND at_ms > {AS_OF} - 7 * 86400000 AND at_ms <= {AS_OF} GROUP BY ALL""",
)
def p7_rejects(spark, sf_dir):
    return R.rejects(request_log(spark, sf_dir), F.lit(AS_OF)).withColumn("status", big("status"))


# -- trades, book, spot --------------------------------------------------------------
TRADE_SQL = f"""tr0 AS (
  SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'binance' ELSE 'hyperliquid' END AS venue, 'S' || (l_partkey % 60) AS symbol,
    {T0} + (l_orderkey % 43200) * 60000 + l_linenumber * 1000 AS at_ms, l_returnflag <> 'A' AS m,
    l_extendedprice AS price, l_quantity AS size, l_suppkey AS buyer, l_orderkey AS seller, l_linenumber AS ln FROM lineitem),
tr AS (SELECT DISTINCT venue, symbol, at_ms, m, price, size, buyer, seller FROM tr0),
mf AS (SELECT venue, symbol, at_ms // 60000 * 60000 AS minute_ms, sum(CASE WHEN m THEN -size ELSE size END) AS delta,
    count(*) AS trades FROM tr GROUP BY ALL),
cvd AS (SELECT venue, symbol, minute_ms, sum(delta) OVER (PARTITION BY venue, symbol ORDER BY minute_ms
    RANGE BETWEEN 86399999 PRECEDING AND CURRENT ROW) AS cvd_24h FROM mf)
"""
TRADES = "WITH " + TRADE_SQL


def trades(spark, sf_dir, copies=True):
    """lineitem as trades; the first line of every order is pushed twice."""
    t = bridge.table(spark, sf_dir, "lineitem")
    at_ms = F.lit(T0) + (F.col("l_orderkey") % 43_200) * 60_000 + F.col("l_linenumber") * 1000
    times = F.when(F.col("l_linenumber") == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = t.select(
        F.when(F.col("l_suppkey") % 2 == 0, "binance").otherwise("hyperliquid").alias("venue"),
        F.concat(F.lit("S"), (F.col("l_partkey") % 60).cast("string")).alias("symbol"),
        at_ms.alias("at_ms"),
        (F.col("l_returnflag") != "A").alias("buyer_is_maker"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("size"),
        F.col("l_suppkey").alias("buyer"),
        F.col("l_orderkey").alias("seller"),
        F.explode(times).alias("copy") if copies else F.lit(1).alias("copy"),
    )
    return rows.drop("copy")


@query(
    "p10_trade_dedupe",
    TRADES + "SELECT venue, symbol, count(*) AS trades, round(sum(size), 6) AS size FROM tr GROUP BY ALL",
)
def p10(spark, sf_dir):
    return W.distinct_trades(trades(spark, sf_dir)).groupBy("venue", "symbol").agg(
        F.count("*").alias("trades"), r6(F.sum("size"), "size")
    )


def cvd(spark, sf_dir):
    return W.cumulative_flow(W.minute_flow(W.distinct_trades(trades(spark, sf_dir))))


@query(
    "p9_cumulative_flow",
    TRADES + "SELECT venue, symbol, minute_ms, round(cvd_24h, 6) AS cvd_24h FROM cvd",
)
def p9(spark, sf_dir):
    return cvd(spark, sf_dir).select("venue", "symbol", "minute_ms", r6("cvd_24h"))


FLOW_AS_OF = T0 + 25 * DAY


@query(
    "p9_flow_percentile",
    TRADES + """, fp AS (SELECT venue || ':' || symbol AS scope, 'cvd_24h' AS metric, minute_ms AS ts, cvd_24h AS value, 60 AS grid_s FROM cvd),
""" + pctl_sql("fp", FLOW_AS_OF, 20) + """
SELECT scope, metric, round(value, 6) AS value, round(pctl, 6) AS pctl, n, latest_ms FROM pctl""",
)
def p9_pctl(spark, sf_dir):
    points = W.flow_points(cvd(spark, sf_dir))
    return D.percentiles(points, at(FLOW_AS_OF), 20).select(
        "scope", "metric", r6("value"), r6("pctl"), "n", F.unix_millis("updated").alias("latest_ms")
    )


BOOK_SQL = EVC + """, bk AS (SELECT event_id, venue, symbol, obs_ms, CAST(px AS DOUBLE) + 1 AS p,
    (1 + event_id % 5) * 0.00031::DOUBLE AS step FROM ev),
lt AS (SELECT * FROM bk QUALIFY row_number() OVER (PARTITION BY venue, symbol, obs_ms // 60000 ORDER BY obs_ms DESC) = 1),
lv AS (SELECT venue, symbol, obs_ms // 60000 * 60000 AS minute_ms,
    [p * (1 - i * step) FOR i IN generate_series(1, 20)] AS bp, [p * (1 + i * step) FOR i IN generate_series(1, 20)] AS ap,
    [CAST(1 + (event_id + i) % 7 AS DOUBLE) FOR i IN generate_series(1, 20)] AS sz FROM lt),
mm AS (SELECT *, (bp[1] + ap[1]) / 2 AS mid FROM lv),
q AS (SELECT venue, symbol, minute_ms, mid, bp[20] <= mid * (1 - 0.005::DOUBLE) AS rb, ap[20] >= mid * (1 + 0.005::DOUBLE) AS ra,
  list_sum([CASE WHEN bp[i] >= mid * (1 - 0.005::DOUBLE) THEN bp[i] * sz[i] ELSE 0 END FOR i IN generate_series(1, 20)]) AS b,
  list_sum([CASE WHEN ap[i] <= mid * (1 + 0.005::DOUBLE) THEN ap[i] * sz[i] ELSE 0 END FOR i IN generate_series(1, 20)]) AS a FROM mm)
"""


@query(
    "p11_book_depth",
    BOOK_SQL + """SELECT venue, symbol, minute_ms, round(mid, 6) AS mid, round(CASE WHEN rb THEN b END, 9) AS bid_usd,
  round(CASE WHEN ra THEN a END, 9) AS ask_usd, rb AS bid_reaches_band, ra AS ask_reaches_band FROM q""",
)
def p11(spark, sf_dir):
    step = (1 + F.col("event_id") % 5) * F.lit(0.00031)
    price = F.col("px").cast("double") + 1

    def levels(sign):
        return F.transform(
            F.sequence(F.lit(1), F.lit(20)),
            lambda i: F.struct(
                (price * (1 + i * step) if sign > 0 else price * (1 - i * step)).alias("px"),
                (1 + (F.col("event_id") + i) % 7).cast("double").alias("sz"),
            ),
        )

    snapshots = bridge.events(spark, sf_dir).select(
        "venue", "symbol", F.col("obs_ms").alias("at_ms"), levels(-1).alias("bids"), levels(1).alias("asks")
    )
    return W.book_depth(snapshots).select(
        "venue", "symbol", "minute_ms", r6("mid"), F.round("bid_usd", 9).alias("bid_usd"), F.round("ask_usd", 9).alias("ask_usd"), "bid_reaches_band", "ask_reaches_band"
    )


@query(
    "p12_spot_basis",
    B.with_ctes(*B.market_ctes()) + """, spot AS (SELECT symbol, obs_ms // 60000 * 60000 AS ts, arg_max(CAST(px AS DOUBLE) + 1, obs_ms * 100000 + event_id) AS spot
  FROM ev WHERE sym_no < 4 AND event_type = 'view' GROUP BY ALL)
SELECT venue, symbol, m.ts AS minute_ms, round(CAST(mark AS DOUBLE), 6) AS mark, round(spot, 6) AS spot,
  round((CAST(mark AS DOUBLE) - spot) / spot * 100, 6) AS basis_pct, round((CAST(mark AS DOUBLE) - spot) / spot * 100 * 365 / 10, 6) AS basis_pct_per_year,
  CASE WHEN spot IS NULL THEN 'no_spot_pair' ELSE 'binance_spot' END AS spot_source
FROM market m LEFT JOIN spot USING (symbol, ts) WHERE mark IS NOT NULL""",
)
def p12(spark, sf_dir):
    perp = market(spark, sf_dir).filter(F.col("mark").isNotNull()).select(
        "venue", "symbol", F.unix_millis("ts").alias("minute_ms"), F.col("mark").cast("double").alias("mark")
    )
    e = bridge.events(spark, sf_dir).filter((F.col("sym_no") < 4) & (F.col("event_type") == "view"))
    minute = F.col("obs_ms") - F.pmod(F.col("obs_ms"), F.lit(60_000))
    spot = e.groupBy("symbol", minute.alias("minute_ms")).agg(
        F.max_by(F.col("px").cast("double") + 1, F.col("obs_ms") * 100_000 + F.col("event_id")).alias("spot")
    )
    return W.spot_basis(perp, spot, "binance_spot").select(
        "venue", "symbol", "minute_ms", r6("mark"), r6("spot"), r6("basis_pct"), r6("basis_pct_per_year"), "spot_source"
    )


@query(
    "p13_tick_retention",
    TRADES + f"""SELECT venue, at_ms // 86400000 AS day, count(*) AS trades FROM tr
WHERE at_ms > {T0 + 9 * DAY} - 7 * 86400000 AND at_ms <= {T0 + 9 * DAY} GROUP BY ALL""",
)
def p13(spark, sf_dir):
    kept = W.retained_ticks(W.distinct_trades(trades(spark, sf_dir)), F.lit(T0 + 9 * DAY))
    return kept.groupBy("venue", F.floor(F.col("at_ms") / DAY).cast("bigint").alias("day")).agg(
        F.count("*").alias("trades")
    )


@query(
    "p13_earliest_tick",
    TRADES + f"""SELECT venue, min(at_ms) AS earliest_ms, min(at_ms) <= {T0 + 9 * DAY} - 7 * 86400000 AS overdue FROM tr GROUP BY venue""",
)
def p13_earliest(spark, sf_dir):
    return W.earliest_ticks(trades(spark, sf_dir, copies=False), F.lit(T0 + 9 * DAY))


# -- accounts ------------------------------------------------------------------------
ACCOUNT_SQL = """WITH ac AS (SELECT c_custkey AS account, c_acctbal AS value, c_custkey % 3 <> 0 AS usable FROM customer),
tp AS (SELECT * FROM ac WHERE usable ORDER BY value DESC, account LIMIT 100),
ed AS (SELECT value AS v, account AS a FROM tp ORDER BY value, account DESC LIMIT 1),
sm AS (SELECT ac.* FROM ac, ed WHERE value > v OR (value = v AND account <= a)),
ps AS (SELECT o_custkey AS account, 'S' || (o_orderkey % 20) AS symbol,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'long' ELSE 'short' END AS side, o_totalprice AS notional,
    1 + o_orderkey % 20 AS leverage, o_orderkey % 4 AS part FROM orders)
"""


def accounts(spark, sf_dir):
    return bridge.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("account"),
        F.col("c_acctbal").alias("value"),
        (F.col("c_custkey") % 3 != 0).alias("usable"),
    )


def positions(spark, sf_dir):
    return bridge.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("account"),
        F.concat(F.lit("S"), (F.col("o_orderkey") % 20).cast("string")).alias("symbol"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "long").otherwise("short").alias("side"),
        F.col("o_totalprice").alias("notional"),
        (1 + F.col("o_orderkey") % 20).alias("leverage"),
        (F.col("o_orderkey") % 4).alias("part"),
        "o_orderkey",
    )


@query("p14_large_account_sample", ACCOUNT_SQL + "SELECT account, round(value, 6) AS value, usable FROM sm")
def p14(spark, sf_dir):
    return A.sample(accounts(spark, sf_dir)).select("account", r6("value"), "usable")


@query(
    "p15_five_boards",
    ACCOUNT_SQL + """, nw AS (SELECT * FROM ps SEMI JOIN sm USING (account) WHERE part < 2),
er AS (SELECT * FROM ps SEMI JOIN sm USING (account) WHERE part = 2),
lq AS (SELECT * FROM ps SEMI JOIN sm USING (account) WHERE part = 3),
t AS (SELECT sum(notional) FILTER (side = 'long') / sum(notional) AS ls, sum(CASE side WHEN 'long' THEN notional ELSE -notional END) AS net,
  avg(leverage) AS lev, count(DISTINCT account) AS n FROM nw),
al AS (SELECT 'long_share' AS board, NULL AS item, ls * 10000 AS value, n FROM t
UNION ALL SELECT 'net_change', NULL, net - (SELECT sum(CASE side WHEN 'long' THEN notional ELSE -notional END) FROM er), n FROM t
UNION ALL SELECT 'mean_leverage', NULL, lev * 100, n FROM t
UNION ALL (SELECT 'most_concentrated_coin', symbol, sum(notional) AS s, count(DISTINCT account) FROM nw GROUP BY symbol ORDER BY s DESC, symbol LIMIT 1)
UNION ALL SELECT 'observed_liquidations', 'lower_bound', sum(notional), count(*) FROM lq)
SELECT board, item, round(value, 2) AS value, n FROM al""",
)
def p15(spark, sf_dir):
    p = positions(spark, sf_dir)
    boards = A.boards(
        p.filter("part < 2"), p.filter("part = 2"), p.filter("part = 3"), A.sample(accounts(spark, sf_dir))
    )
    scale = F.when(F.col("board") == "long_share", 10000).when(F.col("board") == "mean_leverage", 100).otherwise(1)
    return boards.select("board", "item", r2(F.col("value") * scale, "value"), "n")


@query(
    "p16_address_pages",
    ACCOUNT_SQL + """, sh AS (SELECT account FROM sm WHERE account % 10 <> 0),
fl AS (SELECT o_custkey AS account, l_extendedprice - 40000 AS realized, l_linenumber IN (1, 2) AS forced
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
h AS (SELECT account, count(*) AS open_positions, sum(notional) AS open_notional FROM ps GROUP BY account),
r AS (SELECT account, count(*) AS n, count(*) FILTER (forced) AS forced_fills, quantile_cont(realized, 0.5) AS md, quantile_cont(realized, 0.25) AS lo, quantile_cont(realized, 0.75) AS hi,
  count(*) FILTER (realized > 0) AS gains FROM fl GROUP BY account)
SELECT account, coalesce(open_positions, 0) AS open_positions, round(coalesce(open_notional, 0), 2) AS open_notional,
  coalesce(n, 0) AS n, coalesce(forced_fills, 0) AS forced_fills, round(CASE WHEN n >= 10 THEN md END, 4) AS median_realized, round(CASE WHEN n >= 10 THEN lo END, 5) AS p25_realized, round(CASE WHEN n >= 10 THEN hi END, 5) AS p75_realized,
  round(CASE WHEN n >= 30 THEN gains / n::DOUBLE END, 6) AS gain_share
FROM sh LEFT JOIN h USING (account) LEFT JOIN r USING (account)""",
)
def p16(spark, sf_dir):
    lines = bridge.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    owners = bridge.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("account")
    )
    fill = (
        F.when(F.col("l_linenumber") == 1, '{"px":"1","liquidation":null}')
        .when(F.col("l_linenumber") == 2, '{"px":"1","liquidation":{"method":"market"}}')
        .otherwise('{"px":"1","hash":"0x0"}')
    )
    fills = lines.join(owners, "l_orderkey").select(
        "account", (F.col("l_extendedprice") - 40_000).alias("realized"), fill.alias("fill")
    )
    everyone = accounts(spark, sf_dir)
    pages = A.address_pages(
        positions(spark, sf_dir), fills, A.sample(everyone), everyone.filter("account % 10 = 0")
    )
    return pages.select(
        "account", "open_positions", r2("open_notional"), "n", "forced_fills", F.round("median_realized", 4).alias("median_realized"), F.round("p25_realized", 5).alias("p25_realized"), F.round("p75_realized", 5).alias("p75_realized"), r6("gain_share")
    )


@query(
    "p22_liquidation_price_ranges",
    ACCOUNT_SQL + """, e AS (SELECT *, 100 + o_orderkey % 37::DOUBLE AS entry, 100 + o_orderkey % 20 AS mark, 5 + o_orderkey % 20 * 5 AS ml
  FROM (SELECT *, o_orderkey % 20 AS sn FROM orders)),
p AS (SELECT 'S' || sn AS symbol, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'long' ELSE 'short' END AS side, o_totalprice AS notional,
  entry, mark, 1 / (1 + sn)::DOUBLE - 1 / (2 * ml)::DOUBLE AS margin FROM e),
b AS (SELECT symbol, side, CAST(floor(CASE side WHEN 'long' THEN entry * (1 - margin) ELSE entry * (1 + margin) END / (mark * 1.0::DOUBLE / 100)) AS BIGINT) AS bucket, notional FROM p)
SELECT symbol, side, bucket, round(sum(notional), 2) AS notional, count(*) AS positions, 'model_estimate' AS label FROM b GROUP BY ALL""",
)
def p22(spark, sf_dir):
    sn = F.col("o_orderkey") % 20
    held = positions(spark, sf_dir).select(
        "symbol",
        "side",
        "notional",
        "leverage",
        (100 + F.col("o_orderkey") % 37).cast("double").alias("entry_px"),
        (100 + sn).alias("mark"),
        (5 + sn * 5).alias("max_leverage"),
    )
    return A.liquidation_ranges(held).select("symbol", "side", "bucket", r2("notional"), "positions", "label")


# -- statistics ----------------------------------------------------------------------
@query(
    "p18_state_episodes",
    B.with_ctes(*B.market_ctes(), MARKET_POINTS) + """, lm AS (SELECT scope, metric, quantile_cont(value, 0.6) AS lim FROM mpt WHERE value IS NOT NULL GROUP BY ALL),
ab AS (SELECT scope, metric, ts, ts - 60000 * row_number() OVER (PARTITION BY scope, metric ORDER BY ts) AS g
  FROM mpt JOIN lm USING (scope, metric) WHERE value > lim)
SELECT scope, metric, min(ts) AS from_ms, count(*) AS minutes FROM ab GROUP BY scope, metric, g HAVING count(*) >= 2""",
)
def p18(spark, sf_dir):
    points = D.market_points(market(spark, sf_dir), POINT_COLUMNS)
    return R.state_episodes(points, 2, 0.6)


@query(
    "p20_false_discovery_control",
    EVC + """, t AS (SELECT event_type AS family, user_id AS test_id, (sum(event_id) % 997 + 0.5)::DOUBLE / 1000 AS p FROM ev GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY p, test_id) AS rank, count(*) OVER (PARTITION BY family) AS m FROM t),
a AS (SELECT *, least(1.0, min(p * m / rank) OVER (PARTITION BY family ORDER BY rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS adj FROM r)
SELECT family, test_id, round(p, 6) AS p, rank, round(adj, 6) AS p_adjusted, adj <= 0.05 AS significant FROM a""",
)
def p20(spark, sf_dir):
    tests = bridge.events(spark, sf_dir).groupBy(
        F.col("event_type").alias("family"), F.col("user_id").alias("test_id")
    ).agg(((F.sum("event_id") % 997 + F.lit(0.5)) / 1000).alias("p"))
    return R.benjamini_hochberg(tests).select(
        "family", "test_id", r6("p"), "rank", r6("p_adjusted"), "significant"
    )


WEIGHT = " + ".join(f"(u >= {t})::INT" for t in R.poisson_thresholds())


@query(
    "p21_block_bootstrap",
    EVC + f""", b AS (SELECT symbol AS grp, event_id // 50 AS b, sum(px) AS s, count(*) AS c FROM ev GROUP BY ALL),
u AS (SELECT grp, s, c, r, list_sum([(strpos('0123456789abcdef', substr(h, k, 1)) - 1) * (16 ** (6 - k))::BIGINT FOR k IN [1, 2, 3, 4, 5, 6]]) AS u
  FROM (SELECT *, md5('1|' || grp || '|' || r || '|' || b) AS h FROM b, (SELECT unnest(generate_series(1, 200)) AS r))),
w AS (SELECT *, {WEIGHT} AS w FROM u),
m AS (SELECT grp, r, sum(CAST(s AS DOUBLE) * w) / sum(c * w) AS mean FROM w WHERE w > 0 GROUP BY ALL)
SELECT grp, count(*) AS replicates, round(quantile_cont(mean, 0.025), 6) AS low, round(quantile_cont(mean, 0.975), 6) AS high FROM m GROUP BY grp""",
)
def p21(spark, sf_dir):
    series = bridge.events(spark, sf_dir).select(
        F.col("symbol").alias("grp"), F.col("event_id").alias("i"), F.col("px").cast("double").alias("value")
    )
    return R.block_bootstrap(spark, series, 50, 200).select("grp", "replicates", r6("low"), r6("high"))


@query(
    "t7_alert_cooldown",
    B.with_ctes(B.EV) + """, c AS (SELECT DISTINCT 'u' || user_id AS rule, obs_ms // 60000 * 60000 AS at_ms FROM ev),
s AS (SELECT rule, min(at_ms) AS at_ms FROM c GROUP BY rule
  UNION ALL SELECT s.rule, (SELECT min(c.at_ms) FROM c WHERE c.rule = s.rule AND c.at_ms >= s.at_ms + 1800000) FROM s
  WHERE (SELECT min(c.at_ms) FROM c WHERE c.rule = s.rule AND c.at_ms >= s.at_ms + 1800000) IS NOT NULL)
SELECT rule, at_ms FROM s""",
)
def t7(spark, sf_dir):
    candidates = bridge.events(spark, sf_dir).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("rule"), F.col("obs_ms").alias("at_ms")
    )
    return R.cooled_down(candidates)


# -- landed files and streams ----------------------------------------------------------
def _folder(spark, name):
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _landed(spark, raw, name):
    path = _folder(spark, name)
    raw.write.json(path)
    return path


def _twin(name):
    return normalize.sql[name]


@query("s1_landed_documents", _twin("n3_mark_index_funding_snapshot"))
def s1(spark, sf_dir):
    path = _landed(spark, P.premium_index(spark, sf_dir), "documents")
    raw = landed.read_documents(spark, path)
    return stage_out(NB.premium_index(raw, P.dimension(spark, sf_dir)))


def _lane(spark, sf_dir, frames, name, lane):
    path = _landed(spark, frames.repartition(4), name)
    store = MinuteStore(spark, _folder(spark, "store"))
    stream = landed.stream_frames(spark, path, max_files_per_trigger=2)
    lane(
        stream, P.dimension(spark, sf_dir), store, _folder(spark, "progress"), available_now=True
    ).awaitTermination()
    return market_out(store.read(bridge.segments(spark, sf_dir)))


def _lane_sql(name):
    """The minute table after the lane's records, newest observation per minute."""
    return f"""WITH rec AS ({_twin(name)}),
w AS (SELECT *, ts_ms - ts_ms % 60000 AS minute FROM rec
  QUALIFY row_number() OVER (PARTITION BY venue, symbol, ts_ms // 60000 ORDER BY ts_ms DESC, ingest_ms DESC) = 1)
SELECT venue, symbol, minute AS ts_ms, obs_fast_ms, obs_slow_ms, next_funding_ms, ingest_ms, funding_interval_h,
  CAST(60 AS BIGINT) AS grid_s, backfilled, semantic, source, mark, index_px, premium, funding_rate,
  CAST(NULL AS DOUBLE) AS oi_base, CAST(NULL AS DOUBLE) AS oi_usd, CAST(NULL AS DOUBLE) AS vol24h_usd, CAST(NULL AS DOUBLE) AS chg24h_pct FROM w"""


@query("t1_mark_price_stream", _lane_sql("n4_streamed_mark_frames"))
def t1(spark, sf_dir):
    """Frames in files (both envelope forms) through the stream into the minute table."""
    return _lane(spark, sf_dir, P.ws_mark_price(spark, sf_dir), "mark-frames", lanes.mark_price_lane)


def _quarantine_lane(spark, sf_dir):
    """Sound and faulty frames mixed in files, read in several batches."""
    frames = P.ws_mark_price(spark, sf_dir).unionByName(P.bad_mark_frames(spark, sf_dir))
    path = _landed(spark, frames.repartition(6), "mixed-frames")
    store, refused = MinuteStore(spark, _folder(spark, "store")), _folder(spark, "quarantine")
    stream = landed.stream_frames(spark, path, max_files_per_trigger=2)
    quarantine.price_lane(
        stream, P.dimension(spark, sf_dir), store, refused, _folder(spark, "progress"), "mark", available_now=True
    ).awaitTermination()
    return store, refused


@query("t1_stream_among_faulty_frames", _lane_sql("n4_streamed_mark_frames"))
def t1_faulty(spark, sf_dir):
    """The sound rows land as if no faulty frame had come."""
    store, _ = _quarantine_lane(spark, sf_dir)
    return market_out(store.read(bridge.segments(spark, sf_dir)))


@query(
    "n19_quarantine_of_a_stream",
    EVC + """SELECT max(obs_ms) AS observed_ms, ['frame_unreadable','name_missing','instant_unreadable',
  'number_unreadable','mark_is_not_negative'][event_id // 50 % 5 + 1] AS reasons
FROM ev WHERE venue = 'binance' AND event_type = 'view' GROUP BY event_id // 50""",
)
def n19_stream(spark, sf_dir):
    _, refused = _quarantine_lane(spark, sf_dir)
    return quarantine.quarantined(spark, refused).select("observed_ms", F.array_join("reasons", ",").alias("reasons"))


@query("t2_mid_price_stream", _lane_sql("n17_all_mids_frames"))
def t2(spark, sf_dir):
    return _lane(spark, sf_dir, P.ws_all_mids(spark, sf_dir), "mid-frames", lanes.mid_price_lane)


@query("t3_liquidation_stream", _twin("l1_liquidation_rows"))
def t3(spark, sf_dir):
    """Unsorted frames in many files and batches, a part of them landed twice."""
    frames = P.force_order(spark, sf_dir)
    again = frames.where(F.pmod(F.xxhash64("payload"), F.lit(3)) == 0)
    path = _landed(spark, frames.unionByName(again).repartition(8), "order-frames")
    out = _folder(spark, "liquidations")
    stream = landed.stream_frames(spark, path, max_files_per_trigger=2)
    lanes.liquidation_lane(
        stream, P.dimension(spark, sf_dir), out, _folder(spark, "progress"), available_now=True
    ).awaitTermination()
    return liquidation_out(lanes.liquidation_table(spark, out))


@query(
    "t1_t2_two_lanes_one_store",
    f"SELECT * FROM ({_lane_sql('n4_streamed_mark_frames')}) UNION ALL SELECT * FROM ({_lane_sql('n17_all_mids_frames')})",
)
def t1_t2(spark, sf_dir):
    """Both price streams into one store, each with its own batch numbers."""
    dim, store = P.dimension(spark, sf_dir), MinuteStore(spark, _folder(spark, "store"))
    for number, (lane, frames) in enumerate(
        ((lanes.mark_price_lane, P.ws_mark_price(spark, sf_dir)), (lanes.mid_price_lane, P.ws_all_mids(spark, sf_dir)))
    ):
        path = _landed(spark, frames.repartition(4), "lane-frames")
        stream = landed.stream_frames(spark, path, max_files_per_trigger=2)
        lane(stream, dim, store, _folder(spark, "progress"), available_now=True, lane=number).awaitTermination()
    return market_out(store.read(bridge.segments(spark, sf_dir)))


SQL_S2 = EVC + """SELECT count(DISTINCT event_id // 50) AS frames, count(*) AS entries FROM ev WHERE venue = 'binance' AND event_type = 'view'"""


@query("s2_binance_frames_both_envelopes", SQL_S2)
def s2(spark, sf_dir):
    frames = NB.unwrap_frames(
        spark.read.schema("venue string, endpoint string, request_symbol string, interval string, "
                          "observed_ms bigint, ingest_ms bigint, payload string")
        .json(_landed(spark, P.ws_mark_price(spark, sf_dir), "frames"))
    )
    return frames.agg(
        F.count("*").alias("frames"),
        F.sum(F.json_array_length("payload")).cast("bigint").alias("entries"),
    )


@query(
    "s3_channel_filter",
    EVC + """SELECT count(*) AS frames FROM ev WHERE venue = 'hyperliquid' AND event_type = 'click' AND event_id % 7 <> 0""",
)
def s3(spark, sf_dir):
    return NH.channel_frames(P.ws_all_mids(spark, sf_dir), "allMids").agg(F.count("*").alias("frames"))
