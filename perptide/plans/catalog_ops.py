"""Queries over usage, throttling, gaps, availability, health, storage and export."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from perptide.functions import costs
from perptide.functions import scalars as C
from perptide.operators import capability as K
from perptide.operators import gaps as G
from perptide.operators import health as H
from perptide.operators import liquidations as L
from perptide.operators import usage as U
from perptide.plans import bridge
from perptide.plans import bridge_sql as B
from perptide.plans import payloads as P
from perptide.plans.catalog_metrics import UNIVERSE
from perptide.plans.common import big, market, r6
from perptide.plans.registry import Registry
from perptide.session import checkpoint_dir
from perptide.sources import export, minute_store, partitions
from perptide.sources.materialize import materialized

query = Registry()
T0 = bridge.T0
HOUR = bridge.HOUR
END = T0 + 12 * HOUR
EVC = B.with_ctes(B.EV)
PRIORITY_SQL = """CASE WHEN event_type IN ('click','view') THEN 'fast_lane' WHEN event_type = 'purchase'
  THEN 'resident' ELSE 'opportunistic' END"""
LOG_SQL = f""", log AS (
  SELECT event_id, venue, 'b' || user_id % 2 AS bucket, obs_ms AS at_ms, 1 + event_id % 20 AS cost,
    {PRIORITY_SQL} AS priority,
    CASE WHEN event_id % 499 = 0 THEN 418 WHEN event_id % 97 = 0 THEN 429 ELSE 200 END AS status,
    ['120', 'Wed, 21 Oct 2026 07:28:00 GMT', NULL, ' 600 '][event_id % 4 + 1] AS retry_after,
    [' null ', '<html>', 'slow down', NULL][event_id % 4 + 1] AS body FROM ev)
"""


def pick(values, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def request_log(spark, sf_dir):
    eid = F.col("event_id")
    return bridge.events(spark, sf_dir).select(
        "event_id",
        "user_id",
        "venue",
        F.concat(F.lit("b"), (F.col("user_id") % 2).cast("string")).alias("bucket"),
        F.col("obs_ms").alias("at_ms"),
        (1 + eid % 20).alias("cost"),
        F.when(F.col("event_type").isin("click", "view"), "fast_lane")
        .when(F.col("event_type") == "purchase", "resident")
        .otherwise("opportunistic")
        .alias("priority"),
        F.when(eid % 499 == 0, 418).when(eid % 97 == 0, 429).otherwise(200).alias("status"),
        pick(["120", "Wed, 21 Oct 2026 07:28:00 GMT", None, " 600 "], eid % 4).alias("retry_after"),
        pick([" null ", "<html>", "slow down", None], eid % 4).alias("body"),
    )


SPEND_SQL = EVC + LOG_SQL + """, sp AS (
  SELECT DISTINCT venue, bucket, at_ms, CAST(sum(cost) OVER w AS BIGINT) AS used,
    CAST(coalesce(sum(cost) FILTER (priority = 'fast_lane') OVER w, 0) AS BIGINT) AS used_fast_lane,
    CAST(coalesce(sum(cost) FILTER (priority = 'resident') OVER w, 0) AS BIGINT) AS used_resident,
    CAST(coalesce(sum(cost) FILTER (priority = 'opportunistic') OVER w, 0) AS BIGINT) AS used_opportunistic
  FROM log WINDOW w AS (PARTITION BY venue, bucket ORDER BY at_ms RANGE BETWEEN 59999 PRECEDING AND CURRENT ROW))
"""


@query("a4_rolling_spend", SPEND_SQL + "SELECT * FROM sp")
def a4(spark, sf_dir):
    return U.rolling_spend(request_log(spark, sf_dir))


def budgets(log):
    fast = F.col("bucket") == "b0"
    return log.select("venue", "bucket").distinct().select(
        "venue",
        "bucket",
        F.when(fast, 960).otherwise(76).alias("ceiling"),
        F.when(fast, 960).otherwise(80).alias("egress_ceiling"),
        F.when(fast, 300).otherwise(60).alias("reserve"),
        F.when(fast, 200).otherwise(16).alias("hard_cap"),
    )


@query(
    "a5_opportunistic_availability",
    SPEND_SQL + """
SELECT venue, bucket, at_ms, used_fast_lane + used_resident AS resident_used,
  CAST(least(greatest(0, (CASE WHEN bucket = 'b0' THEN 960 ELSE 76 END) -
    greatest(CASE WHEN bucket = 'b0' THEN 300 ELSE 60 END, used_fast_lane + used_resident)),
    CASE WHEN bucket = 'b0' THEN 200 ELSE 16 END) AS BIGINT) AS available FROM sp""",
)
def a5(spark, sf_dir):
    log = request_log(spark, sf_dir)
    return U.opportunistic_available(U.rolling_spend(log), materialized(budgets(log))).select(
        "venue", "bucket", "at_ms", "resident_used", big("available")
    )


SOCKET_SQL = """, iv AS (SELECT venue, obs_ms AS o, obs_ms + event_id % 600 * 1000 AS c, 1 + event_id % 3 AS streams,
    'u' || user_id % 20 AS user FROM ev WHERE event_type = 'click'),
sk AS (SELECT venue, o AS at_ms, 1 AS d, streams, user FROM iv
  UNION ALL SELECT venue, c, -1, streams, user FROM iv)
"""


def sockets(spark, sf_dir):
    base = bridge.events(spark, sf_dir).filter("event_type = 'click'")
    closing = F.col("obs_ms") + F.col("event_id") % 600 * 1000
    return base.select(
        "venue",
        (1 + F.col("event_id") % 3).alias("streams"),
        F.concat(F.lit("u"), (F.col("user_id") % 20).cast("string")).alias("user"),
        F.inline(
            F.array(
                F.struct(F.lit("open").alias("event"), F.col("obs_ms").alias("at_ms")),
                F.struct(F.lit("close").alias("event"), closing.alias("at_ms")),
            )
        ),
    )


@query(
    "a6_connection_usage",
    EVC + SOCKET_SQL + """, t AS (SELECT DISTINCT venue, at_ms,
    CAST(coalesce(sum(1) FILTER (d = 1) OVER r, 0) AS BIGINT) AS opened_in_window,
    CAST(sum(d) OVER c AS BIGINT) AS open_connections, CAST(sum(d * streams) OVER c AS BIGINT) AS subscriptions
  FROM sk WINDOW r AS (PARTITION BY venue ORDER BY at_ms RANGE BETWEEN 299999 PRECEDING AND CURRENT ROW),
    c AS (PARTITION BY venue ORDER BY at_ms RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT *, opened_in_window > 12 AS rate_violated, open_connections > 10 AS seats_violated,
  subscriptions > 1000 AS streams_violated FROM t""",
)
def a6(spark, sf_dir):
    caps = bridge.events(spark, sf_dir).select("venue").distinct().select(
        "venue",
        F.lit(12).alias("max_new_connections"),
        F.lit(10).alias("max_connections"),
        F.lit(1000).alias("max_subscriptions"),
    )
    return U.connection_usage(sockets(spark, sf_dir), materialized(caps))


@query(
    "a6_distinct_users",
    EVC + SOCKET_SQL + """, t AS (SELECT DISTINCT venue, at_ms FROM sk)
SELECT venue, at_ms, (SELECT count(DISTINCT user) FROM iv WHERE iv.venue = t.venue AND o <= at_ms AND c > at_ms)
  AS distinct_users FROM t""",
)
def a6_users(spark, sf_dir):
    return U.distinct_users(sockets(spark, sf_dir))


@query(
    "a7_budget_reconciliation",
    EVC + """, l AS (SELECT venue, 'b' || user_id % 2 AS bucket, 'k' || user_id % 4 AS consumer, user_id % 4 AS kn,
    1 + event_id % 20 AS cost FROM ev),
rv AS (SELECT venue, bucket, consumer, CASE WHEN kn = 2 THEN 0 ELSE count(*) % 30 END AS reserved,
    CASE WHEN kn < 2 THEN max(cost) END AS observed_max, CASE WHEN kn = 1 THEN max(cost) * 3 END AS self_cap,
    kn = 2 AS assertion FROM l GROUP BY venue, bucket, consumer, kn),
b AS (SELECT *, CASE WHEN bucket = 'b0' THEN 960 ELSE 80 END AS ec, CASE WHEN bucket = 'b0' THEN 500 ELSE 76 END AS tog FROM rv),
g AS (SELECT venue, bucket, ec, tog, CAST(sum(reserved) AS BIGINT) AS reserved,
    CAST(sum(coalesce(greatest(observed_max, self_cap), reserved)) AS BIGINT) AS others_worst,
    count(*) FILTER (observed_max IS NULL AND self_cap IS NULL AND NOT (reserved = 0 AND assertion)) AS unm,
    count(*) FILTER (observed_max > ec OR self_cap > ec) AS crossed FROM b GROUP BY ALL)
SELECT venue, bucket, reserved, ec - reserved AS our_ceiling, others_worst, others_worst + tog AS together,
  CASE WHEN crossed > 0 THEN 'yellow' WHEN unm > 0 THEN 'unknown' WHEN others_worst + tog > ec THEN 'yellow'
    ELSE 'green' END AS verdict FROM g""",
)
def a7(spark, sf_dir):
    log = request_log(spark, sf_dir)
    kn = F.col("user_id") % 4
    reservations = (
        log.groupBy("venue", "bucket", kn.alias("kn"))
        .agg(F.count("*").alias("n"), F.max("cost").alias("top"))
        .select(
            "venue",
            "bucket",
            F.concat(F.lit("k"), F.col("kn").cast("string")).alias("consumer"),
            F.when(F.col("kn") == 2, 0).otherwise(F.col("n") % 30).alias("reserved"),
            F.when(F.col("kn") < 2, F.col("top")).alias("observed_max"),
            F.when(F.col("kn") == 1, F.col("top") * 3).alias("self_cap"),
            (F.col("kn") == 2).alias("assertion"),
        )
    )
    return U.reconcile_budgets(reservations, budgets(log))


@query(
    "a8_usage_profile",
    EVC + LOG_SQL + """, m AS (SELECT venue, bucket, at_ms // 60000 AS m, sum(cost) AS s FROM log GROUP BY ALL),
b AS (SELECT venue, bucket, min(m) AS lo, max(m) AS hi FROM m GROUP BY ALL),
l AS (SELECT venue, bucket, unnest(generate_series(lo, hi)) AS m FROM b),
f AS (SELECT venue, bucket, coalesce(s, 0) AS s FROM l LEFT JOIN m USING (venue, bucket, m))
SELECT venue, bucket, round(quantile_cont(CAST(s AS DOUBLE), 0.5), 6) AS p50,
  round(quantile_cont(CAST(s AS DOUBLE), 0.95), 6) AS p95, CAST(max(s) AS BIGINT) AS max_spend,
  count(*) AS minutes FROM f GROUP BY ALL""",
)
def a8(spark, sf_dir):
    return U.usage_profile(request_log(spark, sf_dir)).select(
        "venue", "bucket", r6("p50"), r6("p95"), "max_spend", "minutes"
    )


THROTTLE_CTE = """
th AS (
  SELECT venue, bucket, at_ms, status, body, CASE WHEN status = 418 THEN 'ip_ban' ELSE 'rate_limit' END AS cause,
    CASE WHEN status = 418 THEN at_ms + CAST(coalesce(TRY_CAST(trim(retry_after) AS DOUBLE) * 1000, 259200000) AS BIGINT) END AS halt,
    status = 418 OR venue = 'hyperliquid' AS notify
  FROM log WHERE status IN (418, 429)),
th2 AS (SELECT *, greatest(coalesce(halt, 0), at_ms + 3600000) AS frozen FROM th)
"""
THROTTLE_SQL = EVC + LOG_SQL + "," + THROTTLE_CTE


@query(
    "a9_throttle_intervals",
    THROTTLE_SQL + """, s AS (SELECT venue, 'opportunistic' AS tier, at_ms, frozen AS e FROM th2
  UNION ALL SELECT venue, 'all', at_ms, halt FROM th2 WHERE halt IS NOT NULL),
a AS (SELECT *, max(e) OVER (PARTITION BY venue, tier ORDER BY at_ms, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM s),
g AS (SELECT *, sum(CASE WHEN r IS NULL OR at_ms > r THEN 1 ELSE 0 END) OVER (PARTITION BY venue, tier ORDER BY at_ms, e) AS k FROM a)
SELECT venue, tier, min(at_ms) AS span_from_ms, max(e) AS span_to_ms, count(*) AS events FROM g GROUP BY venue, tier, k""",
)
def a9(spark, sf_dir):
    return U.throttle_intervals(request_log(spark, sf_dir))


@query(
    "a10_throttle_gap_rows",
    THROTTLE_SQL + "SELECT venue, bucket, at_ms AS from_ms, coalesce(halt, frozen) AS to_ms, cause, notify FROM th2",
)
def a10(spark, sf_dir):
    return U.throttle_gaps(request_log(spark, sf_dir))


@query(
    "c13_limit_body_class",
    THROTTLE_SQL + """SELECT venue, at_ms, CASE WHEN lower(trim(body)) = 'null' THEN 'weight'
  WHEN starts_with(trim(body), '<') THEN 'connection' ELSE 'unrecognized' END AS body_class FROM th2 WHERE status = 429""",
)
def c13(spark, sf_dir):
    return U.throttle_events(request_log(spark, sf_dir)).filter("cause = 'rate_limit'").select(
        "venue", "at_ms", "body_class"
    )


METRICS = ("mark", "oi_base")
GAP_CTE = f"""
lat AS (SELECT unnest(generate_series({T0}, {END - 60000}, 60000)) AS m),
ex AS (SELECT m, (SELECT count(*) FROM universe u WHERE u.in_from <= m AND (u.in_to IS NULL OR u.in_to > m)) AS expected FROM lat),
ml AS (SELECT * FROM market m WHERE EXISTS (SELECT 1 FROM universe u
  WHERE u.symbol = m.symbol AND u.in_from <= m.ts AND (u.in_to IS NULL OR u.in_to > m.ts))),
pr AS (SELECT venue, ts AS m, 'mark' AS metric, count(mark) AS present FROM ml GROUP BY ALL
  UNION ALL SELECT venue, ts, 'oi_base', count(oi_base) FROM ml GROUP BY ALL),
st AS (SELECT venue, metric, m, expected, coalesce(present, 0) AS present FROM (
    SELECT * FROM ex, (SELECT unnest(['binance','hyperliquid']) AS venue), (SELECT unnest(['mark','oi_base']) AS metric)) v
  LEFT JOIN pr USING (venue, metric, m)),
df AS (SELECT *, m - 60000 * row_number() OVER (PARTITION BY venue, metric ORDER BY m) AS g FROM st WHERE present < expected),
gp AS (SELECT venue, metric, min(m) AS from_ms, max(m) + 60000 AS to_ms, count(*) AS minutes,
    max(expected) AS symbols_expected, min(present) AS symbols_present FROM df GROUP BY venue, metric, g)"""
GAPS = [*B.market_ctes(), UNIVERSE, GAP_CTE]
CAUSED = [*GAPS, LOG_SQL.removeprefix(", "), THROTTLE_CTE]


def status(spark, sf_dir):
    """The minute lattice of the universe: as many rows as minutes, not as records."""
    def build():
        spells = bridge.stored(
            spark, sf_dir, "universe", lambda: L.universe(P.lists(spark, sf_dir))
        )
        expected = G.expected_per_minute(spark, spells, T0, END)
        listed = G.among_listed(market(spark, sf_dir), spells, T0, END)
        return G.minute_status(expected, listed, METRICS)

    return bridge.stored(spark, sf_dir, "status", build)


@query(
    "g1_minute_gaps",
    B.with_ctes(*GAPS) + "SELECT *, 'unknown' AS cause FROM gp",
)
def g1(spark, sf_dir):
    return _gap_out(G.gap_rows(status(spark, sf_dir)))


def _gap_out(df):
    return df.select(
        "venue", "metric", "from_ms", "to_ms", big("minutes"), big("symbols_expected"), big("symbols_present"), "cause"
    )


CAUSE_CTE = """
lg AS (SELECT venue, obs_ms AS f, obs_ms + 1000 * (1 + event_id % 3) AS t,
    ['power_loss','egress_down','rate_limit','ws_reconnect'][event_id // 50 % 4 + 1] AS cause
  FROM ev WHERE event_type = 'error'
  UNION ALL SELECT venue, at_ms, coalesce(halt, frozen), cause FROM th2),
rk AS (SELECT unnest(['power_loss','egress_down','ip_ban','rate_limit','ws_reconnect']) AS cause, unnest([0, 2, 4, 5, 6]) AS rank),
ga AS (SELECT gp.venue, gp.metric, gp.from_ms, gp.to_ms, gp.minutes, gp.symbols_expected, gp.symbols_present,
    coalesce(arg_min(lg.cause, rk.rank), 'unknown') AS cause
  FROM gp LEFT JOIN lg ON lg.venue = gp.venue AND lg.f < gp.to_ms AND lg.t > gp.from_ms LEFT JOIN rk ON rk.cause = lg.cause
  GROUP BY ALL)"""


def cause_intervals(spark, sf_dir):
    """What the operations log says, and the gaps that throttling owes."""
    eid = F.col("event_id")
    logged = bridge.events(spark, sf_dir).filter("event_type = 'error'").select(
        "venue",
        F.col("obs_ms").alias("from_ms"),
        (F.col("obs_ms") + 1000 * (1 + eid % 3)).alias("to_ms"),
        pick(["power_loss", "egress_down", "rate_limit", "ws_reconnect"], F.floor(eid / 50) % 4).alias("cause"),
    )
    throttled = U.throttle_gaps(request_log(spark, sf_dir)).select("venue", "from_ms", "to_ms", "cause")
    return logged.unionByName(throttled)


@query("g2_gap_causes", B.with_ctes(*CAUSED, CAUSE_CTE) + "SELECT * FROM ga")
def g2(spark, sf_dir):
    return _gap_out(G.attribute_causes(G.gap_rows(status(spark, sf_dir)), cause_intervals(spark, sf_dir)))


@query(
    "g3_availability",
    B.with_ctes(*CAUSED, CAUSE_CTE) + """, gm AS (
  SELECT venue, metric, cause IN ('power_loss','host_restart','egress_down','egress_change') AS ex,
    unnest(generate_series(from_ms, to_ms - 60000, 60000)) AS m FROM ga),
j AS (SELECT st.venue, st.metric, present < expected AS miss, coalesce(gm.ex, false) AS ex, gm.ex IS NOT NULL AS expl
  FROM st LEFT JOIN gm USING (venue, metric, m))
SELECT venue, metric, count(*) AS minutes, count(*) FILTER (miss) AS missing, count(*) FILTER (ex) AS excluded,
  round(1 - count(*) FILTER (miss AND NOT ex) / nullif(count(*) FILTER (NOT ex), 0)::DOUBLE, 6) AS availability_a,
  round(1 - count(*) FILTER (miss) / count(*)::DOUBLE, 6) AS availability_b,
  round(count(*) FILTER (miss AND expl) / nullif(count(*) FILTER (miss), 0)::DOUBLE, 6) AS explained_share
FROM j GROUP BY ALL""",
)
def g3(spark, sf_dir):
    minutes = status(spark, sf_dir)
    gaps = G.attribute_causes(G.gap_rows(minutes), cause_intervals(spark, sf_dir))
    return G.availability(minutes, gaps).select(
        "venue", "metric", "minutes", "missing", "excluded", r6("availability_a"), r6("availability_b"),
        r6("explained_share"),
    )


OUTCOME_SQL = EVC + f""", oc AS (SELECT venue, event_type AS capability,
    CASE WHEN user_id % 2 = 0 THEN 'rest' ELSE 'ws' END AS transport, {T0} + event_id * 1000 AS at_ms,
    event_id % 4 <> 0 AND NOT (symbol = 'C1' AND event_type = 'view' AND user_id % 2 = 0) AS ok, event_id % 900 AS latency_ms,
    'e' || event_id % 5 AS error_class FROM ev)
"""


def outcomes(spark, sf_dir):
    eid = F.col("event_id")
    dead = (F.col("symbol") == "C1") & (F.col("event_type") == "view") & (F.col("user_id") % 2 == 0)
    return bridge.events(spark, sf_dir).select(
        "venue",
        F.col("event_type").alias("capability"),
        F.when(F.col("user_id") % 2 == 0, "rest").otherwise("ws").alias("transport"),
        (F.lit(T0) + eid * 1000).alias("at_ms"),
        ((eid % 4 != 0) & ~dead).alias("ok"),
        (eid % 900).alias("latency_ms"),
        F.concat(F.lit("e"), (eid % 5).cast("string")).alias("error_class"),
    )


@query(
    "h1_source_health",
    OUTCOME_SQL + """, s AS (SELECT venue, capability, transport, max(at_ms) FILTER (ok) AS last_ok_ms,
    arg_max(latency_ms, at_ms) FILTER (ok) AS latency_ms, arg_max(error_class, at_ms) FILTER (NOT ok) AS last_error_class,
    arg_max(ok, at_ms) AS ok FROM oc GROUP BY ALL)
SELECT s.*, (SELECT count(*) FROM oc WHERE oc.venue = s.venue AND oc.capability = s.capability AND oc.transport = s.transport
  AND NOT oc.ok AND oc.at_ms > coalesce(s.last_ok_ms, 0)) AS consecutive_fail FROM s""",
)
def h1(spark, sf_dir):
    return H.source_health(outcomes(spark, sf_dir))


@query(
    "h2_run_summary",
    EVC + """SELECT event_type AS lane, count(*) AS rounds, CAST(sum(event_id % 360) AS BIGINT) AS rows_written,
  CAST(sum(event_id % 3) AS BIGINT) AS errors, CAST(sum(event_id % 5000) FILTER (event_id % 50 <> 0) AS BIGINT) AS duration_ms,
  max(event_id % 5000) FILTER (event_id % 50 <> 0) AS longest_ms, count(*) FILTER (event_id % 50 = 0) AS unfinished,
  count(*) FILTER (event_id % 50 <> 0 AND event_id % 7 = 0) AS failed FROM ev GROUP BY ALL""",
)
def h2(spark, sf_dir):
    eid = F.col("event_id")
    running = eid % 50 == 0
    runs = bridge.events(spark, sf_dir).select(
        F.col("event_type").alias("lane"),
        (eid % 360).alias("rows_written"),
        (eid % 3).alias("errors"),
        F.when(~running, eid % 5000).alias("duration_ms"),
        F.when(running, "running").when(eid % 7 == 0, "failed").otherwise("ok").alias("status"),
    )
    return H.run_summary(runs)


SHEET_VALUES = ", ".join(
    f"('{venue}', '{c}', {str(mode is not None).lower()}, "
    + (
        f"'{(K.STREAM_FAMILY if mode == 'push_stream' else K.REST_FAMILY)[venue]}')"
        if mode
        else "NULL)"
    )
    for venue, rows in (("binance", K.BINANCE_SHEET), ("hyperliquid", K.HYPERLIQUID_SHEET))
    for c, mode, _ in rows
)
NEED_VALUES = ", ".join(f"('{f}', '{v}', '{c}')" for f, needs in K.FEATURES.items() for v, c in needs)
MATRIX_SQL = EVC + f""", sheet(venue, capability, supported, family) AS (VALUES {SHEET_VALUES}),
need(feature, venue, capability) AS (VALUES {NEED_VALUES}),
oc AS (SELECT ['binance:fapi','hyperliquid:info','binance:ws_market'][event_id % 3 + 1] AS family, event_id,
    CASE WHEN event_id % 3 = 2 THEN 451 WHEN user_id % 10 = 0 THEN 503 ELSE 200 END AS code FROM ev),
lt AS (SELECT family, arg_max(code, event_id) AS code FROM oc GROUP BY family),
mx AS (SELECT s.*, CASE WHEN NOT supported THEN 'green' WHEN code IS NULL THEN 'unknown'
    WHEN code BETWEEN 200 AND 299 THEN 'green' ELSE 'red' END AS status,
  CASE WHEN NOT supported THEN 'not_published' WHEN code IS NULL THEN 'unknown' WHEN code BETWEEN 200 AND 299
    THEN 'available' WHEN code = 451 THEN 'restricted' ELSE 'unavailable' END AS availability
  FROM sheet s LEFT JOIN lt USING (family))
"""


def matrix(spark, sf_dir):
    log = bridge.events(spark, sf_dir).select(
        pick(["binance:fapi", "hyperliquid:info", "binance:ws_market"], F.col("event_id") % 3).alias("family"),
        F.col("event_id").alias("at_ms"),
        F.when(F.col("event_id") % 3 == 2, 451)
        .when(F.col("user_id") % 10 == 0, 503)
        .otherwise(200)
        .alias("status_code"),
        F.lit(None).cast("string").alias("error_class"),
        F.lit(1).alias("latency_ms"),
    )
    return K.availability_matrix(K.sheet(spark), log)


@query(
    "j8_availability_matrix",
    MATRIX_SQL + "SELECT venue, capability, supported, family, status, availability FROM mx",
)
def j8(spark, sf_dir):
    return matrix(spark, sf_dir).select("venue", "capability", "supported", "family", "status", "availability")


@query(
    "j8_feature_verdicts",
    MATRIX_SQL + """, w AS (SELECT feature, max(CASE coalesce(status, 'unknown') WHEN 'green' THEN 0 WHEN 'yellow' THEN 1
    WHEN 'unknown' THEN 2 ELSE 3 END) AS sev, bool_or(NOT supported) AS unpub FROM need LEFT JOIN mx USING (venue, capability) GROUP BY 1)
SELECT feature, ['green','yellow','unknown','red'][sev + 1] AS status,
  CASE WHEN sev = 0 AND NOT unpub THEN 'available' WHEN sev = 2 THEN 'unknown' ELSE 'unavailable' END AS verdict FROM w""",
)
def j8_features(spark, sf_dir):
    return K.feature_verdicts(K.feature_requirements(spark), matrix(spark, sf_dir))


# -- scalar rules over whole tables -------------------------------------------------
PREFIXES = ("", "1000", "1M", "10", "1000000", "100K", "1", "100")
NAMES_SQL = EVC + """, nm AS (SELECT event_id, event_id % 8 AS i, symbol,
  ['', '1000', '1M', '10', '1000000', '100K', '1', '100'][event_id % 8 + 1] || symbol AS base,
  ['k', 'm', 'K', '', 'kk', 'x', '1', 'k'][event_id % 8 + 1] || symbol AS coin FROM ev)
"""


def _names(spark, sf_dir):
    eid = F.col("event_id")
    return bridge.events(spark, sf_dir).select(
        "event_id",
        F.concat(pick(PREFIXES, eid % 8), "symbol").alias("base"),
        F.concat(pick(["k", "m", "K", "", "kk", "x", "1", "k"], eid % 8), "symbol").alias("coin"),
    )


@query(
    "c4_split_multiplier_binance",
    NAMES_SQL + """SELECT event_id, CASE WHEN i IN (1, 4, 7) THEN symbol WHEN i = 5 THEN 'K' || symbol ELSE base END AS unified,
  CAST([1, 1000, NULL, 1, 1000000, 100, 1, 100][i + 1] AS BIGINT) AS mult FROM nm""",
)
def c4(spark, sf_dir):
    return _names(spark, sf_dir).select(
        "event_id", C.binance_symbol(F.col("base")).alias("unified"), big(C.binance_mult(F.col("base")), "mult")
    )


@query(
    "c5_split_multiplier_hyperliquid",
    NAMES_SQL + """SELECT event_id, CASE WHEN i IN (0, 7) THEN symbol ELSE coin END AS unified,
  CAST([1000, NULL, 1, 1, 1, NULL, 1, 1000][i + 1] AS BIGINT) AS mult FROM nm""",
)
def c5(spark, sf_dir):
    return _names(spark, sf_dir).select(
        "event_id", C.hyperliquid_symbol(F.col("coin")).alias("unified"),
        big(C.hyperliquid_mult(F.col("coin")), "mult"),
    )


@query(
    "c1_decimal_text",
    EVC + """SELECT event_id, round(CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE CAST(px AS DOUBLE) END, 6) AS parsed FROM ev""",
)
def c1(spark, sf_dir):
    text = pick([None, "  ", "p", "s"], F.col("event_id") % 4)
    raw = F.when(text == "p", F.col("px").cast("string")).when(
        text == "s", F.concat(F.lit(" "), F.col("px").cast("string"), F.lit(" "))
    ).otherwise(text)
    return bridge.events(spark, sf_dir).select("event_id", r6(C.decimal_text(raw, "decimal(20,10)"), "parsed"))


@query(
    "c2_c3_instants_and_minutes",
    EVC + "SELECT event_id, raw_ms - raw_ms % 60000 AS minute_ms, strftime(make_timestamp(raw_ms * 1000), '%Y%m') AS month FROM ev",
)
def c2(spark, sf_dir):
    instant = C.epoch_ms(F.col("raw_ms"))
    return bridge.events(spark, sf_dir).select(
        "event_id", F.unix_millis(C.minute(instant)).alias("minute_ms"), C.month_of(instant).alias("month")
    )


@query(
    "c6_c7_units_and_taker_share",
    EVC + """, v AS (SELECT *, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 0 ELSE px END AS buy,
    CASE WHEN event_id % 7 = 0 THEN 0 ELSE event_id % 90 END AS sell,
    CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE 1000 END AS mult FROM ev)
SELECT event_id, round(CASE WHEN buy + sell > 0 THEN CAST(buy AS DOUBLE) / CAST(buy + sell AS DOUBLE) END + 1.234e-7, 6) AS share,
  round(CAST(px AS DOUBLE) * mult, 6) AS base_units FROM v""",
)
def c7(spark, sf_dir):
    # The offset keeps exact halves of the last digit away from the rounding step.
    eid = F.col("event_id")
    buy = F.when(eid % 5 == 0, F.lit(None)).when(eid % 7 == 0, 0).otherwise(F.col("px")).cast("decimal(24,10)")
    sell = F.when(eid % 7 == 0, 0).otherwise(eid % 90).cast("decimal(24,10)")
    mult = F.when(eid % 3 == 1, 1).when(eid % 3 == 2, 1000).cast("decimal(12,0)")
    return bridge.events(spark, sf_dir).select(
        "event_id", r6(C.taker_share(buy, sell).cast("double") + 1.234e-7, "share"), r6(C.to_base_units(F.col("px"), mult), "base_units")
    )


STATES = ("TRADING", "PENDING_TRADING", "SETTLING", "PRE_SETTLE", "DELIVERING", "PRE_DELIVERING", "CLOSE", "HALT")


@query(
    "c8_status_map",
    EVC + f"""SELECT event_id, ['trading','suspended','suspended','suspended','suspended','suspended','delisted',NULL]
  [event_id % 8 + 1] AS status FROM ev""",
)
def c8(spark, sf_dir):
    return bridge.events(spark, sf_dir).select(
        "event_id", C.contract_status(pick(STATES, F.col("event_id") % 8)).alias("status")
    )


@query(
    "c9_price_tick",
    EVC + "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 0.5 WHEN 1 THEN NULL ELSE 0.25 END::DOUBLE AS tick FROM ev",
)
def c9(spark, sf_dir):
    def f(kind, tick):
        return F.struct(F.lit(kind).alias("filterType"), F.lit(tick).alias("tickSize"))

    eid = F.col("event_id")
    filters = (
        F.when(eid % 3 == 0, F.array(f("LOT_SIZE", "9"), f("PRICE_FILTER", "0.5"), f("PRICE_FILTER", "7")))
        .when(eid % 3 == 1, F.array(f("LOT_SIZE", "9")))
        .otherwise(F.array(f("PRICE_FILTER", " 0.25 ")))
    )
    return bridge.events(spark, sf_dir).select("event_id", r6(C.price_tick(filters), "tick"))


@query(
    "c10_eight_hour_funding",
    B.with_ctes(B.EV, B.stage()) + """
SELECT event_id, round(CAST(funding_rate AS DOUBLE) * 8 / funding_interval_h * 10000, 6) AS rate_8h_e4 FROM stg""",
)
def c10(spark, sf_dir):
    rate = C.funding_8h(F.col("funding_rate"), F.col("funding_interval_h"))
    return bridge.stage(spark, sf_dir).select("event_id", r6(rate * 10000, "rate_8h_e4"))


@query(
    "c12_excluded_causes",
    EVC + """SELECT event_id, ['venue_error','power_loss','unknown','egress_change',NULL][event_id % 5 + 1] IN
  ('power_loss','host_restart','egress_down','egress_change') AS excluded FROM ev""",
)
def c12(spark, sf_dir):
    cause = pick(["venue_error", "power_loss", "unknown", "egress_change", None], F.col("event_id") % 5)
    return bridge.events(spark, sf_dir).select(
        "event_id", C.excluded_from_availability_a(cause).alias("excluded")
    )


CALLS = ("klines", "premium_index", "ticker_24h", "open_interest", "funding_info", "taker_long_short_ratio", "depth")
OTHER = ("candle_snapshot", "funding_history", "meta")


@query(
    "c14_request_costs",
    EVC + """, q AS (SELECT event_id, venue, CASE WHEN venue = 'binance' THEN ['klines','premium_index','ticker_24h',
    'open_interest','funding_info','taker_long_short_ratio','depth'][event_id // 2 % 7 + 1]
    ELSE ['candle_snapshot','funding_history','meta'][event_id // 2 % 3 + 1] END AS e,
  CASE WHEN user_id % 4 = 0 THEN NULL ELSE 1 + event_id % 1300 END AS rows, CASE WHEN user_id % 3 > 0 THEN user_id % 3 END AS symbols FROM ev)
SELECT event_id, CASE WHEN venue = 'hyperliquid' THEN 'info_weight' WHEN e = 'funding_info' THEN 'funding_rate'
  WHEN e = 'taker_long_short_ratio' THEN 'futures_data' ELSE 'fapi_weight' END AS bucket,
  CAST(CASE WHEN venue = 'hyperliquid' THEN CASE e WHEN 'candle_snapshot' THEN ceil(coalesce(rows, 500) / 60.0)
      WHEN 'funding_history' THEN ceil(coalesce(rows, 500) / 20.0) ELSE 20 END
    WHEN e = 'klines' THEN CASE WHEN coalesce(rows, 500) < 100 THEN 1 WHEN coalesce(rows, 500) < 500 THEN 2
      WHEN coalesce(rows, 500) <= 1000 THEN 5 ELSE 10 END
    WHEN e = 'premium_index' THEN CASE WHEN symbols IS NULL THEN 10 WHEN symbols = 1 THEN 1 END
    WHEN e = 'ticker_24h' THEN CASE WHEN symbols IS NULL THEN 40 WHEN symbols = 1 THEN 1 END
    WHEN e = 'depth' THEN NULL ELSE 1 END AS BIGINT) AS cost FROM q""",
)
def c14(spark, sf_dir):
    eid = F.col("event_id")
    half = F.floor(eid / 2)
    log = bridge.events(spark, sf_dir).select(
        "event_id",
        "venue",
        F.when(F.col("venue") == "binance", pick(CALLS, half % 7)).otherwise(pick(OTHER, half % 3)).alias("endpoint"),
        F.when(F.col("user_id") % 4 != 0, 1 + eid % 1300).alias("rows"),
        F.when(F.col("user_id") % 3 > 0, F.col("user_id") % 3).alias("symbols"),
    )
    return costs.annotate(log).select("event_id", "bucket", big("cost"))


@query(
    "c15_retry_after",
    EVC + LOG_SQL + "SELECT event_id, TRY_CAST(trim(retry_after) AS DOUBLE) AS seconds FROM log",
)
def c15(spark, sf_dir):
    return request_log(spark, sf_dir).select(
        "event_id", C.retry_after_seconds(F.col("retry_after")).alias("seconds")
    )


@query(
    "c16_scopes",
    EVC + """, s AS (SELECT event_id, ['binance','x','elsewhere'][event_id % 3 + 1] AS v,
    CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'c-1' ELSE symbol END AS y FROM ev)
SELECT event_id, v || ':' || coalesce(y, '*') AS scope, v <> 'elsewhere' AND coalesce(y, '*') <> 'c-1' AS valid,
  v AS scope_venue, y AS scope_symbol FROM s""",
)
def c16(spark, sf_dir):
    eid = F.col("event_id")
    symbol = F.when(eid % 5 == 0, F.lit(None)).when(eid % 7 == 0, "c-1").otherwise(F.col("symbol"))
    return (
        bridge.events(spark, sf_dir)
        .select("event_id", C.scope(pick(["binance", "x", "elsewhere"], eid % 3), symbol).alias("scope"))
        .select(
            "event_id",
            "scope",
            C.scope_is_valid(F.col("scope")).alias("valid"),
            C.scope_venue(F.col("scope")).alias("scope_venue"),
            C.scope_symbol(F.col("scope")).alias("scope_symbol"),
        )
    )


@query(
    "c17_weakest_provenance",
    EVC + """, p AS (SELECT 'f' || event_id // 3 AS figure, 1 + (event_id * 7 + user_id) % 3 AS s, event_id FROM ev),
q AS (SELECT figure, CASE event_id % 5 WHEN 0 THEN 'lower_bound' WHEN 1 THEN 'sample_limited' END AS q FROM p)
SELECT figure, ['unverified','measured','official'][min(s)] AS effective, count(*) AS inputs,
  coalesce((SELECT string_agg(q, ',' ORDER BY q) FROM (SELECT DISTINCT q FROM q WHERE q.figure = p.figure AND q IS NOT NULL)), '') AS qualifiers
FROM p GROUP BY figure""",
)
def c17(spark, sf_dir):
    eid = F.col("event_id")
    parts = bridge.events(spark, sf_dir).select(
        F.concat(F.lit("f"), F.floor(eid / 3).cast("string")).alias("figure"),
        pick(["unverified", "measured", "official"], (eid * 7 + F.col("user_id")) % 3).alias("tag"),
        F.when(eid % 5 == 0, F.array(F.lit("lower_bound")))
        .when(eid % 5 == 1, F.array(F.lit("sample_limited")))
        .otherwise(F.array().cast("array<string>"))
        .alias("qualifiers"),
    )
    return K.derived_provenance(parts).select(
        "figure", "effective", "inputs", F.array_join("qualifiers", ",").alias("qualifiers")
    )


@query(
    "c18_worst_status",
    EVC + """SELECT user_id, ['green','yellow','unknown','red'][max(CASE WHEN event_id % 211 = 0 THEN 3 WHEN event_id % 37 = 0 THEN 2
  WHEN event_id % 19 = 0 THEN 1 ELSE 0 END) + 1] AS status FROM ev GROUP BY user_id""",
)
def c18(spark, sf_dir):
    eid = F.col("event_id")
    status = F.when(eid % 211 == 0, "red").when(eid % 37 == 0, "unknown").when(eid % 19 == 0, "yellow").otherwise("green")
    return bridge.events(spark, sf_dir).groupBy("user_id").agg(C.worst_status(status).alias("status"))


# -- storage -------------------------------------------------------------------------
def ticks(spark, sf_dir):
    """lineitem as trade ticks on their own, years-long time axis."""
    return bridge.table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "N", "binance").otherwise("hyperliquid").alias("venue"),
        F.concat(F.lit("S"), (F.col("l_partkey") % 60).cast("string")).alias("symbol"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        "l_quantity",
    )


@query(
    "s5_month_partitions",
    """SELECT strftime(l_shipdate, '%Y%m') AS month, count(*) AS rows,
  round(sum(l_quantity), 6) AS quantity FROM lineitem GROUP BY 1""",
)
def s5(spark, sf_dir):
    path = f"{checkpoint_dir(spark)}/ticks-{uuid.uuid4().hex}"
    minute_store.write_months(ticks(spark, sf_dir), path)
    stored = spark.read.schema(
        "venue string, symbol string, ts timestamp, l_quantity double, month string"
    ).parquet(path)
    return stored.groupBy("month").agg(
        F.count("*").alias("rows"), r6(F.sum("l_quantity"), "quantity")
    )


FIRST, LAST = "199301", "199712"
MONTHS_SQL = EVC + f""", mc AS (SELECT 'ticks' AS parent, strftime(l_shipdate, '%Y%m') AS month, count(*) AS rows FROM lineitem GROUP BY ALL
  UNION ALL SELECT 'events', strftime(make_timestamp(raw_ms * 1000), '%Y%m'), count(*) FROM ev GROUP BY ALL)
"""


def _tables(spark, sf_dir):
    return {
        "ticks": ticks(spark, sf_dir),
        "events": bridge.events(spark, sf_dir).withColumn("ts", C.epoch_ms(F.col("raw_ms"))),
    }


@query(
    "s6_catch_all_rows",
    MONTHS_SQL + f"""SELECT parent, CAST(coalesce(sum(rows) FILTER (month NOT BETWEEN '{FIRST}' AND '{LAST}'), 0) AS BIGINT) AS rows
  FROM mc GROUP BY parent""",
)
def s6(spark, sf_dir):
    return partitions.catch_all_rows(_tables(spark, sf_dir), FIRST, LAST)


@query(
    "s6_catch_all_alarm",
    MONTHS_SQL + """SELECT parent, CAST(sum(rows) FILTER (month NOT BETWEEN '202401' AND '202412') AS BIGINT) AS rows
  FROM mc GROUP BY parent HAVING sum(rows) FILTER (month NOT BETWEEN '202401' AND '202412') > 0""",
)
def s6_alarm(spark, sf_dir):
    return partitions.catch_all_alarm(_tables(spark, sf_dir), "202401", "202412")


@query(
    "s7_partition_coverage",
    MONTHS_SQL + f"""SELECT parent, count(*) FILTER (month BETWEEN '{FIRST}' AND '{LAST}') AS month_partitions,
  max(month) FILTER (month BETWEEN '{FIRST}' AND '{LAST}') AS last_month,
  bool_or(month NOT BETWEEN '{FIRST}' AND '{LAST}') AS has_catch_all FROM mc GROUP BY parent""",
)
def s7(spark, sf_dir):
    return partitions.partition_coverage(_tables(spark, sf_dir), FIRST, LAST)


@query(
    "s8_rolling_retention",
    """SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, count(*) AS rows FROM lineitem
WHERE CAST(l_shipdate AS DATE) > DATE '1997-06-17' - 35 GROUP BY 1""",
)
def s8(spark, sf_dir):
    kept = partitions.retained(ticks(spark, sf_dir), "divergence_1m", F.lit("1997-06-17").cast("timestamp"))
    return kept.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("rows"))


@query(
    "s8_expired_days",
    """SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, count(*) AS rows FROM lineitem
WHERE CAST(l_shipdate AS DATE) <= DATE '1997-06-17' - 35 GROUP BY 1""",
)
def s8_expired(spark, sf_dir):
    return partitions.expired_days(
        ticks(spark, sf_dir), "divergence_1m", F.lit("1997-06-17").cast("timestamp")
    ).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "rows")


@query(
    "s9_export_latest_state",
    B.with_ctes(*B.market_ctes()) + f"""
SELECT 'v1' AS version, 'latest' AS kind, CAST({END} AS BIGINT) AS as_of, venue, symbol,
  round(arg_max(coalesce(CAST(mark AS DOUBLE), -1), ts), 6) AS mark FROM market GROUP BY venue, symbol""",
)
def s9(spark, sf_dir):
    state = export.latest_state(market(spark, sf_dir))
    lines = export.export_lines(state, "latest", F.timestamp_millis(F.lit(END)))

    def read(path):
        return F.get_json_object("value", path)

    return lines.select(
        read("$.version").alias("version"),
        read("$.kind").alias("kind"),
        read("$.as_of").cast("bigint").alias("as_of"),
        read("$.body.venue").alias("venue"),
        read("$.body.symbol").alias("symbol"),
        F.round(F.coalesce(read("$.body.mark").cast("double"), F.lit(-1.0)), 6).alias("mark"),
    )


@query(
    "p8_freshness",
    B.with_ctes(*B.market_ctes()) + f""", l AS (
  SELECT venue, 'price_funding' AS face, max(obs_fast_ms) AS t, 60 AS b FROM market GROUP BY ALL
  UNION ALL SELECT venue, 'open_interest', max(obs_slow_ms), 120 FROM market GROUP BY ALL)
SELECT venue, face, CAST(b AS BIGINT) AS budget_s, round(({END} - t) / 1000.0, 6)::DOUBLE AS age_s,
  {END} - t <= b * 1000 AS within_budget FROM l""",
)
def p8(spark, sf_dir):
    faces = {"price_funding": "obs_ts_fast", "open_interest": "obs_ts_slow"}
    latest = H.latest_per_face(market(spark, sf_dir), faces)
    promised = spark.createDataFrame(
        [("price_funding", 60), ("open_interest", 120)], "face string, budget_s bigint"
    )
    return H.freshness(latest, promised, F.lit(END)).select(
        "venue", "face", "budget_s", r6("age_s"), "within_budget"
    )


@query(
    "t5_silence_spans",
    EVC + """, w AS (SELECT DISTINCT venue || '-' || user_id AS source, raw_ms FROM ev),
l AS (SELECT *, lag(raw_ms) OVER (PARTITION BY source ORDER BY raw_ms) AS p FROM w)
SELECT source, p AS last_write_ms, p + 600000 AS alert_ms, raw_ms AS recovered_ms FROM l WHERE raw_ms - p > 600000""",
)
def t5(spark, sf_dir):
    writes = bridge.events(spark, sf_dir).select(
        F.concat_ws("-", "venue", F.col("user_id").cast("string")).alias("source"),
        F.col("raw_ms").alias("at_ms"),
    )
    return H.silences(writes)


@query(
    "p17_collection_delay_gate",
    B.with_ctes(B.EV, B.stage()) + """
SELECT source, round(quantile_cont(CAST(ingest_ms - ts_ms AS DOUBLE), 0.95), 6) AS p95_delay_ms, count(*) AS n FROM stg GROUP BY source""",
)
def p17(spark, sf_dir):
    delays = bridge.stage(spark, sf_dir).select(
        "source", (F.col("ingest_ts_ms") - F.col("ts_ms")).alias("delay_ms")
    )
    return H.delay_gate(delays).select("source", r6("p95_delay_ms"), "n")
