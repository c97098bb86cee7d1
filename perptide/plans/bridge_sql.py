"""The bridge inputs spelled for an engine that reads the same tables with SQL."""

from __future__ import annotations

T0 = 1_704_067_200_000

EV = f"""
ev AS (
  SELECT event_id, user_id, event_type,
         epoch_us(ts) // 1000 AS raw_ms,
         {T0} + ((epoch_us(ts) // 1000 - {T0}) // 60) AS obs_ms,
         CASE WHEN event_id % 2 = 0 THEN 'binance' ELSE 'hyperliquid' END AS venue,
         'C' || (user_id % 5) AS symbol, user_id % 5 AS sym_no,
         CAST(value AS DECIMAL(20,10)) AS px
  FROM events)"""

INTERVAL = "(CASE WHEN venue = 'hyperliquid' THEN 1 WHEN sym_no = 3 THEN 4 ELSE 8 END)"


def stage(time: str = "obs_ms") -> str:
    """CTE ``stg`` with staged records in milliseconds; needs ``ev``."""
    return f"""
stg0 AS (
  SELECT *, {time} AS at_ms, event_type IN ('click','view') AS lf, event_type = 'purchase' AS ls,
         event_type = 'signup' AS bk
  FROM ev WHERE event_type <> 'error'),
stg1 AS (
  SELECT *, lf OR (bk AND event_id % 3 <> 1) AS f, ls OR (bk AND event_id % 3 <> 0) AS s FROM stg0),
stg AS (
  SELECT event_id, venue, symbol, at_ms AS ts_ms, at_ms - at_ms % 60000 AS ts,
    at_ms + 250 + event_id % 500 AS ingest_ms,
    CASE WHEN bk THEN 'binance_rest_klines'
         WHEN venue = 'hyperliquid' AND event_id % 10 = 1 THEN 'hyperliquid_ws_all_mids'
         ELSE 'bridge_live' END AS source,
    CASE WHEN bk THEN 'candle_close' ELSE 'mark_price' END AS semantic,
    CASE WHEN f AND event_id % 17 <> 0 THEN px END AS mark,
    CASE WHEN lf THEN px + event_id % 7 END AS index_px,
    CASE WHEN lf AND venue = 'hyperliquid'
         THEN CAST(event_id % 11 - 5 AS DECIMAL(10,0)) * 0.0001 END AS premium,
    CASE WHEN lf THEN CAST(event_id % 201 - 100 AS DECIMAL(10,0)) * 0.000001 END AS funding_rate,
    CASE WHEN lf THEN {INTERVAL} END AS funding_interval_h,
    CASE WHEN lf THEN (at_ms // ({INTERVAL} * 3600000) + 1) * {INTERVAL} * 3600000 END
      AS next_funding_ms,
    CASE WHEN s THEN px * 100 END AS oi_base,
    CASE WHEN ls THEN px * 1000 END AS vol24h_usd,
    CASE WHEN ls THEN CAST(event_id % 400 - 200 AS DOUBLE) / 10 END AS chg24h_pct,
    CASE WHEN f THEN at_ms END AS obs_fast_ms,
    CASE WHEN s THEN at_ms END AS obs_slow_ms,
    CASE WHEN bk THEN 60 * (1 + event_id % 5) END AS grid_s,
    bk AS backfilled, event_id // 500 AS batch_seq, (event_id * 7919) % 20 AS late_seq
  FROM stg1)"""


def instruments(where: str = "true") -> str:
    """CTE ``instruments``: versions out of hourly contract snapshots; needs ``ev``."""
    return f"""
snap AS (
  SELECT venue, symbol, sym_no, (obs_ms - {T0}) // 3600000 AS hour_no FROM ev GROUP BY ALL),
inst_rows AS (
  SELECT venue, symbol || CASE WHEN venue = 'binance' THEN 'USDT' ELSE '' END AS venue_symbol,
    {T0} + hour_no * 3600000 AS ts_ms, symbol,
    CASE WHEN sym_no = 0 AND (hour_no // 3) % 2 = 0 THEN 1000 ELSE 1 END AS mult,
    {INTERVAL} AS funding_interval_h,
    CASE WHEN sym_no = 2 AND hour_no >= 6 THEN 'suspended' ELSE 'trading' END AS status
  FROM snap WHERE (sym_no <> 4 OR hour_no % 5 <> 2) AND ({where})),
inst_at AS (
  SELECT venue, ts_ms, lead(ts_ms) OVER (PARTITION BY venue ORDER BY ts_ms) AS nxt
  FROM (SELECT DISTINCT venue, ts_ms FROM inst_rows)),
inst_mark AS (
  SELECT r.*, a.nxt,
    coalesce(lag(a.nxt) OVER w <> r.ts_ms OR lag(mult || '/' || status) OVER w <> mult || '/' || status,
             true) AS opens
  FROM inst_rows r JOIN inst_at a USING (venue, ts_ms)
  WINDOW w AS (PARTITION BY venue, venue_symbol ORDER BY ts_ms)),
inst_no AS (
  SELECT *, sum(opens::INT) OVER (PARTITION BY venue, venue_symbol ORDER BY ts_ms) AS ver
  FROM inst_mark),
instr AS (
  SELECT venue, venue_symbol, symbol, mult, funding_interval_h, status,
    min(ts_ms) AS vf, arg_max(coalesce(nxt, -1), ts_ms) AS vt0
  FROM inst_no GROUP BY venue, venue_symbol, symbol, mult, funding_interval_h, status, ver),
instruments AS (
  SELECT * EXCLUDE (vt0), CASE WHEN vt0 < 0 THEN NULL ELSE vt0 END AS vt FROM instr)"""


INSTRUMENTS = instruments()


def mult_at(ts_ms: str, alias: str) -> str:
    """Scalar subquery: multiplier as of a minute, nearest version as fallback."""
    return f"""(SELECT i.mult FROM instruments i
      WHERE i.venue = {alias}.venue AND i.symbol = {alias}.symbol AND i.mult > 0
      ORDER BY (i.vf <= {ts_ms} AND (i.vt IS NULL OR i.vt > {ts_ms})) DESC,
               abs(i.vf - {ts_ms}), i.vf LIMIT 1)"""


FAST = "mark index_px premium funding_rate funding_interval_h next_funding_ms obs_fast_ms".split()
SLOW = "oi_base vol24h_usd chg24h_pct obs_slow_ms".split()
SHARED = "semantic grid_s source ingest_ms".split()


def ops(seq: str = "batch_seq", where: str = "true") -> str:
    """CTE ``ops``: one row per (minute, batch, statement), numbered in log order."""
    nulls = {c: f"NULL AS {c}" for c in FAST + SLOW}

    def lane(columns: list[str], obs: str, other: list[str], stmt: int) -> str:
        return f"""
  SELECT venue, symbol, ts, {seq} AS seq, {stmt} AS stmt, {', '.join(columns)},
    {', '.join(nulls[c] for c in other)}, semantic, coalesce(grid_s, 60) AS grid_s, source, ingest_ms
  FROM stg WHERE NOT backfilled AND {obs} IS NOT NULL AND ({where})
  QUALIFY row_number() OVER (PARTITION BY venue, symbol, ts, {seq}
    ORDER BY {obs} DESC, ingest_ms DESC, source DESC) = 1"""

    return f"""
op AS (
  SELECT * FROM ({lane(FAST, 'obs_fast_ms', SLOW, 0)})
  UNION ALL BY NAME
  SELECT * FROM ({lane(SLOW, 'obs_slow_ms', FAST, 1)})
  UNION ALL BY NAME
  SELECT * FROM (
  SELECT venue, symbol, ts, {seq} AS seq, 2 AS stmt, {', '.join(FAST + SLOW)}, semantic, grid_s,
    source, ingest_ms
  FROM stg WHERE backfilled AND grid_s IS NOT NULL
    AND (obs_fast_ms IS NOT NULL OR obs_slow_ms IS NOT NULL) AND ({where})
  QUALIFY row_number() OVER (PARTITION BY venue, symbol, ts, {seq}
    ORDER BY grid_s, coalesce(obs_fast_ms, obs_slow_ms) DESC, ingest_ms DESC, source) = 1)),
ops AS (
  SELECT *, row_number() OVER (PARTITION BY venue, symbol, ts ORDER BY seq, stmt) AS ord FROM op)"""


def _step() -> str:
    cols = []
    for c in FAST:
        cols.append(
            f"CASE WHEN ap AND stmt = 0 THEN n_{c} WHEN ap AND stmt = 2 "
            f"THEN coalesce(n_{c}, {c}) ELSE {c} END AS {c}"
        )
    for c in SLOW:
        cols.append(
            f"CASE WHEN ap AND stmt = 1 THEN n_{c} WHEN ap AND stmt = 2 "
            f"THEN coalesce(n_{c}, {c}) ELSE {c} END AS {c}"
        )
    for c in SHARED:
        cols.append(f"CASE WHEN ap THEN n_{c} ELSE {c} END AS {c}")
    cols.append("CASE WHEN ap THEN stmt = 2 ELSE backfilled END AS backfilled")
    return ", ".join(cols)


def fold() -> str:
    """Recursive CTE ``folded``: the statements of each minute applied one by one."""
    state = FAST + SLOW + SHARED
    renamed = ", ".join(f"o.{c} AS n_{c}" for c in state)
    return f"""
steps AS (
  SELECT venue, symbol, ts, ord, {', '.join(state)}, stmt = 2 AS backfilled FROM ops WHERE ord = 1
  UNION ALL
  SELECT venue, symbol, ts, ord, {_step()} FROM (
    SELECT f.venue, f.symbol, f.ts, o.ord, {', '.join('f.' + c for c in state)}, f.backfilled,
      o.stmt, {renamed},
      CASE o.stmt
        WHEN 0 THEN f.backfilled OR o.obs_fast_ms > coalesce(f.obs_fast_ms, -1)
        WHEN 1 THEN f.backfilled OR o.obs_slow_ms > coalesce(f.obs_slow_ms, -1)
        ELSE f.backfilled AND o.grid_s <= f.grid_s END AS ap
    FROM steps f JOIN ops o
      ON o.venue = f.venue AND o.symbol = f.symbol AND o.ts = f.ts AND o.ord = f.ord + 1)),
folded AS (
  SELECT * FROM steps QUALIFY row_number() OVER (PARTITION BY venue, symbol, ts ORDER BY ord DESC) = 1),
market AS (
  SELECT m.*, m.oi_base * m.mark / {mult_at('m.ts', 'm')} AS oi_usd FROM folded m)"""


def with_ctes(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(ctes)


def market_ctes(seq: str = "batch_seq", where: str = "true", time: str = "obs_ms") -> list[str]:
    return [EV, stage(time), INSTRUMENTS, ops(seq, where), fold()]


def r6(expression: str, name: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6) AS {name}"


MARKET_OUT = f"""
SELECT venue, symbol, ts AS ts_ms, obs_fast_ms, obs_slow_ms, next_funding_ms, ingest_ms,
  CAST(funding_interval_h AS BIGINT) AS funding_interval_h, CAST(grid_s AS BIGINT) AS grid_s,
  backfilled, semantic, source, {r6('mark', 'mark')}, {r6('index_px', 'index_px')},
  {r6('premium', 'premium')}, {r6('funding_rate', 'funding_rate')}, {r6('oi_base', 'oi_base')},
  {r6('oi_usd', 'oi_usd')}, {r6('vol24h_usd', 'vol24h_usd')}, {r6('chg24h_pct', 'chg24h_pct')}
"""
