"""Queries over the payload parsers, the symbol lookups and the record contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from perptide.functions import scalars as C
from perptide.operators import capability, contracts, liquidations, symbols
from perptide.operators import normalize_binance as NB
from perptide.operators import normalize_hyperliquid as NH
from perptide.plans import bridge
from perptide.plans import bridge_sql as B
from perptide.plans import payloads as P
from perptide.plans.common import big, r6, stage_out
from perptide.plans.registry import Registry

query = Registry()
NOW_MS = bridge.T0 + 11 * bridge.HOUR

BASE = B.with_ctes(B.EV)
KNOWN = "event_id % 13 <> 0"
RATE = "CAST(event_id % 201 - 100 AS DOUBLE) / 1000000"
BLOCK_INGEST = "max(obs_ms) OVER (PARTITION BY {by}) + 250"
MULT = "(CASE WHEN sym_no = 0 THEN 1000 ELSE 1 END)"
BINANCE_H = "(CASE WHEN sym_no = 3 THEN 4 ELSE 8 END)"
INTERVAL_NAME = "['1m','1h','1d'][(event_id // 2) % 3 + 1]"
GRID = "[60,3600,86400][(event_id // 2) % 3 + 1]"


def _stage_sql(where: str, *, source: str, ingest: str, keep: str = "true", **values: str) -> str:
    """SQL with the staged columns; what is not named is NULL."""
    defaults = {
        "ts_ms": "obs_ms",
        "semantic": "'mark_price'",
        "backfilled": "false",
        "obs_fast_ms": "NULL",
        "obs_slow_ms": "NULL",
        "next_funding_ms": "NULL",
        "grid_s": "NULL",
        "funding_interval_h": "NULL",
        **{c: "NULL" for c in ("mark", "index_px", "premium", "funding_rate", "oi_base", "vol24h_usd", "chg24h_pct")},
        **values,
    }
    doubles = ("mark", "index_px", "premium", "funding_rate", "oi_base", "vol24h_usd", "chg24h_pct")
    longs = ("obs_fast_ms", "obs_slow_ms", "next_funding_ms", "grid_s", "funding_interval_h")
    out = [f"round(CAST({defaults[c]} AS DOUBLE), 6) AS {c}" for c in doubles]
    out += [f"CAST({defaults[c]} AS BIGINT) AS {c}" for c in longs]
    return BASE + f""", src AS (SELECT *, {ingest} AS ing FROM ev WHERE {where})
SELECT venue, symbol, {defaults['ts_ms']} AS ts_ms, ing AS ingest_ms, '{source}' AS source,
  {defaults['semantic']} AS semantic, {defaults['backfilled']} AS backfilled, {', '.join(out)}
FROM src WHERE {keep}"""


def _block(by: str = "") -> str:
    return BLOCK_INGEST.format(by="event_id // 50" + by)


@query(
    "n1_contract_list",
    BASE + f""", h AS (SELECT DISTINCT sym_no, symbol, {B.T0} + (obs_ms - {B.T0}) // 3600000 * 3600000 AS ts_ms
  FROM ev WHERE venue = 'binance')
SELECT symbol, CASE WHEN sym_no = 0 THEN '1000C0' ELSE symbol END || 'USDT' AS venue_symbol, ts_ms,
  ts_ms + 250 AS ingest_ms, CAST({MULT} AS BIGINT) AS mult, CAST({BINANCE_H} AS BIGINT) AS funding_interval_h,
  round(0.1::DOUBLE, 6) AS tick, ['trading','suspended','delisted','trading',NULL][sym_no + 1] AS status FROM h""",
)
def n1(spark, sf_dir):
    raw = P.exchange_info(spark, sf_dir).unionByName(P.funding_info(spark, sf_dir))
    return _instrument_out(NB.instruments(raw))


def _instrument_out(df):
    return df.select(
        "symbol", "venue_symbol", "ts_ms", big("ingest_ts_ms", "ingest_ms"), big("mult"),
        big("funding_interval_h"), r6("tick"), "status",
    )


@query(
    "n2_funding_intervals",
    BASE + """
SELECT DISTINCT symbol || 'USDT' AS venue_symbol, CAST(4 AS BIGINT) AS hours FROM ev
WHERE venue = 'binance' AND sym_no = 3""",
)
def n2(spark, sf_dir):
    return NB.funding_intervals(P.funding_info(spark, sf_dir)).select("venue_symbol", big("hours")).distinct()


@query(
    "n3_mark_index_funding_snapshot",
    _stage_sql(
        "venue = 'binance' AND event_type = 'click'", source="binance_rest_premium_index",
        ingest=_block(), keep=KNOWN, mark="px", index_px="px + 1",
        funding_rate=f"CASE WHEN event_id % 9 <> 0 THEN {RATE} END", funding_interval_h=BINANCE_H,
        next_funding_ms="CASE WHEN event_id % 10 <> 0 THEN obs_ms + 28800000 END", obs_fast_ms="obs_ms",
    ),
)
def n3(spark, sf_dir):
    return stage_out(NB.premium_index(P.premium_index(spark, sf_dir), P.dimension(spark, sf_dir)))


@query(
    "n4_streamed_mark_frames",
    _stage_sql(
        "venue = 'binance' AND event_type = 'view'", source="binance_ws_mark_price", ingest=_block(),
        keep=KNOWN, mark="px", index_px="px + 1", funding_rate=RATE, funding_interval_h=BINANCE_H,
        next_funding_ms="obs_ms + 28800000", obs_fast_ms="obs_ms",
    ),
)
def n4(spark, sf_dir):
    return stage_out(NB.ws_mark_price(P.ws_mark_price(spark, sf_dir), P.dimension(spark, sf_dir)))


@query(
    "n5_settled_funding_history",
    _stage_sql(
        "venue = 'binance' AND event_type = 'signup'", source="binance_rest_funding_rate",
        ingest=_block(), keep=KNOWN, funding_rate=RATE, funding_interval_h=BINANCE_H,
        grid_s=f"{BINANCE_H} * 3600", obs_fast_ms="obs_ms", backfilled="true",
    ),
)
def n5(spark, sf_dir):
    return stage_out(NB.funding_rate(P.funding_rate(spark, sf_dir), P.dimension(spark, sf_dir)))


#: The interval of a contract as the last list not after the event says, or the first list that has it.
INTERVAL_AT = """
il AS (
  SELECT DISTINCT sym_no, k, T0 + k * 600000 AS list_ms,
    CASE WHEN sym_no = 3 AND CAST(floor(k / 4) AS BIGINT) % 2 = 0 THEN 4 WHEN sym_no = 1 AND k % 9 < 3 THEN 1 ELSE 8 END AS h
  FROM (SELECT sym_no, CAST(floor((obs_ms - T0) / 600000) AS BIGINT) AS k FROM ev WHERE venue = 'binance')
  WHERE NOT (sym_no = 4 AND k % 5 = 2)),
ah AS (
  SELECT e.event_id, coalesce(arg_max(il.h, il.list_ms) FILTER (il.list_ms <= e.obs_ms), arg_min(il.h, il.list_ms)) AS h
  FROM ev e JOIN il ON il.sym_no = e.sym_no WHERE e.venue = 'binance' GROUP BY e.event_id)""".replace("T0", str(bridge.T0))


@query(
    "n5_settled_funding_as_of",
    "WITH out AS (" + _stage_sql(
        "venue = 'binance' AND event_type = 'signup'", source="binance_rest_funding_rate",
        ingest=_block(), keep=KNOWN, funding_rate=RATE, funding_interval_h="-event_id",
        grid_s="0", obs_fast_ms="obs_ms", backfilled="true",
    ) + "), " + B.EV + "," + INTERVAL_AT + """
SELECT out.* REPLACE (CAST(h AS BIGINT) AS funding_interval_h, CAST(h * 3600 AS BIGINT) AS grid_s)
FROM out JOIN ah ON ah.event_id = -out.funding_interval_h""",
)
def n5_as_of(spark, sf_dir):
    """Each settlement with the interval of its own time, from lists in which intervals change."""
    return stage_out(NB.funding_rate(P.funding_rate(spark, sf_dir), P.symbol_history(spark, sf_dir)))


@query(
    "n6_open_interest",
    _stage_sql(
        "venue = 'binance' AND event_type = 'purchase'", source="binance_rest_open_interest",
        ingest="obs_ms + 250", keep=KNOWN, oi_base=f"px * {MULT}", obs_slow_ms="obs_ms",
    ),
)
def n6(spark, sf_dir):
    return stage_out(NB.open_interest(P.open_interest(spark, sf_dir), P.dimension(spark, sf_dir)))


@query(
    "n7_ticker_24h",
    _stage_sql(
        "venue = 'binance' AND event_type = 'purchase'", source="binance_rest_ticker_24h",
        ingest=_block(), keep=KNOWN, vol24h_usd="px * 1000", chg24h_pct="px - 50", obs_slow_ms="obs_ms",
    ),
)
def n7(spark, sf_dir):
    return stage_out(NB.ticker_24h(P.ticker_24h(spark, sf_dir), P.dimension(spark, sf_dir)))


@query(
    "n8_long_short_ratio",
    BASE + """, k AS (SELECT *, (event_id // 2) % 3 AS kn FROM ev WHERE venue = 'binance'),
v AS (SELECT *, CASE WHEN event_id % 25 = 0 THEN 0 ELSE px END AS buy,
        CASE WHEN event_id % 25 = 0 THEN 0 ELSE event_id % 90 END AS sell FROM k)
SELECT venue, symbol, ['global_long_short_account','top_long_short_position','taker_long_short'][kn + 1] AS kind,
  obs_ms AS ts_ms, max(obs_ms) OVER (PARTITION BY event_id // 50, symbol, kn) + 250 AS ingest_ms,
  ['binance_rest_global_long_short_account_ratio','binance_rest_top_long_short_position_ratio',
   'binance_rest_taker_long_short_ratio'][kn + 1] AS source, CAST(300 AS BIGINT) AS period,
  round(CASE WHEN kn < 2 THEN CAST(event_id % 1001 AS DOUBLE) / 1000
    WHEN buy + sell > 0 THEN CAST(buy AS DOUBLE) / CAST(buy + sell AS DOUBLE) END, 6) AS long_share FROM v""",
)
def n8(spark, sf_dir):
    return NB.ls_ratio(P.ls_ratio(spark, sf_dir)).select(
        "venue", "symbol", "kind", "ts_ms", big("ingest_ts_ms", "ingest_ms"), "source", big("period"),
        r6("long_share"),
    )


@query(
    "n9_closed_bars",
    _stage_sql(
        "venue = 'binance' AND event_type = 'signup'", source="binance_rest_klines",
        ingest=_block(f", symbol, {INTERVAL_NAME}"), keep=f"obs_ms < {NOW_MS}", mark="px",
        semantic="'candle_close'", grid_s=GRID, obs_fast_ms="obs_ms", backfilled="true",
    ),
)
def n9(spark, sf_dir):
    return stage_out(NB.klines(P.klines(spark, sf_dir), NOW_MS))


@query(
    "n10_forced_order_floor",
    BASE + f"""
SELECT venue, symbol, obs_ms AS ts_ms, obs_ms + 250 AS ingest_ms, 'binance_ws_force_order' AS source
FROM ev, (SELECT unnest([1, 2]) AS copy) WHERE venue = 'binance' AND event_type = 'error' AND {KNOWN}
  AND (copy = 1 OR event_id % 5 = 0)""",
)
def n10(spark, sf_dir):
    return NB.force_order(P.force_order(spark, sf_dir), P.dimension(spark, sf_dir)).withColumnRenamed(
        "ingest_ts_ms", "ingest_ms"
    )


@query(
    "n11_contract_list_from_meta",
    BASE + f""", h AS (SELECT DISTINCT sym_no, symbol, {B.T0} + (obs_ms - {B.T0}) // 3600000 * 3600000 AS ts_ms
  FROM ev WHERE venue = 'hyperliquid')
SELECT symbol, CASE WHEN sym_no = 0 THEN 'kC0' ELSE symbol END AS venue_symbol, ts_ms,
  ts_ms + 250 AS ingest_ms, CAST({MULT} AS BIGINT) AS mult, CAST(1 AS BIGINT) AS funding_interval_h,
  CAST(NULL AS DOUBLE) AS tick, CAST(NULL AS VARCHAR) AS status FROM h""",
)
def n11(spark, sf_dir):
    return _instrument_out(NH.instruments(P.meta(spark, sf_dir)))


@query(
    "n12_asset_metadata",
    BASE + f""", h AS (SELECT DISTINCT sym_no, symbol, {B.T0} + (obs_ms - {B.T0}) // 3600000 * 3600000 AS ts_ms
  FROM ev WHERE venue = 'hyperliquid')
SELECT CASE WHEN sym_no = 0 THEN 'kC0' ELSE symbol END AS venue_symbol, ts_ms AS observed_ms,
  sym_no AS sz_decimals, CASE WHEN sym_no <> 4 THEN 50 - sym_no END AS max_leverage FROM h""",
)
def n12(spark, sf_dir):
    return NH.asset_metadata(P.meta(spark, sf_dir)).select(
        "venue_symbol", "observed_ms", big("sz_decimals"), big("max_leverage")
    )


@query(
    "n13_meta_and_contexts",
    _stage_sql(
        "venue = 'hyperliquid' AND event_type = 'click'", source="hyperliquid_rest_meta_and_asset_ctxs",
        ingest="obs_ms + 250", keep=KNOWN, mark="px", index_px="px + 1",
        premium=f"CASE WHEN event_id % 3 <> 0 THEN {RATE} * 2 END", funding_rate=RATE,
        funding_interval_h="1", oi_base=f"px * {MULT}", vol24h_usd="px * 1000",
        obs_fast_ms="obs_ms", obs_slow_ms="obs_ms",
    ),
)
def n13(spark, sf_dir):
    return stage_out(
        NH.meta_and_asset_ctxs(P.meta_and_asset_ctxs(spark, sf_dir), P.dimension(spark, sf_dir))
    )


@query(
    "n14_predicted_fundings",
    _stage_sql(
        "venue = 'hyperliquid' AND event_type = 'view'", source="hyperliquid_rest_predicted_fundings",
        ingest="obs_ms + 250", keep=KNOWN, funding_rate=RATE, funding_interval_h="1",
        next_funding_ms="obs_ms + 3600000", obs_fast_ms="obs_ms",
    ),
)
def n14(spark, sf_dir):
    return stage_out(
        NH.predicted_fundings(P.predicted_fundings(spark, sf_dir), P.dimension(spark, sf_dir))
    )


@query(
    "n14_other_venues_left_out",
    BASE + """
SELECT 'BinPerp' AS venue_key, count(*) AS rows FROM ev WHERE venue = 'hyperliquid' AND event_type = 'view'""",
)
def n14_other(spark, sf_dir):
    return NH.predicted_fundings_other_venues(P.predicted_fundings(spark, sf_dir))


@query(
    "n15_hourly_settled_funding",
    _stage_sql(
        "venue = 'hyperliquid' AND event_type = 'signup'", source="hyperliquid_rest_funding_history",
        ingest=_block(", symbol"), funding_rate=RATE, premium=f"{RATE} * 2", funding_interval_h="1",
        grid_s="3600", obs_fast_ms="obs_ms", backfilled="true",
    ),
)
def n15(spark, sf_dir):
    return stage_out(NH.funding_history(P.funding_history(spark, sf_dir)))


CLOSE = f"(CASE WHEN event_id % 3 <> 0 THEN obs_ms + 59999 ELSE obs_ms + {GRID} * 1000 - 1 END)"


@query(
    "n16_candle_snapshot",
    _stage_sql(
        "venue = 'hyperliquid' AND event_type = 'signup'", source="hyperliquid_rest_candle_snapshot",
        ingest=_block(f", symbol, {INTERVAL_NAME}"), keep=f"{CLOSE} < {NOW_MS}", ts_ms=CLOSE, mark="px",
        semantic="'candle_close'", grid_s=GRID, obs_fast_ms=CLOSE, backfilled="true",
    ),
)
def n16(spark, sf_dir):
    return stage_out(NH.candle_snapshot(P.candle_snapshot(spark, sf_dir), NOW_MS))


@query(
    "n17_all_mids_frames",
    _stage_sql(
        "venue = 'hyperliquid' AND event_type = 'click'", source="hyperliquid_ws_all_mids",
        ingest="obs_ms + 250", keep=f"{KNOWN} AND event_id % 7 <> 0", mark="px", funding_interval_h="1",
        obs_fast_ms="obs_ms",
    ),
)
def n17(spark, sf_dir):
    return stage_out(NH.ws_all_mids(P.ws_all_mids(spark, sf_dir), P.dimension(spark, sf_dir)))


@query(
    "n18_unknown_symbols",
    BASE + """
SELECT venue, CASE WHEN venue = 'binance' THEN 'NEWUSDT' ELSE 'NEW' END AS venue_symbol, count(*) AS rows
FROM ev WHERE event_id % 13 = 0 AND ((venue = 'binance' AND event_type = 'view') OR
  (venue = 'hyperliquid' AND event_type = 'click')) GROUP BY ALL""",
)
def n18(spark, sf_dir):
    entries = NB.ws_mark_price_entries(P.ws_mark_price(spark, sf_dir)).select("venue", "venue_symbol")
    other = NH.meta_and_asset_ctxs_entries(P.meta_and_asset_ctxs(spark, sf_dir))
    return symbols.unknown_symbols(
        entries.unionByName(other.select("venue", "venue_symbol")), P.dimension(spark, sf_dir)
    )


# Bridge records with faults in them, for the contract checks.
FAULTY = B.with_ctes(B.EV, B.stage()) + """, bad AS (SELECT *,
  CASE WHEN event_id % 31 = 0 THEN NULL ELSE obs_fast_ms END AS of2,
  CASE WHEN event_id % 37 = 0 THEN NULL ELSE obs_slow_ms END AS os2,
  CASE WHEN event_id % 41 = 0 THEN 'x' ELSE venue END AS venue2,
  CASE WHEN event_id % 43 = 0 THEN 'c-1' ELSE symbol END AS symbol2,
  CASE WHEN event_id % 47 = 0 THEN -mark ELSE mark END AS mark2 FROM stg),
v AS (SELECT event_id, list_filter([
  CASE WHEN of2 IS NULL AND (mark2 IS NOT NULL OR index_px IS NOT NULL OR premium IS NOT NULL OR
    funding_rate IS NOT NULL OR funding_interval_h IS NOT NULL OR next_funding_ms IS NOT NULL)
    THEN 'fast_payload_needs_obs_ts_fast' END,
  CASE WHEN os2 IS NULL AND (oi_base IS NOT NULL OR vol24h_usd IS NOT NULL OR chg24h_pct IS NOT NULL)
    THEN 'slow_payload_needs_obs_ts_slow' END,
  CASE WHEN of2 IS NULL AND os2 IS NULL THEN 'at_least_one_lane' END,
  CASE WHEN venue2 NOT IN ('binance','hyperliquid') THEN 'single_venue' END,
  CASE WHEN NOT regexp_matches(symbol2, '^[A-Z0-9]{1,15}$') THEN 'symbol_is_unified' END,
  CASE WHEN mark2 < 0 THEN 'mark_is_not_negative' END], lambda x: x IS NOT NULL) AS violations FROM bad)
"""


def _faulty(spark, sf_dir):
    eid = F.col("event_id")

    def unless(divisor, column, bad):
        return F.when(eid % divisor == 0, bad).otherwise(F.col(column))

    return (
        bridge.stage(spark, sf_dir)
        .withColumn("obs_ts_fast_ms", unless(31, "obs_ts_fast_ms", F.lit(None).cast("bigint")))
        .withColumn("obs_ts_slow_ms", unless(37, "obs_ts_slow_ms", F.lit(None).cast("bigint")))
        .withColumn("venue", unless(41, "venue", F.lit("x")))
        .withColumn("symbol", unless(43, "symbol", F.lit("c-1")))
        .withColumn("mark", unless(47, "mark", -F.col("mark")))
    )


@query(
    "n19_contract_quarantine",
    FAULTY + """SELECT event_id, array_to_string(violations, ',') AS reasons FROM v WHERE len(violations) > 0""",
)
def n19(spark, sf_dir):
    _, quarantine = contracts.split_valid(_faulty(spark, sf_dir), contracts.market_record_rules())
    return quarantine.select("event_id", F.array_join("violations", ",").alias("reasons"))


@query("n19_contract_valid_rows", FAULTY + "SELECT event_id FROM v WHERE len(violations) = 0")
def n19_valid(spark, sf_dir):
    valid, _ = contracts.split_valid(_faulty(spark, sf_dir), contracts.market_record_rules())
    return valid.select("event_id")


@query(
    "j1_venue_name_to_unified",
    BASE + f"""
SELECT event_id, symbol AS unified, CAST({MULT} AS BIGINT) AS mult FROM ev WHERE {KNOWN}""",
)
def j1(spark, sf_dir):
    name = F.when(F.col("venue") == "binance", P.binance_name()).otherwise(P.hyperliquid_name())
    entries = bridge.events(spark, sf_dir).select("event_id", "venue", name.alias("venue_symbol"))
    return symbols.resolve(entries, P.dimension(spark, sf_dir)).select(
        "event_id", F.col("symbol").alias("unified"), big("mult")
    )


@query(
    "j1_venue_name_as_of",
    B.with_ctes(B.EV, B.INSTRUMENTS) + """, p AS (
  SELECT event_id, venue, symbol || CASE WHEN venue = 'binance' THEN 'USDT' ELSE '' END AS venue_symbol, obs_ms FROM ev)
SELECT p.event_id, any_value(r.symbol) AS unified,
  CAST(coalesce(arg_max(r.mult, r.ts_ms) FILTER (r.ts_ms <= p.obs_ms), arg_min(r.mult, r.ts_ms)) AS BIGINT) AS mult
FROM p JOIN inst_rows r ON r.venue = p.venue AND r.venue_symbol = p.venue_symbol GROUP BY p.event_id""",
)
def j1_as_of(spark, sf_dir):
    """Names read by the list of their time; one contract changes its multiplier again and again."""
    name = F.concat(F.col("symbol"), F.when(F.col("venue") == "binance", "USDT").otherwise(""))
    entries = bridge.events(spark, sf_dir).select(
        "event_id", "venue", name.alias("venue_symbol"), F.col("obs_ms").alias("ts_ms")
    )
    history = symbols.symbol_history(bridge.instrument_snapshots(spark, sf_dir))
    return symbols.resolve(entries, history).select("event_id", F.col("symbol").alias("unified"), big("mult"))


@query(
    "j2_unified_name_to_venue",
    BASE + """
SELECT event_id, CASE WHEN venue = 'binance' THEN (CASE WHEN sym_no = 0 THEN '1000C0' ELSE symbol END) || 'USDT'
  ELSE CASE WHEN sym_no = 0 THEN 'kC0' ELSE symbol END END AS venue_symbol FROM ev""",
)
def j2(spark, sf_dir):
    dim = symbols.one_to_one(P.dimension(spark, sf_dir))
    return symbols.to_venue(bridge.events(spark, sf_dir), dim).select("event_id", "venue_symbol")


@query(
    "j2_ambiguous_names",
    B.with_ctes(B.EV, B.INSTRUMENTS) + """, d AS (
  SELECT venue, 'venue_symbol' AS side, venue_symbol AS name, count(*) AS rows FROM instruments GROUP BY ALL
  UNION ALL SELECT venue, 'symbol', symbol, count(*) FROM instruments GROUP BY ALL)
SELECT * FROM d WHERE rows > 1""",
)
def j2_conflicts(spark, sf_dir):
    return symbols.mapping_conflicts(bridge.instruments(spark, sf_dir))


@query(
    "j7_capability_gate",
    BASE + """, r AS (SELECT event_id, venue, ['mark_price','taker_ratio','long_short_ratio','liquidation_stream',
  'spot','klines','moon_phase'][event_id % 7 + 1] AS capability FROM ev)
SELECT event_id, capability, NOT (capability IN ('spot','moon_phase') OR (venue = 'hyperliquid' AND
  capability IN ('taker_ratio','long_short_ratio','liquidation_stream'))) AS passed FROM r""",
)
def j7(spark, sf_dir):
    names = ("mark_price", "taker_ratio", "long_short_ratio", "liquidation_stream", "spot", "klines", "moon_phase")
    asked = bridge.events(spark, sf_dir).select(
        "event_id",
        "venue",
        F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("event_id") % 7 + 1).cast("int")).alias("capability"),
    )
    declared = capability.sheet(spark)
    return (
        capability.gate(asked, declared)
        .withColumn("passed", F.lit(True))
        .unionByName(capability.refused(asked, declared).withColumn("passed", F.lit(False)))
        .select("event_id", "capability", "passed")
    )


LIQ_CTE = BASE + f""", liq AS (
  SELECT event_id, venue, symbol, obs_ms AS ts_ms,
    CASE WHEN (event_id // 2) % 2 = 0 THEN 'long' ELSE 'short' END AS side, px + 1 AS price,
    (event_id % 50 + 1) * {MULT} AS size, (px + 1) * (event_id % 50 + 1) AS notional
  FROM ev WHERE venue = 'binance' AND event_type = 'error' AND {KNOWN})
"""


def liquidation_table(spark, sf_dir):
    return liquidations.liquidations(
        NB.force_order_entries(P.force_order(spark, sf_dir)), P.dimension(spark, sf_dir)
    )


@query(
    "l1_liquidation_rows",
    LIQ_CTE + f"""SELECT venue, symbol, ts_ms, side, {B.r6('price', 'price')}, {B.r6('size', 'size')},
  {B.r6('notional', 'notional_usd')}, true AS throttled_source, 'lower_bound' AS completeness,
  'binance_ws' AS ingest_path FROM liq""",
)
def l1(spark, sf_dir):
    return liquidation_out(liquidation_table(spark, sf_dir))


def liquidation_out(rows):
    return rows.select(
        "venue", "symbol", "ts_ms", "side", r6("price"), r6("size"), r6("notional_usd"),
        "throttled_source", "completeness", "ingest_path",
    )


@query(
    "l2_hourly_bars",
    LIQ_CTE + f"""SELECT venue, symbol, 'binance_ws' AS ingest_path, side, ts_ms // 3600000 * 3600000 AS hour_ms,
  {B.r6('sum(notional)', 'observed_lower_bound_usd')}, count(*) AS events,
  CAST(0 AS BIGINT) AS events_without_notional, 'lower_bound' AS completeness FROM liq GROUP BY ALL""",
)
def l2(spark, sf_dir):
    bars = liquidations.hourly_bars(liquidation_table(spark, sf_dir))
    return bars.withColumn("observed_lower_bound_usd", r6("observed_lower_bound_usd"))


@query(
    "c19_row_rules",
    B.with_ctes(B.EV) + f"""
SELECT 'ls_ratio' AS table_name, rule, count(*) AS rows FROM (
  SELECT unnest(list_filter([
    CASE WHEN event_id % 41 = 0 THEN 'venue_is_an_exchange' END,
    CASE WHEN event_id % 43 = 0 THEN 'symbol_is_unified' END,
    CASE WHEN event_id % 45 = 0 THEN 'kind_is_closed' END,
    CASE WHEN px > 90 THEN 'long_share_is_a_fraction' END,
    CASE WHEN event_id % 29 = 0 THEN 'period_is_positive' END], lambda x: x IS NOT NULL)) AS rule FROM ev)
GROUP BY rule""",
)
def c19(spark, sf_dir):
    eid = F.col("event_id")
    rows = bridge.events(spark, sf_dir).select(
        F.when(eid % 41 == 0, "elsewhere").otherwise(F.col("venue")).alias("venue"),
        F.when(eid % 43 == 0, "c 1").otherwise(F.col("symbol")).alias("symbol"),
        F.lit("bridge").alias("source"),
        F.when(eid % 45 == 0, "unheard_of").otherwise("taker_long_short").alias("kind"),
        (F.col("px") / 90).alias("long_share"),
        F.when(eid % 29 == 0, 0).otherwise(300).alias("period"),
    )
    return contracts.violation_counts(rows, "ls_ratio")


@query(
    "c20_key_uniqueness",
    B.with_ctes(B.EV, B.stage()) + """
SELECT venue, symbol, ts AS ts_ms, count(*) AS rows FROM stg GROUP BY ALL HAVING count(*) > 1""",
)
def c20(spark, sf_dir):
    keyed = bridge.stage(spark, sf_dir).select(
        "venue", "symbol", C.minute(C.epoch_ms(F.col("ts_ms"))).alias("ts")
    )
    return contracts.duplicate_keys(keyed, "market_1m").select(
        "venue", "symbol", F.unix_millis("ts").alias("ts_ms"), "rows"
    )
