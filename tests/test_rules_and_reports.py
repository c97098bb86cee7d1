"""Table rules, scalar vectors, statistics, samples and the query registry."""

from __future__ import annotations

import random
from decimal import Decimal

import duckdb
import numpy as np
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from perptide.functions import scalars as C
from perptide.operators import accounts as A
from perptide.operators import capability as K
from perptide.operators import contracts, history, usage
from perptide.operators import gaps as G
from perptide.operators import reports as R

TS = "timestamp'2025-01-01 00:05:00'"
GOOD = {
    "instruments": f"'binance' venue, 'BTCUSDT' venue_symbol, 'BTC' symbol, 's' source, 'trading' status, 1 mult, 8 funding_interval_h, 0.1 tick, {TS} valid_from, cast(null as timestamp) valid_to",
    "coin_universe": f"'BTC' symbol, 's' source, 'r' reason, {TS} in_from, cast(null as timestamp) in_to",
    "market_1m": f"{TS} ts, 'binance' venue, 'BTC' symbol, 's' source, 'mark_price' semantic, cast(null as double) premium, 1 mark, 1 oi_base, 1 oi_usd, 1 vol24h_usd, 8 funding_interval_h, 60 grid_s",
    "ls_ratio": f"{TS} ts, 'binance' venue, 'BTC' symbol, 's' source, 'taker_long_short' kind, 0.5 long_share, 300 period",
    "liquidations": f"{TS} ts, 'binance' venue, 'BTC' symbol, 's' source, 'e' event_id, 'long' side, 'lower_bound' completeness, 'binance_ws' ingest_path, 1 price, 1 size, cast(null as double) notional_usd",
    "divergence_1m": f"{TS} ts, 'BTC' symbol, 's' source, 2 n_venues, 0.5 oi_share_bn, 0.5 vol_share_bn",
    "metric_pctl": f"'x:BTC' scope, 'm' metric, 's' source, 0.5 pctl, 30 n, 60 grid_s, {TS} window_from, timestamp'2025-02-01' window_to",
    "metric_coverage": "'x:*' scope, 'm' metric, 's' source, 3 days_available, 60 grid_s_min",
    "source_health": "'binance' venue, 'klines' capability, 'rest' transport, 's' source, 5 latency_ms, 0 consecutive_fail",
    "ingest_gap": f"'binance' venue, 'mark' metric, 's' source, 'unknown' cause, {TS} from_ts, timestamp'2025-02-01' to_ts, 5 minutes, 10 symbols_expected, 3 symbols_present",
    "collector_run": f"'fast' lane, {TS} started_at, 's' source, 'ok' status, 1 rows_written, 0 errors, 5 duration_ms",
    "backfill_cursor": "'j' job, 'binance' venue, 'BTC' symbol, 'mark' metric, 's' source",
    "notify_log": "'digest' kind, 'k' dedupe_key, 'channel' target, 's' source, cast(null as boolean) ok, cast(null as timestamp) sent_at",
    "ops_event": f"'backup' kind, {TS} ts, 's' source, '{{}}' detail",
}
BAD = [
    ("instruments", "mult", "0", "mult_is_positive"),
    ("instruments", "valid_to", TS, "version_is_an_interval"),
    ("coin_universe", "symbol", "'btc'", "symbol_is_unified"),
    ("market_1m", "ts", "timestamp'2025-01-01 00:05:01'", "ts_is_a_minute_bucket"),
    ("market_1m", "premium", "0.1", "premium_is_hyperliquid_only"),
    ("market_1m", "funding_interval_h", "169", "funding_interval_is_positive"),
    ("ls_ratio", "long_share", "55.0", "long_share_is_a_fraction"),
    ("liquidations", "completeness", "'full'", "completeness_is_a_lower_bound"),
    ("liquidations", "side", "'SELL'", "side_is_closed"),
    ("divergence_1m", "n_venues", "3", "n_venues_is_plausible"),
    ("metric_pctl", "n", "29", "percentile_needs_thirty_observations"),
    ("metric_pctl", "n", "cast(null as int)", "percentile_needs_thirty_observations"),
    ("metric_coverage", "scope", "'x:BTC:1'", "scope_is_two_segment"),
    ("source_health", "transport", "'carrier_pigeon'", "transport_is_closed"),
    ("ingest_gap", "symbols_present", "11", "present_is_within_expected"),
    ("ingest_gap", "cause", "'gremlins'", "cause_is_closed"),
    ("collector_run", "status", "'done'", "status_is_closed"),
    ("backfill_cursor", "job", "'Job 1'", "job_is_a_tag"),
    ("notify_log", "ok", "true", "resolved_rows_have_a_time"),
    ("ops_event", "detail", "'[1]'", "detail_is_an_object"),
]


def test_every_table_accepts_a_good_row(spark):
    assert GOOD.keys() == contracts.table_rules().keys() == contracts.TABLE_KEYS.keys()
    for table, columns in GOOD.items():
        row = spark.sql(f"select {columns}")
        assert contracts.violation_counts(row, table).count() == 0, table
        assert contracts.duplicate_keys(row.unionByName(row), table).count() == 1


@pytest.mark.parametrize("table, column, value, rule", BAD)
def test_rules_name_the_fault(spark, table, column, value, rule):
    row = spark.sql(f"select {GOOD[table]}").withColumn(column, F.expr(value))
    assert [(r.rule, r.rows) for r in contracts.violation_counts(row, table).collect()] == [(rule, 1)]


def test_open_versions_and_spells(spark):
    row = spark.sql(f"select {GOOD['instruments']}")
    assert contracts.open_version_conflicts(row).count() == 0
    assert contracts.open_version_conflicts(row.unionByName(row)).count() == 1
    spell = spark.sql(f"select {GOOD['coin_universe']}")
    assert contracts.open_spell_conflicts(spell.unionByName(spell)).count() == 1


def test_scalar_vectors(spark):
    names = {"BTC": ("BTC", 1), "1000PEPE": ("PEPE", 1000), "1000000MOG": ("MOG", 1000000), "1INCH": ("1INCH", 1),
             "1MBABYDOGE": ("1MBABYDOGE", None)}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.n: (r.s, None if r.m is None else int(r.m)) for r in
           df.select("n", C.binance_symbol(F.col("n")).alias("s"), C.binance_mult(F.col("n")).alias("m")).collect()}
    assert got == names
    coins = {"kPEPE": ("PEPE", 1000), "KAITO": ("KAITO", 1), "mX": ("mX", None), "k": ("k", 1)}
    df = spark.createDataFrame([(n,) for n in coins], "n string")
    got = {r.n: (r.s, None if r.m is None else int(r.m)) for r in
           df.select("n", C.hyperliquid_symbol(F.col("n")).alias("s"), C.hyperliquid_mult(F.col("n")).alias("m")).collect()}
    assert got == coins
    rates = [("0.0000125", 1, "0.0001"), ("0.0001", 8, "0.0001"), ("0.00005", 4, "0.0001"), ("-0.0000125", 1, "-0.0001"),
             ("0", 1, "0"), (None, 1, None), ("0.1", None, None)]
    df = spark.createDataFrame([(r and Decimal(r), h, w and Decimal(w)) for r, h, w in rates],
                               "r decimal(20,12), h int, w decimal(20,12)")
    for row in df.withColumn("got", C.funding_8h(F.col("r"), F.col("h"))).collect():
        assert row.got == row.w
    bodies = {"null": "weight", " NULL\n": "weight", "<html>": "connection", "": "unrecognized", "oops": "unrecognized"}
    df = spark.createDataFrame([(b,) for b in bodies], "b string")
    assert {r.b: r.k for r in df.select("b", C.limit_body_class(F.col("b")).alias("k")).collect()} == bodies


def test_opportunistic_formula(spark):
    spend = spark.createDataFrame([("v", "b", t, 0, u, 0) for t, u in ((1, 10), (2, 790), (3, 950))],
                                  "venue string, bucket string, at_ms bigint, used_fast_lane bigint, used_resident bigint, used_opportunistic bigint")
    budget = spark.createDataFrame([("v", "b", 918, 300, 200)], "venue string, bucket string, ceiling int, reserve int, hard_cap int")
    out = {r.at_ms: r.available for r in usage.opportunistic_available(spend, budget).collect()}
    assert out == {1: 200, 2: 128, 3: 0}


BUDGET = "venue string, bucket string, egress_ceiling int, reserve int, hard_cap int"
RESERVATION = "venue string, bucket string, consumer string, reserved int, observed_max int, self_cap int, assertion boolean"


@pytest.mark.parametrize(
    "rows, verdict",
    [
        ([("a", 10, 20, None, False)], "green"),
        ([("a", 10, 101, None, False)], "yellow"),
        ([("a", 10, None, None, False)], "unknown"),
        ([("a", 0, None, None, True)], "green"),
        ([("a", 10, 60, None, False)], "yellow"),
        ([("a", 10, 101, None, False), ("b", 5, None, None, False)], "yellow"),
        ([], "green"),
    ],
)
def test_budget_verdicts(spark, rows, verdict):
    budgets = spark.createDataFrame([("v", "b", 100, 40, 10)], BUDGET)
    reservations = spark.createDataFrame([("v", "b", *r) for r in rows], RESERVATION)
    (row,) = usage.reconcile_budgets(reservations, budgets).collect()
    assert row.verdict == verdict and row.our_ceiling == 100 - sum(r[1] for r in rows)


def test_reservations_above_the_ceiling_fail(spark):
    budgets = spark.createDataFrame([("v", "b", 100, 40, 10)], BUDGET)
    reservations = spark.createDataFrame([("v", "b", "a", 101, 1, None, False)], RESERVATION)
    with pytest.raises((PySparkException, Py4JJavaError)):
        usage.reconcile_budgets(reservations, budgets).collect()


def test_capability_sheet_is_complete(spark):
    sheet = K.sheet(spark)
    assert sheet.count() == 26 and sheet.select("venue", "capability").distinct().count() == 26
    assert sheet.filter("throttled_source").select("venue", "completeness").collect() == [("binance", "lower_bound")]


def test_false_discovery_control(spark):
    rng = random.Random(6)
    rows = [("hot" if rng.random() < 0.7 else "cold", i, rng.choice([rng.random(), 0.01, 1.0])) for i in range(400)]
    df = spark.createDataFrame(rows, "family string, test_id int, p double")
    got = {r.test_id: r.p_adjusted for r in R.benjamini_hochberg(df).collect()}
    for family in ("hot", "cold"):
        tests = sorted((p, i) for f, i, p in rows if f == family)
        best = 1.0
        for rank in range(len(tests), 0, -1):
            p, i = tests[rank - 1]
            best = min(best, p * len(tests) / rank)
            assert abs(got[i] - best) < 1e-12


def test_wilson_vector(spark):
    low, high = R.wilson(F.col("s"), F.col("n"))
    row = spark.sql("select 34 s, 118 n").select(low.alias("l"), high.alias("h")).first()
    assert (round(row.l, 2), round(row.h, 2)) == (0.21, 0.38)


def test_bootstrap_brackets_the_mean(spark):
    rng = np.random.default_rng(1)
    rows = [("g", i, float(x)) for i, x in enumerate(rng.normal(5, 2, 400))]
    df = spark.createDataFrame(rows, "grp string, i bigint, value double")
    (row,) = R.block_bootstrap(spark, df, 10, 300, seed=3).collect()
    mean = np.mean([r[2] for r in rows])
    assert row.replicates == 300 and row.low < mean < row.high and row.high - row.low < 1.0


def test_state_episodes_need_their_length(spark):
    start = 1_760_000_040_000 // 60_000 * 60_000
    high = {10, 11, 12, 40, 70, 71}
    rows = [("x:BTC", "m", start + i * 60_000, 9.0 if i in high else 1.0) for i in range(200)]
    points = spark.createDataFrame(rows, "scope string, metric string, ms bigint, value double").withColumn(
        "ts", F.timestamp_millis("ms")
    )
    out = R.state_episodes(points, 2, 0.95).collect()
    assert sorted((r.from_ms - start, r.minutes) for r in out) == [(600_000, 3), (4_200_000, 2)]


def test_sample_grows_until_enough_are_usable(spark):
    rows = [(i, float(1000 - i // 2), i % 3 != 0) for i in range(60)]
    df = spark.createDataFrame(rows, "account bigint, value double, usable boolean")
    got = {r.account for r in A.sample(df, 10).collect()}
    ordered = sorted(rows, key=lambda r: (-r[1], r[0]))
    want, usable = set(), 0
    for account, _, ok in ordered:
        want.add(account)
        usable += ok
        if usable == 10:
            break
    assert got == want


def test_forced_fill_is_decided_by_the_key(spark):
    fills = ['{"liquidation":null}', '{"liquidation":{"method":"m"}}', '{"px":"1"}', '{"note":"liquidation"}']
    df = spark.createDataFrame([(f,) for f in fills], "f string")
    assert [r.x for r in df.select(A.is_forced(F.col("f")).alias("x")).collect()] == [True, True, False, False]


def test_history_closes_a_missing_contract(spark):
    rows = [("v", "A", h, 1) for h in (0, 1, 3, 4)] + [("v", "B", h, h // 3) for h in range(5)]
    snapshots = spark.createDataFrame(rows, "venue string, venue_symbol string, h int, mult int").withColumn(
        "ts", F.timestamp_seconds(F.col("h") * 3600)
    )
    out = history.scd2_history(snapshots, ["venue", "venue_symbol"], ["mult"], ["venue"])

    def hour(c):
        return (F.unix_seconds(c) / 3600).cast("int")

    got = {(r.venue_symbol, r.f, r.t, r.mult) for r in
           out.select("venue_symbol", hour("valid_from").alias("f"), hour("valid_to").alias("t"), "mult").collect()}
    assert got == {("A", 0, 2, 1), ("A", 3, None, 1), ("B", 0, 3, 0), ("B", 3, None, 1)}


def test_registry_is_consistent():
    queries, sql = entry_module.queries(), entry_module.oracle_sql()
    assert len(queries) > 100 and sql.keys() <= queries.keys()


def test_entry_returns_rows(spark):
    rows = entry_module.entry(spark).collect()
    assert rows and {"venue", "symbol", "oi_usd", "funding_rate_8h"} <= set(rows[0].asDict())


@pytest.mark.parametrize("name", ["u4_replay_late_arrivals", "a4_rolling_spend", "g2_gap_causes", "p20_false_discovery_control"])
def test_query_equals_its_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("events", "lineitem", "orders", "customer"):
        con.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    cursor = con.execute(entry_module.oracle_sql()[name])
    columns = sorted(c[0] for c in cursor.description)
    order = [[c[0] for c in cursor.description].index(c) for c in columns]
    want = sorted(str([r[i] for i in order]) for r in cursor.fetchall())
    got = sorted(str([r[c] for c in columns]) for r in entry_module.queries()[name](spark, folder).collect())
    assert got == want


@pytest.mark.parametrize("name", ["a5_opportunistic_availability", "a6_connection_usage"])
def test_limits_meet_usage_without_a_shuffle_by_their_few_keys(spark, name):
    """Two venues and two buckets would put all rows into as many tasks."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "8000")
    try:
        query = entry_module.queries()[name](spark, "/root/testdata/sf0.001")
        plan = query._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(threshold)
    joins = [line for line in plan.splitlines() if "Join [venue#" in line]
    limits = [line for line in joins if "at_ms#" not in line and "_chunk#" not in line]
    assert limits and all("BroadcastHashJoin" in line for line in limits)


def test_bootstrap_width_is_that_of_independent_draws(spark):
    rng = np.random.default_rng(11)
    n, block, replicates = 60_000, 20, 800
    values = rng.normal(0, 1, n)
    rows = [("g", i, float(x)) for i, x in enumerate(values)]
    df = spark.createDataFrame(rows, "grp string, i bigint, value double")
    (row,) = R.block_bootstrap(spark, df, block, replicates, seed=5).collect()
    sums = values.reshape(-1, block).sum(axis=1)
    drawn = rng.integers(0, len(sums), (4000, len(sums)))
    means = sums[drawn].mean(axis=1) / block
    width = np.quantile(means, 0.975) - np.quantile(means, 0.025)
    assert abs((row.high - row.low) / width - 1) < 0.1
    assert R.poisson_thresholds()[:2] == [6171993, 12343986]


def test_open_cause_reaches_to_the_last_gap(spark):
    gaps = spark.createDataFrame(
        [("v", "m", 0, 120_000, 2, 3, 1, "unknown"), ("v", "m", 600_000, 660_000, 1, 3, 1, "unknown"),
         ("w", "m", 0, 60_000, 1, 3, 1, "unknown")],
        "venue string, metric string, from_ms bigint, to_ms bigint, minutes int, symbols_expected int, "
        "symbols_present int, cause string",
    )
    causes = spark.createDataFrame(
        [("v", 300_000, None, "egress_down")], "venue string, from_ms bigint, to_ms bigint, cause string"
    )
    out = {(r.venue, r.from_ms): r.cause for r in G.attribute_causes(gaps, causes).collect()}
    assert out == {("v", 0): "unknown", ("v", 600_000): "egress_down", ("w", 0): "unknown"}
