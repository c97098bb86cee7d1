"""The upsert cases, each on a coin of its own so that all run in one pass."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from perptide import schemas as S
from perptide.operators import merge
from perptide.operators.asof import multiplier_segments

B = 1_760_000_040_000 // 60_000 * 60_000  # a minute boundary
DAY = 86_400_000
COLUMNS = list(S.STAGE)


def record(symbol, offset_s, *, bucket=B, **values):
    at = bucket + int(offset_s * 1000)
    row = {c: None for c in COLUMNS}
    row.update(
        venue="binance", symbol=symbol, ts_ms=at, ingest_ts_ms=at + 400, source="binance_rest_premium_index",
        semantic="mark_price", backfilled=False,
    )
    row.update(values)
    for name, kind in S.STAGE.items():
        if kind.startswith("decimal") and row[name] is not None:
            row[name] = Decimal(str(row[name]))
    return row


def fast(symbol, offset_s, mark=65000, **kw):
    at = kw.get("bucket", B) + int(offset_s * 1000)
    return record(symbol, offset_s, mark=mark, index_px=mark, funding_rate="0.0001", funding_interval_h=8,
                  obs_ts_fast_ms=at, **kw)


def slow(symbol, offset_s, oi=1000, **kw):
    at = kw.get("bucket", B) + int(offset_s * 1000)
    return record(symbol, offset_s, oi_base=oi, vol24h_usd=5, chg24h_pct=1, obs_ts_slow_ms=at, **kw)


def back(symbol, offset_s, grid, mark=None, oi=None, **kw):
    at = kw.get("bucket", B) + int(offset_s * 1000)
    return record(
        symbol, offset_s, mark=mark, oi_base=oi, semantic="candle_close", source="binance_rest_klines",
        obs_ts_fast_ms=at if mark is not None else None, obs_ts_slow_ms=at if oi is not None else None,
        grid_s=grid, backfilled=True, **kw,
    )


# Per coin: the batches in order.
CASES = {
    "K1": [[fast("K1", 37.5)]],
    "K2": [[fast("K2", 1, 1), fast("K2", 31, 2)]],
    "K3": [[fast("K3", 30)], [fast("K3", 5, 1)]],
    "K4": [[fast("K4", 5)], [fast("K4", 35, 2)]],
    "K6": [[slow("K6", 30)], [slow("K6", 5, 7)]],
    "K7": [[fast("K7", 1)], [slow("K7", 2)]],
    "K8": [[fast("K8", 1)], [back("K8", 50, 300, 1)]],
    "K9": [[back("K9", 50, 60, 5)], [back("K9", 50, 300, 6)]],
    "K10": [[back("K10", 50, 300, 5)], [back("K10", 50, 60, 64000)]],
    "K11": [[back("K11", 50, 300, 5)], [fast("K11", 1)]],
    "K12": [[back("K12", 50, 300, 5)], [back("K12", 50, 300, None, 9)]],
    "K13": [[slow("K13", 1)]],
    "K14": [[slow("K14", 1)], [fast("K14", 2)]],
    "K15": [[fast("K15", 2)], [slow("K15", 1)]],
    "K16": [[fast("K16", 30)], [slow("K16", 31)], [fast("K16", 1, 1)]],
    "K17": [[fast("K17", 1, "0.0074")], [slow("K17", 2, 5_000_000)]],
    "K18": [[fast("K18", 1)], [slow("K18", 2)]],
    "K20": [
        [fast("K20", 1, "0.0074"), slow("K20", 2, 5_000_000),
         fast("K20", 1, "0.0074", bucket=B - 5 * DAY), slow("K20", 2, 5_000_000, bucket=B - 5 * DAY)],
    ],
    "TIE": [[fast("TIE", 5, 1)], [fast("TIE", 5, 2)]],
    "KEEP": [[slow("KEEP", 1)], [back("KEEP", 50, 60, 5)]],
    "TURN": [[back("TURN", 10, 60, 5, 9)], [fast("TURN", 20)]],
    "EARLY": [[fast("EARLY", 1), slow("EARLY", 2)]],
}


def instant(ms):
    return dt.datetime.fromtimestamp(ms / 1000, dt.UTC)


@pytest.fixture(scope="module")
def segments(spark):
    rows = [
        ("binance", f"{s}USDT", s, instant(B - 90 * DAY), None, Decimal(1000 if s == "K17" else 1))
        for s in CASES
        if s not in ("K18", "K20", "EARLY")
    ]
    rows += [
        ("binance", "1000K20USDT", "K20", instant(B - 90 * DAY), instant(B - DAY), Decimal(1000)),
        ("binance", "K20USDT", "K20", instant(B - DAY), None, Decimal(1)),
        ("binance", "EARLYUSDT", "EARLY", instant(B + DAY), instant(B + 2 * DAY), Decimal(10)),
        ("binance", "EARLY2USDT", "EARLY", instant(B + 3 * DAY), None, Decimal(1)),
    ]
    df = spark.createDataFrame(
        rows,
        "venue string, venue_symbol string, symbol string, valid_from timestamp, valid_to timestamp, "
        "mult decimal(12,0)",
    )
    return multiplier_segments(df)


def frame(spark, rows, extra=()):
    schema = {**S.STAGE, **{e: "bigint" for e in extra}}
    return spark.createDataFrame([tuple(r[c] for c in schema) for r in rows], S.ddl(schema))


@pytest.fixture(scope="module")
def stepwise(spark, segments):
    """Every case applied one statement at a time; also how many rows each step wrote."""
    target = merge.empty_target(spark)
    changed = {}
    for step in range(max(len(b) for b in CASES.values())):
        rows = [r for b in CASES.values() if step < len(b) for r in b[step]]
        batch = frame(spark, rows)
        for apply in (merge.upsert_fast, merge.upsert_slow, merge.upsert_backfill):
            result = apply(target, batch, segments).collect()
            for row in result:
                if row.applied:
                    changed[row.symbol, step] = changed.get((row.symbol, step), 0) + 1
            target = spark.createDataFrame(
                [tuple(r[c] for c in merge.COLUMNS) for r in result], S.ddl(S.MARKET_1M)
            )
    rows = {(r.symbol, int(r.ts.timestamp() * 1000)): r for r in target.collect()}
    return rows, changed


def at(stepwise, symbol, bucket=B):
    return stepwise[0][symbol, bucket]


def ms(value):
    return int(value.timestamp() * 1000)


def test_bucket_is_the_minute_and_instant_is_kept(stepwise):
    row = at(stepwise, "K1")
    assert ms(row.ts) == B and ms(row.obs_ts_fast) == B + 37_500


def test_newest_of_one_batch_wins(stepwise):
    assert at(stepwise, "K2").mark == 2


def test_stale_fast_changes_nothing(stepwise):
    assert ("K3", 1) not in stepwise[1] and at(stepwise, "K3").mark == 65000


def test_newer_fast_applies(stepwise):
    assert stepwise[1]["K4", 1] == 1 and at(stepwise, "K4").mark == 2


def test_stale_slow_changes_nothing(stepwise):
    assert ("K6", 1) not in stepwise[1] and at(stepwise, "K6").oi_base == 1000


def test_slow_leaves_the_fast_group(stepwise):
    row = at(stepwise, "K7")
    assert row.mark == 65000 and row.oi_base == 1000 and row.funding_interval_h == 8


def test_backfill_never_touches_a_live_row(stepwise):
    row = at(stepwise, "K8")
    assert ("K8", 1) not in stepwise[1]
    assert (row.backfilled, row.grid_s, row.semantic) == (False, 60, "mark_price")


def test_coarser_backfill_is_refused(stepwise):
    assert ("K9", 1) not in stepwise[1] and at(stepwise, "K9").grid_s == 60


def test_finer_backfill_applies(stepwise):
    row = at(stepwise, "K10")
    assert (row.grid_s, row.mark, row.backfilled) == (60, 64000, True)


def test_older_live_beats_backfill(stepwise):
    row = at(stepwise, "K11")
    assert (row.mark, row.backfilled, row.grid_s) == (65000, False, 60)


def test_two_backfills_complete_each_other(stepwise):
    row = at(stepwise, "K12")
    assert row.mark == 5 and row.oi_base == 9


def test_oi_usd_needs_both_factors(stepwise):
    assert at(stepwise, "K13").oi_usd is None


@pytest.mark.parametrize("symbol", ["K14", "K15", "K16"])
def test_oi_usd_in_any_arrival_order(stepwise, symbol):
    assert at(stepwise, symbol).oi_usd == 65_000_000


def test_stale_fast_does_not_revalue(stepwise):
    assert ("K16", 2) not in stepwise[1]


def test_oi_usd_divides_by_the_multiplier(stepwise):
    assert at(stepwise, "K17").oi_usd == 37


def test_no_instrument_means_no_oi_usd(stepwise):
    row = at(stepwise, "K18")
    assert row.oi_usd is None and row.mark == 65000 and row.oi_base == 1000


def test_multiplier_of_the_minute_is_used(stepwise):
    assert at(stepwise, "K20", B - 5 * DAY).oi_usd == 37
    assert at(stepwise, "K20").oi_usd == 37_000


def test_nearest_version_before_the_first(stepwise):
    assert at(stepwise, "EARLY").oi_usd == 6_500_000


def test_tie_keeps_the_first(stepwise):
    assert at(stepwise, "TIE").mark == 1


def test_live_row_without_a_lane_refuses_backfill(stepwise):
    assert at(stepwise, "KEEP").mark is None


def test_backfilled_slow_group_survives_the_turn_to_live(stepwise):
    row = at(stepwise, "TURN")
    assert (row.backfilled, row.mark, row.oi_base) == (False, 65000, 9)


def test_fast_statement_ignores_slow_fields(spark, segments):
    row = fast("K5", 1)
    row.update(oi_base=Decimal(3), obs_ts_slow_ms=B + 1000)
    out = merge.upsert_fast(merge.empty_target(spark), frame(spark, [row]), segments).collect()
    assert out[0].oi_base is None and out[0].obs_ts_slow is None


def test_staged_oi_usd_is_rejected(spark):
    row = fast("K19", 1)
    row["oi_usd"] = Decimal(1)
    with pytest.raises(PySparkException):
        merge.staged(frame(spark, [row])).collect()


def test_replay_equals_the_statements(spark, segments, stepwise):
    rows = [
        {**r, "batch_seq": step} for b in CASES.values() for step, batch in enumerate(b) for r in batch
    ]
    out = merge.replay(frame(spark, rows, ["batch_seq"]), segments).collect()
    expected = {k: tuple(r[c] for c in merge.COLUMNS) for k, r in stepwise[0].items()}
    assert {(r.symbol, ms(r.ts)): tuple(r[c] for c in merge.COLUMNS) for r in out} == expected
