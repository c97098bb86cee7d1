"""The stored minute table: work by touched months, lists of generations, old files deleted safely."""

from __future__ import annotations

import os
import re
from decimal import Decimal

import pytest

from perptide import schemas as S
from perptide.operators import merge
from perptide.sources.minute_store import LANES, MinuteStore, _inside
from pyspark.sql import functions as F

JAN, FEB, MAR = 1_704_067_200_000, 1_706_745_600_000, 1_709_251_200_000
SEGMENTS = "venue string, symbol string, seg_from_us bigint, seg_to_us bigint, mult decimal(12,0)"


@pytest.fixture(scope="module")
def segments(spark):
    return spark.createDataFrame([("binance", "BTC", -(2**62), 2**62, Decimal(2))], SEGMENTS)


def batch(spark, *rows):
    full = []
    for at, values in rows:
        row = {c: None for c in S.STAGE}
        row.update(venue="binance", symbol="BTC", source="t", semantic="mark_price", backfilled=False)
        row.update(ts_ms=at, ingest_ts_ms=at + 1, **values)
        full.append(tuple(row[c] for c in S.STAGE))
    return spark.createDataFrame(full, S.ddl(S.STAGE))


def fast(at, mark):
    return at, dict(mark=Decimal(mark), obs_ts_fast_ms=at)


def slow(at, oi):
    return at, dict(oi_base=Decimal(oi), obs_ts_slow_ms=at)


def backfill(at, mark):
    return at, dict(mark=Decimal(mark), obs_ts_fast_ms=at, grid_s=60, backfilled=True)


def files(root):
    return {
        os.path.relpath(os.path.join(d, f), root): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(root)
        for f in names
        if f.endswith(".parquet")
    }


def of_month(found, month):
    return {k: v for k, v in found.items() if f"month={month}" in k}


def scanned_months(df):
    return set(re.findall(r"month=(\d{6})", " ".join(df.inputFiles())))


def table(df):
    return sorted(map(str, df.select(*merge.COLUMNS).collect()))


def test_compaction_touches_the_months_of_its_batches_only(spark, segments, tmp_path):
    store = MinuteStore(spark, str(tmp_path / "s"))
    store.append(batch(spark, fast(JAN, 1), fast(FEB, 2), slow(MAR, 3)), 0)
    first = store.compact(segments, 0)
    before = files(tmp_path / "s" / "base")
    assert {k[:12] for k in before} == {"month=202401", "month=202402", "month=202403"}
    store.append(batch(spark, slow(FEB + 5, 9)), 1)
    second = store.compact(segments, 1, first)
    after = files(tmp_path / "s" / "base")
    for month in ("202401", "202403"):
        assert of_month(after, month) == of_month(before, month)
    assert {k.split("/")[1] for k in of_month(after, "202402")} == {"generation=0", "generation=1"}
    everything = merge.replay(store.log().drop("month"), segments)
    assert table(store.read(segments, second)) == table(everything)
    assert table(store.read(segments, first)) == table(everything)
    assert store.compact(segments, 1, second) == second + 1  # nothing new: a list, no month files
    assert files(tmp_path / "s" / "base") == after


def test_one_month_is_scanned_for_a_batch_of_one_month(spark, segments, tmp_path):
    store = MinuteStore(spark, str(tmp_path / "s"))
    store.append(batch(spark, fast(JAN, 1), fast(FEB, 2), fast(MAR, 3)), 0)
    generation = store.compact(segments, 0)
    store.append(batch(spark, fast(FEB + 1, 7)), 1)
    store.append(batch(spark, fast(MAR + 1, 8)), 2)
    part = store.read(segments, generation, months=["202402"])
    assert scanned_months(store.base(generation, ["202402"])) == {"202402"}
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan or "PartitionFilters: [(month" in plan
    assert [r["mark"] for r in part.collect()] == [7]
    assert scanned_months(store.base(generation)) == {"202401", "202402", "202403"}
    assert store.base(generation, ["202512"]).count() == 0


def test_statements_on_stored_months_equal_statements_on_the_table(spark, segments, tmp_path):
    store = MinuteStore(spark, str(tmp_path / "s"))
    chain = [
        ("backfill", [backfill(JAN, 1), backfill(FEB, 2)]),
        ("fast", [fast(FEB + 3, 5), fast(MAR, 6)]),
        ("slow", [slow(FEB + 9, 40), slow(JAN + 60_000, 8)]),
        ("backfill", [backfill(FEB, 77), backfill(MAR + 60_000, 4)]),
    ]
    generation, whole = None, merge.empty_target(spark)
    apply = {"fast": merge.upsert_fast, "slow": merge.upsert_slow, "backfill": merge.upsert_backfill}
    seen = {}
    for statement, rows in chain:
        stage = batch(spark, *rows)
        now = files(tmp_path / "s" / "base")
        generation = store.upsert(stage, segments, statement, generation)
        whole = apply[statement](whole, stage, segments).drop("applied")
        seen[generation] = files(tmp_path / "s" / "base").keys() - now.keys()
    assert table(store.base(generation)) == table(whole)
    assert {m[6:12] for m in seen[1]} == {"202402", "202403"}
    assert {m[6:12] for m in seen[3]} == {"202402", "202403"}


def test_vacuum_keeps_what_is_listed(spark, segments, tmp_path):
    store = MinuteStore(spark, str(tmp_path / "s"))
    store.append(batch(spark, fast(JAN, 1), fast(FEB, 2)), 0)
    first = store.compact(segments, 0)
    store.append(batch(spark, fast(FEB + 4, 3)), 1)
    second = store.compact(segments, 1, first)
    rows = table(store.base(second))
    assert store.vacuum([first, second]) == 0
    assert store.vacuum([second]) == 2  # the first list, and its February
    assert table(store.base(second)) == rows
    assert {k[:25] for k in files(tmp_path / "s" / "base")} == {"month=202401/generation=0", "month=202402/generation=1"}


def test_stored_values_stay_where_nothing_changed(spark, segments, tmp_path):
    store = MinuteStore(spark, str(tmp_path / "s"))
    store.append(batch(spark, (JAN, dict(mark=Decimal(10), obs_ts_fast_ms=JAN, oi_base=Decimal(4), obs_ts_slow_ms=JAN)),
                       slow(JAN + 60_000, 1)), 0)
    generation = store.compact(segments, 0)
    other = segments.withColumn("mult", F.lit(Decimal(4)).cast("decimal(12,0)"))
    store.append(batch(spark, fast(JAN + 60_000, 6)), 1)
    valued = {r["ts"].minute: r["oi_usd"] for r in store.read(other, generation).collect()}
    assert valued == {0: Decimal(20), 1: Decimal("1.5")}


def test_limits_are_one_lookup_for_any_number_of_lanes(spark):
    rows = spark.range(4 * LANES).select((F.col("id")).alias("batch_seq"))
    limits = {lane: lane % 4 - 1 for lane in range(LANES - 1)}
    inside = {r["batch_seq"] for r in rows.filter(_inside(limits)).collect()}
    assert inside == {n for n in range(4 * LANES) if n % LANES in limits and n // LANES <= limits[n % LANES]}
    assert rows.filter(_inside({})).count() == 0
