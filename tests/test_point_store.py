"""Day counts that add up to percentiles, days rewritten by a backfill, and expiry of whole days."""

from __future__ import annotations

import datetime as dt
import os
import random
import re

import pytest

from perptide.operators import divergence as D
from perptide.sources.point_store import PointStore
from pyspark.sql import functions as F

T = dt.datetime(2024, 3, 1, tzinfo=dt.UTC)


def points(spark, rng, days=45, scopes=("a:X", "b:X", "x:*"), every=90):
    rows = []
    for scope in scopes:
        for minute in range(0, days * 1440, every):
            if rng.random() < 0.9:
                value = None if rng.random() < 0.05 else float(rng.randint(0, 40))
                rows.append((scope, "m", T + dt.timedelta(minutes=minute), value, 60 if minute > 20_000 else 300, False))
    rows.append(("few:X", "m", T + dt.timedelta(days=40), 1.0, 60, False))
    return spark.createDataFrame(rows, "scope string, metric string, ts timestamp, value double, grid_s int, backfilled boolean")


def same(a, b):
    columns = ["scope", "metric", "value", "pctl", "n", "grid_s", "updated", "window_from", "window_to"]
    assert sorted(map(str, a.select(*columns).collect())) == sorted(map(str, b.select(*columns).collect()))


@pytest.mark.parametrize("as_of", [T + dt.timedelta(days=40, hours=7, minutes=3), T + dt.timedelta(days=35), T + dt.timedelta(days=9)])
def test_equal_to_counting_the_window(spark, tmp_path, as_of):
    rows = points(spark, random.Random(1))
    store = PointStore(spark, str(tmp_path / "p"))
    store.write_days(rows)
    same(store.percentiles(as_of, 30), D.percentiles(rows, F.lit(as_of).cast("timestamp")))


def test_a_window_reads_its_days_only(spark, tmp_path):
    store = PointStore(spark, str(tmp_path / "p"))
    store.write_days(points(spark, random.Random(2), days=60))
    as_of = T + dt.timedelta(days=50, hours=7)
    plan = store.percentiles(as_of, 30)._jdf.queryExecution().executedPlan()
    filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan.toString())
    edges = [f for f in filters if "IN (" in f]
    whole = [f for f in filters if "(day" in f and ">" in f and "<" in f]
    assert edges and whole and len(edges) + len(whole) == len(filters)
    first, last = (as_of - dt.timedelta(days=30)).strftime("%Y%m%d"), as_of.strftime("%Y%m%d")
    assert all(first in f and last in f for f in filters)
    days = [r["day"] for r in store._read("counts", "day string").filter((F.col("day") > first) & (F.col("day") < last)).distinct().collect()]
    assert len(days) == 29  # and the two days at the ends: 31


def test_backfill_rewrites_its_days_and_refreshes_its_series(spark, tmp_path):
    rng = random.Random(3)
    before = points(spark, rng)
    store = PointStore(spark, str(tmp_path / "p"))
    store.write_days(before)
    as_of = T + dt.timedelta(days=40, hours=1)
    stored = spark.createDataFrame(store.percentiles(as_of, 30).collect(), store.percentiles(as_of, 30).schema)
    late = spark.createDataFrame(
        [("a:X", "m", T + dt.timedelta(days=30, minutes=i), 3.5, 60, True) for i in range(50)]
        + [("b:X", "m", T + dt.timedelta(days=2, minutes=1), 9.0, 300, True)],
        before.schema,
    )
    kept = {f: os.stat(f).st_mtime_ns for f in _files(tmp_path / "p")}
    after = before.unionByName(late)
    days = ["20240331", "20240303"]
    store.write_days(after.filter(F.date_format("ts", "yyyyMMdd").isin(*days)))
    touched = late.groupBy("scope").agg(F.min("ts").alias("from_ts"), F.max("ts").alias("to_ts"))
    same(store.refreshed(stored, touched, as_of, 30), D.percentiles(after, F.lit(as_of).cast("timestamp")))
    assert {f for f in kept if not any(d in f for d in days)} <= set(_files(tmp_path / "p"))
    untouched = {f: t for f, t in kept.items() if not any(d in f for d in days)}
    assert {f: os.stat(f).st_mtime_ns for f in untouched} == untouched


def _files(root):
    return [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")]


def test_expiry_deletes_old_days_and_no_other(spark, tmp_path):
    store = PointStore(spark, str(tmp_path / "p"))
    store.write_days(points(spark, random.Random(4), days=12))
    total = store.points().count()
    old = store.points().filter("day < '20240305'").count()
    assert store.expire("20240305") == 4
    assert store.points().count() == total - old
    folders = os.listdir(tmp_path / "p" / "points")
    assert sorted(f for f in folders if f.startswith("day="))[0] == "day=20240305"
    assert store.expire("20240305") == 0 and store.expire("20240301") == 0
    assert store.first_day() == "20240305"


def test_empty(spark, tmp_path):
    store = PointStore(spark, str(tmp_path / "p"))
    store.write_days(points(spark, random.Random(5), days=1).limit(0))
    assert store.percentiles(T, 30).count() == 0
