"""Ranks and quantiles of hot keys: narrow bands and ties are spread over slices, results stay exact."""

from __future__ import annotations

import random

import pytest

from perptide.operators import ranks as K
from perptide.operators import reports as R
from perptide.operators.quantiles import exact_quantiles
from pyspark.sql import functions as F


def test_a_series_inside_one_percent_is_spread(spark):
    # 20,000 prices between 60,000 and 60,600: one magnitude, one 64th of an octave.
    band = spark.range(20_000).select(
        F.lit("BTC").alias("k"), (60_000 + F.pmod(F.col("id") * 7919, F.lit(20_000)) * 0.03).alias("x")
    )
    few = spark.range(50).select(F.lit("few").alias("k"), F.col("id").cast("double").alias("x"))
    both = band.unionByName(few)
    dealt = K.sliced(both, ["k"], F.col("x"), rows_a_slice=1000)
    sizes = {(r["k"], r["_slice"]): r["count"] for r in dealt.groupBy("k", "_slice").count().collect()}
    large = [n for (k, _), n in sizes.items() if k == "BTC"]
    assert len(large) > 200 and max(large) < 4 * 20_000 / K.SLICES and sum(large) == 20_000
    assert {s for k, s in sizes if k == "few"} == {0}
    ordered = dealt.filter("k = 'BTC'").groupBy("_slice").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    rows = sorted(ordered.collect())
    assert all(a["hi"] < b["lo"] for a, b in zip(rows, rows[1:]))
    got = exact_quantiles(both, ["k"], "x", {"a": 0.05, "b": 0.95}, rows_a_slice=1000).collect()
    by_key = {r["k"]: (r["n"], round(r["a"], 6), round(r["b"], 6)) for r in got}
    values = [60_000 + i * 0.03 for i in range(20_000)]
    at = lambda q: values[int(q * 19_999)] + (q * 19_999 % 1) * 0.03
    assert by_key == {"BTC": (20_000, round(at(0.05), 6), round(at(0.95), 6)), "few": (50, 2.45, 46.55)}


def brute(tests):
    out = {}
    for family in {f for f, _, _ in tests}:
        own = sorted((p, i) for f, i, p in tests if f == family)
        lowest = float("inf")
        for rank in range(len(own), 0, -1):
            p, i = own[rank - 1]
            lowest = min(lowest, p * len(own) / rank)
            out[family, i] = (rank, round(min(1.0, lowest), 9))
    return out


@pytest.mark.parametrize("text_ids", [False, True])
def test_a_mass_of_equal_p_values(spark, text_ids):
    rng = random.Random(2)
    name = (lambda i: f"t{i:05d}") if text_ids else (lambda i: i)
    tests = [("big", name(i), 1.0 if i % 3 else rng.random() ** 3) for i in range(6000)]
    tests += [("small", name(i), rng.choice([0.001, 0.02, 0.5])) for i in range(40)]
    df = spark.createDataFrame(tests, f"family string, test_id {'string' if text_ids else 'long'}, p double")
    got = R.benjamini_hochberg(df, rows_a_slice=100).collect()
    assert {(r["family"], r["test_id"]): (r["rank"], round(r["p_adjusted"], 9)) for r in got} == brute(tests)
    if not text_ids:
        ties = K.sliced(df, ["family", "p"], F.col("test_id"), rows_a_slice=100).filter("p = 1.0")
        sizes = [r["count"] for r in ties.groupBy("_slice").count().collect()]
        assert len(sizes) > 200 and max(sizes) < 4 * 4000 / K.SLICES


def test_empty_and_null_values(spark):
    empty = spark.createDataFrame([], "k string, x double")
    assert exact_quantiles(empty, ["k"], "x", {"a": 0.5}).count() == 0
    nothing = spark.createDataFrame([("k", None), ("k", 2.0)], "k string, x double")
    assert [r["a"] for r in exact_quantiles(nothing, ["k"], "x", {"a": 0.5}).collect()] == [2.0]
