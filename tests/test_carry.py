"""Chunked running values, frames, islands and quantiles against brute force."""

from __future__ import annotations

import math
import random
from decimal import Decimal

import numpy as np
from pyspark.sql import functions as F

from perptide.operators import carry
from perptide.operators.quantiles import exact_quantiles


def skewed(n=1500, seed=3, span=400_000):
    """One key holds most rows, and instants repeat."""
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < 0.7 else f"k{rng.randint(0, 5)}", rng.randint(-span, span), rng.randint(-9, 9), i)
        for i in range(n)
    ]


def test_running_sum_and_max_across_chunks(spark):
    rows = skewed()
    df = spark.createDataFrame(rows, "k string, at bigint, v bigint, i bigint")
    chunk = carry.chunk_of(F.col("at"), 10_000)
    out = carry.running(df, ["k"], ["at", "i"], F.col("v"), "total", how="sum", chunk=chunk)
    out = carry.running(out, ["k"], ["at", "i"], F.col("v"), "top", how="max", chunk=chunk, inclusive=False)
    got = {r.i: (r.total, r.top) for r in out.collect()}
    for k in {r[0] for r in rows}:
        total, top = 0, None
        for _, _, v, i in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[3])):
            total += v
            assert got[i] == (total, top)
            top = v if top is None else max(top, v)


def test_trailing_sums_open_left_frame(spark):
    rows = [("k", 1000 * i, 1, 0) for i in range(60)] + [("k", 60_000, 5, 0), ("k", 60_001, 7, 0)] + skewed()
    df = spark.createDataFrame(rows, "k string, at_ms bigint, cost bigint, i bigint")
    out = carry.trailing_sums(df, ["k"], "at_ms", 60_000, ["cost"]).collect()
    assert len(out) == len({(r[0], r[1]) for r in rows})
    for r in out:
        want = sum(c for k, at, c, _ in rows if k == r.k and r.at_ms - 60_000 < at <= r.at_ms)
        assert r.cost == want


def test_sixty_charges_leave_after_the_window(spark):
    df = spark.createDataFrame([("k", i, 1) for i in range(60)] + [("k", 60_059, 0)], "k string, at_ms bigint, cost bigint")
    out = {r.at_ms: r.cost for r in carry.trailing_sums(df, ["k"], "at_ms", 60_000, ["cost"]).collect()}
    assert out[59] == 60 and out[60_059] == 0


def test_trailing_sums_add_up_no_frame_anew(spark):
    df = spark.createDataFrame([("k", i, 1) for i in range(10)], "k string, at_ms bigint, cost bigint")
    plan = carry.trailing_sums(df, ["k"], "at_ms", 60_000, ["cost"])._jdf.queryExecution().executedPlan().toString()
    assert "specifiedwindowframe" in plan and "-59999" not in plan


def test_trailing_sums_of_unknown_huge_and_decimal_values(spark):
    rng = random.Random(4)
    rows = [
        (rng.choice(["k", None]), rng.randint(-500, 500), rng.choice([None, 1, 1 << 40]), rng.choice([None, 1e17, 0.25]),
         rng.choice([None, Decimal("0.0000000001"), Decimal("9999999999.9999999999")]))
        for _ in range(400)
    ]
    rows += [("k", None, 7, 7.0, Decimal(7)), ("late", 10_000, None, None, None)]
    df = spark.createDataFrame(rows, "k string, at_ms bigint, a bigint, b double, c decimal(20,10)")
    out = carry.trailing_sums(df, ["k"], "at_ms", 100, ["a", "b", "c"])
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "bigint", "bigint", "double", "decimal(38,10)"]
    got = {(r.k, r.at_ms): r for r in out.collect()}
    assert got.keys() == {r[:2] for r in rows if r[1] is not None}
    for (k, at), r in got.items():
        frame = [x for x in rows if x[0] == k and x[1] is not None and at - 100 < x[1] <= at]
        for i, name in enumerate("abc", 2):
            values = [x[i] for x in frame if x[i] is not None]
            if name == "b" and values:
                assert abs(r.b - math.fsum(values)) <= 1e-12 * math.fsum(values)
            else:
                assert r[name] == (sum(values) if values else None)


def test_islands_cross_day_boundaries(spark):
    day = carry.DAY_MS
    steps = [("a", day - 120_000 + 60_000 * i) for i in range(6)] + [("a", day + 3_600_000), ("b", day)]
    df = spark.createDataFrame(steps, "k string, at bigint")
    out = {(r.k, r.at): r.island_ms for r in carry.islands(df, ["k"], "at").collect()}
    assert {out["a", s] for _, s in steps[:6]} == {day - 120_000}
    assert out["a", day + 3_600_000] == day + 3_600_000 and out["b", day] == day


def test_merge_intervals(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(400):
        start = rng.randint(0, 10 * carry.DAY_MS)
        rows.append((rng.choice("ab"), start, start + rng.randint(0, 3_600_000 * 5)))
    df = spark.createDataFrame(rows, "k string, f bigint, t bigint")
    out = carry.merge_intervals(df, ["k"], "f", "t", F.count("*").alias("n")).collect()
    got = sorted((r.k, r.span_from_ms, r.span_to_ms, r.n) for r in out)
    want = []
    for k in "ab":
        current = None
        for _, f, t in sorted(r for r in rows if r[0] == k):
            if current is None or f > current[2]:
                current = [k, f, t, 1]
                want.append(current)
            else:
                current[2] = max(current[2], t)
                current[3] += 1
    assert got == sorted(tuple(w) for w in want)


def test_exact_quantiles(spark):
    rng = random.Random(11)
    values = [("hot" if rng.random() < 0.6 else "k", rng.choice([0.0, round(rng.uniform(-500, 9000), 2)])) for _ in range(3000)]
    values += [("one", 4.5), ("neg", -1.0), ("neg", -3.0)]
    df = spark.createDataFrame([*values, ("one", None)], "k string, x double")
    out = {r.k: r for r in exact_quantiles(df, ["k"], "x", {"a": 0.05, "b": 0.5, "c": 0.95}).collect()}
    for k in ("hot", "k", "one", "neg"):
        xs = [x for kk, x in values if kk == k]
        assert out[k].n == len(xs)
        for name, q in (("a", 0.05), ("b", 0.5), ("c", 0.95)):
            assert abs(out[k][name] - np.quantile(xs, q)) < 1e-9
