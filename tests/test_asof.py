"""Multiplier segments against a brute-force lookup."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

from perptide.operators import asof, symbols
from perptide.operators.asof import multiplier_segments, with_multiplier
from pyspark.sql import Row
from pyspark.sql import functions as F

T = dt.datetime(2025, 1, 1, tzinfo=dt.UTC)


def minutes(n):
    return T + dt.timedelta(minutes=n)


def brute(versions, at):
    usable = [v for v in versions if v["mult"] is not None and v["mult"] > 0]
    if not usable:
        return None

    def rank(v):
        covers = v["f"] <= at and (v["t"] is None or v["t"] > at)
        return (not covers, abs(v["f"] - at), v["f"], v["name"])

    return min(usable, key=rank)["mult"]


def test_segments_match_brute_force(spark):
    rng = random.Random(5)
    coins, rows = {}, []
    for i in range(60):
        versions = []
        for contract in range(rng.randint(1, 3)):
            start = rng.randint(0, 40)
            for _ in range(rng.randint(1, 4)):
                end = None if rng.random() < 0.2 else start + rng.randint(1, 30)
                versions.append(
                    {"name": f"X{contract}", "f": start, "t": end, "mult": rng.choice([1, 1000, None, 10])}
                )
                if end is None:
                    break
                start = end + rng.randint(0, 10)
        coins[f"C{i}"] = versions
        rows += [
            ("binance", f"C{i}{v['name']}", f"C{i}", minutes(v["f"]),
             None if v["t"] is None else minutes(v["t"]),
             None if v["mult"] is None else Decimal(v["mult"]))
            for v in versions
        ]
    instruments = spark.createDataFrame(
        rows,
        "venue string, venue_symbol string, symbol string, valid_from timestamp, valid_to timestamp, "
        "mult decimal(12,0)",
    )
    probes = spark.createDataFrame(
        [("binance", c, minutes(m)) for c in coins for m in range(-10, 160)],
        "venue string, symbol string, ts timestamp",
    )
    out = with_multiplier(probes, multiplier_segments(instruments)).collect()
    assert len(out) == len(coins) * 170
    for row in out:
        m = round((row.ts.replace(tzinfo=dt.UTC) if row.ts.tzinfo is None else row.ts).timestamp() - T.timestamp()) // 60
        want = brute(coins[row.symbol], m)
        assert (None if row.mult is None else int(row.mult)) == want, (row.symbol, m, coins[row.symbol])


def test_lookup_over_years_meets_the_segments_of_one_month_only(spark):
    rng = random.Random(11)
    day = 86_400_000_000
    rows, cuts_of = [], {}
    for key, n in (("often", 900), ("twice", 2), ("never", 0), ("edge", 3)):
        cuts = sorted(rng.sample(range(0, 3000), n)) if key != "edge" else [30, 60, 61]
        cuts_of[key] = cuts
        ends = [asof.FOREVER_AGO, *[c * day for c in cuts], asof.FOREVER]
        rows += [(key, a, b, i) for i, (a, b) in enumerate(zip(ends, ends[1:]))]
    segments = spark.createDataFrame(rows, "k string, seg_from_us long, seg_to_us long, v long")
    probes = [(k, rng.randint(-500, 3500) * day + rng.choice([0, -1, 1])) for k in [*cuts_of, "none"] for _ in range(150)]
    probes += [("edge", c * day + d) for c in (30, 60, 61) for d in (-1, 0)] + [(None, 5), ("often", None)]
    df = spark.createDataFrame(probes, "k string, us long")
    got = sorted(asof.lookup(df, segments, ["k"], F.col("us"), ["v"]).collect(), key=str)
    expected = [
        (k, us, None if k not in cuts_of or us is None else sum(c * day <= us for c in cuts_of[k])) for k, us in probes
    ]
    assert [tuple(r) for r in got] == sorted(expected, key=lambda r: str(Row(k=r[0], us=r[1], v=r[2])))
    spans, laid = asof.by_months(segments, ["k"])
    most = laid.groupBy("k", "month").count().agg(F.max("count")).first()[0]
    assert most <= 32  # 900 changes of one key in 100 months, and at most 30 days in one
    assert laid.count() <= len(rows) + 2 * 101 and spans.count() == 4


def test_names_mean_what_the_list_of_their_time_says(spark):
    lists = [  # (minute, {name: (symbol, mult, interval)})
        (0, {"AUSDT": ("A", 1, 8), "BUSDT": ("B", 1, None)}),
        (10, {"AUSDT": ("A", 1, 4)}),
        (20, {"AUSDT": ("A", 1, 4), "BUSDT": ("B", 1000, 8), "CUSDT": ("C", 1, 8)}),
    ]
    flat = [("binance", n, *v, m) for m, names in lists for n, v in names.items()]
    snapshots = spark.createDataFrame(
        flat, "venue string, venue_symbol string, symbol string, mult int, funding_interval_h int, m long"
    ).withColumn("ts", F.timestamp_millis(F.col("m") * 60_000))
    history = symbols.symbol_history(snapshots)
    asked = [("AUSDT", -5), ("AUSDT", 9), ("AUSDT", 10), ("BUSDT", 15), ("BUSDT", 25), ("CUSDT", 3), ("XUSDT", 3), ("AUSDT", 99)]
    entries = spark.createDataFrame([("binance", n, m * 60_000) for n, m in asked], "venue string, venue_symbol string, ts_ms long")
    got = {(r["venue_symbol"], r["ts_ms"] // 60_000): (r["symbol"], r["mult"], r["funding_interval_h"])
           for r in symbols.resolve(entries, history).collect()}
    assert got == {
        ("AUSDT", -5): ("A", 1, 8), ("AUSDT", 9): ("A", 1, 8), ("AUSDT", 10): ("A", 1, 4), ("AUSDT", 99): ("A", 1, 4),
        ("BUSDT", 15): ("B", 1, 8), ("BUSDT", 25): ("B", 1000, 8), ("CUSDT", 3): ("C", 1, 8),
    }
