"""The coin universe from lists on clocks of their own, and coins that count as present."""

from __future__ import annotations

import random

from perptide.operators import gaps as G
from perptide.operators import liquidations as L
from pyspark.sql import functions as F

T = 1_704_067_200_000
MIN = 60_000


def lists(spark, rows):
    """rows: (venue, minute, {symbol: status})."""
    flat = [(v, f"{s}-x", s, T + m * MIN, status) for v, m, coins in rows for s, status in coins.items()]
    df = spark.createDataFrame(flat, "venue string, venue_symbol string, symbol string, ms long, status string")
    return df.withColumn("ts", F.timestamp_millis("ms"))


def spells(df):
    found = df.select("symbol", F.unix_millis("in_from").alias("f"), F.unix_millis("in_to").alias("t"), "reason")
    minute = lambda x: None if x is None else (x - T) // MIN
    return sorted((r["symbol"], minute(r["f"]), minute(r["t"])) for r in found.collect())


def test_clocks_and_missing_status(spark):
    snapshots = lists(spark, [
        ("binance", 0, {"A": "trading", "B": "trading", "C": "settling", "D": None}),
        ("hyperliquid", 7, {"A": None, "B": None, "C": None, "D": None}),
        ("binance", 10, {"A": "trading", "B": "settling"}),
        ("hyperliquid", 22, {"A": None, "B": None}),
        ("binance", 30, {"A": "trading", "B": "trading"}),
        ("hyperliquid", 37, {"B": None}),
    ])
    assert spells(L.universe(snapshots)) == [("A", 7, 37), ("B", 7, 10), ("B", 30, None)]
    assert [r["symbol"] for r in L.listed_now(snapshots).collect()] == ["B"]
    assert L.universe(snapshots.filter("venue = 'binance'")).count() == 0
    assert L.universe(snapshots.limit(0)).count() == L.listed_now(snapshots.limit(0)).count() == 0


def test_same_as_carrying_each_list_forward(spark):
    rng = random.Random(5)
    rows = []
    for venue, every, start in (("binance", 10, 0), ("hyperliquid", 13, 4)):
        for m in range(start, 400_000, every * 997):
            coins = {s: rng.choice(["trading", "trading", "settling", None]) for s in "ABCDEF" if rng.random() < 0.8}
            rows.append((venue, m, coins or {"Z": "settling"}))
    held, inside, expected = {}, {}, []
    for venue, m, coins in sorted(rows, key=lambda r: r[1]):
        held[venue] = {s for s, status in coins.items() if status == "trading" or (status is None and venue == "hyperliquid")}
        now = held.get("binance", set()) & held.get("hyperliquid", set())
        for s in set(inside) - now:
            expected.append((s, inside.pop(s), m))
        for s in now - set(inside):
            inside[s] = m
    expected += [(s, m, None) for s, m in inside.items()]
    assert spells(L.universe(lists(spark, rows))) == sorted(expected, key=lambda r: r[:2])


def test_coins_outside_the_universe_hide_no_gap(spark):
    universe = spark.createDataFrame([("A", T, T + 3 * MIN), ("B", T + MIN, None)], "symbol string, f long, t long").select(
        "symbol", F.timestamp_millis("f").alias("in_from"), F.timestamp_millis("t").alias("in_to")
    )
    rows = [("binance", s, T + m * MIN, 1.0) for s, m in [("A", 0), ("A", 3), ("B", 0), ("B", 1), ("B", 4), ("X", 2), ("X", 1)]]
    market = spark.createDataFrame(rows, "venue string, symbol string, ms long, mark double").withColumn(
        "ts", F.timestamp_millis("ms")
    )
    listed = G.among_listed(market, universe, T, T + 5 * MIN)
    assert sorted((r["symbol"], (r["ms"] - T) // MIN) for r in listed.collect()) == [("A", 0), ("B", 1), ("B", 4)]
    expected = G.expected_per_minute(spark, universe, T, T + 5 * MIN)
    status = G.minute_status(expected, listed, ["mark"]).filter("venue = 'binance'")
    got = {(r["minute_ms"] - T) // MIN: (r["expected"], r["present"]) for r in status.collect()}
    assert got == {0: (1, 1), 1: (2, 1), 2: (2, 0), 3: (1, 0), 4: (1, 1)}
