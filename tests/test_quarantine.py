"""Lanes that keep running over faulty frames and list what they refuse."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest

from perptide import schemas as S
from perptide.operators import normalize_binance as NB
from perptide.operators import normalize_hyperliquid as NH
from perptide.sources import landed
from perptide.sources.minute_store import MinuteStore
from perptide.streaming import quarantine as Q

T = 1_760_000_040_000
SEGMENTS = "venue string, symbol string, seg_from_us bigint, seg_to_us bigint, mult decimal(12,0)"


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(
        [("binance", "BTCUSDT", "BTC", Decimal(1), 8), ("hyperliquid", "BTC", "BTC", Decimal(1), 1),
         ("hyperliquid", "ETH", "ETH", Decimal(1), 1)],
        "venue string, venue_symbol string, symbol string, mult decimal(12,0), funding_interval_h int",
    )


def entry(**values):
    return {"s": "BTCUSDT", "p": "10", "i": "", "r": "0.0001", "T": 0, "E": T} | values


MARK = [
    (json.dumps([entry()]), []),
    (json.dumps({"stream": "x", "data": [entry(E=T + 60_000), entry(p="x"), entry(s=None)]}), ["name_missing", "number_unreadable"]),
    (json.dumps(entry(E=T + 120_000, P="1", e="kind")), []),
    (json.dumps([entry(E=""), entry(E="now"), entry(T="later", p="1" * 60)]), ["instant_unreadable"] * 2 + ["number_unreadable"]),
    ("[{", ["frame_unreadable"]), ("", ["frame_unreadable"]), ("[]", []), ('[1, "x"]', None), (json.dumps([entry(p="-1")]), ["mark_is_not_negative"]),
]
MIDS = [
    ('{"channel":"allMids","data":{"mids":{"BTC":"5","ETH":"six"}}}', ["number_unreadable"]),
    ('{"channel":"subscriptionResponse","data":{"x":1}}', []),
    ('{"channel":"allMids","data":{"mids":{"ETH":"7","@1":"0.5"}}}', []),
    ('{"channel":"allMids","data"', ["frame_unreadable"]),
    ('{"channel":"allMids","data":{}}', ["frame_unreadable"]),
]


def frames(spark, venue, endpoint, payloads):
    rows = [(venue, endpoint, None, None, T + i, T + i + 1, p) for i, (p, _) in enumerate(payloads)]
    return spark.createDataFrame(rows, S.RAW_PAYLOAD if isinstance(S.RAW_PAYLOAD, str) else S.ddl(S.RAW_PAYLOAD))


def reasons_of(df):
    return sorted(x for r in df.collect() for x in r["reasons"])


@pytest.mark.parametrize(
    ("kind", "venue", "endpoint", "payloads"),
    [("mark", "binance", "ws_mark_price", MARK), ("mid", "hyperliquid", "ws_all_mids", MIDS)],
)
def test_what_is_sound_lands_and_the_rest_is_listed(spark, dim, kind, venue, endpoint, payloads):
    known = [p for p in payloads if p[1] is not None]
    good, bad = Q.judged_records(frames(spark, venue, endpoint, known), dim, kind)
    assert reasons_of(bad) == sorted(x for _, found in known for x in found)
    landed_rows = sorted((r["symbol"], r["ts_ms"], r["mark"]) for r in good.collect())
    if kind == "mark":
        assert landed_rows == [("BTC", T + m * 60_000, Decimal(10)) for m in range(3)]
    else:
        assert landed_rows == [("BTC", T, Decimal(5)), ("ETH", T + 2, Decimal(7))]


def test_odd_frames_never_end_the_lane(spark, dim):
    good, bad = Q.judged_records(frames(spark, "binance", "ws_mark_price", MARK), dim, "mark")
    assert good.count() == 3 and bad.count() >= 8


def test_sound_frames_parse_as_before(spark, dim):
    sound = frames(spark, "binance", "ws_mark_price", [MARK[0], MARK[2]])
    good, bad = Q.judged_records(sound, dim, "mark")
    assert bad.count() == 0
    assert sorted(map(str, good.collect())) == sorted(map(str, NB.ws_mark_price(sound, dim).collect()))
    mids = frames(spark, "hyperliquid", "ws_all_mids", [MIDS[1], MIDS[2]])
    good, bad = Q.judged_records(mids, dim, "mid")
    assert bad.count() == 0
    assert sorted(map(str, good.collect())) == sorted(map(str, NH.ws_all_mids(mids, dim).collect()))


def test_stream_with_restart(spark, dim, tmp_path):
    source = tmp_path / "frames"
    source.mkdir()
    store, refused = MinuteStore(spark, str(tmp_path / "store")), str(tmp_path / "refused")
    for part in (MARK[:4], MARK[4:]):
        name = f"{len(list(source.iterdir()))}.json"
        lines = [
            json.dumps(dict(venue="binance", endpoint="ws_mark_price", observed_ms=T, ingest_ms=T + 1, payload=p))
            for p, found in part
            if found is not None
        ]
        (source / name).write_text("\n".join(lines))
        Q.price_lane(
            landed.stream_frames(spark, str(source), 1), dim, store, refused, str(tmp_path / "progress"), "mark",
            lane=3, available_now=True,
        ).awaitTermination()
    segments = spark.createDataFrame([], SEGMENTS)
    assert store.read(segments).count() == 3
    listed = Q.quarantined(spark, refused)
    assert reasons_of(listed) == sorted(x for _, found in MARK if found for x in found)
    assert {r["batch_seq"] for r in listed.collect()} == {3, 1003}
