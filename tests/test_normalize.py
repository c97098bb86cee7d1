"""Parsers on small payloads of the venues' shapes, and their refusals."""

from __future__ import annotations

from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from perptide import schemas as S
from perptide.operators import liquidations as L
from perptide.operators import normalize_binance as NB
from perptide.operators import normalize_hyperliquid as NH
from perptide.operators import symbols

T = 1_760_000_000_000
REFUSED = (PySparkException, Py4JJavaError)


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(
        [
            ("binance", "BTCUSDT", "BTC", Decimal(1), 8),
            ("binance", "1000PEPEUSDT", "PEPE", Decimal(1000), 4),
            ("binance", "1MBABYUSDT", "1MBABY", None, 8),
            ("hyperliquid", "BTC", "BTC", Decimal(1), 1),
            ("hyperliquid", "kPEPE", "PEPE", Decimal(1000), 1),
        ],
        "venue string, venue_symbol string, symbol string, mult decimal(12,0), funding_interval_h int",
    )


@pytest.fixture
def raw(spark):
    def build(venue, endpoint, payload, request_symbol=None, interval=None):
        return spark.createDataFrame(
            [(venue, endpoint, request_symbol, interval, T, T + 250, payload)], S.RAW_PAYLOAD
        )

    return build


def test_premium_index_array_and_lone_object(raw, dim):
    one = (
        '{"symbol":"BTCUSDT","markPrice":"65000.10","indexPrice":"65001","lastFundingRate":"",'
        f'"nextFundingTime":0,"time":{T}}}'
    )
    other = one.replace("BTCUSDT", "NEWUSDT")
    for payload, seen in ((one, 1), (f"[{one},{other}]", 2)):
        document = raw("binance", "premium_index", payload)
        (row,) = NB.premium_index(document, dim).collect()
        assert row.mark == Decimal("65000.1") and row.funding_rate is None
        assert row.next_funding_ts_ms is None and row.premium is None
        assert NB.premium_index_entries(document).count() == seen
    unknown = symbols.unknown_symbols(NB.premium_index_entries(document), dim).collect()
    assert [(u.venue_symbol, u.rows) for u in unknown] == [("NEWUSDT", 1)]


def test_streamed_frame_keys_that_differ_by_case(raw, dim):
    frame = f'[{{"e":"markPriceUpdate","E":{T},"s":"BTCUSDT","p":"1.5","P":"9","i":"2","r":"0.0001","T":{T + 1}}}]'
    for payload in (frame, f'{{"stream":"!markPrice@arr@1s","data":{frame}}}'):
        (row,) = NB.ws_mark_price(raw("binance", "ws_mark_price", payload), dim).collect()
        assert row.mark == Decimal("1.5") and row.ts_ms == T and row.next_funding_ts_ms == T + 1


def test_settled_funding_uses_the_contract_interval(raw, dim):
    payload = f'[{{"symbol":"1000PEPEUSDT","fundingRate":"0.00005","fundingTime":{T}}}]'
    (row,) = NB.funding_rate(raw("binance", "funding_rate", payload), dim).collect()
    assert row.grid_s == 4 * 3600 and row.backfilled and row.symbol == "PEPE"


def test_settled_funding_without_a_rate_is_an_error(raw, dim):
    payload = f'[{{"symbol":"BTCUSDT","fundingRate":"","fundingTime":{T}}}]'
    with pytest.raises(REFUSED):
        NB.funding_rate(raw("binance", "funding_rate", payload), dim).collect()


def test_open_interest_in_base_units(raw, dim):
    def oi(name):
        payload = f'{{"symbol":"{name}","openInterest":"5.5","time":{T}}}'
        return NB.open_interest(raw("binance", "open_interest", payload), dim).collect()[0]

    assert oi("1000PEPEUSDT").oi_base == 5500
    assert oi("1MBABYUSDT").oi_base is None
    assert oi("BTCUSDT").oi_usd is None and oi("BTCUSDT").funding_interval_h is None


def test_taker_ratio(raw):
    payload = (
        f'[{{"buyVol":"3","sellVol":"1","timestamp":{T}}},{{"buyVol":"0","sellVol":"0","timestamp":{T + 1}}}]'
    )
    rows = NB.ls_ratio(raw("binance", "taker_long_short", payload, "BTC")).orderBy("ts_ms").collect()
    assert [r.long_share for r in rows] == [Decimal("0.75"), None] and rows[0].period == 300
    with pytest.raises(REFUSED):
        bad = payload.replace('"1"', '"-1"')
        NB.ls_ratio(raw("binance", "taker_long_short", bad, "BTC")).collect()


def test_klines_drop_the_forming_bar(raw):
    bar = '[1,"o","h","l","{c}","v",{t},"q"]'
    payload = "[" + ",".join(bar.replace("{c}", c).replace("{t}", str(t)) for c, t in (("7", T - 1), ("8", T))) + "]"
    (row,) = NB.klines(raw("binance", "klines", payload, "BTC", "1h"), T).collect()
    assert (row.mark, row.grid_s, row.semantic) == (7, 3600, "candle_close")


@pytest.mark.parametrize(
    "payload, interval", [("[[1,2,3,4,5,6]]", "1m"), ("[[1,2,3,4,5,6,7]]", "2m"), ('{"code":-1}', "1m")]
)
def test_klines_refuse_other_shapes(raw, payload, interval):
    with pytest.raises(REFUSED):
        NB.klines(raw("binance", "klines", payload, "BTC", interval), T).collect()


def order_frame(side="SELL", name="1000PEPEUSDT", at=T):
    return (
        f'{{"e":"forceOrder","E":{at + 50},"o":{{"s":"{name}","S":"{side}","o":"LIMIT","q":"9","p":"2",'
        f'"ap":"1.9","z":"4","T":{at}}}}}'
    )


def test_forced_order_to_liquidation(raw, dim):
    (row,) = NB.force_order(raw("binance", "ws_force_order", order_frame()), dim).collect()
    assert row.ts_ms == T
    entries = NB.force_order_entries(raw("binance", "ws_force_order", order_frame()))
    (row,) = L.liquidations(entries.unionByName(entries), dim).collect()
    assert (row.side, row.size, row.notional_usd) == ("long", 4000, Decimal("7.6"))
    unknown = NB.force_order_entries(raw("binance", "ws_force_order", order_frame("BUY", "1MBABYUSDT")))
    (row,) = L.liquidations(unknown, dim).collect()
    assert (row.side, row.size, row.notional_usd) == ("short", None, None)


def test_contract_list(raw):
    payload = (
        f'{{"serverTime":{T},"symbols":['
        '{"symbol":"1000PEPEUSDT","contractType":"PERPETUAL","status":"SETTLING","baseAsset":"1000PEPE",'
        '"filters":[{"filterType":"LOT_SIZE"},{"filterType":"PRICE_FILTER","tickSize":"0.01"}]},'
        '{"symbol":"1INCHUSDT","contractType":"PERPETUAL","status":"ODD","baseAsset":"1INCH"},'
        '{"symbol":"BTCUSDT_Q","contractType":"CURRENT_QUARTER","status":"TRADING","baseAsset":"BTC"}]}'
    )
    documents = raw("binance", "exchange_info", payload).unionByName(
        raw("binance", "funding_info",
            '[{"symbol":"1000PEPEUSDT","fundingIntervalHours":8},{"symbol":"1000PEPEUSDT","fundingIntervalHours":4}]')
    )
    rows = {r.symbol: r for r in NB.instruments(documents).collect()}
    assert rows.keys() == {"PEPE", "1INCH"}
    assert (rows["PEPE"].mult, rows["PEPE"].funding_interval_h, rows["PEPE"].status) == (1000, 4, "suspended")
    assert rows["PEPE"].tick == Decimal("0.01")
    assert (rows["1INCH"].mult, rows["1INCH"].funding_interval_h, rows["1INCH"].status) == (1, 8, None)


META = '{"universe":[{"name":"BTC","szDecimals":5,"maxLeverage":40},{"name":"kPEPE","szDecimals":0}]}'
CTX = '{"funding":"0.0000125","openInterest":"7","markPx":"2","oraclePx":"3","premium":"-0.1","dayNtlVlm":"11"}'


def test_meta(raw):
    document = raw("hyperliquid", "meta", META)
    rows = {r.symbol: r for r in NH.instruments(document).collect()}
    assert rows["PEPE"].mult == 1000 and rows["BTC"].ts_ms == T and rows["BTC"].status is None
    assets = {r.venue_symbol: r.max_leverage for r in NH.asset_metadata(document).collect()}
    assert assets == {"BTC": 40, "kPEPE": None}


def test_meta_and_contexts_pair_by_position(raw, dim):
    rows = {
        r.symbol: r
        for r in NH.meta_and_asset_ctxs(
            raw("hyperliquid", "meta_and_asset_ctxs", f"[{META},[{CTX},{CTX}]]"), dim
        ).collect()
    }
    assert rows["PEPE"].oi_base == 7000 and rows["BTC"].oi_base == 7
    assert rows["BTC"].obs_ts_fast_ms == rows["BTC"].obs_ts_slow_ms == T
    assert rows["BTC"].premium == Decimal("-0.1") and rows["BTC"].chg24h_pct is None


def test_meta_and_contexts_length_mismatch(raw, dim):
    with pytest.raises(REFUSED):
        NH.meta_and_asset_ctxs(
            raw("hyperliquid", "meta_and_asset_ctxs", f"[{META},[{CTX}]]"), dim
        ).collect()


def test_predicted_fundings_keep_the_own_key(raw, dim):
    payload = (
        '[["BTC",[["BinPerp",{"fundingRate":"0.8","nextFundingTime":5}],'
        '["HlPerp",{"fundingRate":"0.1","nextFundingTime":7}]]],["NEW",[["HlPerp",{"fundingRate":"0"}]]]]'
    )
    document = raw("hyperliquid", "predicted_fundings", payload)
    (row,) = NH.predicted_fundings(document, dim).collect()
    assert row.funding_rate == Decimal("0.1") and row.next_funding_ts_ms == 7
    others = NH.predicted_fundings_other_venues(document).collect()
    assert [(o.venue_key, o.rows) for o in others] == [("BinPerp", 1)]


def test_funding_history_zero_is_a_value(raw):
    payload = f'[{{"coin":"BTC","fundingRate":"0.0","premium":"","time":{T}}}]'
    (row,) = NH.funding_history(raw("hyperliquid", "funding_history", payload, "BTC")).collect()
    assert row.funding_rate == 0 and row.premium is None and row.grid_s == 3600


def test_candles_with_and_without_close_instant(raw):
    now = T + 10 * 60_000
    payload = f'[{{"t":{T},"T":{T + 59_999},"c":"1"}},{{"t":{T + 60_000},"c":"2"}},{{"t":{now - 60_000},"c":"3"}},{{"t":{now - 59_999},"c":"4"}}]'
    rows = NH.candle_snapshot(raw("hyperliquid", "candle_snapshot", payload, "BTC", "1m"), now).collect()
    assert sorted((r.ts_ms, int(r.mark)) for r in rows) == [
        (T + 59_999, 1), (T + 119_999, 2), (now - 1, 3),
    ]


def test_all_mids_keeps_its_channel(raw, dim):
    frame = '{"channel":"allMids","data":{"mids":{"BTC":"10","kPEPE":"20","NEW":"1"}}}'
    rows = NH.ws_all_mids(raw("hyperliquid", "ws_all_mids", frame), dim).collect()
    assert {(r.symbol, int(r.mark), r.source) for r in rows} == {
        ("BTC", 10, "hyperliquid_ws_all_mids"), ("PEPE", 20, "hyperliquid_ws_all_mids"),
    }
    note = raw("hyperliquid", "ws_all_mids", '{"channel":"subscriptionResponse","data":{}}')
    assert NH.ws_all_mids(note, dim).count() == 0


def test_text_that_is_no_number_is_an_error(raw, dim):
    payload = f'{{"symbol":"BTCUSDT","openInterest":"n/a","time":{T}}}'
    with pytest.raises(REFUSED):
        NB.open_interest(raw("binance", "open_interest", payload), dim).collect()


def test_ambiguous_mapping_fails(spark, dim):
    assert symbols.one_to_one(dim).count() == 5
    twice = dim.unionByName(dim.filter("symbol = 'BTC'"))
    with pytest.raises(REFUSED):
        symbols.one_to_one(twice).collect()


@pytest.mark.parametrize(
    ("endpoint", "payload", "read"),
    [
        ("premium_index", '[{"markPrice":"1","time":"5"}]', lambda r: NB.premium_index_entries(r)),
        ("ws_mark_price", '[{"p":"1","E":"5"}]', lambda r: NB.ws_mark_price_entries(r)),
        ("exchange_info", '{"serverTime":"5"}', lambda r: NB.instruments(r)),
        ("exchange_info", '{"serverTime":"5","symbols":[{"contractType":"PERPETUAL","baseAsset":"A"}]}', lambda r: NB.instruments(r)),
        ("exchange_info", '{"serverTime":"5","symbols":[{"contractType":"PERPETUAL","symbol":"A"}]}', lambda r: NB.instruments(r)),
        ("funding_info", '[{"fundingIntervalHours":4}]', lambda r: NB.funding_intervals(r)),
        ("funding_info", '[{"symbol":"AUSDT"}]', lambda r: NB.funding_intervals(r)),
        ("ws_force_order", '{"E":"5","o":{"T":"5","S":"BUY"}}', lambda r: NB.force_order_entries(r)),
        ("meta", "{}", lambda r: NH.instruments(r)),
        ("meta_and_asset_ctxs", '[{"universe":[{}]},[{"markPx":"1"}]]', lambda r: NH.meta_and_asset_ctxs_entries(r)),
    ],
)
def test_missing_names_and_containers_are_refused(spark, endpoint, payload, read):
    venue = "hyperliquid" if endpoint.startswith("meta") else "binance"
    raw = spark.createDataFrame([(venue, endpoint, None, None, 5, 6, payload)], S.RAW_PAYLOAD)
    with pytest.raises(Exception, match="the payload gives no"):
        read(raw).collect()


def test_interval_of_the_list_before(spark):
    """A contract that moves from 8 to 4 hours keeps its 8 in the older list."""
    listed = '{{"serverTime":"{t}","symbols":[{{"symbol":"AUSDT","contractType":"PERPETUAL","status":"TRADING","baseAsset":"A","filters":[]}}]}}'
    day = 86_400_000
    rows = [("binance", "exchange_info", None, None, t, t, listed.format(t=t)) for t in (day, 2 * day, 3 * day)]
    rows += [("binance", "funding_info", None, None, t, t, p) for t, p in (
        (day - 5, "[]"), (2 * day, '[{"symbol":"AUSDT","fundingIntervalHours":4}]'), (3 * day + 5, '[{"symbol":"AUSDT","fundingIntervalHours":1}]'),
    )]
    out = NB.instruments(spark.createDataFrame(rows, S.RAW_PAYLOAD)).collect()
    assert {r.ts_ms // day: r.funding_interval_h for r in out} == {1: 8, 2: 4, 3: 4}
