"""Minute store, stream lanes, and the two stateful alerts."""

from __future__ import annotations

import json
import random
from decimal import Decimal

import pytest

from perptide import schemas as S
from perptide.operators import merge
from perptide.operators import normalize_binance as NB
from perptide.operators import reports as R
from perptide.sources import export, landed
from perptide.sources.minute_store import MinuteStore
from perptide.streaming import alerts, lanes
from pyspark.sql import functions as F

B = 1_760_000_040_000 // 60_000 * 60_000
SEGMENTS = "venue string, symbol string, seg_from_us bigint, seg_to_us bigint, mult decimal(12,0)"


@pytest.fixture(scope="module")
def segments(spark):
    return spark.createDataFrame([("binance", "BTC", -(2**62), 2**62, Decimal(1))], SEGMENTS)


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(
        [("binance", "BTCUSDT", "BTC", Decimal(1), 8)],
        "venue string, venue_symbol string, symbol string, mult decimal(12,0), funding_interval_h int",
    )


def stage(spark, rows):
    full = []
    for r in rows:
        row = {c: None for c in S.STAGE}
        row.update(venue="binance", symbol="BTC", source="t", semantic="mark_price", backfilled=False, **r)
        row["ingest_ts_ms"] = row["ts_ms"] + 1
        full.append(tuple(row[c] for c in S.STAGE))
    return spark.createDataFrame(full, S.ddl(S.STAGE))


def table_rows(df):
    return sorted(df.collect(), key=lambda r: (r.venue, r.symbol, r.ts))


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_store_is_idempotent_and_compaction_changes_nothing(spark, segments, tmp_path):
    store = MinuteStore(spark, str(tmp_path / "store"))
    month = 31 * 86_400_000
    batches = [
        [dict(ts_ms=B + 5, mark=Decimal(1), obs_ts_fast_ms=B + 5)],
        [dict(ts_ms=B + 9, oi_base=Decimal(7), obs_ts_slow_ms=B + 9),
         dict(ts_ms=B + month, mark=Decimal(3), obs_ts_fast_ms=B + month)],
        [dict(ts_ms=B + 2, mark=Decimal(9), obs_ts_fast_ms=B + 2)],
    ]
    for number, rows in enumerate(batches):
        store.append(stage(spark, rows), number)
    before = table_rows(store.read(segments))
    store.append(stage(spark, batches[1]), 1)  # the same batch again
    assert table_rows(store.read(segments)) == before
    assert len(before) == 2
    (first,) = [r for r in before if r.mark == 1]
    assert first.oi_base == 7 and first.oi_usd == 7
    generation = store.compact(segments, upto=1)
    assert table_rows(store.read(segments, generation)) == before
    second = store.compact(segments, upto=2, generation=generation)
    assert table_rows(store.read(segments, second)) == before
    month_name = max(r.ts for r in before).strftime("%Y%m")
    assert store.read(segments, second, months=[month_name]).count() == 1


def frames(rng, n):
    out = []
    for i in range(n):
        at = B + rng.randint(0, 600) * 1000 + i
        entry = f'{{"E":{at},"s":"{rng.choice(["BTCUSDT", "NEWUSDT"])}","p":"{i}","i":"1","r":"","T":0}}'
        payload = f'{{"stream":"x","data":[{entry}]}}' if i % 2 else f"[{entry}]"
        out.append(dict(venue="binance", endpoint="ws_mark_price", observed_ms=at, ingest_ms=at + 1, payload=payload))
    return out


def test_stream_equals_batch_across_a_restart(spark, segments, dim, tmp_path):
    rng = random.Random(4)
    source = tmp_path / "frames"
    source.mkdir()
    store = MinuteStore(spark, str(tmp_path / "store"))
    for round_ in range(2):
        for part in range(3):
            lines = "\n".join(json.dumps(f) for f in frames(rng, 40))
            (source / f"{round_}-{part}.json").write_text(lines)
        lanes.mark_price_lane(
            landed.stream_frames(spark, str(source), 1), dim, store, str(tmp_path / "progress"), True
        ).awaitTermination()
    raw = spark.read.schema(S.RAW_PAYLOAD).json(str(source))
    batch = NB.ws_mark_price(raw, dim).withColumn("batch_seq", F.lit(0).cast("bigint"))
    streamed = store.read(segments)
    same(streamed.select("ts", "mark", "obs_ts_fast"), merge.replay(batch, segments).select("ts", "mark", "obs_ts_fast"))
    assert streamed.count() > 5


def test_liquidation_lane_drops_repeats(spark, dim, tmp_path):
    order = '{{"E":{t},"o":{{"s":"BTCUSDT","S":"SELL","q":"1","p":"2","ap":"2","z":"{z}","T":{t}}}}}'
    source = tmp_path / "orders"
    source.mkdir()
    rows = [(B, 1), (B, 1), (B + 1000, 2)]
    (source / "a.json").write_text(
        "\n".join(
            json.dumps(dict(venue="binance", endpoint="ws_force_order", observed_ms=t, ingest_ms=t,
                            payload=order.format(t=t, z=z)))
            for t, z in rows
        )
    )
    out = str(tmp_path / "table")
    lanes.liquidation_lane(
        landed.stream_frames(spark, str(source)), dim, out, str(tmp_path / "p"), True
    ).awaitTermination()
    table = spark.read.schema(lanes.LIQUIDATION_TABLE).parquet(out)
    assert sorted(r.ts_ms for r in table.collect()) == [B, B + 1000]
    pushes = lanes.liquidation_pushes(table, 1).collect()
    assert [(p.events, float(p.observed_lower_bound_usd)) for p in pushes] == [(2, 6.0)]


def run(spark, df, name, tmp_path, **trigger):
    query = (
        df.writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", str(tmp_path / name)).trigger(**trigger).start()
    )
    try:
        assert query.awaitTermination(120)
    finally:
        query.stop()
    return spark.table(name).collect()


def test_silence_alert_and_recovery(spark, tmp_path):
    source = tmp_path / "writes"
    source.mkdir()
    minute = 60_000
    for i, instants in enumerate([[0, minute], [20 * minute, 21 * minute]]):
        (source / f"{i}.json").write_text("\n".join(json.dumps({"source": "s", "at_ms": a}) for a in instants))
    writes = (
        spark.readStream.schema("source string, at_ms bigint").option("maxFilesPerTrigger", 1).json(str(source))
    )
    out = {(r.kind, r.last_write_ms, r.at_ms) for r in run(spark, alerts.silence_alerts(writes), "silence", tmp_path, once=True)}
    assert out == {("silent", minute, 11 * minute), ("recovered", minute, 20 * minute)}


def greedy(instants, cooldown):
    last, out = None, []
    for at in sorted(set(instants)):
        if last is None or at - last >= cooldown:
            out.append(at)
            last = at
    return out


def test_cooldown_stream_and_batch_agree(spark, tmp_path):
    rng = random.Random(2)
    minute, half_hour = 60_000, 1_800_000
    rows = {r: [rng.randint(0, 2000) * minute for _ in range(150)] for r in ("a", "b")}
    rows["dense"] = [i * minute for i in range(3000)]
    flat = sorted((at, r) for r, xs in rows.items() for at in xs)
    want = {(r, at) for r, xs in rows.items() for at in greedy(xs, half_hour)}
    df = spark.createDataFrame([(r, at) for at, r in flat], "rule string, at_ms bigint")
    assert {(r.rule, r.at_ms) for r in R.cooled_down(df).collect()} == want
    source = tmp_path / "candidates"
    source.mkdir()
    for i in range(3):
        part = flat[i * len(flat) // 3 : (i + 1) * len(flat) // 3]
        (source / f"{i}.json").write_text("\n".join(json.dumps({"rule": r, "at_ms": at}) for at, r in part))
    stream = spark.readStream.schema("rule string, at_ms bigint").option("maxFilesPerTrigger", 1).json(str(source))
    assert {(r.rule, r.at_ms) for r in run(spark, alerts.cooled_down_alerts(stream), "cooldown", tmp_path, availableNow=True)} == want


def test_cooldown_batch_walks_many_runs_in_one_call(spark):
    rng = random.Random(6)
    minute, half_hour = 60_000, 1_800_000
    rows = {f"r{i}": [rng.randint(0, 600) * minute for _ in range(12)] for i in range(400)}
    rows["dense"] = [i * minute for i in range(5000)]
    df = spark.createDataFrame([(r, at) for r, xs in rows.items() for at in xs] + [("dense", None)], "rule string, at_ms bigint")
    out = R.cooled_down(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan
    want = [(r, at) for r, xs in rows.items() for at in greedy(xs, half_hour)] + [("dense", None)]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))


def test_documents_and_export_round_trip(spark, tmp_path):
    line = {"source": "documented", "endpoint": "meta", "note": "n", "venue": "hyperliquid", "observed_ms": 1,
            "ingest_ms": 2, "payload": "{\"universe\":[]}"}
    (tmp_path / "d.json").write_text(json.dumps(line))
    (row,) = landed.read_documents(spark, str(tmp_path / "d.json")).collect()
    assert row.payload == '{"universe":[]}' and row.endpoint == "meta"
    df = spark.createDataFrame([("BTC", None)], "symbol string, mark decimal(20,10)")
    path = export.write_export(df, "latest", F.timestamp_millis(F.lit(B)), str(tmp_path / "out"))
    (text,) = spark.read.text(path).collect()
    assert json.loads(text.value) == {
        "version": "v1", "kind": "latest", "as_of": B, "body": {"symbol": "BTC", "mark": None},
    }


def test_two_lanes_share_one_store(spark, segments, tmp_path):
    store = MinuteStore(spark, str(tmp_path / "store"))
    for lane, mark in ((0, 1), (1, 2)):
        for batch in range(2):
            at = B + (2 * lane + batch) * 60_000
            store.append(stage(spark, [dict(ts_ms=at, mark=Decimal(mark), obs_ts_fast_ms=at)]), batch, lane)
    before = table_rows(store.read(segments))
    assert [r.mark for r in before] == [1, 1, 2, 2]
    generation = store.compact(segments, upto={0: 1, 1: 0})
    assert table_rows(store.read(segments, generation)) == before
    late = B + 9 * 60_000
    store.append(stage(spark, [dict(ts_ms=late, mark=Decimal(3), obs_ts_fast_ms=late)]), 2, 1)
    assert [r.mark for r in table_rows(store.read(segments, generation))] == [1, 1, 2, 2, 3]
    with pytest.raises(ValueError, match="lane"):
        store.append(stage(spark, []), 0, 1000)


def test_late_liquidations_are_kept(spark, dim, tmp_path):
    """Frames that land hours behind the newest event, over several batches, one of them repeated."""
    order = '{{"E":{t},"o":{{"s":"BTCUSDT","S":"BUY","q":"1","p":"2","ap":"2","z":"1","T":{t}}}}}'
    source = tmp_path / "orders"
    source.mkdir()
    hour = 3_600_000
    for i, t in enumerate([B + 2 * hour, B + 2 * hour + 1, B, B - 30 * hour, B]):
        body = dict(venue="binance", endpoint="ws_force_order", observed_ms=t, ingest_ms=t, payload=order.format(t=t))
        (source / f"{i}.json").write_text(json.dumps(body))
    out = str(tmp_path / "table")
    lanes.liquidation_lane(
        landed.stream_frames(spark, str(source), 1), dim, out, str(tmp_path / "p"), True
    ).awaitTermination()
    table = lanes.liquidation_table(spark, out)
    assert sorted(r.ts_ms for r in table.collect()) == [B - 30 * hour, B, B + 2 * hour, B + 2 * hour + 1]
    month = table.where(F.col("ts_ms") == B).first().month
    assert lanes.liquidation_table(spark, out, [month]).count() >= 3


def test_unknown_order_side_is_refused(spark, dim):
    payload = f'{{"E":{B},"o":{{"s":"BTCUSDT","S":"HOLD","q":"1","p":"2","ap":"2","z":"1","T":{B}}}}}'
    rows = [("binance", "ws_force_order", None, None, B, B, payload)]
    frames = spark.createDataFrame(rows, S.RAW_PAYLOAD)
    with pytest.raises(Exception, match="unknown order side"):
        lanes.liquidation_rows(frames, dim).collect()


def test_replay_leaves_untouched_values_alone(spark, segments):
    """The multiplier's history changed since: only keys that the log changes are valued anew."""
    rows = [dict(ts_ms=B + 60_000 * i, mark=Decimal(2), oi_base=Decimal(1000), obs_ts_fast_ms=B + 60_000 * i,
                 obs_ts_slow_ms=B + 60_000 * i) for i in range(2)]
    log = stage(spark, rows).withColumn("batch_seq", F.lit(0).cast("bigint"))
    stored = merge.replay(log, segments).withColumn("oi_usd", F.lit(7).cast(dict(merge.replay(log, segments).dtypes)["oi_usd"]))
    newer = stage(spark, [dict(ts_ms=B + 60_001, mark=Decimal(3), obs_ts_fast_ms=B + 60_001)])
    out = merge.replay(newer.withColumn("batch_seq", F.lit(1).cast("bigint")), segments, target=stored)
    assert [(r.mark, r.oi_usd) for r in table_rows(out)] == [(2, 7), (3, 3000)]
