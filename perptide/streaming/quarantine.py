"""Stream lanes that keep running over bad frames and bad rows.

A frame is judged before the strict parsers see it: it is read permissively as text by name,
entries that could not be parsed are taken out with their reasons, and what is sound is
written back as a frame. So the parsers stay as strict as they are and never meet what would end
the stream. Parsed records are then held against the record contract. Each batch has two
outputs, the rows and the quarantine, and both replace their own partitions when a batch is
repeated, so nothing is lost, doubled or reordered by a restart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from perptide import schemas as S
from perptide.operators import contracts
from perptide.operators import normalize_binance as NB
from perptide.operators import normalize_hyperliquid as NH
from perptide.sources.minute_store import LANES, MinuteStore

QUARANTINE = "endpoint string, observed_ms bigint, ingest_ms bigint, entry string, reasons array<string>, batch_seq bigint"
_KEPT = ["endpoint", "observed_ms", "ingest_ms"]
_TEXTS = "map<string,string>"


def _readable(text: Column, kind: str) -> Column:
    """Whether a text is blank or a value of the type."""
    bare = F.nullif(F.trim(text), F.lit(""))
    return bare.isNull() | bare.try_cast(kind).isNotNull()


def _reasons(**broken: Column) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(b, F.lit(True)), F.lit(name)) for name, b in broken.items()]))


def _field(entry: Column, name: str) -> Column:
    return F.try_element_at(entry, F.lit(name))


def mark_entry_reasons(entry: Column) -> Column:
    at = F.nullif(F.trim(_field(entry, "E")), F.lit(""))
    kinds = {"p": S.PX, "i": S.PX, "r": S.RATE, "T": "bigint"}
    sound = F.lit(True)
    for name, kind in kinds.items():
        sound = sound & _readable(_field(entry, name), kind)
    return _reasons(
        name_missing=_field(entry, "s").isNull(),
        instant_unreadable=at.try_cast("bigint").isNull(),
        number_unreadable=~sound,
    )


def judged_mark_frames(frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sound frames, quarantine) of streamed mark prices, entry by entry."""
    wanted = NB.unwrap_frames(NB.documents(frames, "ws_mark_price"))
    array = F.from_json("payload", f"array<{_TEXTS}>")
    one = F.from_json("payload", _TEXTS)
    lone = F.when(F.ltrim("payload").startswith("{") & one.isNotNull(), F.array(one))
    return _judged(wanted.withColumn("entries", F.coalesce(lone, array)), mark_entry_reasons, F.to_json)


def mid_entry_reasons(entry: Column) -> Column:
    return _reasons(number_unreadable=~_readable(F.map_values(entry)[0], S.PX))


def judged_mid_frames(frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sound frames, quarantine) of streamed mids; frames of other channels are neither."""
    read = NB.documents(frames, "ws_all_mids", NH.VENUE).withColumn("top", F.from_json("payload", _TEXTS))
    ours = read.filter(F.col("top").isNull() | (_field(F.col("top"), "channel") == "allMids"))
    mids = F.from_json(_field(F.from_json(_field(F.col("top"), "data"), _TEXTS), "mids"), _TEXTS)
    each = F.transform(F.map_entries(mids), lambda e: F.create_map(e["key"], e["value"]))

    def again(sound: Column) -> Column:
        whole = F.map_from_entries(F.flatten(F.transform(sound, F.map_entries)))
        return F.to_json(F.struct(F.lit("allMids").alias("channel"), F.struct(whole.alias("mids")).alias("data")))

    return _judged(ours.withColumn("entries", each).drop("top"), mid_entry_reasons, again)


def _judged(read: DataFrame, reasons: Callable[[Column], Column], again: Callable[[Column], Column]):
    entries = F.col("entries")
    sound = F.filter(entries, lambda e: e.isNotNull() & (F.size(reasons(e)) == 0))
    some = F.coalesce(F.size(sound) > 0, F.lit(False))  # a frame without a sound entry has nothing to parse
    good = read.filter(some).withColumn("payload", again(sound)).drop("entries")
    unreadable = read.filter(entries.isNull()).select(
        *_KEPT, F.col("payload").alias("entry"), F.array(F.lit("frame_unreadable")).alias("reasons")
    )
    bad = (
        read.filter(entries.isNotNull())
        .select(*_KEPT, F.explode("entries").alias("e"))
        .select(
            *_KEPT,
            F.to_json("e").alias("entry"),
            F.when(F.col("e").isNull(), F.array(F.lit("entry_unreadable"))).otherwise(reasons(F.col("e"))).alias("reasons"),
        )
        .filter(F.size("reasons") > 0)
    )
    return good, unreadable.unionByName(bad)


#: How a lane's frames are judged and parsed.
KINDS = {
    "mark": (judged_mark_frames, NB.ws_mark_price),
    "mid": (judged_mid_frames, NH.ws_all_mids),
}


def judged_records(frames: DataFrame, dim: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(records that hold the contract, quarantine of entries and of records) of a batch of frames."""
    judge, parse = KINDS[kind]
    good, bad = judge(frames)
    valid, broken = contracts.split_valid(parse(good, dim), contracts.market_record_rules())
    records = broken.select(
        F.col("source").alias("endpoint"),
        F.col("ts_ms").alias("observed_ms"),
        F.col("ingest_ts_ms").alias("ingest_ms"),
        F.to_json(F.struct(*[c for c in broken.columns if c != "violations"])).alias("entry"),
        F.col("violations").alias("reasons"),
    )
    return valid, bad.unionByName(records)


def price_lane(
    frames: DataFrame, dim: DataFrame, store: MinuteStore, quarantine: str, checkpoint: str, kind: str,
    lane: int = 0, available_now: bool = False,
) -> StreamingQuery:
    """Frames of ``kind`` (mark or mid) into the store, and what is refused into the table at ``quarantine``.

    The number of a batch holds its lane, as in the store, so lanes may share a quarantine.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        valid, refused = judged_records(batch, dim, kind)
        (
            refused.withColumn("batch_seq", F.lit(batch_id * LANES + lane).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_seq")
            .parquet(quarantine)
        )
        store.append(valid, batch_id, lane)

    writer = frames.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(QUARANTINE).parquet(path)
