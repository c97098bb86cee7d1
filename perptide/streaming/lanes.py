"""Streams of landed frames into the minute store and the liquidation table.

The minute table has no lateness bound: an older observation of a minute loses by
the guard inside the merge, whenever it arrives, so these streams carry no
watermark. Liquidations have none either: a frame may land at any time after its
event, and repeats are told apart by the event's identity when the table is read.
Batches are idempotent by their lane and number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from perptide import schemas as S
from perptide.operators import liquidations as L
from perptide.operators import normalize_binance as NB
from perptide.operators import normalize_hyperliquid as NH
from perptide.sources.minute_store import MinuteStore


def _start(df: DataFrame, checkpoint: str, write, available_now: bool) -> StreamingQuery:
    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _into_store(records: DataFrame, store: MinuteStore, checkpoint: str, available_now: bool, lane: int):
    def write(batch: DataFrame, batch_id: int) -> None:
        store.append(batch, batch_id, lane)

    return _start(records, checkpoint, write, available_now)


def mark_price_lane(
    frames: DataFrame, dim: DataFrame, store: MinuteStore, checkpoint: str, available_now: bool = False, lane: int = 0
) -> StreamingQuery:
    """``lane`` tells the streams that write one store apart; it must stay the same over restarts."""
    return _into_store(NB.ws_mark_price(frames, dim), store, checkpoint, available_now, lane)


def mid_price_lane(
    frames: DataFrame, dim: DataFrame, store: MinuteStore, checkpoint: str, available_now: bool = False, lane: int = 1
) -> StreamingQuery:
    """``lane`` tells the streams that write one store apart; it must stay the same over restarts."""
    return _into_store(NH.ws_all_mids(frames, dim), store, checkpoint, available_now, lane)


def liquidation_rows(frames: DataFrame, dim: DataFrame) -> DataFrame:
    """Liquidation rows of a stream or a batch, repeated frames included."""
    rows = L.liquidation_rows(NB.force_order_entries(frames), dim)
    return rows.withColumn("ts", F.timestamp_millis("ts_ms"))


def liquidation_lane(
    frames: DataFrame, dim: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Forced orders into a Parquet table by month and batch; a repeated batch replaces its own files."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.dropDuplicates(L.EVENT_KEY)
            .withColumn("month", F.date_format("ts", "yyyyMM"))
            .withColumn("batch_seq", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("month", "batch_seq")
            .parquet(path)
        )

    return _start(liquidation_rows(frames, dim), checkpoint, write, available_now)


LIQUIDATION_TABLE = S.ddl({**S.LIQUIDATION, "ts": "timestamp", "month": "string", "batch_seq": "bigint"})


def liquidation_table(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """The table that ``liquidation_lane`` writes, each event once: the row of its first batch.

    Repeats of an event have its instant, so they lie in one month and ``months`` prunes safely.
    """
    rows = spark.read.schema(LIQUIDATION_TABLE).parquet(path)
    if months is not None:
        rows = rows.filter(F.col("month").isin(*months))
    kept = [c for c in rows.columns if c not in L.EVENT_KEY]
    first = rows.groupBy(*L.EVENT_KEY).agg(F.min_by(F.struct(*kept), "batch_seq").alias("row"))
    return first.select(*L.EVENT_KEY, "row.*").select(*rows.columns)


def liquidation_pushes(rows: DataFrame, at_least_usd: float) -> DataFrame:
    """One merged message per venue and five-minute window, on a stream or a batch.

    ``rows`` already carries a watermark on ``ts`` when it is a stream.
    """
    return (
        rows.filter(F.col("notional_usd") >= at_least_usd)
        .groupBy("venue", F.window("ts", "5 minutes"))
        .agg(
            F.count("*").alias("events"),
            F.sum("notional_usd").alias("observed_lower_bound_usd"),
            F.max("notional_usd").alias("largest_usd"),
        )
        .select(
            "venue",
            F.unix_millis("window.start").alias("window_ms"),
            "events",
            "observed_lower_bound_usd",
            "largest_usd",
        )
    )
