"""Landed payload documents and stream frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perptide import schemas as S

# The payload stays text: VARIANT or a struct here would fix its shape too early.
ENVELOPE = (
    "venue string, endpoint string, request_symbol string, interval string, observed_ms bigint, "
    "ingest_ms bigint, source string, note string, payload string"
)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Envelopes {source, endpoint, note, payload, ...}, one JSON document per line."""
    return (
        spark.read.schema(ENVELOPE)
        .json(path, mode="FAILFAST")
        .select("venue", "endpoint", "request_symbol", "interval", "observed_ms", "ingest_ms", "payload")
    )


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The same relation kept as Parquet."""
    return spark.read.schema(S.RAW_PAYLOAD).parquet(path)


def stream_frames(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Landed frame files as a stream of raw payload rows."""
    reader = spark.readStream.schema(S.RAW_PAYLOAD)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)
