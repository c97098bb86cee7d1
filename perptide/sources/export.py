"""Versioned JSON documents of the latest state, each with its ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSION = "v1"


def export_lines(df: DataFrame, kind: str, as_of: Column) -> DataFrame:
    """One JSON document per row: {version, kind, as_of, body}; NULL fields stay."""
    body = F.struct(*df.columns)
    document = F.struct(
        F.lit(VERSION).alias("version"),
        F.lit(kind).alias("kind"),
        F.unix_millis(as_of).alias("as_of"),
        body.alias("body"),
    )
    return df.select(
        F.lit(kind).alias("kind"), F.to_json(document, {"ignoreNullFields": "false"}).alias("value")
    )


def write_export(df: DataFrame, kind: str, as_of: Column, root: str) -> str:
    path = f"{root.rstrip('/')}/{VERSION}/{kind}"
    export_lines(df, kind, as_of).select("value").write.mode("overwrite").text(path)
    return path


def latest_state(market: DataFrame) -> DataFrame:
    """Newest row per (venue, coin)."""
    rest = [c for c in market.columns if c not in ("venue", "symbol")]
    return market.groupBy("venue", "symbol").agg(
        F.max_by(F.struct(*rest), "ts").alias("r")
    ).select("venue", "symbol", "r.*")
