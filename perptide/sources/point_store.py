"""Metric points by UTC day, with sorted counts of each day, and percentiles that add days up.

A day is written as three partitions: its points, how often each value occurs in each series, and
the last point of each series. A percentile over a window adds the counts of the window's whole
days and reads points of the two days at its ends only. So a day more costs a day, a
backfill rewrites the days it touches, and the window never scans points twice.

Days expire as whole partitions. What is held is listed in a file of its own: expiry first lists
the shorter history and then deletes folders, so a reader never meets a listed day without files.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perptide.sources import files

POINTS = "scope string, metric string, ts timestamp, value double, grid_s int, day string"
COUNTS = "scope string, metric string, grid_s int, value double, n bigint, day string"
LAST = "scope string, metric string, ts timestamp, value double, grid_s int, day string"
SERIES = ["scope", "metric"]
#: Observations below which a percentile stays unknown.
MIN_N = 30


def day_of(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyyMMdd")


class PointStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def write_days(self, points: DataFrame) -> None:
        """Store all days of ``points`` (scope, metric, ts, value, grid_s), each as a whole; other days stay.

        Points without a value are no points. Writing a day again replaces it.
        """
        rows = points.filter(F.col("value").isNotNull()).select(
            *SERIES, "ts", F.col("value").cast("double"), F.col("grid_s").cast("int"), day_of("ts").alias("day")
        )
        self._write(rows, "points")
        days = self.days_of(rows)
        held = self.points().filter(F.col("day").isin(*days)) if days else rows.limit(0)
        self._write(held.groupBy(*SERIES, "grid_s", "value", "day").agg(F.count("*").alias("n")), "counts")
        newest = F.max_by(F.struct("ts", "value", "grid_s"), "ts").alias("r")
        self._write(held.groupBy(*SERIES, "day").agg(newest).select(*SERIES, "r.*", "day"), "last")

    @staticmethod
    def days_of(rows: DataFrame) -> list[str]:
        return sorted(r["day"] for r in rows.select("day").distinct().collect())

    def _write(self, df: DataFrame, kind: str) -> None:
        (
            df.repartition("day", *SERIES)
            .sortWithinPartitions("day", *SERIES)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day")
            .parquet(f"{self.root}/{kind}")
        )

    def points(self) -> DataFrame:
        return self._read("points", POINTS)

    def _read(self, kind: str, schema: str) -> DataFrame:
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/{kind}")
        first = self.first_day()
        return rows if first is None else rows.filter(F.col("day") >= first)

    # -- percentiles -------------------------------------------------------------------
    def percentiles(self, as_of: dt.datetime, window_days: int, scopes: DataFrame | None = None) -> DataFrame:
        """Where each series' latest value stands in the window that ends at ``as_of``, as of the window's own
        points on the latest one's grid. ``scopes`` (one column) narrows the series."""
        start = as_of - dt.timedelta(days=window_days)
        at, begin = F.lit(as_of).cast("timestamp"), F.lit(start).cast("timestamp")
        ends = [start.strftime("%Y%m%d"), as_of.strftime("%Y%m%d")]

        def narrowed(df: DataFrame) -> DataFrame:
            return df if scopes is None else df.join(scopes.select("scope").distinct(), "scope", "left_semi")

        between = (F.col("day") > ends[0]) & (F.col("day") < ends[1])
        edge = narrowed(
            self.points().filter(F.col("day").isin(*ends) & (F.col("ts") > begin) & (F.col("ts") <= at))
        )
        whole = narrowed(self._read("counts", COUNTS).filter(between))
        last = narrowed(self._read("last", LAST).filter(between)).select(*SERIES, "ts", "value", "grid_s")
        latest = (
            last.unionByName(edge.select(*SERIES, "ts", "value", "grid_s"))
            .groupBy(*SERIES)
            .agg(F.max_by(F.struct("value", "grid_s", "ts"), "ts").alias("now"))
            .select(*SERIES, F.col("now.value").alias("current"), F.col("now.grid_s").alias("grid_s"), F.col("now.ts").alias("updated"))
        )
        counted = whole.select(*SERIES, "grid_s", "value", "n").unionByName(
            edge.select(*SERIES, "grid_s", "value", F.lit(1).cast("bigint").alias("n"))
        )
        below = F.sum(F.when(F.col("value") < F.col("current"), F.col("n")).otherwise(0))
        return (
            counted.join(latest, [*SERIES, "grid_s"])
            .groupBy(*SERIES, "grid_s", "current", "updated")
            .agg(F.sum("n").alias("n"), below.alias("below"))
            .select(
                *SERIES,
                F.col("current").alias("value"),
                F.when(F.col("n") >= MIN_N, F.col("below") / F.col("n")).alias("pctl"),
                "n",
                begin.alias("window_from"),
                at.alias("window_to"),
                "grid_s",
                "updated",
            )
        )

    def refreshed(self, stored: DataFrame, touched: DataFrame, as_of: dt.datetime, window_days: int) -> DataFrame:
        """Latest percentiles after a backfill of ``touched`` (scope, from_ts, to_ts): series with a touched
        minute inside the window are counted anew, the others keep their row."""
        start = F.lit(as_of - dt.timedelta(days=window_days)).cast("timestamp")
        dirty = touched.filter(
            (F.col("from_ts") <= F.lit(as_of).cast("timestamp")) & (F.col("to_ts") > start)
        ).select("scope").distinct()
        fresh = self.percentiles(as_of, window_days, dirty)
        return stored.join(dirty, "scope", "left_anti").unionByName(fresh)

    # -- retention ---------------------------------------------------------------------
    def first_day(self) -> str | None:
        """The first day that is listed; None where nothing has expired."""
        listed = [f.partition("=")[2] for f in files.folders(self.spark, f"{self.root}/held") if "=" in f]
        return max(listed, default=None)

    def expire(self, before: str) -> int:
        """Drop all days before ``before`` (yyyyMMdd): unlist them, then delete their folders; the days deleted."""
        self.spark.range(1).write.mode("overwrite").parquet(f"{self.root}/held/first={before}")
        deleted = 0
        for kind in ("points", "counts", "last"):
            for folder in files.folders(self.spark, f"{self.root}/{kind}"):
                day = folder.partition("=")[2]
                if folder.startswith("day=") and day < before:
                    deleted += files.delete(self.spark, f"{self.root}/{kind}/{folder}") and kind == "points"
        return deleted
