"""Month partitions of the time-series tables: coverage, catch-all rows, retention."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perptide.functions import scalars as C

RETENTION_DAYS = {"divergence_1m": 35, "notify_log": 90}


def month_counts(df: DataFrame, parent: str, ts: str = "ts") -> DataFrame:
    """Rows per UTC month. The month does not depend on a session's clock."""
    return df.groupBy(C.month_of(F.col(ts)).alias("month")).agg(F.count("*").alias("rows")).select(
        F.lit(parent).alias("parent"), "month", "rows"
    )


def _all_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [month_counts(df, name) for name, df in tables.items()]
    )


def catch_all_rows(tables: dict[str, DataFrame], first: str, last: str) -> DataFrame:
    """Rows of each table outside the declared months; normally zero."""
    outside = ~F.col("month").between(first, last)
    return _all_counts(tables).groupBy("parent").agg(
        F.coalesce(F.sum(F.when(outside, F.col("rows"))), F.lit(0)).cast("bigint").alias("rows")
    )


def catch_all_alarm(tables: dict[str, DataFrame], first: str, last: str) -> DataFrame:
    """Only the unhealthy tables: any row returned is an alarm."""
    return catch_all_rows(tables, first, last).filter(F.col("rows") > 0)


def partition_coverage(tables: dict[str, DataFrame], first: str, last: str) -> DataFrame:
    """Months present, the last declared one present, and whether a catch-all exists."""
    inside = F.col("month").between(first, last)
    return _all_counts(tables).groupBy("parent").agg(
        F.count_if(inside).alias("month_partitions"),
        F.max(F.when(inside, F.col("month"))).alias("last_month"),
        F.bool_or(~inside).alias("has_catch_all"),
    )


def retained(df: DataFrame, table: str, as_of: Column, ts: str = "ts") -> DataFrame:
    """Rows inside the table's retention; tables without one are permanent.

    Compared by day, so a table partitioned by day loses whole partitions.
    """
    days = RETENTION_DAYS.get(table)
    if days is None:
        return df
    return df.filter(F.to_date(ts) > F.date_sub(F.to_date(as_of), days))


def expired_days(df: DataFrame, table: str, as_of: Column, ts: str = "ts") -> DataFrame:
    """Days that may be dropped, with their row counts."""
    cutoff = F.date_sub(F.to_date(as_of), RETENTION_DAYS[table])
    day = F.to_date(ts)
    return df.filter(day <= cutoff).groupBy(day.alias("day")).agg(F.count("*").alias("rows"))
