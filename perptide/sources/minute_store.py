"""The minute table on Parquet: an append-only batch log and a base of whole months.

The built-in catalog has no MERGE for Parquet tables, and a table must not be
overwritten while it is read. Batches are therefore appended as staged rows under
their batch number, and reading folds log and base in one aggregation. A repeated
batch overwrites its own files, so a restarted stream writes nothing twice.

Work follows the months that a batch touches, never the size of the table. A generation is a
list that names, for each month, the generation whose files hold it, and for each lane the last batch
that is folded in. Compaction and single statements read the touched months' base and log, write these
months under a new number, and list the others where they are. The list is
written last, so a generation is there as a whole or not at all, and older ones stay readable
until ``vacuum`` deletes what no kept list names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perptide import schemas as S
from perptide.functions import scalars as C
from perptide.operators import merge
from perptide.sources import files

#: Streams that may write one store. Batch n of lane k is number n * LANES + k in the log.
LANES = 1000

LOG_SCHEMA = {**S.STAGE, "batch_seq": "bigint", "month": "string"}
BASE_SCHEMA = {**S.MARKET_1M, "month": "string"}
LIST_SCHEMA = {"month": "string", "held_by": "int", "lane": "int", "upto": "bigint"}

STATEMENTS: dict[str, Callable] = {
    "fast": merge.upsert_fast,
    "slow": merge.upsert_slow,
    "backfill": merge.upsert_backfill,
}


def month(ts_ms: str) -> Column:
    return C.month_of(C.epoch_ms(F.col(ts_ms)))


def months_of(df: DataFrame, column: Column | str = "month") -> list[str]:
    """The months of a batch, a handful of names."""
    name = F.col(column) if isinstance(column, str) else column
    return sorted(r["m"] for r in df.select(name.alias("m")).distinct().collect())


class MinuteStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- the log ---------------------------------------------------------------------
    def append(self, records: DataFrame, batch_seq: int, lane: int = 0) -> None:
        """Stage one batch of a lane; running it again replaces the same partitions.

        The number in the log orders the batches of all lanes, so no two batches share it.
        """
        if not 0 <= lane < LANES:
            raise ValueError(f"a lane is a number from 0 to {LANES - 1}")
        number = batch_seq * LANES + lane
        staged = merge.staged(records)
        (
            staged.withColumn("month", month("ts_ms"))
            .withColumn("batch_seq", F.lit(number).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("month", "batch_seq")
            .parquet(f"{self.root}/log")
        )

    def log(self, after: int | None = None, months: list[str] | None = None) -> DataFrame:
        """Batches outside generation ``after``, which holds those up to a number of its own for each lane."""
        df = self._read(f"{self.root}/log", LOG_SCHEMA)
        if after is not None:
            df = df.filter(~_inside(self._limits(after)))
        return df if months is None else df.filter(F.col("month").isin(*months))

    # -- the base --------------------------------------------------------------------
    def base(self, generation: int | None, months: list[str] | None = None) -> DataFrame:
        """The folded months of a generation. Only files of ``months`` are listed and read."""
        held = {} if generation is None else self._months(generation)
        paths = [
            f"{self.root}/base/month={m}/generation={g}" for m, g in sorted(held.items()) if months is None or m in months
        ]
        if not paths:
            return merge.empty_target(self.spark)
        reader = self.spark.read.schema(S.ddl(BASE_SCHEMA)).option("basePath", f"{self.root}/base")
        return reader.parquet(*paths).select(*merge.COLUMNS)

    def read(
        self,
        segments: DataFrame,
        generation: int | None = None,
        months: list[str] | None = None,
    ) -> DataFrame:
        """The table now: a generation and the batches outside it."""
        return merge.replay(
            self.log(generation, months).drop("month"),
            segments,
            target=self.base(generation, months),
        )

    def compact(self, segments: DataFrame, upto: int | dict[int, int], generation: int | None = None) -> int:
        """Fold batches over ``generation`` into a new generation and return its number.

        ``upto`` is the last batch to take of each lane; a lone number is lane 0's. Lanes move
        on at their own pace, so a generation remembers a limit for each. Months without a new
        batch are neither read nor written.
        """
        limits = {} if generation is None else self._limits(generation)
        limits |= {0: upto} if isinstance(upto, int) else upto
        recent = self.log(generation).filter(_inside(limits))
        touched = months_of(recent)
        rows = recent.filter(F.col("month").isin(*touched)).drop("month")
        folded = merge.replay(rows, segments, target=self.base(generation, touched))
        return self._written(folded, touched, generation, limits)

    def upsert(
        self, records: DataFrame, segments: DataFrame, statement: str, generation: int | None = None
    ) -> int:
        """Apply one batch's statement (fast, slow or backfill) to the months it touches; a new generation.

        For tables that are kept by single statements. Batches still in the log are not seen; a store
        with a log is compacted first.
        """
        staged = merge.staged(records)
        touched = months_of(staged, month("ts_ms"))
        merged = STATEMENTS[statement](self.base(generation, touched), staged, segments).drop("applied")
        limits = {} if generation is None else self._limits(generation)
        return self._written(merged, touched, generation, limits)

    def _written(self, df: DataFrame, touched: list[str], generation: int | None, limits: dict[int, int]) -> int:
        held = {} if generation is None else self._months(generation)
        following = 0 if generation is None else generation + 1
        if touched:
            write_months(df, f"{self.root}/base", F.lit(following))
        rows = [(m, g, None, None) for m, g in sorted((held | dict.fromkeys(touched, following)).items())]
        rows += [(None, None, lane, upto) for lane, upto in sorted(limits.items())]
        listed = self.spark.createDataFrame(rows, S.ddl(LIST_SCHEMA))
        listed.coalesce(1).write.mode("overwrite").parquet(self._list_path(following))
        return following

    def vacuum(self, keep: list[int]) -> int:
        """Delete month files and lists that no generation of ``keep`` names; the number of folders deleted.

        Lists go first, so nothing that is listed ever lacks its files.
        """
        named = {(m, g) for generation in keep for m, g in self._months(generation).items()}
        deleted = 0
        for folder in files.folders(self.spark, f"{self.root}/list"):
            if int(folder.partition("=")[2]) not in keep:
                deleted += files.delete(self.spark, f"{self.root}/list/{folder}")
        for m in files.folders(self.spark, f"{self.root}/base"):
            for g in files.folders(self.spark, f"{self.root}/base/{m}"):
                if (m.partition("=")[2], int(g.partition("=")[2])) not in named:
                    deleted += files.delete(self.spark, f"{self.root}/base/{m}/{g}")
        return deleted

    # -- lists -----------------------------------------------------------------------
    def _list_path(self, generation: int) -> str:
        return f"{self.root}/list/generation={generation}"

    def _listed(self, generation: int) -> list:
        return self._read(self._list_path(generation), LIST_SCHEMA).collect()

    def _months(self, generation: int) -> dict[str, int]:
        return {r["month"]: r["held_by"] for r in self._listed(generation) if r["month"] is not None}

    def _limits(self, generation: int) -> dict[int, int]:
        return {r["lane"]: r["upto"] for r in self._listed(generation) if r["lane"] is not None}

    def _read(self, path: str, columns: dict[str, str]) -> DataFrame:
        return self.spark.read.schema(S.ddl(columns)).parquet(path)


def _inside(limits: dict[int, int]) -> Column:
    """Whether a log row belongs to the batches up to ``limits``: one look-up by lane, for any number of lanes."""
    if not limits:
        return F.lit(False)
    pairs = [F.lit(x) for lane, upto in limits.items() for x in (lane, upto * LANES + lane)]
    last = F.try_element_at(F.create_map(*pairs), (F.col("batch_seq") % LANES).cast("int"))
    return F.coalesce(F.col("batch_seq") <= last, F.lit(False))


def write_months(df: DataFrame, path: str, generation: Column | None = None, ts: str = "ts") -> None:
    """Write a time-series table by UTC month (and generation), rows of a file in time order."""
    by = ["month"] if generation is None else ["month", "generation"]
    dealt = df.withColumn("month", C.month_of(F.col(ts)))
    if generation is not None:
        dealt = dealt.withColumn("generation", generation)
    (
        dealt.repartition("month", "venue", "symbol", F.to_date(ts))
        .sortWithinPartitions("month", ts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
