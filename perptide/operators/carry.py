"""Running values and islands that do not put a whole key into one task.

A plain window over (venue, symbol) sorts one key in one task, and a single key
may hold a third of the data. Here each key is cut into time chunks. The running
value of a row is its value inside the chunk combined with what the earlier
chunks carry in, and the carry is computed from one pre-aggregated row per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

DAY_MS = 86_400_000


def chunk_of(ms: Column, chunk_ms: int = DAY_MS) -> Column:
    return F.floor(ms / F.lit(chunk_ms)).cast("bigint")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    how: str = "max",
    chunk: Column | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Add ``out``: running max or sum of ``value`` per key in ``order``.

    ``chunk`` must not decrease along ``order``; by default it is the day of the
    first order column, taken as UTC milliseconds.
    """
    aggregate = {"max": F.max, "sum": F.sum}[how]
    keys = list(keys)
    marked = df.withColumn("_v", value).withColumn(
        "_chunk", chunk if chunk is not None else chunk_of(F.col(order[0]))
    )
    per_chunk = marked.groupBy(*keys, "_chunk").agg(aggregate("_v").alias("_cv"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = per_chunk.select(*keys, "_chunk", aggregate("_cv").over(before).alias("_carry"))
    inside = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    local = aggregate("_v").over(inside)
    if how == "max":
        total = F.greatest(local, F.col("_carry"))
    else:
        total = F.when(
            local.isNotNull() | F.col("_carry").isNotNull(),
            F.coalesce(local, F.lit(0)) + F.coalesce(F.col("_carry"), F.lit(0)),
        )
    return (
        marked.join(carried, [*keys, "_chunk"], "left")
        .withColumn(out, total)
        .drop("_v", "_chunk", "_carry")
    )


def trailing_sums(
    points: DataFrame,
    keys: Sequence[str],
    at_ms: str,
    frame_ms: int,
    sums: Sequence[str],
) -> DataFrame:
    """Sum each column over the open-left frame (at - frame_ms, at].

    Points are summed per (key, instant) first, then each key is cut into blocks of one
    frame. A frame is its own block up to the instant and what the block before holds
    behind (at - frame_ms). Both are running sums, so no frame is added up anew and the
    work grows with the points, not with the points of a frame. Nothing is subtracted.
    """
    keys = list(keys)
    instants = points.filter(F.col(at_ms).isNotNull()).groupBy(*keys, at_ms).agg(*[F.sum(c).alias(c) for c in sums])
    block = Window.partitionBy(*keys, "_block")
    forward, backward = block.orderBy(at_ms), block.orderBy(F.desc(at_ms))

    def totals(window):
        return F.struct(*[F.sum(c).over(window).alias(c) for c in sums])

    parts = instants.withColumn("_block", chunk_of(F.col(at_ms), frame_ms)).select(
        *keys,
        at_ms,
        "_block",
        totals(forward.rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"),
        totals(backward.rowsBetween(Window.unboundedPreceding, 0)).alias("_from_here"),
        totals(backward.rowsBetween(Window.unboundedPreceding, -1)).alias("_behind"),
        F.row_number().over(forward).alias("_nth"),
    )

    def step(block_no, since, at, own, rest):
        named = {"_block": block_no, "_since": since, at_ms: at, "_own": own, "_rest": rest}
        return F.struct(*[c.alias(name) for name, c in named.items()])

    # A block leaves the frames of the next one point by point, a frame after each.
    at, next_no, none = F.col(at_ms), F.col("_block") + 1, F.lit(None)
    own = step(F.col("_block"), at.cast("bigint"), at, F.col("_upto"), none)
    whole = step(next_no, next_no * frame_ms - 1, none, none, F.col("_from_here"))
    left = step(next_no, at.cast("bigint") + frame_ms, none, none, F.col("_behind"))
    steps = parts.select(
        *keys, F.inline(F.when(F.col("_nth") == 1, F.array(own, whole, left)).otherwise(F.array(own, left)))
    )
    so_far = block.orderBy("_since").rangeBetween(Window.unboundedPreceding, 0)
    held = steps.withColumn("_rest", F.last("_rest", ignorenulls=True).over(so_far)).filter(F.col("_own").isNotNull())
    types = held.schema["_own"].dataType
    return held.select(*keys, at_ms, *[_added(F.col("_own")[c], F.col("_rest")[c], types[c].dataType).alias(c) for c in sums])


def _added(a: Column, b: Column, kind: DataType) -> Column:
    """The sum of both in their own type, of one where the other is NULL."""
    if isinstance(kind, DecimalType):
        # A decimal of 38 digits would lose one of its scale to the sum's carry.
        room = DecimalType(min(kind.precision, 37), kind.scale)
        return F.coalesce((a.cast(room) + b.cast(room)).cast(kind), a, b)
    return F.coalesce(a + b, a, b)


def islands(
    steps: DataFrame, keys: Sequence[str], at_ms: str, step_ms: int = 60_000
) -> DataFrame:
    """Add ``island_ms``: the first step of the unbroken run a step belongs to.

    ``steps`` has one row per (key, step). A run starts where the preceding step
    is absent, which is an equality join on the step before.
    """
    keys = list(keys)
    previous = steps.select(
        *keys, (F.col(at_ms) + step_ms).alias(at_ms), F.lit(True).alias("_has_previous")
    )
    flagged = steps.join(previous, [*keys, at_ms], "left")
    start = F.when(F.col("_has_previous").isNull(), F.col(at_ms))
    return running(flagged, keys, [at_ms], start, "island_ms").drop("_has_previous")


def merge_intervals(
    df: DataFrame, keys: Sequence[str], from_ms: str, to_ms: str, *aggregates: Column
) -> DataFrame:
    """Unite overlapping or touching intervals per key into maximal ones."""
    keys = list(keys)
    # One row per start instant: the longest interval from there decides coverage.
    starts = df.groupBy(*keys, from_ms).agg(F.max(to_ms).alias("_to"))
    reach = running(starts, keys, [from_ms], F.col("_to"), "_reach", inclusive=False)
    opening = F.when(
        F.col("_reach").isNull() | (F.col(from_ms) > F.col("_reach")), F.col(from_ms)
    )
    labelled = running(reach, keys, [from_ms], opening, "_island").select(
        *keys, from_ms, "_island"
    )
    return (
        df.join(labelled, [*keys, from_ms])
        .groupBy(*keys, F.col("_island").alias("span_from_ms"))
        .agg(F.max(to_ms).alias("span_to_ms"), *aggregates)
    )
