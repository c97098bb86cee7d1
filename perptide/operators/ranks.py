"""Order slices and exact ranks of keys of any size and any distribution.

Rows of a large key are dealt by value into slices of about equal size, whose borders come from
a mergeable quantile sketch of the key itself; so a series inside a narrow band is
spread as well as one over many magnitudes. Equal values lie in one slice; where many rows may share
one value, ``tie_ranks`` deals these by their identifiers in turn.

The borders are written once and read back: all uses of them see the same ones, also when a
lost executor makes Spark compute a part again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perptide.operators.carry import running
from perptide.sources.materialize import materialized

#: Keys of fewer rows stay in one slice.
ROWS_A_SLICE = 1 << 16
SLICES = 256
_COARSE = 16


def sliced(df: DataFrame, keys: Sequence[str], value: Column, rows_a_slice: int = ROWS_A_SLICE) -> DataFrame:
    """``df`` with ``_slice``, a number that never decreases as the numeric ``value`` grows within a key."""
    keys = list(keys)
    shares = [i / SLICES for i in range(1, SLICES)]
    sketch = F.percentile_approx("_value", F.array(*map(F.lit, shares)), F.lit(10_000))
    valued = df.withColumn("_value", value.cast("double"))
    large = F.count("*") > rows_a_slice
    borders = valued.groupBy(*keys).agg(
        F.when(large, F.array_distinct(sketch)).otherwise(F.array().cast("array<double>")).alias("_borders")
    )
    stored = materialized(borders)
    below = lambda array: F.size(F.filter(array, lambda border: border < F.col("_value")))
    every = F.transform(F.sequence(F.lit(1), F.lit(_COARSE - 1)), lambda i: F.get("_borders", i * _COARSE - 1))
    # Two short searches instead of one along all borders.
    coarse = F.size(F.filter(every, lambda b: F.coalesce(b < F.col("_value"), F.lit(False))))
    fine = below(F.slice("_borders", F.col("_coarse") * _COARSE + 1, F.lit(_COARSE)))
    return (
        valued.join(stored, keys)
        .withColumn("_coarse", F.when(F.size("_borders") > 0, coarse).otherwise(0))
        .withColumn("_slice", F.when(F.size("_borders") > 0, F.col("_coarse") * _COARSE + fine).otherwise(0).cast("bigint"))
        .drop("_value", "_coarse", "_borders")
    )


def _as_number(df: DataFrame, name: str) -> Column:
    """A number that grows with the column: itself, or the first six bytes of a text."""
    if df.schema[name].dataType.typeName() == "string":
        return F.conv(F.rpad(F.hex(F.substring(F.col(name).cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    return F.col(name).cast("double")


def tie_ranks(df: DataFrame, keys: Sequence[str], by: str, out: str, rows_a_slice: int = ROWS_A_SLICE) -> DataFrame:
    """``df`` with ``out``, the rank from 1 of the row's ``by`` among the rows of its key."""
    dealt = sliced(df, keys, _as_number(df, by), rows_a_slice)
    return running(dealt, keys, [by], F.lit(1), out, how="sum", chunk=F.col("_slice")).drop("_slice")
