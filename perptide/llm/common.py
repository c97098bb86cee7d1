"""Small helpers that several operators of this folder share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perptide.sources.materialize import materialized

__all__ = [
    "WordHashes",
    "ascii_lower",
    "bytes_of",
    "fold",
    "fresh",
    "left_by",
    "lowered_words",
    "materialized",
    "mixed",
    "numbered",
    "ordered_hash",
]

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER_TABLE = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and leave every other character alone."""
    return F.translate(text, _UPPER, _UPPER.lower())


def fold(doc_id: Column, parts: int = 5) -> Column:
    """crc32 of the identifier's text, modulo ``parts``; NULL for a NULL identifier."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)).cast("int")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not use yet, whatever columns callers bring along."""
    taken = {name.lower() for name in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def left_by(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on ``keys`` where NULL equals NULL; ``right`` holds one row per key."""
    names = fresh(left, *[f"key_{i}" for i in range(len(keys))])
    renamed = right.withColumnsRenamed(dict(zip(keys, names, strict=True)))
    on = [left[k].eqNullSafe(renamed[n]) for k, n in zip(keys, names, strict=True)]
    return left.join(renamed, on, "left").drop(*names)


def ordered_hash(*columns: Column) -> Column:
    """A non-negative 62-bit hash to order or to deal rows by."""
    return F.xxhash64(*columns).bitwiseAND(F.lit((1 << 62) - 1))


def numbered(df: DataFrame, name: str, by: list[str], order: list[str], rows_a_group: int = 1 << 15) -> DataFrame:
    """Add ``name``, a gapless rank from 0 within ``by``, however many rows one ``by`` holds.

    Rows are dealt into hash groups of about ``rows_a_group``; a rank is the rank within
    the group plus the rows of the groups before it. ``order`` must tell rows apart;
    rows that are equal in all of it are interchangeable.
    """
    group, hashed, base, amount = fresh(df, "rank_group", "rank_hash", "rank_base", "rank_rows")
    groups = max(64, 1 << (max(1, df.count()) // rows_a_group).bit_length())
    dealt = df.withColumn(hashed, ordered_hash(*[F.col(c) for c in order])).withColumn(
        group, F.col(hashed) % groups
    )
    from pyspark.sql import Window

    sizes = dealt.groupBy(*by, group).agg(F.count("*").alias(amount))
    before = Window.partitionBy(*by).orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn(base, F.coalesce(F.sum(amount).over(before), F.lit(0))).drop(amount)
    inside = Window.partitionBy(*by, group).orderBy(hashed, *order)
    ranked = dealt.withColumn(name, F.row_number().over(inside) - F.lit(1))
    return (
        left_by(ranked, sizes, [*by, group])
        .withColumn(name, (F.col(name) + F.col(base)).cast("long"))
        .drop(group, hashed, base)
    )


# ---- inside tasks -------------------------------------------------------------------


def bytes_of(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding it."""
    return column.cast(pa.binary()).to_pylist()


def lowered_words(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased; none for a NULL text."""
    return text.translate(_LOWER_TABLE).split() if text else []


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that sums and products of hashes spread over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class WordHashes(dict):
    """64-bit hash of each word; forgets all once ``most`` words are held, so memory is bounded."""

    def __init__(self, most: int = 1 << 18):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def appended(df: DataFrame, fields: str, arrays, keep: list[str] | None = None) -> DataFrame:
    """``df`` with columns made batch by batch: ``arrays(batch)`` yields one array per field.

    ``fields`` is a DDL string. The columns of ``df`` (or those in ``keep``) pass through,
    so no join is needed to bring the new columns to the rows.
    """
    from pyspark.sql.types import StructType

    added = StructType.fromDDL(fields)
    kept = df.columns if keep is None else keep

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *arrays(batch)], names=[*kept, *added.names]
            )

    return df.mapInArrow(run, StructType([*(df.schema[c] for c in kept), *added.fields]))
