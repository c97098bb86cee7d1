"""Embedding whitening by spectrum slicing.

Entries become whole numbers, x = floor(64 * c) + 1000000, so counts and sums are exact at any
size. One pass gives every task's count, sums and centred second moments; these are merged row by row
of the matrix, in two rounds, so no task holds more than one row of each partial matrix.

The leading eigenpairs of the covariance V come from slicing its spectrum. The
pivots of an LDL' factorisation of V - s I have the signs of its eigenvalues (inertia), so one
factorisation counts the eigenvalues above s. Halving an interval by such counts isolates the k-th
eigenvalue; Rayleigh quotient iteration from inside the interval then converges cubically; and counts
right below and above what it found certify that this is number k. The components are searched in
tasks of their own. Eigenvalues too close to part by rounding are halved to the last bit, and
inverse iteration that is kept orthogonal to the vectors before gives a basis of their space.

The vectors are scanned three times: moments, the check of the identity, and the result. What
reaches the driver is one matrix of the vectors' dimension.

Defined results
* Vectors that are NULL, empty, or hold NULL, NaN, infinite entries or ones of 2^55 and more take no part.
* Vectors are of one dimension. Of several the most frequent one is whitened (of equals the
  largest) and other vectors take no part.
* Components whose eigenvalue is zero to rounding have no whitened value and are left out; so one
  vector alone, or copies of one vector only, give no rows. Fewer dimensions than asked for: all of them.
* Repeated rows count and return as often as they stand. A deviation beyond 64 bits is NULL.
* An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perptide.llm.common import appended, materialized

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
#: Partial matrices that meet in one group of the first merge.
MERGED_AT_ONCE = 64

_LARGEST = 2.0**55
_EPS = float(np.finfo(float).eps)
#: Eigenvalues nearer than this share of the largest one are treated together.
_CLOSE = 1e-6

_MOMENTS = "dim int, i int, slot int, n long, high long, low long, mean binary, moments binary"


def valid(vector: Column) -> Column:
    """Whether a vector takes part."""
    inside = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < _LARGEST, F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & inside, F.lit(False))


def _matrices(column: pa.Array):
    """(rows, x) for each dimension among the vectors of a batch; x is a whole-number matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    starts = column.offsets.to_numpy()
    sizes, entries = np.diff(starts), column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = starts[:-1] - starts[0]
    for dim in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dim)
        taken = entries[starts[rows][:, None] + np.arange(dim)]
        yield rows, np.floor(SCALE * taken).astype(np.int64) + OFFSET


# ---- moments ------------------------------------------------------------------------


@dataclass
class Moments:
    """Count, mean and centred second moments (rows ``at`` of the matrix) of rows of doubles."""

    n: int
    mean: np.ndarray
    squares: np.ndarray
    high: np.ndarray
    low: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray, exact: np.ndarray | None = None) -> Moments:
        mean = rows.mean(axis=0)
        centred = rows - mean
        none = np.zeros(rows.shape[1], np.int64)
        # Sums of the upper and the lower halves stay far inside 64 bits.
        high, low = (none, none) if exact is None else ((exact >> 31).sum(axis=0), (exact & (1 << 31) - 1).sum(axis=0))
        return cls(len(rows), mean, centred.T @ centred, high, low)

    def add(self, other: Moments, at=slice(None)) -> None:
        """Merge another part; ``squares`` holds the rows ``at`` of the matrix in both."""
        n = self.n + other.n
        apart = other.mean - self.mean
        self.squares = self.squares + other.squares + np.outer(apart[at], apart) * (self.n * (other.n / n))
        self.mean = self.mean + apart * (other.n / n)
        self.high, self.low, self.n = self.high + other.high, self.low + other.low, n


def _partials(matrices):
    """A task's moments for each dimension, one row for each row of the matrix."""

    def rows(found: dict[int, Moments], slot: int):
        for dim, m in found.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(dim, dim), pa.int32()),
                    pa.array(np.arange(dim), pa.int32()),
                    pa.array(np.full(dim, slot), pa.int32()),
                    pa.array(np.full(dim, m.n), pa.int64()),
                    pa.array(m.high, pa.int64()),
                    pa.array(m.low, pa.int64()),
                    pa.array([m.mean.tobytes()] * dim, pa.binary()),
                    pa.array([row.tobytes() for row in m.squares], pa.binary()),
                ],
                names=["dim", "i", "slot", "n", "high", "low", "mean", "moments"],
            )

    def run(batches):
        from pyspark import TaskContext

        slot = TaskContext.get().partitionId() // MERGED_AT_ONCE
        found: dict[int, Moments] = {}
        for batch in batches:
            for part in matrices(batch):
                dim = len(part.mean)
                if dim in found:
                    found[dim].add(part)
                else:
                    if len(found) >= 4:  # many dimensions: hand on what is there, memory stays bounded
                        yield from rows(found, slot)
                        found = {}
                    found[dim] = part
        yield from rows(found, slot)

    return run


def _merged(table: pa.Table) -> pa.Table:
    """One row of the matrix, merged over parts."""
    i, total = table["i"][0].as_py(), None
    for n, high, low, mean, squares in zip(*(table[c].to_pylist() for c in ("n", "high", "low", "mean", "moments")), strict=True):
        part = Moments(n, np.frombuffer(mean), np.frombuffer(squares)[None, :], np.array([high]), np.array([low]))
        if total is None:
            total = part
        else:
            total.add(part, slice(i, i + 1))
    return pa.table(
        {
            "dim": pa.array([table["dim"][0].as_py()], pa.int32()),
            "i": pa.array([i], pa.int32()),
            "slot": pa.array([table["slot"][0].as_py()], pa.int32()),
            "n": pa.array([total.n], pa.int64()),
            "high": pa.array(total.high, pa.int64()),
            "low": pa.array(total.low, pa.int64()),
            "mean": pa.array([total.mean.tobytes()], pa.binary()),
            "moments": pa.array([total.squares.tobytes()], pa.binary()),
        }
    )


def moments(rows: DataFrame, matrices) -> tuple[int, list[int], np.ndarray, np.ndarray] | None:
    """(n, sums, mean, covariance) over all rows; None without rows. Sums are exact."""
    merged = rows.mapInArrow(_partials(matrices), _MOMENTS)
    for keys in (["dim", "i", "slot"], ["dim", "i"]):
        merged = merged.groupBy(*keys).applyInArrow(_merged, _MOMENTS)
    stored = materialized(merged)
    leading = stored.where("i = 0").orderBy(F.desc("n"), F.desc("dim")).first()
    if leading is None:
        return None
    found = sorted(stored.where(F.col("dim") == leading["dim"]).collect(), key=lambda r: r["i"])
    squares = np.stack([np.frombuffer(r["moments"]) for r in found]) / leading["n"]
    sums = [(r["high"] << 31) + r["low"] for r in found]
    return leading["n"], sums, np.frombuffer(leading["mean"]), (squares + squares.T) / 2


# ---- spectrum -----------------------------------------------------------------------


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are greater than ``shift``: positive pivots of LDL' of the shifted matrix.

    Pivots are single entries or pairs, chosen so that no entry grows much; a pair has one
    eigenvalue of each sign.
    """
    a = matrix - shift * np.eye(len(matrix))
    bound = (1 + 17**0.5) / 8
    size, k, positive = len(a), 0, 0

    def swap(p: int, q: int) -> None:
        a[[p, q]] = a[[q, p]]
        a[:, [p, q]] = a[:, [q, p]]

    while k < size:
        pair = False
        below = np.abs(a[k + 1 :, k])
        if len(below) and abs(a[k, k]) < bound * below.max():
            r = k + 1 + int(below.argmax())
            others = np.abs(a[r, k:])
            others[r - k] = 0
            if abs(a[k, k]) * others.max() < bound * below.max() ** 2:
                if abs(a[r, r]) >= bound * others.max():
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    pair = True
        if pair:
            block, side = a[k : k + 2, k : k + 2], a[k + 2 :, k : k + 2]
            positive += 1
            a[k + 2 :, k + 2 :] -= side @ np.linalg.solve(block, side.T)
            k += 2
        else:
            pivot, side = a[k, k], a[k + 1 :, k]
            positive += bool(pivot > 0)
            if pivot != 0:
                a[k + 1 :, k + 1 :] -= np.outer(side, side / pivot)
            k += 1
    return positive


def _solve(matrix: np.ndarray, shift: float, x: np.ndarray, scale: float) -> np.ndarray:
    while True:
        try:
            y = np.linalg.solve(matrix - shift * np.eye(len(matrix)), x)
            if np.isfinite(y).all():
                return y / np.linalg.norm(y)
        except np.linalg.LinAlgError:
            pass
        shift += _EPS * scale


def _quotient(matrix: np.ndarray, x: np.ndarray) -> tuple[float, float]:
    image = matrix @ x
    value = float(x @ image)
    return value, float(np.linalg.norm(image - value * x))


def _start(size: int, k: int) -> np.ndarray:
    return np.random.default_rng([size, k]).standard_normal(size)


@dataclass
class Slice:
    """The interval (low, high] that holds eigenvalue ``k``, and the counts above its ends."""

    matrix: np.ndarray
    k: int
    low: float
    high: float
    above_low: int = field(init=False)
    above_high: int = 0

    def __post_init__(self) -> None:
        self.above_low = len(self.matrix)

    @property
    def width(self) -> float:
        return self.high - self.low

    def halve(self) -> None:
        middle = self.low + self.width / 2
        n = above(self.matrix, middle)
        if n >= self.k:
            self.low, self.above_low = middle, n
        else:
            self.high, self.above_high = middle, n

    def narrow(self, width: float, alone: bool = False) -> bool:
        """Halve until the eigenvalue is alone, if that is asked for, or the interval this narrow."""
        while self.width > width and not (alone and self.above_low - self.above_high == 1):
            if not self.low < self.low + self.width / 2 < self.high:
                break
            self.halve()
        return self.above_low - self.above_high == 1


def eigenpair(matrix: np.ndarray, k: int, top: float) -> tuple[float, np.ndarray | None]:
    """Eigenvalue number ``k`` from the largest, with its vector where it stands apart from all others.

    ``top`` is above all eigenvalues. Rayleigh quotients that leave the interval were drawn
    to a neighbour, and the interval is halved once more.
    """
    part = Slice(matrix, k, -top * _EPS * len(matrix), top)
    while part.narrow(_CLOSE * top / 4, alone=True):
        x = _solve(matrix, part.low + part.width / 2, _start(len(matrix), k), top)
        x = _solve(matrix, part.low + part.width / 2, x, top)
        value, residual = _quotient(matrix, x)
        for _ in range(20):
            if not part.low < value <= part.high:
                break
            y = _solve(matrix, value, x, top)
            better, left = _quotient(matrix, y)
            if left >= residual:
                break
            x, value, residual = y, better, left
        if part.low < value <= part.high and residual <= _EPS * len(matrix) * top:
            return value, x
        if part.width <= _CLOSE * top / 4:
            break
        part.halve()
    part.narrow(2 * _EPS * top)
    return part.low + part.width / 2, None


def certified(matrix: np.ndarray, k: int, value: float, top: float) -> bool:
    """Whether counts on both sides of ``value`` say that it is eigenvalue number ``k``."""
    margin = 16 * _EPS * len(matrix) * top
    return above(matrix, value + margin) < k <= above(matrix, value - margin)


def _orthogonal(matrix: np.ndarray, k: int, value: float, before: list[np.ndarray], top: float) -> np.ndarray:
    """A vector of ``value`` at right angles to the vectors ``before``, by inverse iteration."""
    x = _start(len(matrix), k)
    shift = value + 4 * _EPS * top
    for _ in range(6):
        x = _solve(matrix, shift, x, top)
        for _ in range(2):
            for v in before:
                x = x - (v @ x) * v
            x = x / np.linalg.norm(x)
    return x


def leading(spark, matrix: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The leading eigenvalues that are not zero to rounding, falling, and their vectors as columns."""
    size, top = len(matrix), float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    wanted = min(components, above(matrix, 8 * _EPS * size * top)) if top > 0 else 0
    if not wanted:
        return np.zeros(0), np.zeros((size, 0))
    top *= 1 + 4 * _EPS

    def search(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                value, x = eigenpair(matrix, k, top)
                sure = certified(matrix, k, value, top)
                columns = {"k": [k], "value": [value], "sure": [sure], "vector": [None if x is None else x.tobytes()]}
                types = [pa.int64(), pa.float64(), pa.bool_(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(columns.values(), types, strict=True)], names=list(columns)
                )

    numbers = spark.range(1, wanted + 1, numPartitions=min(wanted, max(2, spark.sparkContext.defaultParallelism)))
    found = numbers.mapInArrow(search, "k long, value double, sure boolean, vector binary").collect()
    found.sort(key=lambda r: r["k"])
    if not all(r["sure"] for r in found):
        raise ArithmeticError("an eigenvalue does not have the number that was looked for")
    values, vectors = np.array([r["value"] for r in found]), []
    for at, r in enumerate(found):
        near = [j for j in range(at) if values[j] - values[at] < _CLOSE * top]
        if near or r["vector"] is None:
            vectors.append(_orthogonal(matrix, r["k"], values[at], [vectors[j] for j in near], top))
        else:
            vectors.append(np.frombuffer(r["vector"]))
    return values, np.stack(vectors, axis=1)


# ---- the operator -------------------------------------------------------------------


@dataclass
class Whitening:
    """What the fit list taught: its size and exact sums, and the leading eigenpairs of its covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def dim(self) -> int:
        return len(self.sums)

    @property
    def explained(self) -> list[float]:
        return (self.values / self.trace).tolist() if len(self.values) else []

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows of whole-number vectors."""
        near = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return ((x - near) - rest) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of squares of n * x - S of each row, exact; None beyond 64 bits."""
        most = max(int(np.abs(x).max(initial=0)) * self.n, *map(abs, self.sums))
        if most < 1 << 62:
            apart = x * self.n - np.array(self.sums, np.int64)
            if int(np.abs(apart).max(initial=0)) ** 2 * self.dim < 1 << 62:
                return (apart * apart).sum(axis=1).tolist()
            apart = apart.astype(object)
        else:
            apart = x.astype(object) * self.n - np.array(self.sums, object)
        return [int(v) if v < 1 << 63 else None for v in (apart * apart).sum(axis=1)]


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Learn from all vectors that take part."""

    def matrices(batch: pa.RecordBatch):
        for _, x in _matrices(batch.column(0)):
            yield Moments.of(x.astype(np.float64), x)

    taking_part = vectors.select(vector).where(valid(F.col(vector)))
    found = moments(taking_part, matrices)
    if found is None:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    n, sums, _, covariance = found
    return Whitening(n, sums, *leading(vectors.sparkSession, covariance, components), float(np.trace(covariance)))


def _part(df: DataFrame, model: Whitening, vector: str) -> DataFrame:
    return df.where(valid(F.col(vector)) & (F.size(vector) == model.dim))


def whitened(
    vectors: DataFrame, model: Whitening, vector: str = "embedding", keep: list[str] | None = None,
    names: tuple[str, str] = ("deviation", "whitened"),
) -> DataFrame:
    """The rows that take part (their columns ``keep``) with the deviation and the array of whitened values."""

    def arrays(batch: pa.RecordBatch):
        deviations, rows = [], np.zeros((0, len(model.values)))
        for _, x in _matrices(batch.column(vector)):
            deviations, rows = model.deviations(x), model.apply(x)
        yield pa.array(deviations, pa.int64())
        ends = pa.array(np.arange(len(rows) + 1) * len(model.values), pa.int32())
        yield pa.ListArray.from_arrays(ends, pa.array(rows.ravel(), pa.float64()))

    deviation, values = names
    return appended(_part(vectors, model, vector), f"`{deviation}` long, `{values}` array<double>", arrays, keep)


def identity_error(vectors: DataFrame, model: Whitening, vector: str = "embedding") -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured over all rows."""

    def matrices(batch: pa.RecordBatch):
        for _, x in _matrices(batch.column(0)):
            yield Moments.of(model.apply(x))

    if not len(model.values):
        return None
    _, _, _, covariance = moments(_part(vectors.select(vector), model, vector), matrices)
    return float(np.abs(covariance - np.eye(len(covariance))).max())
