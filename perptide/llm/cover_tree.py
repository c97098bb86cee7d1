"""Exact top-k search with two cover trees.

Components become whole numbers, floor(1024 * x), and the score is the inner product.
Each task indexes its vectors in blocks; the queries, a stated set, come in broadcast blocks
of bounded size with a tree of their own. Both trees are walked together: a pair of
nodes with centers p, q and covering radii r, s holds no score above
<p, q> + r |q| + s |p| + r s, so the pair is left out once that is below the worst k-th
score of the query node. What is left is scored exactly, block against block.

Queries first meet a bounded sample of the rows. Its k-th scores are lower bounds from the
start, so a task returns only what may still be among the best.

Defined results
* Vectors that are NULL, or hold NULL or a value that is not finite, take no part, nor do
  rows without an identifier. Vectors of different lengths are not compared.
* A query never meets rows of its own identifier. Repeated rows are candidates each for
  itself; of several query rows with one identifier the smallest vector asks.
* Ties go to the smaller identifier. Fewer candidates than k: all of them.
* A score beyond 64 bits that is met, or a component beyond 2 ** 500, is an error; any other score
  is exact. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perptide.llm.common import materialized, ordered_hash

K = 10
SCALE = 1024
#: A cover tree's scales shrink by this factor from level to level.
BASE = 1.3
LEAF = 64
#: Queries of a leaf: few, so that each leaf has a tight ball and a k-th score of its own.
QUERY_LEAF = 4
BLOCK = 8192
QUERY_BLOCK = 8192
SEEDS = 4096
#: Stands for no score; below every score.
NONE = np.iinfo(np.int64).min


@dataclass
class Node:
    """A ball of the tree: its points lie within ``radius`` of ``center``."""

    points: np.ndarray
    center: np.ndarray
    radius: float
    children: list[Node] = field(default_factory=list)

    @cached_property
    def balls(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Centers, radii and center norms of the children, or of the node itself if it has none."""
        nodes = self.children or [self]
        centers = np.stack([n.center for n in nodes])
        return centers, np.array([n.radius for n in nodes]), np.sqrt((centers * centers).sum(axis=1))


def cover_tree(
    vectors: np.ndarray, leaf: int = LEAF, points: np.ndarray | None = None, center: int | None = None
) -> Node:
    """Top-down cover tree. The centers of a node's children are points farther apart than the
    children's scale, and every point lies within that scale of its child's center."""
    points = np.arange(len(vectors)) if points is None else points
    center = int(points[0]) if center is None else center
    away = np.sqrt(((vectors[points] - vectors[center]) ** 2).sum(axis=1))
    node = Node(points, vectors[center], float(away.max()))
    if len(points) <= leaf or node.radius == 0:
        return node
    scale = node.radius / BASE
    left = np.concatenate([[center], points[points != center]])
    while len(left):
        head = int(left[0])
        near = ((vectors[left] - vectors[head]) ** 2).sum(axis=1) <= scale * scale
        near[0] = True
        node.children.append(Node(left[near], vectors[head], 0.0))
        left = left[~near]
    node.children = [cover_tree(vectors, leaf, c.points, int(c.points[0])) for c in node.children]
    if leaf == LEAF:
        node.children = _grouped(node.children, vectors)
    return node


def _grouped(children: list[Node], vectors: np.ndarray) -> list[Node]:
    """Children of few points are put together in leaves around one of their centers."""
    small = [c for c in children if len(c.points) < LEAF // 4 and not c.children]
    out = [c for c in children if not (len(c.points) < LEAF // 4 and not c.children)]
    held: list[np.ndarray] = []
    for i, child in enumerate(small):
        held.append(child.points)
        if sum(map(len, held)) >= LEAF or i == len(small) - 1:
            points = np.concatenate(held)
            middle = vectors[points].mean(axis=0)
            radius = float(np.sqrt(((vectors[points] - middle) ** 2).sum(axis=1)).max())
            out.append(Node(points, middle, radius))
            held = []
    return out


class Best:
    """The k best (score, identifier) of each query so far."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k = k
        self.scores = np.full((len(floors), k), NONE)
        self.ids = np.full((len(floors), k), np.iinfo(np.int64).max)
        found = np.isfinite(floors)
        self.floors = np.where(found, np.where(found, floors, 0).astype(np.int64), NONE)

    def worst(self, queries: np.ndarray) -> np.ndarray:
        return np.maximum(self.scores[queries, -1], self.floors[queries])

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        some = (scores >= self.worst(queries)[:, None]).any(axis=1)
        queries, scores = queries[some], scores[some]
        if not len(queries):
            return
        scores = np.concatenate([self.scores[queries], scores], axis=1)
        ids = np.concatenate([self.ids[queries], np.broadcast_to(ids, (len(queries), len(ids)))], axis=1)
        order = np.lexsort((ids, ~scores), axis=1)[:, : self.k]
        self.scores[queries] = np.take_along_axis(scores, order, axis=1)
        self.ids[queries] = np.take_along_axis(ids, order, axis=1)


def dual_search(
    query_tree: Node, queries: np.ndarray, query_ids: np.ndarray, tree: Node, vectors: np.ndarray, ids: np.ndarray,
    best: Best,
) -> int:
    """Walk both trees and update ``best``; returns the number of scores that were computed."""
    scored = 0
    stack = [(query_tree, tree, np.inf)]
    while stack:
        q, d, bound = stack.pop()
        if bound < best.worst(q.points).min():
            continue
        if not q.children and not d.children:
            own = query_ids[q.points][:, None] == ids[d.points][None, :]
            scores = exact_scores(queries[q.points], vectors[d.points], own)
            best.add(q.points, scores, ids[d.points])
            scored += scores.size
            continue
        # Half a unit, and a share of the size, stand above any rounding of a bound.
        if d.children and (not q.children or d.radius >= q.radius):
            pairs, (centers, radii, norms), other = [(q, c) for c in d.children], d.balls, q
        else:
            pairs, (centers, radii, norms), other = [(c, d) for c in q.children], q.balls, d
        norm = float(np.sqrt(other.center @ other.center))
        bounds = centers @ other.center + radii * norm + other.radius * norms + radii * other.radius
        bounds += 0.5 + 1e-9 * (norms + radii) * (norm + other.radius)
        stack += [(*pairs[i], float(bounds[i])) for i in np.argsort(bounds)]
    return scored


def whole(vector: Column) -> Column:
    """Whether a vector takes part."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )


def _matrix(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows and scaled vectors by the vectors' length."""
    lengths = np.diff(column.offsets.to_numpy())
    values = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    out = {}
    for size in np.unique(lengths):
        rows = np.flatnonzero(lengths == size)
        out[int(size)] = rows, values[starts[rows][:, None] + np.arange(size)]
    return out


def exact_scores(queries: np.ndarray, vectors: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit numbers, ``NONE`` where ``own`` holds: in doubles or 64 bits where every partial
    sum fits, else in numbers of any size."""
    most = lambda m: float(np.abs(m).max(initial=0.0))
    largest = queries.shape[1] * most(queries) * most(vectors)
    if largest < 2**52:
        scores = (queries @ vectors.T).astype(np.int64)
    # A component meets zeros alone where the product is small, and may not fit by itself.
    elif largest < 2**62 and max(most(queries), most(vectors)) < 2**62:
        scores = queries.astype(np.int64) @ vectors.astype(np.int64).T
    else:
        scores = _integers(queries) @ _integers(vectors).T
        scores[own] = NONE
        if (np.abs(scores[~own]) >= 2**63).any():
            raise OverflowError("a score does not fit 64 bits")
        scores = scores.astype(np.int64)
    scores[own] = NONE
    return scores


def _integers(values: np.ndarray) -> np.ndarray:
    out = np.empty(values.size, object)
    out[:] = [int(v) for v in values.ravel()]
    return out.reshape(values.shape)


def _bounded(vectors: np.ndarray) -> np.ndarray:
    """``vectors``, whose squared distances must be finite."""
    if np.abs(vectors).max(initial=0.0) >= 2.0**500:
        raise OverflowError("a component is too large")
    return vectors


def top_of(
    data: DataFrame, asking: list[tuple[int, list[float]]], floors: dict[int, int], k: int = K
) -> DataFrame:
    """(query_id, vec_id, score): per task the best of its rows for each query of one block."""
    context = data.sparkSession.sparkContext
    block = context.broadcast((asking, floors))

    def run(batches):
        asked, known = block.value
        trees = {}
        for size in {len(v) for _, v in asked}:
            own = [(i, v) for i, v in asked if len(v) == size]
            matrix = _bounded(np.floor(SCALE * np.array([v for _, v in own], np.float64).reshape(len(own), size)))
            numbers = np.array([i for i, _ in own], np.int64)
            limits = np.array([known.get(i, NONE) for i, _ in own], np.int64)
            trees[size] = matrix, numbers, cover_tree(matrix, QUERY_LEAF), Best(limits, k)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                for size, (rows, vectors) in _matrix(part.column(1)).items():
                    if size in trees:
                        matrix, numbers, tree, best = trees[size]
                        dual_search(tree, matrix, numbers, cover_tree(_bounded(vectors)), vectors, ids[rows], best)
        for _, numbers, _, best in trees.values():
            keep = (best.scores != NONE) & (best.scores >= best.floors[:, None])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.broadcast_to(numbers[:, None], keep.shape)[keep], pa.int64()),
                    pa.array(best.ids[keep], pa.int64()),
                    pa.array(best.scores[keep], pa.int64()),
                ],
                names=["query_id", "vec_id", "score"],
            )

    return data.mapInArrow(run, "query_id long, vec_id long, score long")


def ranked(found: DataFrame, k: int = K) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows for which ``is_query`` holds, against all rows."""
    rows = vectors.where(F.col(vec_id).isNotNull() & whole(F.col(embedding)))
    data = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("v"))
    queries = rows.where(is_query).groupBy(F.col(vec_id).cast("long").alias("id")).agg(F.min(embedding).alias("v"))
    seeds = materialized(data.orderBy(ordered_hash(F.col("id")), "id").limit(SEEDS))
    found = None
    for block in _blocks(queries, query_block):
        first = ranked(top_of(seeds, block, {}, k), k).where(F.col("rank") == k).collect()
        floors = {r["query_id"]: r["score"] for r in first}
        part = top_of(data, block, floors, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    return ranked(found, k).select("query_id", "rank", "vec_id", "score")


def _blocks(queries: DataFrame, most: int):
    """Queries in blocks of at most ``most``; one at a time is on the driver."""
    held = []
    for r in queries.toLocalIterator():
        held.append((r["id"], list(r["v"])))
        if len(held) == most:
            yield held
            held = []
    if held:
        yield held
