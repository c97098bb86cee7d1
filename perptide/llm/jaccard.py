"""N-gram Jaccard join: documents whose sets of five-word shingles are at least 80 % alike.

1. One pass makes each document's set of distinct shingles (64-bit hashes), its digest and its
   count vector: the shingles dealt to ``GROUPS`` groups by hash, and their number in each.
   Documents of one digest are one class from here on; classes are the nodes of the join.
2. A second pass emits, per class, the tokens of the set's prefix: two sets that are alike share
   at least one token of their prefixes (size minus the least overlap, plus one, in one common
   order of tokens). The order is rarest first by a sketch of token counts of fixed size, so
   shared passages make no large buckets. A bucket is the classes that emitted one token.
3. Stars: each class is compared with the bucket pivots that it meets most often. Verified links
   are joined to components. A group of near copies is settled here with a few links for each.
4. Count-vector R-tree: a bucket that still holds several components is indexed. Its points are
   the count vectors, sorted by set size and cut into leaves; a leaf pair whose summed coordinate
   minima of the upper corners fall short of the least overlap is left out, then points pairwise
   by the minima of their own vectors, and only pairs across components survive.
   Buckets of nearly the same classes go to one call, which names a pair once for all of them. A call
   of more pairs than points names its classes instead; it is handed their whole sets, verifies its
   pairs itself and gives the links that join components, so what is named grows with the points.
5. Other survivors are verified with the whole sets in rounds: each class tries its best partner in
   another component, components are joined, and pairs inside one are dropped. Once a round
   settles less than half of the pairs, all that are left are verified.

No link between different sets is lost: the prefix filter, the size filter and the bound are all
necessary conditions, and a pair inside one component needs no further link.

Large buckets are cut into leaves and leaf pairs before they reach a task, hot tokens are dealt
by a salt, and texts are fetched only for classes that a pair holds.

Defined results
* Words are parted by ASCII white space, A-Z lower-cased. Fewer than five words make one shingle;
  NULL, empty and blank texts have no shingles and are linked with nothing.
* The component is the smallest identifier of all linked rows; NULL identifiers are passed over,
  so it is NULL only where every linked row has none.
* Repeated rows are in one class. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perptide.llm.common import WordHashes, bytes_of, fresh, left_by, lowered_words, materialized, mixed, ordered_hash

NGRAM = 5
#: Links need 100 * overlap >= PERCENT * union.
PERCENT = 80
GROUPS = 64
#: Cells of the sketch of token counts; a token's cell is its first bits. The sketch is broadcast.
CELL_BITS = 18
#: A token is frequent when its cell counts one class of so many, and twice the mean of all cells.
HOT_SHARE = 1 << 14
#: Pivots of a bucket, each the first by an order of its own.
PIVOTS = 3
#: Points of a stored leaf, and of a node inside a task.
LEAF = 1024
INNER = 32
#: Points that one call takes, and rows of pairs that it holds before it counts or verifies them.
CALL_POINTS = 1 << 15
HELD_PAIRS = 1 << 18
#: Pairs that a call may name for each of its points.
NAMED = 1
#: A longer set counts as a point for each so many tokens, and so many tokens are looked up at once.
POINT_TOKENS = 512
LOOKED_TOKENS = 1 << 18
#: Leaves of at most so many points are compared many at a time.
FEW = 8

_SET_FIELDS = "n long, hi long, lo long, vector array<int>"
#: Bits of the filter that picks the documents whose sets are fetched, and tokens counted at once.
FILTER_BITS = 1 << 26
FLUSH_TOKENS = 1 << 20


def shingles(text: bytes | None, hashes: WordHashes, size: int = NGRAM) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; of all words if there are fewer."""
    words = lowered_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = hashes.of(words)
    take = min(size, len(h))
    out = np.full(len(h) - take + 1, take, np.uint64)
    for k in range(take):
        out = out * np.uint64(0x9E3779B97F4A7C15) + mixed(h[k : len(h) - take + 1 + k])
    return np.unique(mixed(out))


def digest(tokens: np.ndarray) -> tuple[int, int]:
    body = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    return int.from_bytes(body[:8], "little", signed=True), int.from_bytes(body[8:], "little", signed=True)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Tokens of which a set of n and any set alike share at least one."""
    return n - -(-percent * n // 100) + 1


def least_overlap(a, b, percent: int = PERCENT):
    """Shared tokens that sets of a and b tokens need: overlap * (100 + percent) >= percent * (a + b)."""
    return -(-percent * (a + b) // (100 + percent))


def _sets(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows of two kinds from one pass: documents (token NULL) and cells of the sketch (cell in token, count in n)."""
    kind = docs.schema[doc_id].dataType.simpleString()

    names = ["doc_id", "text_key", "n", "hi", "lo", "vector", "token"]
    vectors = pa.list_(pa.int32())

    def run(batches):
        hashes, seen, held, waiting, kind = WordHashes(), set(), [], 0, pa.int64()
        counts = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            kind = batch.schema.field(0).type
            facts, grouped = [], np.zeros((batch.num_rows, GROUPS), np.int32)
            for i, body in enumerate(bytes_of(batch.column(1))):
                tokens = shingles(body, hashes)
                hi, lo = digest(tokens) if len(tokens) else (0, 0)
                grouped[i] = np.bincount((tokens & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)
                facts.append((len(tokens), hi, lo))
                if len(tokens) and lo not in seen:
                    seen.add(lo)
                    held.append(tokens)
                    waiting += len(tokens)
                    if waiting > FLUSH_TOKENS:
                        counts += _cell_counts(held)
                        held, waiting = [], 0
            n, hi, lo = (pa.array([f[k] for f in facts], pa.int64()) for k in range(3))
            ends = pa.array(np.arange(0, GROUPS * len(facts) + 1, GROUPS), pa.int32())
            vector = pa.ListArray.from_arrays(ends, pa.array(grouped.reshape(-1)))
            columns = [batch.column(0), batch.column(2), n, hi, lo, vector, pa.nulls(len(facts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        counts += _cell_counts(held)
        cells = np.flatnonzero(counts)
        m, none = len(cells), [pa.nulls(len(cells), pa.int64())] * 2
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(m, kind), none[0], pa.array(counts[cells]), *none, pa.nulls(m, vectors), pa.array(cells)],
            names=names,
        )

    source = docs.select(F.col(doc_id), F.col(text), F.xxhash64(F.col(text)))
    return source.mapInArrow(run, f"doc_id {kind}, text_key long, {_SET_FIELDS}, token long")


def _cell(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _cell_counts(held: list[np.ndarray]) -> np.ndarray:
    tokens = np.concatenate([np.zeros(0, np.uint64), *held])
    return np.bincount(_cell(tokens), minlength=1 << CELL_BITS)


def _prefixes(docs: DataFrame, text: str, counts: np.ndarray, hot: float) -> DataFrame:
    """(token, node, hot) of the prefixes, rarest cells first; each class once a task."""
    sketch = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        hashes, seen, often = WordHashes(), set(), sketch.value
        for batch in batches:
            parts = []
            for body in bytes_of(batch.column(0)):
                tokens = shingles(body, hashes)
                if not len(tokens):
                    continue
                node = digest(tokens)[1]
                if node in seen:
                    continue
                seen.add(node)
                held = often[_cell(tokens)]
                first = np.argsort(held, kind="stable")[: prefix_length(len(tokens))]
                parts.append((node, tokens[first], held[first] >= hot))
            if parts:
                sizes = np.array([len(t) for _, t, _ in parts])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([t for _, t, _ in parts]).view(np.int64)),
                        pa.array(np.repeat(np.array([n for n, _, _ in parts], np.int64), sizes)),
                        pa.array(np.concatenate([h for _, _, h in parts])),
                    ],
                    names=["token", "node", "hot"],
                )

    return docs.select(F.col(text)).mapInArrow(run, "token long, node long, hot boolean")


def _filter(wanted: DataFrame) -> np.ndarray:
    """A bitmap of fixed size that holds the hash of every row in ``wanted`` (column row)."""
    spot = F.pmod(F.col("row"), F.lit(FILTER_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (spot % 64).cast("int"))
    cells = wanted.select(F.floor(spot / 64).alias("cell"), bit.alias("bit"))
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for r in cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toLocalIterator():
        bits[r["cell"]] = r["bits"]
    return bits.view(np.uint64)


def _fetched(docs: DataFrame, classes: DataFrame, nodes: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(node, tokens): whole sets of the classes in ``nodes``, each from one document.

    A filter of fixed size picks the documents, so no text is shuffled. It may let others
    through; a set more, or one twice, changes no result.
    """
    wanted = classes.join(nodes, "node", "left_semi").select("row")
    bitmap = docs.sparkSession.sparkContext.broadcast(_filter(wanted))

    def run(batches):
        hashes, bits = WordHashes(), bitmap.value
        for batch in batches:
            spot = batch.column(0).to_numpy() % FILTER_BITS
            passed = (bits[spot >> 6] >> (spot & 63).astype(np.uint64)) & np.uint64(1)
            sets = [shingles(b, hashes) for b in bytes_of(batch.column(1).filter(pa.array(passed > 0)))]
            sets = [t for t in sets if len(t)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([digest(t)[1] for t in sets], pa.int64()),
                    pa.array([t.view(np.int64) for t in sets], pa.list_(pa.int64())),
                ],
                names=["node", "tokens"],
            )

    return docs.select(_row(doc_id, text), F.col(text)).mapInArrow(run, "node long, tokens array<long>")


def _row(doc_id: str, text: str):
    return F.xxhash64(F.col(doc_id), F.xxhash64(F.col(text)))


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("right"))
    shared = F.size(F.array_intersect("left", "right")).cast("long")
    total = (F.size("left") + F.size("right")).cast("long")
    return (
        pairs.join(right, "b").join(left, "a").where(shared * (100 + percent) >= F.lit(percent) * total)
        .select("a", "b").distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable along ``edges`` (a, b).

    In a round every node hears the labels of its neighbours' labels, and passes the lowest on to its own
    label too (FastSV), so whole trees are hooked and rounds grow with the logarithm of a chain's length.
    Labels only sink, and rounds end when none does: then no edge joins two labels. Each round is written
    out, so lineage stays short."""
    both = materialized(edges.union(edges.select("b", "a")).toDF("node", "other").distinct())
    labels = materialized(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")))
    while True:
        far = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        jumped = materialized(labels.join(far, "label").select("node", "label", "far"))
        heard = (
            both.join(jumped.select(F.col("node").alias("other"), "far"), "other")
            .groupBy("node")
            .agg(F.min("far").alias("heard"))
            .join(jumped.select("node", "label"), "node")
        )
        heard = heard.select(F.explode(F.array_distinct(F.array("node", "label"))).alias("node"), "heard")
        lowest = heard.groupBy("node").agg(F.min("heard").alias("heard"))
        stepped = materialized(
            jumped.join(lowest, "node", "left").select("node", "label", F.least("label", "far", "heard").alias("next"))
        )
        labels = stepped.select("node", F.col("next").alias("label"))
        if stepped.where(F.col("next") != F.col("label")).isEmpty():
            return labels


def _bound(a: str, b: str):
    """Summed coordinate minima of two count vectors, an upper bound of the overlap."""
    least = F.zip_with(a, b, lambda p, q: F.least(p, q))
    return F.aggregate(least, F.lit(0).cast("long"), lambda total, v: total + v)


def _stars(buckets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b): each class with the pivots that most of its buckets share, where sizes and bound allow a link.

    A bucket has ``PIVOTS`` of them. Copies of one text that differ from a pivot in too much are mostly
    alike with another, so a group of any size comes together by a few links for each member.
    """
    best = None
    for turn in range(PIVOTS):
        order = F.struct(F.xxhash64("node", F.lit(turn)).alias("first"), F.col("node"))
        pivots = buckets.groupBy("token").agg(F.min(order)["node"].alias("pivot"))
        met = buckets.join(pivots, "token").where("node <> pivot").groupBy("node", "pivot").agg(F.count("*").alias("n"))
        one = met.groupBy("node").agg(F.max_by("pivot", F.struct("n", -F.col("pivot"))).alias("a"))
        best = one if best is None else best.union(one)
    best = best.select(F.greatest("node", "a").alias("node"), F.least("node", "a").alias("a")).distinct()
    b = classes.select("node", F.col("n").alias("n_b"), F.col("vector").alias("vector_b"))
    a = classes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("vector").alias("vector_a"))
    near = best.join(b, "node").join(a, "a").where(
        (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
        & (_bound("vector_a", "vector_b") * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent)
    )
    return near.select("a", F.col("node").alias("b"))


def _survivors(x: dict, y: dict | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of two leaves (or of one) that pass the size filter and both bounds, across components."""
    same, y = y is None, x if y is None else y
    out = [], []
    for i in range(0, len(x["n"]), INNER):
        a = {k: v[i : i + INNER] for k, v in x.items()}
        corner = a["vector"].max(axis=0)
        for j in range(i if same else 0, len(y["n"]), INNER):
            b = {k: v[j : j + INNER] for k, v in y.items()}
            if 100 * min(a["n"].max(), b["n"].max()) < percent * max(a["n"].min(), b["n"].min()):
                continue
            least = least_overlap(int(a["n"].min()), int(b["n"].min()), percent)
            if np.minimum(corner, b["vector"].max(axis=0)).sum() < least:
                continue
            p, q = a["n"][:, None], b["n"][None, :]
            fits = (a["label"][:, None] != b["label"][None, :]) & (100 * np.minimum(p, q) >= percent * np.maximum(p, q))
            if same and i == j:
                fits &= np.arange(len(a["n"]))[:, None] < np.arange(len(b["n"]))[None, :]
            r, s = np.nonzero(fits)
            r, s = _bounded(a, r, b, s, percent)
            out[0].append(r + i)
            out[1].append(s + j)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return join(out[0]), join(out[1])


def _few(points: dict, unit: np.ndarray, few: np.ndarray, percent: int):
    """The pairs of ``_survivors`` inside the units of at most ``FEW`` points, block by block."""
    for gap in range(1, FEW):
        first = np.flatnonzero((unit[gap:] == unit[:-gap]) & few[gap:])
        first = first[points["label"][first] != points["label"][first + gap]]
        for start in range(0, len(first), 1 << 12):
            r = first[start : start + (1 << 12)]
            n, m = points["n"][r], points["n"][r + gap]
            r = r[100 * np.minimum(n, m) >= percent * np.maximum(n, m)]
            yield _bounded(points, r, points, r + gap, percent)


def _bounded(x: dict, r: np.ndarray, y: dict, s: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The row pairs whose count vectors allow a link."""
    bound = np.minimum(x["vector"][r], y["vector"][s]).sum(axis=1)
    keep = bound >= least_overlap(x["n"][r], y["n"][s], percent)
    return r[keep], s[keep]


def rtree_pairs(points: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b, shared), distinct: pairs of ``points`` (token, node, n, label, vector) that share a token, lie in
    different components and pass the bounds, also that of the tokens which their prefixes share:
    ``points`` must hold every prefix token of two components."""

    def named(table: pa.Table) -> pa.Table:
        columns, pairs = _met(table, percent)
        found, held = [np.zeros((0, 5), np.int64)], 0
        for r, s in pairs:
            found.append(_ends(columns, r, s))
            held += len(found[-1])
            if held > HELD_PAIRS:
                found, held = [_counted(found)], 0
        names = ("a", "b", "n_a", "n_b", "shared")
        return pa.table(dict(zip(names, np.ascontiguousarray(_counted(found).T), strict=True)))

    calls = _calls(points, percent)().groupBy("call")
    return _summed(calls.applyInArrow(named, "a long, b long, n_a long, n_b long, shared long"), percent)


def _summed(found: DataFrame, percent: int) -> DataFrame:
    """(a, b, shared) of the pairs that calls named, where the tokens that they share allow a link."""
    found = found.groupBy("a", "b").agg(
        F.min("n_a").alias("n_a"), F.min("n_b").alias("n_b"), F.sum("shared").alias("shared")
    )
    fits = _prefix_bound(percent) * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent
    return found.where(fits).select("a", "b", "shared")


def tree_links(points: DataFrame, fetch, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(pairs, links) of ``points`` as in ``rtree_pairs``: its pairs (a, b, shared), but for those that meet in a
    call of more than ``NAMED`` pairs a point; and links (a, b) that join all components which those would join.

    ``fetch`` gives (node, tokens), the whole sets, for a table of nodes."""
    dealt = _calls(points, percent)

    def met(table: pa.Table) -> pa.Table:
        columns, pairs = _met(table, percent)
        some, most = np.zeros(table.num_rows, bool), NAMED * table.num_rows
        found, held, many = [np.zeros((0, 5), np.int64)], 0, False
        for r, s in pairs:
            some[r] = some[s] = True
            if not many:
                found.append(_ends(columns, r, s))
                held += len(found[-1])
                if held > 2 * most:
                    found = [_counted(found)]
                    held = len(found[0])
                    many = held > most
        rows = _counted(found)
        if many or len(rows) > most:
            nodes = np.unique(columns["node"][some])
            rows = np.zeros((len(nodes), 5), np.int64)
            rows[:, 0], many = nodes, True
        a, b, *rest = np.ascontiguousarray(rows.T)
        call = np.repeat(table["call"].to_numpy()[:1], len(rows))
        b = pa.array(b, mask=np.full(len(rows), many))
        return pa.table(dict(zip(("call", "a", "b", "n_a", "n_b", "shared"), (call, a, b, *rest), strict=True)))

    def joined(left: pa.Table, right: pa.Table) -> pa.Table:
        columns, pairs = _met(left, percent)
        links = _Links(columns, right, percent)
        for r, s in pairs:
            links.hold(r, s)
        return pa.table(dict(zip("ab", links.found(), strict=True)))

    fields = "call long, a long, b long, n_a long, n_b long, shared long"
    told = materialized(dealt().groupBy("call").applyInArrow(met, fields))
    pairs = materialized(_summed(told.where("b IS NOT NULL").drop("call"), percent))
    asked = told.where("b IS NULL").select("call", F.col("a").alias("node"))
    if asked.isEmpty():
        return pairs, told.select("a", "b").limit(0)
    nodes = asked.select("node").distinct()
    sets = asked.join(materialized(fetch(nodes)), "node").select("call", "node", "tokens")
    left = dealt(nodes).join(asked, ["call", "node"], "left_semi")
    links = left.groupBy("call").cogroup(sets.groupBy("call")).applyInArrow(joined, "a long, b long")
    return pairs, materialized(links)


class _Links:
    """The pairs of one call, verified by whole sets; components that a link joins are one from there on."""

    def __init__(self, columns: dict, sets: pa.Table, percent: int):
        self.percent = percent
        nodes, first = np.unique(sets["node"].to_numpy(), return_index=True)
        tokens = sets["tokens"].combine_chunks()
        offsets = tokens.offsets.to_numpy()
        self.tokens = tokens.values.to_numpy().view(np.uint64)
        self.starts, self.sizes = offsets[:-1][first].astype(np.int64), np.diff(offsets)[first].astype(np.int64)
        self.nodes, self.place = nodes, np.searchsorted(nodes, columns["node"])
        self.component = np.zeros(len(nodes), np.int64)
        self.component[self.place] = np.unique(columns["label"], return_inverse=True)[1]
        self.waiting, self.held = [np.zeros(0, np.int64)], 0
        self.links: list[tuple[int, int]] = []

    def hold(self, r: np.ndarray, s: np.ndarray) -> None:
        p, q = self.place[r], self.place[s]
        self.waiting.append(np.minimum(p, q) * len(self.nodes) + np.maximum(p, q))
        self.held += len(r)
        if self.held > HELD_PAIRS:
            self._verify()

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        self._verify()
        ends = self.nodes[np.array(self.links, np.int64).reshape(-1, 2)]
        return ends.min(axis=1, initial=np.iinfo(np.int64).max), ends.max(axis=1, initial=np.iinfo(np.int64).min)

    def _verify(self) -> None:
        pairs = np.unique(np.concatenate(self.waiting))
        self.waiting, self.held = [np.zeros(0, np.int64)], 0
        first, second = pairs // max(len(self.nodes), 1), pairs % max(len(self.nodes), 1)
        for some in np.split(np.arange(len(pairs)), np.flatnonzero(np.diff(first)) + 1):
            if len(some):
                self._try(int(first[some[0]]), second[some])

    def _try(self, one: int, others: np.ndarray) -> None:
        own = self.tokens[self.starts[one] : self.starts[one] + self.sizes[one]]
        while len(others := others[self.component[others] != self.component[one]]):
            taken = max(1, int(np.searchsorted(np.cumsum(self.sizes[others]), LOOKED_TOKENS, "right")))
            now, others = others[:taken], others[taken:]
            sizes = self.sizes[now]
            before = np.cumsum(sizes) - sizes
            met = self.tokens[np.repeat(self.starts[now] - before, sizes) + np.arange(sizes.sum())]
            spot = np.minimum(np.searchsorted(own, met), len(own) - 1)
            shared = np.add.reduceat((own[spot] == met).astype(np.int64), before)
            for other in now[shared * (100 + self.percent) >= self.percent * (sizes + len(own))].tolist():
                if self.component[other] != self.component[one]:
                    self.component[self.component == self.component[other]] = self.component[one]
                    self.links.append((one, other))


def _calls(points: DataFrame, percent: int):
    """A function that deals ``points``, or those of some nodes, to calls and units: any two points that share
    a token meet in a unit of one call.

    A bucket of more than ``LEAF`` points is cut into leaves of about so many by size and by hash of the
    node, so leaves of buckets alike are alike."""
    points, mark = materialized(points), ordered_hash(F.col("node"))
    weight = F.sum(F.ceil(F.col("n") / POINT_TOKENS)).alias("points")
    amount = points.groupBy("token").agg(weight, F.min(mark).alias("key"))
    amount = materialized(amount)
    small = amount.where(F.col("points") <= LEAF)
    small = materialized(_dealt(small, ["token"]))

    many = _by_size(points.join(amount.where(F.col("points") > LEAF).select("token"), "token", "left_semi"))
    cells = many.groupBy("token", "cell").agg(weight)
    leaf = F.col("cell") * (1 << 32) + F.floor(mark / F.lit(float(1 << 62)) * F.col("leaves"))
    leaves = cells.withColumn("leaves", F.pow(F.lit(2), F.ceil(F.log2(F.col("points") / LEAF))))
    leaves = many.join(leaves.drop("points"), ["token", "cell"]).withColumn("leaf", leaf.cast("long"))
    leaves = materialized(leaves.drop("cell", "leaves"))
    corners = leaves.groupBy("token", "leaf").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), weight, F.min(mark).alias("key"),
        F.array(*[F.max(F.col("vector")[k]) for k in range(GROUPS)]).alias("corner"),
    )
    corners = materialized(corners)
    kinds = ("leaf", "low", "high", "corner", "points", "key")
    first, second = (corners.select("token", *[F.col(c).alias(f"{c}_{k}") for c in kinds]) for k in "ab")
    fits = (
        (F.col("leaf_a") <= F.col("leaf_b"))
        & (F.least("high_a", "high_b") * 100 >= F.greatest("low_a", "low_b") * percent)
        & (_bound("corner_a", "corner_b") * (100 + percent) >= (F.col("low_a") + F.col("low_b")) * percent)
    )
    pairs = first.join(second, "token").where(fits).select(
        "token", "leaf_a", "leaf_b", F.xxhash64("key_a", "key_b").alias("key"),
        (F.col("points_a") + F.col("points_b")).alias("points"),
    )
    pairs = materialized(_dealt(materialized(pairs), ["token", "leaf_a", "leaf_b"]))
    unit = F.xxhash64("token", "leaf_a", "leaf_b").alias("unit")
    sides = pairs.select("token", "call", unit, F.explode(F.array_distinct(F.array("leaf_a", "leaf_b"))).alias("leaf"))

    # One leaf, or one pair of leaves, is a unit; units of one key are of nearly the same classes.
    fields = ["call", "unit", "token", "leaf", "node", "n", "label", "vector"]

    def dealt(nodes: DataFrame | None = None) -> DataFrame:
        some = [rows if nodes is None else rows.join(nodes, "node", "left_semi") for rows in (points, leaves)]
        whole = some[0].join(small, "token").withColumns({c: F.lit(0).cast("long") for c in ("unit", "leaf")})
        across = sides.join(some[1], ["token", "leaf"])
        return whole.select(fields).unionByName(across.select(fields))

    return dealt


def _met(table: pa.Table, percent: int):
    """The columns of a call's points in the order of their units, and the row pairs that pass all bounds."""
    columns = _columns(table.sort_by([(c, "ascending") for c in ("unit", "token", "leaf", "n")]))
    edge = (np.diff(columns["unit"], prepend=0) != 0) | (np.diff(columns["token"], prepend=0) != 0)
    edge[:1] = True
    ends = np.append(np.flatnonzero(edge), table.num_rows)
    leaf = columns["leaf"]
    columns = {c: columns[c] for c in ("label", "node", "n", "vector")}

    def pairs():
        few = (np.diff(ends) <= FEW) & (leaf[ends[:-1]] == leaf[ends[1:] - 1])
        yield from _few(columns, np.repeat(np.arange(len(few)), np.diff(ends)), np.repeat(few, np.diff(ends)), percent)
        for start, end in zip(ends[:-1][~few], ends[1:][~few], strict=True):
            one = {c: v[start:end] for c, v in columns.items()}
            if one["label"].min() == one["label"].max():
                continue
            cut, x, y = 0, one, None
            if leaf[start] != leaf[end - 1]:
                cut = int(np.searchsorted(leaf[start:end], leaf[end - 1]))
                x, y = ({c: v[k] for c, v in one.items()} for k in (slice(0, cut), slice(cut, None)))
            r, s = _survivors(x, y, percent)
            yield r + start, s + start + cut

    return columns, pairs()


def _dealt(units: DataFrame, names: list[str]) -> DataFrame:
    """``names`` of the units (with key and points) and their call: units of one key share it until it holds
    ``CALL_POINTS`` points; keys of few points share calls."""
    heavy = units.groupBy("key").agg(F.sum("points").alias("all"))
    total = heavy.agg(F.sum("all")).first()[0] or 0
    calls = max(64, 2 * total // CALL_POINTS)
    piece = F.pmod(F.xxhash64(*names), F.ceil(F.col("all") / CALL_POINTS))
    call = F.when(F.col("all") <= CALL_POINTS // 4, F.pmod(F.xxhash64("key"), F.lit(calls)))
    return units.join(heavy, "key").select(*names, call.otherwise(F.xxhash64("key", piece)).alias("call"))


def _prefix_bound(percent: int):
    """Upper bound of the overlap of sets of n_a and n_b whose prefixes share ``shared`` tokens.

    Up to the end of the prefix that ends first, everything that the sets share is in both
    prefixes; behind it that set holds its size less its prefix, and the other at most its size
    less what it shared before. Which prefix ends first is not known here, so both cases count.
    """
    behind = {c: F.floor(F.col(c) * percent / 100 + F.lit(1 - 1e-9)) - 1 for c in ("n_a", "n_b")}
    first = F.least(behind["n_a"], F.col("n_b") - F.col("shared"))
    second = F.least(F.col("n_a") - F.col("shared"), behind["n_b"])
    return F.col("shared") + F.greatest(first, second)


def _ends(points: dict, r: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Rows (a, b, n_a, n_b, 1) of the pairs, the smaller node first; a node never meets itself."""
    ones, node, n = np.ones(len(r), np.int64), points["node"], points["n"]
    rows = np.stack([node[r], node[s], n[r], n[s], ones], axis=1).astype(np.int64)
    swap = rows[:, 0] > rows[:, 1]
    rows[swap] = rows[swap][:, [1, 0, 3, 2, 4]]
    return rows[rows[:, 0] < rows[:, 1]]


def _counted(found: list[np.ndarray]) -> np.ndarray:
    """Each pair once, with the sum of its last column."""
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    starts = np.flatnonzero((np.diff(rows[:, :2], axis=0, prepend=rows[:1, :2]) != 0).any(axis=1))
    starts = np.concatenate([np.zeros(min(1, len(rows)), np.int64), starts])
    out = rows[starts]
    if len(rows):
        out[:, 4] = np.add.reduceat(rows[:, 4], starts)
    return out


def _columns(table: pa.Table) -> dict[str, np.ndarray]:
    out = {c: table[c].to_numpy() for c in table.column_names if c != "vector"}
    return out | {"vector": table["vector"].combine_chunks().flatten().to_numpy().reshape(-1, GROUPS)}


def _by_size(points: DataFrame) -> DataFrame:
    """Points with ``cell``, the number of times 1.25 fits into the size: leaves then hold alike sizes."""
    return points.withColumn("cell", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25))).cast("long"))


def linked(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, labels): the documents with their classes, the classes with a document of each,
    and the component label of every class that is linked with another."""
    facts = materialized(_sets(docs, doc_id, text))
    rows = facts.where("token IS NULL").select("doc_id", "text_key", "n", F.col("lo").alias("node"), "vector")
    filled = rows.where("n > 0")
    classes = materialized(
        filled.groupBy("node").agg(
            F.min("n").alias("n"), F.min("doc_id").alias("first"), F.min("vector").alias("vector"),
            F.min_by(F.xxhash64("doc_id", "text_key"), F.struct("doc_id", "text_key")).alias("row"),
        )
    )
    sketch = facts.where("token IS NOT NULL").groupBy("token").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << CELL_BITS, np.int64)
    counts[sketch["token"].to_numpy()] = sketch["n"].to_numpy()
    hot = max(2, classes.count() / HOT_SHARE, 2 * counts.mean())
    prefixes = _prefixes(docs, text, counts, hot).withColumn(
        "salt", F.when(F.col("hot"), F.pmod(F.xxhash64("node"), F.lit(256))).otherwise(0)
    )
    together = Window.partitionBy("token", "salt")
    buckets = prefixes.withColumns({"low": F.min("node").over(together), "high": F.max("node").over(together)})
    buckets = materialized(buckets.where(F.col("hot") | (F.col("low") < F.col("high"))).select("token", "node"))

    stars = materialized(_stars(buckets, classes, percent))
    ends = stars.select(F.col("a").alias("node")).union(stars.select("b")).distinct()
    edges = materialized(verified(stars, materialized(_fetched(docs, classes, ends, doc_id, text)), percent))
    labels = components(edges)

    labelled = left_by(buckets, labels, ["node"]).withColumn("label", F.coalesce("label", "node"))
    labelled = materialized(labelled.distinct())
    open_tokens = labelled.groupBy("token").agg(F.min("label").alias("p"), F.max("label").alias("q")).where("p < q")
    points = labelled.join(open_tokens.select("token"), "token", "left_semi").join(
        classes.select("node", "n", "vector"), "node"
    )
    pairs, links = tree_links(points, lambda nodes: _fetched(docs, classes, nodes, doc_id, text), percent)
    if not links.isEmpty():
        edges = materialized(edges.unionByName(links))
        labels = components(edges)
        pairs = materialized(_apart(pairs, labels))
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = materialized(_fetched(docs, classes, ends, doc_id, text))
    return rows, classes, _settled(pairs, sets, edges, labels, percent)


def _settled(pairs: DataFrame, sets: DataFrame, edges: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Labels after every link among ``pairs`` (a, b, shared) counts; ``edges`` and their ``labels`` come before.

    A round verifies the best pair of each class and drops the pairs that its links put inside one
    component. It is worth its jobs as long as it settles half of the pairs; then all others follow.
    """
    left = pairs.count()
    while left:
        ends = pairs.withColumn("node", F.explode(F.array("a", "b")))
        best = ends.groupBy("node").agg(F.max_by(F.struct("a", "b"), F.struct("shared", F.xxhash64("a", "b"))).alias("pair"))
        tried = materialized(best.select("pair.*").distinct())
        found = materialized(verified(tried, sets, percent))
        if not found.isEmpty():
            edges = materialized(edges.unionByName(found))
            labels = components(edges)
        pairs, before = materialized(_apart(pairs.join(tried, ["a", "b"], "left_anti"), labels)), left
        left = pairs.count()
        if 2 * left > before:
            break
    if not left:
        return labels
    more = materialized(verified(pairs, sets, percent))
    return labels if more.isEmpty() else components(edges.unionByName(more))


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs between two components."""
    for end in "ab":
        of = labels.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}"))
        pairs = pairs.join(of, end, "left").withColumn(f"label_{end}", F.coalesce(f"label_{end}", end))
    return pairs.where("label_a <> label_b").drop("label_a", "label_b")


def component_ids(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, component) of every document; ``text_key`` is xxhash64 of
    the text, ``component`` the label of its component, NULL without shingles."""
    rows, classes, labels = linked(docs, doc_id, text, percent)
    labelled = classes.select("node", "first").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node")
    )
    smallest = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    whole = labelled.join(smallest, "label").select("node", "component_id", F.col("label").alias("component"))
    joined = rows.withColumn("node", F.when(F.col("n") > 0, F.col("node"))).join(whole, "node", "left")
    return joined.select(
        "doc_id",
        "text_key",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "component",
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One document of each component, the one of the smallest identifier, and all without shingles."""
    found = materialized(component_ids(docs, doc_id, text, percent))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_key"))
    chosen = found.where("component IS NOT NULL").groupBy("component").agg(
        F.min_by(F.struct("doc_id", "text_key"), order).alias("row")
    )
    without = found.where("component IS NULL").select("doc_id", "text_key").distinct()
    key, one, copy = fresh(docs, "text_key", "one_of_many", "copy")
    kept = chosen.select("row.*", F.lit(True).alias(one)).unionByName(without.withColumn(one, F.lit(False)))
    kept = kept.withColumnsRenamed({"doc_id": doc_id, "text_key": key})
    joined = left_by(docs.withColumn(key, F.xxhash64(F.col(text))), kept, [doc_id, key]).where(F.col(one).isNotNull())
    repeated = F.row_number().over(Window.partitionBy(doc_id, key).orderBy(one))
    return joined.withColumn(copy, repeated).where(~F.col(one) | (F.col(copy) == 1)).drop(key, one, copy)
