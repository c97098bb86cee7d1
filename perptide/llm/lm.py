"""Language-model scores by deleted interpolation.

The model predicts each token, and the end of each text, from the word before it. It mixes
maximum-likelihood estimates of the pair, of the single word and the uniform one; the mixture
weights depend on how often the context was seen (powers of two), and expectation-
maximisation learns them on counts of training documents that were left out of the estimates
(one of ``DELETED``). The estimates used for scoring are then taken over all training documents.

Words are counted exactly over the whole corpus, and each of them is a class of its own in pairs;
all words not seen in training are one more class. The most frequent ``WORDS`` are numbered and
broadcast: they are a cache, and no result depends on its size. A pair of two numbered words is
named by their numbers, any other (an open pair) by a 64-bit hash of its two word hashes; two open
pairs with one name would be taken for one (chance n^2 / 2^65).

``most`` asks for a coarser model instead: at most so many words are classes, every other one, seen
or not, is predicted as the rare class and then within it by its own exact count. Both models are
proper distributions.

1. Unigrams: per-batch counts by word hash, summed by Spark. 2. Pairs: per-batch counts, dealt by
a hash of the pair into parts of about ``PART_TOKENS`` tokens, summed part by part. 3. Statistics
of the left-out pairs on a fixed grid, and the pairs that hold 1 / ``HOT_PAIRS`` of all tokens or
more. Open pairs of all documents are counted by their hashes and joined with the counts of
their words. 4. Scoring: documents send what they need from each part, as packed arrays, and meet
the part's counts there; partial sums return to the batch of documents they came from. Hot pairs,
and everything about frequent words, are scored where the document is, so no part is flooded.

Broadcast are the frequent words (at most ``WORDS``), the hot pairs (at most ``HOT_PAIRS``) and the
weights. The driver gets these, the grid, and counts of counts.

Defined results
* NULL text counts as empty: its end alone. Rows without an identifier are scored, never learned
  from, and not held out. Repeated rows are counted and scored each.
* Without training tokens every estimate is uniform. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perptide.llm.common import WordHashes, bytes_of, fold, lowered_words, materialized, mixed

WORDS = 1 << 19
DELETED = 10
PART_TOKENS = 1 << 21
HOT_PAIRS = 1 << 16
BUCKETS = 64
#: Cells of the grid an octave of an estimate.
CELLS = 4
EM_ROUNDS = 100

#: Texts of about so many bytes are worked on at once; so many words are objects at a time, so many scores are made.
TEXT_BYTES = 1 << 23
SPLIT_WORDS = 1 << 15
LOGS = 1 << 16
#: The end of a text as a token; no word holds white space.
END = b" "
END_HASH = xxhash.xxh64_intdigest(END)
#: The start of a text as a context.
START_HASH = xxhash.xxh64_intdigest(b"\n")
_U = np.uint64


def pack(values: np.ndarray) -> bytes:
    """Unsigned numbers in as many bytes each as the largest needs."""
    values = np.ascontiguousarray(values, "<u8")
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(body: bytes) -> np.ndarray:
    width = body[0]
    cells = np.frombuffer(body, np.uint8, offset=1).reshape(-1, width)
    out = np.zeros((len(cells), 8), np.uint8)
    out[:, :width] = cells
    return out.reshape(-1).view("<u8")


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=_U(0)))


def unpack_sorted(body: bytes) -> np.ndarray:
    return np.cumsum(unpack(body), dtype=np.uint64)


@dataclass
class Words:
    """The frequent words by hash, with counts of the estimating part (``main``) and of all training
    documents; entries past them are the rare class and, as a context only, the start. ``open``: the
    words of the rare class are classes of their own, and their pairs are kept by hash."""

    hashes: np.ndarray
    main: np.ndarray
    total: np.ndarray
    rare_total: int
    rare_kinds: int
    open: bool = False

    @property
    def classes(self) -> int:
        """Classes that a word may have, that of unseen words (or the rare class) included."""
        return len(self.hashes) + 1 + (self.rare_kinds if self.open else 0)

    @property
    def rare(self) -> int:
        return len(self.hashes)

    @property
    def start(self) -> int:
        return len(self.hashes) + 1

    @property
    def base(self) -> int:
        """Pairs are numbered context * base + word."""
        return len(self.hashes) + 2

    def classes_of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(hashes), self.rare)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, self.rare)


class _Ids(dict):
    """Place of each word in this task's arrays of hashes and classes; a bounded number is remembered."""

    def __init__(self, words: Words, most: int = 1 << 18):
        super().__init__()
        self.words, self.most = words, most
        self._forget()

    def _forget(self) -> None:
        self.clear()
        self.late: list[int] = []
        self.hashes, self.classes = np.zeros(0, _U), np.zeros(0, np.int32)

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        self.late.append(xxhash.xxh64_intdigest(word))
        return value

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and classes of the words."""
        if len(self) > self.most:
            self._forget()
        places = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.late:
            late = np.array(self.late, _U)
            self.hashes = np.concatenate([self.hashes, late])
            self.classes = np.concatenate([self.classes, self.words.classes_of(late).astype(np.int32)])
            self.late = []
        return self.hashes[places], self.classes[places]


@dataclass
class Tokens:
    """The tokens of some texts one after the other, each text closed by its end, and what stands before each."""

    words: Words
    text: np.ndarray
    sizes: np.ndarray
    hashes: np.ndarray
    classes: np.ndarray
    class_before: np.ndarray

    @staticmethod
    def of(texts: list[bytes | None], ids: _Ids) -> Tokens:
        split, sizes = [], np.zeros(len(texts), np.int64)
        hashes, classes = [np.zeros(0, _U)], [np.zeros(0, np.int32)]
        for i, text in enumerate(texts):
            found = lowered_words(text)
            split += found
            split.append(END)
            sizes[i] = len(found) + 1
            if len(split) >= SPLIT_WORDS or i == len(texts) - 1:
                for held, new in zip((hashes, classes), ids.of(split), strict=True):
                    held.append(new)
                split = []
        hashes, classes = np.concatenate(hashes), np.concatenate(classes)
        class_before = np.roll(classes, 1)
        class_before[np.cumsum(sizes) - sizes] = ids.words.start
        text = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        return Tokens(ids.words, text, sizes, hashes, classes, class_before)

    def hash_before(self, at: np.ndarray) -> np.ndarray:
        """Hashes of what stands before the tokens at the places ``at``."""
        return np.where(self.class_before[at] == self.words.start, _U(START_HASH), self.hashes[at - 1])

    @property
    def bare(self) -> np.ndarray:
        """Whether a token's word has no number, and whether the one before it has none."""
        return np.stack([self.classes == self.words.rare, self.class_before == self.words.rare])

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs by number, and the text of each; open pairs are left out where they have names."""
        text, before, classes = self.text, self.class_before, self.classes
        if self.words.open:
            numbered = ~self.bare.any(axis=0)
            text, before, classes = text[numbered], before[numbered], classes[numbered]
        return before.astype(_U) * _U(self.words.base) + classes.astype(_U), text

    def open_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Names of the open pairs, and the places of their tokens."""
        at = np.flatnonzero(self.bare.any(axis=0))
        return mixed(mixed(self.hash_before(at)) * _U(0x9E3779B97F4A7C15) + self.hashes[at]), at


def _groups(batch: pa.RecordBatch, column: int, rows: int = 4096):
    """Slices of a batch of at most ``rows`` rows and, but for a longer text, ``TEXT_BYTES``, with their texts."""
    texts = bytes_of(batch.column(column))
    start, taken = 0, 0
    for i, text in enumerate(texts):
        size = len(text or b"")
        if i > start and (taken + size > TEXT_BYTES or i - start == rows):
            yield batch.slice(start, i - start), texts[start:i]
            start, taken = i, 0
        taken += size
    if texts:
        yield batch.slice(start), texts[start:]


def _summed(place: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Sums of the weights by place; bincount alone gives whole numbers where nothing is summed."""
    return np.bincount(place, weights, n).astype(np.float64)


def bucket(count: np.ndarray) -> np.ndarray:
    """Context-frequency bucket: 0 for none, then one for each power of two."""
    return np.frexp(np.asarray(count, np.float64))[1].clip(0, BUCKETS - 1)


def parts_of(docs: DataFrame, doc_id: str, text: str, held_out: Column) -> DataFrame:
    """(doc_id, text, role): 0 held out, 1 estimating, 2 left out of the estimates to learn weights,
    3 without an identifier."""
    left_out = F.pmod(F.xxhash64(F.col(doc_id).cast("string")), F.lit(DELETED)) == 0
    role = F.when(F.col(doc_id).isNull(), 3).when(held_out, 0).when(left_out, 2).otherwise(1)
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), role.cast("int").alias("role"))


def unigrams(rows: DataFrame) -> DataFrame:
    """(hash, main, held) of every training token, the end included."""

    def run(batches):
        hashes = WordHashes()
        end = np.array([END_HASH], _U)
        for batch in batches:
            role = batch.column(1).to_numpy()
            texts = bytes_of(batch.column(0))
            for which, names in ((1, ("main", "held")), (2, ("held", "main"))):
                found = [hashes.of(lowered_words(t)) for t, r in zip(texts, role, strict=True) if r == which]
                if found:
                    values, n = np.unique(np.concatenate([*found, np.repeat(end, len(found))]), return_counts=True)
                    columns = {"hash": pa.array(values.view(np.int64)), names[0]: pa.array(n.astype(np.int64))}
                    columns[names[1]] = pa.array(np.zeros(len(n), np.int64))
                    order = ["hash", "main", "held"]
                    yield pa.RecordBatch.from_arrays([columns[c] for c in order], names=order)

    counted = rows.where("role IN (1, 2)").select("text", "role").mapInArrow(run, "hash long, main long, held long")
    return counted.groupBy("hash").agg(F.sum("main").alias("main"), F.sum("held").alias("held"))


def frequent(counts: DataFrame, most: int = WORDS) -> tuple[Words, int]:
    """The frequent words, and the least count of one. At most ``most`` words: of a count that would
    lead beyond, none is taken."""
    histogram = counts.groupBy((F.col("main") + F.col("held")).alias("c")).agg(F.count("*").alias("n")).collect()
    taken, least = 0, None
    for c, n in sorted(((r["c"], r["n"]) for r in histogram), reverse=True):
        if taken + n > most:
            break
        taken, least = taken + n, c
    least = least if least is not None else 1 << 62
    total = sum(r["c"] * r["n"] for r in histogram)
    table = counts.where(F.col("main") + F.col("held") >= least).toArrow()
    order = np.argsort(table["hash"].to_numpy().view(np.uint64))
    main = table["main"].to_numpy()[order].astype(np.float64)
    every = main + table["held"].to_numpy()[order]
    words = Words(
        table["hash"].to_numpy().view(np.uint64)[order], main, every,
        int(total - every.sum()), sum(r["n"] for r in histogram) - taken,
    )
    return words, int(least)


def contexts(words: Words, counts: DataFrame, rows: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of every class and of the start, in the estimating part and in all training documents."""
    rare = counts.where(F.col("main") + F.col("held") < least).agg(F.sum("main").alias("m"), F.sum("held").alias("h"))
    rare = rare.collect()[0]
    texts = {r["role"]: r["n"] for r in rows.groupBy("role").agg(F.count("*").alias("n")).collect()}
    main, held = rare["m"] or 0, rare["h"] or 0
    starts = texts.get(1, 0), texts.get(2, 0)
    return (
        np.concatenate([words.main, [main, starts[0]]]),
        np.concatenate([words.total, [main + held, sum(starts)]]),
    )


def _part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(keys) % _U(parts)).astype(np.int64)


def _dealt(part: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by part (and as before within one), and the parts in that order."""
    order = np.argsort(part.astype(np.min_scalar_type(parts)), kind="stable")
    return order, part[order]


def _cuts(dealt: np.ndarray, some: np.ndarray) -> list[slice]:
    """Where each of the parts ``some`` stands in ``dealt``."""
    return [slice(a, b) for a, b in zip(
        np.searchsorted(dealt, some).tolist(), np.searchsorted(dealt, some, "right").tolist(), strict=True
    )]


def pair_counts(rows: DataFrame, words, parts: int) -> DataFrame:
    """(part, keys, main, held): the pairs of each part, sorted, with their counts, packed."""

    def gather(batches):
        ids = _Ids(words.value)
        for batch in batches:
            for rows, texts in _groups(batch, 0):
                keys, text = Tokens.of(texts, ids).pairs()
                held = rows.column(1).to_numpy()[text] == 2
                values, n = np.unique(keys * _U(2) + held.astype(_U), return_counts=True)
                order, dealt = _dealt(_part_of(values >> _U(1), parts), parts)
                values, n, some = values[order], n[order], np.unique(dealt)
                cuts = _cuts(dealt, some)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some, pa.int32()),
                        pa.array([pack_sorted(values[c]) for c in cuts], pa.binary()),
                        pa.array([pack(n[c]) for c in cuts], pa.binary()),
                    ],
                    names=["part", "keys", "counts"],
                )

    def add(table: pa.Table) -> pa.Table:
        keys = np.concatenate([unpack_sorted(b) for b in table["keys"].to_pylist()])
        counts = np.concatenate([unpack(b) for b in table["counts"].to_pylist()])
        values, place = np.unique(keys >> _U(1), return_inverse=True)
        held = (keys & _U(1)).astype(np.float64)
        sums = [np.bincount(place, counts * w, len(values)).astype(np.uint64) for w in (1 - held, held)]
        return pa.table(
            {
                "part": pa.array([table["part"][0].as_py()], pa.int32()),
                "keys": [pack_sorted(values)], "main": [pack(sums[0])], "held": [pack(sums[1])],
            }
        )

    dealt = rows.where("role IN (1, 2)").select("text", "role").mapInArrow(gather, "part int, keys binary, counts binary")
    return dealt.groupBy("part").applyInArrow(add, "part int, keys binary, main binary, held binary")


def open_pairs(rows: DataFrame, counts: DataFrame, words, known, least: int) -> DataFrame:
    """(pair, main, held, before_main, before_total, word_main, word_total, word_open) of the open pairs of
    all documents, with the counts of their words. A pair that no training document holds counts 0."""

    def gather(batches):
        ids = _Ids(words.value)
        for batch in batches:
            for rows, texts in _groups(batch, 0):
                tokens = Tokens.of(texts, ids)
                pair, at = tokens.open_pairs()
                values, first, place = np.unique(pair, return_index=True, return_inverse=True)
                role = rows.column(1).to_numpy()[tokens.text[at]]
                main, held = (np.bincount(place, role == r, len(values)).astype(np.int64) for r in (1, 2))
                at = at[first]
                word_open, before_open = tokens.bare[:, at]
                yield pa.RecordBatch.from_pydict({
                    "pair": values.view(np.int64),
                    "before": np.where(before_open, tokens.hash_before(at).view(np.int64), tokens.class_before[at]),
                    "before_open": before_open,
                    "word": np.where(word_open, tokens.hashes[at].view(np.int64), tokens.classes[at]),
                    "word_open": word_open, "main": main, "held": held,
                })

    fields = "pair long, before long, before_open boolean, word long, word_open boolean, main long, held long"
    found = rows.select("text", "role").mapInArrow(gather, fields)
    found = found.groupBy("pair", "before", "before_open", "word", "word_open").agg(
        F.sum("main").alias("main"), F.sum("held").alias("held")
    )
    bare = counts.where(F.col("main") + F.col("held") < least)
    for side in ("before", "word"):
        of = bare.select(
            F.col("hash").alias(f"{side}_hash"), F.col("main").alias(f"{side}_main"),
            (F.col("main") + F.col("held")).alias(f"{side}_total"),
        )
        # Numbered words find nothing here; the name of the pair spreads them over all tasks.
        key = F.when(F.col(f"{side}_open"), F.col(side)).otherwise(F.col("pair"))
        found = found.join(of, (key == F.col(f"{side}_hash")) & F.col(f"{side}_open"), "left").drop(f"{side}_hash")

    def fill(batches):
        own, (main, total) = words.value, known.value
        for batch in batches:
            columns = {c: batch.column(c) for c in ("pair", "main", "held")}
            for side in ("before", "word"):
                bare = batch.column(f"{side}_open").to_numpy(zero_copy_only=False)
                number = np.where(bare, own.rare, batch.column(side).to_numpy())
                for which, numbered in (("main", main), ("total", total)):
                    counted = batch.column(f"{side}_{which}").fill_null(0).to_numpy()
                    columns[f"{side}_{which}"] = np.where(bare, counted, numbered[number]).astype(np.int64)
            yield pa.RecordBatch.from_pydict(columns | {"word_open": batch.column("word_open")})

    return found.mapInArrow(
        fill,
        "pair long, main long, held long, before_main long, before_total long, word_main long, word_total long, "
        "word_open boolean",
    )


def _grid(before: np.ndarray, word: np.ndarray, m: np.ndarray, weight: np.ndarray, tokens: float) -> list[np.ndarray]:
    """Cells of left-out pairs, and sums in each; ``before`` and ``word`` are counts of the estimating part."""
    pair, single = m / np.maximum(before, 1), word / tokens
    cell = (bucket(before) * 512 + _octave(pair)) * 512 + _octave(single)
    cells, place = np.unique(cell, return_inverse=True)
    return [cells, *(_summed(place, w, len(cells)) for w in (weight, weight * pair, weight * single))]


def statistics(pairs: DataFrame, words, known, hot_from: int, opened: DataFrame | None = None) -> DataFrame:
    """(cell, weight, pair, single): left-out counts by context bucket and quantised estimates, with the
    weighted sums of the estimates; and for each hot pair a row of cell -1 - key with its count."""

    def run(batches):
        own, (main, _) = words.value, known.value
        tokens = max(1.0, main[: own.rare + 1].sum())
        for batch in batches:
            for k, m, h in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                keys, m, h = unpack_sorted(k), unpack(m).astype(np.float64), unpack(h).astype(np.float64)
                hot = m + h >= hot_from
                hot_counts = (m + h)[hot]
                context, word = (keys // _U(own.base)).astype(np.int64), (keys % _U(own.base)).astype(np.int64)
                some = h > 0
                context, word, m, weight = context[some], word[some], m[some], h[some]
                cells, *sums = _grid(main[context], main[word], m, weight, tokens)
                zeros = np.zeros(int(hot.sum()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([cells, -1 - keys[hot].astype(np.int64)])),
                        pa.array(np.concatenate([sums[0], hot_counts])),
                        pa.array(np.concatenate([sums[1], zeros])),
                        pa.array(np.concatenate([sums[2], zeros])),
                    ],
                    names=["cell", "weight", "pair", "single"],
                )

    def run_open(batches):
        own, (main, _) = words.value, known.value
        tokens = max(1.0, main[: own.rare + 1].sum())
        for batch in batches:
            before, word, m, weight = (c.to_numpy().astype(np.float64) for c in batch.columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in _grid(before, word, m, weight, tokens)], names=["cell", "weight", "pair", "single"]
            )

    fields = "cell long, weight double, pair double, single double"
    found = pairs.select("keys", "main", "held").mapInArrow(run, fields)
    if opened is not None:
        left_out = opened.where("held > 0").select("before_main", "word_main", "main", "held")
        found = found.unionByName(left_out.mapInArrow(run_open, fields))
    return found.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("weight", "pair", "single")])


def _octave(p: np.ndarray) -> np.ndarray:
    """0 for 0, else a step for each quarter octave below 1."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.clip(1 + np.floor(-CELLS * np.log2(np.where(p > 0, p, 1))), 1, 511), 0).astype(np.int64)


def mixture(grid: list, kinds: int, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Weights (bucket, [uniform, single, pair]) by expectation-maximisation over the grid's cells.

    Every bucket starts even; an empty one keeps the weights that all buckets together learn."""
    cells = np.array([r["cell"] for r in grid], np.int64)
    weight = np.array([r["weight"] for r in grid])
    estimates = np.stack(
        [np.full(len(grid), 1.0 / kinds), np.array([r["single"] for r in grid]) / np.maximum(weight, 1e-300),
         np.array([r["pair"] for r in grid]) / np.maximum(weight, 1e-300)], axis=1,
    ) if len(grid) else np.zeros((0, 3))

    def learn(rows: np.ndarray) -> np.ndarray:
        mix = np.full(3, 1 / 3)
        for _ in range(rounds):
            joint = estimates[rows] * mix
            share = joint / joint.sum(axis=1, keepdims=True)
            mix = (share * weight[rows, None]).sum(axis=0) / weight[rows].sum()
        # Neither estimate covers everything, so the uniform one keeps a share.
        mix = np.maximum(mix, [1e-6, 0, 0])
        return mix / mix.sum()

    whole = learn(np.arange(len(grid))) if len(grid) else np.full(3, 1 / 3)
    own = cells // (512 * 512)
    return np.stack([learn(np.flatnonzero(own == b)) if (own == b).any() else whole for b in range(BUCKETS)])


@dataclass
class Scorer:
    """What every task knows: class counts, weights, hot pairs."""

    words: Words
    total: np.ndarray
    mix: np.ndarray
    hot_keys: np.ndarray
    hot_counts: np.ndarray
    tokens: int
    kinds: int

    def logs(self, keys: np.ndarray, count: np.ndarray) -> np.ndarray:
        """log10 of the mixture for pairs seen ``count`` times."""
        base = self.words.base
        context, word = (keys // _U(base)).astype(np.int64), (keys % _U(base)).astype(np.int64)
        return self.log_of(self.total[context], self.total[word], count)

    def log_of(self, seen: np.ndarray, word: np.ndarray, count: np.ndarray) -> np.ndarray:
        """log10 of the mixture for contexts seen ``seen`` times, words seen ``word`` times, pairs ``count`` times."""
        out = np.zeros(len(word))
        for start in range(0, len(word), LOGS):
            some = slice(start, start + LOGS)
            mix = self.mix[bucket(seen[some])]
            single = word[some] / self.tokens if self.tokens else np.zeros(len(word[some]))
            pair = mix[:, 2] * count[some] / np.maximum(seen[some], 1)
            out[some] = np.log10(mix[:, 0] / self.words.classes + mix[:, 1] * single + pair)
        return out

    def base_log(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.kinds + 1)))

    def rare_log(self, count: np.ndarray) -> np.ndarray:
        """log10 of a rare word within its class."""
        return np.log10((count + 0.5) / (self.words.rare_total + 0.5 * (self.words.rare_kinds + 1)))


_ASK = (
    "part int, block long, keys binary, docs binary, times binary, rare binary, rare_docs binary, "
    "open binary, open_docs binary"
)
_SUMS = "block long, docs binary, known binary, base binary, score binary"


def _asked(rows: DataFrame, scorer, parts: int) -> tuple[DataFrame, str]:
    """What each batch of documents knows by itself, and what it asks of each part."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        own: Scorer = scorer.value
        words, task, number = own.words, TaskContext.get().partitionId(), 0
        ids = _Ids(words)
        for whole in batches:
            for batch, texts in _groups(whole, 1):
                block, number = (task << 24) + number, number + 1
                tokens = Tokens.of(texts, ids)
                sizes, doc = tokens.sizes, tokens.text
                keys, key_doc = tokens.pairs()
                plain = tokens.classes < words.rare
                base = _summed(doc[plain], own.base_log(own.total[tokens.classes[plain]]), len(sizes))
                known = np.bincount(doc[plain], minlength=len(sizes))
                late = np.flatnonzero(~plain) if not words.open else np.zeros(0, np.int64)
                rare, rare_doc = tokens.hashes[late], doc[late]
                opened, open_at = tokens.open_pairs() if words.open else (np.zeros(0, _U), np.zeros(0, np.int64))
                open_doc = doc[open_at]
                spot = np.minimum(np.searchsorted(own.hot_keys, keys), max(len(own.hot_keys) - 1, 0))
                hot = own.hot_keys[spot] == keys if len(own.hot_keys) else np.zeros(len(keys), bool)
                score = _summed(key_doc[hot], own.logs(keys[hot], own.hot_counts[spot[hot]]), len(sizes))
                # A pair and a document as one number: a group holds at most 4096 documents.
                both, times = np.unique(np.stack([keys[~hot], key_doc[~hot].astype(_U)]), axis=1, return_counts=True) if (
                    words.base**2 >= 1 << 51
                ) else _counted(keys[~hot], key_doc[~hot])
                order, dealt = _dealt(_part_of(both[0], parts), parts)
                both, times = both[:, order], times[order]
                rare_order, rare_dealt = _dealt(rare.view(np.int64) % parts, parts)
                rare, rare_doc = rare[rare_order], rare_doc[rare_order]
                open_order, open_dealt = _dealt(opened.view(np.int64) % parts, parts)
                opened, open_doc = opened[open_order], open_doc[open_order]
                some = np.unique(np.concatenate([dealt, rare_dealt, open_dealt]))
                cut, rare_cut, open_cut = (_cuts(d, some) for d in (dealt, rare_dealt, open_dealt))
                m = len(some)
                asks = [
                    pa.array(some, pa.int32()), pa.array([block] * m, pa.int64()),
                    pa.array([pack_sorted(both[0, c]) for c in cut], pa.binary()),
                    pa.array([pack(both[1, c]) for c in cut], pa.binary()),
                    pa.array([pack(times[c]) for c in cut], pa.binary()),
                    pa.array([rare[c].tobytes() for c in rare_cut], pa.binary()),
                    pa.array([pack(rare_doc[c]) for c in rare_cut], pa.binary()),
                    pa.array([opened[c].tobytes() for c in open_cut], pa.binary()),
                    pa.array([pack(open_doc[c]) for c in open_cut], pa.binary()),
                ]
                names = ["part", "block", "keys", "docs", "times", "rare", "rare_docs", "open", "open_docs", "facts"]
                fact = pa.struct([("doc_id", batch.schema.field(0).type), ("role", pa.int32()), ("n", pa.int64()),
                                  ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])
                yield pa.RecordBatch.from_arrays([*asks, pa.nulls(m, pa.list_(fact))], names=names)
                facts = pa.StructArray.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(sizes), pa.array(known.astype(np.int64)),
                     pa.array(base.astype(np.float64)), pa.array(score.astype(np.float64))],
                    fields=list(fact),
                )
                held = pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), facts)
                none = [pa.nulls(1, pa.binary())] * 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block % parts], pa.int32()), pa.array([block], pa.int64()), *none, held], names=names
                )

    facts = f"array<struct<doc_id:{kind},role:int,n:bigint,known:bigint,base:double,score:double>>"
    return rows.mapInArrow(run, f"{_ASK}, facts {facts}"), facts


def _counted(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, times = np.unique((keys << _U(12)) | doc.astype(_U), return_counts=True)
    return np.stack([values >> _U(12), values & _U(4095)]), times


def _answered(left: pa.Table, right: pa.Table, own: Scorer, kind: pa.DataType) -> pa.Table:
    """Partial sums of one part for each batch that asks."""
    stored = right.filter(right["keys"].is_valid())
    pairs, seen = np.zeros(0, _U), np.zeros(0)
    if stored.num_rows:
        pairs = unpack_sorted(stored["keys"][0].as_py())
        seen = (unpack(stored["main"][0].as_py()) + unpack(stored["held"][0].as_py())).astype(np.float64)
    words = right.filter(right["rare"].is_valid())
    rare = words["rare"].to_numpy().astype(np.int64).view(_U)
    order = np.argsort(rare)
    rare, amount = rare[order], words["amount"].to_numpy().astype(np.float64)[order]
    opened = right.filter(right["open"].is_valid())
    named = opened["open"].to_numpy().astype(np.int64).view(_U)
    order = np.argsort(named)
    named = named[order]
    open_seen, open_before, open_word, open_bare = (
        opened[c].to_numpy().astype(np.float64)[order] for c in ("seen", "before", "word", "bare")
    )

    def look(table, values, found):
        if not len(table):
            return np.zeros(len(found))
        spot = np.minimum(np.searchsorted(table, found), len(table) - 1)
        return np.where(table[spot] == found, values[spot], 0.0)

    out = {c: [] for c in ("block", "docs", "known", "base", "score", "facts")}
    asked = ["block", "keys", "docs", "times", "rare", "rare_docs", "open", "open_docs"]
    for row in left.select([*asked, "facts"]).to_batches():
        for i in range(row.num_rows):
            block, keys, docs, times, late, late_docs, bare, bare_docs = (row.column(k)[i].as_py() for k in range(8))
            out["block"].append(block)
            if keys is None:
                out["facts"].append(row.column(8).slice(i, 1))
                for c in ("docs", "known", "base", "score"):
                    out[c].append(None)
                continue
            out["facts"].append(pa.nulls(1, kind))
            keys, docs, times = unpack_sorted(keys), unpack(docs).astype(np.int64), unpack(times)
            late, late_docs = np.frombuffer(late, _U), unpack(late_docs).astype(np.int64)
            bare, bare_docs = np.frombuffer(bare, _U), unpack(bare_docs).astype(np.int64)
            count = look(rare, amount, late)
            every, place = np.unique(np.concatenate([docs, late_docs, bare_docs]), return_inverse=True)
            first, second, third = np.split(place, [len(docs), len(docs) + len(late_docs)])
            n = len(every)
            score = _summed(first, own.logs(keys, look(pairs, seen, keys)) * times, n)
            score += _summed(second, own.rare_log(count), n)
            amounts = look(named, open_word, bare)
            score += _summed(third, own.log_of(look(named, open_before, bare), amounts, look(named, open_seen, bare)), n)
            # Numbered words are known where the document is.
            alone = look(named, open_bare, bare) > 0
            second, count = np.append(second, third[alone]), np.append(count, amounts[alone])
            out["docs"].append(pack(every))
            out["known"].append(pack(np.bincount(second, count > 0, n)))
            out["base"].append(_summed(second, own.base_log(count), n).astype("<f8").tobytes())
            out["score"].append(score.astype("<f8").tobytes())
    return pa.table(
        {
            "block": pa.array(out["block"], pa.int64()),
            **{c: pa.array(out[c], pa.binary()) for c in ("docs", "known", "base", "score")},
            "facts": pa.concat_arrays(out["facts"]) if out["facts"] else pa.nulls(0, kind),
        }
    )


def _gathered(table: pa.Table) -> pa.Table:
    """The documents of one batch with all their sums."""
    facts = pa.concat_arrays(table.filter(table["facts"].is_valid())["facts"].chunks).flatten()
    columns = dict(zip([f.name for f in facts.type], facts.flatten(), strict=True))
    known = columns["known"].to_numpy().astype(np.float64)
    base, score = columns["base"].to_numpy().copy(), columns["score"].to_numpy().copy()
    parts = table.filter(table["docs"].is_valid())
    for d, k, b, s in zip(*(parts[c].to_pylist() for c in ("docs", "known", "base", "score")), strict=True):
        docs = unpack(d).astype(np.int64)
        known[docs] += unpack(k)
        base[docs] += np.frombuffer(b, "<f8")
        score[docs] += np.frombuffer(s, "<f8")
    return pa.table(
        {
            "doc_id": columns["doc_id"], "role": columns["role"], "n_tokens": columns["n"],
            "n_known": pa.array(known.astype(np.int64)), "base_score": base, "score": score,
        }
    )


def scores(
    docs: DataFrame, held_out: Column | None = None, doc_id: str = "doc_id", text: str = "text", most: int | None = None,
    part_tokens: int = PART_TOKENS, hot_pairs: int = HOT_PAIRS, cached: int = WORDS,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    ``held_out`` is a condition on ``docs``; the model learns from all other rows. Every word is a class
    unless ``most`` limits them; ``cached`` is the number of words that are broadcast."""
    held_out = fold(F.col(doc_id)) == 1 if held_out is None else held_out
    context = docs.sparkSession.sparkContext
    rows = parts_of(docs, doc_id, text, held_out)
    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = materialized(unigrams(rows))
    words, least = frequent(counts, cached if most is None else most)
    # Where every word is numbered, the rare class holds the unseen words alone.
    words.open = most is None and words.rare_kinds > 0
    known = contexts(words, counts, rows, least)
    tokens = int(known[1][: words.rare + 1].sum())
    parts = max(16, tokens // part_tokens)
    shared, shared_known = context.broadcast(words), context.broadcast(known)
    pairs = materialized(pair_counts(rows, shared, parts))
    opened = materialized(open_pairs(rows, counts, shared, shared_known, least)) if words.open else None
    grid = statistics(pairs, shared, shared_known, max(1, -(-tokens // hot_pairs)), opened).collect()
    # Pairs are written, so nothing reads these again.
    shared.destroy()
    shared_known.destroy()
    hot = sorted((-1 - r["cell"], r["weight"]) for r in grid if r["cell"] < 0)
    mix = mixture([r for r in grid if r["cell"] >= 0], words.classes)
    own = Scorer(
        words, known[1], mix, np.array([k for k, _ in hot], _U), np.array([c for _, c in hot], np.float64),
        tokens, words.rare + words.rare_kinds,
    )
    scorer = context.broadcast(own)
    asked, facts = _asked(rows, scorer, parts)
    rare = counts.where(F.col("main") + F.col("held") < least).select(
        F.pmod("hash", F.lit(parts)).cast("int").alias("part"), F.col("hash").alias("rare"),
        (F.col("main") + F.col("held")).alias("amount"),
    )
    if opened is not None:
        rare = rare.limit(0)
    found = (
        opened.select(
            F.pmod("pair", F.lit(parts)).cast("int").alias("part"), F.col("pair").alias("open"),
            (F.col("main") + F.col("held")).alias("seen"), F.col("before_total").alias("before"),
            F.col("word_total").alias("word"), F.col("word_open").cast("long").alias("bare"),
        ) if opened is not None
        else docs.sparkSession.createDataFrame([], "part int, open long, seen long, before long, word long, bare long")
    )
    stored = pairs.unionByName(rare, allowMissingColumns=True).unionByName(found, allowMissingColumns=True)

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        return _answered(left, right, scorer.value, left.schema.field("facts").type)

    answers = (
        asked.groupBy("part").cogroup(stored.groupBy("part")).applyInArrow(answer, f"{_SUMS}, facts {facts}")
    )
    schema = f"doc_id {kind}, role int, n_tokens long, n_known long, base_score double, score double"
    done = answers.groupBy("block").applyInArrow(_gathered, schema)
    return done.select(
        "doc_id",
        (F.col("role") == 0).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
