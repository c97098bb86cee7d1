"""Benchmark decontamination with suffix arrays over shards of the training texts.

A task cuts its documents into shards of bounded size and builds a suffix array for each:
the word positions at which a benchmark window can begin, sorted by the words that follow.
Every test suffix is binary-searched in every shard. The range of suffixes that share a
whole window gives all verbatim occurrences and their places; the neighbours of a suffix
give its longest verbatim match. Documents with an occurrence are removed.

The benchmark is a stated query set. It is taken in blocks of at most ``BLOCK_BYTES`` of
text, each broadcast in turn; documents stay where they are, nothing is shuffled, and the
findings of all blocks gather in the rows of the documents.

Defined results
* Words are runs of characters outside the ASCII marks, A-Z lower-cased. A NULL or
  wordless text holds no word and is never contaminated; such an item has no window.
* An item of fewer words than a window is one window of its own.
* Items of one identifier count as one; a NULL identifier is written ``null``.
* Repeated documents are judged alike and all stay or go; other columns are kept.
* A very long document is searched in pieces that overlap by a window.
* Without items nothing is contaminated; without documents the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perptide.llm.common import appended, bytes_of, fresh

WINDOW = 10
#: Words of a shard; a document of more is cut.
SHARD_WORDS = 1 << 20
#: Benchmark text that is broadcast at once.
BLOCK_BYTES = 16 << 20

_WORD_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_PAIR_SLOTS = 1 << 24
SPANS = "array<struct<start:int,length:int>>"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_TABLE).split() if text else []


class Block:
    """Test suffixes of one block of items.

    ``words`` numbers the words from 1. ``windows`` holds the distinct windows by length;
    row i of a matrix is a window, and ``owners`` lists the items it stands in.
    """

    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.names: list[str] = []
        texts: list[np.ndarray] = []
        for name, text in items:
            ids = [self.words.setdefault(w, len(self.words) + 1) for w in words_of(text)]
            if ids:
                self.names.append(name)
                texts.append(np.array(ids, np.int32))
        owners: dict[int, dict[bytes, set[int]]] = {}
        for item, ids in enumerate(texts):
            size = min(window, len(ids))
            rows = np.lib.stride_tricks.sliding_window_view(ids, size)
            found = owners.setdefault(size, {})
            for row in np.unique(rows, axis=0):
                found.setdefault(row.tobytes(), set()).add(item)
        self.windows = {}
        for size, found in owners.items():
            matrix = np.frombuffer(b"".join(found), np.int32).reshape(-1, size)
            lists = [np.array(sorted(s), np.int64) for s in found.values()]
            self.windows[size] = matrix, lists
        self.texts = texts
        #: Which pairs of words stand side by side in a full window, and which words begin a short one.
        self.pairs = np.zeros(_PAIR_SLOTS, bool)
        self.starts = np.zeros(len(self.words) + 1, bool)
        for size, (matrix, _) in self.windows.items():
            if size == window:
                self.pairs[_pair(matrix[:, :-1], matrix[:, 1:])] = True
            else:
                self.starts[matrix[:, 0]] = True

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Numbers of the words; 0 for one that no item holds."""
        known = self.words.get
        return np.fromiter((known(w, 0) for w in words), np.int32, len(words))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.uint64) * np.uint64(0x9E3779B1) + b.astype(np.uint64) * np.uint64(0x85EBCA77)) % np.uint64(
        _PAIR_SLOTS
    )


class SuffixArray:
    """Sorted suffixes of a shard (documents parted by 0) at which a window of ``block`` can begin.

    A suffix that cannot begin one (a pair of its first words stands side by side in no
    item) is left out. Sorting goes window by window of words until no two suffixes tie
    or ``depth`` words are compared.
    """

    def __init__(self, text: np.ndarray, block: Block, depth: int):
        w = block.window
        self.text = np.concatenate([text, np.zeros(depth + 2 * w, np.int32)])
        n = len(text)
        fits = np.zeros(n, bool)
        if w in block.windows and w > 1 and n >= w:
            side = block.pairs[_pair(text[:-1], text[1:])] & (text[:-1] > 0) & (text[1:] > 0)
            run = np.concatenate([[0], np.cumsum(side)])
            fits[: n - w + 1] = run[w - 1 :] - run[: n - w + 1] == w - 1
        elif w in block.windows:
            fits = text > 0
        at = np.flatnonzero(fits | block.starts[text])
        group = np.zeros(len(at), np.int64)
        done = 0
        while len(at) and done < depth:
            tied = np.ones(len(at), bool) if not done else _ties(group)
            if not tied.any():
                break
            part, own = at[tied], group[tied]
            columns = self.text[part[:, None] + np.arange(done, done + w)]
            order = np.lexsort((*columns.T[::-1], own))
            part, own, columns = part[order], own[order], columns[order]
            new = np.ones(len(part), bool)
            new[1:] = (own[1:] != own[:-1]) | (columns[1:] != columns[:-1]).any(axis=1)
            where = np.flatnonzero(tied)
            at[where] = part
            starts = np.zeros(len(at), bool)
            starts[where] = new
            starts[~tied] = True
            group = np.cumsum(starts)
            done += w
        self.at = at

    def compare(self, rank: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """-1, 0, 1: the suffixes of these ranks against the queries, over the queries' words."""
        size = queries.shape[1]
        differ = np.zeros(len(rank), np.int8)
        open_ = np.arange(len(rank))
        for k in range(size):
            a, b = self.text[self.at[rank[open_]] + k], queries[open_, k]
            differ[open_] = np.sign(a.astype(np.int64) - b)
            open_ = open_[a == b]
            if not len(open_):
                break
        return differ

    def search(self, queries: np.ndarray, right: bool) -> np.ndarray:
        """Rank of the first suffix that is not below (``right``: that is above) each query."""
        low = np.zeros(len(queries), np.int64)
        high = np.full(len(queries), len(self.at), np.int64)
        while (busy := np.flatnonzero(low < high)).size:
            middle = (low[busy] + high[busy]) // 2
            order = self.compare(middle, queries[busy])
            below = order <= 0 if right else order < 0
            low[busy[below]] = middle[below] + 1
            high[busy[~below]] = middle[~below]
        return low

    def common(self, rank: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """Words that suffixes and queries (padded with -1) share at their start."""
        shared = np.zeros(len(rank), np.int64)
        open_ = np.flatnonzero((rank >= 0) & (rank < len(self.at)))
        for k in range(queries.shape[1]):
            open_ = open_[self.text[self.at[rank[open_]] + k] == queries[open_, k]]
            shared[open_] += 1
            if not len(open_):
                break
        return shared


def _ties(group: np.ndarray) -> np.ndarray:
    same = group[1:] == group[:-1]
    return np.concatenate([same, [False]]) | np.concatenate([[False], same])


def _shards(texts: list[bytes | None], block: Block, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, pieces): numbered words with a 0 after each piece; a row of pieces is
    (document, first word in it, start in the text, words)."""
    held, rows, size = [], [], 0
    stop = np.zeros(1, np.int32)
    for doc, text in enumerate(texts):
        ids = block.ids(words_of(text))
        step = most - block.window + 1
        for first in range(0, max(len(ids) - block.window + 1, min(len(ids), 1)), step):
            piece = ids[first : first + most]
            if size and size + len(piece) > most:
                yield np.concatenate(held), np.array(rows, np.int64)
                held, rows, size = [], [], 0
            rows.append((doc, first, size, len(piece)))
            held += [piece, stop]
            size += len(piece) + 1
    if rows:
        yield np.concatenate(held), np.array(rows, np.int64)


def occurrences(text: np.ndarray, block: Block) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, window, place in the text) of all occurrences in a shard, by length of the windows."""
    index = SuffixArray(text, block, block.window)
    for size, (matrix, _) in block.windows.items():
        low, high = index.search(matrix, False), index.search(matrix, True)
        counts = high - low
        window = np.repeat(np.arange(len(matrix)), counts)
        rank = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
        yield size, window, index.at[rank]


def search_texts(texts: list[bytes | None], block: Block, most: int = SHARD_WORDS) -> list[tuple[list, set]]:
    """Per text: disjoint spans [start, end) of hit words in order, and the items that occur."""
    found: list[tuple[list, set]] = [([], set()) for _ in texts]
    for text, pieces in _shards(texts, block, most):
        edge = np.zeros(len(text) + 1, np.int64)
        for size, window, place in occurrences(text, block):
            np.add.at(edge, place, 1)
            np.add.at(edge, place + size, -1)
            piece = np.searchsorted(pieces[:, 2], place, "right") - 1
            pairs = np.unique(np.stack([pieces[piece, 0], window]), axis=1)
            lists = block.windows[size][1]
            for doc, one in pairs.T:
                found[doc][1].update(lists[one])
        hit = np.concatenate([[False], np.cumsum(edge)[:-1] > 0, [False]])
        change = np.flatnonzero(hit[1:] != hit[:-1])
        for start, end in change.reshape(-1, 2):
            doc, first, begin, _ = pieces[np.searchsorted(pieces[:, 2], start, "right") - 1]
            found[doc][0].append((int(start - begin + first), int(end - begin + first)))
    return found


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of spans, touching ones apart: only words matter, so adjacent spans are merged too."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def blocks_of(
    benchmark: DataFrame, item_id: str = "item_id", text: str = "text", most: int = BLOCK_BYTES
) -> Iterator[list[tuple[str, bytes | None]]]:
    """The items in blocks of at most ``most`` bytes of text; one block at a time is on the driver."""
    rows = benchmark.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")), F.col(text).cast("binary")
    )
    held, size = [], 0
    for name, body in rows.toLocalIterator():
        if held and size + len(body) > most:
            yield held
            held, size = [], 0
        held.append((name, bytes(body)))
        size += len(body)
    if held:
        yield held


def found_in(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    names: tuple[str, str, str] = ("n_words", "hit_spans", "hit_items"), block_bytes: int = BLOCK_BYTES,
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the number of words, the spans of hit words and the
    sorted items that occur."""
    count, spans, items = names
    context = docs.sparkSession.sparkContext
    words = [pa.field("start", pa.int32()), pa.field("length", pa.int32())]

    def start(batch: pa.RecordBatch):
        texts = bytes_of(batch.column(text))
        yield pa.array([len(words_of(t)) for t in texts], pa.int64())
        yield pa.array([[] for _ in texts], pa.list_(pa.struct(words)))
        yield pa.array([[] for _ in texts], pa.list_(pa.string()))

    out = None
    blocks = blocks_of(benchmark, item_id, item_text, block_bytes)
    block = next(blocks, None)
    if block is None:
        return appended(docs, f"`{count}` long, `{spans}` {SPANS}, `{items}` array<string>", start, keep)
    while block is not None:
        shared, block = context.broadcast(block), next(blocks, None)
        held: list[Block] = []  # one a task, made where it is used

        def gather(batch: pa.RecordBatch, shared=shared, held=held, first=out is None):
            if not held:
                held.append(Block(shared.value))
            texts = bytes_of(batch.column(text))
            found = search_texts(texts, held[0])
            old_spans = [[]] * len(texts) if first else batch.column(spans).to_pylist()
            old_items = [[]] * len(texts) if first else batch.column(items).to_pylist()
            merged = [
                joined_spans(hit + [(s["start"], s["start"] + s["length"]) for s in old])
                for (hit, _), old in zip(found, old_spans, strict=True)
            ]
            own = [sorted({held[0].names[i] for i in at} | set(o)) for (_, at), o in zip(found, old_items, strict=True)]
            if first:
                yield pa.array([len(words_of(t)) for t in texts], pa.int64())
            yield pa.array([[{"start": a, "length": b - a} for a, b in m] for m in merged], pa.list_(pa.struct(words)))
            yield pa.array(own, pa.list_(pa.string()))

        kept = keep if block is None else docs.columns
        if out is None:
            out = appended(docs, f"`{count}` long, `{spans}` {SPANS}, `{items}` array<string>", gather, kept)
        else:
            new = fresh(out, "more_spans", "more_items")
            kept = [*(docs.columns if kept is None else kept), count]
            out = appended(out, f"`{new[0]}` {SPANS}, `{new[1]}` array<string>", gather, kept)
            out = out.withColumnsRenamed({new[0]: spans, new[1]: items})
    return out


def longest_matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per test suffix (item_id, item_word) with a match of a window or more: the longest verbatim
    match over all shards (n_words), and the smallest document and word at which it stands."""
    context = docs.sparkSession.sparkContext
    kind = docs.schema[doc_id].dataType.simpleString()
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"item_id string, item_word int, n_words int, doc_id {kind}, doc_word long"
    parts = []
    for items in blocks_of(benchmark):
        shared = context.broadcast(items)

        def run(batches, shared=shared):
            block = Block(shared.value)
            longest = max(map(len, block.texts), default=0)
            for batch in batches:
                for shard, pieces in _shards(bytes_of(batch.column(1)), block, SHARD_WORDS):
                    index = SuffixArray(shard, block, longest)
                    for item, ids in enumerate(block.texts):
                        least = min(block.window, len(ids))
                        count = len(ids) - least + 1
                        padded = np.concatenate([ids, np.full(len(ids), -1, np.int32)])
                        suffixes = padded[np.arange(count)[:, None] + np.arange(len(ids))]
                        right = index.search(suffixes, False)
                        above, below = index.common(right, suffixes), index.common(right - 1, suffixes)
                        best = np.maximum(above, below)
                        for j in np.flatnonzero(best >= least):
                            place = index.at[right[j] if above[j] >= below[j] else right[j] - 1]
                            doc, first, begin, _ = pieces[np.searchsorted(pieces[:, 2], place, "right") - 1]
                            row = [block.names[item], int(j), int(best[j]), batch.column(0)[int(doc)].as_py()]
                            yield pa.RecordBatch.from_pylist(
                                [dict(zip(["item_id", "item_word", "n_words", "doc_id"], row, strict=True))
                                 | {"doc_word": int(place - begin + first)}],
                                schema=pa.schema([
                                    ("item_id", pa.string()), ("item_word", pa.int32()), ("n_words", pa.int32()),
                                    ("doc_id", batch.schema.field(0).type), ("doc_word", pa.int64()),
                                ]),
                            )

        parts.append(source.mapInArrow(run, schema))
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    order = F.struct(-F.col("n_words"), F.col("doc_id"), F.col("doc_word"))
    best = out.groupBy("item_id", "item_word").agg(F.min_by(F.struct("n_words", "doc_id", "doc_word"), order).alias("b"))
    return best.select("item_id", "item_word", "b.*")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that hold no window of the benchmark, with their columns as they were."""
    names = fresh(docs, "n_words", "hit_spans", "hit_items")
    return found_in(docs, benchmark, text, names=tuple(names)).where(F.size(names[1]) == 0).drop(*names)
