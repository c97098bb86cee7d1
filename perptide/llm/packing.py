"""Best-fit packing of token pieces into sequences of a fixed capacity.

Best fit in decreasing order, in bulk-synchronous rounds of one piece length each.
In a round all pieces of the length are matched to their successors, the smallest gaps
that still hold them; ranks settle which piece gets which gap; the gaps shrink, and the
next round begins. Pieces of one length, like gaps of one room, are interchangeable, so
both are range-sorted by counting: a round sweeps runs of equal gaps, at most as many as
the capacity has lengths, whatever the number of documents. What the sweeps decide is a
table of rank intervals, bounded by the capacity (see ``plan``), which is joined with the
ranked pieces on the cluster. Neither pieces nor gaps ever meet in one task.

Defined results
* NULL text counts as empty: a document of the end token alone.
* A document longer than the capacity is cut into pieces of it; only the last is shorter.
* Repeated rows are packed as often as they stand; ties of length are ranked by a hash
  and then by identifier, piece and checksum.
* An empty table gives an empty result. Other columns of the pieces are kept.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perptide.llm.common import fresh, materialized, numbered

CAPACITY = 4096
TOKENIZER = "word_bpe_49k.json"
END_ID = 1

_PIECE_SCHEMA = "piece int, start long, length long, ids_crc32 long"


class Encoder(dict):
    """Little-endian 32-bit ids of each word between spaces; white space never joins words here.

    Words of plain Latin letters, with or without marks behind them, are one piece and a run of
    marks for the tokenizer, so the letters go to its model at once. Other new words of a
    batch are encoded together, parted by a mark that is one token. At most ``most`` words are held.
    """

    MARK = "\x01"
    TAILS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")

    def __init__(self, path: str, most: int = 1 << 19):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.most = most
        self.mark = self._ids(self.MARK)
        self.heads: dict[str, bytes] = {}
        self.tails = {"": b""}
        # Bytes that are no visible Latin-1 character stand for the code points from 256 on, in order.
        hidden = [b for b in range(256) if b <= 32 or 127 <= b <= 160 or b == 173]
        self.visible = {b: 256 + i for i, b in enumerate(hidden)}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _latin(self, word: str) -> bytes | None:
        head = word.rstrip(self.TAILS)
        if not head.isalpha() or max(head) >= "\u0130":
            return None
        tail = word[len(head) :]
        if tail not in self.tails:
            if len(self.tails) > 4096:
                self.tails = {"": b""}
            self.tails[tail] = np.array(self._ids(tail), "<u4").tobytes()
        form = head.lower()
        ids = self.heads.get(form)
        if ids is None:
            shown = form if form.isascii() else form.encode().decode("latin-1").translate(self.visible)
            ids = array("I", [token.id for token in self.model.tokenize(shown)]).tobytes()
            if len(self.heads) > self.most // 2:
                self.heads.clear()
            self.heads[form] = ids
        return ids + self.tails[tail] if tail else ids

    def _learn(self, words: list[str]) -> None:
        rest = []
        for word in words:
            ids = self._latin(word)
            if ids is None:
                rest.append(word)
            else:
                self[word] = ids
        plain = [w for w in rest if self.MARK not in w] if len(self.mark) == 1 else []
        for start in range(0, len(plain), 4096):
            chunk = plain[start : start + 4096]
            ids = np.array(self._ids(f" {self.MARK} ".join(chunk)), "<u4")
            parts = np.split(ids, np.flatnonzero(ids == self.mark[0]))
            if len(parts) == len(chunk):
                self.update(zip(chunk, (p[bool(i) :].tobytes() for i, p in enumerate(parts)), strict=True))
        for word in rest:
            if word not in self:
                self[word] = np.array(self._ids(word), "<u4").tobytes()

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text with the end token, as bytes."""
        split = [(t or "").replace("\n", " ").split(" ") for t in texts]
        if len(self) > self.most:
            self.clear()
        new = [w for w in {w for words in split for w in words} if w not in self]
        if new:
            self._learn(new)
        end = np.array([END_ID], "<u4").tobytes()
        return [b"".join(map(self.__getitem__, words)) + end for words in split]


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    if "/" not in path:
        import public_tokenizers

        path = public_tokenizers.path(path)
    return Encoder(path)


def pieces(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str = TOKENIZER,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document; ids as little-endian bytes."""

    def run(batches):
        encoder = _encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                encoded = encoder.batch(part.column(1).to_pylist())
                rows = [
                    (i, k, s // 4, ids[s : s + 4 * capacity])
                    for i, ids in enumerate(encoded)
                    for k, s in enumerate(range(0, len(ids), 4 * capacity))
                ]
                columns = [
                    part.column(0).take(pa.array([r[0] for r in rows], pa.int32())),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([r[2] for r in rows], pa.int64()),
                    pa.array([len(r[3]) // 4 for r in rows], pa.int64()),
                    pa.array([zlib.crc32(r[3]) for r in rows], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([r[3] for r in rows], pa.binary()))
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, {_PIECE_SCHEMA}" + ", ids binary" * with_ids
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, pieces, first sequence, pieces per sequence, offset).

    The pieces of ``length`` whose ranks lie in the interval go to consecutive sequences,
    so many to each, from ``offset`` on. A round splits at most one run of gaps and opens
    at most two, and a run shrinks at most log2(capacity) times, as less than half of a gap
    is left after it was matched. So there are at most 4 * capacity * log2(capacity) rows.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    out = []
    following = 0

    def leave(room: int, first: int, n: int) -> None:
        if room > 0 and n > 0:
            if not gaps.get(room):
                gaps[room] = []
                insort(rooms, room)
            gaps[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                break
            room = rooms[at]
            first, n = gaps[room].pop()
            if not gaps[room]:
                rooms.pop(at)
            each = min(room // length, left)
            used = min(n, left // each)
            out.append((length, rank, used * each, first, each, capacity - room))
            rank, left = rank + used * each, left - used * each
            leave(room - each * length, first, used)
            leave(room, first + used, n - used)
        if left:
            each = min(capacity // length, left)
            used = left // each
            out.append((length, rank, used * each, following, each, 0))
            leave(capacity - each * length, following, used)
            following += used
            rest = left - used * each
            if rest:
                out.append((length, rank + used * each, rest, following, rest, 0))
                leave(capacity - rest * length, following, 1)
                following += 1
    return out


def place(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``items`` (doc_id, piece, length, ids_crc32, ...) with ``sequence_id`` and ``offset``.

    ``items`` is read several times, so it should be stored. Collected are the counts of
    the lengths, at most ``capacity`` rows; broadcast is the plan, bounded as ``plan`` says.
    """
    counts = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}
    spark = items.sparkSession
    if not counts:
        return items.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    rank, length = fresh(items, "piece_rank", "plan_length")
    ranked = numbered(items, rank, ["length"], ["doc_id", "piece", "ids_crc32"])
    schema = "l long, lo long, n long, seq long, each long, at long"
    steps = spark.createDataFrame(plan(counts, capacity), schema).withColumnRenamed("l", length)
    inside = (F.col("length") == F.col(length)) & (F.col(rank) >= F.col("lo")) & (F.col(rank) < F.col("lo") + F.col("n"))
    within = F.col(rank) - F.col("lo")
    return ranked.join(F.broadcast(steps), inside).select(
        *[F.col(c) for c in items.columns],
        (F.col("seq") + F.floor(within / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + (within % F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )


def packed(docs: DataFrame, **options) -> DataFrame:
    """Pieces of ``docs`` with their places."""
    return place(materialized(pieces(docs, **options)), options.get("capacity", CAPACITY))


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of placed pieces that carry ``ids``; a group holds one sequence."""
    inner = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(inner, F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"))
