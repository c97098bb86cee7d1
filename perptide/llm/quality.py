"""Quality classifier: logistic regression over hashed word n-grams.

Features of a text are its tokens (runs of letters and digits, runs of other marks), pairs
of neighbouring tokens, a common feature for a token that repeats the one before it, and
triples of token shapes, each hashed into ``1 << BITS`` slots. A slot's value is the square
root of its share of the text's features, so long and short texts weigh alike.

Training follows the regularised leader (FTRL-proximal) on a bounded sample of labelled
rows: ``SAMPLE`` rows by the order of a hash, dealt to ``SHARDS`` learners that each run over
their share; their states are averaged and start the next of ``ROUNDS`` rounds. Scoring
is a sparse dot product per text with the broadcast weights, whose size ``BITS`` fixes.

Defined results
* NULL and empty texts hold no features and score the model's intercept.
* Rows without an identifier, a label or a text are no examples; of several label rows of
  one document each is an example. Without examples every text scores 0.5.
* Repeated rows get equal scores and all stay; other columns are kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perptide.llm.common import WordHashes, appended, bytes_of, fresh, materialized, mixed, ordered_hash

BITS = 18
SAMPLE = 16384
SHARDS = 8
ROUNDS = 4
#: Rejected are texts that score lower.
THRESHOLD = 0.3

_TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\s]+")
_SAME, _SHAPE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _Tokens(WordHashes):
    """Hash of the lower-cased token, its shape in the last two bits."""

    def __missing__(self, word: bytes) -> int:
        text = word.decode("utf-8", "replace")
        if not text[:1].isalpha():
            shape = 3
        elif len(text) > 1 and text.isupper():
            shape = 2
        else:
            shape = int(text[:1].isupper())
        value = self[word] = xxhash.xxh64_intdigest(text.lower()) & ~3 | shape
        return value


def features(text: bytes | None, tokens: _Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(slots, values) of a text; slot 0 is the intercept."""
    found = tokens.of(_TOKEN.findall(text)) if text else np.zeros(0, np.uint64)
    if not len(found):
        return np.zeros(1, np.int64), np.ones(1)
    shape, word = found & np.uint64(3), found >> np.uint64(2)
    pairs = np.where(word[:-1] == word[1:], _SAME, word[:-1] * np.uint64(31) + word[1:])
    triples = shape[:-2] * np.uint64(16) + shape[1:-1] * np.uint64(4) + shape[2:] + _SHAPE
    slots = mixed(np.concatenate([word, pairs, triples])) & np.uint64((1 << BITS) - 1)
    slots, counts = np.unique(slots.astype(np.int64), return_counts=True)
    return np.append(slots[slots > 0], 0), np.append(np.sqrt(counts[slots > 0] / counts.sum()), 1.0)


@dataclass
class Ftrl:
    """State of the regularised leader: gradient sums ``z`` and squared gradient sums ``n``."""

    z: np.ndarray
    n: np.ndarray
    alpha: float = 15.0
    beta: float = 1.0
    l1: float = 0.005
    l2: float = 0.0

    @classmethod
    def empty(cls) -> Ftrl:
        return cls(np.zeros(1 << BITS), np.zeros(1 << BITS))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        rate = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) > self.l1, (np.sign(z) * self.l1 - z) / rate, 0.0)

    def learn(self, slots: np.ndarray, values: np.ndarray, label: float) -> None:
        w = self.weights(slots)
        gradient = (sigmoid(float(w @ values)) - label) * values
        squared = gradient * gradient
        sigma = (np.sqrt(self.n[slots] + squared) - np.sqrt(self.n[slots])) / self.alpha
        self.z[slots] += gradient - sigma * w
        self.n[slots] += squared


def sigmoid(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -500, 500))))


def examples(
    docs: DataFrame, labels: DataFrame, learn_from: Column, doc_id: str = "doc_id", text: str = "text",
    label: str = "quality", sample: int = SAMPLE,
) -> DataFrame:
    """(text, label, shard, at) of the sampled rows; ``learn_from`` is a condition on ``labels``.

    The sample holds at most ``sample`` identifiers with labels, so it may be broadcast;
    the texts of the documents are not shuffled.
    """
    order = ordered_hash(F.col(doc_id), F.col(label))
    chosen = (
        labels.where(learn_from & F.col(doc_id).isNotNull() & F.col(label).isNotNull())
        .select(F.col(doc_id).alias("key"), F.col(label).cast("double").alias("label"), order.alias("at"))
        .orderBy("at", "key", "label")
        .limit(sample)
    )
    return (
        docs.where(F.col(text).isNotNull())
        .select(F.col(doc_id).alias("key"), F.col(text).alias("text"))
        .join(F.broadcast(chosen), "key")
        .select("text", "label", (F.col("at") % SHARDS).cast("int").alias("shard"), "at")
    )


_STATE = "shard int, slots binary, z binary, n binary"


def _state_of(rows: pa.Table) -> Ftrl:
    """The mean of the states in ``rows``; slots that a state does not list are zero in it."""
    mean = Ftrl.empty()
    for slots, z, n in zip(*(rows[c].to_pylist() for c in ("slots", "z", "n")), strict=True):
        at = np.frombuffer(slots, np.int32)
        mean.z[at] += np.frombuffer(z) / rows.num_rows
        mean.n[at] += np.frombuffer(n) / rows.num_rows
    return mean


def _touched(state: Ftrl, shard: int) -> pa.Table:
    """The state's slots that an example has touched, as one row."""
    at = np.flatnonzero(state.n).astype(np.int32)
    columns = [pa.array([x.tobytes()], pa.binary()) for x in (at, state.z[at], state.n[at])]
    return pa.table([pa.array([shard], pa.int32()), *columns], names=["shard", "slots", "z", "n"])


def _learn(key, examples: pa.Table, start: pa.Table) -> pa.Table:
    """One learner's run over its share, from the state of the round before."""
    if not examples.num_rows:
        return start.slice(0, 0)
    own, tokens = _state_of(start), _Tokens()
    examples = examples.sort_by("at")
    for text, label in zip(bytes_of(examples["text"]), examples["label"].to_pylist(), strict=True):
        own.learn(*features(text, tokens), label)
    return _touched(own, key[0].as_py())


def _mean(states: pa.Table) -> pa.Table:
    return _touched(_state_of(states), 0)


def train(rows: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """Weights learned from ``examples``.

    States stay on the cluster: a round's ``SHARDS`` states, of fixed size, are averaged in one task,
    and the stored mean starts the next round. The driver gets the last mean only.
    """
    spark = rows.sparkSession
    stored = materialized(rows)
    every = F.explode(F.array(*map(F.lit, range(SHARDS)))).alias("shard")
    mean = spark.createDataFrame([], _STATE)
    for _ in range(rounds):
        start = mean.select(every, "slots", "z", "n").groupBy("shard")
        states = stored.groupBy("shard").cogroup(start).applyInArrow(_learn, _STATE)
        mean = materialized(states.groupBy().applyInArrow(_mean, _STATE))
    return _state_of(mean.toArrow()).weights()


def scored(
    docs: DataFrame, weights: np.ndarray, text: str = "text", score: str = "score", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the probability of a good text in the column ``score``."""
    model = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float64))
    held: list[_Tokens] = []  # one a task, made where it is used

    def arrays(batch: pa.RecordBatch):
        if not held:
            held.append(_Tokens())
        w, tokens = model.value, held[0]
        margins = [float(w[s] @ v) for s, v in (features(t, tokens) for t in bytes_of(batch.column(text)))]
        yield pa.array([sigmoid(m) for m in margins], pa.float64())

    return appended(docs, f"`{score}` double", arrays, keep)


def filtered(docs: DataFrame, weights: np.ndarray, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with their columns as they were."""
    (score,) = fresh(docs, "quality_score")
    return scored(docs, weights, text, score).where(F.col(score) >= threshold).drop(score)
