"""Byte-level BPE encoding and decoding with exact ids, by dynamic programming over prefixes.

The encoding of a text's prefix has one last token. It is the only token that ends there
and may stand behind the last token of the prefix before it: two tokens may be
neighbours when no merge across their border comes before the merges that made them. So a
piece is encoded in one pass, without a queue of merges: an automaton over the vocabulary lists
along its suffix links, for every prefix, the tokens that are suffixes of it, the test of
pairs picks the one, and following back-pointers from the end gives the ids. The work is
linear in the bytes of a piece, for pieces of any length.

Texts never leave their row: each batch is encoded where it is read, nothing is shuffled.
A task holds the vocabulary, at most ``most`` pieces with their ids and twice as many tested
pairs; long pieces are not held.

Defined results
* NULL and empty texts have no ids; no ids decode to the empty text.
* Whole texts of any length are encoded; ties do not occur, as the encoding is unique.
* The text of an added token (``<|endoftext|>``) becomes its one id and is decoded to that text.
* Ids that the vocabulary does not hold decode to nothing; bytes that are no UTF-8 to U+FFFD.
* Repeated rows give equal ids and all stay; an empty table gives an empty result. Other columns
  are kept; the caller names the new ones, and a name that the table uses already is refused.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from array import array
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from perptide.llm.common import appended

VOCABULARY = "byte_bpe_50k.json"

# How the byte-level pre-tokenizer parts a text into pieces.
PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


@lru_cache(maxsize=1)
def recent_characters() -> frozenset[str]:
    """Characters that only the newer one of two Unicode tables in this process knows.

    Libraries of different age class them differently, so texts that hold one are
    parted by the tokenizer's own code.
    """
    unassigned = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Cn")
    return frozenset(regex.findall(r"\P{Cn}", unassigned))


def shown_bytes() -> dict[str, int]:
    """The character by which a byte-level vocabulary file writes each byte."""
    hidden = [b for b in range(256) if b <= 32 or 127 <= b <= 160 or b == 173]
    return {chr(256 + hidden.index(b) if b in hidden else b): b for b in range(256)}


class Vocabulary:
    """Tokens, merges and the automaton of one vocabulary file, with an encoder and a decoder."""

    def __init__(self, path: str, most: int = 1 << 19):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        part = described["pre_tokenizer"]
        if part["type"] != "ByteLevel" or part["add_prefix_space"] or described["normalizer"]:
            raise ValueError(f"{path} is no plain byte-level vocabulary")
        self.own_parts = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.most = most
        self.held: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}  # both ids in one number
        self._read(described["model"])
        self._added(described["added_tokens"])

    def _read(self, model: dict) -> None:
        of_char, vocab = shown_bytes(), model["vocab"]
        self.bytes_of = {i: bytes(map(of_char.__getitem__, token)) for token, i in vocab.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[left], vocab[right]] = rank
            self.parts.setdefault(vocab[left + right], (vocab[left], vocab[right]))
        # The rank of the merge that makes a token; bytes are there from the start.
        self.made = {i: self.rank.get(self.parts.get(i), -1) for i in self.bytes_of}
        self.automaton = ahocorasick.Automaton()
        for i, token in self.bytes_of.items():
            if len(token) == 1 or (i in self.parts and self._apart(*self.parts[i], self.made[i])):
                self.automaton.add_word(token.decode("latin-1"), (i, len(token)))
        self.automaton.make_automaton()

    def _added(self, added: list[dict]) -> None:
        self.added = {token["content"]: token["id"] for token in added}
        self.bytes_of |= {i: text.encode() for text, i in self.added.items()}
        longest_first = sorted(map(regex.escape, self.added), key=len, reverse=True)
        self.added_pattern = regex.compile(f"({'|'.join(longest_first)})") if added else None

    def _apart(self, left: int, right: int, until: float = float("inf")) -> bool:
        """Whether the border of two neighbours outlives all merges of a rank below ``until``.

        Time runs backwards: of the two tokens at the border the one made last is undone, and
        what remains at the border of it was there before. A merge of the two happens if it
        comes before either is used up by its own token; of merges of one rank the left goes first.
        """
        made, parts, rank = self.made, self.parts, self.rank
        left_ends = right_ends = until
        while True:
            joined = rank.get((left, right))
            if joined is not None and joined < left_ends and joined <= right_ends and joined < until:
                return False
            if made[left] > made[right]:
                left_ends, left = made[left], parts[left][1]
            elif made[right] >= 0:
                right_ends, right = made[right], parts[right][0]
            else:
                return True

    def _follows(self, left: int, right: int) -> bool:
        if len(self.pairs) > 2 * self.most:
            self.pairs.clear()
        known = self.pairs[left << 32 | right] = self._apart(left, right)
        return known

    def piece_ids(self, piece: bytes) -> list[int]:
        """Ids of one piece: the last token of each prefix, then back-pointers from the end."""
        last: list[int] = [-1] * len(piece)
        pairs, follows = self.pairs, self._follows
        for end, (token, size) in self.automaton.iter(piece.decode("latin-1")):
            if last[end] < 0:
                if end < size:
                    last[end] = token
                elif (left := last[end - size]) >= 0:
                    known = pairs.get(left << 32 | token)
                    if follows(left, token) if known is None else known:
                        last[end] = token
        out, at, bytes_of = [], len(piece) - 1, self.bytes_of
        while at >= 0:
            out.append(last[at])
            at -= len(bytes_of[last[at]])
        out.reverse()
        return out

    def _held(self, piece: str) -> bytes:
        ids = array("I", self.piece_ids(piece.encode())).tobytes()
        if len(piece) <= 64:
            if len(self.held) >= self.most:
                self.held.clear()
            self.held[piece] = ids
        return ids

    def _split(self, text: str) -> list[str]:
        if text.isascii() or recent_characters().isdisjoint(text):
            return PIECES.findall(text)
        return [text[a:b] for _, (a, b) in self.own_parts(text)]

    def encode(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids of the whole text."""
        if not text:
            return b""
        if self.added_pattern and self.added_pattern.search(text):
            ends = [array("I", [self.added[x]]).tobytes() for x in self.added_pattern.findall(text)]
            between = [self.encode(x) for x in self.added_pattern.split(text)[::2]]
            return between[0] + b"".join(chain.from_iterable(zip(ends, between[1:], strict=True)))
        held, new = self.held.get, self._held
        return b"".join([held(piece) or new(piece) for piece in self._split(text)])

    def decode(self, ids: bytes | None) -> str:
        """The text of little-endian 32-bit ids."""
        token = self.bytes_of
        found = [token.get(i, b"") for i in np.frombuffer(ids or b"", "<u4").tolist()]
        return b"".join(found).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of this process; a bare name is a file of the public tokenizers."""
    if "/" not in path:
        import public_tokenizers

        path = public_tokenizers.path(path)
    return Vocabulary(path)


def _refused(df: DataFrame, name: str) -> None:
    if name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"the table has a column {name} already; name the new column otherwise")


def encoded(
    docs: DataFrame, text: str = "text", ids: str = "ids", path: str = VOCABULARY, keep: list[str] | None = None
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the ids of its texts, as little-endian 32-bit integers."""
    _refused(docs.select(*keep) if keep is not None else docs, ids)

    def arrays(batch: pa.RecordBatch):
        encode = vocabulary(path).encode
        yield pa.array([encode(t.as_py()) for t in batch.column(text)], pa.binary())

    return appended(docs, f"`{ids}` binary", arrays, keep)


def decoded(
    df: DataFrame, ids: str = "ids", text: str = "decoded", path: str = VOCABULARY, keep: list[str] | None = None
) -> DataFrame:
    """``df`` (or its columns ``keep``) with the texts of its ids."""
    _refused(df.select(*keep) if keep is not None else df, text)

    def arrays(batch: pa.RecordBatch):
        decode = vocabulary(path).decode
        yield pa.array([decode(i.as_py()) for i in batch.column(ids)], pa.string())

    return appended(df, f"`{text}` string", arrays, keep)
