import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from perptide.llm import packing


def sequential(lengths, capacity):
    """Best fit, one piece after the other in decreasing order: the number of sequences."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


@pytest.mark.parametrize("most", [5, 40, 100])
def test_plan_is_best_fit_decreasing(rng, most):
    for _ in range(20):
        lengths = [min(100, rng.randint(1, most) if rng.random() < 0.7 else 100) for _ in range(rng.randint(1, 120))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        used = {}
        for length, rank, n, first, each, offset in packing.plan(counts, 100):
            for k in range(n):
                used.setdefault(first + k // each, []).append((offset + (k % each) * length, length))
            assert 0 <= rank and rank + n <= counts[length]
        assert sum(map(len, used.values())) == len(lengths)
        for held in used.values():
            at = 0
            for offset, length in sorted(held):
                assert offset == at
                at += length
            assert at <= 100
        assert len(used) == sequential(lengths, 100)


TEXTS = [
    None, "", "One, two!", "a\tb\r\nc  d", "x \x01 y\x01", "<|endoftext|> inside<|endoftext|>", "Ünïcode ΣΑΣ é", "’s it's",
    " ".join(f"word{i % 700}" for i in range(9000)), "same", "same",
]


def test_tokens_places_and_sequences(spark, documents):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "s"), (None, "nobody", "s")]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    expected = []
    for doc, text, _ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        for k, s in enumerate(range(0, len(ids), 4096)):
            part = ids[s : s + 4096]
            expected.append((doc, k, s, len(part), zlib.crc32(part.tobytes())))
    placed = packing.packed(documents(rows), with_ids=True).cache()
    got = placed.collect()
    assert sorted(map(repr, expected)) == sorted(
        repr((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in got
    )
    total = sum(r["length"] for r in got)
    assert len({r["sequence_id"] for r in got}) == math.ceil(total / 4096)
    for r in packing.sequences(placed).collect():
        ids = bytes(r["ids"])
        for piece in (g for g in got if g["sequence_id"] == r["sequence_id"]):
            assert ids[4 * piece["offset"] :][: 4 * piece["length"]] == bytes(piece["ids"])


def test_empty_table(documents):
    assert packing.packed(documents([])).count() == 0
