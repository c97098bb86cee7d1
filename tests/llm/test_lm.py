import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from perptide.llm import lm


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*low.split(), None]


def brute(rows, roles, most):
    """Scores of all rows by plain dictionaries, with the weights that the operator's own EM finds."""
    train = Counter(w for (_, t), r in zip(rows, roles) if r in (1, 2) for w in tokens(t))
    main = Counter(w for (_, t), r in zip(rows, roles) if r == 1 for w in tokens(t))
    total, kinds = sum(train.values()), len(train)
    taken = set()
    for count in sorted(set(train.values()), reverse=True):
        more = {w for w, c in train.items() if c == count}
        if len(taken) + len(more) > most:
            break
        taken |= more
    cls = lambda w: w if w in taken else "RARE"
    pairs = lambda which: Counter(
        p for (_, t), r in zip(rows, roles) if r in which
        for x in [[cls(w) for w in tokens(t)]] for p in zip(["START", *x], x)
    )
    def level(counter, which):
        out = Counter()
        for w, c in counter.items():
            out[cls(w)] += c
        out["START"] = sum(r in which for r in roles)
        return out
    c_main, c_all = level(main, (1,)), level(train, (1, 2))
    p_main, p_held, p_all = pairs((1,)), pairs((2,)), pairs((1, 2))
    n_main = max(1, sum(main.values()))
    grid = {}
    for (v, w), h in p_held.items():
        p2, p1 = p_main[v, w] / max(c_main[v], 1), c_main[w] / n_main
        cell = int((lm.bucket(np.array([c_main[v]]))[0] * 512 + lm._octave(np.array([p2]))[0]) * 512 + lm._octave(np.array([p1]))[0])
        row = grid.setdefault(cell, {"cell": cell, "weight": 0.0, "pair": 0.0, "single": 0.0})
        row["weight"] += h
        row["pair"] += h * p2
        row["single"] += h * p1
    mix = lm.mixture(list(grid.values()), len(taken) + 1)
    rare_total = sum(c for w, c in train.items() if w not in taken)
    rare_kinds = sum(w not in taken for w in train)

    def p(v, w):
        m = mix[lm.bucket(np.array([c_all[v]]))[0]]
        out = m[0] / (len(taken) + 1) + m[1] * c_all[cls(w)] / max(total, 1) + m[2] * p_all[v, cls(w)] / max(c_all[v], 1)
        return out if w in taken else out * (train[w] + 0.5) / (rare_total + 0.5 * (rare_kinds + 1))

    out = []
    for doc, text in rows:
        x = tokens(text)
        before = ["START", *map(cls, x)]
        out.append((
            doc, len(x), sum(train[w] > 0 for w in x), total,
            sum(math.log10((train[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in x),
            sum(math.log10(p(v, w)) for v, w in zip(before, x)),
        ))
    outside = sum(0.5 / (rare_total + 0.5 * (rare_kinds + 1)) for _ in [0])
    v = "START"
    m = mix[lm.bucket(np.array([c_all[v]]))[0]]
    rare = m[0] / (len(taken) + 1) + m[1] * c_all["RARE"] / max(total, 1) + m[2] * p_all[v, "RARE"] / max(c_all[v], 1)
    if total:
        assert abs(sum(p(v, w) for w in train) + rare * outside - 1) < 1e-9
    return out


@pytest.mark.parametrize(("most", "hot"), [(1 << 19, 1 << 16), (20, 50), (0, 50)])
def test_equals_brute_force(spark, documents, rng, most, hot):
    word = lambda: rng.choice("the of and a in") if rng.random() < 0.5 else f"W{int(rng.expovariate(0.05))}"
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 40)))) for i in range(150)]
    rows += [(500, None), (501, ""), (502, "the of " * 4000), (None, "the of never"), (503, "\t\n"), (4, rows[4][1])]
    docs = documents([(i, t, "s") for i, t in rows])
    roles = {r["doc_id"]: r["role"] for r in lm.parts_of(docs, "doc_id", "text", F.col("doc_id") % 5 == 1).collect()}
    expected = brute(rows, [roles[i] for i, _ in rows], most)
    got = lm.scores(docs, F.col("doc_id") % 5 == 1, most=most, part_tokens=100, hot_pairs=hot).collect()
    found = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got), key=lambda r: repr(r[:3]))
    assert len(found) == len(expected)
    for a, b in zip(found, sorted(expected, key=lambda r: repr(r[:3])), strict=True):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], rel=1e-9)
    assert {r["doc_id"] for r in got if r["held_out"]} == {i for i, _ in rows if i is not None and i % 5 == 1}


def test_packed_numbers():
    for values in ([], [0], [1, 1, 2**40], [2**64 - 1, 3]):
        x = np.array(values, np.uint64)
        assert (lm.unpack(lm.pack(x)) == x).all()
        assert (lm.unpack_sorted(lm.pack_sorted(np.sort(x))) == np.sort(x)).all()


def test_empty_and_nothing_to_learn(documents):
    assert lm.scores(documents([])).count() == 0
    got = lm.scores(documents([(1, "a b", "s")]), F.lit(True)).collect()
    assert got[0]["train_tokens"] == 0 and got[0]["n_known"] == 0 and got[0]["score"] <= 0


@pytest.mark.parametrize(("cached", "hot"), [(20, 50), (0, 50)])
def test_words_past_the_cache_are_classes_of_their_own(documents, rng, cached, hot):
    word = lambda: rng.choice("the of and a in") if rng.random() < 0.5 else f"W{int(rng.expovariate(0.05))}"
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 40)))) for i in range(150)]
    rows += [(500, None), (501, "new1 new2 new1 W3 the"), (502, "the of " * 4000), (None, "the of never W1"), (4, rows[4][1])]
    docs = documents([(i, t, "s") for i, t in rows])
    roles = {r["doc_id"]: r["role"] for r in lm.parts_of(docs, "doc_id", "text", F.col("doc_id") % 5 == 1).collect()}
    expected = brute(rows, [roles[i] for i, _ in rows], 1 << 19)
    got = lm.scores(docs, F.col("doc_id") % 5 == 1, cached=cached, part_tokens=100, hot_pairs=hot).collect()
    columns = ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    found = sorted((tuple(r[c] for c in columns) for r in got), key=lambda r: repr(r[:3]))
    assert len(found) == len(expected)
    for a, b in zip(found, sorted(expected, key=lambda r: repr(r[:3])), strict=True):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], rel=1e-9)
