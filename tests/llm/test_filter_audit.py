import re
from collections import Counter
from itertools import permutations

import pytest

from perptide.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int, text string, n int, part string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def brute(rows, labels):
    """Every order applied filter by filter."""
    texts = [(i, t or "", s or "") for i, t, s in rows]
    first = {}
    for i, t, _ in texts:
        if i is not None:
            first[t] = min(i, first.get(t, i))

    def fails(i, t):
        w = words(t)
        return "".join(
            name
            for name, failed in {
                "A": len(w) < 50,
                "B": 100 * len(set(w)) < 65 * len(w),
                "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
                "D": any(c in "#$%&*|" for c in t),
                "E": i is not None and i > first[t],
            }.items()
            if failed
        )

    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, x in labels if x == 1} - {None}
    docs = [(s, fails(i, t), i in good, i in toxic) for i, t, s in texts]
    out, total = {}, Counter()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, name in enumerate(order, 1):
                gone = [d for d in left if name in d[1]]
                left = [d for d in left if name not in d[1]]
                failing = sum(name in d[1] for d in own)
                total[part, name] += len(gone)
                out[part, order, step] = (
                    len(left),
                    len(gone),
                    failing - len(gone),
                    sum(d[1] == name for d in own),
                    sum(d[2] for d in gone),
                    sum(d[3] for d in gone),
                )
    return {(p, o, s): (*v, total[p, o[s - 1]]) for (p, o, s), v in out.items()}


def audited(spark, documents, rows, labels):
    table = spark.createDataFrame([(*r, "x", 1, "y") for r in labels], LABELS)
    result = filter_audit.audit(filter_audit.counts(documents(rows), table)).collect()
    return {tuple(r)[:3]: tuple(r)[3:] for r in result}, len(result)


def long_text(rng, n=80):
    text = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", f"w{rng.randrange(400)}"]) for _ in range(n))
    return text + rng.choice(["", " HELLO WORLD OF CAPITALS", " 50%", "\n\x0b\f\r\t", " Ünïcödé ÄÖ"])


def test_same_as_applying_every_order(spark, documents, rng):
    texts = [None, "", " ", "a", "A", "A\tA A", "#", "x y", *[long_text(rng) for _ in range(8)]]
    texts += [" ".join(f"w{i}" for i in range(n)) for n in (49, 50, 51)]
    texts += [" ".join(f"w{i}" for i in range(65)) + " w0" * n for n in (34, 35, 36)]
    rows = [(i, rng.choice(texts), rng.choice(["p", "q", "p", None, ""])) for i in range(150)]
    rows += [(None, texts[9], "p"), (None, texts[9], "q"), rows[3], rows[3], rows[7]]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 150, 2)]
    labels += [(4, 1, 0), (4, 0, 1), (None, 1, 1), (999, 1, 1)]
    got, n = audited(spark, documents, rows, labels)
    assert got == brute(rows, labels) and n == 120 * 5 * 3


def test_empty_tables(spark, documents):
    assert audited(spark, documents, [], []) == ({}, 0)
    got, n = audited(spark, documents, [(1, None, None)], [])
    assert n == 600 and got["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)


def test_very_long_text_and_one_hot_text(spark, documents):
    long = " ".join(f"w{i}" for i in range(200_000))
    rows = [(i, long if i < 3 else "same", "s") for i in range(400)]
    got, _ = audited(spark, documents, rows, [(0, 1, 1), (5, 1, 0)])
    assert got == brute(rows, [(0, 1, 1), (5, 1, 0)])


@pytest.mark.parametrize("k", [1, 2, 4, 5])
def test_lattice(k):
    names = "ABCDEFG"[:k]
    found = filter_audit.edges(names)
    orders = len(list(permutations(names)))
    reaching, leaving = filter_audit.path_counts(k)
    assert len(found) == k * 2 ** (k - 1) and reaching[-1] == leaving[0] == orders
    assert all(e["weight"] == len(e["orders"]) for e in found)
    for size in range(k):
        assert sum(e["weight"] for e in found if e["before"].bit_count() == size) == orders
