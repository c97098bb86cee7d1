import re

import pytest
from pyspark.sql import functions as F

from perptide.llm import decontaminate as dc


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(text, items, window=10):
    w, hit, found = words(text), set(), set()
    for name, body in items:
        x = words(body)
        size = min(window, len(x))
        for k in range(len(x) - size + 1) if x else ():
            for p in range(len(w) - size + 1):
                if w[p : p + size] == x[k : k + size]:
                    hit |= set(range(p, p + size))
                    found.add("null" if name is None else str(name))
    return len(w), len(hit), sorted(found)


def corpus(rng):
    vocabulary = ["Alpha", "beta", "Gamma", "été", "delta9", "x"]
    text = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", "!"]) for _ in range(n))
    items = [(i, text(rng.randint(11, 30))) for i in range(8)]
    items += [(20, "x beta x"), (21, "zeta"), (22, ""), (23, None), (None, text(14)), (3, text(12)), (2, items[0][1])]
    docs = [(i, text(rng.randint(0, 60)), "s") for i in range(40)]
    docs += [(50 + i, text(20) + " " + body + " " + text(5), "s") for i, (_, body) in enumerate(items) if body]
    docs += [(90, None, "s"), (91, "", "s"), (92, "...", "s"), (93, items[1][1], "s"), (93, items[1][1], "s")]
    docs += [(None, items[2][1], "s"), (94, "x beta " * 200, "s"), (95, "x " * 5000 + items[4][1], "s")]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_equals_brute_force(spark, documents, rng, block_bytes):
    docs, items = corpus(rng)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = dc.found_in(documents(docs), benchmark, block_bytes=block_bytes)
    size = F.aggregate("hit_spans", F.lit(0), lambda n, s: n + s["length"])
    got = found.select("doc_id", "n_words", size.alias("n_hit"), "hit_items").collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(repr((d, *brute(t, items))) for d, t, _ in docs)
    kept = dc.clean(documents(docs), benchmark)
    assert kept.columns == documents([]).columns
    assert sorted(map(repr, (r["doc_id"] for r in kept.collect()))) == sorted(
        repr(d) for d, t, _ in docs if not brute(t, items)[1]
    )


def test_pieces_of_a_long_document(rng):
    docs, items = corpus(rng)
    block = dc.Block([(str(i), t.encode()) for i, t in items if t])
    texts = [t.encode() if t is not None else None for _, t, _ in docs]
    whole, cut = dc.search_texts(texts, block), dc.search_texts(texts, block, most=40)
    assert [(dc.joined_spans(a), b) for a, b in whole] == [(dc.joined_spans(a), b) for a, b in cut]


def test_longest_matches(spark, documents, rng):
    docs, items = corpus(rng)
    docs = [d for d in docs if d[0] is not None and d[0] < 94]
    items = [(i, t) for i, t in items[:8]]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["item_id"], r["item_word"]): r for r in dc.longest_matches(documents(docs), benchmark).collect()}
    texts = {d: words(t) for d, t, _ in docs}
    for name, body in items:
        x = words(body)
        for j in range(len(x) - 9):
            best = 0
            for w in texts.values():
                for p in range(len(w)):
                    n = 0
                    while j + n < len(x) and p + n < len(w) and x[j + n] == w[p + n]:
                        n += 1
                    best = max(best, n)
            row = got.get((str(name), j))
            assert (row["n_words"] if row else 0) == (best if best >= 10 else 0)
            if row:
                w, p, n = texts[row["doc_id"]], row["doc_word"], row["n_words"]
                assert w[p : p + n] == x[j : j + n]


def test_empty_sides(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert dc.clean(documents([(1, "a b c", "s")]), none).count() == 1
    assert dc.clean(documents([]), some).count() == 0
