import pytest
from pyspark.sql import functions as F

from perptide.llm import jaccard as jc


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in low.replace("\t", " ").replace("\n", " ").split(" ") if x]
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t, _ in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    out = [None] * len(rows)
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            out[i] = (rows[i][0], len(sets[i]), min(ids) if ids else None)
    return out


def corpus(rng):
    word = lambda: f"w{rng.randint(0, 400)}"
    rows, doc = [], 0
    passage = [word() for _ in range(30)]
    for _ in range(25):
        base = [word() for _ in range(rng.randint(3, 120))]
        if rng.random() < 0.4:
            base += passage
        for _ in range(rng.randint(1, 8)):
            text = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 25)):
                text[rng.randrange(len(text))] = word()
            rows.append((doc, " ".join(text), "s"))
            doc += 1
            base = text if rng.random() < 0.5 else base
    long = [f"v{i}" for i in range(3000)]
    rows += [(doc, " ".join(long), "s"), (doc + 1, " ".join(long[:2600]), "s"), (doc + 2, " ".join(long[:2300]), "s")]
    rows += [(900, None, "s"), (901, "", "s"), (902, " \n", "s"), (903, "One two", "s"), (904, "one  TWO", "s")]
    rows += [(905, "two one", "s"), (None, rows[0][1], "s"), (None, "alone here", "s"), (3, rows[3][1], "s"), (906, "é É", "s")]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(documents, rng, monkeypatch, small):
    if small:  # leaves of four points, frequent tokens from two classes on
        monkeypatch.setattr(jc, "LEAF", 4)
        monkeypatch.setattr(jc, "INNER", 2)
        monkeypatch.setattr(jc, "HOT_SHARE", 20)
    rows = corpus(rng)
    got = jc.component_ids(documents(rows)).collect()
    assert sorted(repr((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got) == sorted(map(repr, brute(rows)))


def test_without_stars_the_tree_finds_all(spark, rng):
    base = rng.sample(range(10**6), 200)
    sets = [sorted({*rng.sample(base, 150), *rng.sample(range(10**6), rng.randint(0, 60))}) for _ in range(60)]
    rows = [
        (token, i, len(s), i, [sum(t % jc.GROUPS == g for t in s) for g in range(jc.GROUPS)])
        for i, s in enumerate(sets) for token in s[: jc.prefix_length(len(s))]
    ]
    points = spark.createDataFrame(rows, "token long, node long, n long, label long, vector array<int>")
    found = {(r["a"], r["b"]) for r in jc.rtree_pairs(points).collect()}
    alike = {
        (i, j) for j in range(60) for i in range(j)
        if 100 * len({*sets[i]} & {*sets[j]}) >= 80 * len({*sets[i]} | {*sets[j]})
    }
    assert alike <= found


def test_calls_that_verify_their_pairs_equal_brute_force(documents, rng, monkeypatch):
    monkeypatch.setattr(jc, "NAMED", 0)
    rows = corpus(rng)
    got = jc.component_ids(documents(rows)).collect()
    assert sorted(repr((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got) == sorted(map(repr, brute(rows)))


def test_what_calls_name_grows_with_the_points(spark, monkeypatch):
    sets = {i: [1, *range(1000 * i + 2, 1000 * i + 11)] for i in range(300)}
    points = spark.createDataFrame(
        [(1, i, 10, i, [10] + [0] * (jc.GROUPS - 1)) for i in sets], "token long, node long, n long, label long, vector array<int>"
    )
    whole, written = spark.createDataFrame(list(sets.items()), "node long, tokens array<long>"), []

    def materialized(df, write=jc.materialized):
        out = write(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(jc, "materialized", materialized)
    monkeypatch.setattr(jc, "_prefix_bound", lambda percent: F.col("n_a"))
    assert jc.rtree_pairs(points).count() == 300 * 299 // 2
    pairs, links = jc.tree_links(points, lambda nodes: whole.join(nodes, "node", "left_semi"))
    assert pairs.count() == 0 and links.count() == 0 and max(written) <= 300


@pytest.mark.parametrize(("few", "named"), [(False, 1), (False, 0), (True, 0)])
def test_links_of_the_tree_join_what_is_alike(spark, rng, monkeypatch, few, named):
    monkeypatch.setattr(jc, "NAMED", named)
    if few:  # sets count as many points, so units are cut into leaves
        monkeypatch.setattr(jc, "LEAF", 64)
        monkeypatch.setattr(jc, "POINT_TOKENS", 16)
    base = rng.sample(range(10**6), 200)
    sets = [sorted({*rng.sample(base, rng.choice([150, 190])), *rng.sample(range(10**6), rng.randint(0, 20))}) for _ in range(60)]
    rows = [
        (token, i, len(s), i, [sum(t % jc.GROUPS == g for t in s) for g in range(jc.GROUPS)])
        for i, s in enumerate(sets) for token in s[: jc.prefix_length(len(s))]
    ]
    points = spark.createDataFrame(rows, "token long, node long, n long, label long, vector array<int>")
    whole = spark.createDataFrame([(i, s) for i, s in enumerate(sets)] * 2, "node long, tokens array<long>")
    pairs, links = jc.tree_links(points, lambda nodes: whole.join(nodes, "node", "left_semi"))
    links = links.union(jc.verified(pairs, whole))
    alike = [
        (i, j) for j in range(60) for i in range(j)
        if 100 * len({*sets[i]} & {*sets[j]}) >= 80 * len({*sets[i]} | {*sets[j]})
    ]
    assert {(r["a"], r["b"]) for r in links.collect()} <= {*alike}
    edges = spark.createDataFrame(alike, "a long, b long")
    labels = lambda found: {(r["node"], r["label"]) for r in jc.components(found).collect()}
    assert alike and labels(links) == labels(edges)


def test_keep_one(documents, rng):
    rows = corpus(rng)
    docs = documents(rows)
    kept = jc.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(repr(r["doc_id"]) for r in kept.collect())
    expected = {repr(c) for _, n, c in brute(rows) if n} | {"900", "901", "902"}
    assert sorted(ids) == sorted(expected)


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 102)], "a long, b long")
    got = {r["node"]: r["label"] for r in jc.components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert jc.components(edges.limit(0)).count() == 0


def test_components_of_a_long_chain(spark, rng):
    names = list({rng.getrandbits(63) - (1 << 62) for _ in range(1000)})
    rng.shuffle(names)
    edges = spark.createDataFrame(list(zip(names[:-1], names[1:])), "a long, b long")
    got = {r["node"]: r["label"] for r in jc.components(edges).collect()}
    assert got == dict.fromkeys(names, min(names))


def test_empty_table(documents):
    assert jc.component_ids(documents([])).count() == 0
    assert jc.keep_one(documents([]).where(F.lit(True))).count() == 0
