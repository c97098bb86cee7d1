import zlib

import pytest
from pyspark.sql import functions as F

from perptide.llm import sharding


def check(rows, got):
    facts = lambda d, t: (d, len((t or "").encode()) + 1, zlib.crc32(t.encode()) if t is not None else None)
    assert sorted(map(repr, ((r["doc_id"], r["size"], r["text_crc32"]) for r in got))) == sorted(
        repr(facts(d, t)) for d, t, _ in rows
    )
    counts = [sum(r["shard"] == j for r in got) for j in range(8)]
    assert max(counts) - min(counts) <= 1
    for j in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == j) == list(range(counts[j]))
    assert all(r["grown_shard"] is None and r["law"] == "rows" for r in got)


@pytest.mark.parametrize(("texts", "most_split"), [(150, 0.2), (900, 0.0)])
def test_law_and_groups(documents, rng, texts, most_split):
    """With 150 texts nearly every document is linked, so room is short and some groups stay split."""
    rows = [(i, f"text {rng.randint(0, texts)}", "s") for i in range(400)]
    rows += [(1000 + i, None, "s") for i in range(9)] + [(None, "text 1", "s"), (7, "text 7", "s"), (7, "text 7", "s")]
    got = sharding.shard(documents(rows)).collect()
    check(rows, got)
    home = {}
    for r in got:
        if r["text_crc32"] is not None:
            home.setdefault(r["text_crc32"], set()).add(r["shard"])
    split = sum(len(s) > 1 for s in home.values())
    assert split <= most_split * len(home)


def test_group_larger_than_a_shard(documents):
    rows = [(i, "same" if i < 200 else f"t{i}", "s") for i in range(400)]
    got = sharding.shard(documents(rows)).collect()
    check(rows, got)
    assert len({r["shard"] for r in got if r["text_crc32"] == zlib.crc32(b"same")}) <= 6


def test_small_and_empty(documents):
    check([(1, "a", "s")], sharding.shard(documents([(1, "a", "s")])).collect())
    assert sharding.shard(documents([])).count() == 0


def test_propagation_lowers_the_cut(spark, rng):
    pairs = [(n, n // 40 * 3 + rng.randint(0, 2)) for n in range(800) for _ in range(2)]
    links = spark.createDataFrame(sorted(set(pairs)), "node long, hub long").withColumn("hub", F.col("hub"))
    labels, room = sharding.propagate(links, 1000, 8)
    start = labels.select("node", (F.col("node") % 8).cast("int").alias("shard"))
    before, after = sharding.cut_links(start, links).collect()[0], sharding.cut_links(labels, links).collect()[0]
    assert after["cut"] < 0.5 * before["cut"] and (room >= 0).all()
