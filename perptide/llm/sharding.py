"""Sharding by balanced label propagation.

Documents hang on hubs (for this engine's query: equal texts share one hub, so a group of n
costs n links and never n * n pairs). Documents start in shards by their rank in a hash
order, with counts at most one apart. In each round, joins bring every linked document the
labels of its hubs, weighted by the neighbours that hold them; it asks to move to the
heaviest; every other round only shards with a tenth of room may be asked for. Quotas keep the counts: as
many move to a shard as leave it or find room there. Whole hubs are let through in hash order
until the quota is used. Documents without links fill the room that is left, so the law ``rows``
holds exactly: counts of shards differ by one at most.

A hub of more than a sixteenth of a shard is let through in parts, so it fills shard by shard.
Back to the driver come counts per pair of shards and hash bucket, at most
``shards ** 2 * BUCKETS`` numbers, however many documents there are.

Defined results
* A NULL text has size 1, checksum NULL and no link; equal empty texts are linked.
* Repeated rows are documents of their own (with equal texts, so linked).
* Fewer documents than shards leave shards empty. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perptide.llm.common import left_by, materialized, numbered

SHARDS = 8
ROUNDS = 8
BUCKETS = 1024


def hubs(links: DataFrame, most: int) -> DataFrame:
    """(node, hub, part) of the hubs with at least two nodes; parts hold about ``most`` nodes."""
    sizes = links.groupBy("hub").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / F.lit(max(1, most)))
    return links.join(sizes, "hub").select("node", "hub", F.pmod(F.xxhash64("node"), parts).cast("int").alias("part"))


def wishes(linked: DataFrame, labels: DataFrame, turn: int, open_shards: list[int]) -> DataFrame:
    """(node, shard, target, bucket): nodes that more neighbours await in the open shards than in their own.

    Of equal weights a hash of hub, shard and ``turn`` decides, so ties do not crowd one shard.
    """
    placed = linked.join(labels, "node")
    counts = placed.groupBy("hub", "shard").agg(F.count("*").alias("n"))
    order = F.struct("n", F.xxhash64("hub", "shard", F.lit(turn)))
    heaviest = counts.where(F.col("shard").isin(open_shards)).groupBy("hub").agg(
        F.max_by("shard", order).alias("label"), F.max("n").alias("weight")
    )
    votes = (
        placed.join(counts.withColumnRenamed("n", "own"), ["hub", "shard"])
        .join(heaviest, "hub")
        .groupBy("node", "shard", "label")
        .agg(F.sum("weight").alias("weight"), F.sum("own").alias("own"), F.min(F.xxhash64("hub", "part")).alias("first"))
    )
    best = votes.groupBy("node", "shard").agg(
        F.max(F.struct("weight", "first", "label")).alias("best"), F.sum("own").alias("own")
    )
    return best.select(
        "node", "shard", F.col("best.label").alias("target"), F.pmod("best.first", F.lit(BUCKETS)).alias("bucket")
    ).where((F.col("target") != F.col("shard")) & (F.col("best.weight") >= F.col("own")))


def admitted(flows: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Per pair of shards the number of leading buckets whose nodes together stay in the quota."""
    return (np.cumsum(flows, axis=2) <= allowed[:, :, None]).sum(axis=2)


def quotas(flows: np.ndarray, held: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Moves allowed from shard i to j, so that no shard ends above its room.

    ``flows[i, j]`` nodes by bucket ask to go from i to j, ``held`` linked nodes are in a shard and
    ``room`` is the most that it may hold. All wishes are allowed at first, so that swaps and
    cycles go through together; as long as whole buckets would leave a shard too full, its
    largest inflows are cut. Without moves no shard is too full, so this ends.
    """
    allowed = flows.sum(axis=2)
    while True:
        limits = admitted(flows, allowed)
        through = np.where(np.arange(flows.shape[2]) < limits[:, :, None], flows, 0).sum(axis=2)
        above = held - through.sum(axis=1) + through.sum(axis=0) - room
        if (above <= 0).all():
            return allowed
        for j in np.flatnonzero(above > 0):
            over = above[j]
            for i in np.argsort(-through[:, j]):
                cut = min(over, through[i, j])
                allowed[i, j], over = through[i, j] - cut, over - cut


def propagate(links: DataFrame, nodes: int, shards: int = SHARDS, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(node, shard) of the linked nodes, and how many of them each shard holds.

    Nodes are numbered from 0 without gaps, and node n starts in shard n % shards.
    """
    spark = links.sparkSession
    room = np.array([(nodes - j + shards - 1) // shards for j in range(shards)])
    linked = materialized(hubs(links, nodes // shards // 16))
    labels = linked.select("node").distinct().withColumn("shard", (F.col("node") % shards).cast("int"))
    labels = materialized(labels)
    for turn in range(rounds):
        held = np.zeros(shards, np.int64)
        for r in labels.groupBy("shard").agg(F.count("*").alias("n")).collect():
            held[r["shard"]] = r["n"]
        free = [j for j in range(shards) if turn % 2 == 0 or held[j] < 0.9 * room[j]]
        wish = materialized(wishes(linked, labels, turn, free))
        flows = np.zeros((shards, shards, BUCKETS), np.int64)
        for r in wish.groupBy("shard", "target", "bucket").agg(F.count("*").alias("n")).collect():
            flows[r["shard"], r["target"], r["bucket"]] = r["n"]
        limits = admitted(flows, quotas(flows, held, room))
        moved = sum(int(flows[i, j, : limits[i, j]].sum()) for i in range(shards) for j in range(shards))
        if not flows.any() and len(free) == shards:
            break
        if not moved:
            continue
        rows = [(i, j, int(limits[i, j])) for i in range(shards) for j in range(shards)]
        gate = F.broadcast(spark.createDataFrame(rows, "shard int, target int, upto int"))
        moves = wish.join(gate, ["shard", "target"]).where(F.col("bucket") < F.col("upto")).select("node", "target")
        labels = materialized(
            labels.join(moves, "node", "left").select("node", F.coalesce("target", "shard").alias("shard"))
        )
    held = np.zeros(shards, np.int64)
    for r in labels.groupBy("shard").agg(F.count("*").alias("n")).collect():
        held[r["shard"]] = r["n"]
    return labels, room - held


def text_hub(text: Column) -> Column:
    """Identity of a text; NULL for a NULL text."""
    return F.when(text.isNotNull(), F.struct(F.xxhash64(text), F.crc32(text.cast("binary")), F.octet_length(text)))


def shard(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document; equal texts are linked."""
    body = F.col(text)
    facts = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        text_hub(body).alias("hub"),
    )
    facts = materialized(numbered(materialized(facts), "node", [], ["doc_id", "size", "text_crc32", "hub"]))
    nodes = facts.count()
    labels, left = propagate(facts.where("hub IS NOT NULL").select("node", "hub"), nodes, shards)
    joined = left_by(facts.drop("hub"), labels, ["node"])
    loose = materialized(numbered(materialized(joined.where("shard IS NULL").drop("shard")), "place", [], ["node"]))
    ends = np.cumsum(left)
    where = F.lit(shards - 1)
    for j in reversed(range(shards - 1)):
        where = F.when(F.col("place") < int(ends[j]), j).otherwise(where)
    filled = loose.withColumn("shard", where).drop("place")
    whole = materialized(joined.where("shard IS NOT NULL").unionByName(filled))
    return numbered(whole, "slot", ["shard"], ["node"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def cut_links(labels: DataFrame, links: DataFrame) -> DataFrame:
    """One row: pairs of linked nodes in one hub, and those of them in different shards."""
    counts = links.join(labels, "node").groupBy("hub", "shard").agg(F.count("*").alias("n"))
    hub = counts.groupBy("hub").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same"))
    return hub.agg(
        F.sum(F.col("n") * (F.col("n") - 1) / 2).cast("long").alias("pairs"),
        F.sum((F.col("n") * F.col("n") - F.col("same")) / 2).cast("long").alias("cut"),
    )
