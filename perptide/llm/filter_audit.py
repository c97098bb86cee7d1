"""Filter interaction audit: what every filter does in every order of the filters.

A document is the set of the filters it fails, so a table is a count for each set. The sets of
filters already applied are the states of a subset lattice, and applying one more filter is an
edge; an order of the filters is a path from the empty state to the full one. Forward counts
say how many orders reach a state, backward counts how many lead on from it, and their
product how many orders run along an edge. So the work is one pass over the documents and
one count for each edge: the removals of an edge, weighted by its orders, add up to the Shapley
value, and the steps of each order are read from the edges of its path.

Everything is native: texts are read once and never shuffled. A document leaves its row as a digest of
its text, its identifier and a few bits; copies of one text, a source's rows and repeated rows are
added up before the shuffle, so neither a hot source nor a large group of copies meets in one task.
The lattice of k filters has k * 2^(k-1) edges and k! orders; it is a constant of the plan.

Defined results
* NULL text counts as empty, a NULL source as the empty string; NULL and empty texts are copies of each other.
* An empty text fails A (no words) and none of B, C, D. Whole texts of any length are read.
* Of documents with equal texts those of the smallest identifier are no copies, repeated rows of
  it included; a row without identifier is no copy and makes none.
* Of several label rows of one document each says good, or toxic, for it; rows without identifier label none.
* An empty table gives an empty result. Only the named columns are read, whatever else a table holds.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The filters of the query, by bit.
FILTERS = "ABCDE"
COPY = "E"

_SPACES = " \t\n\x0b\f\r"
_SPACE_RUN = r"[\x20\x09-\x0D]+"


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions that a text decides alone: few words, repetitive, capitals, marks."""
    trimmed = F.btrim(text, F.lit(_SPACES))
    words = F.split(trimmed, _SPACE_RUN)
    n_words = F.when(trimmed == "", 0).otherwise(F.size(words))
    distinct = F.when(trimmed == "", 0).otherwise(F.size(F.array_distinct(words)))
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n_words < 50,
        "B": F.lit(100).cast("long") * distinct < F.lit(65).cast("long") * n_words,
        "C": F.lit(100).cast("long") * capitals > F.lit(5).cast("long") * F.char_length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def bits_of(failures: dict[str, Column], filters: str = FILTERS) -> Column:
    """The failed filters as a number; the filter at place i is worth 2^i."""
    worth = [F.when(failed, 1 << filters.index(name)).otherwise(0) for name, failed in failures.items()]
    return reduce(Column.bitwiseOR, worth)


def counts(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source",
    good: str = "quality", toxic: str = "toxic",
) -> DataFrame:
    """(part, failed, good, toxic, n): the documents of each part by the set of filters they fail."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("digest"),
        bits_of(text_failures(whole)).alias("failed"),
    )
    marks = (
        labels.where(F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("id"))
        .agg(F.max(F.col(good) == 1).alias("good"), F.max(F.col(toxic) == 1).alias("toxic"))
    )
    no = F.lit(False)
    marked = rows.join(marks, "id", "left").withColumns(
        {"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)}
    )
    kinds = ["digest", "part", "failed", "good", "toxic"]
    by_id = marked.groupBy("id", *kinds).agg(F.count("*").alias("n"))
    named = F.col("id").isNotNull()
    kept = by_id.groupBy(*kinds).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(~named, F.col("n")).otherwise(0)).alias("nameless"),
        F.min(F.when(named, F.struct("id", "n"))).alias("first"),
    )
    least = kept.groupBy("digest").agg(F.min("first.id").alias("least"))
    at_least = F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    told = kept.join(least, "digest").withColumn("originals", F.col("nameless") + at_least)
    copy = 1 << FILTERS.index(COPY)
    both = F.array(
        F.struct(F.col("failed").alias("failed"), F.col("originals").alias("n")),
        F.struct(F.col("failed").bitwiseOR(F.lit(copy)).alias("failed"), (F.col("n") - F.col("originals")).alias("n")),
    )
    return (
        told.select("part", "good", "toxic", F.inline(both))
        .where(F.col("n") > 0)
        .groupBy("part", "failed", "good", "toxic")
        .agg(F.sum("n").alias("n"))
    )


def path_counts(k: int) -> tuple[list[int], list[int]]:
    """Of each state of the lattice: the orders that reach it, and those that lead from it to the full state."""
    full = (1 << k) - 1
    reaching, leaving = [1] + [0] * full, [0] * full + [1]
    for state in range(1, full + 1):
        reaching[state] = sum(reaching[state ^ 1 << f] for f in range(k) if state >> f & 1)
    for state in reversed(range(full)):
        leaving[state] = sum(leaving[state | 1 << f] for f in range(k) if not state >> f & 1)
    return reaching, leaving


def edges(filters: str = FILTERS) -> list[dict]:
    """Every edge: the state before it, its filter's bit, its weight, and the orders that run along it."""
    k = len(filters)
    reaching, leaving = path_counts(k)
    found = {
        (state, 1 << f): {"before": state, "bit": 1 << f, "weight": reaching[state] * leaving[state | 1 << f], "orders": []}
        for state in range(1 << k)
        for f in range(k)
        if not state >> f & 1
    }
    for order in permutations(filters):
        state = 0
        for name in order:
            bit = 1 << filters.index(name)
            found[state, bit]["orders"].append("".join(order))
            state |= bit
    return list(found.values())


def audit(table: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row for each part, order and step from ``counts``: what the step's filter does there."""
    lattice = edges(filters)
    failed, n, before, bit = F.col("failed"), F.col("n"), F.col("edge.before"), F.col("edge.bit")
    fails = failed.bitwiseAND(bit) != 0
    gone = failed.bitwiseAND(before) != 0
    removed = fails & ~gone

    def total(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, n).otherwise(0)).cast("long").alias(name)

    plain = [F.struct(F.lit(e["before"]).alias("before"), F.lit(e["bit"]).alias("bit")) for e in lattice]
    # Every state set meets every edge of the constant lattice, so zeros are there as well.
    on_edges = (
        table.select("part", "failed", "good", "toxic", "n", F.posexplode(F.array(*plain)).alias("number", "edge"))
        .groupBy("part", "number")
        .agg(
            total(~fails & ~gone, "kept"),
            total(removed, "removed"),
            total(fails & gone, "redundant"),
            total(failed == bit, "unique_fails"),
            total(removed & F.col("good"), "good_lost"),
            total(removed & F.col("toxic"), "toxic_lost"),
        )
    )

    def of_edge(key: str) -> Column:
        values = [F.array(*map(F.lit, e[key])) if key == "orders" else F.lit(e[key]) for e in lattice]
        return F.array(*values)[F.col("number")]

    value = F.sum(F.col("weight") * F.col("removed")).over(Window.partitionBy("part", "bit"))
    measures = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    return (
        on_edges.withColumns({"weight": of_edge("weight").cast("long"), "bit": of_edge("bit")})
        .withColumn("shapley", value.cast("long"))
        .select(
            "part",
            F.explode(of_edge("orders")).alias("filter_order"),
            (F.bit_count(of_edge("before")) + 1).cast("int").alias("step"),
            *measures,
            "shapley",
        )
    )
