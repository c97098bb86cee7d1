from pyspark.sql import functions as F

from perptide.llm import quality


def test_learns_and_scores(spark, documents, rng):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    good = lambda: " ".join(word() for _ in range(rng.randint(5, 60))) + "."
    bad = lambda: " ".join(word().upper() + "!!" for _ in range(rng.randint(5, 60)))
    rows = [(i, good() if i % 3 else bad(), "s") for i in range(400)]
    rows += [(900, None, "s"), (901, "", "s"), (None, good(), "s"), (5, rows[5][1], "s")]
    docs = documents(rows)
    labels = spark.createDataFrame(
        [(i, int(i % 3 > 0), 0) for i in range(400)] + [(None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int"
    )
    weights = quality.train(quality.examples(docs, labels, F.col("doc_id") % 5 != 0))
    got = quality.scored(docs, weights, score="quality").collect()
    assert len(got) == len(rows)
    held = [(r["doc_id"] % 3 > 0, r["quality"]) for r in got if r["doc_id"] is not None and r["doc_id"] < 400 and r["doc_id"] % 5 == 0]
    assert all((score >= quality.THRESHOLD) == label for label, score in held)
    blank = {r["quality"] for r in got if not r["text"]}
    assert len(blank) == 1 and 0 <= blank.pop() <= 1
    kept = quality.filtered(docs, weights)
    assert kept.columns == docs.columns and 0 < kept.count() < len(rows)


def test_without_examples(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    docs = documents([(1, "some text", "s")])
    weights = quality.train(quality.examples(docs, labels, F.lit(True)))
    assert [r["p"] for r in quality.scored(docs, weights, score="p").collect()] == [0.5]
    assert quality.scored(documents([]), weights).count() == 0
