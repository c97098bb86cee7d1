import os

import corpus_pipeline
from perptide.llm import decontaminate
from perptide.llm.common import materialized

from .test_decontaminate import brute as brute_hits
from .test_jaccard import brute as brute_components
from .test_line_dedup import brute as brute_lines

SF = os.environ.get("SMOKE_SF_DIR", "/root/testdata/sf0.001")


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    columns, outputs = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        outputs.append(materialized(stage(spark, outputs[-1], SF)))
    for out in outputs[:-1]:
        assert out.columns == columns
    rows = [[(r["doc_id"], r["text"], r["source"]) for r in out.collect()] for out in outputs[:-1]]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r[0] for r in rows[1]}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept for d in good) >= 0.97 * len(good)
    bad = [d for d, q in labels.items() if q == 0]
    assert sum(d in kept for d in bad) <= 0.4 * len(bad)
    cleaned = [(d, t) for d, t in brute_lines(rows[1], 8) if (t or "").strip() or not (dict((a, b) for a, b, _ in rows[1])[d] or "").strip()]
    assert sorted(map(repr, cleaned)) == sorted(repr(r[:2]) for r in rows[2])
    assert all(r["n_chars"] == len(r["text"]) for r in outputs[2].collect())
    groups = brute_components(rows[2])
    assert sorted(r[0] for r in rows[3]) == sorted({c for _, n, c in groups if n} | {d for d, n, _ in groups if not n})
    assert sorted(r[0] for r in rows[4]) == sorted(d for d, t, _ in rows[3] if not brute_hits(t, benchmark, decontaminate.WINDOW)[1])
    assert {r["doc_id"] for r in outputs[5].collect()} == {r[0] for r in rows[4]}


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialized(stage(spark, docs, SF))
        assert docs.count() == 0
