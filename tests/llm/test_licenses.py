from perptide.llm import licenses
from perptide.llm.license_texts import KNOWN_TEXTS


def test_variants_and_edges(spark, documents):
    mit = KNOWN_TEXTS[0][1]
    rows = [
        (1, mit, "s"), (2, "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace('"', "“"), "s"),
        (3, mit + " and more", "s"), (4, None, "s"), (5, "", "s"), (6, "Copyright 2020 me", "s"),
        (7, "prose\nreleased under the MIT licence\nSPDX-License-Identifier:  isc", "s"), (7, "prose\nreleased under the MIT licence\nSPDX-License-Identifier:  isc", "s"),
        (None, "Licensed under CC BY-NC 4.0.", "s"), (8, "word " * 50000, "s"),
        (9, mit.replace("sublicense", "sub-license"), "s"),
    ]
    docs = documents(rows)
    got = licenses.scan(docs, licenses.known_digests(spark))
    assert got.columns[: len(docs.columns)] == docs.columns
    found = [(r["doc_id"], r["license"], r["line_licenses"], r["license_lines"]) for r in got.collect()]
    none = lambda i: (i, None, [], 0)
    expected = [
        (1, "MIT", [], 0), (2, "MIT", [], 0), none(3), none(4), none(5), none(6),
        (7, None, ["ISC", "MIT"], 2), (7, None, ["ISC", "MIT"], 2),
        (None, "CC-BY-NC-4.0", ["CC-BY-NC-4.0"], 1), none(8), (9, "MIT", [], 0),
    ]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_empty_sides(spark, documents):
    known = licenses.known_digests(spark)
    assert licenses.scan(documents([]), known).count() == 0
    assert [r["license"] for r in licenses.scan(documents([(1, "MIT", "s")]), known.limit(0)).collect()] == [None]


def test_each_known_text_is_found(spark, documents):
    docs = documents([(i, text, "s") for i, (_, text) in enumerate(KNOWN_TEXTS)])
    got = {r["doc_id"]: r["license"] for r in licenses.scan(docs, licenses.known_digests(spark)).collect()}
    assert got == {i: name for i, (name, _) in enumerate(KNOWN_TEXTS)}
