from collections import defaultdict

from perptide.llm.line_dedup import dedup_lines


def brute(rows, least):
    sites, first = defaultdict(set), {}
    for doc, text, site in rows:
        for at, line in enumerate((text or "").split("\n")):
            key = line.strip(" \t\r")
            if key:
                sites[key].add(site)
                place = (doc is not None, doc or 0, at)
                first[key] = min(first.get(key, place), place)
    out = []
    for doc, text, _ in rows:
        kept = None
        if text is not None:
            kept = "\n".join(
                line for at, line in enumerate(text.split("\n"))
                if len(sites[line.strip(" \t\r")]) < least or first[line.strip(" \t\r")] == (doc is not None, doc or 0, at)
            )
        out.append((doc, kept))
    return out


def test_equals_brute_force(documents, rng):
    lines = [f"line {i}" for i in range(12)] + ["", "  ", " padded\t"]
    rows = [
        (i, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 9))), rng.choice(["a", "b", "c", "d", None]))
        for i in range(60)
    ]
    rows += [(100, None, "a"), (101, "", "b"), (None, "line 1\nonly here", "c"), (102, "x\n" * 3000 + "line 2", "d")]
    docs = documents(rows)
    for least in (2, 3, 5):
        got = dedup_lines(docs, min_sites=least)
        assert got.columns == docs.columns
        found = sorted([(r["doc_id"], r["text"]) for r in got.collect()], key=repr)
        assert found == sorted(brute(rows, least), key=repr)


def test_repeated_rows_and_emptied_documents(documents):
    rows = [(1, "shared", "a"), (1, "shared", "a"), (2, "shared", "b"), (3, "", "a"), (4, None, "a")]
    got = dedup_lines(documents(rows), min_sites=2, drop_emptied=True, report=("n_lines", "n_removed")).collect()
    assert sorted((r["doc_id"], r["text"] or "", r["n_removed"]) for r in got) == [
        (1, "shared", 0), (1, "shared", 0), (3, "", 0), (4, "", 0),
    ]


def test_empty_table(documents):
    assert dedup_lines(documents([])).count() == 0
