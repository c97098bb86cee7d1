"""SQL twins of the queries of this folder, for DuckDB over the same tables."""

from __future__ import annotations

from perptide.llm import decontaminate, licenses, line_dedup, url_filter
from perptide.llm.license_texts import EQUIVALENT_SPELLINGS, KNOWN_TEXTS

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(x: str) -> str:
    return f"translate({x}, '{UPPER}', '{UPPER.lower()}')"


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


LINE_DEDUP = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, text, coalesce(source, '') AS site FROM documents
), line AS (
  SELECT r, doc_id, site, pos, l, regexp_replace(l, '^[ \t\r]+|[ \t\r]+$', '', 'g') AS k FROM (
    SELECT r, doc_id, site, unnest(string_split(text, chr(10))) AS l,
           generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM doc)
), spread AS (
  SELECT k, count(DISTINCT site) AS sites, min(doc_id) AS first_doc FROM line WHERE k <> '' GROUP BY k
), place AS (
  SELECT s.k, s.first_doc, min(l.pos) AS first_at
  FROM spread s JOIN line l ON l.k = s.k AND l.doc_id = s.first_doc
  WHERE s.sites >= {line_dedup.MIN_SITES} GROUP BY s.k, s.first_doc
), marked AS (
  SELECT l.*, p.k IS NOT NULL AND NOT (l.doc_id = p.first_doc AND l.pos = p.first_at) AS gone
  FROM line l LEFT JOIN place p ON l.k = p.k
), kept AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
         coalesce(string_agg(l, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
  FROM marked GROUP BY r
)
SELECT doc.doc_id, coalesce(kept.n_lines, 0)::BIGINT AS n_lines, coalesce(kept.n_removed, 0)::BIGINT AS n_removed,
       strlen(kept.text)::BIGINT AS kept_bytes, md5(kept.text) AS kept_md5
FROM doc LEFT JOIN kept USING (r)
"""

_SITES = [(*rule, url_filter.site_rule(*rule)[4]) for rule in url_filter.SITE_RULES]
_SITE_CASES = "\n".join(
    f"    SELECT {quoted(n)} AS rule, {quoted(v)} AS verdict, {quoted(x)} AS regex UNION ALL" for n, v, x in _SITES
).removesuffix("UNION ALL")
_PATTERNS = "\n".join(
    f"    SELECT {quoted(n)} AS pattern, {quoted(v)} AS verdict, {quoted(x)} AS regex UNION ALL"
    for n, v, x, _ in url_filter.PATTERN_RULES
).removesuffix("UNION ALL")

URL_FILTER = rf"""
WITH site_rule AS (
{_SITE_CASES}
), pattern_rule AS (
{_PATTERNS}
), cut AS (
  SELECT row_number() OVER () AS r, page_id, url,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), page AS (
  SELECT r, page_id, url, {lowered("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), by_site AS (
  SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM page JOIN site_rule ON regexp_matches(host || path, regex) GROUP BY r
), by_pattern AS (
  SELECT r, pattern, p.verdict FROM page JOIN pattern_rule p ON regexp_matches({lowered("url")}, regex)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(pattern) DESC, pattern) = 1
)
SELECT page_id, host, path, s.rule, coalesce(s.verdict, p.verdict, 'allow') AS verdict,
       CASE WHEN s.rule IS NULL THEN p.pattern END AS pattern
FROM page LEFT JOIN by_site s USING (r) LEFT JOIN by_pattern p USING (r)
"""


def _canonical(x: str) -> str:
    y = f"regexp_replace(lower({x}), {quoted(licenses.COPYRIGHT_LINE)}, ' ', 'g')"
    y = f"' ' || trim(regexp_replace({y}, {quoted(licenses.PUNCTUATION)}, ' ', 'g'), ' ') || ' '"
    for a, b in EQUIVALENT_SPELLINGS:
        y = f"replace({y}, {quoted(a)}, {quoted(b)})"
    return f"trim({y}, ' ')"


def _digest(x: str) -> str:
    return f"CASE WHEN {_canonical(x)} <> '' THEN sha256({_canonical(x)}) END"


_KNOWN = " UNION ALL ".join(f"SELECT {quoted(n)} AS license, {quoted(t)} AS text" for n, t in KNOWN_TEXTS)

LICENSES = rf"""
WITH known AS (
  SELECT {_digest("text")} AS digest, min(license) AS license FROM ({_KNOWN}) GROUP BY 1
), doc AS (
  SELECT row_number() OVER () AS r, doc_id, text, {_digest("text")} AS digest FROM documents
), line AS (
  SELECT r, {_digest("l")} AS digest FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM doc)
), found AS (
  SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses, count(*) AS license_lines
  FROM line JOIN known USING (digest) GROUP BY r
)
SELECT doc.doc_id, known.license, coalesce(found.line_licenses, '') AS line_licenses,
       coalesce(found.license_lines, 0)::BIGINT AS license_lines
FROM doc LEFT JOIN known USING (digest) LEFT JOIN found USING (r)
"""


def _words(x: str) -> str:
    return rf"coalesce(regexp_extract_all({lowered(x)}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"


DECONTAMINATION = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS w FROM documents
), item AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item, w, least({decontaminate.WINDOW}, len(w)) AS n
  FROM (SELECT item_id, {_words("text")} AS w FROM benchmark) WHERE len(w) > 0
), item_window AS (
  SELECT DISTINCT item, n, array_to_string(w[p : p + n - 1], ' ') AS k
  FROM (SELECT item, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM item)
), doc_window AS (
  SELECT r, p, n, array_to_string(w[p : p + n - 1], ' ') AS k
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM doc, (SELECT DISTINCT n FROM item_window))
), found AS (
  SELECT r, p, n, item FROM doc_window JOIN item_window USING (n, k)
), hit AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM found) GROUP BY r
), named AS (
  SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM found GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""


TOP_K = """
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), q AS (
  SELECT vec_id AS query_id, min(e) AS e FROM v WHERE vec_id % 100 = 0 GROUP BY vec_id
), scored AS (
  SELECT query_id, vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
  FROM q JOIN v ON vec_id <> query_id AND len(q.e) = len(v.e)
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10
"""

JACCARD = rf"""
WITH RECURSIVE doc AS MATERIALIZED (
  SELECT doc_id, coalesce(regexp_extract_all({lowered("text")}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), shingle AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + least(5, len(w)) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS p FROM doc WHERE len(w) > 0)
), size AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), overlap AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o
  FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), link AS MATERIALIZED (
  SELECT a, b FROM overlap JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * o >= 80 * (x.n + y.n - o)
), reach AS (
  SELECT a, b FROM link
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), least AS (
  SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a
)
SELECT doc.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc.doc_id, coalesce(m, doc.doc_id)) AS component_id
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN least USING (doc_id)
"""

FILTER_AUDIT = r"""
WITH doc AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), seen AS (
  SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY t) AS first_id
  FROM doc
), mark AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), fail AS (
  SELECT s.part, coalesce(m.good, false) AS good, coalesce(m.toxic, false) AS toxic,
         concat(
           CASE WHEN len(words) < 50 THEN 'A' ELSE '' END,
           CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END,
           CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END,
           CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
           CASE WHEN s.doc_id > first_id THEN 'E' ELSE '' END) AS fails
  FROM seen s LEFT JOIN mark m ON s.doc_id = m.doc_id
), state AS (
  SELECT part, good, toxic, fails, count(*) AS n FROM fail GROUP BY ALL
), letter AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), ordering AS (
  SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), placed AS (
  SELECT o.filter_order, s.*,
         coalesce(list_min([instr(o.filter_order, f) FOR f IN string_split(s.fails, '') IF f <> '']), 6) AS gone_at
  FROM ordering o, state s
), stepped AS (
  SELECT p.*, g.step, contains(p.fails, substr(p.filter_order, g.step, 1)) AS failing,
         substr(p.filter_order, g.step, 1) AS filter
  FROM placed p, (SELECT unnest(range(1, 6)) AS step) g
), summed AS (
  SELECT part, filter_order, step, filter,
         coalesce(sum(n) FILTER (WHERE gone_at > step), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (WHERE gone_at = step), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE failing AND gone_at < step), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (WHERE fails = filter), 0)::BIGINT AS unique_fails,
         coalesce(sum(n) FILTER (WHERE gone_at = step AND good), 0)::BIGINT AS good_lost,
         coalesce(sum(n) FILTER (WHERE gone_at = step AND toxic), 0)::BIGINT AS toxic_lost
  FROM stepped GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley
FROM summed
"""
