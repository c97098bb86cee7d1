import re

from perptide.llm import url_filter as uf


def brute(url):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule, verdict in uf.SITE_RULES:
        domain, _, tail = rule.partition("/")
        if (low == domain or low.endswith("." + domain)) and path.startswith("/" + tail):
            fits.append((len(rule), rule, verdict))
    if fits:
        return low, path, max(fits)[1], max(fits)[2]
    found = [v for _, v, x, _ in uf.PATTERN_RULES if url is not None and re.search(x, url.lower())]
    return low, path, None, found[0] if found else "allow"


URLS = [
    None, "", "no scheme", "://", "http://example.org", "http://example.org/", "HTTP://WWW.Example.ORG/es/1",
    "http://example.org/es", "http://example.org/en/123?x=/es/", "http://a.b.com/fr/x#y", "http://com/fr/", "http://xcom/fr/",
    "http://shop.com/de/", "http://shop.com/DE/", "http://user@example.org:80/es/", "http://spam-farm.net/", "http://x.net/wp-admin",
    "http://x.net/cgi-bin/a", "http://x.net/login", "http://x.net/loginx", "viagra", "http://cheap-pills.com/fr/1", "http://évil.org/ñ?#",
    "http://a.org/" + "x" * 20000, "http://x.net?q=://y.org/", "http://x.net/?porn", "http://x.net/porno",
]


def test_equals_brute_force(spark):
    rows = [(i, u, "h", "p", "t") for i, u in enumerate(URLS * 2)] + [(None, URLS[6], "h", "p", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, path string, token string")
    got = uf.judge(pages, uf.standing_rules(spark)).collect()
    assert len(got) == len(rows)
    for r in got:
        rule = r["rule"] if r["tier"] == 0 else None
        assert (r["_host"], r["_path"], rule, r["verdict"]) == brute(r["url"]), r["url"]
        assert r["host"] == "h"


def test_rarest_token_and_empty_sides(spark):
    pages = spark.createDataFrame([(1, "http://a.com/de/"), (2, "http://b.com/fr/")], "page_id long, url string")
    rules = uf.standing_rules(spark)
    index = {r["name"]: r["token"] for r in uf.rule_index(pages.select("url"), rules).collect()}
    assert index["com/de/"] == "de" and index["login-page"] == "" and index["example.org/en/1"] in ("en", "example", "org")
    assert uf.judge(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in uf.judge(pages, rules.limit(0)).collect()} == {"allow"}
