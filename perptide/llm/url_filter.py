"""URL filter: pattern rules indexed by their rarest literal token.

A rule is a regular expression together with literal tokens that every URL it matches
must hold as whole tokens (runs of a-z and 0-9 of the lower-cased URL). The rule is
filed under the rarest of them, by the number of URLs that hold it. The tokens of a
URL fetch the rules filed under them, and only those expressions run.

Defined results
* A NULL URL, or one without ``://``, has an empty host and an empty path; pattern rules
  still see its text (NULL: no rule fits).
* A rule without a literal token is a candidate for every URL.
* Of several fitting rules the one of the smallest ``tier`` wins, then the longest
  ``name``, then the smallest ``name``. No fitting rule: ``rule`` NULL and the default verdict.
* Equal URLs get equal verdicts; repeated rows stay, other columns of the table are kept.
* An empty table gives an empty result; without rules every URL gets the default.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perptide.llm.common import ascii_lower, fresh

_RULE_SCHEMA = "name string, verdict string, tier int, subject string, regex string, tokens array<string>"

# Host and path rules of the standing policy.
SITE_RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)

#: (name, verdict, expression on the lower-cased URL, literal tokens of every match)
PATTERN_RULES = (
    ("spam-host", "block", r"://([^/?#]*[.-])?spam([.-]|[/?#:]|$)", ("spam",)),
    ("cheap-pills", "block", r"://([^/?#]*[.-])?cheap[.-]?pills([.-]|[/?#:]|$)", ("pills", "cheap")),
    ("cheappills", "block", r"://([^/?#]*[.-])?cheappills([.-]|[/?#:]|$)", ("cheappills",)),
    ("casino-host", "block", r"://([^/?#]*[.-])?casino([.-]|[/?#:]|$)", ("casino",)),
    ("poker-host", "block", r"://([^/?#]*[.-])?poker([.-]|[/?#:]|$)", ("poker",)),
    ("viagra", "block", r"(^|[^a-z0-9])viagra([^a-z0-9]|$)", ("viagra",)),
    ("porn", "block", r"(^|[^a-z0-9])porn([^a-z0-9]|$)", ("porn",)),
    ("xxx", "block", r"(^|[^a-z0-9])xxx([^a-z0-9]|$)", ("xxx",)),
    ("login-page", "block", r"/(login|signin)([/?#.]|$)", ()),
    ("wp-admin", "block", r"/wp-admin([/?#]|$)", ("wp", "admin")),
    ("cgi-bin", "block", r"/cgi-bin/", ("cgi", "bin")),
)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def site_rule(name: str, verdict: str, tier: int = 0) -> tuple:
    """A rule for a host, its subdomains and every path that starts with the rule's.

    Its tokens are those of the host and of the path's closed segments; an open last
    segment may go on in the URL, so it is no whole token.
    """
    domain, slash, rest = name.partition("/")
    closed = rest.rpartition("/")[0]
    tokens = sorted(set(re.findall("[a-z0-9]+", f"{domain}/{closed}".lower())))
    expression = rf"^(?:[^/]*\.)?{re.escape(domain.lower())}{re.escape(slash + rest)}"
    return name, verdict, tier, "site", expression, tokens


def standing_rules(spark: SparkSession) -> DataFrame:
    rows = [site_rule(*rule) for rule in SITE_RULES]
    rows += [(name, verdict, 1, "url", regex, list(tokens)) for name, verdict, regex, tokens in PATTERN_RULES]
    return spark.createDataFrame(rows, _RULE_SCHEMA)


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL, and the empty token under which rules without a literal are filed."""
    found = F.regexp_extract_all(ascii_lower(F.coalesce(url, F.lit(""))), F.lit("([a-z0-9]+)"), 1)
    return F.array_distinct(F.array_append(found, F.lit("")))


def rule_index(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``rules`` with ``token``, the rarest literal of each over all rows of ``urls`` (column url)."""
    literals = rules.select("name", F.explode_outer("tokens").alias("token")).fillna("", ["token"])
    wanted = literals.select("token").distinct()
    frequency = (
        urls.select(F.explode(tokens(F.col("url"))).alias("token"))
        .join(wanted, "token", "left_semi")
        .groupBy("token")
        .agg(F.count("*").alias("urls"))
    )
    rarest = (
        literals.join(frequency, "token", "left")
        .groupBy("name")
        .agg(F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token")).alias("best"))
        .select("name", F.col("best.token").alias("token"))
    )
    return rules.join(rarest, "name")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule, tier and verdict of its column ``url``.

    Columns of the same names that ``pages`` has already stay, and the new ones get a leading underscore.

    Shuffles URLs only, and only candidate rules are tested. The rule index is joined on
    the token: Spark broadcasts it while it is small and shuffles and splits otherwise.
    """
    urls = pages.select(F.col(url).alias("url"))
    index = rule_index(urls, rules)
    subject = F.when(F.col("subject") == "site", F.concat("host", "path")).otherwise(ascii_lower(F.col("url")))
    fitting = (
        urls.where(F.col("url").isNotNull())
        .select("url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
        .withColumn("token", F.explode(tokens(F.col("url"))))
        .join(index.select("token", "name", "verdict", "tier", "subject", "regex"), "token")
        .withColumn("text", subject)
        .where(F.expr("text rlike regex"))
    )
    best = fitting.groupBy("url").agg(
        F.min(F.struct("tier", (-F.length("name")).alias("shorter"), "name", "verdict")).alias("best")
    )
    site, rest, rule, tier, verdict, key = fresh(pages, "host", "path", "rule", "tier", "verdict", "judged")
    best = best.select(
        F.col("url").alias(key),
        F.col("best.name").alias(rule),
        F.col("best.tier").alias(tier),
        F.col("best.verdict").alias(verdict),
    )
    return (
        pages.withColumns({site: host(F.col(url)), rest: path(F.col(url))})
        .join(best, F.col(url) == F.col(key), "left")
        .drop(key)
        .withColumn(verdict, F.coalesce(F.col(verdict), F.lit(default)))
    )
