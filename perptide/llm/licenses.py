"""License scan by canonical digests.

A text is normalised (case, punctuation and typographic marks, copyright lines, equivalent
spellings, white space), its SHA-256 is joined with the digests of known texts that went
through the same expressions. Looked up are the whole document and each of its lines,
the latter as a text of its own. Built-in functions only; nothing but digests is shuffled,
and the known texts are broadcast by Spark as long as they stay small.

A text of other ends than those of a known text cannot equal one. So a short piece of its start
decides first: where no copyright mark stands in a text its normal form starts with its first
words, and only texts that start as a known one, or hold a copyright mark, are normalised
as a whole. Spellings, many passes over a text, run only where the last word fits as well.

Defined results
* NULL and blank texts, and texts that hold nothing but copyright lines, match nothing.
* Several known texts of one digest: the smallest name wins.
* Repeated rows get equal answers and all stay; other columns are kept.
* Without documents or without known texts the result is empty or without matches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perptide.llm.common import fresh, left_by, materialized
from perptide.llm.license_texts import EQUIVALENT_SPELLINGS, KNOWN_TEXTS

COPYRIGHT_LINE = r"(?m)^[ \t*#/;-]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"
COPYRIGHT_MARKS = ("copyright", "(c)", "©", "all rights reserved")
#: ASCII marks, dashes, quotes and the no-break space.
PUNCTUATION = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F‐‑‒–—‘’“” ]+"
FIRST_WORDS = f"^(?:{PUNCTUATION})?({PUNCTUATION.replace('[', '[^', 1)}(?:{PUNCTUATION}{PUNCTUATION.replace('[', '[^', 1)})?)"
#: Stands for the first word where it is not known yet; no word holds a space.
UNKNOWN_START = " "


def plain(text: Column) -> Column:
    """Lower-case words between single spaces, without copyright lines."""
    low = F.lower(text)
    marked = reduce(lambda a, b: a | b, [F.contains(low, F.lit(m)) for m in COPYRIGHT_MARKS])
    bare = F.when(marked, F.regexp_replace(low, COPYRIGHT_LINE, " ")).otherwise(low)
    return F.trim(F.regexp_replace(bare, PUNCTUATION, " "))


def spelled(words: Column) -> Column:
    """Plain words with equivalent spellings made one."""
    spaced = F.concat(F.lit(" "), words, F.lit(" "))
    return F.trim(reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), EQUIVALENT_SPELLINGS, spaced))


def ends(words: Column) -> tuple[Column, Column]:
    """First and last word of the normal form. A spelling joins two words at most, so two decide each."""
    first = spelled(F.substring_index(words, " ", 2))
    last = spelled(F.substring_index(words, " ", -2))
    return F.substring_index(first, " ", 1), F.substring_index(last, " ", -1)


def beginning(text: Column) -> Column:
    """First word of the normal form, from the first two words alone; NULL where a copyright mark may hide it."""
    low = F.lower(text)
    marked = reduce(lambda a, b: a | b, [F.contains(low, F.lit(m)) for m in COPYRIGHT_MARKS])
    head = F.regexp_replace(F.regexp_extract(low, FIRST_WORDS, 1), PUNCTUATION, " ")
    return F.when(~marked, F.substring_index(spelled(head), " ", 1))


def known_digests(spark: SparkSession, texts: tuple = KNOWN_TEXTS) -> DataFrame:
    """(license, digest, first, last), one row per digest; stored, so that Spark knows how small it is."""
    frame = spark.createDataFrame(list(texts), "license string, text string").withColumn("plain", plain(F.col("text")))
    first, last = ends(F.col("plain"))
    return materialized(
        frame.where("plain <> ''")
        .select("license", F.sha2(spelled(F.col("plain")), 256).alias("digest"), first.alias("first"), last.alias("last"))
        .groupBy("digest")
        .agg(F.min("license").alias("license"), F.min("first").alias("first"), F.min("last").alias("last"))
    )


def matched(texts: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of ``texts`` whose column ``body`` is a known text, with ``license``; ``body`` is dropped.

    Keys are never NULL and nothing is filtered by the normal form, so Spark infers no condition
    that would compute it a second time below the projection. No known text has an empty end.
    """
    spark = texts.sparkSession
    starts = known.select("first").union(spark.range(1).select(F.lit(UNKNOWN_START))).distinct()
    begun = texts.withColumn("first", F.coalesce(beginning(F.col("body")), F.lit(UNKNOWN_START)))
    started = begun.where(F.col("body").isNotNull()).join(F.broadcast(starts), "first", "left_semi").drop("first")
    words = started.withColumn("body", plain(F.col("body")))
    first, last = (F.coalesce(x, F.lit("")) for x in ends(F.col("body")))
    likely = words.withColumns({"first": first, "last": last}).join(
        known.select("first", "last").distinct(), ["first", "last"], "left_semi"
    )
    digest = F.coalesce(F.sha2(spelled(F.col("body")), 256), F.lit(""))
    digests = likely.withColumn("digest", digest).drop("body", "first", "last")
    return digests.join(known.select("digest", "license"), "digest").drop("digest")


def scan(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``license`` (of the whole text), ``line_licenses`` (sorted) and ``license_lines``.

    Columns of these names in ``docs`` stay; the new ones then get a leading underscore.
    """
    whole, names, amount, mark = fresh(docs, "license", "line_licenses", "license_lines", "text_digest")
    source = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(F.col(text)).alias("mark"), F.col(text).alias("body"))
    entire = matched(source, known).groupBy("doc", "mark").agg(F.min("license").alias(whole))
    lines = source.select("doc", "mark", F.posexplode(F.split("body", "\n", -1)).alias("at", "body"))
    found = (
        matched(lines, known)
        .groupBy("doc", "mark")
        .agg(F.sort_array(F.collect_set("license")).alias(names), F.size(F.collect_set("at")).alias(amount))
    )
    keys = {"doc": doc_id, "mark": mark}
    answers = docs.withColumn(mark, F.xxhash64(F.col(text)))
    answers = left_by(answers, entire.withColumnsRenamed(keys), [doc_id, mark])
    return (
        left_by(answers, found.withColumnsRenamed(keys), [doc_id, mark])
        .withColumn(amount, F.coalesce(F.col(amount), F.lit(0)))
        .withColumn(names, F.coalesce(F.col(names), F.array().cast("array<string>")))
        .drop(mark)
    )
