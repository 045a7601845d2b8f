"""Which terms and sources of a language stand apart: divergences between the sources of a language and of each from the whole.

A language keeps the terms that enough of its documents hold. Each kept term is one wide row: its counts as an array indexed by
the language's sources, and its total. Higher-order functions turn the counts into smoothed shares of a billion and those into a
contribution for each pair of sources, in the JVM; contributions are summed map-side, so what is shuffled is a row a pair and
task. All arithmetic is on whole numbers.

Scale. Documents are counted by (language, source, term) with map-side sums before anything moves, so a hot source, language or
term is no large group; after it no key has more rows than the language has sources. The tables that are joined by language (its sources'
totals, its number of terms) hold a row a source or language; Spark broadcasts them where their size lets it. The ranking of a
source's terms keeps ten rows a task before its shuffle. Pairs are as many as the result has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize

BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"  # what is no letter of a term
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_DOCS, TOP, SMOOTH = 10, 10, 2


def lowered(text: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def terms(text: Column) -> Column:
    """The terms of a text in order; there may be an empty string before and after them."""
    return F.split(lowered(text), BETWEEN)


def share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(1e9 (count + 2) / (n + 2 v)), by long division in steps of a thousand, exact up to 9e15 occurrences."""
    a, b = count + F.lit(SMOOTH), n + F.lit(SMOOTH) * v
    div = lambda x: F.call_function("div", x, b)
    whole, rest = div(a), a % b
    for _ in range(3):
        whole, rest = whole * 1000 + div(rest * 1000), rest * 1000 % b
    return F.lit(1).cast("long") + whole


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q))"""
    return F.call_function("div", (p - q) * (p - q), p + q)


def counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold it), from lang, source, text without nulls."""
    t = docs.select("lang", "source", terms(F.col("text")).alias("t")).withColumn("size", F.size("t"))
    t = t.select("lang", "source", "size", F.posexplode(F.concat("t", F.array_distinct("t"))).alias("at", "term"))  # all terms, then each once
    every = F.col("at") < F.col("size")
    return t.groupBy("lang", "source", "term").agg(F.count_if(every).alias("n"), F.count_if(~every).alias("docs")).where("term <> ''")


def wide(counted: DataFrame, sources: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """lang, term, total, v: one row a kept term, v the counts by place of the source in its language (sources: lang, source, place)."""
    t = counted.join(sources.select("lang", "source", "place", "n_sources"), ["lang", "source"])
    t = t.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.max("n_sources").alias("n_sources"), F.map_from_entries(F.collect_list(F.struct("place", "n"))).alias("m"))
    places = F.sequence(F.lit(0), F.col("n_sources") - 1)
    return t.where(F.col("docs") >= least).select("lang", "term", "total", F.transform(places, lambda i: F.coalesce(F.col("m")[i], F.lit(0).cast("long"))).alias("v"))


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank. Part 'pair': item is each other source of the language, value the summed divergence of
    the two over all kept terms. Part 'term': item is each of the `top` terms in which the source most exceeds its language.

    Nulls: a null text, lang or source is the empty string, and the empty string is a language or source like others. A document
    without terms still names its source. A language none of whose terms is held often enough has pairs of value 0 and no terms. Repeated rows
    are documents of their own. Ties go to the smaller item by UTF-8 bytes. Very long texts are texts like others; a text's terms
    are one array. No rows: no rows. Columns other than lang, source and text are ignored, whatever their names.
    """
    d = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    groups = d.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows"))
    lists = groups.groupBy("lang").agg(F.array_sort(F.collect_list("source")).alias("sources"))
    lists = materialize(lists, "lists")
    places = materialize(lists.select("lang", F.size("sources").alias("n_sources"), F.posexplode("sources").alias("place", "source")), "places")
    rows = materialize(wide(counts(d), places, least), "wide")
    sums = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("n"))
    each = rows.select("lang", F.posexplode("v").alias("place", "n")).groupBy("lang", "place").agg(F.sum("n").alias("n"))
    each = each.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "n"))), lambda x: x["n"]).alias("ns"))
    whole = materialize(lists.join(sums, "lang").join(each, "lang"), "whole")  # a row a language that keeps terms

    r = rows.join(whole, "lang").withColumn("p", F.transform("v", lambda c, i: share(c, F.col("ns")[i], F.col("terms"))))
    ahead = F.transform("p", lambda x, i: F.transform(F.slice("p", i + 2, F.size("p")), lambda y: divergence(x, y)))
    pairs = r.select("lang", F.posexplode(F.flatten(ahead)).alias("at", "value")).groupBy("lang", "at").agg(F.sum("value").alias("value"))
    order = F.transform("sources", lambda _, i: F.transform(F.slice("sources", i + 2, F.size("sources")), lambda _, j: F.struct(i.alias("a"), (i + 1 + j).alias("b"))))
    pairs = lists.select("lang", F.posexplode(F.flatten(order)).alias("at", "x")).join(pairs, ["lang", "at"]).select("lang", "x.a", "x.b", "value")
    pairs = materialize(pairs, "pairs")  # each pair once
    both = pairs.select("lang", F.inline(F.array(F.struct(F.col("a").alias("place"), F.col("b").alias("other"), "value"), F.struct(F.col("b").alias("place"), F.col("a").alias("other"), "value"))))
    names = places.select("lang", "place", "source").join(lists, "lang")
    names = names.select("lang", "place", "source", F.posexplode("sources").alias("other", "item")).where("place <> other")
    pair = names.join(both, ["lang", "place", "other"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pair = pair.withColumn("rank", F.row_number().over(best))

    q = share(F.col("total"), F.col("n"), F.col("terms"))
    r = r.withColumn("q", q)
    over = F.filter(F.transform("p", lambda x, i: F.struct(i.alias("place"), F.when((F.col("v")[i] > 0) & (x > F.col("q")), divergence(x, F.col("q"))).alias("value"))), lambda x: x["value"].isNotNull())
    term = r.select("lang", "sources", F.col("term").alias("item"), F.inline(over)).select("lang", F.col("sources")[F.col("place")].alias("source"), F.lit("term").alias("part"), "item", "value")
    term = term.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return pair.unionByName(term)
