"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Each source gets a target share of all words; the documents of a source then all expect target / size copies. The
expected copies are prefix-summed in a fixed order within the source, one random offset is added, and a document is
emitted once for each integer that its stretch of the sum crosses. The order goes by size, so that every stretch of
sizes gives its share and the words taken come near the target.

Scale: only (id, source, size) is shuffled to mix; to emit, each row meets its number of copies in one equi-join. A source
is never gathered in one task: it is cut into groups of like size and equal remainder of a hash of the id, the groups are
counted before the shuffle, and a group's place in the source is a prefix sum over group counts. The number of remainders
grows with the root of the number of documents, and so do both the rows of a group and the groups of a source. Rows that
are alike are one row with a count, so an id that is there a million times is no large group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SALTS, SALTED_ROWS = 16, 1_000_000  # remainders, for each root of so many rows
LARGE_PART = 50
WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with its words counted in the column size; no text has no words."""
    return docs.withColumn("size", F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from one row a source. Weights repeat over the sources by code point, null last.

    A target that would pass most x its source's size stops there and the excess is shared again by weight. What that
    ends in is a water level: with the sources in order of the level at which they are full, a source is full if the
    level reached with all before it full, and it and all after it not, is not below its own. One row a source goes to
    a single task; sources are few.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    w = w.withColumn("cap", most * F.col("source_size"))
    full = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    w = w.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after))
    w = w.withColumn("open", F.col("cap") > F.col("level") * F.col("weight"))
    w = w.withColumn("level", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)["level"])
    return w.select("source", "source_size", F.when(F.col("open"), F.col("level") * F.col("weight")).otherwise(F.col("cap")).cast("double").alias("target"))


def offset(key: str, seed: str) -> Column:
    """The one random offset of a source, in [0, 1): the same whenever it is asked for."""
    return _hex(F.concat(F.lit(seed), F.col(key))) / F.lit(4294967296.0)


def _hex(text: Column) -> Column:
    """32 bits of a text's hash."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def _drawn(docs: DataFrame, weights: tuple[int, ...], most: int, part: int, seed: str, keep: tuple[str, ...]) -> DataFrame:
    """One row for all rows alike in source, size, doc_id and keep: these, source_size, target, rate, how many come before
    (place) and how many they are (n)."""
    d = sized(docs).select("doc_id", "source", "size", *keep)
    d = d.withColumn("skey", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))  # never null
    d = d.withColumn("grade", F.floor(F.sqrt(F.col("size").cast("double"))).cast("long"))
    d = d.groupBy("doc_id", "source", "skey", "size", "grade", *keep).agg(F.count(F.lit(1)).alias("n"))
    d = materialize(d.withColumn("hash", _hex(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), *keep))), "sized")
    rows = d.agg(F.coalesce(F.sum("n"), F.lit(0))).collect()[0][0]
    d = d.withColumn("salt", F.col("hash") % (SALTS * max(1, math.ceil(math.sqrt(rows / SALTED_ROWS))))).drop("hash")
    groups = d.groupBy("source", "skey", "grade", "salt").agg(F.sum("n").alias("n"), F.sum(F.col("size") * F.col("n")).alias("words"))
    groups = materialize(groups, "counted")
    goal = targets(groups.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    groups = groups.join(goal.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).withColumn("large", F.col("grade") * F.col("grade") * part > F.col("source_size"))
    before = Window.partitionBy("skey", "large").orderBy("grade", "salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    groups = materialize(groups.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))).drop("of", "source"), "groups")
    within = Window.partitionBy("skey", "grade", "salt").orderBy("size", "doc_id", *keep).rowsBetween(Window.unboundedPreceding, -1)
    placed = lambda g: d.join(g.drop("n", "words"), ["skey", "grade", "salt"]).withColumn("place", F.col("base") + F.coalesce(F.sum("n").over(within), F.lit(0)))
    first = placed(groups.where("large")).groupBy("skey").agg(F.sum(_copies(F.col("place"), F.col("n"), seed) * F.col("size")).alias("drawn"))
    left = groups.groupBy("skey").agg(F.sum(F.when(~F.col("large"), F.col("words")).otherwise(F.lit(0))).alias("small"), F.max("target").alias("goal"))
    left = left.join(first, "skey", "left").select("skey", F.when(F.col("small") > 0, F.greatest(F.lit(0.0), F.least(F.lit(float(most)), (F.col("goal") - F.coalesce("drawn", F.lit(0))) / F.col("small")))).otherwise(F.lit(0.0)).alias("rest"))
    return placed(groups.join(left, "skey").withColumn("rate", F.when(F.col("large"), F.col("rate")).otherwise(F.col("rest"))))


def _copies(place: Column, n: Column, seed: str) -> Column:
    """Integer boundaries that the stretch of n documents behind `place` others crosses in the prefix sum."""
    upto = lambda k: F.floor(k.cast("double") * F.col("rate") + offset("skey", seed))
    return (upto(place + n) - upto(place)).cast("long")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, part: int = LARGE_PART, seed: str = "mix", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, copies, taken (= copies x size), and keep.

    Documents of more than about a `part`-th of their source (few, by that) are drawn first at the source's rate; the
    others then expect whatever rate fills what those left of the target, so that one long text more or less does not
    move the source off its target. No document expects more than `most` copies.

    Nulls: a null source is a source of its own, after the others; a null id is an id of its own; a null or empty text has
    size 0 and takes no words. Repeated rows are documents of their own. Very long texts are documents like others. No
    rows: no rows. More columns than doc_id, text, source are ignored but for those in keep. Same rows, same result,
    however they are dealt.
    """
    out = _drawn(docs, weights, most, part, seed, keep)
    out = out.withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    out = out.withColumn("copies", _copies(F.col("place") + F.col("nth"), F.lit(1), seed))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *keep)


def emit(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, part: int = LARGE_PART, seed: str = "mix") -> DataFrame:
    """The rows of docs (doc_id, text, source, any others of any name), each as often as the mix takes it.

    Which rows these are depends on the rows alone, not on how they are dealt: ties in id and size are ordered by a hash of
    all columns. Nulls, repeated rows, long texts: see mix(). No rows: no rows.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*names).alias("row"), F.col("doc_id"), F.col("source"), F.col("text"), F.xxhash64(*names).alias("key"))
    drawn = _drawn(rows.select("doc_id", "source", "text", "key"), weights, most, part, seed, ("key",))
    drawn = materialize(drawn.select(F.col("doc_id").alias("of"), F.col("key").alias("of_key"), "n", _copies(F.col("place"), F.col("n"), seed).alias("copies")).where("copies > 0"), "copies")
    rows = rows.select("row", "doc_id", "key")
    if not drawn.where("n > 1").isEmpty():  # rows that are alike: one of them stands for all
        rows = rows.dropDuplicates(["doc_id", "key"])
    out = rows.join(drawn.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key")))
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")
