"""Exact deduplication through an extendible-hash index on shared files, in DataFrame and SQL functions only.

A text's key is a 64-bit hash of its normalised form. The directory has 2^depth slots, one for each value of a key's leading
bits; it doubles as long as a bucket holds more than its capacity, and the overfull bucket splits, so slots that did not need
the last doubling share a bucket. Buckets in the order of their slots are ranges of keys; each of the session's shuffle
partitions owns a run of them of about equal weight. The owner of a range chains the texts that share a key and compares their
bytes: equal ones become one entry of the index, with the smallest id and a count. The entries are written as Parquet.

Scale. A key that occurs once equals no other, so only texts of other keys move, once each (where those keys are too many to
be broadcast, all texts move, to the same end). Splitting buckets cannot divide one key: one that outweighs a bucket is dealt
out in pages to owners one after another, whose entries, a few a page, are merged by comparing bytes again. Documents get their
entry by an equi-join of ids and hashes with the entries; rows that are alike count as one there, and a hot key on the
documents' side can be split by adaptive execution. Directory, hot keys and repeated keys are broadcast below fixed numbers of rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize

SPACE = r"[\x20\x09-\x0D]+"
MOST_BUCKETS = 1 << 18  # directory and hot keys, at most HOT_PART as many, are broadcast
HOT_PART = 4  # a key of more than this part of a bucket is dealt out by itself, so that few keys never split a bucket to great depth
MOST_DEPTH = 20  # bits of the directory
MOST_SENT = 1 << 20  # repeated keys that are broadcast, 16 MB
PER_OWNER = 4  # buckets of an owner; its load is at most a bucket over the mean
ROW_BYTES = 256  # weight of a row beside its text


class Index(NamedTuple):
    """rows: doc_id, key, text_sha256, weight, n (rows alike), a row for all that are alike. directory: slot, depth (the bucket's),
    bucket (first slot of it), owner, of 2^depth_bits slots. entries: owner, key, text_sha256, keep_id, group_size, for each text whose
    key occurs more than once."""

    rows: DataFrame
    directory: DataFrame
    depth_bits: int
    entries: DataFrame


def normalised(text: Column) -> Column:
    """Each run of ASCII white space is one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def key_of(text: Column, bits: int = 64) -> Column:
    """The leading `bits` of a 64-bit hash, as bits of a long; fewer than 64 are for tests of collisions."""
    h = F.xxhash64(text)
    return h if bits == 64 else h.bitwiseAND(F.lit(-1 << (64 - bits)))


def _prefix(key: str, bits: int | Column) -> Column:
    """A key's leading bits as a number: a shift by 64 would be one by none."""
    return F.expr(f"shiftrightunsigned(shiftrightunsigned({key}, 1), {63 - bits})") if isinstance(bits, int) else F.call_function("shiftrightunsigned", F.col(key), bits)


def directory(keys: DataFrame, owners: int, bytes_each: int = 0) -> tuple[DataFrame, int, int]:
    """(slot, depth, bucket, owner), its depth, and the capacity of a bucket, from (key, weight) with distinct keys.

    Doubling from one slot on, all buckets at once: counts by the longest prefix are rolled up to each shorter one, and a
    slot's bucket is that of the shortest prefix that is not overfull. The capacity is total / (PER_OWNER x owners), or
    bytes_each, but never so small that there could be more than MOST_BUCKETS buckets. Keys heavier than a HOT_PART-th of
    a bucket are left out of the weights: they are dealt out by themselves, in pages of a bucket at most.
    """
    total = keys.agg(F.coalesce(F.sum("weight"), F.lit(0)).cast("long")).collect()[0][0]
    capacity = max(bytes_each or -(-total // (PER_OWNER * owners)), -(-2 * total // MOST_BUCKETS), 1)
    fine = keys.where(F.col("weight") * HOT_PART <= capacity).groupBy(_prefix("key", MOST_DEPTH).alias("p")).agg(F.sum("weight").alias("weight"))
    level = fine.select(F.explode(F.sequence(F.lit(0), F.lit(MOST_DEPTH))).alias("depth"), "p", "weight")
    shift = F.lit(MOST_DEPTH) - F.col("depth")
    level = level.withColumn("prefix", F.call_function("shiftrightunsigned", F.col("p"), shift)).groupBy("depth", "prefix").agg(F.sum("weight").alias("weight"))
    overfull = (F.col("weight") > capacity) & (F.col("depth") < MOST_DEPTH)
    halves = level.where(overfull).select((F.col("depth") + 1).alias("depth"), F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix"))
    root = keys.sparkSession.range(1).select(F.lit(0).alias("depth"), F.col("id").alias("prefix"))
    buckets = level.where(~overfull).join(halves.unionByName(root), ["depth", "prefix"], "left_semi")  # what an overfull bucket splits into
    level = materialize(buckets.select("depth", "prefix", "weight"), "buckets")
    bits = level.agg(F.coalesce(F.max("depth"), F.lit(0))).collect()[0][0]
    wide = F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(bits) - F.col("depth"))
    order = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    each = level.withColumn("bucket", F.col("prefix") * wide).withColumn("before", F.coalesce(F.sum("weight").over(order), F.lit(0)))
    share = F.sum("weight").over(Window.partitionBy())
    each = each.withColumn("owner", F.least(F.floor(F.col("before") * F.lit(owners) / F.greatest(share, F.lit(1))), F.lit(owners - 1)).cast("int"))
    slots = each.withColumn("slot", F.explode(F.sequence(F.col("bucket"), F.col("bucket") + wide - 1)))
    out = materialize(slots.select("slot", "depth", "bucket", "owner"), "directory")
    discard(level)
    return out, bits, capacity


def build(docs: DataFrame, bytes_each: int = 0, bits: int = 64, sent: int = MOST_SENT) -> Index:
    """The index of docs (doc_id, text). bytes_each: capacity of a bucket (0: by the session's shuffle partitions); bits: of a key;
    sent: at most so many repeated keys are broadcast, beyond it all texts move."""
    spark = docs.sparkSession
    owners = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = docs.select("doc_id", normalised(F.col("text")).alias("text")).select("doc_id", "text", key_of(F.col("text"), bits).alias("key"))
    rows = text.select("doc_id", "key", F.unhex(F.sha2(F.col("text"), 256)).alias("sha"), (F.octet_length("text") + ROW_BYTES).cast("long").alias("weight"))
    rows = materialize(rows.groupBy("doc_id", "key", "sha").agg(F.first("weight").alias("weight"), F.count(F.lit(1)).alias("n")), "rows")
    keys = rows.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("weight")).alias("weight"))
    keys = materialize(keys.where("n > 1"), "repeated")  # a key that occurs once has nothing to be compared with
    few = keys.limit(sent + 1).count() <= sent
    if few:
        text = text.join(F.broadcast(keys.select("key")), "key", "left_semi")
    found, depth, capacity = directory(keys if few else rows.groupBy("key").agg(F.sum(F.col("n") * F.col("weight")).alias("weight")), owners, bytes_each)
    hot = keys.where(F.col("weight") * HOT_PART > capacity).select(F.col("key").alias("hot_key"), F.ceil(F.col("weight") / capacity).cast("long").alias("pages"))
    dealt = text.join(F.broadcast(hot), F.col("key") == F.col("hot_key"), "left").withColumn("slot", _prefix("key", depth))
    dealt = dealt.join(F.broadcast(found.select("slot", "owner")), "slot", "left")
    page = F.pmod(F.xxhash64("doc_id", "key"), F.col("pages"))
    first = F.pmod(F.col("key"), F.lit(owners))  # hot keys are not in the directory's weights
    owner = F.when(F.col("pages").isNotNull(), F.pmod(first + page, F.lit(owners))).otherwise(F.coalesce(F.col("owner"), F.lit(0))).cast("int")
    dealt = dealt.select(owner.alias("owner"), "key", "text", "doc_id", (F.coalesce("pages", F.lit(0)) > 1).alias("paged"))
    chained = dealt.repartitionById(owners, F.col("owner")).groupBy("owner", "key", "text", "paged").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    sha = F.unhex(F.sha2(F.col("text"), 256)).alias("sha")
    chained = materialize(chained.select("owner", "key", F.when(F.col("paged"), F.col("text")).alias("text"), sha, "keep_id", "group_size"), "chained")
    paged = chained.where(F.col("text").isNotNull()).groupBy("key", "text").agg(F.min("owner").alias("owner"), F.first("sha").alias("sha"), F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    columns = ["owner", "key", "sha", "keep_id", "group_size"]
    entries = materialize(chained.where(F.col("text").isNull()).select(*columns).unionByName(paged.select(*columns)), "entries")
    discard(keys, chained)
    return Index(rows, found, depth, entries)


def dedup(docs: DataFrame, bytes_each: int = 0, bits: int = 64, sent: int = MOST_SENT) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256. Texts are equal when they are alike after each run of
    ASCII white space became one space; of equal ones the row with the smallest doc_id is kept.

    Which rows are equal is found by comparing bytes; within a key's chain, whose texts differ, a document then finds its own
    entry by its SHA-256. Should two different texts of a chain ever have the same one, the job fails and says so.
    Nulls: a null text is empty; a null id stays only where no row of the group has an id. Repeated rows: of rows with one id and equal
    texts one is kept, and group_size counts each. Empty texts are equal to each other. Very long texts are texts like others.
    No rows: no rows. Columns other than doc_id and text are ignored, whatever their names. Same rows, same result.
    """
    index = build(docs, bytes_each, bits, sent)
    texts = index.entries.groupBy("key", "sha").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count(F.lit(1)).alias("texts"))
    texts = texts.select("key", "sha", "keep_id", F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts have one SHA-256")).cast("long")).otherwise(F.col("group_size")).alias("group_size"))
    texts = materialize(texts, "texts")
    discard(index.entries, index.directory)
    out = index.rows.join(texts, ["key", "sha"], "left").withColumn("own", F.col("group_size").isNull())
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return out.select(
        "doc_id", F.when(F.col("own"), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.when(F.col("own"), F.lit(1)).otherwise(F.col("group_size")).cast("long").alias("group_size"),
        ((F.col("copy") == 1) & (F.col("own") | F.col("doc_id").eqNullSafe(F.col("keep_id")))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )
