"""Near-duplicate documents by b-bit MinHash.

A document's set holds its distinct shingles of five lower-cased words. HASHES minima are taken over it; of each only the
low BITS bits are kept, packed as bit planes, and bands of ROWS whole minima become bucket keys. Pairs come from buckets;
their similarity is first estimated from the packed signatures by counting bits, corrected for minima that agree in the
low bits by chance, and what passes is confirmed on the full sets.

Why nothing is lost: at similarity 0.85 a pair shares a given band with probability 0.85^6 = 0.38, so it misses all 32
with 3e-7; the estimate has a standard deviation of 0.026 there and is asked to be above the threshold less SLACK = 0.13.

Sets are compared as sets of 64-bit shingle hashes, in full; two different shingles are taken for one with 5e-20.

Scale: texts with equal sets are one class, a node, from the start; the rows of an id with several texts are nodes of their
own that are linked at the end. Buckets never give all their pairs: each document is first
paired with one partner only, the one among the first members of its buckets that shares most buckets; the links that
are confirmed make components, and then only buckets that still span several components are looked at again, where pairs
within a component, pairs within the bucket's first component, pairs whose estimate is too low and pairs that have too many
shingles which nobody else has are left out inside the join. Minima over buckets are taken before the shuffle and written, so both
sides of the joins on classes, buckets and partners are dealt by the join itself and adaptive execution can split a hot
key. Texts are shuffled only to confirm pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, connected_components, discard, grams, joined, list_array, materialize, mix, ship, signed, words

SHINGLE = 5
THRESHOLD = 85  # per cent
ROWS, BANDS, BITS = 6, 32, 4
HASHES = ROWS * BANDS  # 192: three 64-bit words a plane
SLACK = 0.13

_rng = np.random.default_rng(7)
_XOR = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_MUL = (_rng.integers(0, 1 << 31, HASHES, dtype=np.uint64) * 2 + 1).astype(np.uint32)
_BAND_MUL = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64).reshape(BANDS, ROWS) * np.uint64(2) + np.uint64(1)
PLANES = [f"p{i}" for i in range(BITS * HASHES // 64)]
SIGNATURE = "doc_id long, text_key long, n_shingles long, key1 long, key2 long, " + ", ".join(f"{p} long" for p in PLANES) + ", bands array<long>"


def shingle_sets(texts: list[bytes | None], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and the offsets; fewer than k words are one shingle."""
    buf, starts = joined(texts)
    h, s, _ = words(buf.lower())  # bytes.lower() changes A-Z only
    first = np.searchsorted(s, starts)
    sets = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= k:
            sets.append(np.unique(grams(h[a:b], k)))
        elif b > a:
            sets.append(mix(grams(h[a:b], b - a, seed=1)))
        else:
            sets.append(np.empty(0, np.uint64))
    offsets = np.zeros(len(sets) + 1, np.int64)
    np.cumsum([len(x) for x in sets], out=offsets[1:])
    return np.concatenate(sets) if sets else np.empty(0, np.uint64), offsets


def minima(x: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(HASHES, sets) minima of the 32-bit permuted shingle hashes; every set must hold a shingle."""
    x = (x >> np.uint64(32)).astype(np.uint32)
    out = np.full((HASHES, len(offsets) - 1), 0xFFFFFFFF, np.uint32)
    at = 0
    while at < len(offsets) - 1:  # sets that together fit the cache; a long one by parts
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + 32_768, side="right")) - 1)
        for lo in range(int(offsets[at]), int(offsets[upto]), 1 << 18):
            hi = min(lo + (1 << 18), int(offsets[upto]))
            part, cut = x[lo:hi], np.maximum(offsets[at:upto] - lo, 0)
            tmp = np.empty(len(part), np.uint32)
            for i in range(HASHES):
                np.bitwise_xor(part, _XOR[i], out=tmp)
                np.multiply(tmp, _MUL[i], out=tmp)
                np.minimum(out[i, at:upto], np.minimum.reduceat(tmp, cut), out=out[i, at:upto])
        at = upto
    return out


def _signatures(batch: pa.RecordBatch) -> pa.RecordBatch:
    ids, texts = batch.column(0), batch.column(2).to_pylist()
    x, offsets = shingle_sets(texts)
    n = np.diff(offsets)
    some = np.flatnonzero(n)
    m = minima(x, np.concatenate((offsets[some], offsets[-1:])))
    planes = np.zeros((len(PLANES), len(n)), np.uint64)
    bands = np.zeros((len(some), BANDS), np.uint64)
    for b in range(BITS):
        bits = ((m >> np.uint32(b)) & np.uint32(1)).astype(np.uint64).reshape(HASHES // 64, 64, len(some))
        planes[b * (HASHES // 64) : (b + 1) * (HASHES // 64), some] = (bits << np.arange(64, dtype=np.uint64)[None, :, None]).sum(1, dtype=np.uint64)
    for j in range(BANDS):
        key = np.full(len(some), j + 1, np.uint64)
        for r in range(ROWS):
            key = mix(key + m[j * ROWS + r].astype(np.uint64) * _BAND_MUL[j, r])
        bands[:, j] = key
    keys = np.zeros((2, len(n)), np.uint64)
    for i, part in enumerate((x, mix(x ^ np.uint64(0x5851F42D4C957F2D)))):
        keys[i, some] = np.add.reduceat(part, offsets[some]) if len(some) else 0
    spread = np.zeros(len(n) + 1, np.int64)
    np.cumsum((n > 0) * BANDS, out=spread[1:])
    cols = [ids, batch.column(1), pa.array(n), pa.array(signed(keys[0])), pa.array(signed(keys[1])), *[pa.array(signed(p)) for p in planes], list_array(signed(bands.ravel()), spread)]
    return pa.RecordBatch.from_arrays(cols, ["doc_id", "text_key", "n_shingles", "key1", "key2", *PLANES, "bands"])


def estimate(a: str, b: str) -> Column:
    """Similarity from packed signatures: the share of equal b-bit minima, less what agrees by chance."""
    words_a_plane, differ = HASHES // 64, F.lit(0)
    for w in range(words_a_plane):
        any_bit = F.lit(0).cast("long")
        for bit in range(BITS):
            p = PLANES[bit * words_a_plane + w]
            any_bit = any_bit.bitwiseOR(F.col(f"{a}{p}").bitwiseXOR(F.col(f"{b}{p}")))
        differ = differ + F.bit_count(any_bit)
    chance = 1 / (1 << BITS)
    return (1 - differ / F.lit(float(HASHES)) - chance) / (1 - chance)


def _may_link(a: str, b: str, threshold: int) -> Column:
    sizes = 100 * F.least(F.col(f"{a}n_shingles"), F.col(f"{b}n_shingles")) >= threshold * F.greatest(F.col(f"{a}n_shingles"), F.col(f"{b}n_shingles"))
    return sizes & (estimate(a, b) >= threshold / 100 - SLACK)


def _confirm(threshold: int):
    held: dict[int, np.ndarray] = {}  # by node, which has one text only

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        u, v, tu, tv = (batch.column(i).to_pylist() for i in range(4))
        if len(held) > 64:
            held.clear()
        fresh = {x: tv[i] for i, x in enumerate(v) if x not in held}  # pairs come in order of v more or less: the last sets are kept
        x, o = shingle_sets(list(fresh.values()))
        held.update({d: x[o[i] : o[i + 1]] for i, d in enumerate(fresh)})
        x, o = shingle_sets(tu)
        keep = np.zeros(len(u), bool)
        for i, d in enumerate(v):
            a, b = x[o[i] : o[i + 1]], held[d]
            if len(a) and len(b):
                at = np.searchsorted(b, a)
                both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
                keep[i] = 100 * both >= threshold * (len(a) + len(b) - both)
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()).filter(pa.array(keep)), pa.array(v, pa.int64()).filter(pa.array(keep))], ["u", "v"])

    return run


class Texts:
    """The text of each node: that of the row (doc_id, text_key) which stands for the class."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, repeated: bool):
        self.docs, self.nodes, self.repeated = docs, nodes.select("node", "doc_id", "text_key"), repeated

    def of(self, wanted: DataFrame) -> DataFrame:
        """(node, text) of the nodes of `wanted`, which are all different."""
        at = self.nodes.join(wanted.select("node"), "node")
        out = self.docs.join(at.hint("shuffle_hash"), ["doc_id", "text_key"]).select("node", "text")
        return out.dropDuplicates(["node"]) if self.repeated else out  # where no row is there twice, nothing needs to move again

    def confirm(self, pairs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
        """Those of pairs (u, v) whose full sets are as alike as asked for."""
        texts = self.of(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct())
        both = pairs.join(texts.toDF("u", "tu"), "u").join(texts.toDF("v", "tv"), "v").select("u", "v", "tu", "tv")
        return arrow_map(both, _confirm(threshold), "u long, v long", 300)


def _shingle_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    x, o = shingle_sets(batch.column(1).to_pylist())
    return pa.RecordBatch.from_arrays([batch.column(0), list_array(signed(x), o)], ["node", "shingles"])


def _own_shingles(bands: DataFrame, texts: Texts) -> DataFrame:
    """(node, own) of the nodes in `bands`: how many of its shingles no other of them has. No pair of them can share
    those, which rules out most pairs of a group whose members were each changed a little too much, without comparing."""
    ids = bands.select("node").distinct()
    sets = arrow_map(texts.of(ids), _shingle_rows, "node long, shingles array<long>", 300).select("node", F.explode("shingles").alias("shingle"))
    lone = sets.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("last")).where("node = last")
    own = lone.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    return materialize(ids.join(own, "node", "left").select("node", F.coalesce("own", F.lit(0)).alias("own")), "own")


def _links(classes: DataFrame, texts: Texts, threshold: int) -> DataFrame:
    """(u, v) between nodes: enough of the confirmed links that every linked pair ends in one component."""
    bands = classes.select("node", F.posexplode("bands").alias("nth", "band"))
    shared = materialize(bands.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("band", "low"), "shared")
    bands = materialize(bands.join(shared, "band").select("node", "nth", "band", "low"), "buckets")  # of buckets with two members at least
    discard(shared)
    first = bands.where("node > low").groupBy("node", "low").count().groupBy("node").agg(F.max_by("low", F.struct(F.col("count"), -F.col("low"))).alias("low"))
    packed = ["node", "n_shingles", *PLANES]
    sides = lambda p: classes.select(*[F.col(c).alias(p + c) for c in packed])
    first = first.join(sides("a_"), F.col("node") == F.col("a_node")).join(sides("b_"), F.col("low") == F.col("b_node"))
    first = materialize(first.where(_may_link("a_", "b_", threshold)).select(F.col("node").alias("u"), F.col("low").alias("v")), "first-pairs")
    linked = materialize(texts.confirm(first, threshold), "first-links")
    labels = connected_components(linked, "first")
    # what is left: buckets that span components
    wide = bands.join(labels, F.col("node") == F.col("id"), "left").select("node", "nth", "band", F.coalesce("component", "node").alias("component"))
    spans = materialize(wide.groupBy("band").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most").select("band", "least"), "spans")
    wide = materialize(wide.join(spans, "band"), "open-buckets")
    discard(bands, spans, labels)
    own = _own_shingles(wide, texts)
    open_ = wide.join(classes.select(*packed, "bands"), "node").join(own, "node")
    a = open_.where("component <> least").select("band", *[F.col(c).alias("a_" + c) for c in open_.columns if c not in ("band", "least")])
    b = open_.select("band", *[F.col(c).alias("b_" + c) for c in open_.columns if c != "band"])
    once = (F.col("b_component") == F.col("b_least")) | (F.col("a_node") > F.col("b_node"))
    most = F.least(F.col("a_n_shingles") - F.col("a_own"), F.col("b_n_shingles") - F.col("b_own"))  # they cannot share more
    can = 100 * most >= threshold * (F.col("a_n_shingles") + F.col("b_n_shingles") - most)
    before = lambda p: F.slice(F.col(p + "bands"), F.lit(1), F.col("a_nth"))
    met = F.exists(F.zip_with(before("a_"), before("b_"), lambda x, y: x == y), lambda x: x)  # in an earlier bucket
    pairs = a.join(b, (a["band"] == b["band"]) & (F.col("a_component") != F.col("b_component")) & once & can & _may_link("a_", "b_", threshold) & ~met)
    pairs = pairs.select(F.greatest("a_node", "b_node").alias("u"), F.least("a_node", "b_node").alias("v")).distinct().join(first, ["u", "v"], "left_anti")
    pairs = materialize(pairs, "second-pairs")
    discard(wide, own, first)
    return linked if pairs.isEmpty() else linked.unionByName(texts.confirm(pairs, threshold))


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One row a row of docs (doc_id, text): doc_id, n_shingles, component_id, kept.

    Links are transitive; kept is the smallest id of each component. Nulls: a null or empty text, or one of white space,
    has the empty set, links with nothing and is kept; a row with a null id is no node: its component_id is null and it is
    kept. Repeated rows: every row with an id gets that id's component. An id whose rows have different texts is linked
    through each of them, so it joins what they are near to. Fewer than five words are one shingle. Very long texts are
    hashed by slices. No rows: no rows. Other columns are ignored.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text"))
    rows = materialize(arrow_map(docs, _signatures, SIGNATURE, 300), "signatures")
    real = rows.where("n_shingles > 0 and doc_id is not null")
    keys = ["key1", "key2", "n_shingles"]
    # a node is a class of equal sets; numbers follow the least ids, so that what was copied comes before its copies
    led = real.groupBy(*keys).agg(F.min("doc_id").alias("doc_id"), F.min_by("text_key", "doc_id").alias("text_key"))
    led = materialize(led.repartitionByRange("doc_id").sortWithinPartitions("doc_id", *keys).withColumn("node", F.monotonically_increasing_id()), "nodes")
    members = materialize(real.select("doc_id", *keys).join(led.select("node", *keys), keys).select("doc_id", "node"), "members")
    repeated = not rows.groupBy("doc_id", "text_key").count().where("count > 1").isEmpty()
    classes = real.join(led, ["doc_id", "text_key", *keys])
    classes = materialize(classes.dropDuplicates(["node"]) if repeated else classes, "classes")
    links = _links(classes, Texts(docs, classes, repeated), threshold)
    several = materialize(members.groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high"), "several")
    links = links.unionByName(members.join(several, "doc_id").where("node > low").select(F.col("node").alias("u"), F.col("low").alias("v")))
    labels = connected_components(links, "all")
    groups = materialize(members.join(labels, F.col("node") == F.col("id"), "left").select("doc_id", F.coalesce("component", "node").alias("component")), "groups")
    least = materialize(groups.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.max("doc_id").alias("last")).where("component_id < last").select("component", "component_id"), "least")
    moved = groups.join(least, "component").where("doc_id > component_id").select("doc_id", "component_id").distinct()
    moved = materialize(moved, "moved")
    discard(led, classes, members, several, labels, groups, least)
    out = rows.select("doc_id", "n_shingles").join(moved, "doc_id", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
