"""Near-duplicate embeddings with randomised-rotation binary codes.

A unit vector is rotated at random and its signs are kept: 64 bits a rotation block, with one correction factor, the inner
product of the vector and its code. Another vector, its rotated components rounded to a few bits by chance so that the
rounding has no bias, gives with the code an unbiased estimate of the two vectors' inner product in a handful of AND and
bit-count operations, and the factor gives a bound on its error. A pair whose upper bound reaches the threshold is
recomputed exactly in double precision; all others are dropped on their codes alone.

Candidates come from bands of sign bits of several rotations. A band has as many bits as the logarithm of the number of
vectors, so that the chance pairs of a vector stay one a band at most whatever the size; there are as many bands as it takes
to miss a pair at the threshold with MISS (at cosine 0.95 a bit agrees with probability 0.899: 46 bands of 16 bits, 274 of
32).

Scale: equal vectors are one class with a weight from the start, so thousands of copies are one row. Buckets are joined to
themselves on the band by an equi-join that can split; the code estimate is part of its condition, and so is the rule that
a pair which shares one of the first rotation's bands, as nearly all close pairs do, is met in the first such band only.
Vectors themselves are moved only for survivors.

A large group of near copies has links by the square of its size, and n_links asks for their number. Most need not be made
one by one: a vector that is linked to the first of its bucket, its middle, has an exact angle to it, and two vectors whose
angles to the same middle add up to less than the threshold's angle are linked for certain. These are counted by angle; all
other pairs go through the codes.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, connected_components, discard, list_array, materialize, ship, signed

THRESHOLD = 0.95
MISS = 1e-4
LEAST_BITS, MOST_BITS = 12, 32
MIDDLE_BANDS = 12
STEPS = 4_096  # of the angle that the threshold stands for
QUERY_BITS = 4
BOUND = 4.0  # standard deviations of the code's error that are allowed for


def _rotation(dims: int, padded: int, i: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(100 + i).normal(size=(padded, padded)))[0][:dims]


def _pack(bits: np.ndarray) -> np.ndarray:
    """(n, 64w) booleans -> (n, w) words."""
    b = bits.reshape(len(bits), -1, 64).astype(np.uint64)
    return (b << np.arange(64, dtype=np.uint64)).sum(2, dtype=np.uint64)


def bands_for(rows: int, threshold: float) -> tuple[int, int]:
    """Bits of a band, and how many bands."""
    bits = min(max(math.ceil(math.log2(max(rows, 2))), LEAST_BITS), MOST_BITS)
    same = 1 - math.acos(threshold) / math.pi
    return bits, math.ceil(math.log(MISS) / math.log(1 - same**bits))


def _codes(bits: int, n_bands: int):
    """Band n of dims-long vectors is the number dims << 42 | n << 32 | its bits."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, lists = batch.column(0), batch.column(1)
        keep, code, planes, facts, bands = [], [], [], [], []
        lengths = np.diff(np.asarray(lists.offsets))
        for dims in np.unique(lengths):  # vectors of other lengths are a set of their own
            rows = np.flatnonzero(lengths == dims)
            x = np.asarray(lists.take(pa.array(rows)).flatten()).reshape(-1, dims)
            x = x / np.abs(x).max(1, keepdims=True)
            x = x / np.sqrt((x * x).sum(1, keepdims=True))
            padded = -(-int(dims) // 64) * 64
            y = x @ _rotation(int(dims), padded, 0)
            sign = y > 0
            align = np.abs(y).sum(1) / np.sqrt(padded)  # <code, vector>, the correction factor
            low, top = y.min(1, keepdims=True), (1 << QUERY_BITS) - 1
            width = np.maximum((y.max(1, keepdims=True) - low) / top, 1e-12)
            dither = np.random.default_rng(9).random(padded)[None, :]
            u = np.clip(np.floor((y - low) / width + dither), 0, top).astype(np.uint64)
            keep.append(rows)
            code.append(_pack(sign))
            planes.append(np.stack([_pack(((u >> np.uint64(j)) & np.uint64(1)).astype(bool)) for j in range(QUERY_BITS)], 1))
            facts.append(np.stack((align, low[:, 0], width[:, 0]), 1))
            own, n, i = [], 0, 0
            while n < n_bands:
                s = sign if i == 0 else x @ _rotation(int(dims), padded, i) > 0
                for w in range(0, padded, 64):
                    for at in range(w, w + 64 - bits + 1, bits):
                        if n < n_bands:
                            own.append((s[:, at : at + bits] << np.arange(bits)).sum(1) + (n << 32) + (int(dims) << 42))
                            n += 1
                i += 1
            bands.append(np.stack(own, 1))
        rows = np.concatenate(keep)
        lists_of = lambda parts: pa.array([list(r) for p in parts for r in signed(np.ascontiguousarray(p)).reshape(len(p), -1).tolist()], pa.list_(pa.int64()))
        f = np.concatenate(facts)
        b = np.concatenate(bands)
        cols = [ids.take(pa.array(rows)), lists.take(pa.array(rows)), lists_of(code), lists_of(planes), *[pa.array(f[:, j]) for j in range(len(FACTS))], list_array(b.ravel().astype(np.int64), np.arange(len(b) + 1) * b.shape[1])]
        return pa.RecordBatch.from_arrays(cols, ["id", "v", "code", "planes", *FACTS, "bands"])

    return run


FACTS = ["align", "low", "width"]


def upper_bound(a: str, b: str, n_words: int, bound: float = BOUND) -> Column:
    """Upper confidence bound of the inner product of b's vector with a's, from a's code and b's rounded components."""
    c = lambda p, x: F.col(f"{p}{x}")
    both, total, ones = F.lit(0), F.lit(0), F.lit(0)
    for w in range(n_words):
        ones = ones + F.bit_count(c(a, "code")[w])
        for j in range(QUERY_BITS):
            plane = c(b, "planes")[j * n_words + w]
            both = both + (1 << j) * F.bit_count(c(a, "code")[w].bitwiseAND(plane))
            total = total + (1 << j) * F.bit_count(plane)
    padded = 64.0 * n_words
    # <code, y> = (2 (width both + low ones) - (width total + low padded)) / sqrt(padded)
    dot = (2 * (c(b, "width") * both + c(b, "low") * ones) - (c(b, "width") * total + c(b, "low") * padded)) / math.sqrt(padded)
    spread = F.sqrt((1 - c(a, "align") * c(a, "align")) / (c(a, "align") * c(a, "align")) / (padded - 1))
    rounding = c(b, "width") / c(a, "align") / 2
    return dot / c(a, "align") + bound * (spread + rounding)


def met_before(a: str, b: str, n: Column, n_words: int, bits: int) -> Column:
    """Whether the vectors share one of the first rotation's bands before band n; those are read off their codes."""
    out, k = F.lit(False), 0
    for w in range(n_words):
        differ = F.col(f"{a}code")[w].bitwiseXOR(F.col(f"{b}code")[w])
        for at in range(0, 64 - bits + 1, bits):
            mask = ((1 << bits) - 1) << at
            out = out | ((n > k) & (differ.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)) == 0))
            k += 1
    return out


def _exact(threshold: float):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        x, y = (np.asarray(batch.column(i).flatten()).reshape(n, -1) if len(set(np.diff(np.asarray(batch.column(i).offsets)).tolist())) == 1 else None for i in (2, 3))
        if x is None:  # several lengths in a batch
            cos = np.array([_cosine(np.array([a]), np.array([b]))[0] for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)])
        else:
            cos = _cosine(x, y)
        keep = pa.array(cos >= threshold)
        return pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(cos).filter(keep)], ["u", "v", "cos"])

    return run


def _cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x, y = x / np.abs(x).max(1, keepdims=True), y / np.abs(y).max(1, keepdims=True)  # no overflow
    return (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))


def _one_of(longest: int, test: Callable[[int], Column]) -> Column:
    """test(words) for two codes of that many words each."""
    if longest == 1:
        return test(1)
    out = F.lit(False)
    for w in range(1, longest + 1):
        out = out | ((F.size("a_code") == w) & (F.size("b_code") == w) & test(w))
    return out


def _confirmed(pairs: DataFrame, codes: DataFrame, threshold: float) -> DataFrame:
    """(u, v, cos) of those of pairs (u, v) that reach the threshold in double precision."""
    vec = codes.select("node", F.col("v").alias("x"))
    both = pairs.join(vec.toDF("u", "xu"), "u").join(vec.toDF("v", "xv"), "v").select("u", "v", "xu", "xv")
    return arrow_map(both, _exact(threshold), "u long, v long, cos double", 2_000)


def _candidates(codes: DataFrame, middles: DataFrame, longest: int, threshold: float, bits: int) -> DataFrame:
    """(u, v) of pairs that share a band, are not linked for certain, and whose codes leave room for a link.

    A bucket may hold thousands around one middle, and a few others. What is not of the bucket's most frequent middle meets
    all that has another middle than its own; and what lies so far out that its angle does not settle its links meets those of its own
    middle. So the many never meet each other, and no pair is left out."""
    near = codes.join(middles, "node", "left").withColumns({"middle": F.coalesce("middle", -1 - F.col("node")), "step": F.coalesce("step", F.lit(STEPS))})
    near = materialize(near.select("bands", "node", "middle", "step", "code", "planes", *FACTS), "placed")
    kinds = near.select(F.explode("bands").alias("band"), "middle").groupBy("band", "middle").agg(F.count(F.lit(1)).alias("n"))
    kinds = kinds.groupBy("band").agg(F.max_by("middle", F.struct("n", "middle")).alias("most"), F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    kinds = materialize(kinds.select("band", "most"), "kinds")
    bands = near.select(F.explode("bands").alias("band"), *[c for c in near.columns if c != "bands"])
    mixed = materialize(bands.join(kinds, "band"), "buckets")
    side = lambda d, p: d.select("band", *[F.col(c).alias(p + c) for c in d.columns if c != "band"])
    a, b = side(mixed.where("middle <> most").drop("most"), "a_"), side(mixed, "b_")
    may = lambda nth: _one_of(longest, lambda w: (upper_bound("a_", "b_", w) >= threshold) & ~met_before("a_", "b_", nth, w, bits))
    nth = lambda band: F.shiftright(band, 32).bitwiseAND(F.lit(1023))
    once = (F.col("b_middle") == F.col("b_most")) | (F.col("a_node") > F.col("b_node"))
    across = a.join(b, (a["band"] == b["band"]) & (F.col("a_middle") != F.col("b_middle")) & once & may(nth(a["band"])))
    far = near.where((2 * F.col("step") + 3 > STEPS) & (F.col("middle") >= 0))
    far = far.select(F.explode("bands").alias("band"), *[c for c in near.columns if c != "bands"])
    own = bands.join(far.select("middle").distinct(), "middle", "left_semi").select(*far.columns)
    c, d = side(far, "a_"), side(own, "b_")
    once = (2 * F.col("b_step") + 3 <= STEPS) | (F.col("a_node") > F.col("b_node"))
    within = c.join(d, (c["band"] == d["band"]) & (F.col("a_middle") == F.col("b_middle")) & (F.col("a_node") != F.col("b_node")) & (F.col("a_step") + F.col("b_step") + 3 > STEPS) & once & may(nth(c["band"])))
    ends = [x.select(F.least("a_node", "b_node").alias("u"), F.greatest("a_node", "b_node").alias("v")) for x in (across, within)]
    out = materialize(ends[0].unionByName(ends[1]).distinct(), "pairs")
    discard(near, kinds, mixed)
    return out


def _middles(codes: DataFrame, longest: int, threshold: float) -> DataFrame:
    """(node, middle, step): for vectors that are linked to the first member of a bucket of theirs (of several, the one that
    shares most buckets), that vector and the angle between, in steps of the threshold's angle. The codes decide which of
    these pairs are recomputed, as they do for all others; there is one a vector. The first MIDDLE_BANDS bands are enough: what
    finds no middle there goes the way of all others."""
    bands = codes.select("node", F.explode(F.slice("bands", 1, MIDDLE_BANDS)).alias("band"))
    firsts = materialize(bands.groupBy("band").agg(F.min("node").alias("at"), F.max("node").alias("last")).where("at < last").select("band", "at"), "firsts")
    best = bands.join(firsts, "band").where("node > at").groupBy("node", "at").count().groupBy("node").agg(F.max_by("at", F.struct(F.col("count"), -F.col("at"))).alias("at"))
    side = lambda p: codes.select(*[F.col(c).alias(p + c) for c in ("node", "code", "planes", *FACTS)])
    met = best.join(side("a_"), F.col("node") == F.col("a_node")).join(side("b_"), F.col("at") == F.col("b_node")).where(_one_of(longest, lambda w: upper_bound("a_", "b_", w) >= threshold))
    met = _confirmed(met.select(F.col("node").alias("u"), F.col("at").alias("v")), codes, threshold)
    angle = F.acos(F.least(F.col("cos"), F.lit(1.0)))
    out = materialize(met.select(F.col("u").alias("node"), F.col("v").alias("middle"), F.floor(angle / math.acos(threshold) * STEPS).cast("int").alias("step")), "middles")
    discard(firsts)
    return out


def _sure_links(members: DataFrame) -> DataFrame:
    """(node, sure): how many vectors have the same middle and an angle to it that leaves no doubt, from (node, middle, step,
    weight). Counted on steps: at most STEPS rows a middle, however many vectors share it."""
    steps = materialize(members.groupBy("middle", "step").agg(F.sum("weight").alias("w")), "steps")
    asks = steps.select("middle", (STEPS - 3 - F.col("step")).alias("upto"), F.lit(0).cast("long").alias("w"), F.col("step").alias("of"))
    run = Window.partitionBy("middle").orderBy("upto", F.col("of").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    both = steps.select("middle", F.col("step").alias("upto"), "w", F.lit(None).cast("int").alias("of")).unionByName(asks)
    within = both.withColumn("all", F.sum("w").over(run)).where("of is not null").select("middle", F.col("of").alias("step"), "all")
    own = F.when(2 * F.col("step") + 3 <= STEPS, F.col("weight")).otherwise(F.lit(0))
    return members.join(materialize(within, "within"), ["middle", "step"]).select("node", (F.col("all") - own).alias("sure"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row a row of vectors (vec_id, embedding): vec_id, n_links, component_id, kept.

    Nulls: a null or empty vector, one of zeros, or one with a null or non-finite component links with nothing (n_links 0)
    and is kept. A row with a null id is no node: component_id null, kept. Repeated rows count once; an id with several
    different vectors has one component_id, and each of them its own n_links, which counts the id's other vectors too. Vectors of
    other lengths link among themselves. No rows: no rows. Other columns are ignored. Every link found is confirmed in double precision.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda c: c.cast("double")).alias("v"))
    ok = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0) & F.col("vec_id").isNotNull()
    rows = rows.select("vec_id", F.when(F.coalesce(ok, F.lit(False)), F.transform("v", lambda c: F.when(c == 0, F.lit(0.0)).otherwise(c))).alias("v"))
    # equal vectors, told by 128 bits, are one class; its smallest id stands for it
    same = ["same1", "same2"]
    rows = rows.withColumns({"same1": F.when(F.col("v").isNotNull(), F.xxhash64("v")), "same2": F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(2), "v"))})
    members = materialize(rows.where(F.col("v").isNotNull()).distinct(), "members")
    classes = materialize(members.groupBy(*same).agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight")), "classes")
    reps = members.join(classes.select(F.col("id").alias("vec_id"), *same), ["vec_id", *same]).select(F.col("vec_id").alias("id"), "v", *same)
    reps = reps.repartitionByRange("id").sortWithinPartitions("id", *same).withColumn("node", F.monotonically_increasing_id())  # in order of ids; an id can stand for several classes
    reps = materialize(reps, "representatives")
    bits, n_bands = bands_for(reps.count(), threshold)
    schema = "node long, v array<double>, code array<long>, planes array<long>, " + ", ".join(f"{f} double" for f in FACTS) + ", bands array<long>"
    codes = materialize(arrow_map(reps.select("node", "v"), _codes(bits, n_bands), schema, 2_000), "codes")
    longest = codes.agg(F.max(F.size("code"))).collect()[0][0] or 1
    middles = _middles(codes, longest, threshold)
    pairs = _candidates(codes, middles, longest, threshold, bits)
    links = materialize(_confirmed(pairs, codes, threshold).select("u", "v"), "links")
    labels = connected_components(links, "vectors")
    facts = reps.select("node", *same).join(classes.select(*same, "weight"), same)
    ends = links.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("to")), F.struct(F.col("v").alias("node"), F.col("u").alias("to")))).alias("e")).select("e.*")
    degree = ends.join(facts.select(F.col("node").alias("to"), "weight"), "to").groupBy("node").agg(F.sum("weight").alias("more"))
    counted = _sure_links(middles.join(facts.select("node", "weight"), "node"))
    facts = facts.join(degree, "node", "left").join(counted, "node", "left").join(labels, F.col("node") == F.col("id"), "left")
    facts = facts.select(*same, "node", F.coalesce("component", "node").alias("component"), (F.col("weight") - 1 + F.coalesce("more", F.lit(0)) + F.coalesce("sure", F.lit(0))).alias("n"))
    facts = materialize(facts, "degrees")
    found = members.select("vec_id", *same).join(facts, same).select("vec_id", *same, "component", "n")
    found = materialize(found, "found")
    discard(codes, middles, pairs, links, labels, facts)
    # an id with several vectors joins their components
    several = materialize(found.groupBy("vec_id").agg(F.min("component").alias("u"), F.max("component").alias("w")).where("u < w").select("vec_id", "u"), "several")
    if not several.isEmpty():
        ties = connected_components(found.join(several, "vec_id").select("u", F.col("component").alias("v")), "ids")
        found = found.join(ties.toDF("component", "joined"), "component", "left").select("vec_id", *same, F.coalesce("joined", "component").alias("component"), "n")
    least = materialize(found.groupBy("component").agg(F.min("vec_id").alias("component_id")), "least")
    out = rows.select("vec_id", *same).join(found.join(least, "component").drop("component"), ["vec_id", *same], "left")
    out = out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
