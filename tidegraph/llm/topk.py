"""Exact top-k by inner product with a pivot-distance index.

Vectors are lifted by one component to equal length, so the largest inner product is the least distance. The index keys a
vector by its nearest pivot and its distance to it, and cuts each pivot's sorted distances into rings, the annuli. A query
first searches what lies about its own pivot at its own distance, which gives a k-th best score to beat; then the annuli
around every pivot are taken in as far as the triangle inequality |d(q, p) - d(v, p)| <= d(q, v) leaves room for a better
score, and no further. Scores are integer sums in double precision, exact below 2^53.

Scale: pivots are fitted on a bounded sample; everything else is distributed. There are about as many pivots as twice the root of the
number of vectors, MOST_PIVOTS at most, and RINGS annuli at most, of RING rows or more: a table of a few numbers each, which is what the
bound is tested against. Annuli that follow one another are dealt together in blocks of about BLOCK rows. A task holds the
vectors of one block as a matrix and streams the queries that reach some annulus of it past it, and scores them against
those annuli only; vectors move once, a query once for each block that it reaches. Where very many queries reach a block they
are dealt to several tasks with a copy of it each. Equal distances by the thousand are split too. What a task returns is k
rows a query at most, and those at or above the score to beat only. share_reached() says how much of the table is scored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, discard, materialize, parts, ship

LEAST_PIVOTS, MOST_PIVOTS = 32, 512
SAMPLE = 4_000  # rows that the pivots are fitted on
RING, RING_MOST, RINGS = 32, 262_144, 4_096  # rows of an annulus: the table over RINGS, within these bounds
BLOCK = 8_192  # rows that are dealt together
CELLS = 1 << 22  # scores at once


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v): floor(scale x component); rows with a null or empty vector or a null or non-finite component take no
    part."""
    x = F.transform(F.col("embedding"), lambda c: c.cast("double"))
    ok = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = vectors.where(F.coalesce(ok, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale).cast("double")).alias("v"))
    return v.where("vec_id is not null")


def _pivots(v: DataFrame, dims: int, longest: float, pivots: int, sample: int) -> np.ndarray:
    """Centres of a few rounds of k-means over a bounded sample of lifted vectors."""
    rows = v.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").collect()
    x = _lift(np.array([r[0] for r in rows]).reshape(-1, dims), longest)
    rng = np.random.default_rng(3)
    c = x[rng.permutation(len(x))[:pivots]]
    for _ in range(6):
        near = np.argmin((c * c).sum(1)[None, :] - 2 * x @ c.T, 1)
        c = np.array([x[near == i].mean(0) if (near == i).any() else c[i] for i in range(len(c))])
    d, order, left = _dist(c, c), [0], np.ones(len(c), bool)
    for _ in range(len(c) - 1):  # each pivot beside one near it, so that a block's annuli lie together
        left[order[-1]] = False
        order.append(int(np.argmin(np.where(left, d[order[-1]], np.inf))))
    return c[order]


def _lift(x: np.ndarray, longest: float) -> np.ndarray:
    return np.concatenate((x, np.sqrt(np.maximum(longest - (x * x).sum(1), 0))[:, None]), 1)


def _matrix(col: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(col.flatten()).reshape(-1, dims)


def _dist(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * x @ c.T, 0))


def _search(q_ids: np.ndarray, q: np.ndarray, beat: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, room: np.ndarray | None = None, spans: list[tuple[int, int]] = ()) -> tuple[np.ndarray, ...]:
    """(query, id, score) of the k best ids of x for each query, at or above the score to beat; with room (queries x spans),
    only in the spans of x that have room. The rows of one id count as the best of them."""
    order = np.argsort(ids, kind="stable")
    own, first = np.unique(ids[order], return_index=True)
    out: tuple[list, ...] = ([], [], [])
    step = max(1, CELLS // len(ids))
    for at in range(0, len(q), step):
        here = q_ids[at : at + step]
        if room is None:
            s = q[at : at + step] @ x.T
        else:
            s = np.full((len(here), len(ids)), -np.inf)
            for j, (a, b) in enumerate(spans):
                some = np.flatnonzero(room[at : at + step, j])
                if len(some):
                    s[some, a:b] = q[at + some] @ x[a:b].T
        s = s[:, order]
        if len(own) < len(ids):
            s = np.maximum.reduceat(s, first, axis=1)
        place = np.minimum(np.searchsorted(own, here), len(own) - 1)
        same = np.flatnonzero(own[place] == here)
        s[same, place[same]] = -np.inf
        s[s < beat[at : at + step, None]] = -np.inf
        best = np.argsort(-s, axis=1, kind="stable")[:, :k] if s.shape[1] <= 64 else _best(s, k)
        r, c = np.repeat(np.arange(len(here)), best.shape[1]), best.ravel()
        ok = s[r, c] > -np.inf
        for o, v in zip(out, (here[r[ok]], own[c[ok]], s[r[ok], c[ok]].astype(np.int64)), strict=True):
            o.append(v)
    return tuple(np.concatenate(o) for o in out)


class Annuli(NamedTuple):
    """Of an index: its pivots, and of each annulus its pivot, its least and largest distance, its rows and its block; length of lifted vectors."""

    centre: np.ndarray
    pivot: np.ndarray
    low: np.ndarray
    high: np.ndarray
    rows: np.ndarray
    block: np.ndarray
    longest: float

    def room(self, q: np.ndarray, beat: np.ndarray, some: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Queries x annuli (some of them): whether a score as good as the one to beat may be there."""
        far = np.sqrt(np.maximum((q * q).sum(1) + self.longest - 2 * np.maximum(beat, -1e300), 0)) * (1 + 1e-9) + 1e-6
        d = _dist(np.concatenate((q, np.zeros((len(q), 1))), 1), self.centre)[:, self.pivot[some]]
        return (self.low[some][None] - d <= far[:, None]) & (d - self.high[some][None] <= far[:, None])


FOUND = "query_id long, vec_id long, score long"


def _met(dims: int, k: int, annuli: Annuli | None):
    """Streams rows (block, share, is_query, id, v, beat, annulus), a block's vectors first, and searches it for its queries: all of it, or
    with annuli where there is room."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, block, some, spans = None, [], None, None, []
        for whole in batches:
            for batch in parts(whole, 4_096, 4 << 20):
                key = np.stack([np.asarray(batch.column(i)).astype(np.int64) for i in range(3)], 1)
                cuts = np.concatenate(([0], np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, [len(key)]))
                ids, x, beat, ring = np.asarray(batch.column(3)), _matrix(batch.column(4), dims), np.asarray(batch.column(5)), np.asarray(batch.column(6))
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    if now != tuple(key[a, :2]):
                        now, held, block = tuple(key[a, :2]), [], None
                    if not key[a, 2]:
                        held.append((ids[a:b], x[a:b], ring[a:b]))
                        continue
                    if block is None:
                        every, rows, rings = (np.concatenate(h) for h in zip(*held, strict=True))
                        order = np.argsort(rings, kind="stable")
                        block, held = (every[order], rows[order]), []
                        some, first, count = np.unique(rings[order], return_index=True, return_counts=True)
                        spans = [(int(f), int(f + c)) for f, c in zip(first, count, strict=True)]
                    room = annuli.room(x[a:b], beat[a:b], some) if annuli is not None else None
                    found = _search(ids[a:b], x[a:b], beat[a:b], *block, k, room, spans)
                    if len(found[0]):
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["query_id", "vec_id", "score"])

    return run


def _best(s: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest of each row, ties to the smaller column."""
    kth = -np.partition(-s, k - 1, axis=1)[:, k - 1 : k]
    above, level = s > kth, s == kth
    level &= np.cumsum(level, 1) <= k - above.sum(1, keepdims=True)
    cols = np.nonzero(above | level)[1].reshape(len(s), k)
    return np.take_along_axis(cols, np.argsort(-np.take_along_axis(s, cols, 1), axis=1, kind="stable"), 1)


def _sizes(v: DataFrame, every: int) -> list:
    """longest (squared), asked, n of each length of vectors that has queries: a row a length."""
    asked = F.sum((F.col("vec_id") % every == 0).cast("int"))
    return v.groupBy("dims").agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)).alias("longest"), asked.alias("asked"), F.count(F.lit(1)).alias("n")).where("asked > 0").orderBy("dims").collect()


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256, pivots: int | None = None, sample: int = SAMPLE, ring: int | None = None, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for queries with vec_id divisible by `every` against every other row.

    Nulls: see quantised(); a null vec_id takes no part either. Ties go to the smaller vec_id. Fewer than k others: all of
    them. Repeated rows of one vec_id count once; where they have different vectors, with the highest score that any of
    them has (rows with the query's id are never its candidates). No rows: no rows. Vectors of other lengths are searched
    among themselves, an index for each length, one after another; very long vectors are rows like others. Columns other than vec_id and
    embedding are ignored. Exact while |scores| stay below 2^53.
    """
    spark = ship(vectors.sparkSession)
    v = materialize(quantised(vectors, scale).distinct().withColumn("dims", F.size("v")), "vectors")
    found = spark.createDataFrame([], FOUND)
    for r in _sizes(v, every):
        index = Index(v.where(F.col("dims") == r["dims"]).drop("dims"), r, every, pivots, sample, ring, block)
        found = found.unionByName(index.best(k))
    nth = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(nth)).where(f"rank <= {k}")
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def share_reached(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256, pivots: int | None = None, sample: int = SAMPLE, ring: int | None = None, block: int = BLOCK) -> float:
    """Which part of all pairs of a query and a vector top_k() scores once it knows a score to beat."""
    v = materialize(quantised(vectors, scale).distinct().withColumn("dims", F.size("v")), "vectors")
    scored = every_pair = 0
    for r in _sizes(v, every):
        index = Index(v.where(F.col("dims") == r["dims"]).drop("dims"), r, every, pivots, sample, ring, block)
        scored, every_pair = scored + index.scored(k), every_pair + r["asked"] * r["n"]
    return scored / max(every_pair, 1)


class Index:
    """The index of vectors (vec_id, v) of one length, and its queries."""

    def __init__(self, v: DataFrame, size, every: int, pivots: int | None, sample: int, ring: int | None, block: int):
        self.dims, longest, n = size["dims"], size["longest"], size["n"]
        pivots = min(max(LEAST_PIVOTS, 2 * math.isqrt(n)), MOST_PIVOTS) if pivots is None else pivots
        ring = min(max(-(-n // RINGS), RING), RING_MOST) if ring is None else ring
        centre, dims = _pivots(v, self.dims, longest, pivots, sample), self.dims

        def near(batch: pa.RecordBatch) -> pa.RecordBatch:
            d = _dist(_lift(_matrix(batch.column(1), dims), longest), centre)
            p = np.argmin(d, 1)
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p.astype(np.int32)), pa.array(d[np.arange(len(p)), p])], ["vec_id", "v", "pivot", "dist"])

        keyed = arrow_map(v, near, "vec_id long, v array<double>, pivot int, dist double", 2_000)
        # rings: a pivot's distances in fine steps, gathered into rings of about `ring` rows; a full step is split by a hash
        step = max(np.sqrt(longest), 1.0) / 256
        keyed = materialize(keyed.withColumn("step", F.floor(F.col("dist") / step)), "keyed")
        counts = materialize(keyed.groupBy("pivot", "step").agg(F.count(F.lit(1)).alias("n")), "steps")  # pivots x 512 rows at most
        upto = Window.partitionBy("pivot").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
        rings = counts.withColumn("ring", F.floor(F.coalesce(F.sum("n").over(upto), F.lit(0)) / ring)).withColumn("parts", F.ceil(F.col("n") / max(ring, block))).drop("n")
        keyed = keyed.join(F.broadcast(rings), ["pivot", "step"]).withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), F.col("parts")).cast("int"))
        keyed = materialize(keyed.select("vec_id", "v", "dist", F.struct("pivot", "ring", "part").alias("place")), "placed")
        found = sorted(keyed.groupBy("place").agg(F.min("dist").alias("low"), F.max("dist").alias("high"), F.count(F.lit(1)).alias("rows")).collect(), key=lambda r: tuple(r["place"]))
        rows = np.array([r["rows"] for r in found], np.int64)
        number = np.concatenate(([0], np.cumsum(rows)[:-1])) // block if len(found) else rows
        self.annuli = Annuli(centre, np.array([r["place"]["pivot"] for r in found], int), np.array([r["low"] for r in found]), np.array([r["high"] for r in found]), rows, number, longest)
        table = v.sparkSession.createDataFrame([(tuple(r["place"]), i, int(number[i])) for i, r in enumerate(found)], "place struct<pivot:int,ring:long,part:int>, annulus int, block long")
        self.placed = materialize(keyed.join(F.broadcast(table), "place").select("block", "annulus", "vec_id", "v"), "annuli")
        self.shares = -(-size["asked"] // max(65_536, 2 * block, 2 * ring))
        self.queries = materialize(self.placed.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "block"), "queries")
        discard(keyed, counts)

    def _search(self, queries: DataFrame, k: int, annuli: Annuli | None) -> DataFrame:
        """queries: (block, query_id, q, beat)"""
        share = F.pmod(F.xxhash64("query_id"), F.lit(self.shares)).cast("int")
        asks = queries.select("block", share.alias("share"), F.lit(True).alias("is_query"), F.col("query_id").alias("id"), F.col("q").alias("v"), "beat", F.lit(-1).alias("annulus"))
        have = self.placed.select("block", F.explode(F.sequence(F.lit(0), F.lit(self.shares - 1))).alias("share"), F.lit(False).alias("is_query"), F.col("vec_id").alias("id"), "v", F.lit(0.0).alias("beat"), "annulus")
        both = have.unionByName(asks).repartition("block", "share").sortWithinPartitions("block", "share", "is_query")
        return both.mapInArrow(_met(self.dims, k, annuli), FOUND)

    def _asked(self, k: int) -> tuple[DataFrame, DataFrame]:
        """What the queries' own blocks give, and the queries with the score to beat."""
        first = materialize(self._search(self.queries.withColumn("beat", F.lit(float("-inf"))), k, None), "first")
        nth = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        beat = first.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("r", F.row_number().over(nth)).where(f"r = {k}").select("query_id", F.col("score").cast("double").alias("beat"))
        return first, self.queries.join(beat, "query_id", "left").select("query_id", "q", "block", F.coalesce("beat", F.lit(float("-inf"))).alias("beat"))

    def best(self, k: int) -> DataFrame:
        """(query_id, vec_id, score): the best k of each query and more."""
        first, asked = self._asked(k)
        annuli, dims = self.annuli, self.dims

        def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Each query once for each block, but its own, with an annulus that leaves room for a score as good as the one to beat."""
            edge = np.flatnonzero(np.diff(annuli.block, prepend=-1))
            for batch in (p for whole in batches for p in parts(whole, 400)):
                room = np.logical_or.reduceat(annuli.room(_matrix(batch.column(1), dims), np.asarray(batch.column(3))), edge, axis=1)
                room[annuli.block[edge][None] == np.asarray(batch.column(2))[:, None]] = False
                q, a = np.nonzero(room)
                for i in range(0, len(q), 4_096):
                    rows = pa.array(q[i : i + 4_096])
                    yield pa.RecordBatch.from_arrays([pa.array(annuli.block[edge][a[i : i + 4_096]]), batch.column(0).take(rows), batch.column(1).take(rows), batch.column(3).take(rows)], ["block", "query_id", "q", "beat"])

        rest = materialize(self._search(asked.mapInArrow(reach, "block long, query_id long, q array<double>, beat double"), k, annuli), "rest")
        discard(self.placed, self.queries)
        return first.unionByName(rest)

    def scored(self, k: int) -> int:
        """Pairs of a query and a vector in an annulus with room."""
        asked, annuli, dims = self._asked(k)[1], self.annuli, self.dims

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(annuli.room(_matrix(batch.column(0), dims), np.asarray(batch.column(1))) @ annuli.rows)], ["n"])

        return arrow_map(asked.select("q", "beat"), run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).collect()[0][0]
