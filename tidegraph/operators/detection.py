"""Events of a multi-channel recording: drift removal, noise floor, threshold crossings, events, triggers.

samples is (electrode, sample, value); more key columns, such as a dataset, are named in `keys`. Order is by sample. What is
sequential runs within blocks of a channel, as the recording is stored: a block is summed up in a row (how it begins and ends, how
many runs begin in it), those rows are scanned in the order of blocks, and each block starts with what the scan brings it. So a channel
is never sorted or held in one piece, and its blocks are dealt out like those of others.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from .tables import drop, keyed_hash, written

KEYS = ("electrode",)
BLOCK = 16_384  # places of a block: samples, or the times of events
TTL_ELECTRODE, TTL_SIGMA, TTL_THRESHOLD, TTL_AMPLITUDE = 1, 100.0, 1000.0, 1500.0


def _begin(samples: DataFrame, keys: list[str]) -> DataFrame:
    """keys and the first sample number: a row a channel."""
    return samples.groupBy(*keys).agg(F.min("sample").alias("begin"))


def first_mean(samples: DataFrame, n: int, keys: Iterable[str] = KEYS, short: str = "raise") -> DataFrame:
    """Mean of each channel's first n samples, whose numbers have no gaps. The filter cannot be started on a channel with
    fewer: that raises when the result is used, or with short='drop' such channels are left out."""
    keys = list(keys)
    head = samples.join(_begin(samples, keys), keys).where(F.col("sample") < F.col("begin") + n)
    mean = head.groupBy(*keys).agg(F.avg("value").alias("start_mean"), F.count(F.lit(1)).alias("n"))
    if short == "drop":
        return mean.where(F.col("n") == n).drop("n")
    return mean.select(*keys, F.when(F.col("n") == n, F.col("start_mean")).otherwise(F.raise_error(F.format_string(f"a channel has %d samples where {n} are needed", "n")).cast("double")).alias("start_mean"))


def remove_drift(samples: DataFrame, start: DataFrame, alpha: float, block: int = 4096, keys: Iterable[str] = KEYS) -> DataFrame:
    """samples with drift (running mean after the sample) and filtered = value - drift, drift' = (1 - alpha) drift + alpha value.

    start: keys and start_mean, the drift before the first sample. Sample numbers of a channel must have no gaps. Within a
    block the recurrence is a weighted prefix sum; a block's contribution fades by (1 - alpha)^block, so a block's start is
    the sum over the few blocks before it that double precision still sees. No channel is folded in one piece.
    """
    keys = list(keys)
    q = 1.0 - alpha
    block = max(1, min(block, int(300 / -math.log(q))))  # weights stay within double range
    back = max(1, math.ceil(40 / (-math.log(q) * block)))
    s = samples.join(_begin(samples, keys), keys).withColumn("at", F.col("sample") - F.col("begin"))
    s = s.withColumn("block", F.floor(F.col("at") / block)).withColumn("place", F.col("at") % block)
    weighted = F.lit(alpha) * F.col("value") * F.pow(F.lit(q), -(F.col("place") + 1).cast("double"))
    ends = s.groupBy(*keys, "block").agg((F.sum(weighted) * F.pow(F.lit(q), F.count(F.lit(1)).cast("double"))).alias("own"), F.count(F.lit(1)).alias("n")).join(start, keys)
    order = Window.partitionBy(*keys).orderBy("block")
    before = F.lit(0.0)
    for j in range(1, back + 1):
        before = before + F.coalesce(F.lag("own", j).over(order), F.lit(0.0)) * (q ** (block * (j - 1)))
    before = before + F.when(F.col("block") <= back, F.col("start_mean") * F.pow(F.lit(q), (F.col("block") * block).cast("double"))).otherwise(F.lit(0.0))
    ends = ends.withColumn("before", before).select(*keys, "block", "before")
    run = Window.partitionBy(*keys, "block").orderBy("sample").rowsBetween(Window.unboundedPreceding, 0)
    out = s.withColumn("run", F.sum(weighted).over(run)).join(ends, [*keys, "block"])
    out = out.withColumn("drift", F.pow(F.lit(q), (F.col("place") + 1).cast("double")) * (F.col("before") + F.col("run")))
    return out.select(*samples.columns, "drift", (F.col("value") - F.col("drift")).alias("filtered"))


def noise_rounds(samples: DataFrame, rounds: int, keys: Iterable[str] = KEYS, clip: float = 3.0) -> DataFrame:
    """Noise floor after a fixed number of clipping rounds: keys, sigma, mu, n.

    Counts and sums run on over the rounds, so a sample that stays counts once a round. The first round keeps all. Each
    round is one aggregation with partial sums; channels are joined back by key, a row each.
    """
    keys = list(keys)
    value = F.col("value").cast("double")
    add = lambda d: d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n1"), F.sum(value).alias("s1"), F.sum(value * value).alias("q1"))
    total = None
    for _ in range(rounds):
        if total is None:
            total = add(samples).toDF(*keys, "n", "s", "q")
        else:
            kept = samples.join(total.select(*keys, "mu", "sigma"), keys).where(F.abs(value - F.col("mu")) < clip * F.col("sigma"))
            total = total.join(add(kept), keys, "left").select(*keys, *[(F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a) for a, b in (("n", "n1"), ("s", "s1"), ("q", "q1"))])
        total = total.withColumn("mu", F.col("s") / F.col("n")).withColumn("sigma", F.when(F.col("n") > 1, F.sqrt(F.greatest((F.col("q") - F.col("s") * F.col("s") / F.col("n")) / (F.col("n") - 1), F.lit(0.0)))))
        total = written(total, "noise")  # a row a channel; without it each round's plan would hold the last one's twice
    return total.select(*keys, "sigma", "mu", "n")


def converged_noise(values: Iterable[float], counts: Iterable[int] | None = None, clip: float = 3.0, tolerance: float = 0.01, most: int = 1000) -> tuple[float, float, int, int]:
    """(sigma, mu, rounds, running count) of one channel, from its values or its value counts."""
    x = np.asarray(values if isinstance(values, np.ndarray) else list(values), float)
    c = np.ones(len(x)) if counts is None else np.asarray(counts if isinstance(counts, np.ndarray) else list(counts), float)
    return binned_noise(x, x, c, c * x, c * x * x, clip, tolerance, most)[:4]


def binned_noise(low: np.ndarray, high: np.ndarray, c: np.ndarray, s1: np.ndarray, s2: np.ndarray, clip: float = 3.0, tolerance: float = 0.01, most: int = 1000) -> tuple[float, float, int, int, list[int]]:
    """Rounds on bins (least and largest value, count, sum and sum of squares of each): sigma, mu, rounds, running count, and which bins a
    bound fell into, so that only part of them should have been counted; without any the result is that of the values. Such a bin is
    counted by its mean, which shows about where later rounds' bounds come to."""
    n = s = q = 0.0
    sigma, mu, rounds, cut = math.inf, 0.0, 0, np.zeros(len(c), bool)
    middle = s1 / np.maximum(c, 1)
    while rounds < most:
        if rounds:
            inner, outer = np.abs(low - mu) < clip * sigma, np.abs(high - mu) < clip * sigma
            cut |= (inner != outer) | (~inner & (low < mu) & (high > mu))
            stay = np.where(inner == outer, inner, np.abs(middle - mu) < clip * sigma)
        else:
            stay = np.ones(len(c), bool)
        n, s, q = n + c[stay].sum(), s + s1[stay].sum(), q + s2[stay].sum()
        last, sigma, mu, rounds = sigma, math.sqrt(max((q - s * s / n) / max(n - 1, 1), 0.0)), s / n, rounds + 1
        if abs(last - sigma) < tolerance:
            break
    return sigma, mu, rounds, int(n), np.flatnonzero(cut).tolist()


NOISE_BINS = 4_096


def noise_floor(samples: DataFrame, clip: float = 3.0, tolerance: float = 0.01, keys: Iterable[str] = KEYS, bins: int = NOISE_BINS) -> DataFrame:
    """Noise floor to convergence: keys, sigma, mu, rounds, n, as from all values.

    Values are summed into at most `bins` bins of a channel before the shuffle, so any number of values of any kind meets
    as a bounded row. Rounds run on the bins; where a bound falls into a bin of several values, those of that bin, a thin slice
    near the bound, are counted one by one in a further pass and the rounds run again, until none does. Values that are null,
    infinite or no number are left out; a channel without others has no row.
    """
    keys = list(keys)
    ship(samples.sparkSession)
    fields = {f.name: f.dataType.simpleString() for f in samples.schema}
    kept = samples.select(*keys, F.col("value").cast("double").alias("value")).where((F.abs("value") < float("inf")) & ~F.isnan("value"))
    ends = written(kept.groupBy(*keys).agg(F.min("value").alias("least"), F.max("value").alias("most")), "noise-ends")
    width = (F.col("most") - F.col("least")) / bins
    kept = kept.join(ends, keys).withColumn("bin", F.when(width > 0, F.least(F.floor((F.col("value") - F.col("least")) / width), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")).select(*keys, "bin", "value")
    sums = lambda d, *by: d.groupBy(*keys, *by).agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count(F.lit(1)).alias("c"), F.sum("value").alias("s1"), F.sum(F.col("value") * F.col("value")).alias("s2"))
    table = written(sums(kept, "bin"), "noise-bins")
    names, spec = ["bin", "low", "high", "c", "s1", "s2"], ", ".join(f"`{k}` {fields[k]}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(len(keys)):
                b, low, high, c, s1, s2 = (x.values.field(n).to_numpy(False) for n in names)
                *found, cut = binned_noise(low, high, c.astype(float), s1, s2, clip, tolerance)
                out.append((*found, sorted({int(b[i]) for i in cut})))
            columns = [pa.array([o[j] for o in out], t) for j, t in enumerate((pa.float64(), pa.float64(), pa.int32(), pa.int64(), pa.list_(pa.int32())))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *columns], [*keys, "sigma", "mu", "rounds", "n", "cut"])

    while True:
        channel = table.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("low", *[n for n in names if n != "low"]))).alias("x"))
        result = written(channel.mapInArrow(run, spec + ", sigma double, mu double, rounds int, n long, cut array<int>"), "noise-rounds")
        cut = result.select(*keys, F.explode("cut").alias("bin"))
        if cut.isEmpty():
            drop(table, ends)
            return result.drop("cut")
        exact = sums(kept.join(cut, [*keys, "bin"], "left_semi"), "bin", "value").drop("value")
        old = table
        table = written(table.join(cut, [*keys, "bin"], "left_anti").unionByName(exact), "noise-bins")
        drop(old, result)


def thresholds(noise: DataFrame, factor: float = 4.0) -> DataFrame:
    """factor x sigma a channel; the trigger channel has a sigma of its own."""
    sigma = F.when(F.col("electrode") == TTL_ELECTRODE, F.lit(TTL_SIGMA)).otherwise(F.col("sigma"))
    return noise.select("electrode", (sigma * factor).alias("threshold"))


def _carried(ends: DataFrame, keys: list[str], **over: Column) -> DataFrame:
    """Block summaries (keys, block, ...) with columns over the blocks of the channel that come before: a row a block is sorted,
    not a row a sample."""
    order = Window.partitionBy(*keys).orderBy("block")
    return ends.withColumns({n: c.over(order.rowsBetween(Window.unboundedPreceding, -1)) for n, c in over.items()})


def previous(d: DataFrame, column: str, order: str, keys: Iterable[str] = KEYS, block: int = BLOCK) -> DataFrame:
    """d with `previous`: the value of `column` in the row before, by the whole-numbered `order` within the keys; null in the
    first row. Rows alike in keys and order come in no order of their own."""
    keys = list(keys)
    d = d.withColumn("block", F.floor(F.col(order) / block))
    within = Window.partitionBy(*keys, "block").orderBy(order)
    ends = d.groupBy(*keys, "block").agg(F.max_by(F.struct(F.col(column).alias("x")), order).alias("end"))
    ends = _carried(ends, keys, before=F.last("end")).select(*keys, "block", "before")
    d = d.withColumn("lag", F.lag(F.struct(F.col(column).alias("x"))).over(within)).join(ends, [*keys, "block"])
    return d.withColumn("previous", F.coalesce("lag", "before")["x"]).drop("block", "lag", "before")


def _hot(samples: DataFrame, hot: Column, keys: list[str], block: int = BLOCK) -> DataFrame:
    """samples with hot, was (the sample before was hot) and run, the number of the last run of hot samples that has begun.

    A block's summary is whether it begins and ends hot and how many runs begin behind its first sample; whether its first
    sample begins one too depends on the end of the block before. Two scans over the summaries give each block the state that it
    starts from and the number of runs before it.
    """
    s = samples.withColumn("hot", F.coalesce(hot, F.lit(False))).withColumn("block", F.floor(F.col("sample") / block))
    within = Window.partitionBy(*keys, "block").orderBy("sample")
    s = s.withColumn("lag", F.lag("hot").over(within))
    begins = F.when(F.col("hot") & ~F.col("lag"), 1).otherwise(0)  # null in a block's first row
    ends = s.groupBy(*keys, "block").agg(F.min_by("hot", "sample").alias("first"), F.max_by("hot", "sample").alias("last"), F.sum(begins).alias("inner"))
    ends = _carried(ends, keys, before=F.last("last")).withColumn("before", F.coalesce("before", F.lit(False)))
    ends = ends.withColumn("starts", F.col("inner") + F.when(F.col("first") & ~F.col("before"), 1).otherwise(0))
    ends = _carried(ends, keys, base=F.sum("starts")).select(*keys, "block", "before", F.coalesce("base", F.lit(0)).alias("base"))
    s = s.join(ends, [*keys, "block"]).withColumn("was", F.coalesce("lag", "before"))
    runs = F.sum(F.when(F.col("hot") & ~F.col("was"), 1).otherwise(0)).over(within.rowsBetween(Window.unboundedPreceding, 0))
    return s.withColumn("run", F.col("base") + runs).drop("block", "lag", "before", "base")


def _below(samples: DataFrame, limits: DataFrame, keys: list[str], block: int) -> DataFrame:
    return _hot(samples.join(limits, keys), F.col("value") < -F.col("threshold"), keys, block)  # strictly below


def crossings(samples: DataFrame, limits: DataFrame, keys: Iterable[str] = KEYS, block: int = BLOCK) -> DataFrame:
    """keys, sample, direction: 'up' at the first sample beyond the threshold, 'down' at the first one back. A null value is
    not beyond it."""
    keys = list(keys)
    s = _below(samples, limits, keys, block).where(F.col("hot") != F.col("was"))
    return s.select(*keys, "sample", F.when(F.col("hot"), F.lit("up")).otherwise(F.lit("down")).alias("direction"))


def candidates(samples: DataFrame, limits: DataFrame, keys: Iterable[str] = KEYS, block: int = BLOCK) -> DataFrame:
    """keys, up, down, width, spike_time, amplitude: one row a run beyond the threshold that has come back.

    The frame takes in the first sample back; spike_time is that of the lowest value, the first on ties. A run may go over
    any number of blocks: its number is the same in all of them, and its parts are summed before they meet.
    """
    keys = list(keys)
    s = _below(samples, limits, keys, block).where(F.col("hot") | F.col("was"))
    runs = s.groupBy(*keys, "run").agg(
        F.min("sample").alias("up"), F.max(F.when(~F.col("hot"), F.col("sample"))).alias("down"), F.min(F.when(F.col("value").isNotNull(), F.struct("value", "sample"))).alias("low"),
    )
    return runs.where("down is not null").select(*keys, "up", "down", (F.col("down") - F.col("up")).alias("width"), F.col("low.sample").alias("spike_time"), (-F.col("low.value")).alias("amplitude"))


def keep_rule(found: DataFrame, max_width: int = 50, min_gap: int = 5, keys: Iterable[str] = KEYS, block: int = BLOCK) -> DataFrame:
    """found with kept: narrow enough, and far enough from the candidate before it, kept or not."""
    d = previous(found, "spike_time", "spike_time", keys, block)
    d = d.withColumn("gap", F.col("spike_time") - F.col("previous")).drop("previous")
    return d.withColumn("kept", (F.col("width") <= max_width) & (F.col("gap").isNull() | (F.col("gap") > min_gap)))


def detect(samples: DataFrame, limits: DataFrame, max_width: int = 50, min_gap: int = 5, keys: Iterable[str] = KEYS, block: int = BLOCK) -> DataFrame:
    """The events: keys, spike_time, width, amplitude."""
    found = keep_rule(candidates(samples, limits, keys, block), max_width, min_gap, keys, block)
    return found.where("kept").select(*keys, "spike_time", "width", "amplitude")


def trigger_edges(samples: DataFrame, hot: Column | None = None, keys: Iterable[str] = KEYS, block: int = BLOCK) -> DataFrame:
    """keys, sample, amplitude at each rising edge of a trigger channel."""
    keys = list(keys)
    s = _hot(samples, F.col("value") < -TTL_THRESHOLD if hot is None else hot, keys, block)
    return s.where("hot AND NOT was").select(*keys, "sample", F.lit(TTL_AMPLITUDE).alias("amplitude"))


def trigger_intervals(edges: DataFrame, keys: Iterable[str] = KEYS, block: int = BLOCK) -> DataFrame:
    """keys, n, total and mean of the intervals between triggers."""
    keys = list(keys)
    d = previous(edges, "sample", "sample", keys, block).withColumn("gap", F.col("sample") - F.col("previous")).where("gap is not null")
    return d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("gap").cast("long").alias("total"), F.avg("gap").alias("mean"))


def in_order(spikes: DataFrame, keys: Iterable[str] = KEYS) -> DataFrame:
    """spikes of all channels by time, then keys, in files that follow one another: sorted by ranges, not in one task."""
    order = ["spike_time", *keys]
    return spikes.repartitionByRange(*order).sortWithinPartitions(*order)


def buffers(samples: DataFrame, size: int, left: int, right: int, keys: Iterable[str] = KEYS) -> DataFrame:
    """samples dealt to overlapping buffers: buffer, start, stop (exclusive) added; a sample near an edge is in two."""
    keys = list(keys)
    ends = samples.groupBy(*keys).agg(F.min("sample").alias("lo"), (F.max("sample") + 1).alias("hi"))
    own = F.floor((F.col("sample") - F.col("lo")) / size)
    near = F.array_distinct(F.array(own, F.floor((F.col("sample") - F.col("lo") + left) / size), F.floor((F.col("sample") - F.col("lo") - right - 1) / size)))
    s = samples.join(ends, keys).withColumn("buffer", F.explode(near)).where(F.col("buffer") >= 0)
    s = s.withColumn("start", F.greatest(F.col("lo"), F.col("lo") + F.col("buffer") * size - left)).withColumn("stop", F.least(F.col("hi"), F.col("lo") + (F.col("buffer") + 1) * size + right + 1))
    whole = F.col("lo") + F.col("buffer") * size < F.col("hi")
    return s.where(whole & (F.col("sample") >= F.col("start")) & (F.col("sample") < F.col("stop"))).drop("lo", "hi")


def interior(spikes: DataFrame, left: int, right: int) -> DataFrame:
    """Spikes whose whole window lies in their buffer (columns start, stop)."""
    return spikes.where((F.col("spike_time") >= F.col("start") + left) & (F.col("spike_time") < F.col("stop") - right))


ROUNDS, WALK = 4, 256
STRETCH, DRAWN = 10_000, 50_000  # places of a channel that stay together, places drawn by a task


def shuffled_place(i: Column, span: Column, *key: Column | int | str) -> Column:
    """Where place i of [0, span) comes to under a keyed permutation of [0, span).

    A Feistel network permutes the smallest square of a power of two that holds the span: the two halves of a number change
    places, one of them mixed with a keyed hash of the other, ROUNDS times. Numbers that fall outside go through it again, which keeps it a
    permutation of those inside; at least a quarter of the square is inside, so that WALK passes fail with probability 1e-32, and then raise.
    Passes are made a few at a time, and only for numbers that are outside: most are inside after the first.
    """
    half = F.pow(F.lit(2.0), F.ceil(F.log2(F.sqrt(F.greatest(span, F.lit(1)).cast("double"))))).cast("long")
    half = F.when(half * half < span, half * 2).otherwise(half)
    div = lambda a, b: F.call_function("div", a, b)
    few = round(WALK**0.5)

    def once(x: Column, h: Column) -> Column:
        mixed = lambda s, r: F.struct(s["b"].alias("a"), s["a"].bitwiseXOR(keyed_hash(*key, r, s["b"]) % h).alias("b"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), F.struct(div(x, h).alias("a"), (x % h).alias("b")), mixed, lambda out: out["a"] * h + out["b"])

    def walked(h: Column) -> Column:
        step = lambda x: F.when(x < span, x).otherwise(once(x, h))
        some = lambda x: F.when(x < span, x).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(few)), x, lambda y, _: step(y)))
        inside = lambda x: F.when(x < span, x).otherwise(F.raise_error(F.lit("a place was not found")).cast("long"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(WALK // few)), once(i.cast("long"), h), lambda x, _: some(x), inside)

    return F.element_at(F.transform(F.array(half), walked), 1)  # half is computed once a row


def random_events(spans: DataFrame, rate: float, seed: int = 0, keys: Iterable[str] = KEYS) -> DataFrame:
    """Noise events without replacement: n = round(rate x span) sample numbers of each channel (keys, first, span), every
    set of n alike likely, the same for the same seed. They are the first n places of the span under a keyed permutation, so no channel
    is laid out or sorted for it: work and memory are those of the events, dealt into tasks of about DRAWN events, stretches of a long channel
    by themselves. rate is at most 1; rows without a span give none."""
    if not 0 <= rate <= 1:
        raise ValueError("rate lies in [0, 1]")
    keys = list(keys)
    at = written(spans.withColumn("n", F.round(F.col("span") * rate).cast("long")).where("n > 0"), "spans")  # a row a channel
    tasks = max(1, -(-at.agg(F.coalesce(F.sum("n"), F.lit(0))).collect()[0][0] // DRAWN))
    at = at.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(STRETCH).cast("long")))).repartition(tasks, *keys, "from")
    at = at.withColumn("i", F.explode(F.sequence("from", F.least(F.col("from") + STRETCH, F.col("n")) - 1)))
    return at.select(*keys, (F.col("first") + shuffled_place(F.col("i"), F.col("span"), seed, *[F.col(k) for k in keys])).alias("spike_time"))


def drop_near_spikes(noise: DataFrame, spikes: DataFrame, width: float = 20.0, first_only: bool = False, keys: Iterable[str] = KEYS) -> DataFrame:
    """noise without the events whose bin round(t / width) holds a spike; first_only drops but the first of such a bin."""
    keys = list(keys)
    bin_of = lambda d: d.withColumn("bin", F.round(F.col("spike_time") / width).cast("long"))
    taken = bin_of(spikes).select(*keys, "bin").distinct()
    n = bin_of(noise)
    if not first_only:
        return n.join(taken, [*keys, "bin"], "left_anti").drop("bin")
    n = n.withColumn("nth", F.row_number().over(Window.partitionBy(*keys, "bin").orderBy("spike_time")))
    return n.join(taken.withColumn("hit", F.lit(True)), [*keys, "bin"], "left").where("hit is null or nth > 1").drop("bin", "nth", "hit")
