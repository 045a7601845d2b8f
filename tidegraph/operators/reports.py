"""Averages, histograms and the report over trains: what an editor's panels show."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from .tables import keyed_hash


def contamination(trains: DataFrame, tau: float, n_samples: Column | float, key: str = "neuron_id", time: str = "spike_time") -> DataFrame:
    """key, n, violations, contamination = v n_samples / (tau n^2) with v intervals in (0, tau]; 0 below two events."""
    gap = F.col(time) - F.lag(time).over(Window.partitionBy(key).orderBy(time))
    span = n_samples if isinstance(n_samples, Column) else F.lit(float(n_samples))
    d = trains.withColumn("gap", gap).groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("gap") > 0) & (F.col("gap") <= tau)).alias("violations"))
    return d.withColumn("contamination", F.when(F.col("n") < 2, F.lit(0.0)).otherwise(F.col("violations") * span / (F.lit(float(tau)) * F.col("n") * F.col("n"))))


def clean_filter(stats: DataFrame, least: int, most: float) -> DataFrame:
    """stats with removed: too few events or too contaminated."""
    return stats.withColumn("removed", (F.col("n") < least) | (F.col("contamination") > most))


def rate_histogram(trains: DataFrame, bins: int = 100, key: str = "neuron_id", time: str = "spike_time") -> DataFrame:
    """key, bin (1..bins), n: equal bins between a train's first and last event, the last in the last bin."""
    ends = trains.groupBy(key).agg(F.min(time).alias("lo"), F.max(time).alias("hi"))
    width = (F.col("hi") - F.col("lo")).cast("double")
    at = F.when(width > 0, F.least(F.floor((F.col(time) - F.col("lo")) * bins / width) + 1, F.lit(bins))).otherwise(F.lit(1))
    return trains.join(ends, key).withColumn("bin", at.cast("int")).groupBy(key, "bin").agg(F.count(F.lit(1)).alias("n"))


def autocorrelogram(trains: DataFrame, reach: float, step: float, key: str = "neuron_id", time: str = "spike_time") -> DataFrame:
    """key, bin (1..reach/step), n, share: pairs of events (0, reach] apart, by bins of `step`; share is n over the length
    of the vector of all bins. Joined by equality on bins of the reach."""
    b = F.floor(F.col(time) / reach)
    early = trains.select(key, F.col(time).alias("ta"), b.alias("slot"))
    late = trains.select(key, F.col(time).alias("tb"), F.explode(F.array(b - 1, b)).alias("slot"))
    lag = F.col("tb") - F.col("ta")
    d = early.join(late, [key, "slot"]).where((lag > 0) & (lag <= reach)).groupBy(key, F.ceil(lag / step).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = trains.select(key).distinct().withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(int(np.ceil(reach / step))))))
    d = every.join(d, [key, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    norm = F.sqrt(F.sum(F.col("n").cast("double") * F.col("n")).over(Window.partitionBy(key)))
    return d.withColumn("share", F.when(norm > 0, F.col("n") / norm).otherwise(F.lit(0.0)))


def smoothed(d: DataFrame, key: str, order: str, value: str, taps: int = 8) -> DataFrame:
    """d with smooth: moving sum over the last `taps` rows divided by taps, rows before the first counting as 0."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(-(taps - 1), 0)
    return d.withColumn("smooth", F.sum(value).over(w) / taps)


def stride_sample(trains: DataFrame, target: int, key: str = "neuron_id", time: str = "spike_time") -> DataFrame:
    """About `target` events a train by a whole stride: all if it is 0, else the 0-based places i > 0 that it divides. The
    very first event of all trains is kept whatever its place (of several at that time, the one of the smallest key)."""
    w = Window.partitionBy(key)
    start = trains.agg(F.min(F.struct(time, key)).alias("start"))  # one row
    d = trains.crossJoin(F.broadcast(start)).withColumn("i", F.row_number().over(w.orderBy(time)) - 1).withColumn("step", F.floor(F.count(F.lit(1)).over(w) / target))
    first = (F.col("i") == 0) & (F.struct(time, key) == F.col("start"))
    return d.where((F.col("step") == 0) | ((F.col("i") > 0) & (F.col("i") % F.col("step") == 0)) | first).drop("i", "step", "start")


def average_image(trains: DataFrame, samples: DataFrame, left: int, right: int, electrodes: DataFrame | None = None) -> DataFrame:
    """neuron_id, electrode, pos, n, mean: the average window of a train's events on every electrode (or those given as
    neuron_id, electrode)."""
    ask = trains.select("neuron_id", "spike_time", F.explode(F.sequence(F.lit(-left), F.lit(right))).alias("pos")).withColumn("sample", F.col("spike_time") + F.col("pos"))
    if electrodes is not None:
        ask = ask.join(electrodes, "neuron_id")
    on = ["sample"] if electrodes is None else ["electrode", "sample"]
    return ask.join(samples.select("electrode", "sample", "value"), on).groupBy("neuron_id", "electrode", "pos").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"))


def compound(images: DataFrame, group: str, at: str, n: str, value: str) -> DataFrame:
    """group, at, n, value: average weighted by the number of events."""
    return images.groupBy(group, at).agg(F.sum(n).alias("n"), (F.sum(F.col(n) * F.col(value)) / F.sum(n)).alias(value))


def last_trigger(events: DataFrame, triggers: DataFrame, key: str, time: str) -> DataFrame:
    """events with trigger_time: the last trigger of the key at or before the event, null without one. One union and one
    window instead of a range join."""
    t = triggers.select(F.col(key), F.col(time), F.col(time).alias("trigger_time"), F.lit(0).alias("kind"), *[F.lit(None).cast(events.schema[c].dataType).alias(c) for c in events.columns if c not in (key, time)])
    e = events.withColumn("trigger_time", F.lit(None).cast(triggers.schema[time].dataType)).withColumn("kind", F.lit(1))
    w = Window.partitionBy(key).orderBy(time, "kind").rowsBetween(Window.unboundedPreceding, 0)
    out = t.unionByName(e).withColumn("trigger_time", F.last("trigger_time", ignorenulls=True).over(w))
    return out.where("kind = 1").select(*events.columns, "trigger_time")


FRAMES, NEURONS, VALUES = 4_096, 128, 512  # of one product


def triggered_average(events: DataFrame, frames: DataFrame, depth: int, offset: int = -1) -> DataFrame:
    """neuron_id, back (0..depth-1), n, mean (an array): the average stimulus frame (frame, values) `back` frames before an event's
    frame, moved by offset, over the n events for which that frame is there.

    Events (neuron_id, frame) are counted by neuron and frame first. Counts and frames then meet as matrices, a block of
    frames x a group of neurons x a stretch of values at a time, a bounded size each, and `depth` products give that block's
    sums; the blocks' sums are added up map-side. Frames are equally long; other ones raise. No events or no frames: no rows.
    """
    ship(events.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in events.schema}
    counted = events.groupBy("neuron_id", "frame").agg(F.count(F.lit(1)).alias("c"))
    counted = counted.withColumn("block", F.floor(F.col("frame") / FRAMES))
    groups = max(1, -(-events.select("neuron_id").distinct().count() // NEURONS))
    size = frames.agg(F.coalesce(F.max(F.size("values")), F.lit(0))).collect()[0][0]
    stretches = max(1, -(-size // VALUES))
    counted = counted.withColumn("g", F.pmod(F.xxhash64("neuron_id"), F.lit(groups)).cast("int")).withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(stretches - 1))))
    first, last = F.floor((F.col("frame") - offset) / FRAMES), F.floor((F.col("frame") - offset + depth - 1) / FRAMES)  # of events that see the frame
    seen = frames.select("frame", F.transform("values", lambda v: v.cast("double")).alias("values"), F.explode(F.sequence(first, last)).alias("block"))
    hit = counted.select(F.col("block").alias("block"), F.col("g").alias("g")).distinct()  # a group's block without events needs no frames
    seen = seen.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(stretches - 1)))).withColumn("values", F.slice("values", F.col("s") * VALUES + 1, F.lit(VALUES)))
    seen = seen.join(hit, "block")

    def run(c: pd.DataFrame, f: pd.DataFrame) -> pd.DataFrame:
        if not len(c) or not len(f):
            return pd.DataFrame([], columns=["neuron_id", "back", "s", "n", "sums"])
        low = int(c["block"].iloc[0]) * FRAMES
        x = np.stack(f["values"].to_numpy())
        stack, there = np.zeros((FRAMES + depth - 1, x.shape[1])), np.zeros(FRAMES + depth - 1)
        at = f["frame"].to_numpy() - (low + offset - depth + 1)  # place 0 is the earliest frame that the block's events see
        stack[at], there[at] = x, 1
        ids, row = np.unique(c["neuron_id"].to_numpy(), return_inverse=True)
        m = np.zeros((len(ids), FRAMES))
        np.add.at(m, (row, c["frame"].to_numpy() - low), c["c"].to_numpy())
        rows = []
        for back in range(depth):
            shift = slice(depth - 1 - back, depth - 1 - back + FRAMES)
            sums, n = m @ stack[shift], m @ there[shift]
            rows += [(i, back, c["s"].iloc[0], int(k), v) for i, k, v in zip(ids, n, sums, strict=True) if k]
        return pd.DataFrame(rows, columns=["neuron_id", "back", "s", "n", "sums"])

    keys = ["block", "g", "s"]
    part = counted.groupBy(*keys).cogroup(seen.groupBy(*keys)).applyInPandas(run, f"neuron_id {kinds['neuron_id']}, back int, s int, n long, sums array<double>")
    total = part.select("neuron_id", "back", "s", "n", F.posexplode("sums").alias("i", "x")).groupBy("neuron_id", "back", "s", "i").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    mean = F.transform(F.array_sort(F.collect_list(F.struct("s", "i", (F.col("x") / F.col("n")).alias("x")))), lambda v: v["x"])
    return total.groupBy("neuron_id", "back").agg(F.max("n").alias("n"), mean.alias("mean"))


def split_by_interval(events: DataFrame, lengths: DataFrame, time: str = "spike_time") -> DataFrame:
    """events cut at the datasets' ends (dataset, ord, length) and rebased to their own starts; nothing outside stays.

    The time line is cut into as many bins as there are datasets; an event has one bin and a dataset the bins that it
    touches, three a dataset on average, so the join is by equality however many datasets there are."""
    run = Window.partitionBy().orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)  # a row a dataset
    ends = lengths.where("length > 0").withColumn("start", F.coalesce(F.sum("length").over(run), F.lit(0))).withColumn("stop", F.col("start") + F.col("length"))
    ends = ends.withColumn("width", F.greatest(F.lit(1), F.ceil(F.avg("length").over(Window.partitionBy())))).select("dataset", "start", "stop", "width")
    width = ends.agg(F.coalesce(F.max("width"), F.lit(1))).collect()[0][0]
    slots = ends.withColumn("slot", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("stop") - 1) / width)))).drop("width")
    d = events.withColumn("slot", F.floor(F.col(time) / width)).join(slots, "slot").where((F.col(time) >= F.col("start")) & (F.col(time) < F.col("stop")))
    return d.withColumn(time, F.col(time) - F.col("start")).drop("start", "stop", "slot")


def concat_with_offsets(events: DataFrame, lengths: DataFrame, time: str = "spike_time") -> DataFrame:
    """events of several datasets on one time line: each shifted by the length of those before it."""
    run = Window.partitionBy().orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    off = lengths.withColumn("offset", F.coalesce(F.sum("length").over(run), F.lit(0))).select("dataset", "offset")
    return events.join(off, "dataset").withColumn(time, F.col(time) + F.col("offset")).drop("offset")


def display_sample(points: DataFrame, group: str, clust: str, id_col: str, most: int = 8_000, seed: int = 0) -> DataFrame:
    """floor(f n) rows of each cluster, f = min(1, most / rows of the group), the same for the same seed."""
    total = F.count(F.lit(1)).over(Window.partitionBy(group))
    n = F.count(F.lit(1)).over(Window.partitionBy(group, clust))
    nth = F.row_number().over(Window.partitionBy(group, clust).orderBy(keyed_hash(seed, F.col(id_col)), id_col))
    d = points.withColumn("total", total).withColumn("n", n).withColumn("nth", nth)
    return d.where(F.col("nth") <= F.floor(F.least(F.lit(1.0), F.lit(float(most)) / F.col("total")) * F.col("n"))).drop("total", "n", "nth")


def colour_ranks(status: DataFrame, group: str) -> DataFrame:
    """status (group, neuron_id, master_id) with hue in [0, 1): clusters merged together stand side by side."""
    lead = F.coalesce("master_id", "neuron_id")
    w = Window.partitionBy(group)
    return status.withColumn("lead", lead).withColumn("hue", (F.row_number().over(w.orderBy("lead", "neuron_id")) - 1) / F.count(F.lit(1)).over(w)).drop("lead")


def status_summary(status: DataFrame) -> DataFrame:
    """code, n over all neurons."""
    return status.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def pools(n: int, workers: int) -> list[range]:
    """Electrodes 1..n in contiguous pools: boundaries at round(n i / workers), halves away from zero."""
    edge = [int(np.floor(n * i / workers + 0.5)) + 1 for i in range(workers + 1)]
    return [range(a, b) for a, b in zip(edge, edge[1:])]


def pool_table(electrodes: DataFrame, workers: int) -> DataFrame:
    """pool, first, last of pools() over as many electrodes as there are rows."""
    n = electrodes.agg(F.count(F.lit(1)).alias("n"))  # one row
    edge = lambda i: F.floor(F.col("n") * i / workers + 0.5)
    d = n.select("n", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(workers).cast("long"))).alias("pool"))
    return d.select("pool", (edge(F.col("pool") - 1) + 1).alias("first"), edge(F.col("pool")).alias("last"))


def ordered(nodes: DataFrame, weights: DataFrame, id_col: str) -> DataFrame:
    """place, id_col: block_order() of the nodes, from the weights of their pairs (id_a, id_b, weight); 1 on the diagonal, 0 for
    pairs without a row. One matrix is one task: the clusters or electrodes of a display."""
    ship(nodes.sparkSession)
    kind = {f.name: f.dataType.simpleString() for f in nodes.schema}[id_col]

    def run(a: pd.DataFrame, w: pd.DataFrame) -> pd.DataFrame:
        ids = np.sort(a["id"].to_numpy())
        m = np.eye(len(ids))
        x, y = np.searchsorted(ids, w["id_a"]), np.searchsorted(ids, w["id_b"])
        m[x, y] = m[y, x] = w["weight"]
        return pd.DataFrame({"place": np.arange(len(ids), dtype=np.int32), id_col: ids[block_order(m)]})

    one = F.lit(0).alias("g")
    return nodes.select(one, F.col(id_col).alias("id")).groupBy("g").cogroup(weights.select(one, "id_a", "id_b", "weight").groupBy("g")).applyInPandas(run, f"place int, {id_col} {kind}")


def block_order(m: np.ndarray) -> list[int]:
    """An order of rows and columns that gathers mass near the diagonal: 2 n rounds of the best single exchange."""
    n = len(m)
    far = np.abs(np.arange(n)[:, None] - np.arange(n)[None])
    order = list(range(n))
    cost = lambda o: float((m[np.ix_(o, o)] * far).sum())
    for _ in range(2 * n):
        best = (cost(order), None)
        for i in range(n):
            for j in range(i + 1, n):
                o = order.copy()
                o[i], o[j] = o[j], o[i]
                if (c := cost(o)) < best[0] - 1e-12:
                    best = (c, o)
        if best[1] is None:
            break
        order = best[1]
    return order
