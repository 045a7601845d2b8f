"""Waveforms and grouped linear algebra: windows, alignment, covariance, whitening, projection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship


def windows(spikes: DataFrame, samples: DataFrame, adjacency: DataFrame, left: int, right: int, block: int = 256) -> DataFrame:
    """electrode, spike_time, neighbor, ord, pos, value: the samples around each spike on its neighbours.

    Samples are gathered in blocks of sample numbers, and a window asks for the blocks that it lies in, mostly one: the join
    is by equality on (electrode, block) and its rows are windows, whatever their width; the window is cut out behind it, by
    place where the block has no gap.
    """
    place = F.struct("sample", "value")
    have = samples.groupBy(F.col("electrode").alias("neighbor"), F.floor(F.col("sample") / block).alias("block"))
    have = have.agg(F.array_sort(F.collect_list(place)).alias("held"), F.min("sample").alias("from"), F.max("sample").alias("to"))
    ask = spikes.select("electrode", "spike_time").join(adjacency.select("electrode", "neighbor", "ord"), "electrode")
    ask = ask.withColumn("block", F.explode(F.sequence(F.floor((F.col("spike_time") - left) / block), F.floor((F.col("spike_time") + right) / block))))
    low, high = F.greatest(F.col("spike_time") - left, F.col("from")), F.least(F.col("spike_time") + right, F.col("to"))
    gaps = F.filter("held", lambda x: (x["sample"] >= low) & (x["sample"] <= high))
    near = F.when(F.size("held") == F.col("to") - F.col("from") + 1, F.slice("held", (low - F.col("from") + 1).cast("int"), F.greatest(high - low + 1, F.lit(0)).cast("int"))).otherwise(gaps)
    out = ask.join(have, ["neighbor", "block"]).select("electrode", "spike_time", "neighbor", "ord", F.explode(near).alias("x"))
    return out.select("electrode", "spike_time", "neighbor", "ord", (F.col("x.sample") - F.col("spike_time")).cast("int").alias("pos"), F.col("x.value").alias("value"))


def spline(y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Cubic spline through y at 0, 1, 2, ... with not-a-knot ends, evaluated at `at`. Rows of y are curves of their own, with
    the same `at` for all or a row each."""
    if y.ndim == 1:
        return spline(y[None], at)[0]
    rows, n = y.shape
    at = np.broadcast_to(at, (rows, at.shape[-1]))
    if n < 4:
        return np.stack([np.polyval(np.polyfit(np.arange(n), v, n - 1), t) for v, t in zip(y, at, strict=True)])
    a, r = np.zeros((n, n)), np.zeros((n, rows))
    for i in range(1, n - 1):
        a[i, i - 1 : i + 2] = 1, 4, 1
    r[1:-1] = 6 * (y[:, :-2] - 2 * y[:, 1:-1] + y[:, 2:]).T
    a[0, :3] = a[-1, -3:] = 1, -2, 1  # third derivatives agree on either side of the second and last but one point
    m = np.linalg.solve(a, r).T
    i = np.clip(np.floor(at).astype(int), 0, n - 2)
    t = at - i
    take = lambda v, j: np.take_along_axis(v, j, 1)
    return (1 - t) * take(y, i) + t * take(y, i + 1) + ((1 - t) ** 3 - (1 - t)) * take(m, i) / 6 + (t**3 - t) * take(m, i + 1) / 6


def align(waves: np.ndarray, centre: int, reach: float, pitch: float, left: int, right: int) -> np.ndarray:
    """waves (events x channels x points, or those of one event) resampled about the lowest point of the first channel within
    `reach` of `centre`."""
    if waves.ndim == 2:
        return align(waves[None], centre, reach, pitch, left, right)[0]
    events, channels, points = waves.shape
    at = np.arange(centre - reach, centre + reach + pitch / 2, pitch)
    best = at[spline(waves[:, 0], at).argmin(1)]
    grid = np.clip(best[:, None] + np.arange(-left, right + 1), 0, points - 1)
    return spline(waves.reshape(-1, points), np.repeat(grid, channels, 0)).reshape(events, channels, -1)


def aligned_waveforms(windowed: DataFrame, left: int, right: int, reach: float = 1.0, pitch: float = 1 / 16) -> DataFrame:
    """electrode, spike_time, wave: each spike's channels in `ord` order, aligned below the sample grid, end to end.

    A spike's samples are gathered by an aggregation; those of a batch that have as many channels and points are aligned
    together. Spikes whose channels have not all the same points (at the recording's ends) are left out.
    """
    ship(windowed.sparkSession)
    kind = {f.name: f.dataType.simpleString() for f in windowed.schema}
    x = F.sort_array(F.collect_list(F.struct("ord", "pos", F.col("value").cast("double").alias("value"))))
    whole = windowed.groupBy("electrode", "spike_time").agg(x.alias("x"), F.count_distinct("ord").alias("channels"), F.min("pos").alias("first"), F.max("pos").alias("last"))
    whole = whole.where(F.size("x") == F.col("channels") * (F.col("last") - F.col("first") + 1))
    rows = whole.select("electrode", "spike_time", F.col("channels").cast("int").alias("channels"), F.col("first").cast("int").alias("first"), F.transform("x", lambda v: v["value"]).alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            channels, first, values = np.asarray(batch.column(2)), np.asarray(batch.column(3)), batch.column(4)
            size = np.diff(np.asarray(values.offsets))
            out: list = [None] * batch.num_rows
            for shape in set(zip(channels.tolist(), size.tolist(), first.tolist(), strict=True)):
                at = np.flatnonzero((channels == shape[0]) & (size == shape[1]) & (first == shape[2]))
                waves = np.asarray(values.take(pa.array(at)).flatten()).reshape(len(at), shape[0], -1)
                for i, w in zip(at.tolist(), align(waves, -shape[2], reach, pitch, left, right).reshape(len(at), -1), strict=True):
                    out[i] = w
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.float64()))], ["electrode", "spike_time", "wave"])

    return rows.mapInArrow(run, f"electrode {kind['electrode']}, spike_time {kind['spike_time']}, wave array<double>")


def moments(waves: DataFrame, key: str, wave: str) -> DataFrame:
    """key, i, j, n, si, sj, sij for i <= j: sums that merge, so groups of any size reduce before the shuffle."""
    x = waves.select(key, F.posexplode(wave).alias("i", "x"), F.col(wave).alias("w"))
    x = x.select(key, "i", F.col("x").cast("double").alias("x"), F.posexplode("w").alias("j", "y")).where("i <= j").withColumn("y", F.col("y").cast("double"))
    return x.groupBy(key, "i", "j").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("si"), F.sum("y").alias("sj"), F.sum(F.col("x") * F.col("y")).alias("sij"))


def covariance(m: DataFrame, key: str) -> DataFrame:
    """key, i, j, n, cov from moments: unbiased, null below two rows."""
    return m.select(key, "i", "j", "n", F.when(F.col("n") > 1, (F.col("sij") - F.col("si") * F.col("sj") / F.col("n")) / (F.col("n") - 1)).alias("cov"))


def mean_wave(waves: DataFrame, key: str, wave: str) -> DataFrame:
    return waves.select(key, F.posexplode(wave).alias("i", "x")).groupBy(key, "i").agg(F.avg(F.col("x").cast("double")).alias("mean"), F.count(F.lit(1)).alias("n"))


def pooled(parts: DataFrame, key: str, value: str, *at: str) -> DataFrame:
    """Count-weighted merge over datasets: sum(n x) / sum(n), null where no dataset has rows."""
    n = F.sum("n")
    return parts.groupBy(key, *at).agg(n.cast("long").alias("n"), F.when(n > 0, F.sum(F.col("n") * F.col(value)) / n).alias(value))


def _matrix(frame: pd.DataFrame, value: str = "cov") -> np.ndarray:
    d = int(frame["j"].max()) + 1
    out = np.zeros((d, d))
    out[frame["i"], frame["j"]] = out[frame["j"], frame["i"]] = frame[value].fillna(0.0)
    return out


def principal_axes(cov: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues, and eigenvectors in columns with their largest component positive."""
    w, v = np.linalg.eigh(cov)
    w, v = w[::-1][:dims], v[:, ::-1][:, :dims]
    big = v[np.abs(v).argmax(0), np.arange(v.shape[1])]
    return w, v * np.where(big < 0, -1, 1)


def eigen(cov: DataFrame, key: str, dims: int = 5) -> DataFrame:
    """key, rank, eigenvalue, axis from the long covariance; a group is one matrix."""
    ship(cov.sparkSession)
    kind = {f.name: f.dataType.simpleString() for f in cov.schema}[key]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        w, v = principal_axes(_matrix(frame), dims)
        return pd.DataFrame({key: frame[key].iloc[0], "rank": np.arange(1, len(w) + 1, dtype=np.int32), "eigenvalue": w, "axis": list(v.T)})

    return cov.groupBy(key).applyInPandas(run, f"{key} {kind}, rank int, eigenvalue double, axis array<double>")


def whiten(cov: np.ndarray, noise: np.ndarray) -> np.ndarray:
    """noise^-1/2 cov noise^-1/2 on the channels that are connected; cov as it is if the noise has not full rank there."""
    on = np.flatnonzero(np.diag(cov) != 0)
    out = np.zeros_like(cov)
    c, n = cov[np.ix_(on, on)], noise[np.ix_(on, on)]
    if len(on):
        if np.linalg.matrix_rank(n) == len(on):
            w, v = np.linalg.eigh(n)
            root = (v / np.sqrt(w)) @ v.T
            c = root @ c @ root
        out[np.ix_(on, on)] = c
    return out


def whitened(cov: DataFrame, noise: DataFrame, key: str) -> DataFrame:
    """The long covariance, whitened by the long noise covariance of the same key."""
    ship(cov.sparkSession)
    kind = {f.name: f.dataType.simpleString() for f in cov.schema}[key]

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a):
            return pd.DataFrame({key: [], "i": [], "j": [], "cov": []})
        m = _matrix(a)
        m = whiten(m, _matrix(b) if len(b) else np.zeros_like(m))
        i, j = np.triu_indices(len(m))
        return pd.DataFrame({key: a[key].iloc[0], "i": i, "j": j, "cov": m[i, j]})

    noise = noise.select(*[F.col(c).alias(c) for c in noise.columns])  # both may come from one table
    return cov.groupBy(key).cogroup(noise.groupBy(key)).applyInPandas(run, f"{key} {kind}, i int, j int, cov double")


def project(waves: DataFrame, means: DataFrame, axes: DataFrame, key: str, id_col: str, wave: str) -> DataFrame:
    """key, id, rank, score = (wave - mean) . axis; means: key, mean (array); axes: key, rank, axis."""
    centred = F.zip_with(F.transform(wave, lambda v: v.cast("double")), "mean", lambda a, b: a - b)
    d = waves.join(means, key).withColumn("centred", centred).join(axes.select(key, "rank", "axis"), key)
    return d.select(key, id_col, "rank", F.aggregate(F.zip_with("centred", "axis", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v).alias("score"))
