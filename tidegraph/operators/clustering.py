"""Clustering of one channel's events: self-tuning spectral clustering, k-means, Gaussian mixtures, and their SQL parts.

The dense part of spectral clustering runs on a bounded number of landmarks per group; everything else is extended row by row in batches, so a
channel of any size costs memory for its landmarks only. k-means and mixtures are fitted to all rows: within a task up to a bounded
number of them, in rounds over parts (`fits`) beyond it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import squared_l2
from ..session import ship
from . import fits
from .tables import written

# Landmarks, rows for k-means and mixtures within a task, neighbour that sets the local scale, leading vectors, most clusters, tolerance of the automatic
# choice, k-means replicates and iterations, retries, most dropped rows, posterior that a row of a mixture must exceed.
LANDMARKS, POINTS, NEIGHBOUR, VECTORS, MOST, TOLERANCE = 2_500, 20_000, 5, 20, 15, 0.015
REPLICATES, ITERATIONS, RETRIES, MOST_DROPPED, POSTERIOR = 5, 200, 10, 0.01, 0.5
# Fixed value: products with the matrix at most, while leading vectors are sought.
PRODUCTS = 300
DENSE = 400  # rows up to which all eigenvectors cost less than the leading ones
PART_ROWS = 50_000  # rows that meet one copy of a model
AT_ONCE = 4_096  # rows whose differences from a centre are computed at a time
TASKS = 4  # tasks for each fit, most of them empty, so that few fits meet in one


# -------------------------------------------------------------------------------------------------- SQL parts


def marks(points: DataFrame, group: str, id_col: str, most: int = LANDMARKS) -> DataFrame:
    """The landmarks of each group: all of its points, or `most` of them by a hash of the id."""
    nth = Window.partitionBy(group).orderBy(F.xxhash64(id_col), id_col)
    return points.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= most).drop("nth")


def pairs(points: DataFrame, group: str, id_col: str, vec: str, landmarks: int = LANDMARKS) -> DataFrame:
    """group, id_a, id_b, d2 over all ordered pairs of a group's landmarks, a point with itself included: at most
    landmarks^2 rows a group. Written once, since the scales and the affinities both read them."""
    m = marks(points.select(group, id_col, vec), group, id_col, landmarks)
    m = written(m, "landmarks")
    a = m.select(group, F.col(id_col).alias("id_a"), F.col(vec).alias("va"))
    b = m.select(group, F.col(id_col).alias("id_b"), F.col(vec).alias("vb"))
    return written(a.join(b, group).select(group, "id_a", "id_b", squared_l2(F.col("va"), F.col("vb")).alias("d2")), "pairs")


def local_scale(d: DataFrame, group: str, nth: int = NEIGHBOUR) -> DataFrame:
    """group, id, scale: distance to the nth nearest point, the point itself counted."""
    at = Window.partitionBy(group, "id_a").orderBy("d2", "id_b")
    return d.withColumn("nth", F.row_number().over(at)).where(F.col("nth") == nth).select(group, F.col("id_a").alias("id"), F.sqrt("d2").alias("scale"))


def affinity(d: DataFrame, scales: DataFrame, group: str, kernel: str = "gauss", cut_off: float = 0.0) -> DataFrame:
    """group, id_a, id_b, a = exp(-d2 / (s_a s_b)), or 1 / (1 + d2 s_a s_b) above a cut-off for kernel 'power'."""
    s = scales.toDF(group, "id_a", "sa"), scales.toDF(group, "id_b", "sb")
    d = d.join(s[0], [group, "id_a"]).join(s[1], [group, "id_b"])
    a = F.exp(-F.col("d2") / (F.col("sa") * F.col("sb"))) if kernel == "gauss" else 1 / (1 + F.col("d2") * F.col("sa") * F.col("sb"))
    return d.select(group, "id_a", "id_b", a.alias("a")).where(F.col("a") >= cut_off)


ROWS_AT_ONCE = 200  # landmarks that meet all others of their group in one task


def _against(m: DataFrame, group: str, id_col: str, landmarks: int, run: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """run(some of a group's landmarks, all of them), in parts of about ROWS_AT_ONCE: a task holds a part's distances, no pair is
    a row before it is a result."""
    ship(m.sparkSession)
    blocks = -(-landmarks // ROWS_AT_ONCE)
    a = m.withColumn("part", F.pmod(F.xxhash64(id_col), F.lit(blocks)).cast("int"))
    b = m.select(*[F.col(c).alias(c) for c in m.columns]).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return a.groupBy(group, "part").cogroup(b.groupBy(group, "part")).applyInPandas(run, schema)


def _square_distances(a: pd.Series, b: pd.Series) -> np.ndarray:
    """Rows x rows, added up component by component as SQL does."""
    x, y = np.stack(a.to_numpy()).astype(float), np.stack(b.to_numpy()).astype(float)
    out = np.zeros((len(x), len(y)))
    for i in range(x.shape[1]):
        out += (x[:, i, None] - y[None, :, i]) ** 2
    return out


def landmark_scales(points: DataFrame, group: str, id_col: str, vec: str, nth: int = NEIGHBOUR, landmarks: int = LANDMARKS) -> DataFrame:
    """local_scale() of each landmark without a table of pairs; groups of fewer than nth landmarks have no rows."""
    kind = {f.name: f.dataType.simpleString() for f in points.schema}

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or len(b) < nth:
            return pd.DataFrame([], columns=[group, "id", "scale"])
        d = np.partition(_square_distances(a[vec], b[vec]), nth - 1, axis=1)[:, nth - 1]
        return pd.DataFrame({group: a[group], "id": a[id_col], "scale": np.sqrt(d)})

    m = written(marks(points.select(group, id_col, vec), group, id_col, landmarks), "landmarks")
    return _against(m, group, id_col, landmarks, run, f"{group} {kind[group]}, id {kind[id_col]}, scale double")


def landmark_affinity(points: DataFrame, group: str, id_col: str, vec: str, kernel: str = "gauss", cut_off: float = 0.0, nth: int = NEIGHBOUR, landmarks: int = LANDMARKS) -> DataFrame:
    """affinity() of all pairs of a group's landmarks, without a table of their distances."""
    kind = {f.name: f.dataType.simpleString() for f in points.schema}
    m = marks(points.select(group, id_col, vec), group, id_col, landmarks)
    scales = landmark_scales(points, group, id_col, vec, nth, landmarks).withColumnRenamed("id", id_col)
    m = written(m.join(scales, [group, id_col]), "scaled")

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a):
            return pd.DataFrame([], columns=[group, "id_a", "id_b", "a"])
        d, s = _square_distances(a[vec], b[vec]), np.outer(a["scale"], b["scale"])
        with np.errstate(divide="ignore", invalid="ignore"):
            w = np.exp(-d / s) if kernel == "gauss" else 1 / (1 + d * s)
        i, j = np.nonzero(w >= cut_off)
        return pd.DataFrame({group: a[group].iloc[0], "id_a": a[id_col].to_numpy()[i], "id_b": b[id_col].to_numpy()[j], "a": w[i, j]})

    return _against(m, group, id_col, landmarks, run, f"{group} {kind[group]}, id_a {kind[id_col]}, id_b {kind[id_col]}, a double")


def nearest_centroid(points: DataFrame, centroids: DataFrame, group: str, id_col: str, vec: str) -> DataFrame:
    """group, id, clust, d2: centroids (group, clust, centroid), few a group, ties to the smaller cluster."""
    d = points.join(centroids, group).select(group, id_col, "clust", squared_l2(F.col(vec), F.col("centroid")).alias("d2"))
    return d.groupBy(group, id_col).agg(F.min(F.struct("d2", "clust")).alias("m")).select(group, id_col, F.col("m.clust").alias("clust"), F.col("m.d2").alias("d2"))


def cluster_stats(points: DataFrame, group: str, clust: str, vec: str) -> DataFrame:
    """group, clust, i, centroid, variance (population), n, mix_frac (share of the group)."""
    x = points.select(group, clust, F.posexplode(vec).alias("i", "x"))
    s = x.groupBy(group, clust, "i").agg(F.avg(F.col("x").cast("double")).alias("centroid"), F.var_pop(F.col("x").cast("double")).alias("variance"), F.count(F.lit(1)).alias("n"))
    return s.withColumn("mix_frac", F.col("n") / F.sum("n").over(Window.partitionBy(group, "i")))


# ------------------------------------------------------------------------------------------------ numerics


def square_sums(x: np.ndarray, c: np.ndarray, over: np.ndarray | None = None) -> np.ndarray:
    """Rows x centroids: sums of squares of what a row is off a centroid, divided by its row of `over`. A bounded number of rows at a time, whose differences
    are written over each other; the values are those of the whole table at once."""
    out, off = np.empty((len(x), len(c))), np.empty((min(AT_ONCE, len(x)), x.shape[1]))
    for at in range(0, len(x), AT_ONCE):
        rows = x[at : at + AT_ONCE]
        d = off[: len(rows)]
        for j, m in enumerate(c):
            np.subtract(rows, m, out=d)
            np.multiply(d, d, out=d)
            if over is not None:
                np.divide(d, over[j], out=d)
            d.sum(1, out=out[at : at + AT_ONCE, j])
    return out


def square_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Rows x centroids, without a copy of the rows."""
    return square_sums(x, c)


def starts(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k rows to start from (k-means++): each is drawn by its squared distance to the nearest one before."""
    c = x[[rng.integers(len(x))]]
    d = square_distances(x, c)[:, 0] if k > 1 else None
    while len(c) < k:
        c = np.concatenate((c, x[[rng.choice(len(x), p=d / d.sum()) if d.sum() > 0 else rng.integers(len(x))]]))
        d = np.minimum(d, square_distances(x, c[-1:])[:, 0])
    return c


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, replicates: int = REPLICATES, iterations: int = ITERATIONS) -> tuple[np.ndarray, np.ndarray]:
    """Labels and centroids of the best of several k-means++ starts."""
    best = (np.inf, None, None)
    for _ in range(replicates):
        c, label = starts(x, k, rng), None
        for _ in range(iterations):
            d = square_distances(x, c)
            new = d.argmin(1)
            if label is not None and (new == label).all():
                break
            label = new
            c = np.stack([x[label == j].mean(0) if (label == j).any() else x[d.min(1).argmax()] for j in range(k)])
        cost = ((x - c[label]) ** 2).sum()
        if cost < best[0]:
            best = (cost, label, c)
    return best[1], best[2]


def alignment_quality(z: np.ndarray) -> float:
    """1 where every row lies on one axis; lower the more rows lie between axes."""
    top = (z * z).max(1)
    return float(1 - ((z * z).sum(1) / np.where(top > 0, top, 1)).mean() / z.shape[1] + 1 / z.shape[1])


def align_axes(x: np.ndarray, rounds: int = 200, rate: float = 1.0, least_gain: float = 1e-3) -> tuple[np.ndarray, float]:
    """Rotates eigenvectors so that rows lie along axes (self-tuning spectral clustering, Zelnik-Manor and Perona 2004).

    One angle a pair of axes; each is moved along its numerical gradient as long as the quality rises.
    """
    d = x.shape[1]
    planes = [(i, j) for i in range(d) for j in range(i + 1, d)]
    z, quality, past = x.copy(), alignment_quality(x), []

    def turned(m: np.ndarray, i: int, j: int, t: float) -> np.ndarray:
        out = m.copy()
        out[:, i], out[:, j] = np.cos(t) * m[:, i] - np.sin(t) * m[:, j], np.sin(t) * m[:, i] + np.cos(t) * m[:, j]
        return out

    for n in range(rounds):
        for i, j in planes:
            slope = (alignment_quality(turned(z, i, j, 1e-4)) - alignment_quality(turned(z, i, j, -1e-4))) / 2e-4
            new = turned(z, i, j, rate * slope)
            if (q := alignment_quality(new)) > quality:
                z, quality = new, q
        past.append(quality)
        if n > 2 and past[-1] - past[-3] < least_gain:
            break
    return z, quality


def leading(a: np.ndarray, k: int, rng: np.random.Generator, most: int = PRODUCTS, tolerance: float = 1e-12, steps: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, largest first, and their vectors, without the others.

    Block Lanczos with full orthogonalisation, restarted from the best vectors: a block a few vectors wider than k is multiplied
    `steps` times, the matrix is reduced to what they span and solved there. It ends when every residual |a v - w v| is below
    tolerance x the largest value, no longer shrinks, or after `most` products. A block holds repeated eigenvalues too, as a graph of several parts has.
    """
    n, width = len(a), min(len(a), k + 8)
    if n <= max(DENSE, 3 * width):
        w, v = np.linalg.eigh(a)
        return w[::-1][:k], v[:, ::-1][:, :k]
    q, products, before = np.linalg.qr(rng.normal(size=(n, width)))[0], 0, np.inf
    aq = a @ q
    while True:
        basis, images = [q], [aq]
        for _ in range(steps - 1):
            new = images[-1]
            for _ in range(2):  # once leaves what rounding brings back
                for b in basis:
                    new = new - b @ (b.T @ new)
            new = np.linalg.qr(new)[0]
            basis.append(new)
            images.append(a @ new)
            products += 1
        span, image = np.concatenate(basis, 1), np.concatenate(images, 1)
        small = span.T @ image
        w, y = np.linalg.eigh((small + small.T) / 2)
        w, y = w[::-1][:width], y[:, ::-1][:, :width]
        q, aq = span @ y, image @ y
        residual = np.sqrt(((aq - q * w) ** 2).sum(0))[:k].max()
        if residual <= tolerance * abs(w[0]) or residual > 0.5 * before and residual < 1e-8 * abs(w[0]) or products >= most:
            return w[:k], q[:, :k]
        before = residual
        q, r = np.linalg.qr(q)  # orthogonal again, with the products to match
        aq = np.linalg.solve(r.T, aq.T).T


def spectral(x: np.ndarray, rng: np.random.Generator, most: int = MOST, k: int | None = None, landmarks: int = LANDMARKS, neighbour: int = NEIGHBOUR, tolerance: float = TOLERANCE, kernel: str = "gauss") -> dict:
    """A fitted model: landmarks, their scales, the chosen eigenvectors, centroids on the unit sphere, k and quality."""
    mark = x if len(x) <= landmarks else x[np.sort(rng.choice(len(x), landmarks, replace=False))]
    d2 = np.maximum((mark * mark).sum(1)[:, None] + (mark * mark).sum(1)[None] - 2 * mark @ mark.T, 0)
    scale = np.sqrt(np.partition(d2, min(neighbour, len(mark)) - 1, axis=1)[:, min(neighbour, len(mark)) - 1])
    scale = np.where(scale > 0, scale, scale[scale > 0].min() if (scale > 0).any() else 1.0)
    a = np.exp(-d2 / np.outer(scale, scale)) if kernel == "gauss" else 1 / (1 + d2 * np.outer(scale, scale))
    np.fill_diagonal(a, 0)
    degree = np.maximum(a.sum(1), 1e-300)
    w, v = leading(a / np.sqrt(np.outer(degree, degree)), VECTORS, rng)
    if k is None:
        most = min(most, v.shape[1], len(mark))
        quality, z = {1: -np.inf}, v[:, :1]
        for n in range(2, most + 1):
            z, quality[n] = align_axes(np.concatenate((z[:, : n - 1], v[:, n - 1 : n]), 1))
        best = max(quality.values())
        k = max(n for n, q in quality.items() if q >= best - tolerance)
    model = {"mark": mark, "scale": scale, "degree": degree, "values": w[:k], "vectors": v[:, :k], "k": k, "neighbour": neighbour, "kernel": kernel}
    y = embed(model, mark)
    ok = np.isfinite(y).all(1)
    model["centroids"] = k_means(y[ok], k, rng)[1]
    return model


def embed(model: dict, x: np.ndarray) -> np.ndarray:
    """Rows on the unit sphere of the chosen eigenvectors, for landmarks and any other points; NaN where isolated."""
    mark, scale = model["mark"], model["scale"]
    d2 = np.maximum((x * x).sum(1)[:, None] + (mark * mark).sum(1)[None] - 2 * x @ mark.T, 0)
    own = np.sqrt(np.partition(d2, min(model["neighbour"], len(mark)) - 1, axis=1)[:, min(model["neighbour"], len(mark)) - 1])
    own = np.where(own > 0, own, scale.min())
    a = np.exp(-d2 / np.outer(own, scale)) if model["kernel"] == "gauss" else 1 / (1 + d2 * np.outer(own, scale))
    a[d2 < 1e-18] = 0
    with np.errstate(invalid="ignore", divide="ignore"):
        y = (a / np.sqrt(model["degree"])[None] / np.sqrt(a.sum(1))[:, None]) @ model["vectors"] / model["values"][None]
        return y / np.sqrt((y * y).sum(1))[:, None]


def assign(model: dict, x: np.ndarray, chunk: int = 1_000) -> np.ndarray:
    """Clusters 1..k, 0 for rows that cannot be placed."""
    out = np.zeros(len(x), int)
    for at in range(0, len(x), chunk):
        y = embed(model, x[at : at + chunk])
        ok = np.isfinite(y).all(1)
        out[at : at + chunk][ok] = ((y[ok][:, None] - model["centroids"][None]) ** 2).sum(2).argmin(1) + 1
    return out


def log_density(model: dict, x: np.ndarray) -> np.ndarray:
    """Rows x components: log of share times density."""
    fit = square_sums(x, model["means"], model["variances"])
    for j, (s, v) in enumerate(zip(model["shares"], model["variances"], strict=True)):
        fit[:, j] = np.log(s + 1e-300) - 0.5 * (np.log(2 * np.pi * v).sum() + fit[:, j])
    return fit


def posterior(model: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows x components: probability of each component; and the log-likelihood of each row."""
    logp = log_density(model, x)
    top = logp.max(1, keepdims=True)
    like = top[:, 0] + np.log(np.exp(logp - top).sum(1))
    return np.exp(logp - like[:, None]), like


def likeliest(model: dict, x: np.ndarray, least: float = POSTERIOR) -> np.ndarray:
    """Clusters 1..k by the largest posterior, 0 for rows that no component has with more than `least`."""
    r, _ = posterior(model, x)
    return np.where(r.max(1) > least, r.argmax(1) + 1, 0)


MIXTURE_STARTS, MIXTURE_ITERATIONS = 2, 50


def mixtures(x: np.ndarray, numbers: list[int], rng: np.random.Generator, rounds: int = 100) -> list[tuple[int, float, dict]]:
    """k, criterion and model (shares, means, variances, k) of diagonal mixtures of so many components. What is drawn for smaller
    numbers is drawn first, so that each fit is the same whichever others are asked for."""
    fits, off = [], np.empty_like(x)
    for k in range(1, max(numbers) + 1):
        if k not in numbers:
            for _ in range(MIXTURE_STARTS):
                starts(x, k, rng)
            continue
        label, c = k_means(x, k, rng, MIXTURE_STARTS, MIXTURE_ITERATIONS)
        model = {"shares": np.bincount(label, minlength=k) / len(x), "means": c, "variances": np.stack([x[label == j].var(0) if (label == j).any() else x.var(0) for j in range(k)]) + 1e-6, "k": k}
        for _ in range(rounds):
            r, _ = posterior(model, x)
            n = r.sum(0) + 1e-12
            c = r.T @ x / n[:, None]
            var = np.empty_like(c)
            for j in range(k):
                np.subtract(x, c[j], out=off)
                np.multiply(off, off, out=off)
                var[j] = r[:, j] @ off / n[j]
            model = {"shares": n / len(x), "means": c, "variances": var + 1e-6, "k": k}
        like = posterior(model, x)[1]
        fits.append((k, float(-2 * like.sum() + (k * (2 * x.shape[1] + 1) - 1) * np.log(len(x))), model))
    return fits


def best_mixture(fits: list[tuple[int, float, dict]]) -> dict:
    """The model of the first k whose gain on the last is under a tenth of what is left from k = 1."""
    fits = sorted(fits, key=lambda f: f[0])
    first, last = fits[0][1], fits[-1][1]
    return next(m for i, (_, s, m) in enumerate(fits) if s < 0.9 * last + 0.1 * first or i == len(fits) - 1)


def gaussian_mixture(x: np.ndarray, most: int, rng: np.random.Generator, rounds: int = 100) -> tuple[dict, list[float]]:
    """best_mixture() of k = 1..most, and the criterion of each."""
    fits = mixtures(x, list(range(1, most + 1)), rng, rounds)
    return best_mixture(fits), [s for _, s, _ in fits]


def bundles(most: int) -> list[list[int]]:
    """1..most in lists of about the same sum, so of the same work: each number with what it lacks to the largest."""
    return [[n, most - n] if 0 < most - n < n else [n] for n in range(most, (most - 1) // 2, -1)]


# --------------------------------------------------------------------------------------------------- Spark


def _seeded(key, attempt: int) -> np.random.Generator:
    import zlib

    return np.random.default_rng([zlib.crc32(str(key).encode()), attempt])


def _fitted_in_rounds(points: DataFrame, group: str, id_col: str, vec: str, sizes: DataFrame, method: str, most: int) -> list[tuple]:
    """group, model, k of each group of sizes, fitted to all of its rows."""
    import pickle

    of = {"gmm": (list(range(1, most + 1)), MIXTURE_STARTS, MIXTURE_ITERATIONS), "kmeans": ([most], REPLICATES, ITERATIONS)}[method]
    out = []
    for key, found in fits.fit(points, group, id_col, vec, sizes, method, *of):
        model = best_mixture(found) if found is not None and method == "gmm" else found
        out.append((key, pickle.dumps(model), model["k"] if model else 0))
    return out


def cluster(points: DataFrame, group: str, id_col: str, vec: str, method: str = "spectral", k: int | None = None, most: int = MOST, least: int = 100, landmarks: int | None = None) -> DataFrame:
    """group, id, clust, k: clusters of each group of more than `least` rows, none (0) in smaller ones.

    Spectral clustering is fitted to the landmarks of a group, at most `landmarks` (LANDMARKS) by a hash of the id, in one task. k-means and mixtures are fitted to
    all rows: of groups of at most `landmarks` (POINTS) rows in tasks that hold them, of larger ones in rounds over their parts, fits.fit(). Then all rows are
    placed in batches against the fitted models, which have a bounded size each; in mixtures by the largest posterior, 0 where
    none exceeds POSTERIOR. Numerical failures are tried again with
    another seed; a group that keeps failing is left at 0. Rows of a null group are left out.
    The mixtures of a group that tasks hold are fitted by tasks of their own, bundles of about the same work, and then compared: drawn alike, they are the same
    as one after the other (what fails depends on the rows, from the second component on, so bundles fail alike).
    """
    spark = ship(points.sparkSession)
    landmarks = landmarks or (LANDMARKS if method == "spectral" else POINTS)
    kind = {f.name: f.dataType.simpleString() for f in points.schema}
    size = written(points.groupBy(group).agg(F.count(F.lit(1)).alias("size")), "sizes")
    held = size if method == "spectral" else size.where(F.col("size") <= max(landmarks, least))
    chosen = points.select(group, id_col, vec) if method != "spectral" else marks(points.select(group, id_col, vec), group, id_col, landmarks)
    numbers = bundles(k or most) if method == "gmm" else [[]]

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["place", id_col])  # as marks() has them: what is drawn depends on the order
        key, part, model = frame[group].iloc[0], int(frame["bundle"].iloc[0]), None
        x = np.stack(frame[vec].to_numpy()).astype(float)
        if frame["size"].iloc[0] > least:
            for attempt in range(RETRIES):
                try:
                    rng = _seeded(key, attempt)
                    if method == "spectral":
                        m = spectral(x, rng, most, k, landmarks)
                        if (assign(m, x) == 0).mean() > MOST_DROPPED:
                            raise ValueError("too many rows dropped")
                    elif method == "kmeans":
                        m = {"centroids": k_means(x, k or most, rng)[1], "k": k or most}
                    else:
                        m = {"fits": mixtures(x, numbers[part], rng), "k": 0}
                    model = m
                    break
                except (ValueError, np.linalg.LinAlgError):
                    continue
        import pickle

        return pd.DataFrame({group: [key], "model": [pickle.dumps(model)], "k": [model["k"] if model else 0]})

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        import pickle

        every = [pickle.loads(m) for m in frame["model"]]
        model = None if any(m is None for m in every) else best_mixture([f for m in every for f in m["fits"]])
        return pd.DataFrame({group: [frame[group].iloc[0]], "model": [pickle.dumps(model)], "k": [model["k"] if model else 0]})

    # A bundle of a group is a task's work, whatever its bytes: by their bytes Spark would put many fits into one.
    bundle = F.when(F.col("size") > least, F.sequence(F.lit(0), F.lit(len(numbers) - 1))).otherwise(F.array(F.lit(0)))
    chosen = chosen.join(held, group).withColumn("place", F.xxhash64(id_col)).withColumn("bundle", F.explode(bundle))
    tasks = max(1, min(20_000, TASKS * len(numbers) * size.count()))
    models = chosen.repartition(tasks, group, "bundle").groupBy(group, "bundle").applyInPandas(fit, schema := f"{group} {kind[group]}, model binary, k int")
    models = written(models.groupBy(group).applyInPandas(choose, schema) if method == "gmm" else models, "models")
    if method != "spectral" and (large := _fitted_in_rounds(points, group, id_col, vec, size.where((F.col("size") > max(landmarks, least)) & F.col(group).isNotNull()), method, k or most)):
        models = models.unionByName(spark.createDataFrame(large, schema))  # a model for each group that no task holds

    def place(rows: pd.DataFrame, fitted: pd.DataFrame) -> pd.DataFrame:
        import pickle

        if not len(rows) or not len(fitted):
            return pd.DataFrame({group: [], id_col: [], "clust": [], "k": []})
        m, label = pickle.loads(fitted["model"].iloc[0]), np.zeros(len(rows), np.int32)
        for at in range(0, len(rows) if m is not None else 0, 1_000):
            x = np.stack(rows[vec].iloc[at : at + 1_000].to_numpy()).astype(float)
            label[at : at + 1_000] = assign(m, x) if "mark" in m else likeliest(m, x) if "shares" in m else square_distances(x, m["centroids"]).argmin(1) + 1
        return pd.DataFrame({group: rows[group], id_col: rows[id_col], "clust": label, "k": np.int32(fitted["k"].iloc[0])})

    # A group is cut into parts of about PART_ROWS rows; a copy of its model travels to each part, not to each row.
    parts = size.select(group, F.ceil(F.col("size") / PART_ROWS).cast("int").alias("parts"))
    rows = points.select(group, id_col, vec).join(parts, group).withColumn("part", F.pmod(F.xxhash64(id_col), F.col("parts")).cast("int")).drop("parts")
    models = models.join(parts, group).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return rows.groupBy(group, "part").cogroup(models.groupBy(group, "part")).applyInPandas(place, f"{group} {kind[group]}, {id_col} {kind[id_col]}, clust int, k int")
