"""k-means and diagonal mixtures of groups that no task should hold, fitted to all of their rows in rounds.

In a round every task passes once over its rows with the models of a bounded number of groups, and what its parts add up is joined by group
before it leaves Spark. The methods are those of clustering.k_means() and clustering.mixtures(): starts by k-means++, the cheapest of
several, as many rounds; of one drawn sequence of starts the first k are those of k components. What is drawn depends on the rows' ids,
not on how rows are dealt. Squares are taken about the group's mean.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .parts import matrix
from .tables import drop, written

PART, CHUNK = 20_000, 2_048  # rows of a part, and at a time
GROUPS = 64  # groups whose models travel together
SETTLED = 1e-12  # of the rows' mean square: centres that move less have settled
FLOOR = 1e-6  # added to variances

Sums = tuple[np.ndarray, np.ndarray, np.ndarray]  # what is added up; the smallest keys; the rows that have them


def _joined(a: Sums | None, b: Sums) -> Sums:
    if a is None:
        return b
    nearer = b[1] < a[1]
    return a[0] + b[0], np.where(nearer, b[1], a[1]), np.where(nearer[:, None], b[2], a[2])


def _drawn(place: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Rows x seeds: numbers above 0 and below 1 that follow from place and seed alone."""
    z = place.astype(np.uint64)[:, None] ^ seeds[None]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 0x9E3779B97F4A7C15)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return ((z ^ (z >> np.uint64(32))) >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances, rows x centres; 0 where rounding is all that is left."""
    size = (x * x).sum(1)[:, None] + (c * c).sum(1)[None]
    d = size - 2 * x @ c.T
    return np.where(d > 1e-14 * size, d, 0.0)


def _moments(model: dict, x: np.ndarray, place: np.ndarray) -> Sums:
    return np.concatenate(([len(x)], x.sum(0))), np.zeros(0), np.zeros((0, x.shape[1]))


def _spread(model: dict, x: np.ndarray, place: np.ndarray) -> Sums:
    return np.concatenate(([(x * x).sum()], (x * x).sum(0))), np.zeros(0), np.zeros((0, x.shape[1]))


def _start(model: dict, x: np.ndarray, place: np.ndarray) -> Sums:
    """The next centre of each sequence: the row with the smallest exponential draw over its weight."""
    c = model["centres"]  # sequences x drawn so far x width
    e = -np.log(_drawn(place, model["seeds"]))
    if c.shape[1]:
        w = _squares(x, c.reshape(-1, c.shape[2])).reshape(len(x), *c.shape[:2]).min(2)
        with np.errstate(divide="ignore", over="ignore"):
            e = np.where(w > 0, np.minimum(e / np.where(w > 0, w, 1), 1e299), 1e300 * (1 + e))  # copies of centres only where nothing else is left
    at = e.argmin(0)
    return np.zeros(0), e[at, np.arange(e.shape[1])], x[at]


def _nearest(model: dict, x: np.ndarray, place: np.ndarray) -> Sums:
    """Of sequences of centres: rows, sums and squares of each cluster, then the cost of each sequence; the row farthest from all centres."""
    ends = np.cumsum(model["sizes"])
    d, hard = _squares(x, model["centres"]), np.zeros((len(x), int(ends[-1])))
    cost, key, far = np.zeros(len(ends)), np.zeros(len(ends)), np.zeros((len(ends), x.shape[1]))
    for i, (lo, hi) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
        label = d[:, lo:hi].argmin(1)
        least = d[np.arange(len(x)), lo + label]
        hard[np.arange(len(x)), lo + label] = 1
        at = least.argmax()
        cost[i], key[i], far[i] = least.sum(), -least[at], x[at]
    squares = (hard.T @ (x * x)).ravel() if model["squares"] else np.zeros(0)
    return np.concatenate((hard.sum(0), (hard.T @ x).ravel(), squares, cost)), key, far


def _expected(model: dict, x: np.ndarray, place: np.ndarray) -> Sums:
    """Of mixtures side by side: expected rows, sums and squares of each component, then the log-likelihood of each mixture."""
    first = np.concatenate(([0], np.cumsum(model["sizes"])[:-1]))
    exact = 1 / model["variances"]
    m = model["means"]
    const = np.log(model["shares"] + 1e-300) - 0.5 * (np.log(2 * np.pi * model["variances"]).sum(1) + (m * m * exact).sum(1))
    logp = const[None] - 0.5 * ((x * x) @ exact.T) + x @ (m * exact).T
    top = np.maximum.reduceat(logp, first, axis=1)
    r = np.exp(logp - np.repeat(top, model["sizes"], axis=1))
    total = np.add.reduceat(r, first, axis=1)
    r /= np.repeat(total, model["sizes"], axis=1)
    return np.concatenate((r.sum(0), (r.T @ x).ravel(), (r.T @ (x * x)).ravel(), (top + np.log(total)).sum(0))), np.zeros(0), np.zeros((0, x.shape[1]))


class Rounds:
    """rows: a written table of (group, part, place, v), each part in order of place; models of its groups go over it once a round."""

    def __init__(self, rows: DataFrame, group: str):
        self.rows, self.group, self.spark = rows, group, ship(rows.sparkSession)
        self.kind = dict(rows.dtypes)[group]

    def over(self, work: Callable[[dict, np.ndarray, np.ndarray], Sums], models: dict) -> dict[object, Sums]:
        """Of each group of models what work(model, rows less the model's mean, place) gives over all of its rows."""
        names = [self.group, "part", "added", "key", "at"]
        schema = f"{self.group} {self.kind}, part long, added binary, key binary, at binary"

        def row(types: list, name: object, part: int, sums: Sums) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([name], types[0]), pa.array([part], pa.int64()), *(pa.array([np.ascontiguousarray(a, float).tobytes()], pa.binary()) for a in sums)], names)

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, sums = None, None
            for batch in batches:
                types = [c.type for c in batch.columns]
                part, keys = np.asarray(batch.column(1)), batch.column(0).to_numpy(zero_copy_only=False)
                cut = np.flatnonzero((part[1:] != part[:-1]) | (keys[1:] != keys[:-1])) + 1
                for lo, hi in zip([0, *cut], [*cut, len(part)], strict=True):
                    if lo == hi:
                        continue
                    this = batch.column(0)[int(lo)].as_py(), int(part[lo])
                    if this != now:
                        if sums is not None:
                            yield row(types, *now, sums)
                        now, sums = this, None
                    if (model := models.get(this[0])) is None:
                        continue
                    for at in range(int(lo), int(hi), CHUNK):
                        b = batch.slice(at, min(CHUNK, int(hi) - at))
                        width = b.column(3)[0].as_py()
                        if b.column(4).null_count or not (np.asarray(b.column(4).value_lengths()) == width).all():
                            raise ValueError("vectors of a group differ in length")
                        x = matrix(b.column(4), width)
                        sums = _joined(sums, work(model, x - model["mean"] if "mean" in model else x, np.asarray(b.column(2))))
            if sums is not None:
                yield row(types, *now, sums)

        def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, sums = None, None
            for batch in batches:
                types = [c.type for c in batch.columns]
                for i in range(batch.num_rows):
                    name = batch.column(0)[i].as_py()
                    added, key, at = (np.frombuffer(batch.column(j)[i].as_py()) for j in (2, 3, 4))
                    if name != now:
                        if sums is not None:
                            yield row(types, now, 0, sums)
                        now, sums = name, None
                    sums = _joined(sums, (added, key, at.reshape(len(key), -1) if len(key) else np.zeros((0, 1))))
            if sums is not None:
                yield row(types, now, 0, sums)

        tasks = min(len(models), int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        some = self.rows.mapInArrow(partial, schema).repartition(tasks, self.group).sortWithinPartitions(self.group, "part")
        found = {}
        for r in some.mapInArrow(total, schema).collect():  # a row a group, as large as its models
            key = np.frombuffer(r["key"])
            found[r[self.group]] = np.frombuffer(r["added"]), key, np.frombuffer(r["at"]).reshape(len(key), -1) if len(key) else None
        return found


def _clusters(added: np.ndarray, n: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts, sums, squares (none, if not asked for) and the rest."""
    rest = added[n + n * width :]
    squares = rest[: n * width].reshape(n, width) if len(rest) >= n * width else None
    return added[:n], added[n : n + n * width].reshape(n, width), squares, rest[n * width :] if squares is not None else rest


def _seeds(key: object, sequences: int, step: int) -> np.ndarray:
    return np.random.default_rng([zlib.crc32(str(key).encode()), step]).integers(0, 2**63, sequences).astype(np.uint64)


def _k_means(rounds: Rounds, about: dict, numbers: list[int], replicates: int, iterations: int) -> dict:
    """Of each group: per number the centres (less the mean), counts, sums and squares of the cheapest of `replicates` starts."""
    drawn = {g: np.zeros((replicates, 0, len(a["mean"]))) for g, a in about.items()}
    for step in range(max(numbers)):
        found = rounds.over(_start, {g: {"mean": a["mean"], "centres": drawn[g], "seeds": _seeds(g, replicates, step)} for g, a in about.items()})
        drawn = {g: np.concatenate((drawn[g], found[g][2][:, None]), 1) for g in about}
    sequences = [(k, i) for k in numbers for i in range(replicates)]
    centres = {g: {s: drawn[g][s[1], : s[0]] for s in sequences} for g in about}
    moving = {g: list(sequences) for g in about}
    side = lambda g, some, squares: {"mean": about[g]["mean"], "centres": np.concatenate([centres[g][s] for s in some]), "sizes": [s[0] for s in some], "squares": squares}
    for _ in range(iterations):
        asked = {g: side(g, some, False) for g, some in moving.items() if some}
        if not asked:
            break
        for g, (added, _, far) in rounds.over(_nearest, asked).items():
            some, at, still = moving[g], 0, []
            n, sums, _, _ = _clusters(added[: -len(some)], sum(s[0] for s in some), len(about[g]["mean"]))
            for i, s in enumerate(some):
                own, c = n[at : at + s[0]], sums[at : at + s[0]]
                new = np.where(own[:, None] > 0, c / np.maximum(own, 1)[:, None], far[i][None])
                if ((new - centres[g][s]) ** 2).sum(1).max() > SETTLED * about[g]["square"]:
                    still.append(s)
                centres[g][s], at = new, at + s[0]
            moving[g] = still
    out = {}
    for g, (added, _, _) in rounds.over(_nearest, {g: side(g, sequences, True) for g in about}).items():
        n, sums, squares, cost = _clusters(added, sum(s[0] for s in sequences), len(about[g]["mean"]))
        first = np.cumsum([0, *[s[0] for s in sequences]])
        out[g] = {}
        for k in numbers:
            best = min((i for i, s in enumerate(sequences) if s[0] == k), key=lambda i: cost[i])
            own = slice(first[best], first[best + 1])
            out[g][k] = {"centres": centres[g][sequences[best]], "n": n[own], "sums": sums[own], "squares": squares[own]}
    return out


def _mixtures(rounds: Rounds, about: dict, numbers: list[int], replicates: int, iterations: int, times: int) -> dict:
    """Of each group k, criterion and model (as clustering.mixtures() has them) of mixtures of so many components."""
    models = {}
    for g, found in _k_means(rounds, about, numbers, replicates, iterations).items():
        a, shares, means, variances = about[g], [], [], []
        for k in numbers:
            f = found[k]
            some, n = (f["n"] > 0)[:, None], np.maximum(f["n"], 1)[:, None]
            shares.append(f["n"] / a["n"])
            means.append(f["centres"])
            variances.append(np.where(some, np.maximum(f["squares"] / n - (f["sums"] / n) ** 2, 0), a["variance"][None]) + FLOOR)
        models[g] = {"mean": a["mean"], "sizes": numbers, "shares": np.concatenate(shares), "means": np.concatenate(means), "variances": np.concatenate(variances)}
    for at in range(times + 1):
        found, like = rounds.over(_expected, models), {}
        for g, (added, _, _) in found.items():
            n, sums, squares, like[g] = _clusters(added, sum(numbers), len(about[g]["mean"]))
            if at < times:
                n = n + 1e-12
                m = sums / n[:, None]
                models[g] |= {"shares": n / about[g]["n"], "means": m, "variances": np.maximum(squares / n[:, None] - m * m, 0) + FLOOR}
    out = {}
    for g, m in models.items():
        first, width = np.cumsum([0, *numbers]), len(m["mean"])
        out[g] = []
        for i, k in enumerate(numbers):
            own = slice(first[i], first[i + 1])
            criterion = float(-2 * like[g][i] + (k * (2 * width + 1) - 1) * np.log(about[g]["n"]))
            out[g].append((k, criterion, {"shares": m["shares"][own], "means": m["means"][own] + m["mean"], "variances": m["variances"][own], "k": k}))
    return out


def fit(points: DataFrame, group: str, id_col: str, vec: str, sizes: DataFrame, method: str, numbers: list[int], replicates: int, iterations: int, times: int = 100) -> Iterator[tuple[object, object]]:
    """group and fit of each group of sizes (group, size): for 'gmm' a list of k, criterion and model, else the model of k-means. None
    where components are not finite. Groups are fitted GROUPS at a time."""
    names = [r[group] for r in sizes.select(group).orderBy(group).collect()]
    for at in range(0, len(names), GROUPS):
        wave = sizes.where(F.col(group).isin(names[at : at + GROUPS])).select(group, F.ceil(F.col("size") / PART).cast("long").alias("parts"), "size")
        tasks = max(1, wave.agg(F.sum("parts")).collect()[0][0])
        place = F.xxhash64(id_col)
        rows = points.join(wave, group).select(group, F.pmod(F.shiftright(place, 20), F.col("parts")).alias("part"), place.alias("place"), F.coalesce(F.size(vec), F.lit(-1)).alias("width"), F.transform(vec, lambda v: v.cast("double")).alias("v"))
        rows = written(rows.repartition(min(tasks, 20_000), group, "part").sortWithinPartitions(group, "part", "place"), "fit-rows")
        rounds, about = Rounds(rows, group), {}
        for g, (added, _, _) in rounds.over(_moments, {g: {} for g in names[at : at + GROUPS]}).items():
            if np.isfinite(added).all():
                about[g] = {"n": added[0], "mean": added[1:] / added[0]}
            else:
                yield g, None
        for g, (added, _, _) in rounds.over(_spread, about).items() if about else ():
            about[g] |= {"square": added[0] / about[g]["n"], "variance": added[1:] / about[g]["n"]}
        if about and method == "gmm":
            yield from _mixtures(rounds, about, numbers, replicates, iterations, times).items()
        elif about:
            for g, found in _k_means(rounds, about, numbers, replicates, iterations).items():
                yield g, {"centroids": found[numbers[0]]["centres"] + about[g]["mean"], "k": numbers[0]}
        drop(rows)
