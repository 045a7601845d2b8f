"""The exact threshold join and what is built on it, against all pairs."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegraph.operators import graph, images, nearby

POINTS = "id long, v array<double>"


def brute(rows, bound):
    """Pairs of rows of equal length nearer than the bound, by a plain loop."""
    ok = [(i, np.array(v)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    return {(min(a, b), max(a, b)) for (a, x), (b, y) in itertools.combinations(ok, 2) if len(x) == len(y) and ((x - y) ** 2).sum() < bound}


def clustered(n, seed=0, dims=8, each=10):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(1, n // each), dims))
    return [(i, (centres[i % len(centres)] + 0.02 * rng.normal(size=dims)).tolist()) for i in range(n)]


@pytest.mark.parametrize(("bound", "pivots", "part_rows"), [(0.05, None, 2_000), (1.5, 7, 20), (3.0, 40, 13), (40.0, 5, 50), (0.4, 1, 9)])
def test_pairs_equal_all_pairs(spark, bound, pivots, part_rows):
    rows = clustered(240)
    got = nearby.near_pairs(spark.createDataFrame(rows, POINTS), "id", "v", bound, pivots, part_rows).collect()
    assert len(got) == len({(r["id_a"], r["id_b"]) for r in got})
    assert {(r["id_a"], r["id_b"]) for r in got} == brute(rows, bound)
    where = dict(rows)
    assert all(abs(r["d2"] - ((np.array(where[r["id_a"]]) - np.array(where[r["id_b"]])) ** 2).sum()) < 1e-12 for r in got)


def test_odd_rows(spark):
    rows = [(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 0.0]), (5, [None, 0.0]), (6, [float("inf"), 0.0]), (7, [0.0]), (8, [0.1]), (9, []), (10, [0.0, 0.5]), (11, [1e9, 0.0]), (-5, [1e9, 0.3])]
    t = spark.createDataFrame(rows, POINTS).withColumn("cell", F.lit("mine")).withColumn("r", F.lit(-1))
    got = {(r["id_a"], r["id_b"]) for r in nearby.near_pairs(t, "id", "v", 0.3).collect()}
    assert got == {(1, 2), (1, 10), (2, 10), (7, 8), (-5, 11)} == brute(rows, 0.3)
    assert nearby.near_pairs(t, "id", "v", 0.0).collect() == []
    assert nearby.near_pairs(spark.createDataFrame([], POINTS), "id", "v", 1.0).collect() == []
    assert nearby.near_pairs(spark.createDataFrame([(3, None)], POINTS), "id", "v", 1.0).collect() == []


def test_a_third_in_one_place(spark):
    rows = clustered(200, 3) + [(1000 + i, [5.0] * 8) for i in range(100)]
    got = {(r["id_a"], r["id_b"]) for r in nearby.near_pairs(spark.createDataFrame(rows, POINTS), "id", "v", 0.02, None, 16).collect()}
    assert got == brute(rows, 0.02)


def compared(spark, n):
    """Pairs that meet in some part, of all that could."""
    rows = spark.createDataFrame(clustered(n, 1), POINTS)
    cells = nearby.Cells(rows, 0.02**0.5, None, 2_000)
    placed = cells.home(rows).toPandas()
    x = np.stack(placed["v"].to_numpy())
    _, to, _ = cells.visits(x, placed["cell"].to_numpy(), placed["r"].to_numpy())
    size = np.bincount(placed["cell"], minlength=len(cells.pivots))
    return int((np.bincount(to, minlength=len(size)) * size).sum() + (size * (size - 1) // 2).sum())


def test_pairs_compared_grow_below_the_square(spark):
    few, many = compared(spark, 1_000), compared(spark, 4_000)
    assert few < 0.12 * 1_000 * 999 / 2 and many < 0.07 * 4_000 * 3_999 / 2
    assert many < 11 * few  # of all pairs there are sixteen times as many


# ------------------------------------------------------------------------------------------- pairs of electrodes


def union_find(nodes, links):
    lead = {n: n for n in nodes}
    for a, b in links:
        x, y = a, b
        while lead[x] != x:
            x = lead[x]
        while lead[y] != y:
            y = lead[y]
        lead[max(x, y)] = min(x, y)
    out = {}
    for n in nodes:
        r = n
        while lead[r] != r:
            r = lead[r]
        out.setdefault(r, []).append(n)
    return list(out.values())


def losers(homes, counts, linked):
    """(pair, master, loser) over every pair of electrodes; linked(e1, e2, a, b)."""
    out = set()
    for e1, e2 in itertools.combinations(sorted(set(homes.values())), 2):
        here = [n for n, e in homes.items() if e in (e1, e2)]
        for part in union_find(here, [(a, b) for a, b in itertools.combinations(here, 2) if linked(e1, e2, a, b)]):
            best = min(part, key=lambda n: (-counts.get(n, 0), n))
            out |= {(f"{e1}-{e2}", best, n) for n in part if n != best}
    return out


def test_global_duplicates_over_every_pair(spark):
    rng = np.random.default_rng(2)
    rows = clustered(60, 4, 4, 6)
    homes = {i: int(rng.integers(-2, 6)) for i, _ in rows}
    counts = {i: int(rng.integers(0, 5)) for i, _ in rows if i % 7}
    v = {i: np.array(x) for i, x in rows}
    want = losers(homes, counts, lambda e1, e2, a, b: 0 < ((v[a] - v[b]) ** 2).sum() < 0.5)
    t = spark.createDataFrame([(homes[i], i, x) for i, x in rows], "electrode int, id long, v array<double>")
    c = spark.createDataFrame(list(counts.items()), "id long, n long")
    across, within = graph.trace_links(t, "electrode", "id", "v", 0.5)
    found = graph.across_pairs(t.select("electrode"), across, within, c)
    assert {tuple(r) for r in graph.spread(found, t.select("electrode"), across).collect()} == want
    assert {(r["master_id"], r["loser_id"]) for r in found.collect()} == {x[1:] for x in want}


def picture(kind, seed):
    """Images of neurons on a line of electrodes: local ones, far-reaching ones, silent ones, twins."""
    rng = np.random.default_rng(seed)
    wave, homes, n = {}, {}, 0
    for e in range(1, 8):
        for _ in range(rng.integers(1, 4)):
            n += 1
            homes[n] = e
            reach = range(1, 8) if kind == "dense" else [x for x in range(e - 1, e + 2)] + ([int(rng.integers(1, 8))] if rng.random() < 0.5 else [])
            shape = rng.normal(size=3)
            for x in set(reach):
                w = shape * (3.0 if x == e else 1.0) + 0.4 * rng.normal(size=3)
                wave[n, x] = w if rng.random() < 0.95 else np.zeros(3)
            if n % 5 == 0 and n > 1:
                for x in range(0, 9):
                    wave.pop((n, x), None)
                    if (n - 1, x) in wave:
                        wave[n, x] = wave[n - 1, x] * 2.0 + (0 if n % 10 else 1e-3)
            if n % 11 == 0:
                for x in range(0, 9):
                    wave.pop((n, x), None)
    return wave, homes


@pytest.mark.parametrize(("kind", "seed", "threshold"), [("local", 1, 0.8), ("local", 2, 1.2), ("dense", 3, 0.6), ("dense", 4, 1.7), ("local", 5, 2.5)])
def test_images_across_every_pair(spark, kind, seed, threshold):
    wave, homes = picture(kind, seed)
    counts = {n: n * 7 % 5 for n in homes if n % 4}

    def linked(e1, e2, a, b):
        union = sorted({e1 - 1, e1, e1 + 1, e2 - 1, e2, e2 + 1})
        x, y = (np.concatenate([wave.get((n, e), np.zeros(3)) for e in union]) for n in (a, b))
        if not x.any() or not y.any():
            return False
        d2 = ((x / np.sqrt((x * x).sum()) - y / np.sqrt((y * y).sum())) ** 2).sum()
        return 1e-30 < d2 < threshold

    want = losers(homes, counts, linked)
    im = spark.createDataFrame([(n, e, w.tolist()) for (n, e), w in wave.items()], "neuron_id long, electrode int, wave array<double>")
    h = spark.createDataFrame(list(homes.items()), "neuron_id long, electrode int")
    line = spark.createDataFrame([(e, x) for e in range(0, 9) for x in (e - 1, e, e + 1)], "electrode int, neighbor int")
    c = spark.createDataFrame(list(counts.items()), "id long, n long")
    got = {tuple(r) for r in images.discard_across(im, h, line, c, threshold, laid_out=True).collect()}
    assert got == want
    short = images.discard_across(im, h, line, c, threshold)
    assert {(r["master_id"], r["loser_id"]) for r in short.collect()} == {x[1:] for x in want}


def test_only_visitors_meet(spark):
    """Local images: candidates stay in proportion to the electrodes, not to their square."""
    def candidates(n):
        rng = np.random.default_rng(1)
        rows = [(3 * e + k, e + d, (rng.normal(size=2) * (1 if d else 5)).tolist()) for e in range(n) for k in range(3) for d in (-1, 0, 1)]
        im = spark.createDataFrame(rows, "neuron_id long, electrode int, wave array<double>")
        h = im.groupBy("neuron_id").agg(F.floor(F.first("neuron_id") / 3).cast("int").alias("electrode"))
        line = spark.createDataFrame([(e, x) for e in range(n) for x in (e - 1, e, e + 1)], "electrode int, neighbor int")
        return images.AcrossImages(im, h, line, 0.5).candidates().count()

    few, many = candidates(10), candidates(40)
    assert many < 5 * few
