"""Noise events without replacement, averages of stimulus frames, leading eigenvectors, models that travel to parts."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegraph.operators import clustering, detection, reports


def drawn(spark, spans, rate, seed=0):
    d = spark.createDataFrame(spans, "electrode int, first long, span long")
    return [(r["electrode"], r["spike_time"]) for r in detection.random_events(d, rate, seed).collect()]


def test_places_are_distinct_and_inside(spark):
    spans = [(1, 0, 1), (2, 100, 2), (3, -5, 37), (4, 0, 4096), (5, 7, 4097), (6, 0, 0), (7, 10**12, 1000)]
    got = drawn(spark, spans, 1.0)
    assert len(got) == len(set(got))
    for e, first, span in spans:  # all places, each once: it is a permutation
        assert sorted(t for x, t in got if x == e) == list(range(first, first + span))


def test_draws_repeat_and_are_uniform(spark):
    spans = [(e, 0, 50) for e in range(2_000)]
    one, two, other = drawn(spark, spans, 0.1), drawn(spark, spans, 0.1), drawn(spark, spans, 0.1, 1)
    assert sorted(one) == sorted(two) != sorted(other)
    assert set(Counter(e for e, _ in one).values()) == {5}
    n = Counter(t for _, t in one)
    assert sum((n[t] - 200) ** 2 / 200 for t in range(50)) < 86  # chi-square of 49 degrees, 0.1 %
    pairs = Counter()
    for e in range(2_000):
        mine = sorted(t for x, t in one[5 * e : 5 * e + 5])
        pairs[mine[1] - mine[0] == 1] += 1
    assert pairs[True] > 50  # neighbours are drawn together too, which one draw in each even part seldom gives
    with pytest.raises(ValueError):
        drawn(spark, spans, 1.5)


@pytest.mark.parametrize(("depth", "offset", "block", "neurons", "values"), [(5, -1, 4_096, 128, 512), (7, -1, 8, 2, 16), (30, 0, 40, 3, 64), (9, 2, 4, 1, 7)])
def test_average_frames(spark, monkeypatch, depth, offset, block, neurons, values):
    monkeypatch.setattr(reports, "FRAMES", block)
    monkeypatch.setattr(reports, "NEURONS", neurons)
    monkeypatch.setattr(reports, "VALUES", values)
    rng = np.random.default_rng(1)
    frames = {f: rng.normal(size=70) for f in range(-3, 100) if rng.random() < 0.9}
    events = [(int(rng.integers(6)), int(rng.integers(-10, 115))) for _ in range(400)]
    got = reports.triggered_average(spark.createDataFrame(events, "neuron_id int, frame long"), spark.createDataFrame([(f, v.tolist()) for f, v in frames.items()], "frame long, values array<double>"), depth, offset)
    want = {}
    for n, f in events:
        for back in range(depth):
            if f + offset - back in frames:
                want.setdefault((n, back), []).append(frames[f + offset - back])
    found = {(r["neuron_id"], r["back"]): (r["n"], r["mean"]) for r in got.collect()}
    assert set(found) == set(want)
    for k, v in want.items():
        assert found[k][0] == len(v)
        np.testing.assert_allclose(found[k][1], np.mean(v, 0), atol=1e-12)


def test_average_of_nothing(spark):
    e, f = spark.createDataFrame([], "neuron_id int, frame long"), spark.createDataFrame([(1, [1.0])], "frame long, values array<double>")
    assert reports.triggered_average(e, f, 3).collect() == []
    assert reports.triggered_average(spark.createDataFrame([(1, 2)], "neuron_id int, frame long"), f.limit(0), 3).collect() == []


def graph_matrix(n, parts, seed):
    """A normalised affinity of points in several places; as many eigenvalues are 1 as there are parts that do not touch."""
    rng = np.random.default_rng(seed)
    centre = 100.0 * np.arange(parts)[:, None] * np.ones((1, 4))
    x = centre[np.arange(n) % parts] + rng.normal(size=(n, 4))
    a = np.exp(-((x[:, None] - x[None]) ** 2).sum(2))
    np.fill_diagonal(a, 0)
    d = np.maximum(a.sum(1), 1e-300)
    return a / np.sqrt(np.outer(d, d))


@pytest.mark.parametrize(("n", "parts"), [(60, 3), (700, 1), (700, 6), (900, 25)])
def test_leading_vectors(n, parts):
    a = graph_matrix(n, parts, 2)
    w, v = clustering.leading(a, 20, np.random.default_rng(0))
    full = np.linalg.eigvalsh(a)[::-1][:20]
    np.testing.assert_allclose(w, full, atol=1e-9)
    assert np.abs(a @ v - v * w).max() < 1e-7
    np.testing.assert_allclose(v.T @ v, np.eye(20), atol=1e-9)


def test_a_model_goes_to_each_part(spark, monkeypatch):
    """Groups cut into parts give the labels of uncut ones; small groups stay at 0."""
    rng = np.random.default_rng(4)
    rows = [(int(i >= 600), i, (rng.normal(size=3) * 0.1 + 3.0 * (i % 3)).tolist()) for i in range(620)]
    p = spark.createDataFrame(rows, "electrode int, id long, v array<double>")
    want = {r["id"]: (r["clust"], r["k"]) for r in clustering.cluster(p, "electrode", "id", "v", "kmeans", k=3, least=50).collect()}
    monkeypatch.setattr(clustering, "PART_ROWS", 37)
    got = {r["id"]: (r["clust"], r["k"]) for r in clustering.cluster(p, "electrode", "id", "v", "kmeans", k=3, least=50).collect()}
    assert got == want and len(want) == 620
    assert all(want[i] == (0, 0) for i in range(600, 620)) and len({want[i][0] for i in range(3)}) == 3
    empty = clustering.cluster(p.limit(0), "electrode", "id", "v", "kmeans", k=3)
    assert empty.collect() == [] and F.col is not None


def test_scales_and_affinities_without_a_table_of_pairs(spark, monkeypatch):
    monkeypatch.setattr(clustering, "ROWS_AT_ONCE", 7)
    rng = np.random.default_rng(6)
    rows = [(i % 3, i, rng.normal(size=5).tolist()) for i in range(90)] + [(9, 200 + i, [0.0] * 5) for i in range(3)]
    p = spark.createDataFrame(rows, "electrode int, id long, v array<double>")
    d = clustering.pairs(p, "electrode", "id", "v", 25)
    scale = clustering.local_scale(d, "electrode")
    got = clustering.landmark_scales(p, "electrode", "id", "v", landmarks=25)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, scale.collect()))
    for kernel, cut in (("gauss", 0.0), ("power", 0.2)):
        want = sorted((tuple(r)[:3], round(r["a"], 12)) for r in clustering.affinity(d, scale, "electrode", kernel, cut).collect())
        found = clustering.landmark_affinity(p, "electrode", "id", "v", kernel, cut, landmarks=25)
        assert sorted((tuple(r)[:3], round(r["a"], 12)) for r in found.collect()) == want and want
    assert clustering.landmark_affinity(p.limit(0), "electrode", "id", "v").collect() == []


@pytest.mark.parametrize("bins", [2, 5, 40, 4_096])
def test_noise_from_bins_is_that_of_all_values(spark, bins):
    rng = np.random.default_rng(7)
    channels = {1: rng.normal(size=3_000) * 5, 2: np.concatenate((rng.normal(size=500), rng.normal(size=40) * 60)), 3: np.round(rng.normal(size=800) * 4), 4: np.array([2.0] * 20), 5: rng.standard_cauchy(600), 6: np.array([1.0]), 7: rng.normal(size=900) + 1_000}
    rows = [(e, float(v)) for e, x in channels.items() for v in x] + [(1, None), (2, float("nan")), (8, None)]
    got = {r["electrode"]: r for r in detection.noise_floor(spark.createDataFrame(rows, "electrode int, value double"), bins=bins).collect()}
    assert set(got) == set(channels)
    for e, x in channels.items():
        sigma, mu, rounds, n = detection.converged_noise(x.tolist())
        assert (got[e]["rounds"], got[e]["n"]) == (rounds, n), e
        assert abs(got[e]["sigma"] - sigma) < 1e-9 * max(1, abs(mu)) and abs(got[e]["mu"] - mu) < 1e-9 * max(1, abs(mu))
