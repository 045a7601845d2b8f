"""Fits and assignments of the clusterings."""

import inspect

import numpy as np
import pytest

from tidegraph.operators import clustering
from tidegraph.plans import QUERIES


def test_mixture_labels_follow_the_posterior(spark):
    r = np.random.default_rng(4)
    x = np.concatenate((r.normal(size=(400, 2)) * 0.2, r.normal(size=(400, 2)) * [3.0, 0.2] + [5.0, 0.0]))
    between = [[-1.4, 0.0], [1.2, 0.0], [1.8, 0.0], [0.1, 0.1], [8.0, 0.0]]  # the first three are nearer to the narrow one
    rows = [(1, i, [float(a) for a in v]) for i, v in enumerate([*between, *x])]
    p = spark.createDataFrame(rows, "g int, id long, v array<double>")
    got = {q.id: q.clust for q in clustering.cluster(p, "g", "id", "v", "gmm", k=None, most=2, landmarks=1_000).collect()}
    assert got[3] != got[4] and 0 not in (got[3], got[4])
    assert [got[i] for i in range(3)] == [got[4]] * 3


def test_posterior_threshold():
    m = {"shares": np.array([0.5, 0.5]), "means": np.array([[0.0], [4.0]]), "variances": np.array([[1.0], [1.0]]), "k": 2}
    x = np.array([[0.0], [1.9], [2.0], [4.0]])
    assert clustering.likeliest(m, x).tolist() == [1, 1, 0, 2]  # half and half in the middle
    assert clustering.likeliest(m, x, 0.9).tolist() == [1, 0, 0, 2]


@pytest.mark.parametrize("name", ["spectral_labels", "spectral_forced_k", "kmeans_labels", "gmm_bic"])
def test_registered_clusterings_have_no_bounds_of_their_own(spark, small, monkeypatch, name):
    seen = []
    monkeypatch.setattr(clustering, "cluster", lambda *a, **b: seen.append(inspect.signature(cluster).bind(*a, **b).arguments))
    QUERIES[name](spark, small)
    assert not {"most", "landmarks"} & set(seen[0])
    assert {len(r.v) for r in seen[0]["points"].select("v").collect()} == {64}


def test_more_than_five_spectral_clusters_in_late_components(spark, tmp_path):
    r = np.random.default_rng(7)
    rows = [(i, [float(a) for a in r.normal(size=64) * 0.05 + 4 * np.eye(64)[40 + i % 8]], 3) for i in range(320)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    own = {(q.id % 8, q.clust) for q in QUERIES["spectral_labels"](spark, str(tmp_path)).collect()}
    kinds = [{k for k, c in own if c == x} for x in {c for _, c in own}]
    assert len(kinds) >= 8 and all(len(k) == 1 for k in kinds)


cluster = clustering.cluster


def test_mixtures_of_a_channel_are_fitted_by_many_tasks(spark):
    """Bundles cover the numbers with about the same work, a bundle's fits are those of the whole sequence, and Spark may not put them together."""
    for most in range(1, 40):
        parts = clustering.bundles(most)
        assert sorted(sum(parts, [])) == list(range(1, most + 1)) and max(map(sum, parts)) == most
    r = np.random.default_rng(9)
    x = np.concatenate([r.normal(size=(40, 3)) + 6 * r.normal(size=3) for _ in range(3)])
    model, scores = clustering.gaussian_mixture(x, 5, clustering._seeded(1, 0), 10)
    fits = sum((clustering.mixtures(x, part, clustering._seeded(1, 0), 10) for part in clustering.bundles(5)), [])
    assert [s for _, s, _ in sorted(fits, key=lambda f: f[0])] == scores
    found = clustering.best_mixture(fits)
    assert found["k"] == model["k"] and all(np.array_equal(found[c], model[c]) for c in model)
    rows = [(g, 1_000 * g + i, v.tolist()) for g in range(4) for i, v in enumerate(x)]
    p = spark.createDataFrame([*rows, (9, 1, [0.0] * 3)], "g int, id long, v array<double>")
    seen, written = [], clustering.written
    clustering.written = lambda d, tag: seen.append((tag, d)) or written(d, tag)
    try:
        got = {(q.g, q.id): (q.clust, q.k) for q in clustering.cluster(p, "g", "id", "v", "gmm", most=5).collect()}
    finally:
        clustering.written = written
    plan = next(d for t, d in seen if t == "models")._jdf.queryExecution().executedPlan().toString()
    assert ", 60), REPARTITION_BY_NUM" in plan  # five groups, three bundles, four tasks each
    want = {g: clustering.gaussian_mixture(x, 5, clustering._seeded(g, 0))[0] for g in range(4)}
    assert got[9, 1] == (0, 0)
    for g in range(4):
        assert [got[g, 1_000 * g + i][1] for i in range(len(x))] == [want[g]["k"]] * len(x)
