"""Fits of groups that no task holds: all rows count, in rounds over their parts."""

import numpy as np
import pytest

from tidegraph.operators import clustering, fits


def rows(r, n, width=3):
    """Three tight clouds, and a fourth of a few rows that a sample by a hash of the id may leave out."""
    at = np.array([[0.0] * width, [9.0] * width, [-9.0] * width, [60.0] * width])
    own = np.where(np.arange(n) < 4, 3, np.arange(n) % 3)
    return at[own] + 0.3 * r.normal(size=(n, width)), own


@pytest.mark.parametrize("method", ["gmm", "kmeans"])
def test_large_groups_are_fitted_to_all_rows(spark, monkeypatch, method):
    """With the limit of a task at 50 rows, a model of 400: every row counts, those that no sample of 50 would hold too."""
    monkeypatch.setattr(fits, "PART", 90)
    x, own = rows(np.random.default_rng(2), 400)
    small, _ = rows(np.random.default_rng(3), 40)
    data = [(1, i, v.tolist()) for i, v in enumerate(x)] + [(2, 1_000 + i, v.tolist()) for i, v in enumerate(small)]
    p = spark.createDataFrame(data, "g int, id long, v array<double>")
    k = None if method == "gmm" else 4
    monkeypatch.setattr(fits.fit, "__defaults__", (30,))
    seen, fit = [], fits.fit
    monkeypatch.setattr(fits, "fit", lambda *a, **b: (seen.append((key, m)) or (key, m) for key, m in fit(*a, **b)))
    got = {(q.g, q.id): (q.clust, q.k) for q in clustering.cluster(p, "g", "id", "v", method, k, most=4, least=20, landmarks=50).collect()}
    assert [key for key, _ in seen] == [1] and len(got) == 440
    if method == "gmm":
        model = clustering.best_mixture(seen[0][1])
        for n, criterion, m in seen[0][1]:  # the fits are fixed points of EM over all of the rows
            assert abs(criterion - (-2 * clustering.posterior(m, x)[1].sum() + (n * 7 - 1) * np.log(400))) < 1e-6 * abs(criterion)
            again, _ = clustering.posterior(m, x)
            assert np.allclose(again.sum(0) / 400, m["shares"], atol=1e-3)
        assert np.isclose(seen[0][1][0][2]["means"], x.mean(0)).all() and np.isclose(seen[0][1][0][2]["variances"], x.var(0) + 1e-6).all()
        want = clustering.likeliest(model, x)
    else:
        c = seen[0][1]["centroids"]
        want = clustering.square_distances(x, c).argmin(1) + 1
        assert np.allclose(c, [x[want == j + 1].mean(0) for j in range(4)])
        assert min(((c - 60) ** 2).sum(1)) < 3  # the four rows far away have a centre
    assert [got[1, i][0] for i in range(400)] == want.tolist()
    assert len({(a, b) for a, b in zip(own.tolist(), want.tolist())}) == len(set(own.tolist()))


def test_rounds_do_not_depend_on_how_rows_are_dealt(spark, monkeypatch):
    x, _ = rows(np.random.default_rng(4), 300)
    p = spark.createDataFrame([("a", i, v.tolist()) for i, v in enumerate(x)] + [("b", 500 + i, v.tolist()) for i, v in enumerate([*x[:200], np.full(3, np.nan)])], "g string, id long, v array<double>")
    sizes = p.groupBy("g").count().withColumnRenamed("count", "size")
    out = []
    for part, chunk, groups in ((1_000, 1_000, 64), (40, 7, 1)):
        monkeypatch.setattr(fits, "PART", part)
        monkeypatch.setattr(fits, "CHUNK", chunk)
        monkeypatch.setattr(fits, "GROUPS", groups)
        out.append(dict(fits.fit(p, "g", "id", "v", sizes, "gmm", [1, 2, 3], 2, 50, 20)))
    assert out[0]["b"] is None and out[1]["b"] is None
    for (k, s, m), (_, t, n) in zip(out[0]["a"], out[1]["a"], strict=True):
        assert abs(s - t) < 1e-6 * abs(s) and np.allclose(m["means"], n["means"]) and np.allclose(m["variances"], n["variances"]) and m["k"] == k


def test_starts_are_copies_only_where_nothing_else_is_left(spark):
    p = spark.createDataFrame([(1, i, [float(i % 2)] * 2) for i in range(60)], "g int, id long, v array<double>")
    sizes = p.groupBy("g").count().withColumnRenamed("count", "size")
    model = dict(fits.fit(p, "g", "id", "v", sizes, "kmeans", [3], 5, 20))[1]
    assert {tuple(c) for c in model["centroids"].round(9).tolist()} == {(0.0, 0.0), (1.0, 1.0)}
