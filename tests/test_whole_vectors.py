"""Queries over embeddings take every component of a vector: against numpy on the small tables."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidegraph.plans import QUERIES
from tidegraph.plans.queries import BASIS

near = lambda want: pytest.approx(want, abs=2e-6)


@pytest.fixture(scope="module")
def vectors(small):
    d = pq.read_table(f"{small}/embeddings.parquet").to_pandas()
    assert {len(v) for v in d["embedding"]} == {64}
    return {int(i): (int(g), np.asarray(v, float)) for i, g, v in zip(d["vec_id"], d["label"], d["embedding"])}


@pytest.fixture(scope="module")
def groups(vectors):
    out = {}
    for i, (g, v) in sorted(vectors.items()):
        out.setdefault(g, ([], []))
        out[g][0].append(i)
        out[g][1].append(v)
    return {g: (np.array(i), np.stack(v)) for g, (i, v) in out.items()}


def collect(spark, small, name):
    return QUERIES[name](spark, small).collect()


def test_l2_normalize(spark, small, vectors):
    got = {(r.id, r.i): r.x for r in collect(spark, small, "l2_normalize")}
    assert got == near({(i, j): x for i, (_, v) in vectors.items() for j, x in enumerate(v / np.linalg.norm(v))})


def test_means_and_covariances(spark, small, groups):
    assert {(r.electrode, r.i): r["mean"] for r in collect(spark, small, "mean_waveform")} == near({(g, i): m for g, (_, v) in groups.items() for i, m in enumerate(v.mean(0))})
    upper = [(i, j) for i in range(64) for j in range(i, 64)]
    got = {(r.electrode, r.i, r.j): r.cov for r in collect(spark, small, "covariance_longform") if r.cov is not None}
    assert got == near({(g, i, j): np.cov(v.T)[i, j] for g, (_, v) in groups.items() if len(v) > 1 for i, j in upper})
    merged = {(r.electrode, r.i, r.j) for r in collect(spark, small, "covariance_merge")}
    assert merged == {(g, i, j) for g in groups for i, j in upper}
    assert {(r.i, r.j) for r in collect(spark, small, "whitened_covariance")} == set(upper)


def test_axes_and_scores(spark, small, groups):
    values = {}
    for r in collect(spark, small, "eigenvalues_top5"):
        values.setdefault(r.electrode, {})[r["rank"]] = r.eigenvalue
    for g, (_, v) in groups.items():
        if len(v) > 1:
            w = np.linalg.eigvalsh(np.cov(v.T))[::-1][:5]
            assert [values[g][k] for k in range(1, 6)] == near(list(w))
    spread = {}
    for r in collect(spark, small, "pc_project"):
        spread.setdefault((r.electrode, r["rank"]), []).append(r.score)
    for (g, k), s in spread.items():
        if len(s) > 1:
            assert np.var(s, ddof=1) == pytest.approx(values[g][k], abs=1e-5)
    want = {(int(i), k): float((x - v.mean(0)) @ np.resize(a, 64)) for ids, v in groups.values() for i, x in zip(ids, v) for k, a in BASIS}
    assert {(r.id, r["rank"]): r.score for r in collect(spark, small, "pc_project_fixed_basis")} == near(want)


def test_neighbour_distances(spark, small, vectors):
    got = {(r.id_a, r.id_b): r.d2 for r in collect(spark, small, "neighbor_pairs_l2")}
    want = {(a, b): ((v - w) ** 2).sum() for a, (g, v) in vectors.items() for b, (h, w) in vectors.items() if b // 15 == a // 15 + 1}  # electrodes by the codec of ids
    assert got == near(want)


def test_cluster_stats_and_images(spark, small, groups):
    got = {(r.electrode, r.clust, r.i): (r.centroid, r.variance) for r in collect(spark, small, "cluster_stats")}
    want = {(g, c, i): (v[ids % 3 == c].mean(0)[i], v[ids % 3 == c].var(0)[i]) for g, (ids, v) in groups.items() for c in range(3) if (ids % 3 == c).any() for i in range(64)}
    assert got.keys() == want.keys() and all(got[k] == near(want[k]) for k in want)
    assert {(r.electrode, r.clust): r.dims for r in collect(spark, small, "export_models") if r.electrode in groups} == {(g, c + 1): 64 for g, (ids, _) in groups.items() for c in range(2) if (ids % 2 == c).any()}
    n = pq.read_table(f"{small}/orders.parquet", columns=["o_custkey"]).to_pandas()["o_custkey"].value_counts()
    want = {}
    for g, (ids, v) in groups.items():
        w = np.array([n.get(i + 1, 0) for i in ids], float)
        if w.sum():
            want |= {(g, i): x for i, x in enumerate(w @ v / w.sum())}
    assert {(r.electrode, r.i): r.x for r in collect(spark, small, "compound_ei")} == near(want)


def test_labels_beyond_the_fourteenth(spark, tmp_path):
    r = np.random.default_rng(1)
    rows = [(i, [float(a) for a in r.normal(size=64)], i % 20) for i in range(80)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert sorted((x.place, x.electrode) for x in collect(spark, str(tmp_path), "block_diag_order"))[-1][0] == 19
    assert {x.electrode for x in collect(spark, str(tmp_path), "block_diag_order")} == set(range(20))
    assert {x.electrode for x in collect(spark, str(tmp_path), "export_models") if x.dims == 64} == set(range(20))
