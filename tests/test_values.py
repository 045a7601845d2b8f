"""Queries that SQL cannot say, and operators on images, edits and recordings, against plain computations."""

import itertools
import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidegraph.operators import detection, editing, images, linear
from tidegraph.operators.editing import Action
from tidegraph.plans import QUERIES
from tidegraph.plans.queries import LINK
from tidegraph.sources import recordings, settings, stages


@pytest.fixture(scope="module")
def vectors(small):
    d = pq.read_table(f"{small}/embeddings.parquet").to_pandas()
    return {int(i): (int(g), np.asarray(v, float)) for i, g, v in zip(d["vec_id"], d["label"], d["embedding"])}


def whole_spline(y, at):
    """Not-a-knot cubic spline by solving for all coefficients of all pieces at once."""
    n = len(y) - 1
    a, b, row = np.zeros((4 * n, 4 * n)), np.zeros(4 * n), 0

    def put(piece, t, order, sign=1.0):
        for k in range(order, 4):
            a[row, 4 * piece + k] += sign * math.perm(k, order) * t ** (k - order)

    for i in range(n):
        for t, v in ((0.0, y[i]), (1.0, y[i + 1])):
            put(i, t, 0)
            b[row], row = v, row + 1
    for i in range(n - 1):
        for order in (1, 2):
            put(i, 1.0, order)
            put(i + 1, 0.0, order, -1.0)
            row += 1
    for i in (0, n - 2):  # third derivatives agree behind the first and before the last piece
        put(i, 1.0, 3)
        put(i + 1, 0.0, 3, -1.0)
        row += 1
    c = np.linalg.solve(a, b).reshape(n, 4)
    piece = np.clip(np.floor(at).astype(int), 0, n - 1)
    t = at - piece
    return (c[piece] * t[:, None] ** np.arange(4)).sum(1)


def test_splines_of_many_rows():
    r = np.random.default_rng(0)
    y, at = r.normal(size=(5, 9)), r.uniform(0, 8, size=(5, 12))
    assert np.allclose(linear.spline(y, at), [whole_spline(v, t) for v, t in zip(y, at)])
    assert np.allclose(linear.spline(y[:, :3], np.array([0.5, 1.5])), [np.polyval(np.polyfit(range(3), v[:3], 2), [0.5, 1.5]) for v in y])


def test_aligned_waveforms(spark, small):
    e = pq.read_table(f"{small}/events.parquet").to_pandas().sort_values(["user_id", "ts", "event_id"])
    value = {u: d["value"].mean() - d["value"].to_numpy() for u, d in e.groupby("user_id")}
    got = QUERIES["aligned_waveforms"](spark, small).collect()
    found = {(r.electrode, r.spike_time) for r in QUERIES["spike_detect"](spark, small).collect()}
    assert {(r.electrode, r.spike_time) for r in got} == found
    for r in got[:40]:
        lo, hi = max(r.spike_time - 3, 0), min(r.spike_time + 3, len(value[r.electrode]) - 1)
        y, centre = value[r.electrode][lo : hi + 1], r.spike_time - lo
        steps = np.arange(centre - 1, centre + 1 + 1 / 32, 1 / 16)
        if len(y) >= 4:
            best = steps[whole_spline(y, steps).argmin()]
            assert r.wave == pytest.approx(list(whole_spline(y, np.clip(best + np.arange(-2, 3), 0, len(y) - 1))), abs=2e-6)


def test_top_eigenvalues_projections_and_whitening(spark, small, vectors):
    groups = {}
    for i, (g, v) in sorted(vectors.items()):
        groups.setdefault(g, []).append((i, v))
    top = {(r.electrode, r["rank"]): r.eigenvalue for r in QUERIES["eigenvalues_top5"](spark, small).collect()}
    white = {(r.electrode, r.i, r.j): r["cov"] for r in QUERIES["whitened_covariance"](spark, small).collect()}
    score = {}
    for r in QUERIES["pc_project"](spark, small).collect():
        score.setdefault((r.electrode, r["rank"]), {})[r.id] = r.score
    w, v = np.linalg.eigh(np.cov(np.stack([x for _, x in vectors.values()]).T))
    root = (v / np.sqrt(w)) @ v.T
    for g, rows in groups.items():
        x = np.stack([a for _, a in rows])
        c = np.cov(x.T)
        assert [top[g, k] for k in range(1, 6)] == pytest.approx(list(np.linalg.eigvalsh(c)[::-1][:5]), abs=2e-6)
        values, axes = np.linalg.eigh(c)
        for k in range(1, 6):
            own = np.array([score[g, k][i] for i, _ in rows])
            want = (x - x.mean(0)) @ axes[:, -k]
            assert np.allclose(own, want, atol=2e-6) or np.allclose(own, -want, atol=2e-6)
        m = root @ c @ root
        assert all(white[g, i, j] == pytest.approx(m[i, j], abs=2e-6) for i in range(64) for j in range(i, 64, 7))


def test_dendrogram_is_single_linkage(spark, small, vectors):
    got = {}
    for r in QUERIES["merge_dendrogram"](spark, small).collect():
        got.setdefault(r.electrode, []).append((r.step, r.threshold, r.left_ids, r.right_ids))
    want = {}
    for g in {i // 15 for i in vectors}:
        parts = [{i} for i in sorted(vectors) if i // 15 == g]
        gap = lambda a, b: min(((vectors[i][1] - vectors[j][1]) ** 2).sum() for i in a for j in b)
        while len(parts) > 1:
            d, a, b = min((gap(a, b), min(a), min(b)) for a, b in itertools.combinations(parts, 2))
            if d >= LINK:
                break
            a, b = (next(p for p in parts if m in p) for m in (a, b))
            x, y = sorted((a, b), key=min)
            say = lambda p: ",".join(map(str, sorted(p)))
            want.setdefault(g + 2, []).append((len(want.get(g + 2, [])) + 1, pytest.approx(d, abs=2e-6), say(x), say(y)))
            parts = [p for p in parts if p not in (a, b)] + [a | b]
    assert {g: sorted(x) for g, x in got.items()} == want


def test_block_order_cannot_be_bettered_by_one_exchange(spark, small, vectors):
    order = [r.electrode for r in sorted(QUERIES["block_diag_order"](spark, small).collect(), key=lambda r: r.place)]
    groups = {}
    for g, v in vectors.values():
        groups.setdefault(g, []).append(v)
    assert sorted(order) == sorted(groups)
    m = {g: np.mean(v, 0) for g, v in groups.items()}
    near = {(a, b): math.exp(-((m[a] - m[b]) ** 2).sum()) for a in m for b in m}
    cost = lambda o: sum(near[a, b] * abs(i - j) for i, a in enumerate(o) for j, b in enumerate(o))
    start, here = cost(sorted(groups)), cost(order)
    assert here <= start
    for i, j in itertools.combinations(range(len(order)), 2):
        o = list(order)
        o[i], o[j] = o[j], o[i]
        assert cost(o) >= here - 1e-9


def test_shrink_against_every_prefix(spark, small, vectors):
    got = {}
    for r in QUERIES["shrink_to_target"](spark, small).collect():
        got.setdefault(r.electrode, []).append((r.t, r.keep))
    groups = {}
    for i, (g, v) in sorted(vectors.items()):
        groups.setdefault(g, []).append((i * 13 % 997, v))
    for g, rows in groups.items():
        x, t = np.stack([v for _, v in rows]), np.array([a for a, _ in rows])
        fifth = np.sort(((x[:, None] - x[None]) ** 2).sum(2), 1)[:, 4]
        order = np.lexsort((t, fifth))[: int(0.8 * len(x))]
        low, high = 0, len(order)
        if editing.contamination_of(t[order], 1000.0) < 0.5:
            low = high
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if editing.contamination_of(t[order[:mid]], 1000.0) < 0.5 else (low, mid)
        assert sorted(got[g]) == sorted((int(a), i in set(order[:low].tolist())) for i, a in enumerate(t))


def test_clusterings_place_every_row(spark, small, vectors):
    for name, k in (("spectral_forced_k", 3), ("kmeans_labels", 3), ("spectral_labels", None), ("gmm_bic", None)):
        rows = QUERIES[name](spark, small).collect()
        assert {r.id for r in rows} == set(vectors) and len(rows) == len(vectors)
        for g in {r.electrode for r in rows}:
            own = [r for r in rows if r.electrode == g]
            assert len({r.k for r in own}) == 1 and all(0 <= r.clust <= r.k for r in own) and (k is None or own[0].k == k)
    for g in {g for g, _ in vectors.values()}:  # k-means: every row is nearest to its own cluster's mean
        own = [(vectors[r.id][1], r.clust) for r in QUERIES["kmeans_labels"](spark, small).where(F.col("electrode") == g).collect()]
        c = {k: np.mean([v for v, x in own if x == k], 0) for k in {x for _, x in own}}
        assert np.mean([min(c, key=lambda k: ((v - c[k]) ** 2).sum()) == x for v, x in own]) > 0.97


def test_realigned_images(spark, small, vectors):
    rows = QUERIES["realigned_images"](spark, small).collect()
    assert len(rows) == len(vectors)
    for r in rows[:25]:
        y = vectors[r.neuron_id][1]
        steps = np.arange(17, 43 + 0.05, 0.1)
        moved = whole_spline(y, steps).argmin() * 0.1
        assert r.wave == pytest.approx(list(whole_spline(y, np.arange(38) + moved)), abs=2e-6)


def test_realignment_brings_the_lowest_point_to_one_place(spark):
    wave = lambda at: [-math.exp(-((i - at) ** 2) / 8) for i in range(81)]
    d = spark.createDataFrame([(1, 2, wave(25.0)), (2, 2, wave(30.3)), (3, 2, [0.0] * 20)], "neuron_id int, electrode int, wave array<double>")
    got = {r.neuron_id: r.wave for r in images.realigned(d).collect()}
    assert len(got[1]) == 55 and np.argmin(got[1]) == np.argmin(got[2]) == 17 and np.allclose(got[1], got[2], atol=1e-3) and got[3] is None


def test_edits_that_write_trains(spark):
    rows = spark.createDataFrame([(i, 10 * i + j) for i in (1, 2, 3, 16) for j in range(5)], "neuron_id int, spike_time long")
    trains = spark.createDataFrame([(1, 1, 10), (1, 1, 11), (1, 4, 12), (3, 2, 20), (3, 5, 21), (3, 5, 30)], "seq int, neuron_id int, spike_time long")
    actions = [Action("SHRINK", [1], frac=0.5, contam=0.1, new_ids=[4]), Action("DELETE", [16]), Action("RECLUSTER", [2, 3], n_clusters=0, config_tag="", new_ids=[2, 5])]
    out = sorted((r.neuron_id, r.spike_time) for r in editing.replay(rows, actions, trains).collect())
    assert out == [(1, 10), (1, 11), (2, 20), (5, 21), (5, 30)]
    again = [*actions, Action("KEEP", [16]), Action("MERGE", [1, 5])]
    out = sorted((r.neuron_id, r.spike_time) for r in editing.replay(rows, again, trains).collect())
    assert out == [(1, 10), (1, 11), (1, 21), (1, 30), (2, 20), *[(16, 160 + j) for j in range(5)]]
    with pytest.raises(ValueError):
        editing.replay(rows, [*actions, Action("DELETE", [3])], trains)
    Action("RECLUSTER", [1], n_clusters=0, config_tag="x").check()  # 0 clusters: the automatic choice


def test_store(spark, tmp_path):
    rows = spark.createDataFrame([(i, 10 * i + j) for i in (1, 2, 3) for j in range(i)], "neuron_id int, spike_time long")
    s = editing.Store(spark, str(tmp_path / "edits"))
    assert s.neurons() is None and s.log().count() == 0 and s.consolidate(rows).count() == 6
    s.add(Action("MERGE", [1, 2]))
    s.add(Action("DELETE", [3]))
    assert s.undo().action == "DELETE"
    s.save()
    assert {r.neuron_id for r in s.consolidate(rows).collect()} == {2, 3}
    s = editing.Store(spark, str(tmp_path / "edits"))  # another session
    assert [a.action for a in s.actions()] == ["MERGE", "CONSOLIDATE"] and s.of_electrode(2).count() == 1 and s.of_electrode(3).count() == 0
    with pytest.raises(ValueError):
        s.add(Action("MERGE", [3]))
    s.add(Action("DELETE", [3]))
    s.clear_session()
    assert s.consolidate(rows).count() == 6
    s.add(Action("DELETE", [3]))
    s.save()
    assert {r.neuron_id for r in s.consolidate(rows).collect()} == {2}
    s.clear_hard()
    s.save()
    assert s.log().count() == 0 and s.neurons() is None


def test_preview(spark):
    times = [(2, n, 100 * n + 7 * i) for n in (1, 2, 3) for i in range(8)]
    t = spark.createDataFrame(times, "electrode int, neuron_id int, spike_time long")
    p = spark.createDataFrame([(2, s, [float(s % 5), 1.0]) for _, _, s in times], "electrode int, spike_time long, pc array<double>")
    view = editing.Preview(t, p, 2, 1e5)
    view.apply(Action("SHRINK", [1], frac=0.5, contam=1e9))
    assert {r.neuron_id: (r.n, r.status) for r in view.report().collect()} == {1: (4, 0), 2: (8, 0), 3: (8, 0), 4: (4, -2)}
    view.undo()
    view.apply(Action("KEEP", [2]))
    view.apply(Action("RECLUSTER", [2, 3], n_clusters=3, config_tag=""), lambda e: e.withColumn("clust", (F.col("spike_time") % 3 + 1).cast("int")))
    assert {r.neuron_id for r in view.report().collect()} == {1, 2, 3, 4} and view.events.count() == 24
    with pytest.raises(ValueError):
        view.apply(Action("RECLUSTER", [1], n_clusters=15, config_tag=""), lambda e: e.withColumn("clust", F.lit(15)))
    with pytest.raises(ValueError):
        view.apply(Action("DELETE", [9]))


def test_short_channels_raise(spark):
    s = spark.createDataFrame([(2, i, 1.0) for i in range(5)] + [(3, i, 1.0) for i in range(3)], "electrode int, sample long, value double")
    with pytest.raises(Exception, match="a channel has 3 samples"):
        detection.first_mean(s, 5).collect()
    assert [r.electrode for r in detection.first_mean(s, 5, short="drop").collect()] == [2]


def test_recording(spark, tmp_path):
    s = spark.createDataFrame([("a", e, i, float(100 * e + i)) for e in (1, 2, 3) for i in range(100)] + [("b", 1, 0, 0.0)], "dataset string, electrode int, sample long, value double")
    recordings.write_recording(s, str(tmp_path), 10, (3,), size=16)
    r = recordings.Recording(spark, str(tmp_path), "a(2-5.5)")
    assert (r.start, r.stop, r.n_electrodes, r.disconnected) == (20, 55, 3, [3])
    assert r.scan().count() == 3 * 35 and r.scan(connected=True).count() == 70
    assert [x.sample for x in r.scan(50, 20).where("electrode = 1").orderBy("sample").collect()] == list(range(50, 55))
    with pytest.raises(ValueError):
        recordings.Recording(spark, str(tmp_path), "c")


def test_settings_files(spark, tmp_path):
    (tmp_path / "cfg").mkdir()
    (tmp_path / "cfg" / "LIST").write_text("%\n" * 6 + "A::./cfg/one::few\nB::" + str(tmp_path / "cfg" / "two") + "::bad\n")
    (tmp_path / "cfg" / "one").write_text("% note\n\nspikesForLaplacian = 1000\nwhitening = false % off\nqualityTol = 0.02\nparamsnThreads = 3\n")
    (tmp_path / "cfg" / "two").write_text("nothing = 1\n")
    got = settings.load_settings(spark, str(tmp_path / "cfg" / "LIST"), "A")
    assert (got.landmarks, got.whitening, got.quality_tolerance) == (1000, False, 0.02)
    assert settings.load_settings(spark, str(tmp_path / "cfg" / "LIST")) == settings.settings()
    for tag in ("B", "C"):
        with pytest.raises(ValueError):
            settings.load_settings(spark, str(tmp_path / "cfg" / "LIST"), tag)


def test_labels_are_rewritten_only_beside_one_file(spark, tmp_path):
    n = spark.createDataFrame([(1, "ON"), (2, "")], "neuron_id int, label string")
    assert stages.rewrite_labels(spark, n, str(tmp_path)) is None
    spark.createDataFrame([("1 All/x",)], "value string").write.text(str(tmp_path / "run.classification"))
    path = stages.rewrite_labels(spark, n, str(tmp_path))
    assert [r.value for r in spark.read.text(path).collect()] == ["1 All/ON"]
    spark.createDataFrame([("1 All/x",)], "value string").write.text(str(tmp_path / "other.classification"))
    assert stages.rewrite_labels(spark, n, str(tmp_path)) is None


def test_union_of_neighbourhoods_is_kept_in_order(spark):
    near = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (2, 1), (2, 3), (3, 3), (3, 2)], "electrode int, neighbor int")
    got = {(r.e1, r.e2): r.electrodes for r in images.electrode_pairs(near).collect()}
    assert got == {(1, 2): [1, 2, 3], (1, 3): [1, 2, 3], (2, 3): [1, 2, 3]}
    got = {(r.e1, r.e2): r.electrodes for r in images.electrode_pairs(near, "intersection", True).collect()}
    assert got == {(1, 2): [1, 2], (2, 3): [2, 3]}
