"""Small cases whose results follow from the rules by hand."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegraph.functions import cluster_of, electrode_of, neuron_id
from tidegraph.operators import clustering, compare, detection, editing, graph, linear, reports
from tidegraph.operators.editing import Action, State
from tidegraph.sources import recordings, settings
from tidegraph.streaming import scan_state
from tidegraph.streaming.detector import EMPTY


def channel(spark, values, electrode=2):
    return spark.createDataFrame([(electrode, i, float(v)) for i, v in enumerate(values)], "electrode int, sample long, value double")


def limit(spark, t, electrode=2):
    return spark.createDataFrame([(electrode, float(t))], "electrode int, threshold double")


DETECT = [0, 0, -5, -9, -6, 0, 0, -7, 0, 0, 0, 0, 0, 0, -8, -8, 0, 0, 0, 0, -6, -6, -6, -6, -6, -6, 0]


def test_noise_floor():
    assert detection.converged_noise([1, -1] * 20)[:2] == (pytest.approx(1.0063092108532552), 0)
    assert detection.converged_noise([1, -1] * 20)[2:] == (2, 80)
    sigma, mu, rounds, n = detection.converged_noise([1, -1] * 20 + [50])
    assert (sigma, mu, rounds, n) == (pytest.approx(1.5355642714396198), pytest.approx(0.027159152634437807), 46, 1841)


def test_noise_floor_frames_agree(spark):
    s = channel(spark, [1, -1] * 20 + [50])
    assert detection.noise_floor(s).collect()[0].sigma == pytest.approx(1.5355642714396198)
    assert detection.noise_rounds(s, 4).collect()[0].sigma == pytest.approx(detection.converged_noise([1, -1] * 20 + [50], tolerance=0, most=4)[0])


@pytest.mark.parametrize("start,want", [(0.0, [5, 2.5, 1.25, -4.375]), (10.0, [0, 0, 0, -5]), (-10.0, [10, 5, 2.5, -3.75])])
def test_drift(spark, start, want):
    s, m = channel(spark, [10, 10, 10, 0]), spark.createDataFrame([(2, start)], "electrode int, start_mean double")
    got = [r.filtered for r in detection.remove_drift(s, m, 0.5).orderBy("sample").collect()]
    assert got == pytest.approx(want)


def test_drift_blocks_do_not_show(spark):
    r = np.random.default_rng(0)
    x = r.normal(size=3000).cumsum()
    s, m, want = channel(spark, x), 1.5, []
    for v in x:
        m = 0.98 * m + 0.02 * v
        want.append(v - m)
    got = detection.remove_drift(s, spark.createDataFrame([(2, 1.5)], "electrode int, start_mean double"), 0.02, block=64).orderBy("sample")
    assert np.allclose([r.filtered for r in got.collect()], want, atol=1e-9)


def test_detection(spark):
    found = detection.candidates(channel(spark, DETECT), limit(spark, 4)).orderBy("up").collect()
    assert [(r.up, r.down, r.width, r.spike_time, r.amplitude) for r in found] == [(2, 5, 3, 3, 9), (7, 8, 1, 7, 7), (14, 16, 2, 14, 8), (20, 26, 6, 20, 6)]
    kept = detection.detect(channel(spark, DETECT), limit(spark, 4), 5, 5).orderBy("spike_time").collect()
    assert [r.spike_time for r in kept] == [3, 14]


def test_gap_counts_candidates(spark):
    c = spark.createDataFrame([(2, t, 1, 5.0) for t in (3, 7, 11)], "electrode int, spike_time long, width long, amplitude double")
    assert [r.spike_time for r in detection.keep_rule(c, 5, 5).where("kept").collect()] == [3]


def test_threshold_is_strict(spark):
    assert detection.crossings(channel(spark, [0, -4, 0]), limit(spark, 4)).count() == 0


@pytest.mark.parametrize("cut", [1, 2, 3, 5, 27])
def test_stream_step_equals_batch(cut):
    state, found = EMPTY, []
    rows = list(enumerate(map(float, DETECT)))
    for at in range(0, len(rows), cut):
        state, new = scan_state(state, rows[at : at + cut], 4, 5, 5)
        found += new
    assert found == [(3, 3, 9), (14, 2, 8)]


def test_stream(spark, tmp_path):
    from tidegraph.streaming import detect_stream

    rows = channel(spark, DETECT).withColumn("threshold", F.lit(4.0))
    for i in range(3):
        rows.where((F.col("sample") >= 9 * i) & (F.col("sample") < 9 * i + 9)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(str(tmp_path / "in"))
    q = detect_stream(s, max_width=5, min_gap=5).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.spike_time for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [3, 14]


def test_ring_of_samples():
    from tidegraph.streaming import push

    rows = [(i, float(i), i in (1, 4, 5, 11)) for i in range(13)]
    for cut in (1, 4, 13):
        state, found = ((), (), ()), []
        for at in range(0, 13, cut):
            state, new = push(state, rows[at : at + cut], 2, 3)
            found += new
            assert len(state[0]) <= 6
        assert found == [(4, [2.0, 3.0, 4.0, 5.0, 6.0, 7.0]), (5, [3.0, 4.0, 5.0, 6.0, 7.0, 8.0])]


def test_codec(spark):
    d = spark.createDataFrame([(2, 1, 1), (2, 15, 15), (3, 1, 16)], "e int, c int, n int")
    for r in d.select("*", neuron_id(F.col("e"), F.col("c")).alias("id"), electrode_of(F.col("n")).alias("be"), cluster_of(F.col("n")).alias("bc")).collect():
        assert (r.id, r.be, r.bc) == (r.n, r.e, r.c)


def test_components(spark):
    p = spark.createDataFrame([(1, i + 1, [float(x)]) for i, x in enumerate([0, 0.2, 0.4, 2, 2])], "g int, id long, v array<double>")
    e = graph.edges(graph.distances(p, "g", "id", "v"), 0.1)
    assert {r.id: r.component for r in graph.components(p, e, "g", "id").collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}
    steps = graph.dendrogram(p, e, "g", "id").orderBy("step").collect()
    assert [(r.left, r.right) for r in steps] == [([1], [2]), ([1, 2], [3])]
    assert graph.edges(graph.distances(p, "g", "id", "v"), 0.1, link_identical=True).count() == 3


def test_merge_tree():
    t = graph.MergeTree([1, 2, 3, 4], [(0.5, 3, 4), (0.1, 1, 2), (0.9, 2, 3)])
    assert t.thresholds() == [0.1, 0.5, 0.9] and t.forest() == [[1, 2, 3, 4]] and t.depth() == 2
    assert t.cut(0.5) == [[1, 2], [3], [4]] and t.cut(1) == [[1, 2, 3, 4]]


def test_rectangles():
    t = graph.MergeTree([1, 2, 3, 4, 5], [(0.5, 3, 4), (0.1, 1, 2), (0.9, 2, 3)])
    assert t.rectangles() == [(0.9, 1.9, 0, 4), (0.1, 0.9, 0, 2), (0.0, 0.1, 0, 1), (0.0, 0.1, 1, 2), (0.5, 0.9, 2, 4), (0.0, 0.5, 2, 3), (0.0, 0.5, 3, 4), (0.0, 1.0, 4, 5)]


def test_chains(spark):
    got = graph.shorten_chains(spark.createDataFrame([(1, 2), (2, 3), (3, 4)], "master_id int, loser_id int")).collect()
    assert sorted(map(tuple, got)) == [(1, 2), (1, 3), (1, 4)]


def test_alignment_quality():
    assert clustering.alignment_quality(np.eye(2)) == 1
    assert clustering.alignment_quality(np.array([[1.0, 1.0], [1.0, -1.0]]) / np.sqrt(2)) == pytest.approx(0.5)


def test_comparator(spark):
    kind = "electrode int, neuron_id int, spike_time long"
    rows = lambda trains: spark.createDataFrame([(2, i, t) for i, ts in enumerate(trains) for t in ts], kind)
    ref, other = rows([[1, 2, 3, 4], [10, 20]]), rows([[1, 2, 3], [4, 10], [20]])
    assert compare.score(ref, other).collect()[0].score == pytest.approx(0.625)
    assert compare.score(ref, ref).collect()[0].score == pytest.approx(1)
    twice = compare.intersections(rows([[5, 5, 6]]), rows([[5, 6, 6]])).collect()
    assert twice[0].common == 2


def test_assignment_matches_enumeration():
    import itertools

    r = np.random.default_rng(3)
    for n, m in [(1, 1), (2, 4), (4, 2), (5, 5), (3, 6)]:
        v = r.random((n, m))
        small, big = min(n, m), max(n, m)
        w = v if n <= m else v.T
        assert compare.best_assignment(v) == pytest.approx(max(sum(w[i, p[i]] for i in range(small)) for p in itertools.permutations(range(big), small)))


def test_pools():
    assert [(p.start, p.stop - 1) for p in reports.pools(10, 4)] == [(1, 3), (4, 5), (6, 8), (9, 10)]


def test_stride(spark):
    four = spark.createDataFrame([(1, t) for t in range(4)], "neuron_id int, spike_time long")
    assert reports.stride_sample(four, 10).count() == 4
    twelve = spark.createDataFrame([(1, t) for t in range(12)], "neuron_id int, spike_time long")
    assert sorted(r.spike_time for r in reports.stride_sample(twelve, 4).collect()) == [0, 3, 6, 9]  # the very first one too
    later = twelve.unionByName(twelve.selectExpr("2 AS neuron_id", "spike_time + 1 AS spike_time"))
    assert sorted(r.spike_time for r in reports.stride_sample(later, 4).where("neuron_id = 2").collect()) == [4, 7, 10]


def test_covariance(spark):
    w = spark.createDataFrame([(2, [1.0, 2.0]), (2, [3.0, 4.0]), (2, [5.0, 9.0])], "electrode int, wave array<double>")
    m = linear.moments(w, "electrode", "wave")
    assert {(r.i, r.j): r.cov for r in linear.covariance(m, "electrode").collect()} == {(0, 0): 4, (0, 1): 7, (1, 1): 13}
    assert {r.i: r["mean"] for r in linear.mean_wave(w, "electrode", "wave").collect()} == {0: 3, 1: 5}
    p = spark.createDataFrame([(2, 2, 1.0), (2, 6, 3.0)], "electrode int, n long, mean double")
    assert linear.pooled(p, "electrode", "mean").collect()[0]["mean"] == 2.5


def test_eigen_and_whitening():
    r = np.random.default_rng(0)
    a = r.normal(size=(200, 6))
    c = np.cov(a.T)
    w, v = linear.principal_axes(c, 6)
    assert np.allclose(v * w @ v.T, c) and (v[np.abs(v).argmax(0), range(6)] > 0).all()
    assert np.allclose(linear.whiten(c, c), np.eye(6))
    assert np.allclose(linear.whiten(c, np.zeros((6, 6))), c)
    c[0] = c[:, 0] = 0
    assert np.allclose(linear.whiten(c, np.eye(6))[0], 0)


def test_spline():
    t = np.arange(12.0)
    y = 2 - t + 0.3 * t**2 - 0.02 * t**3
    at = np.linspace(0, 11, 100)
    assert np.allclose(linear.spline(y, at), 2 - at + 0.3 * at**2 - 0.02 * at**3)
    wave = -np.exp(-((np.arange(21) - 10.3) ** 2) / 8)[None]
    out = linear.align(wave, 10, 1, 1 / 16, 5, 5)
    assert abs(out[0].argmin() - 5) < 1e-9 and out[0, 5] == pytest.approx(-1, abs=1e-3)


def test_split(spark):
    lengths = spark.createDataFrame([("a", 1, 100), ("b", 2, 50), ("c", 3, 80)], "dataset string, ord int, length long")
    e = spark.createDataFrame([(1, t) for t in (0, 99, 100, 149, 150, 229, 230)], "neuron_id int, spike_time long")
    got = reports.split_by_interval(e, lengths)
    assert sorted((r.dataset, r.spike_time) for r in got.collect()) == [("a", 0), ("a", 99), ("b", 0), ("b", 49), ("c", 0), ("c", 79)]
    assert sorted(r.spike_time for r in reports.concat_with_offsets(got, lengths).collect()) == [0, 99, 100, 149, 150, 229]


def test_auto_replay():
    counts = {1: 5, 2: 3, 3: 9, 16: 2, 17: 8}
    s = editing.apply_auto(State(dict(counts), {16}), [Action("AUTO_RM", [2, 16]), Action("AUTO_MERGE", [1], 3), Action("AUTO_RM_DUP", [17], 3)])
    assert s.counts == {3: 14, 16: 2}
    s = editing.apply_auto(State(dict(counts), {3}), [Action("AUTO_MERGE", [1, 2], 3)])
    assert s.counts == {1: 8, 3: 9, 16: 2, 17: 8}
    assert editing.dry_run(counts, [Action("AUTO_MERGE", [1], 3), Action("AUTO_RM_DUP", [3], 17)])[1] == (2, 17)


def test_manual_replay(spark):
    s = editing.apply_manual(State({1: 5, 2: 3}), [Action("MERGE", [1, 2])])
    assert s.counts == {1: 8} and s.labels[1].startswith("Edited/") and not s.elevated
    with pytest.raises(ValueError):
        editing.apply_manual(s, [Action("MERGE", [1, 2])])
    events = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "neuron_id int, spike_time long")
    assert sorted(r.neuron_id for r in editing.remap(events, s).collect()) == [1, 1, 3]


def test_log():
    log = editing.Log([Action("KEEP", [1]), Action("CONSOLIDATE")])
    log.add(Action("MERGE", [1, 2]))
    log.add(Action("CONSOLIDATE"))
    log.add(Action("DELETE", [3]))
    assert [a.action for a in log.pending()] == ["DELETE"] and log.undo().action == "DELETE" and log.pending() == []
    assert [a.action for a in editing.Log([Action("KEEP", [1])]).pending()] == ["KEEP"]
    for bad in (Action("MERGE", [1]), Action("NO"), Action("SHRINK", [1], frac=2.0, contam=1.0), Action("RECLUSTER", [1], n_clusters=16, config_tag="x")):
        with pytest.raises(ValueError):
            log.add(bad)


def test_contamination(spark):
    e = spark.createDataFrame([(1, t) for t in (0, 10, 100, 120, 1000)], "neuron_id int, spike_time long")
    assert reports.contamination(e, 30, 2000.0).collect()[0].contamination == pytest.approx(16 / 3)
    assert editing.contamination_of(np.array([0, 10, 100, 120, 1000]), 2000) == pytest.approx(16 / 3)
    d = spark.createDataFrame([([0, 10, 100, 120, 1000],), ([5],)], "t array<long>").select(editing.contamination(F.col("t"), 2000).alias("c"))
    assert [r.c for r in d.collect()] == [pytest.approx(16 / 3), 0]


def test_noise_events(spark):
    spans = spark.createDataFrame([(2, 0, 36_000)], "electrode int, first long, span long")
    n = detection.random_events(spans, 10 / 36, seed=1)
    assert n.count() == 10_000 and n.distinct().count() == 10_000


def test_smoothing(spark):
    d = spark.createDataFrame([(1, i, 8.0 if i == 0 else 0.0) for i in range(10)], "k int, i int, x double")
    assert [r.smooth for r in reports.smoothed(d, "k", "i", "x").orderBy("i").collect()] == [1.0] * 8 + [0.0] * 2


def test_dataset_strings(spark):
    a = recordings.parse_datasets("x(10-20)+y(5-);z(-7.5)+w")
    assert [(r.path, r.start, r.stop) for r in a] == [("x", 10, 20), ("y", 5, None), ("z", 0, 7.5), ("w", 0, None)]
    assert a[0].bounds(20_000, 300_000) == (200_000, 300_000)
    with pytest.raises(ValueError):
        recordings.parse_datasets("x(-)")


def test_settings():
    assert settings.settings("LIGHT_CLUST").landmarks == 1_000 and settings.settings().landmarks == 2_500
    assert settings.parse_overrides(["% note", "", "landmarks = 7; % few", "whitening = true"]) == {"landmarks": 7, "whitening": True}
    for bad in (["landmarks"], ["unknown = 3"], ["__import__('os') = 1"]):
        with pytest.raises(ValueError):
            settings.parse_overrides(bad)
    assert settings.parse_registry(["h"] * 6 + ["T::a/b::what\n"]) == {"T": ("a/b", "what")}
    with pytest.raises(ValueError):
        settings.settings("none")


def test_planted_clusters(spark):
    r = np.random.default_rng(2)
    rows = [(g, 1000 * g + i, [float(x) for x in r.normal(size=3) * 0.3 + 4 * np.eye(3)[i % 3]]) for g in (1, 2) for i in range(240)]
    rows += [(3, 9000 + i, [0.0, 0.0, float(i)]) for i in range(5)]
    p = spark.createDataFrame(rows, "g int, id long, v array<double>")
    for method, k in (("spectral", None), ("kmeans", 3), ("gmm", None)):
        out = clustering.cluster(p, "g", "id", "v", method, k=k, most=6, landmarks=150).collect()
        for g in (1, 2):
            own = [(x.id % 1000 % 3, x.clust) for x in out if x.g == g]
            n = len({c for _, c in own})  # the automatic choice takes the largest k that is nearly as good
            assert len(set(own)) == n and (n == 3 or method == "spectral" and n <= 5), method
        assert all(x.clust == 0 for x in out if x.g == 3)


def test_shrink(spark):
    r = np.random.default_rng(2)
    rows = [(1, 40 * i if i < 80 else 40 * (i - 80) + 5, [float(x) for x in r.normal(size=2) * (1 if i < 80 else 9)]) for i in range(120)]
    out = editing.shrink(spark.createDataFrame(rows, "k int, t long, v array<double>"), "k", "t", "v", 0.9, 0.02, 3200.0).collect()
    keep = np.array([x.t for x in out if x.keep])
    assert len(out) == 120 and 20 < len(keep) <= 108 and editing.contamination_of(keep, 3200) < 0.02
