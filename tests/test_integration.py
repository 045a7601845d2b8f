"""A planted recording through the detector; stage tables and text formats; queries against SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidegraph.operators import detection, linear
from tidegraph.plans import QUERIES, SQL
from tidegraph.sources import recordings, stages

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_planted_units_are_found(spark, tmp_path):
    s = recordings.synthetic(spark, 6, 20_000, [(3, 50, 611), (5, 90, 937)])
    blocks = recordings.to_blocks(s, 4096)
    blocks.write.parquet(str(tmp_path / "blocks"))
    raw = recordings.scan(spark.read.parquet(str(tmp_path / "blocks")), size=4096).drop("dataset")
    assert raw.count() == 120_000
    some = recordings.scan(spark.read.parquet(str(tmp_path / "blocks")), 4_000, 4_200, size=4096)
    assert some.count() == 6 * 200
    body = raw.where("electrode > 1")
    flat = detection.remove_drift(body, detection.first_mean(body, 2_000), 0.005).select("electrode", "sample", F.col("filtered").alias("value"))
    noise = detection.noise_floor(flat.where("sample between 2000 and 4000").select("electrode", F.round("value", 2).alias("value")))
    found = detection.detect(flat, detection.thresholds(noise, 5.0)).where("amplitude > 120")
    times = {(r.electrode, r.spike_time) for r in found.collect()}
    for electrode, first, period in ((3, 50, 611), (5, 90, 937)):
        planted = range(first + 4, 20_000, period)
        hit = sum(any((electrode, t + d) in times for d in (-1, 0, 1)) for t in planted)
        assert hit >= 0.95 * len(planted)
    edges = detection.trigger_edges(raw.where("electrode = 1"))
    assert edges.count() == 10 and stages.export_triggers(edges.limit(0)).collect()[0].sample == 0
    w = linear.windows(found.where("electrode = 3").limit(5), flat, recordings.linear_adjacency(spark, 6, 1), 4, 4)
    waves = linear.aligned_waveforms(w, 2, 2).collect()
    assert len(waves) == 5 and all(len(r.wave) == 15 for r in waves)


def test_stages(spark, tmp_path):
    made = []
    st = stages.Stages(spark, str(tmp_path))
    make = lambda: made.append(1) or spark.createDataFrame([(2, 1.0), (3, 2.0)], "electrode int, x double")
    assert st.run("a", make, requested=False) is None
    st.run("a", make, partition_by="electrode")
    st.run("a", make)
    st.run("a", make, force=True)
    assert len(made) == 2 and st.load("a", "x", where=F.col("electrode") == 3).collect()[0].x == 2.0
    assert st.find("a") and st.find("none*") is None
    st.run("b", make)
    with pytest.raises(ValueError):
        st.find("*")


def test_text_formats(spark, tmp_path):
    noise = spark.createDataFrame([(3, 2.5), (1, 7.0), (2, 1.5)], "electrode int, sigma double")
    stages.write_noise(noise, str(tmp_path / "noise"))
    assert [r.sigma for r in stages.read_noise(spark, str(tmp_path / "noise"), 3).orderBy("electrode").collect()] == [0.0, 1.5, 2.5]
    with pytest.raises(ValueError):
        stages.read_noise(spark, str(tmp_path / "noise"), 4)
    n = spark.createDataFrame([(1, "ON"), (2, ""), (3, None)], "neuron_id int, label string")
    lines = stages.format_labels(n)
    assert [tuple(r) for r in stages.parse_labels(lines).collect()] == [(1, "ON")]
    stages.copy_selected(n, n.limit(2), str(tmp_path / "copy"))
    with pytest.raises(Exception):
        stages.copy_selected(n, n, str(tmp_path / "copy"))
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 2
    m = spark.createDataFrame([(2, 1, [0.0, 0.0], [1.0, 1.0], 0.5), (2, 2, [5.0, 5.0], [1.0, 1.0], 0.5)], "electrode int, clust int, centroid array<double>, variance array<double>, mix_frac double")
    p = spark.createDataFrame([(2, 10, [0.1, 0.2]), (2, 11, [4.9, 5.5])], "electrode int, spike_time long, pc array<double>")
    assert {r.spike_time: r.clust for r in stages.nearest_model(p, m).collect()} == {10: 1, 11: 2}


def _rows(rows, names):
    one = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(one(r[n]) for n in names) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, name):
    got = QUERIES[name](spark, small)
    rows = [r.asDict() for r in got.collect()]
    if name not in SQL:  # their values are tested in test_values, test_whole_vectors and test_clustering
        assert got.columns and rows
        return
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{small}/{t}.parquet'")
    rel = con.sql(SQL[name])
    names = sorted(rel.columns)
    assert sorted(got.columns) == names
    assert _rows(rows, names) == _rows([dict(zip(rel.columns, r)) for r in rel.fetchall()], names)


def test_entry(spark):
    assert entry.entry(spark).columns == ["electrode", "spike_time", "width", "amplitude"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
