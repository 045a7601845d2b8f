"""Tables that are kept by a key: their files follow the rows, not the number of keys."""

from pathlib import Path

from pyspark.sql import functions as F

from tidegraph.sources import stages


def _files(path):
    return list(Path(path).rglob("*.parquet"))


def test_projections_of_many_electrodes_take_few_files(spark, tmp_path):
    p = spark.range(0, 4_000, numPartitions=4).select((F.col("id") % 500).cast("int").alias("electrode"), F.col("id").alias("spike_time"), F.array(F.col("id") / 2).alias("pc"))
    path = str(tmp_path / "kept")
    stages.write_projections(p, path)
    assert len(_files(path)) <= 8
    assert {tuple(r) for r in stages.read_projections(spark, path).select("electrode", "spike_time").collect()} == {(i % 500, i) for i in range(4_000)}
    assert {r.spike_time for r in stages.read_projections(spark, path, 7).collect()} == set(range(7, 4_000, 500))
    assert stages.read_projections(spark, path, 501).collect() == []


def test_a_stage_of_many_electrodes_takes_few_files(spark, tmp_path):
    st = stages.Stages(spark, str(tmp_path))
    st.run("a", lambda: spark.range(0, 3_000, numPartitions=4).select((F.col("id") % 300).cast("int").alias("electrode"), "id"), partition_by="electrode")
    assert len(_files(st.path("a"))) <= 8
    assert {r.id for r in st.load("a", where=F.col("electrode") == 5).collect()} == set(range(5, 3_000, 300))
