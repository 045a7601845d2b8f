"""format("recording"): batches, bounds, streams, failed writes."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegraph.sources import datasource


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    return [(e, s, float(np.round(rng.normal() * 100))) for e in (1, 2, 7) for s in range(5 * (e == 7), 90 - 10 * e)] + [(9, s, 1.0) for s in (0, 1, 40, 41, 1000)]


@pytest.fixture()
def path(spark, rows, tmp_path):
    datasource.write(spark.createDataFrame(rows, "electrode int, sample long, value double").repartition(3), f"{tmp_path}/rec", size=16)
    return f"{tmp_path}/rec"


def all_of(df):
    return sorted(map(tuple, df.collect()))


def test_round_trip(spark, rows, path):
    assert all_of(datasource.read(spark, path)) == sorted(rows)
    assert all_of(datasource.read(spark, f"file:{path}")) == sorted(rows)


@pytest.mark.parametrize("dtype", ["int16", "float32"])
def test_narrow_types(spark, tmp_path, dtype):
    given = [(1, 0, 1.5), (1, 1, -40_000.0), (1, 2, None), (2, 0, 7.0)]
    datasource.write(spark.createDataFrame(given[:2] + given[3:], "electrode int, sample long, value double"), f"{tmp_path}/r", dtype=dtype)
    want = [(1, 0, 2.0 if dtype == "int16" else 1.5), (1, 1, -32_768.0 if dtype == "int16" else -40_000.0), (2, 0, 7.0)]
    assert all_of(datasource.read(spark, f"{tmp_path}/r")) == want


def test_bounds_by_options_and_by_filters(spark, rows, path):
    want = [r for r in sorted(rows) if 20 <= r[1] < 45 and r[0] in (2, 9)]
    assert all_of(datasource.read(spark, path, 20, 45, [2, 9])) == want
    d = datasource.read(spark, path)
    near = d.where((F.col("sample") >= 20) & (F.col("sample") < 45) & F.col("electrode").isin(2, 9))
    assert all_of(near) == want
    assert all_of(d.where("sample > 19 AND sample <= 44 AND value > 0 AND electrode = 2")) == [r for r in want if r[0] == 2 and r[2] > 0]
    assert all_of(d.where("sample = 40")) == [r for r in sorted(rows) if r[1] == 40]
    assert all_of(d.where("sample < 0")) == []


def test_filters_reach_the_source(spark, path):
    """Bounds are gone from the plan because the source keeps them, and files outside are no partitions."""
    d = datasource.read(spark, path)
    near = d.where((F.col("sample") >= 20) & (F.col("sample") < 30) & (F.col("value") > 0))
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "sample" not in "".join(x for x in plan.splitlines() if "Filter (" in x and "BatchScan" not in x)
    reader = datasource.Reader({"path": path, "filesPerPartition": "1"})
    assert len(reader.partitions()) == len(datasource.blocks(path)) > 3
    left = list(reader.pushFilters([datasource.ds.GreaterThanOrEqual(("sample",), 20), datasource.ds.LessThan(("sample",), 30), datasource.ds.GreaterThan(("value",), 0.0)]))
    assert [f.attribute for f in left] == [("value",)] and len(reader.partitions()) == 1


def test_only_asked_bytes_are_read(path, monkeypatch):
    read = []
    name = next(n for n, low, high, _ in datasource.blocks(path) if low < 40 <= high)
    open_ = datasource._open

    class Counting:
        def __init__(self, f):
            self.f = f

        def __enter__(self):
            self.g = self.f.__enter__()
            return self

        def __exit__(self, *a):
            return self.f.__exit__(*a)

        def seek(self, at):
            return self.g.seek(at)

        def read(self, n):
            read.append(n)
            return self.g.read(n)

    class Files:
        def __init__(self, fs):
            self.fs = fs

        def open_input_file(self, p):
            return Counting(self.fs.open_input_file(p))

    monkeypatch.setattr(datasource, "_open", lambda p: (lambda fs, q: (Files(fs), q))(*open_(p)))
    out = list(datasource.read_file(path, name, datasource.Bounds(38, 41, frozenset([2]))))
    assert sum(b.num_rows for b in out) == 3 and read[2:] == [24]


def test_append_overwrite_and_failed_writes(spark, path, rows):
    more = [(1, s, 0.5) for s in range(2_000, 2_040)]
    datasource.write(spark.createDataFrame(more, "electrode int, sample long, value double"), path, size=16)
    assert all_of(datasource.read(spark, path)) == sorted(rows + more)
    bad = spark.createDataFrame([(1, 5_000, 1.0), (1, 5_001, 2.0)], "electrode int, sample long, value double").withColumn("value", F.when(F.col("sample") == 5_001, F.raise_error(F.lit("broken")).cast("double")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="broken"):
        datasource.write(bad, path)
    open(os.path.join(path, "data", "stray.bin"), "wb").close()  # no manifest names it
    assert all_of(datasource.read(spark, path)) == sorted(rows + more)
    datasource.write(spark.createDataFrame(more, "electrode int, sample long, value double"), path, mode="overwrite")
    assert all_of(datasource.read(spark, path)) == sorted(more)


def test_nothing_recorded(spark, tmp_path):
    assert datasource.read(spark, f"{tmp_path}/none").collect() == []
    datasource.write(spark.createDataFrame([], "electrode int, sample long, value double"), f"{tmp_path}/empty")
    assert datasource.read(spark, f"{tmp_path}/empty").collect() == []


def test_stream_in_steps_and_after_a_restart(spark, path, rows, tmp_path):
    def run():
        q = datasource.stream(spark, path, 2).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").start()
        q.processAllAvailable()
        q.stop()
        return q.lastProgress["batchId"]

    first = run()
    assert first > 1
    schema = "electrode long, sample long, value double"
    assert all_of(spark.read.schema(schema).parquet(f"{tmp_path}/out")) == sorted(rows)
    more = [(1, s, 0.5) for s in range(2_000, 2_040)]
    datasource.write(spark.createDataFrame(more, schema), path, size=16)
    run()  # goes on where the checkpoint stands
    assert all_of(spark.read.schema(schema).parquet(f"{tmp_path}/out")) == sorted(rows + more)
