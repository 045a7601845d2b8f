"""Detection by blocks gives what one scan over the whole channel gives, wherever the blocks are cut."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidegraph.operators import detection


def scanned(values, threshold, max_width, min_gap):
    """Crossings, candidates and events of one channel by a plain loop."""
    cross, found, up, low, was = [], [], None, None, False
    for i, v in values:
        hot = v is not None and v < -threshold
        if hot != was:
            cross.append((i, "up" if hot else "down"))
        if hot and not was:
            up, low = i, (v, i)
        elif hot or was:
            if v is not None and v < low[0]:
                low = (v, i)
            if not hot:
                found.append((up, i, i - up, low[1], -low[0]))
        was = hot
    kept = [c[3] for j, c in enumerate(found) if c[2] <= max_width and (j == 0 or c[3] - found[j - 1][3] > min_gap)]
    return cross, found, kept


@pytest.fixture(scope="module")
def recording():
    rng = random.Random(5)
    out = {}
    for e in range(6):
        v, level = [], 0
        for i in range(400):
            level = rng.choice((0, 0, -6, -7, -9)) if rng.random() < (0.02 if e == 1 else 0.4) else level
            v.append((i + 3 * e, None if rng.random() < 0.01 else float(level)))
        out[e] = v
    out[6] = [(i, -9.0) for i in range(300)] + [(300, 0.0)]  # a run over many blocks
    out[7] = [(i, -9.0) for i in range(300)]  # one that does not come back
    out[8] = [(0, -5.0), (900, -5.0), (901, 0.0)]  # blocks without samples
    return out


@pytest.mark.parametrize("block", [1, 7, 64, 10_000])
def test_blocks_equal_one_scan(spark, recording, block):
    rows = [(e, i, v) for e, channel in recording.items() for i, v in channel]
    random.Random(1).shuffle(rows)
    samples = spark.createDataFrame(rows, "electrode int, sample long, value double")
    limits = samples.select("electrode").distinct().withColumn("threshold", F.lit(4.0))
    want = {e: scanned(c, 4.0, 9, 5) for e, c in recording.items()}
    cross = sorted(map(tuple, detection.crossings(samples, limits, block=block).collect()))
    assert cross == sorted((e, *x) for e, w in want.items() for x in w[0])
    found = detection.candidates(samples, limits, block=block).select("electrode", "up", "down", "width", "spike_time", "amplitude")
    assert sorted(map(tuple, found.collect())) == sorted((e, *x) for e, w in want.items() for x in w[1])
    kept = detection.detect(samples, limits, 9, 5, block=block).select("electrode", "spike_time")
    assert sorted(map(tuple, kept.collect())) == sorted((e, t) for e, w in want.items() for t in w[2])


@pytest.mark.parametrize("block", [1, 50, 10_000])
def test_previous_and_intervals(spark, block):
    times = {1: [3, 4, 90, 500], 2: [77], 3: list(range(0, 1000, 100))}
    rows = [(e, t) for e, ts in times.items() for t in ts]
    got = detection.previous(spark.createDataFrame(rows, "electrode int, sample long"), "sample", "sample", block=block).collect()
    assert {(r["electrode"], r["sample"]): r["previous"] for r in got} == {(e, t): ts[j - 1] if j else None for e, ts in times.items() for j, t in enumerate(ts)}
    gaps = {r["electrode"]: (r["n"], r["total"]) for r in detection.trigger_intervals(spark.createDataFrame(rows, "electrode int, sample long"), block=block).collect()}
    assert gaps == {1: (3, 497), 3: (9, 900)}


def test_empty_tables(spark):
    samples = spark.createDataFrame([], "electrode int, sample long, value double")
    limits = spark.createDataFrame([], "electrode int, threshold double")
    assert detection.detect(samples, limits).collect() == []
    assert detection.trigger_edges(samples).collect() == []


def test_a_channel_is_no_unit_of_work(spark):
    """The samples of a long channel are dealt out by blocks: no window or sort takes them by the channel alone, and one channel's rows
    are read in several tasks."""
    samples = spark.range(3_000_000).select((F.col("id") % 1 + 1).cast("int").alias("electrode"), F.col("id").alias("sample"), F.when(F.col("id") % 1_000 < 3, -9.0).otherwise(0.0).alias("value"))
    limits = spark.createDataFrame([(1, 4.0)], "electrode int, threshold double")
    s = detection._below(samples, limits, ["electrode"], detection.BLOCK)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # what is small here would come to one task
    try:
        parts = s.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) > 1 and sum(r["count"] for r in parts) == 3_000_000
    plan = s._jdf.queryExecution().optimizedPlan().toString()
    over_samples = [w for w in re.findall(r"Window \[.*?\n", plan) if "sample" in w]
    assert over_samples and all(re.search(r"\[electrode#\d+, block#\d+L\]", w) for w in over_samples)
    assert detection.detect(samples, limits).count() == 3_000
