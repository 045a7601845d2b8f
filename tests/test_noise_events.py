"""Noise events near spikes, over every sample, against plain Python."""

import math

import pytest
from pyspark.sql import functions as F

from tidegraph.operators import detection
from tidegraph.plans import QUERIES


@pytest.mark.parametrize("name,width", [("noise_event_antijoin", 4.0), ("noise_event_first_only", 8.0)])
def test_every_sample_is_judged(spark, small, name, width):
    place = lambda e, t: (e, math.floor(t / width + 0.5))
    taken = {place(r.electrode, r.spike_time) for r in QUERIES["spike_detect"](spark, small).collect()}
    n, want, seen = spark.read.parquet(f"{small}/events.parquet").groupBy("user_id").count().collect(), set(), set()
    for r in n:
        for t in range(r["count"]):
            at = place(r.user_id, t)
            if at not in taken or name.endswith("first_only") and at in seen:
                want.add((r.user_id, t))
            seen.add(at)
    got = [(r.electrode, r.spike_time) for r in QUERIES[name](spark, small).collect()]
    assert taken and len(got) == len(set(got)) and set(got) == want


def test_events_are_dealt_into_tasks(spark, monkeypatch):
    """Long channels and many short ones are drawn by tasks of a bounded number of events, however few rows the spans are."""
    spans = spark.createDataFrame([(1, 0, 4_000), (2, 50, 1)] + [(e, 7, 10) for e in range(3, 203)], "electrode int, first long, span long").coalesce(1)
    want = sorted(detection.random_events(spans, 0.5).collect())
    monkeypatch.setattr(detection, "DRAWN", 100, raising=False)
    monkeypatch.setattr(detection, "STRETCH", 20, raising=False)
    out = detection.random_events(spans, 0.5)
    assert sorted(out.collect()) == want and len(want) == len(set(want)) == 2_000 + 1 + 200 * 5  # halves round up
    assert out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).collect()[0][0] <= 400
