"""Tasks that grow in number with the rows, and frames that nobody asks for."""

from pyspark.sql import functions as F

from tidegraph.operators import compare, reports


def test_trains_are_dealt_by_their_rows(spark, monkeypatch):
    monkeypatch.setattr(compare, "ROWS", 100)
    a = spark.range(0, 2_000).select((F.col("id") % 3).cast("int").alias("electrode"), (F.col("id") % 5).alias("neuron_id"), (F.col("id") / 4).cast("long").alias("spike_time"))
    out = compare.intersections(a, a)
    assert "hashpartitioning(electrode#" in (plan := out._jdf.queryExecution().executedPlan().toString()) and ", 20), REPARTITION_BY_NUM" in plan
    want = {}
    rows = [tuple(r) for r in a.collect()]
    times = {}
    for e, n, t in rows:
        times.setdefault((e, t), {}).setdefault(n, 0)
        times[e, t][n] += 1
    for (e, _), c in times.items():
        for x in c:
            for y in c:
                want[e, x, y] = want.get((e, x, y), 0) + min(c[x], c[y])
    assert {(r.electrode, r.ref_id, r.other_id): r.common for r in out.collect()} == want
    dealt = compare.by_time(a, 2_000)
    again = compare.intersections(dealt, dealt, dealt=True)
    assert {(r.electrode, r.ref_id, r.other_id): r.common for r in again.collect()} == want


def test_frames_go_only_where_events_are(spark, monkeypatch):
    """Each event of 40 neurons sees the frames of its own block, not every group those of all blocks."""
    monkeypatch.setattr(reports, "FRAMES", 8)
    monkeypatch.setattr(reports, "NEURONS", 1)
    frames = spark.range(0, 800).select(F.col("id").alias("frame"), F.array(F.col("id") * 1.0).alias("values"))
    events = spark.range(0, 40).select(F.col("id").alias("neuron_id"), F.lit(5).cast("long").alias("frame"))
    out = reports.triggered_average(events, frames, 3)
    assert "Join" in out._jdf.queryExecution().optimizedPlan().toString().split("FlatMapCoGroups")[1]
    got = {(r.neuron_id, r.back): (r.n, list(r["mean"])) for r in out.collect()}
    assert got == {(i, b): (1, [4.0 - b]) for i in range(40) for b in range(3)}
