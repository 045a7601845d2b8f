"""What tasks of the threshold join send and hold, where pivots tell nothing apart."""

import numpy as np
from pyspark.sql import functions as F

from tidegraph.operators import nearby


def test_tasks_hold_a_block_and_a_slice_of_its_visitors(spark, monkeypatch):
    """Every row visits every later block; neither a task that sorts nor one that sends grows with that."""
    monkeypatch.setattr(nearby, "SENT", 1_000)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1_200, 24))
    x /= np.sqrt((x * x).sum(1))[:, None]
    rows = spark.createDataFrame(list(enumerate(x.tolist())), "id long, v array<double>")
    most, sent = {}, {}
    for n in (600, 1_200):
        some = rows.where(F.col("id") < n)
        cells = nearby.Cells(some, 1.0, None, 50)
        met = nearby._meetings(nearby._routed(cells.home(some), cells), cells)
        most[n] = met.groupBy(F.spark_partition_id()).count().agg(F.max("count")).collect()[0][0]
        total = met.count()
        plan = met._jdf.queryExecution().optimizedPlan().toString()
        tasks = int(plan.split("RepartitionByExpression [xxhash64(id")[1].split("], ")[1].split("\n")[0])
        sent[n] = total / tasks
    assert total > 6 * 1_200  # each row goes to about half of the blocks
    assert max(most.values()) <= 1.5 * 50 * (1 + nearby.GUESTS) and max(sent.values()) <= 1_000
    got = {(r.id_a, r.id_b) for r in nearby.near_pairs(rows, "id", "v", 1.0, None, 50).collect()}
    d2 = ((x[:, None] - x[None]) ** 2).sum(2)
    assert got == {(int(a), int(b)) for a, b in np.argwhere(d2 < 1.0) if a < b} and got


def test_bounds_far_below_the_vectors_lengths(spark):
    """Single precision could not tell these apart; double does."""
    rng = np.random.default_rng(6)
    x = 100.0 + 1e-3 * rng.normal(size=(300, 5))
    for kind, bound in ((np.float64, 1e-6), (np.float32, 9e4)):
        y = x if kind is np.float64 else np.where(np.arange(300)[:, None] % 2, x, -x)
        u = spark.createDataFrame(list(enumerate(y.tolist())), "id long, v array<double>")
        assert nearby.Cells(u, bound**0.5, None, None).kind is kind
        d2 = ((y[:, None] - y[None]) ** 2).sum(2)
        got = {(r.id_a, r.id_b) for r in nearby.near_pairs(u, "id", "v", bound).collect()}
        assert got == {(int(a), int(b)) for a, b in np.argwhere(d2 < bound) if a < b} and got
