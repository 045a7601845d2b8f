"""Laying out what electrodes find alone over their pairs."""

import itertools

import pytest

from tidegraph.operators import graph


@pytest.mark.parametrize("block", [2, 4_096])
def test_pairs_of_electrodes_are_not_shuffled(spark, block):
    electrodes = spark.createDataFrame([(e,) for e in range(9)] * 2, "electrode long")
    alone = [(0, None, 10, 11), (0, None, 10, 12), (4, None, 40, 41), (8, None, 80, 81)]
    found = spark.createDataFrame([*alone, (0, 4, 10, 41), (3, 8, 30, 80)], "e1 long, e2 long, master_id long, loser_id long")
    met = {(0, 4), (3, 8), (2, 4)}
    want = {("0-4", 10, 41), ("3-8", 30, 80)}
    for a, b in itertools.combinations(range(9), 2):
        if (a, b) not in met:
            want |= {(f"{a}-{b}", m, x) for e, _, m, x in alone if e in (a, b)}
    out = graph.spread(found, electrodes, spark.createDataFrame(sorted(met), "e1 long, e2 long"), block)
    rows = out.collect()
    assert {tuple(r) for r in rows} == want and len(rows) == len(want)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Generate explode(array_except")[0]
