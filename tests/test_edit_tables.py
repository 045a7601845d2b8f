"""Edits as tables against the fold over one dictionary, and editors who write at the same time."""

import random
from concurrent.futures import ThreadPoolExecutor

import pytest

from tidegraph.operators import editing, tables
from tidegraph.operators.editing import Action, State


def counts_table(spark, counts):
    return spark.createDataFrame(list(counts.items()), "neuron_id int, n long")


def random_log(seed, automatic):
    rng = random.Random(seed)
    counts = {i: rng.randrange(1, 50) for i in range(1, 200) if rng.random() < 0.9}
    guarded = {i for i in counts if rng.random() < 0.1}
    actions, state = [], State(dict(counts), set(guarded))
    for _ in range(80):
        block = rng.randrange(0, 190, 10)
        ids = rng.sample(range(block + 1, block + 11), rng.randrange(1, 4))
        if automatic:
            kind = rng.choice(["AUTO_RM", "AUTO_MERGE", "AUTO_RM_DUP"])
            actions.append(Action(kind, ids, None if kind == "AUTO_RM" else rng.randrange(block + 1, block + 11)))
            continue
        ids = [i for i in ids if i in state.counts]
        kind = rng.choice(["KEEP", "DELETE", "MERGE", "CONSOLIDATE", "SHRINK"])
        if kind != "CONSOLIDATE" and len(ids) < (2 if kind == "MERGE" else 1):
            continue
        a = Action(kind, [] if kind == "CONSOLIDATE" else ids)
        if kind == "SHRINK":
            a.new_ids, a.new_counts = [*ids, 1000 + len(actions)], [*[1] * len(ids), 2]
        actions.append(a)
        editing.apply_manual(state, [a])
    return counts, guarded, actions


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("automatic", [True, False])
def test_fold_equals_one_dictionary(spark, seed, automatic):
    counts, guarded, actions = random_log(seed, automatic)
    want = (editing.apply_auto if automatic else editing.apply_manual)(State(dict(counts), set(guarded)), actions)
    c = counts_table(spark, counts)
    elevated = spark.createDataFrame([(i,) for i in guarded], "neuron_id int")
    rows = {r["neuron_id"]: r for r in editing.fold(editing.log_table(spark, actions), c, elevated, automatic).collect()}
    for i, r in rows.items():
        assert (r["there"], r["n"]) == (i in want.counts, want.counts.get(i, 0))
        assert r["to_id"] == want.into.get(i, i) and r["label"] == want.labels.get(i) and r["elevated"] == (i in want.elevated)
    assert {i for i in want.counts if i not in rows} == {i for i in counts if all(i not in [*a.ids, a.master_id] for a in actions)}
    events = spark.createDataFrame([(i, t) for i, n in counts.items() for t in range(n)], "neuron_id int, spike_time int")
    if automatic:
        dry = editing.dry_run(counts, actions, guarded)
        got = editing.dry_run_by(c, editing.fold(editing.log_table(spark, actions), c, elevated, True))
        assert {r["neuron_id"]: (r["code"], r["master_id"]) for r in got.collect()} == dry
        left = editing.remap_by(events, editing.fold(editing.log_table(spark, actions), c, elevated, True))
        assert {r["neuron_id"]: r["count"] for r in left.groupBy("neuron_id").count().collect()} == want.counts


def test_fold_of_little(spark):
    c = counts_table(spark, {1: 5, 2: 3})
    assert editing.fold(editing.log_table(spark, [Action("CONSOLIDATE")]), c).collect() == []
    with pytest.raises(Exception, match="no neurons"):
        editing.fold(editing.log_table(spark, [Action("MERGE", [1, 9])]), c).collect()
    none = editing.fold(editing.log_table(spark, [Action("AUTO_RM", [7])]), c, automatic=True)
    assert none.collect() == [] and {r["code"] for r in editing.dry_run_by(c, none).collect()} == {0}


def test_one_of_many_publishes(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: tables.publish(spark, f"{tmp_path}/v/1.json", f"writer {i}"), range(8)))
    assert sum(won) == 1
    assert tables.published(spark, f"{tmp_path}/v") == ["1.json"]
    assert tables.text_of(spark, f"{tmp_path}/v/1.json") == f"writer {won.index(True)}"
    assert tables.published(spark, f"{tmp_path}/none") == []


def test_editors_at_once_lose_nothing(spark, tmp_path):
    def edit(k):
        s = editing.Store(spark, f"{tmp_path}/edits")
        for j in range(3):
            s.add(Action("KEEP", [10 * k + 1]))
            s.add(Action("DELETE", [10 * k + 2 + j]))
            s.save()

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(edit, range(4)))
    rows = editing.Store(spark, f"{tmp_path}/edits").log().collect()
    assert [r["seq"] for r in rows] == list(range(1, 25))
    for k in range(4):
        own = [(r["action"], r["ids"]) for r in rows if r["ids"][0] // 10 == k]
        assert own == [x for j in range(3) for x in (("KEEP", [10 * k + 1]), ("DELETE", [10 * k + 2 + j]))]
    for a, b in zip(rows[::2], rows[1::2], strict=True):  # what was saved together stays together
        assert (a["action"], b["action"]) == ("KEEP", "DELETE") and a["ids"][0] // 10 == b["ids"][0] // 10


def test_consolidation_under_another_editors_hand(spark, tmp_path, monkeypatch):
    raw = spark.createDataFrame([(i, t) for i in (1, 2, 3) for t in range(i)], "neuron_id int, spike_time long")
    one, two = editing.Store(spark, f"{tmp_path}/edits"), editing.Store(spark, f"{tmp_path}/edits")
    one.add(Action("DELETE", [1]))
    one.save()
    replay, times = editing.replay, []

    def meanwhile(*a):
        if not times:  # the other editor saves while the first consolidates
            two.add(Action("MERGE", [2, 3]))
            two.save()
        times.append(1)
        return replay(*a)

    monkeypatch.setattr(editing, "replay", meanwhile)
    out = one.consolidate(raw)
    assert len(times) == 2 and {r["neuron_id"]: r["count"] for r in out.groupBy("neuron_id").count().collect()} == {3: 5}
    assert [r["action"] for r in one.log().collect()] == ["DELETE", "MERGE", "CONSOLIDATE"]


def test_a_crash_before_the_version_changes_nothing(spark, tmp_path, monkeypatch):
    raw = spark.createDataFrame([(1, 0), (2, 0)], "neuron_id int, spike_time long")
    s = editing.Store(spark, f"{tmp_path}/edits")
    s.add(Action("DELETE", [1]))
    s.save()
    monkeypatch.setattr(editing, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError):
        s.consolidate(raw)
    monkeypatch.undo()
    again = editing.Store(spark, f"{tmp_path}/edits")
    assert again.neurons() is None and [r["action"] for r in again.log().collect()] == ["DELETE"]
    assert {r["neuron_id"] for r in again.consolidate(raw).collect()} == {2}
    again.clear_hard()
    again.save()
    assert again.log().count() == 0 and again.neurons() is None


def test_rows_are_checked_as_actions_are(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        pick = lambda *x: rng.choice(x)
        rows.append((i, pick(*editing.ACTIONS, "NO_SUCH"), pick([], [1], [2, 2], [1, 5], [0, 3], [-1]), pick(None, 4), pick(None, 0.0, 0.5, 1.0, 1.5), pick(None, -0.1, 0.0, 2.0), pick(None, -1, 0, 15, 16), pick(None, "", "TAG")))
    log = spark.createDataFrame(rows, "seq int, action string, ids array<int>, master_id int, frac double, contam double, n_clusters int, config_tag string")
    for r in editing.invalid(log).collect():
        try:
            Action(r["action"], list(r["ids"]), r["master_id"], r["frac"], r["contam"], r["n_clusters"], r["config_tag"]).check()
            said = None
        except ValueError as e:
            said = str(e)
        assert r["wrong"] == said, r
    short = editing.invalid(spark.createDataFrame([("MERGE", [1, 2]), ("SHRINK", [1]), (None, [1])], "action string, ids array<int>")).collect()
    assert [r["wrong"] for r in short] == [None, "SHRINK needs frac", "unknown action None"]
