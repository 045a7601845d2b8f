"""The edit log: actions, their checks, replay over neurons, dry runs, undo, shrinking.

What an action does depends on those before it, but only on those that it shares ids with, directly or through others. So a
log is cut into the connected components of its ids; each is folded by itself, over ids and counts, never over events, and what
comes out is one mapping (old id -> new id or removed) that is joined to the long table of events. An editor's session,
a handful of actions, is folded where it is, over the ids that it names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import MAX_CLUSTERS
from ..session import ship
from . import graph, parts, reports
from .tables import publish, published, text_of, written

# The actions and what each needs.
ACTIONS = {
    "CONSOLIDATE": (), "DEBUG": (), "KEEP": ("ids",), "DELETE": ("ids",), "MERGE": ("ids",), "SHRINK": ("ids", "frac", "contam"),
    "RECLUSTER": ("ids", "n_clusters", "config_tag"), "AUTO_RM": ("ids",), "AUTO_MERGE": ("master_id", "ids"), "AUTO_RM_DUP": ("master_id", "ids"),
}


@dataclass
class Action:
    action: str
    ids: list[int] = field(default_factory=list)
    master_id: int | None = None
    frac: float | None = None
    contam: float | None = None
    n_clusters: int | None = None
    config_tag: str | None = None
    new_ids: list[int] = field(default_factory=list)
    new_counts: list[int] = field(default_factory=list)

    def check(self) -> None:
        """Raises ValueError with what is wrong."""
        if self.action not in ACTIONS:
            raise ValueError(f"unknown action {self.action}")
        for need in ACTIONS[self.action]:
            if getattr(self, need) in (None, []):
                raise ValueError(f"{self.action} needs {need}")
        if self.action == "MERGE" and len(set(self.ids)) < 2:
            raise ValueError("MERGE needs two ids or more")
        if any(not isinstance(i, int) or i < 1 for i in self.ids):
            raise ValueError("ids are whole numbers from 1")
        if self.frac is not None and not 0 < self.frac <= 1:
            raise ValueError("frac lies in (0, 1]")
        if self.contam is not None and self.contam < 0:
            raise ValueError("contam is not negative")
        if self.n_clusters is not None and not 0 <= self.n_clusters <= MAX_CLUSTERS:
            raise ValueError(f"n_clusters lies in 0..{MAX_CLUSTERS}, 0 for the automatic choice")


def invalid(log: DataFrame) -> DataFrame:
    """log with `wrong`: what Action.check() says of the row, null if it is sound. Rows may come from elsewhere, so columns that log lacks
    are taken as null."""
    have = {c.lower() for c in log.columns}
    col = lambda c, kind: F.col(c).cast(kind) if c in have else F.lit(None).cast(kind)
    kinds = {"ids": "array<long>", "master_id": "long", "frac": "double", "contam": "double", "n_clusters": "long", "config_tag": "string"}
    c = {n: col(n, k) for n, k in kinds.items()}
    lacks = lambda need: F.coalesce(F.size(c[need]), F.lit(0)) < 1 if need == "ids" else c[need].isNull()
    rules = [(~F.coalesce(F.col("action").isin(list(ACTIONS)), F.lit(False)), F.concat(F.lit("unknown action "), F.coalesce("action", F.lit("None"))))]
    for kind, needs in ACTIONS.items():
        rules += [((F.col("action") == kind) & lacks(need), F.lit(f"{kind} needs {need}")) for need in needs]
    rules += [
        ((F.col("action") == "MERGE") & (F.size(F.array_distinct(c["ids"])) < 2), F.lit("MERGE needs two ids or more")),
        (F.exists(c["ids"], lambda i: i.isNull() | (i < 1)), F.lit("ids are whole numbers from 1")),
        ((c["frac"] <= 0) | (c["frac"] > 1), F.lit("frac lies in (0, 1]")), (c["contam"] < 0, F.lit("contam is not negative")),
        ((c["n_clusters"] < 0) | (c["n_clusters"] > MAX_CLUSTERS), F.lit(f"n_clusters lies in 0..{MAX_CLUSTERS}, 0 for the automatic choice")),
    ]
    return log.withColumn("wrong", F.coalesce(*[F.when(rule, said) for rule, said in rules]))


def since_consolidate(log: DataFrame) -> DataFrame:
    """Rows after the last CONSOLIDATE; all without one."""
    mark = log.where("action = 'CONSOLIDATE'").agg(F.coalesce(F.max("seq"), F.lit(-1)).alias("mark"))  # one row
    return log.join(F.broadcast(mark), F.col("seq") > F.col("mark")).drop("mark")


def for_electrode(log: DataFrame, electrode: int) -> DataFrame:
    """Rows whose ids touch the electrode's id range."""
    low = (electrode - 2) * MAX_CLUSTERS + 1
    return log.where(F.arrays_overlap("ids", F.sequence(F.lit(low), F.lit(low + MAX_CLUSTERS - 1))))


def missing_ids(asked: DataFrame, have: DataFrame) -> DataFrame:
    """Asked ids that are not there; empty if the request is sound."""
    return asked.select("neuron_id").distinct().join(have.select("neuron_id"), "neuron_id", "left_anti")


class Log:
    """An append-only log: what was loaded, and what this session added."""

    def __init__(self, loaded: list[Action] | None = None):
        self.loaded, self.session = list(loaded or []), []

    def add(self, action: Action) -> None:
        action.check()
        self.session.append(action)

    def undo(self) -> Action | None:
        return self.session.pop() if self.session else None

    def clear_session(self) -> None:
        self.session = []

    def clear_hard(self) -> None:
        self.loaded, self.session = [], []

    def all(self) -> list[Action]:
        return [*self.loaded, *self.session]

    def pending(self) -> list[Action]:
        a = self.all()
        last = max((i for i, x in enumerate(a) if x.action == "CONSOLIDATE"), default=-1)
        return a[last + 1 :]


@dataclass
class State:
    """Neurons while actions are applied: count of events, mapping of original ids, what is protected, labels, status."""

    counts: dict[int, int]
    elevated: set[int] = field(default_factory=set)
    labels: dict[int, str] = field(default_factory=dict)
    into: dict[int, int | None] = field(default_factory=dict)
    status: dict[int, tuple[int, int | None]] = field(default_factory=dict)

    def _send(self, ids: list[int], to: int | None) -> None:
        for old, now in list(self.into.items()):
            if now in ids:
                self.into[old] = to
        for i in ids:
            self.into[i] = to
            del self.counts[i]


def apply_auto(state: State, actions: list[Action]) -> State:
    """Removals, merges and duplicates in order. Protected neurons are never touched; if a master is protected or missing,
    the largest remaining member (the smaller id on ties) takes its place."""
    for a in actions:
        ids = [i for i in a.ids if i in state.counts and i not in state.elevated]
        if a.action == "AUTO_RM":
            state._send(ids, None)
            state.status |= {i: (1, None) for i in ids}
            continue
        master = a.master_id
        if master not in state.counts or master in state.elevated:
            if not ids:
                continue
            master = max(ids, key=lambda i: (state.counts[i], -i))
        ids = [i for i in ids if i != master]
        total = sum(state.counts[i] for i in ids)
        merge = a.action == "AUTO_MERGE"
        state._send(ids, master if merge else None)
        if merge:
            state.counts[master] += total
        state.status |= {i: (2 if merge else 3, master) for i in ids}
    return state


def apply_manual(state: State, actions: list[Action]) -> State:
    """KEEP protects, DELETE removes, MERGE joins into the largest (the smaller id on ties) and labels it, SHRINK and
    RECLUSTER replace their ids by new neurons; an id that is not there raises."""
    for a in actions:
        if a.action in ("CONSOLIDATE", "DEBUG"):
            continue
        gone = [i for i in a.ids if i not in state.counts]
        if gone:
            raise ValueError(f"{a.action}: no neurons {gone}")
        if a.action == "KEEP":
            state.elevated |= set(a.ids)
        elif a.action == "DELETE":
            state._send(a.ids, None)
        elif a.action == "MERGE":
            master = max(a.ids, key=lambda i: (state.counts[i], -i))
            rest = [i for i in a.ids if i != master]
            total = sum(state.counts[i] for i in rest)
            state._send(rest, master)
            state.counts[master] += total
            state.labels[master] = "Edited/" + state.labels.get(master, "")
        else:
            state._send(a.ids, None)
            for i, n in zip(a.new_ids, a.new_counts, strict=True):
                state.counts[i] = n
                state.elevated.add(i)
                state.labels[i] = "Edited/"
    return state


def incremental(state: State, actions: list[Action]) -> State:
    """All actions on the first run, those after the last marker later on, none if there are none."""
    return apply_manual(state, Log(actions).pending())


def dry_run(counts: dict[int, int], actions: list[Action], elevated: set[int] = frozenset()) -> dict[int, tuple[int, int | None]]:
    """Status code and master of every neuron if the automatic actions were applied; 0 for those that stay."""
    s = apply_auto(State(dict(counts), set(elevated)), actions)
    status = {i: s.status.get(i, (0, None)) for i in counts}
    top = {i: m for i, (_, m) in status.items() if m is not None}
    for i in list(top):  # masters that went elsewhere themselves
        seen = {i}
        while top[i] in top and top[i] not in seen:
            seen.add(top[i])
            top[i] = top[top[i]]
    return {i: (c, top.get(i)) for i, (c, _) in status.items()}


LOG = "seq int, action string, ids array<int>, master_id int, new_ids array<int>, new_counts array<long>"


def log_table(spark: SparkSession, actions: list[Action]) -> DataFrame:
    """A session's actions as rows, seq from 1."""
    return spark.createDataFrame([(i, a.action, a.ids, a.master_id, a.new_ids, a.new_counts) for i, a in enumerate(actions, 1)], LOG)


def fold(log: DataFrame, counts: DataFrame, elevated: DataFrame | None = None, automatic: bool = False) -> DataFrame:
    """What the actions of a log (seq, action, ids, master_id, new_ids, new_counts) make of the neurons (counts: neuron_id, n) that they name:
    neuron_id, there (it is left), to_id (where its events are now; null: removed), n, code, master_id, label, elevated.

    Rows are those of named neurons that are or were there. Actions that share ids, directly or through others, are one component
    of a graph and are folded in the order of seq in one task; components share nothing, so they are folded side by side. Neither
    the log nor the counts are gathered. automatic: apply_auto(), else apply_manual(), whose errors end the job.
    """
    spark = ship(log.sparkSession)
    log = log.where(~F.col("action").isin("CONSOLIDATE", "DEBUG")).select("seq", "action", "ids", "master_id", "new_ids", "new_counts")
    every = F.array_distinct(F.concat(F.coalesce("ids", F.array().cast("array<int>")), F.coalesce("new_ids", F.array().cast("array<int>")), F.when(F.col("master_id").isNull(), F.array().cast("array<int>")).otherwise(F.array("master_id"))))
    log = written(log.withColumn("named", every).where(F.size("named") > 0).withColumn("first", F.array_min("named")), "log")
    named = log.select(F.lit(0).alias("g"), "first", F.explode("named").alias("id"))
    part = graph.components(named, named.select("g", F.col("first").alias("id_a"), F.col("id").alias("id_b")), "g", "id").select("id", "component")
    part = written(part, "log-parts")
    actions = log.join(part.withColumnRenamed("id", "first"), "first").drop("first", "named")
    guarded = elevated.select(F.col("neuron_id").alias("id"), F.lit(True).alias("guarded")).distinct() if elevated is not None else part.select("id", F.lit(True).alias("guarded")).limit(0)
    have = counts.select(F.col("neuron_id").cast("int").alias("id"), "n").join(part, "id").join(guarded, "id", "left").select("component", "id", "n", F.coalesce("guarded", F.lit(False)).alias("guarded"))

    def run(a: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        todo = [Action(r.action, [int(i) for i in r.ids], None if pd.isna(r.master_id) else int(r.master_id), new_ids=[int(i) for i in r.new_ids if r.new_ids is not None], new_counts=[int(i) for i in r.new_counts]) for r in a.sort_values("seq").itertuples()]
        start = {int(i): int(n) for i, n in zip(c["id"], c["n"], strict=True)}
        s = State(dict(start), {int(i) for i in c["id"][c["guarded"].astype(bool)]})
        s = (apply_auto if automatic else apply_manual)(s, todo)
        rows = []
        for i in sorted({*start, *s.counts}):
            code, master = s.status.get(i, (0, None))
            top, seen = master, {i}
            while top in s.status and s.status[top][1] is not None and top not in seen:  # masters that went elsewhere themselves
                seen.add(top)
                top = s.status[top][1]
            rows.append((i, i in s.counts, s.into.get(i, i), s.counts.get(i, 0), code, top, s.labels.get(i), i in s.elevated))
        out = pd.DataFrame(rows, columns=["neuron_id", "there", "to_id", "n", "code", "master_id", "label", "elevated"])
        return out.astype({"to_id": "Int32", "master_id": "Int32"})

    kind = "neuron_id int, there boolean, to_id int, n long, code int, master_id int, label string, elevated boolean"
    have = have.select(*[F.col(c).alias(c) for c in have.columns])  # both sides come from one table
    return actions.groupBy("component").cogroup(have.groupBy("component")).applyInPandas(run, kind)


def remap_by(spikes: DataFrame, folded: DataFrame) -> DataFrame:
    """The long table of events after a fold(): one join with a row a named neuron."""
    moves = folded.where("to_id is null OR to_id <> neuron_id").select("neuron_id", "to_id", F.lit(True).alias("moved"))
    out = spikes.join(moves, "neuron_id", "left").where("moved is null or to_id is not null")
    return out.withColumn("neuron_id", F.coalesce("to_id", "neuron_id")).select(*spikes.columns)


def dry_run_by(counts: DataFrame, folded: DataFrame) -> DataFrame:
    """neuron_id, code, master_id of every neuron if the automatic actions of a fold() were applied; 0 for those that stay."""
    d = counts.select(F.col("neuron_id").cast("int").alias("neuron_id")).join(folded.select("neuron_id", "code", "master_id"), "neuron_id", "left")
    return d.withColumn("code", F.coalesce("code", F.lit(0)))


def remap(spikes: DataFrame, state: State) -> DataFrame:
    """The long table of events after the edits: one join with the mapping, which has a row a changed neuron."""
    spark: SparkSession = spikes.sparkSession
    rows = [(k, v) for k, v in state.into.items()]
    moves = spark.createDataFrame(rows, "neuron_id int, to_id int").withColumn("moved", F.lit(True))
    out = spikes.join(moves, "neuron_id", "left").where("moved is null or to_id is not null")
    return out.withColumn("neuron_id", F.coalesce("to_id", "neuron_id")).drop("to_id", "moved")


def replay(spikes: DataFrame, actions: list[Action], trains: DataFrame | None = None) -> DataFrame:
    """The table of events (neuron_id, spike_time, any others) after manual actions, SHRINK and RECLUSTER included.

    trains (seq, neuron_id, spike_time, any others): the events that action number seq (from 1) gave its neurons: for SHRINK
    those that its ids keep and those of the outlier neuron (new_ids), which goes; for RECLUSTER those of its new_ids. What
    an id holds thus comes from the table itself (source 0) or from an action, and later actions move it on. The fold runs
    on the ids that the actions name and their counts; events are moved by one join on (source, id). Merging takes in all events, repeated times too.
    """
    spark = spikes.sparkSession
    both = spikes.withColumn("source", F.lit(0))
    if trains is not None:
        both = both.unionByName(trains.withColumnRenamed("seq", "source").withColumn("source", F.col("source").cast("int")).select(*both.columns))
    named = spark.createDataFrame([(i,) for i in sorted({i for a in actions for i in [*a.ids, *a.new_ids]})], "neuron_id int")
    n = {(r["source"], r["neuron_id"]): r["count"] for r in both.join(named, "neuron_id", "left_semi").groupBy("source", "neuron_id").count().collect()}  # a row a named neuron
    holds: dict[int, list[tuple[int, int]]] = {i: [(0, i)] for s, i in n if s == 0}
    gone: set[int] = set()
    size = lambda i: sum(n.get(p, 0) for p in holds[i])
    for seq, a in enumerate(actions, 1):
        if a.action in ("CONSOLIDATE", "DEBUG"):
            continue
        missing = [i for i in a.ids if i not in holds]
        if missing:
            raise ValueError(f"{a.action}: no neurons {missing}")
        if a.action == "KEEP":
            gone -= set(a.ids)
        elif a.action == "DELETE":
            gone |= set(a.ids)
        elif a.action == "MERGE":
            master = max(a.ids, key=lambda i: (size(i), -i))
            for i in a.ids:
                if i != master:
                    holds[master] += holds.pop(i)
                    gone.discard(i)
            gone.discard(master)
        elif a.action == "SHRINK":
            for i in a.ids:
                holds[i] = [(seq, i)]
                gone.discard(i)
            for i in a.new_ids:
                holds[i] = [(seq, i)]
                gone.add(i)
        elif a.action == "RECLUSTER":
            for i in a.ids:
                del holds[i]
                gone.discard(i)
            for i in a.new_ids:
                holds[i] = [(seq, i)]
        else:
            raise ValueError(f"{a.action} is no manual action")
    goes = {p: to for to, ps in holds.items() if to not in gone for p in ps}
    moves = spark.createDataFrame([(s, i, goes.get((s, i))) for s, i in n], "source int, neuron_id int, to_id int").withColumn("named", F.lit(True))
    out = both.join(moves, ["source", "neuron_id"], "left").where("to_id is not null OR (named is null AND source = 0)")
    return out.withColumn("neuron_id", F.coalesce("to_id", "neuron_id")).select(*spikes.columns)


def merged_trains(spikes: DataFrame) -> DataFrame:
    """neuron_id, n, times: each neuron's events in order, repeated ones kept, in order of neurons. A row a neuron."""
    out = spikes.groupBy("neuron_id").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("spike_time")).alias("times"))
    return out.repartitionByRange("neuron_id").sortWithinPartitions("neuron_id")


class Store:
    """A log of edits and the neurons that they lead to, as tables under one folder, for any number of editors at once.

    A version is a small file that lists the log's parts in order; the one with the largest number holds. To add, an editor writes its rows as
    a new part and then publishes the next version, which only one can do: who is late reads the version that came
    between and lists its part behind it. Sequence numbers follow from the order of parts, so none is lost or given
    twice, and nothing that is written becomes visible before its version is. The log's last CONSOLIDATE names the table of neurons that holds.
    """

    KIND = "seq int, action string, ids array<int>, master_id int, frac double, contam double, n_clusters int, config_tag string, new_ids array<int>, version string"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.session: list[Action] = []
        self.expect_clear = False

    def version(self) -> tuple[int, list[dict]]:
        """Number and parts of the version that holds; 0 and none before the first."""
        found = published(self.spark, f"{self.root}/versions")
        return (int(found[-1].split(".")[0]), json.loads(text_of(self.spark, f"{self.root}/versions/{found[-1]}"))["parts"]) if found else (0, [])

    def _rows(self, parts: list[dict]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.KIND)
        starts, at = [], 0
        for p in parts:
            starts.append((p["part"], at))
            at += p["n"]
        rows = self.spark.read.schema(self.KIND + ", part string").parquet(*[f"{self.root}/{p['part']}" for p in parts])
        rows = rows.join(self.spark.createDataFrame(starts, "part string, start int"), "part")
        return rows.withColumn("seq", F.col("start") + F.col("seq")).drop("part", "start").orderBy("seq")

    def log(self) -> DataFrame:
        """All saved rows, in order of seq."""
        return self._rows(self.version()[1])

    @staticmethod
    def _read(rows: DataFrame) -> list[Action]:
        return [Action(r["action"], list(r["ids"] or []), r["master_id"], r["frac"], r["contam"], r["n_clusters"], r["config_tag"], list(r["new_ids"] or [])) for r in rows.collect()]

    def actions(self) -> list[Action]:
        return self._read(self.log())

    def _append(self, actions: list[Action], version: str | None = None, fresh: bool = False, after: int | None = None) -> bool:
        """Adds the actions behind all others (fresh: in their place). after: only if that version still holds."""
        new = []
        if actions:
            part = f"log-{uuid.uuid4().hex}"
            rows = [(i, a.action, a.ids, a.master_id, a.frac, a.contam, a.n_clusters, a.config_tag, a.new_ids, version, part) for i, a in enumerate(actions, 1)]
            self.spark.createDataFrame(rows, self.KIND + ", part string").coalesce(1).write.parquet(f"{self.root}/{part}")
            new = [{"part": part, "n": len(rows)}]
        while True:
            base, parts = self.version()
            if after is not None and base != after:
                return False
            if publish(self.spark, f"{self.root}/versions/{base + 1:012d}.json", json.dumps({"parts": new if fresh else parts + new})):
                return True

    def add(self, action: Action) -> None:
        """To the session; kept only when saved."""
        action.check()
        self.session.append(action)

    def undo(self) -> Action | None:
        return self.session.pop() if self.session else None

    def clear_session(self) -> None:
        self.session, self.expect_clear = [], False

    def clear_hard(self) -> None:
        """The next save begins a new log."""
        self.expect_clear = True

    def save(self) -> None:
        if self.session or self.expect_clear:
            self._append(self.session, fresh=self.expect_clear)
        self.clear_session()

    def of_electrode(self, electrode: int) -> DataFrame:
        return for_electrode(self.log(), electrode)

    def neurons(self) -> DataFrame | None:
        """The consolidated table, None before the first consolidation."""
        return self._consolidated(self.log())

    def _consolidated(self, log: DataFrame) -> DataFrame | None:
        last = log.where("action = 'CONSOLIDATE'").orderBy(F.desc("seq")).limit(1).collect()
        return self.spark.read.parquet(f"{self.root}/{last[0]['version']}") if last else None

    def consolidate(self, raw: DataFrame, trains: DataFrame | None = None) -> DataFrame:
        """Applies what was saved since the last CONSOLIDATE to the consolidated neurons (to `raw`, all actions, the first
        time), writes a new table and then the marker that names it; without new actions nothing is written. A write
        that fails leaves the version before it in force; where another editor was faster, it is done again on top of that."""
        while True:
            base, parts = self.version()
            log = self._rows(parts)
            actions, have = self._read(log), self._consolidated(log)
            last = max((i for i, a in enumerate(actions, 1) if a.action == "CONSOLIDATE"), default=0)
            new = actions[last:]
            if not new:
                return have if have is not None else raw
            own = trains.where(F.col("seq") > last).withColumn("seq", F.col("seq") - last) if trains is not None else None
            version = f"neurons-{uuid.uuid4().hex}"
            out = replay(have if have is not None else raw, new, own)
            out.repartitionByRange("neuron_id").sortWithinPartitions("neuron_id", "spike_time").write.parquet(f"{self.root}/{version}")
            if self._append([Action("CONSOLIDATE")], version, after=base):
                return self.spark.read.parquet(f"{self.root}/{version}")


def train_projections(trains: DataFrame, projections: DataFrame) -> DataFrame:
    """trains (electrode, neuron_id, spike_time) with the projections (electrode, spike_time, any others) of their events:
    joined on exact times; events without projections are left out."""
    return trains.join(projections, ["electrode", "spike_time"])


class Preview:
    """What an action would make of one electrode's neurons (neuron_id, spike_time, pc, any others), without touching the
    table: each step is a frame on the one before it, undo goes back one."""

    def __init__(self, trains: DataFrame, projections: DataFrame, electrode: int, n_samples: float, tau: int = 30):
        own = train_projections(trains.where(F.col("electrode") == electrode), projections.where(F.col("electrode") == electrode))
        self.frames, self.n_samples, self.tau = [own.withColumn("status", F.lit(0))], n_samples, tau

    @property
    def events(self) -> DataFrame:
        return self.frames[-1]

    def undo(self) -> None:
        if len(self.frames) > 1:
            self.frames.pop()

    def report(self) -> DataFrame:
        """neuron_id, n, contamination, status."""
        stats = reports.contamination(self.events, self.tau, self.n_samples).select("neuron_id", "n", "contamination")
        return stats.join(self.events.groupBy("neuron_id").agg(F.max("status").alias("status")), "neuron_id")

    def apply(self, action: Action, label: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """The events after the action. RECLUSTER: label gives the pool's events with clust from 1; clusters take the ids that
        were put in, then new ones behind the largest. SHRINK: events that shrink() does not keep become a neuron with a new
        id and status -2. More than MAX_CLUSTERS neurons raise."""
        action.check()
        e = self.events
        counts = {r["neuron_id"]: r["count"] for r in e.groupBy("neuron_id").count().collect()}  # a row a neuron of one electrode
        if any(i not in counts for i in action.ids):
            raise ValueError("some ids are not there")
        mine, new = F.col("neuron_id").isin(action.ids), max(counts, default=0) + 1
        if action.action in ("KEEP", "DELETE"):
            out = e.withColumn("status", F.when(mine, F.lit(0 if action.action == "KEEP" else -2)).otherwise(F.col("status")))
        elif action.action == "MERGE":
            master = max(action.ids, key=lambda i: (counts[i], -i))
            out = e.withColumn("status", F.when(mine, F.lit(0)).otherwise(F.col("status"))).withColumn("neuron_id", F.when(mine, F.lit(master)).otherwise(F.col("neuron_id")).cast("int"))
        elif action.action == "RECLUSTER":
            pool = written(label(e.where(mine)), "pool")
            k = pool.agg(F.max("clust")).collect()[0][0] or 0
            if len(counts) + k - len(action.ids) > MAX_CLUSTERS:
                raise ValueError(f"more than {MAX_CLUSTERS} clusters")
            ids = (sorted(action.ids) + list(range(new, new + k)))[:k]
            pool = pool.where("clust > 0").withColumn("neuron_id", F.element_at(F.array(*map(F.lit, ids)), F.col("clust")).cast("int")).withColumn("status", F.lit(0))
            out = e.where(~mine).unionByName(pool.select(*e.columns))
        elif action.action == "SHRINK":
            if len(counts) >= MAX_CLUSTERS:
                raise ValueError(f"more than {MAX_CLUSTERS} clusters")
            keep = shrink(e.where(mine), "neuron_id", "spike_time", "pc", action.frac, action.contam, self.n_samples, tau=self.tau)
            cut = e.where(mine).join(keep.distinct(), ["neuron_id", "spike_time"])
            cut = cut.withColumn("status", F.when(F.col("keep"), 0).otherwise(-2)).withColumn("neuron_id", F.when(F.col("keep"), F.col("neuron_id")).otherwise(F.lit(new)).cast("int"))
            out = e.where(~mine).unionByName(cut.select(*e.columns))
        else:
            raise ValueError(f"{action.action} is no action of an editor")
        self.frames.append(out)
        return out


def contamination(times: Column, n_samples: float, tau: int = 30) -> Column:
    """Of a sorted array of times: v n_samples / (tau n^2), v = intervals in (0, tau]; 0 below two events."""
    gaps = F.zip_with(F.slice(times, 2, F.greatest(F.size(times) - 1, F.lit(0))), F.slice(times, 1, F.greatest(F.size(times) - 1, F.lit(0))), lambda b, a: b - a)
    v = F.size(F.filter(gaps, lambda g: (g > 0) & (g <= tau)))
    return F.when(F.size(times) < 2, F.lit(0.0)).otherwise(v * F.lit(float(n_samples)) / (F.lit(float(tau)) * F.size(times) * F.size(times)))


def contamination_of(times: np.ndarray, n_samples: float, tau: float = 30) -> float:
    g = np.diff(np.sort(times))
    return 0.0 if len(times) < 2 else float(((g > 0) & (g <= tau)).sum() * n_samples / (tau * len(times) ** 2))


def shrink(points: DataFrame, key: str, time: str, vec: str, frac: float, target: float, n_samples: float, neighbours: int = 5, tau: int = 30) -> DataFrame:
    """key, time, keep: the densest part of each cluster. Points are ranked by the distance to their 5th neighbour, the first
    floor(frac n) are considered, and of those the longest prefix found by halving whose contamination is below target
    stays; all others are the complement. Vectors meet in bounded parts; of a whole cluster only a time and a distance a point come
    together."""
    ship(points.sparkSession)
    kind = {f.name: f.dataType.simpleString() for f in points.schema}
    rows = written(points.select(key, time, F.col(vec).alias("v"), F.monotonically_increasing_id().alias("id")), "shrink")
    scored = rows.select(key, time, "id").join(parts.nth_distance(rows.select(key, "id", "v"), key, neighbours), "id").select(key, time, "d2")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        d, t = frame["d2"].to_numpy(), frame[time].to_numpy()
        order = np.lexsort((t, d))[: int(np.floor(frac * len(d)))]
        low, high = 0, len(order)
        if contamination_of(t[order], n_samples, tau) < target:
            low = high
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if contamination_of(t[order[:mid]], n_samples, tau) < target else (low, mid)
        keep = np.zeros(len(d), bool)
        keep[order[:low]] = True
        return pd.DataFrame({key: frame[key], time: t, "keep": keep})

    return scored.groupBy(key).applyInPandas(run, f"{key} {kind[key]}, {time} {kind[time]}, keep boolean")
