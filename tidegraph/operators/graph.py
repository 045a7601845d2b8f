"""Thresholded graphs within groups: components, keepers, merge trees, duplicate chains, removal actions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import l2_normalise, squared_l2
from ..session import ship
from . import parts
from .nearby import near_pairs
from .tables import drop, written


def distances(traces: DataFrame, group: str, id_col: str, vec: str, normalise: bool = False) -> DataFrame:
    """group, id_a < id_b, d2 (squared)."""
    t = traces.withColumn(vec, l2_normalise(F.col(vec))) if normalise else traces
    a, b = (t.select(group, F.col(id_col).alias(f"id_{s}"), F.col(vec).alias(f"v{s}")) for s in "ab")
    return a.join(b, group).where("id_a < id_b").select(group, "id_a", "id_b", squared_l2(F.col("va"), F.col("vb")).alias("d2"))


def distances_by_parts(traces: DataFrame, group: str, id_col: str, vec: str) -> DataFrame:
    """distances() of large groups, which are cut into parts that meet in bounded tasks."""
    kinds = {f.name: f.dataType.simpleString() for f in traces.schema}
    rows = traces.select(group, F.col(id_col).alias("id"), F.col(vec).alias("v")).where("id is not null")
    return parts.distances(rows, group, {group: kinds[group], "id": kinds[id_col]})


def neighbour_distances(traces: DataFrame, adjacency: DataFrame, electrode: str, id_col: str, vec: str) -> DataFrame:
    """id_a, id_b, d2 between different electrodes that are adjacent (electrode, neighbor)."""
    a, b = (traces.select(F.col(electrode).alias(f"e{s}"), F.col(id_col).alias(f"id_{s}"), F.col(vec).alias(f"v{s}")) for s in "ab")
    near = adjacency.select(F.col("electrode").alias("ea"), F.col("neighbor").alias("eb")).where("ea < eb").distinct()
    return near.join(a, "ea").join(b, "eb").select("ea", "eb", "id_a", "id_b", squared_l2(F.col("va"), F.col("vb")).alias("d2"))


def edges(d: DataFrame, threshold: float, link_identical: bool = False) -> DataFrame:
    """Pairs nearer than the threshold; identical ones (distance 0) are no edge unless asked for."""
    return d.where((F.col("d2") < threshold) & ((F.col("d2") > 0) | F.lit(link_identical)))


def components(nodes: DataFrame, links: DataFrame, group: str, id_col: str) -> DataFrame:
    """group, id, component (smallest id). Each round hooks every component to the smallest next to it, follows the hooks
    to their end and keeps only the links that still join two, so links and rounds shrink; only components that have links
    left are touched. One flag a round reaches the driver."""
    e = links.select(group, F.col("id_a").alias("u"), F.col("id_b").alias("v")).where("u <> v").distinct()
    e = written(e, "links")
    label = written(e.select(group, F.explode(F.array("u", "v")).alias("id")).distinct().withColumn("component", F.col("id")), "labels")
    while not e.isEmpty():
        both = e.unionByName(e.select(group, F.col("v").alias("u"), F.col("u").alias("v")))
        hook = written(both.groupBy(group, F.col("u").alias("at")).agg(F.least("at", F.min("v")).alias("to")), "hooks")
        while True:
            far = hook.select(group, F.col("at").alias("to"), F.col("to").alias("far"))
            jump = written(hook.join(far, [group, "to"]).select(group, "at", F.col("far").alias("to"), (F.col("far") < F.col("to")).alias("moved")), "hooks")
            drop(hook)
            hook, moved = jump, not jump.where("moved").isEmpty()
            if not moved:
                break
        hook = hook.drop("moved")
        old = label, e, jump
        label = written(label.join(hook.withColumnRenamed("at", "component"), [group, "component"], "left").select(group, "id", F.coalesce("to", "component").alias("component")), "labels")
        u, v = hook.select(group, F.col("at").alias("u"), F.col("to").alias("cu")), hook.select(group, F.col("at").alias("v"), F.col("to").alias("cv"))
        e = e.join(u, [group, "u"]).join(v, [group, "v"]).where("cu <> cv")
        e = written(e.select(group, F.least("cu", "cv").alias("u"), F.greatest("cu", "cv").alias("v")).distinct(), "links")
        drop(*old)
    own = nodes.select(group, F.col(id_col).alias("id")).distinct()
    return own.join(label, [group, "id"], "left").select(group, "id", F.coalesce("component", "id").alias("component"))


def keepers(label: DataFrame, counts: DataFrame, group: str) -> DataFrame:
    """label (group, id, component) with n and keeper: the member with the most events, the smaller id on ties."""
    d = label.join(counts, "id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    best = d.groupBy(group, "component").agg(F.max_by("id", F.struct(F.col("n"), -F.col("id"))).alias("keeper"), F.count(F.lit(1)).alias("members"))
    return d.join(best, [group, "component"])


def merge_actions(kept: DataFrame, group: str, action: str = "AUTO_MERGE") -> DataFrame:
    """group, action, master_id, ids: one row a component of two or more, ids in order without the master."""
    d = kept.where((F.col("members") > 1) & (F.col("id") != F.col("keeper")))
    return d.groupBy(group, F.col("keeper").alias("master_id")).agg(F.array_sort(F.collect_set("id")).alias("ids")).withColumn("action", F.lit(action))


def duplicates_by_master(pairs_: DataFrame) -> DataFrame:
    """master_id, ids: all losers of a master over all comparisons, in order."""
    return pairs_.groupBy("master_id").agg(F.array_sort(F.collect_set("loser_id")).alias("ids"))


def shorten_chains(links: DataFrame) -> DataFrame:
    """(master_id, loser_id) with every master that lost itself replaced by its own, to the end; cycles end at their start.
    Each pass doubles the distance that is followed."""
    cur = written(links.select("master_id", "loser_id").distinct(), "chain")
    for _ in range(64):
        up = cur.groupBy(F.col("loser_id").alias("master_id")).agg(F.min("master_id").alias("top"))
        new = cur.join(up, "master_id", "left").select(F.when(F.col("top") == F.col("loser_id"), F.col("master_id")).otherwise(F.coalesce("top", "master_id")).alias("master_id"), "loser_id", F.col("master_id").alias("was"))
        new = written(new, "chain")
        moved = not new.where("was <> master_id").isEmpty()
        cur = new.drop("was")
        if not moved:
            break
    return cur


class MergeTree:
    """Single-linkage merges of one group: nodes joined in order of distance, ties by ids."""

    def __init__(self, nodes: list[int], links: list[tuple[float, int, int]]):
        self.lead = {n: n for n in nodes}
        self.members = {n: [n] for n in nodes}
        self.merges: list[tuple[float, list[int], list[int]]] = []
        for d, a, b in sorted(links):
            x, y = self._root(a), self._root(b)
            if x != y:
                x, y = min(x, y), max(x, y)
                self.merges.append((d, list(self.members[x]), list(self.members[y])))
                self.lead[y] = x
                self.members[x] = sorted(self.members[x] + self.members.pop(y))

    def _root(self, n: int) -> int:
        while self.lead[n] != n:
            n = self.lead[n]
        return n

    def cut(self, threshold: float) -> list[list[int]]:
        """The parts whose inner merges all lie below the threshold."""
        part = {n: n for m in self.members.values() for n in m}
        for d, a, b in self.merges:
            if d < threshold:
                ends = part[a[0]], part[b[0]]
                for n in part:
                    if part[n] in ends:
                        part[n] = min(ends)
        out: dict[int, list[int]] = {}
        for n, p in sorted(part.items()):
            out.setdefault(p, []).append(n)
        return list(out.values())

    def forest(self, singles: bool = True) -> list[list[int]]:
        return [m for _, m in sorted(self.members.items()) if singles or len(m) > 1]

    def thresholds(self) -> list[float]:
        return [d for d, _, _ in self.merges]

    def rectangles(self) -> list[tuple[float, float, int, int]]:
        """(low, high, first, end) of every part that holds between two thresholds: it is merged at low (0 for single nodes) and
        taken in at high (a root: one above its own), and covers places first..end of an order in which parts lie together.
        Roots come by their smallest member, each before what it was merged from, the left side first."""
        made = {tuple(sorted(a + b)): (d, tuple(a), tuple(b)) for d, a, b in self.merges}
        out: list[tuple[float, float, int, int]] = []
        todo, at = [], 0
        for _, members in sorted(self.members.items()):
            part = tuple(members)
            todo.append((part, (made[part][0] if part in made else 0.0) + 1, at))
            at += len(part)
        todo.reverse()
        while todo:
            part, high, first = todo.pop()
            low, left, right = made.get(part, (0.0, (), ()))
            out.append((low, high, first, first + len(part)))
            if left:
                todo += [(right, low, first + len(left)), (left, low, first)]
        return out

    def depth(self) -> int:
        level = dict.fromkeys(self.lead, 0)
        for _, a, b in self.merges:
            top = 1 + max(level[n] for n in a + b)
            for n in a + b:
                level[n] = top
        return max(level.values(), default=0)


def dendrogram(nodes: DataFrame, links: DataFrame, group: str, id_col: str) -> DataFrame:
    """group, step, threshold, left, right (members, in order) of every merge; a group is one channel's few clusters."""
    ship(nodes.sparkSession)
    kind = {f.name: f.dataType.simpleString() for f in nodes.schema}[group]

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a):
            return pd.DataFrame({group: [], "step": [], "threshold": [], "left": [], "right": []})
        t = MergeTree(a[id_col].tolist(), list(zip(b["d2"], b["id_a"], b["id_b"])) if len(b) else [])
        rows = [(a[group].iloc[0], i + 1, d, x, y) for i, (d, x, y) in enumerate(t.merges)]
        return pd.DataFrame(rows, columns=[group, "step", "threshold", "left", "right"])

    links = links.select(*[F.col(c).alias(c) for c in links.columns])  # both may come from one table
    return nodes.select(group, id_col).distinct().groupBy(group).cogroup(links.groupBy(group)).applyInPandas(run, f"{group} {kind}, step int, threshold double, left array<long>, right array<long>")


def pair_duplicates(links: DataFrame, counts: DataFrame) -> DataFrame:
    """pair, master_id, loser_id from links (pair, id_a, id_b): of each component of a pair of electrodes the member with the
    most events stays."""
    links = written(links, "pair-links")
    touched = links.select("pair", F.explode(F.array("id_a", "id_b")).alias("id")).distinct()
    kept = keepers(components(touched, links, "pair", "id"), counts, "pair")
    return kept.where("id <> keeper").select("pair", F.col("keeper").alias("master_id"), F.col("id").alias("loser_id"))


def across_pairs(electrodes: DataFrame, across: DataFrame, within: DataFrame, counts: DataFrame, changed: DataFrame | None = None) -> DataFrame:
    """e1, e2, master_id, loser_id of the comparisons of all pairs of electrodes (electrode), each of which takes in what is linked
    within either one too; losers stay in other comparisons.

    across: e1 < e2, id_a, id_b; within: e, id_a, id_b. changed (e1, e2, id_a, id_b, linked): links within one electrode that this pair
    of electrodes sees otherwise. Most pairs have no link across and see nothing otherwise: what they find is what
    each of their electrodes finds alone, which is there once, with e2 null, not once a pair; spread() lays it out.
    """
    across, within = written(across.select("e1", "e2", "id_a", "id_b"), "across"), written(within.select("e", "id_a", "id_b"), "within")
    met = across.select("e1", "e2")
    if changed is not None:
        changed = written(changed.select("e1", "e2", "id_a", "id_b", "linked"), "changed")
        met = met.unionByName(changed.select("e1", "e2"))
    met = written(met.distinct(), "met")
    ends = met.select("e1", "e2", F.explode(F.array("e1", "e2")).alias("e"))
    own = ends.join(within, "e").select("e1", "e2", "id_a", "id_b")
    if changed is not None:
        own = own.join(changed, ["e1", "e2", "id_a", "id_b"], "left_anti").unionByName(changed.where("linked").drop("linked"))
    name = F.concat_ws("-", "e1", "e2").alias("pair")
    kind = electrodes.schema["electrode"].dataType
    end = lambda i: F.element_at(F.split("pair", "(?<=[0-9])-"), i).cast(kind)
    mixed = pair_duplicates(across.unionByName(own).select(name, "id_a", "id_b"), counts)
    mixed = mixed.select(end(1).alias("e1"), end(2).alias("e2"), "master_id", "loser_id")
    alone = pair_duplicates(within.select(F.col("e").cast("string").alias("pair"), "id_a", "id_b"), counts)
    alone = alone.select(F.col("pair").cast(kind).alias("e1"), "master_id", "loser_id")
    n = electrodes.select("electrode").distinct().count()
    busy = ends.groupBy(F.col("e").alias("e1")).agg(F.count(F.lit(1)).alias("partners"))
    alone = alone.join(busy, "e1", "left").where(F.coalesce("partners", F.lit(0)) < n - 1)  # some pair of it meets nothing
    return mixed.unionByName(alone.select("e1", F.lit(None).cast(kind).alias("e2"), "master_id", "loser_id"))


def spread(found: DataFrame, electrodes: DataFrame, met: DataFrame, block: int = 4_096) -> DataFrame:
    """pair, master_id, loser_id for each pair of electrodes by itself, from across_pairs(); met: the pairs (e1, e2) that have rows of
    their own or see links otherwise.

    What an electrode finds alone is laid out over the other electrodes, a block of them at a time, where it lies: pairs of electrodes are
    as many as the result and are not shuffled."""
    e = electrodes.select("electrode").distinct().select(F.col("electrode").alias("o"))
    blocks = e.groupBy(F.pmod(F.xxhash64("o"), F.lit(max(1, -(-e.count() // block)))).alias("block")).agg(F.collect_list("o").alias("others"))
    one = met.select("e1", "e2").distinct()
    partners = one.unionByName(one.select(F.col("e2").alias("e1"), F.col("e1").alias("e2"))).groupBy(F.col("e1").alias("e")).agg(F.collect_list("e2").alias("known"))
    name = F.concat_ws("-", "e1", "e2").alias("pair")
    alone = found.where("e2 is null").select(F.col("e1").alias("e"), "master_id", "loser_id").join(partners, "e", "left")
    known = F.array_append(F.coalesce("known", F.array().cast(partners.schema["known"].dataType)), F.col("e"))
    rest = alone.withColumn("known", known).crossJoin(blocks.select("others")).select("e", "master_id", "loser_id", F.explode(F.array_except("others", "known")).alias("o"))
    rest = rest.select(F.concat_ws("-", F.least("e", "o"), F.greatest("e", "o")).alias("pair"), "master_id", "loser_id")
    return found.where("e2 is not null").select(name, "master_id", "loser_id").unionByName(rest)


def trace_links(traces: DataFrame, electrode: str, id_col: str, vec: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Links of plain vectors: across (e1 < e2, id_a, id_b) and within (e, id_a, id_b) electrodes, by an exact threshold join."""
    d = written(edges(near_pairs(traces, id_col, vec, threshold), threshold), "near")
    where = traces.select(id_col, electrode)
    d = written(d.join(where.toDF("id_a", "ea"), "id_a").join(where.toDF("id_b", "eb"), "id_b"), "near-electrodes")
    across = d.where("ea <> eb").select(F.least("ea", "eb").alias("e1"), F.greatest("ea", "eb").alias("e2"), "id_a", "id_b")
    return across, d.where("ea = eb").select(F.col("ea").alias("e"), "id_a", "id_b")


def global_duplicates(traces: DataFrame, counts: DataFrame, electrode: str, id_col: str, vec: str, threshold: float) -> DataFrame:
    """across_pairs() of plain vectors."""
    return across_pairs(traces.select(F.col(electrode).alias("electrode")), *trace_links(traces, electrode, id_col, vec, threshold), counts)
