"""Exact threshold join of vectors: all pairs nearer than a bound, found cell by cell.

A bounded number of rows are pivots. Every row has its home in the cell of the nearest pivot and visits the cells in which a
row near enough could have its home: with x at home with c, and t the bound, a row nearer than t to x can be at home with p
only if |xp| - |xc| < 2t and |xp| < t + radius of p's cell. Of two cells the later one receives the visit, so a pair meets once.

Cells that follow one another are one block of at most BLOCK rows at home, a larger cell is cut into blocks. A row goes to a block once, however
many of its cells it visits, and the visitors of a block are dealt into slices of GUESTS blocks' rows, each of which meets a copy of the
block: what a task sorts and holds is bounded, also where a third of all rows is one cell. Visitors are counted first, so that the
tasks that send rows are as many as the rows sent ask for. Within a block a visitor meets the cells that it visits, and of a cell only rows whose
distances to the pivot differ by less than t from its own.

There are about as many cells as the root of the number of rows, so where rows near each other are few the pairs that are compared grow with
its power 3/2. Where nothing can be told apart by distances to pivots (independent directions in many dimensions and a bound
near the usual distance) every cell is visited by all, and the join is that of all pairs in slices; up to 16 BLOCK rows each row is sent about
11 times, beyond that as often as there are blocks, and the pairs are quadratic.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dot, to_double
from ..session import ship
from .tables import drop, written

MOST_PIVOTS, CHUNK, AT_ONCE = 4_096, 500, 20_000
# Rows at home in a block (at most, at least, and blocks until then), bytes of its vectors, visitors of a slice in blocks, rows that one task sends.
BLOCK, LEAST, BLOCKS, BLOCK_BYTES, GUESTS, SENT = 40_000, 1_000, 16, 1 << 25, 2, 100_000
HOST, COPY, GUEST = 0, 1, 2


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows, shorter ones filled with zeros."""
    size = np.asarray(column.value_lengths())
    flat = np.asarray(column.flatten(), float)
    if (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width))
    at = np.repeat(np.arange(len(size)), size)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * x @ y.T, 0))


class Cells:
    """Pivots, and of each cell the radius and its blocks: bounded tables that go to every task."""

    def __init__(self, rows: DataFrame, bound: float, pivots: int | None, part_rows: int | None = None):
        self.bound = bound
        n, width, longest = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.max(F.sqrt(dot(F.col("v"), F.col("v")))), F.lit(0.0))).collect()[0]
        wanted = max(1, min(MOST_PIVOTS, math.isqrt(max(n - 1, 0)) + 1)) if pivots is None else pivots
        chosen = rows.orderBy(F.xxhash64("id"), "id").limit(wanted).select("v").toArrow().column(0).combine_chunks()
        self.width, self.pivots = width, _matrix(chosen, width) if len(chosen) else np.zeros((1, width))
        self.slack = 1e-6 * longest  # distances by products are good to about 1e-7 of the vectors' lengths
        self.part_rows = part_rows or max(1, min(BLOCK, max(LEAST, n // BLOCKS), BLOCK_BYTES // (8 * max(width, 1))))
        # Single precision where what its rounding lets through beyond the bound is little.
        self.kind, self.scale, self.margin = np.float64, 1.0, (width + 4) * 2.0**-51
        if (width + 4) * 2.0**-21 * (longest / bound) ** 2 < 0.1:
            self.kind, self.scale, self.margin = np.float32, 1 / bound, (width + 4) * 2.0**-22
        self.least = -0.5 * (bound * self.scale) ** 2 * (1 + 1e-6)

    def factors(self, v: np.ndarray, guest: bool) -> np.ndarray:
        """Rows whose products, guest with home, are above `least` for every pair nearer than the bound: minus half the squared distance,
        of the scaled vectors, and a margin for rounding."""
        x = v * self.scale
        half = ((x * x).sum(1) * (0.5 - 0.5 * self.margin))[:, None]
        one = np.ones_like(half)
        return np.concatenate((x, -half, one) if guest else (x, one, -half), 1).astype(self.kind)

    def home(self, rows: DataFrame) -> DataFrame:
        """rows (id, v) with cell and r, the distance to its pivot."""
        pivots, width = self.pivots, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, CHUNK):
                    part = batch.slice(at, CHUNK)
                    d = _distances(_matrix(part.column(1), width), pivots)
                    cell = d.argmin(1)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(cell)), cell])], ["id", "v", "cell", "r"])

        ship(rows.sparkSession)
        placed = written(rows.mapInArrow(run, "id long, v array<double>, cell int, r double"), "homes")
        sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("r").alias("radius")).collect()  # a row a pivot
        self.radius, self.sizes = np.full(len(self.pivots), -np.inf), np.zeros(len(self.pivots), int)
        for s in sizes:
            self.radius[s["cell"]], self.sizes[s["cell"]] = s["radius"], s["n"]
        # Of each cell the first block and the number of blocks: several for a large cell, one that others share for a small one.
        self.block, self.parts, used, at = np.zeros(len(self.pivots), int), np.maximum(-(-self.sizes // self.part_rows), 1), 0, 0
        for c, n in enumerate(self.sizes.tolist()):
            if used and used + n > self.part_rows:
                at, used = at + 1, 0
            self.block[c], used = at, used + n
            if self.parts[c] > 1:
                at, used = at + int(self.parts[c]), 0
        return placed

    def visits(self, x: np.ndarray, cell: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, cell and distance to its pivot of each visit to a later cell."""
        d = _distances(x, self.pivots)
        near = (d < self.bound + self.radius[None] + self.slack) & (d - r[:, None] < 2 * self.bound + self.slack)
        near &= np.arange(len(self.pivots))[None] > cell[:, None]
        row, to = np.nonzero(near)
        return row, to, d[row, to]


def _routed(placed: DataFrame, cells: Cells) -> DataFrame:
    """id, v, cell, r with block, where a row is at home, and later: the blocks that it visits, those of its own cell that follow and
    those with a later cell that it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                b = batch.slice(at, CHUNK)
                cell, r, ids = np.asarray(b.column(2)), np.asarray(b.column(3)), np.asarray(b.column(0))
                own = cells.block[cell] + (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64) % cells.parts[cell]
                row, to, _ = cells.visits(_matrix(b.column(1), cells.width), cell, r)
                row, to = np.concatenate((np.arange(len(ids)), row)), np.concatenate((cell, to))
                i = np.repeat(np.arange(len(row)), cells.parts[to])
                nth = np.arange(len(i)) - np.repeat(np.cumsum(cells.parts[to]) - cells.parts[to], cells.parts[to])
                there = np.zeros((len(ids), int((cells.block + cells.parts).max())), bool)
                there[row[i], cells.block[to[i]] + nth] = True
                row, to = np.nonzero(there & (np.arange(there.shape[1])[None] > own[:, None]))
                later = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(ids) + 1)).astype(np.int32)), pa.array(to.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own.astype(np.int32)), later], ["id", "v", "cell", "r", "block", "later"])

    return written(placed.mapInArrow(run, "id long, v array<double>, cell int, r double, block int, later array<int>"), "routed")


def _meetings(routed: DataFrame, cells: Cells) -> DataFrame:
    """unit, role, id, v, cell, r, sorted within the unit's partition: a unit is a block and one slice of its visitors. Roles: HOST, at home
    and in the first slice, where the block meets itself too; COPY, at home in a further slice; GUEST."""
    guests = routed.select(F.explode("later").alias("block")).groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    rows = routed.groupBy("block").agg(F.count(F.lit(1)).alias("homes")).join(guests, "block", "left").orderBy("block").collect()  # a row a block
    slices, table, first, sent = GUESTS * cells.part_rows, [], 0, 0
    for r in rows:
        n = max(1, -(-(r["n"] or 0) // slices))
        table.append((r["block"], first, n))
        first, sent = first + n, sent + r["homes"] * n + (r["n"] or 0)
    units = F.broadcast(routed.sparkSession.createDataFrame(table, "block int, first int, slices int"))
    routed = routed.repartition(max(1, -(-sent // SENT)), F.xxhash64("id"))
    own = F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda i: F.struct((F.col("first") + i).alias("unit"), F.when(i == 0, HOST).otherwise(COPY).alias("role")))
    one = F.array(F.struct((F.col("first") + F.pmod(F.xxhash64("id"), F.col("slices")).cast("int")).alias("unit"), F.lit(GUEST).alias("role")))
    there = routed.select("id", "v", "cell", "r", F.posexplode(F.concat(F.array("block"), "later")).alias("nth", "block")).join(units, "block")
    sent = there.select("id", "v", "cell", "r", F.explode(F.when(F.col("nth") == 0, own).otherwise(one)).alias("to")).select("to.unit", "to.role", "id", "v", "cell", "r")
    return sent.repartitionById(max(1, min(first, 20_000)), "unit").sortWithinPartitions("unit", "role", "cell", "r")


class _Home:
    """The rows of a block in order of cell and distance to its pivot."""

    def __init__(self, held: list[tuple], cells: Cells):
        rows = tuple(np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((rows[3], rows[2]))
        self.rows = tuple(x[order] for x in rows)
        self.cells, self.start = np.unique(self.rows[2], return_index=True)
        self.end = np.append(self.start[1:], len(order))
        self.factors = cells.factors(self.rows[1], False)


def _compare(meetings: DataFrame, cells: Cells) -> DataFrame:
    """id_a < id_b, d2: a block is held, visitors pass in batches behind it."""
    bound, slack, width, limit = cells.bound, cells.slack, cells.width, cells.bound**2
    schema = pa.schema([("id_a", pa.int64()), ("id_b", pa.int64()), ("d2", pa.float64())])

    def found(home: _Home, guest: tuple) -> Iterator[tuple]:
        """Rows of guest and home that may be near, AT_ONCE at most."""
        _, v, cell, r, _ = guest
        hr = home.rows[3]
        for at in range(0, len(v), CHUNK):
            part = slice(at, at + CHUNK)
            gv, gc, gr = v[part], cell[part], r[part]
            left, d = cells.factors(gv, True), _distances(gv, cells.pivots[home.cells])
            near = (d < bound + cells.radius[home.cells][None] + slack) & (d - gr[:, None] < 2 * bound + slack) & (home.cells[None] > gc[:, None])
            near |= home.cells[None] == gc[:, None]
            for k in np.flatnonzero(near.any(0)):
                g, lo, hi = np.flatnonzero(near[:, k]), home.start[k], home.end[k]
                low = lo + np.searchsorted(hr[lo:hi], d[g, k].min() - bound - slack)
                high = lo + np.searchsorted(hr[lo:hi], d[g, k].max() + bound + slack, side="right")
                if low == high:
                    continue
                few = left if len(g) == len(left) else left[g]
                for step in range(low, high, 4 * CHUNK):
                    right = home.factors[step : min(step + 4 * CHUNK, high)]
                    flat = np.flatnonzero(few @ right.T > cells.least)
                    for j in range(0, len(flat), AT_ONCE):
                        x, y = np.divmod(flat[j : j + AT_ONCE], len(right))
                        yield at + g[x], step + y

    def met(home: _Home, guest: tuple, same: bool) -> Iterator[pa.RecordBatch]:
        out, n = [], 0
        for g, h in found(home, guest):
            x = guest[1][g] - home.rows[1][h]
            a, b, d2 = guest[0][g], home.rows[0][h], (x * x).sum(1)
            ok = (d2 < limit) & (guest[4][g] == home.rows[4][h])
            if same:
                ok &= (a < b) | (guest[2][g] != home.rows[2][h])
            out.append((np.minimum(a, b)[ok], np.maximum(a, b)[ok], d2[ok]))
            n += int(ok.sum())
            if n >= AT_ONCE:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], schema=schema)
                out, n = [], 0
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, home, itself = None, [], None, False

        def rows(b: pa.RecordBatch) -> tuple:
            return np.asarray(b.column(2)), _matrix(b.column(3), width), np.asarray(b.column(4)), np.asarray(b.column(5)), np.asarray(b.column(3).value_lengths())

        def alone() -> Iterator[pa.RecordBatch]:
            if itself:
                yield from met(home, home.rows, True)

        for batch in batches:
            unit, role = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            cut = np.flatnonzero((np.diff(unit) != 0) | (np.diff(role) != 0)) + 1
            for lo, hi in zip([0, *cut], [*cut, len(unit)], strict=True):
                if lo == hi:
                    continue
                some = rows(batch.slice(lo, hi - lo))
                if unit[lo] != key:
                    if held and home is None:
                        home = _Home(held, cells)
                        yield from alone()
                    key, held, home, itself = unit[lo], [], None, role[lo] == HOST
                if role[lo] != GUEST:
                    held.append(some)
                    continue
                if home is None:
                    if not held:
                        continue  # a part whose hash drew no row
                    home = _Home(held, cells)
                    yield from alone()
                yield from met(home, some, False)
        if held and home is None:
            home = _Home(held, cells)
            yield from alone()

    return meetings.mapInArrow(run, "id_a long, id_b long, d2 double")


def near_pairs(traces: DataFrame, id_col: str, vec: str, d2_below: float, pivots: int | None = None, part_rows: int | None = None) -> DataFrame:
    """id_a < id_b, d2 for every pair with a squared distance below the bound, each once.

    Ids are whole numbers and unique. Vectors that are null or hold a null or a value that is not finite are near nothing; vectors of different length
    are not compared. Identical vectors are pairs at distance 0. No rows: no pairs. Columns of other names are ignored.
    """
    spark = traces.sparkSession
    v = to_double(F.col(vec))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = traces.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("v").isNotNull() & ~F.exists("v", odd))
    if d2_below <= 0:
        return spark.createDataFrame([], "id_a long, id_b long, d2 double")
    rows = written(rows, "near-rows")
    cells = Cells(rows, math.sqrt(d2_below), pivots, part_rows)
    placed = cells.home(rows)
    routed = _routed(placed, cells)
    drop(rows, placed)
    return _compare(_meetings(routed, cells), cells)
