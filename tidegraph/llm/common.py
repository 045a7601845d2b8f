"""What the corpus operators share: tables written to the shared folder, vectorised word hashes, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tables import shared
from ..session import ship

# ---------------------------------------------------------------------------------------------- shared tables


PART_BYTES = 8 << 20
WRITING = {  # holds while a table is written: shuffle files go when the execution ends, Python workers get small batches
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(PART_BYTES),
}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one in the warehouse where it is unset."""
    return shared(spark, "_tidegraph")


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


@contextmanager
def writing(spark: SparkSession) -> Iterator[None]:
    """Settings for what is executed within; they are put back as they were."""
    before = {k: spark.conf.get(k, None) for k in WRITING}
    for k, v in WRITING.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """df, written once as Parquet in the shared folder and read back: cuts the lineage and survives lost executors. The
    table goes when discard() is called for it, or else when the application ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    with writing(spark):
        df.write.parquet(path)
    fs, p = _file_system(spark, path)
    fs.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._table = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that materialize() gave and that nothing reads any more."""
    for df in tables:
        if path := getattr(df, "_table", None):
            fs, p = _file_system(df.sparkSession, path)
            fs.delete(p, True)
            fs.cancelDeleteOnExit(p)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(names: Iterable[str], base: str) -> str:
    """base, or base with as many underscores before it as it takes to differ from names (Spark ignores case)."""
    taken = {n.lower() for n in names}
    while base.lower() in taken:
        base = "_" + base
    return base


def parts(batch: pa.RecordBatch, rows: int = 400, size: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """batch in pieces of at most `rows` rows and about `size` bytes (a row at least), which bounds the temporaries of what
    works on them. Spark itself bounds a batch by bytes."""
    if batch.num_rows > 1 and (batch.num_rows > rows or batch.nbytes > size):
        half = batch.num_rows // 2
        yield from parts(batch.slice(0, half), rows, size)
        yield from parts(batch.slice(half), rows, size)
    elif batch.num_rows:
        yield batch


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, rows: int = 400) -> DataFrame:
    """fn over the rows of df in parts(), empty ones left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, rows):
                if (out := fn(part)) is not None:
                    yield out

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


# ------------------------------------------------------------------------------------------------ word hashes

_SLICE = 1 << 18  # bytes hashed at once; bounds the temporaries whatever the length of a text
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int) -> np.ndarray:
    out = np.full(_SLICE + 2, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW, _INV = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
SPACES = b" \t\n\x0b\x0c\r"


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _slice_words(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    space = np.ones(len(a) + 2, np.int8)
    space[1:-1] = _IS_SPACE[a]
    turn = np.diff(space)
    s, e = np.flatnonzero(turn == -1), np.flatnonzero(turn == 1)
    p = np.zeros(len(a) + 1, np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * _POW[: len(a)], out=p[1:])
    return mix((p[e] - p[s]) * _INV[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), s, e


def _long_word(a: bytes) -> int:
    """A word longer than a slice, piece by piece."""
    h = np.uint64(len(a))
    with np.errstate(over="ignore"):
        for i in range(0, len(a), _SLICE):
            x = np.frombuffer(a[i : i + _SLICE], np.uint8).astype(np.uint64) + np.uint64(1)
            h = mix(np.array([h + (x * _POW[: len(x)]).sum(dtype=np.uint64)], np.uint64))[0]
    return int(h)


def words(buf: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of each run of bytes that holds no ASCII white space, in slices cut at white space."""
    parts, at, n = [], 0, len(buf)
    while at < n:
        end = min(at + _SLICE, n)
        if end < n and buf[end : end + 1] not in (b" ", b"\n") and not _IS_SPACE[buf[end]]:
            cut = max(buf.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut >= at:
                end = cut + 1
            else:  # one word fills the slice
                while end < n and not _IS_SPACE[buf[end]]:
                    end += 1
                parts.append((np.array([_long_word(buf[at:end])], np.uint64), np.array([at]), np.array([end])))
                at = end
                continue
        h, s, e = _slice_words(np.frombuffer(buf, np.uint8, end - at, at))
        parts.append((h, s + at, e + at))
        at = end
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def hashes(buf: bytes, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hashes of the stretches s to e of buf, equal to those that words() gives where they are words."""
    out, i = np.empty(len(s), np.uint64), 0
    while i < len(s):
        j = int(np.searchsorted(e, s[i] + _SLICE, side="right"))
        if j <= i:  # longer than a slice
            out[i] = _long_word(buf[s[i] : e[i]])
            i += 1
            continue
        base = int(s[i])
        a = np.frombuffer(buf, np.uint8, int(e[j - 1]) - base, base)
        p = np.zeros(len(a) + 1, np.uint64)
        np.cumsum((a.astype(np.uint64) + np.uint64(1)) * _POW[: len(a)], out=p[1:])
        x, y = s[i:j] - base, e[i:j] - base
        out[i:j] = mix((p[y] - p[x]) * _INV[x] + (y - x).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out


def grams(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """A hash for each run of k word hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    rng = np.random.default_rng(1000 * k + seed)
    out = np.zeros(n, np.uint64)
    for j, m in enumerate(rng.integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)):
        out += h[j : j + n] * m
    return mix(out)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def joined(texts: list[bytes | None]) -> tuple[bytes, np.ndarray]:
    """The texts with a line feed between, and where each begins; the end of all at last."""
    parts = [x or b"" for x in texts]
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in parts], out=starts[1:])
    return b"\n".join(parts), starts


def list_array(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


# --------------------------------------------------------------------------------------- connected components


def connected_components(edges: DataFrame, tag: str) -> DataFrame:
    """(id, component) for every id that an edge (u, v) names; component is the smallest id that links reach.

    Each round hooks every component to the smallest one next to it, follows those hooks to their end, and keeps only
    the edges that still join two components, so both edges and rounds shrink fast. Nothing is gathered on the driver
    but whether edges are left. A hub is no bottleneck: minima are taken before the shuffle and the joins can split. The
    tables of a round are deleted as soon as the next one is written.
    """
    edges = materialize(edges.select("u", "v").where("u <> v").distinct(), f"{tag}-edges")
    labels = materialize(edges.select(F.explode(F.array("u", "v")).alias("id")).distinct().select("id", F.col("id").alias("component")), f"{tag}-labels")
    while not edges.isEmpty():
        hook = edges.select(F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("v").alias("b")), F.struct(F.col("v").alias("a"), F.col("u").alias("b")))).alias("x"))
        hook = materialize(hook.groupBy(F.col("x.a").alias("a")).agg(F.least(F.col("a"), F.min("x.b")).alias("to")), f"{tag}-hook")
        while True:  # follow hooks: each pass doubles the distance
            far = hook.select(F.col("a").alias("to"), F.col("to").alias("far"))
            jump = materialize(hook.join(far, "to").select("a", F.col("far").alias("to"), (F.col("far") < F.col("to")).alias("moved")), f"{tag}-jump")
            moved = not jump.where("moved").isEmpty()
            discard(hook)
            hook = jump.drop("moved")
            hook._table = jump._table
            if not moved:
                break
        old = labels, edges
        labels = materialize(labels.join(hook.withColumnRenamed("a", "component"), "component", "left").select("id", F.coalesce("to", "component").alias("component")), f"{tag}-labels")
        u, v = hook.toDF("u", "cu"), hook.toDF("v", "cv")
        edges = edges.join(u, "u").select("v", "cu").join(v, "v").where("cu <> cv")
        edges = materialize(edges.select(F.least("cu", "cv").alias("u"), F.greatest("cu", "cv").alias("v")).distinct(), f"{tag}-edges")
        discard(*old, hook)
    discard(edges)
    return labels
