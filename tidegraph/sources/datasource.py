"""format("recording"): recordings as files of raw numbers, read and written by Spark in batches and as a stream.

A recording is a folder. Each file holds one block of samples of all its channels: a line of JSON that names each channel's run (electrode,
first sample, number of samples), then the runs' numbers end to end, little-endian. What has been written is what a commit's
manifest names; files of failed or repeated attempts are named by none and never read.

Reading: a partition is a few files, planned from the manifests alone. Bounds on sample and electrode, from the options
(start, stop, electrodes) or from pushed filters, drop files before a task is planned, and within a file only the bytes
of asked channels and samples are read. As a stream the offset is the number of manifests' blocks that have been read, and a
micro-batch takes up to `blocksPerBatch` of them.

Paths are anything that pyarrow's file systems reach from driver and executors: shared folders, object stores, HDFS.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.types import Row, StructType

from ..session import ship

SCHEMA = "electrode long, sample long, value double"
DTYPES = {"int16": "<i2", "float32": "<f4", "float64": "<f8"}
BLOCK, FILES_PER_PARTITION = 16_384, 4


def register(spark: SparkSession) -> SparkSession:
    """Makes format("recording") known to the session and lets filters reach it."""
    ship(spark)
    spark.dataSource.register(RecordingSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def _open(path: str):
    """File system and path within it."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", path))


@dataclass
class File(ds.InputPartition):
    """Files of one partition: (name, first sample, end)."""

    names: list[str]


@dataclass
class Bounds:
    start: int | None = None
    stop: int | None = None
    electrodes: frozenset[int] | None = None

    def meets(self, low: int, high: int) -> bool:
        return (self.start is None or high > self.start) and (self.stop is None or low < self.stop)

    def narrow(self, f: ds.Filter) -> bool:
        """Takes in a filter on sample or electrode; whether it did so in full."""
        name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
        if isinstance(f, ds.IsNotNull) and name in ("sample", "electrode"):
            return True  # they never are
        value = getattr(f, "value", None)
        if name == "sample" and isinstance(value, int):
            low = {ds.GreaterThan: value + 1, ds.GreaterThanOrEqual: value, ds.EqualTo: value}.get(type(f))
            high = {ds.LessThan: value, ds.LessThanOrEqual: value + 1, ds.EqualTo: value + 1}.get(type(f))
            if low is not None:
                self.start = low if self.start is None else max(self.start, low)
            if high is not None:
                self.stop = high if self.stop is None else min(self.stop, high)
            return low is not None or high is not None
        asked = {value} if isinstance(f, ds.EqualTo) else set(value) if isinstance(f, ds.In) else None
        if name == "electrode" and asked is not None and all(isinstance(v, int) for v in asked):
            self.electrodes = frozenset(asked) if self.electrodes is None else self.electrodes & asked
            return True
        return False


def manifests(path: str) -> list[dict]:
    """What has been committed, in the order of commits: files as (name, low, high, samples)."""
    from pyarrow import fs

    files, root = _open(path)
    found = files.get_file_info(fs.FileSelector(f"{root}/manifests", allow_not_found=True))
    out = []
    for name in sorted(f.path for f in found if f.path.endswith(".json")):
        with files.open_input_stream(name) as f:
            out.append(json.loads(f.read()))
    return out


def blocks(path: str) -> list[tuple[str, int, int, int]]:
    return [tuple(f) for m in manifests(path) for f in m["files"]]


def read_file(path: str, name: str, bounds: Bounds) -> Iterator[pa.RecordBatch]:
    """The asked samples of a file, a batch a channel: only their bytes are read."""
    files, root = _open(path)
    schema = pa.schema([("electrode", pa.int64()), ("sample", pa.int64()), ("value", pa.float64())])
    with files.open_input_file(f"{root}/{name}") as f:
        head_size = int(f.read(12))
        head = json.loads(f.read(head_size))
        kind, at = np.dtype(DTYPES[head["dtype"]]), 12 + head_size
        for electrode, first, n in head["runs"]:
            low = first if bounds.start is None else max(first, bounds.start)
            high = first + n if bounds.stop is None else min(first + n, bounds.stop)
            if low < high and (bounds.electrodes is None or electrode in bounds.electrodes):
                f.seek(at + (low - first) * kind.itemsize)
                values = np.frombuffer(f.read((high - low) * kind.itemsize), kind).astype(float)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(high - low, electrode, np.int64)), pa.array(np.arange(low, high)), pa.array(values)], schema=schema)
            at += n * kind.itemsize


def _bounds(options: dict[str, str]) -> Bounds:
    number = lambda k: int(options[k]) if options.get(k) else None
    return Bounds(number("start"), number("stop"), frozenset(map(int, options["electrodes"].split(","))) if options.get("electrodes") else None)


class RecordingSource(ds.DataSource):
    """Options: path; start, stop (samples) and electrodes ("1,4") to read; blockSize and dtype (int16, float32, float64) to write;
    blocksPerBatch to stream; filesPerPartition."""

    @classmethod
    def name(cls) -> str:
        return "recording"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> Reader:
        return Reader(dict(self.options))

    def streamReader(self, schema: StructType) -> StreamReader:
        return StreamReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(dict(self.options), [f.name for f in schema.fields], overwrite)


class Reader(ds.DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.bounds = options["path"], _bounds(options)
        self.each = int(options.get("filesperpartition") or options.get("filesPerPartition") or FILES_PER_PARTITION)

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:
        for f in filters:
            if not self.bounds.narrow(f):
                yield f

    def partitions(self) -> list[File]:
        names = [n for n, low, high, _ in blocks(self.path) if self.bounds.meets(low, high)]
        return [File(names[i : i + self.each]) for i in range(0, len(names), self.each)]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        for name in partition.names if partition else ():  # Spark asks once where there is no partition
            yield from read_file(self.path, name, self.bounds)


class StreamReader(ds.DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.bounds = options["path"], _bounds(options)
        self.step = int(options.get("blocksperbatch") or options.get("blocksPerBatch") or 0)
        self.at = 0

    def initialOffset(self) -> dict:
        return {"block": 0}

    def latestOffset(self) -> dict:
        there = len(blocks(self.path))
        self.at = min(there, self.at + self.step) if self.step else there
        return {"block": self.at}

    def partitions(self, start: dict, end: dict) -> list[File]:
        self.at = max(self.at, end["block"])  # after a restart offsets go on from the checkpoint's
        return [File([n]) for n, low, high, _ in blocks(self.path)[start["block"] : end["block"]] if self.bounds.meets(low, high)]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        for name in partition.names if partition else ():  # Spark asks once where there is no partition
            yield from read_file(self.path, name, self.bounds)

    def commit(self, end: dict) -> None:
        pass


@dataclass
class Written(ds.WriterCommitMessage):
    files: list[tuple[str, int, int, int]]


class Writer(ds.DataSourceWriter):
    """Rows in order of block, electrode and sample (see write()): a task holds one channel's run of a block, and its files carry
    names of their own."""

    def __init__(self, options: dict[str, str], names: list[str], overwrite: bool):
        self.path, self.names, self.overwrite = options["path"], names, overwrite
        self.size = int(options.get("blocksize") or options.get("blockSize") or BLOCK)
        self.dtype = options.get("dtype") or "float64"
        if self.dtype not in DTYPES:
            raise ValueError(f"dtype is one of {', '.join(DTYPES)}")

    def write(self, rows: Iterator[Row]) -> Written:
        files, root = _open(self.path)
        files.create_dir(f"{root}/data", recursive=True)
        kind, written = np.dtype(DTYPES[self.dtype]), []
        block, runs, parts = None, [], []

        def close() -> None:
            if runs:
                head = json.dumps({"dtype": self.dtype, "runs": runs}).encode()
                name = f"data/{block:012d}-{uuid.uuid4().hex}.bin"
                with files.open_output_stream(f"{root}/{name}") as f:
                    f.write(b"%12d" % len(head) + head)
                    for p in parts:
                        f.write(p)
                written.append((name, min(r[1] for r in runs), max(r[1] + r[2] for r in runs), sum(r[2] for r in runs)))

        def settle(electrode: int, first: int, values: list[float]) -> None:
            x = np.array(values)
            if kind.kind == "i":
                x = np.clip(np.rint(x), np.iinfo(kind).min, np.iinfo(kind).max)
            runs.append((electrode, first, len(values)))
            parts.append(x.astype(kind).tobytes())

        now, values = None, []
        for r in rows:
            electrode, sample, value = r["electrode"], r["sample"], r["value"]
            if now is None or electrode != now[0] or sample // self.size != block or sample != now[1] + len(values):
                if values:
                    settle(*now, values)
                if sample // self.size != block:
                    close()
                    block, runs, parts = sample // self.size, [], []
                now, values = (electrode, sample), []
            values.append(float("nan") if value is None else value)
        if values:
            settle(*now, values)
        close()
        return Written(written)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        files, root = _open(self.path)
        old = [f.path for f in files.get_file_info(fs.FileSelector(f"{root}/manifests", allow_not_found=True))] if self.overwrite else []
        found = sorted(f for m in messages if m is not None for f in m.files)
        files.create_dir(f"{root}/manifests", recursive=True)
        at = len(files.get_file_info(fs.FileSelector(f"{root}/manifests")))
        name = f"{root}/manifests/{at:08d}-{uuid.uuid4().hex}"
        with files.open_output_stream(f"{name}.tmp") as f:
            f.write(json.dumps({"files": found}).encode())
        files.move(f"{name}.tmp", f"{name}.json")
        for path in old:
            files.delete_file(path)

    def abort(self, messages: list[Written | None]) -> None:
        files, root = _open(self.path)
        for m in messages:
            for f in m.files if m is not None else []:
                files.delete_file(f"{root}/{f[0]}")


def write(samples, path: str, size: int = BLOCK, dtype: str = "float64", mode: str = "append") -> None:
    """samples (electrode, sample, value) as a recording: dealt out and sorted by blocks, so a file holds all channels of a block,
    in the order of blocks; `append` adds blocks behind those that are there."""
    from pyspark.sql import functions as F

    spark = register(samples.sparkSession)
    d = samples.select(F.col("electrode").cast("long"), F.col("sample").cast("long"), F.col("value").cast("double")).withColumn("block", F.floor(F.col("sample") / size))
    d = d.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").sortWithinPartitions("block", "electrode", "sample").drop("block")
    d.write.format("recording").option("path", os.fspath(path)).option("blockSize", size).option("dtype", dtype).mode(mode).save()


def read(spark: SparkSession, path: str, start: int | None = None, stop: int | None = None, electrodes: list[int] | None = None):
    """electrode, sample, value of a recording; bounds here do what pushed filters do."""
    r = register(spark).read.format("recording").option("path", path)
    for k, v in (("start", start), ("stop", stop), ("electrodes", electrodes and ",".join(map(str, electrodes)))):
        if v is not None:
            r = r.option(k, v)
    return r.load()


def stream(spark: SparkSession, path: str, blocks_per_batch: int = 0, start: int | None = None, stop: int | None = None):
    r = register(spark).readStream.format("recording").option("path", path).option("blocksPerBatch", blocks_per_batch)
    for k, v in (("start", start), ("stop", stop)):
        if v is not None:
            r = r.option(k, v)
    return r.load()
