"""Recordings as block tables, their time ranges, and lists of datasets."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.tables import keyed_hash

BLOCKS = "dataset string, electrode int, block_id long, start_sample long, values array<float>"


@dataclass(frozen=True)
class Range:
    """A dataset and the seconds of it that are meant; no end is None."""

    path: str
    start: float = 0.0
    stop: float | None = None

    def bounds(self, sampling_hz: int, n_samples: int) -> tuple[int, int]:
        return int(self.start * sampling_hz), n_samples if self.stop is None else min(int(self.stop * sampling_hz), n_samples)


def parse_datasets(text: str) -> list[Range]:
    """'path(a-b)', 'path(a-)', 'path(-b)', 'path'; several joined by '+' or ';'."""
    out = []
    for part in re.split(r"[+;]", text):
        m = re.fullmatch(r"\s*([^()]+?)\s*(?:\(\s*(\d*\.?\d*)\s*-\s*(\d*\.?\d*)\s*\))?\s*", part)
        if not m or (m[2] == "" and m[3] == ""):
            raise ValueError(f"not a dataset: {part!r}")
        out.append(Range(m[1], float(m[2] or 0), float(m[3]) if m[3] else None))
    return out


def dataset_columns(text: Column) -> list[Column]:
    """path, start and stop of a dataset string in a column."""
    pattern = r"^\s*([^()]+?)\s*(?:\(\s*(\d*\.?\d*)\s*-\s*(\d*\.?\d*)\s*\))?\s*$"
    num = lambda i: F.try_to_number(F.nullif(F.regexp_extract(text, pattern, i), F.lit("")), F.lit("999999999.999")).cast("double")
    return [F.regexp_extract(text, pattern, 1).alias("path"), F.coalesce(num(2), F.lit(0.0)).alias("start"), num(3).alias("stop")]


def to_blocks(samples: DataFrame, size: int = 16_384) -> DataFrame:
    """(dataset, electrode, sample, value) -> the block table; samples without gaps within a channel."""
    s = samples.withColumn("block_id", F.floor(F.col("sample") / size))
    g = s.groupBy("dataset", "electrode", "block_id").agg(F.min("sample").alias("start_sample"), F.sort_array(F.collect_list(F.struct("sample", "value"))).alias("v"))
    return g.select("dataset", "electrode", "block_id", "start_sample", F.transform("v", lambda x: x["value"].cast("float")).alias("values"))


def scan(blocks: DataFrame, start: int | None = None, stop: int | None = None, size: int = 16_384) -> DataFrame:
    """Samples in [start, stop): the bound on start_sample reaches the files, the rest is cut after the explode."""
    b = blocks
    if start is not None:
        b = b.where(F.col("start_sample") > start - size)
    if stop is not None:
        b = b.where(F.col("start_sample") < stop)
    s = b.select("dataset", "electrode", "start_sample", F.posexplode("values").alias("i", "value")).select("dataset", "electrode", (F.col("start_sample") + F.col("i")).alias("sample"), F.col("value").cast("double").alias("value"))
    if start is not None:
        s = s.where(F.col("sample") >= start)
    return s if stop is None else s.where(F.col("sample") < stop)


HEADER = "dataset string, sampling_hz int, n_samples long, n_electrodes int, array_id int, block_size int, disconnected array<int>"


def write_recording(samples: DataFrame, path: str, sampling_hz: int = 20_000, disconnected: tuple[int, ...] = (), array_id: int = 0, size: int = 16_384) -> None:
    """(dataset, electrode, sample, value) as a block table, a folder a dataset, with a header a dataset beside it."""
    to_blocks(samples, size).write.partitionBy("dataset").parquet(f"{path}/blocks")
    gone = F.array(*map(F.lit, disconnected)).cast("array<int>")
    head = samples.groupBy("dataset").agg((F.max("sample") + 1).alias("n_samples"), F.count_distinct("electrode").cast("int").alias("n_electrodes"))
    head = head.select("dataset", F.lit(sampling_hz).alias("sampling_hz"), "n_samples", "n_electrodes", F.lit(array_id).alias("array_id"), F.lit(size).alias("block_size"), gone.alias("disconnected"))
    head.write.parquet(f"{path}/header")


class Recording:
    """One dataset of a recording and the seconds of it that are asked for: 'dataset', 'dataset(a-b)', 'dataset(a-)', ..."""

    def __init__(self, spark: SparkSession, path: str, source: str):
        [asked] = parse_datasets(source)
        head = spark.read.parquet(f"{path}/header").where(F.col("dataset") == asked.path).collect()  # a row
        if not head:
            raise ValueError(f"no dataset {asked.path}")
        self.header = head[0].asDict()
        self.start, self.stop = asked.bounds(self.header["sampling_hz"], self.header["n_samples"])
        self.n_electrodes, self.disconnected = self.header["n_electrodes"], list(self.header["disconnected"] or [])
        self._blocks = spark.read.parquet(f"{path}/blocks").where(F.col("dataset") == asked.path)

    def scan(self, a: int | None = None, n: int | None = None, connected: bool = False) -> DataFrame:
        """Samples [a, a + n) of the range, cut to it; without arguments all of it. The dataset picks the folder, bounds on
        block starts reach the files."""
        low = self.start if a is None else max(self.start, a)
        high = self.stop if n is None else min(self.stop, low + n if a is None else a + n)
        out = scan(self._blocks, low, high, self.header["block_size"])
        return out.where(~F.col("electrode").isin(self.disconnected)) if connected and self.disconnected else out


def adjacency(positions: DataFrame, usage: int = 1, pitch: float = 1.0) -> DataFrame:
    """electrode, neighbor, ord, from (electrode, x, y): itself first, then those within `usage` pitches by distance, ties by
    number; usage 0 is the electrode alone. Met in an equi-join of cells, so the size of the array does not matter."""
    reach = usage * pitch
    cell = max(reach, pitch)
    c = lambda x: F.floor(F.col(x) / cell)
    a = positions.select("electrode", F.col("x").alias("ax"), F.col("y").alias("ay"), F.explode(F.array(*[F.struct((c("x") + i).alias("cx"), (c("y") + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])).alias("c"))
    b = positions.select(F.col("electrode").alias("neighbor"), "x", "y", F.struct(c("x").alias("cx"), c("y").alias("cy")).alias("c"))
    d2 = (F.col("ax") - F.col("x")) * (F.col("ax") - F.col("x")) + (F.col("ay") - F.col("y")) * (F.col("ay") - F.col("y"))
    near = a.join(b, "c").select("electrode", "neighbor", d2.alias("d2")).where(F.col("d2") <= reach * reach * (1 + 1e-9))
    return near.withColumn("ord", (F.row_number().over(Window.partitionBy("electrode").orderBy("d2", "neighbor")) - 1).cast("int")).drop("d2")


def degrees(adjacent: DataFrame) -> DataFrame:
    """electrode, degree (itself included), most: the largest degree of the array."""
    d = adjacent.groupBy("electrode").agg(F.count(F.lit(1)).alias("degree"))
    return d.withColumn("most", F.max("degree").over(Window.partitionBy()))  # a row an electrode


def synthetic(spark: SparkSession, electrodes: int, n_samples: int, units: list[tuple[int, int, int]], sigma: float = 10.0, ttl_every: int = 2_000, seed: int = 1) -> DataFrame:
    """A recording with planted units (electrode, first, period), noise and drift: dataset, electrode, sample, value.
    Electrode 1 is the trigger channel. Every value is an expression of its place, so nothing is built on the driver."""
    s = spark.range(electrodes * n_samples).select((F.col("id") / n_samples).cast("int").alias("e"), (F.col("id") % n_samples).alias("sample")).withColumn("electrode", F.col("e") + 1)
    u = [(keyed_hash(seed + k, F.col("electrode"), F.col("sample")) + 1) / F.lit(float(1 << 32) + 1) for k in (0, 1)]
    noise = F.sqrt(-2 * F.log(u[0])) * F.cos(2 * 3.141592653589793 * u[1]) * sigma + 20 * F.sin(F.col("sample") / 3_000)
    value = F.when(F.col("electrode") == 1, F.when(F.col("sample") % ttl_every < 5, -1_500.0).otherwise(0.0)).otherwise(noise)
    for i, (el, first, period) in enumerate(units):
        phase = (F.col("sample") - first) % period
        shape = F.when(F.col("sample") >= first, F.when(phase < 10, -(200.0 + 40 * i) * F.exp(-((phase - 4) * (phase - 4)) / (2.0 + i))).otherwise(0.0)).otherwise(0.0)
        near = F.abs(F.col("electrode") - el)
        value = value + F.when((F.col("electrode") > 1) & (near <= 1), shape / (1 + 2 * near)).otherwise(0.0)
    return s.select(F.lit("synthetic").alias("dataset"), "electrode", "sample", value.alias("value"))


def linear_adjacency(spark: SparkSession, electrodes: int, reach: int, first: int = 2) -> DataFrame:
    """electrode, neighbor, ord on a line: the electrode itself first, then by distance."""
    e = spark.range(first, electrodes + 1).select(F.col("id").cast("int").alias("electrode"))
    d = F.explode(F.sequence(F.lit(-reach), F.lit(reach))).alias("d")
    n = e.select("electrode", d).withColumn("neighbor", (F.col("electrode") + F.col("d")).cast("int")).where((F.col("neighbor") >= first) & (F.col("neighbor") <= electrodes))
    return n.select("electrode", "neighbor", F.when(F.col("d") == 0, 0).when(F.col("d") < 0, -2 * F.col("d") - 1).otherwise(2 * F.col("d")).cast("int").alias("ord"))
