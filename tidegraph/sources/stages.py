"""Stage tables, legacy-style exports and text formats."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import neuron_id

SPIKES = "dataset string, spike_time long, electrode int"
NEURON_SPIKES = "neuron_id int, spike_time long"


def kept_by(df: DataFrame, key: str) -> DataFrame:
    """df dealt and sorted by key, so that each key's rows lie together in a file (several, where it outweighs one): a filter on the
    key reads the pages that hold it. There are as many files as the rows need, however many keys there are."""
    return df.hint("rebalance", key).sortWithinPartitions(key)


class Stages:
    """Tables of an analysis under one folder. A stage is computed if it is asked for and missing, or forced."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def done(self, name: str) -> bool:
        fs, p = self._fs(self.path(name) + "/_SUCCESS")
        return bool(fs.exists(p))

    def count(self, pattern: str) -> int:
        fs, p = self._fs(self.path(pattern))
        return len(fs.globStatus(p) or [])

    def find(self, pattern: str) -> str | None:
        """The one stage that matches, None without one; several raise."""
        fs, p = self._fs(self.path(pattern))
        found = [str(x.getPath()) for x in (fs.globStatus(p) or [])]
        if len(found) > 1:
            raise ValueError(f"{len(found)} stages match {pattern}")
        return found[0] if found else None

    def run(self, name: str, make: Callable[[], DataFrame], requested: bool = True, force: bool = False, partition_by: str | None = None) -> DataFrame | None:
        if requested and (force or not self.done(name)):
            made = make()
            (kept_by(made, partition_by) if partition_by else made).write.mode("overwrite").parquet(self.path(name))
        return self.load(name) if self.done(name) else None

    def load(self, name: str, *columns: str, where: Column | None = None) -> DataFrame:
        """Named columns only, and only matching rows: both reach the files."""
        d = self.spark.read.parquet(self.path(name))
        d = d.where(where) if where is not None else d
        return d.select(*columns) if columns else d


def write_noise(noise: DataFrame, path: str, table: str | None = None) -> None:
    """One sigma a line in electrode order, the trigger channel as 0; at `table` a copy in binary form, electrode and sigma, for
    further use."""
    value = F.when(F.col("electrode") == 1, F.lit(0.0)).otherwise(F.col("sigma"))
    if table:
        noise.select(F.col("electrode").cast("int").alias("electrode"), value.cast("double").alias("sigma")).write.parquet(table)
    noise.repartitionByRange(1, "electrode").sortWithinPartitions("electrode").select(value.cast("string").alias("value")).write.text(path)  # a row an electrode


def read_noise(spark: SparkSession, path: str, electrodes: int) -> DataFrame:
    """electrode (by line), sigma; another number of lines than electrodes raises."""
    d = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("at")).where("trim(value) <> ''")
    d = d.select(F.row_number().over(Window.partitionBy().orderBy("at")).alias("electrode"), F.col("value").cast("double").alias("sigma"))
    if (n := d.count()) != electrodes:
        raise ValueError(f"{n} noise values for {electrodes} electrodes")
    return d


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("line")).where("line <> ''")


def parse_labels(lines: DataFrame, line: str = "value") -> DataFrame:
    """'<id> All/<label>' lines -> neuron_id, label; others are left out."""
    pattern = r"^(\d+) All/(.*)$"
    return lines.where(F.col(line).rlike(pattern)).select(F.regexp_extract(line, pattern, 1).cast("int").alias("neuron_id"), F.regexp_extract(line, pattern, 2).alias("label"))


def format_labels(neurons: DataFrame) -> DataFrame:
    """One line a neuron with a label."""
    return neurons.where(F.length("label") > 0).select(F.format_string("%d All/%s", "neuron_id", "label").alias("value"))


def label_neurons(neurons: DataFrame, labels: DataFrame) -> DataFrame:
    return neurons.join(labels, "neuron_id", "left")


def rewrite_labels(spark: SparkSession, neurons: DataFrame, folder: str, pattern: str = "*.classification*", out: str = "classification-edited") -> str | None:
    """Labels of the edited neurons as text beside the one classification that there was; None, and nothing written, where
    there was none or several."""
    if Stages(spark, folder).count(pattern) != 1:
        return None
    path = f"{folder.rstrip('/')}/{out}"
    format_labels(neurons).write.mode("overwrite").text(path)
    return path


def spikes_stage(spikes: DataFrame, triggers: DataFrame, n_samples: int) -> DataFrame:
    """One table of what the spike stage saves: kind ('spike', 'trigger', 'n_samples'), spike_time, electrode; integers, no
    amplitude."""
    s = spikes.select(F.lit("spike").alias("kind"), F.col("spike_time").cast("int").alias("spike_time"), F.col("electrode").cast("int").alias("electrode"))
    t = triggers.select(F.lit("trigger").alias("kind"), F.col("sample").cast("int").alias("spike_time"), F.col("electrode").cast("int").alias("electrode"))
    n = spikes.sparkSession.range(1).select(F.lit("n_samples").alias("kind"), F.lit(n_samples).cast("int").alias("spike_time"), F.lit(None).cast("int").alias("electrode"))
    return s.unionByName(t).unionByName(n)


def read_neurons(spark: SparkSession, path: str, ids: list[int] | None = None) -> DataFrame:
    """neuron_id, electrode, n, times (in order) of a table of events; only the ids that are asked for, a bound that reaches
    the files."""
    d = spark.read.parquet(path)
    d = d if ids is None else d.where(F.col("neuron_id").isin(ids))
    return d.groupBy("neuron_id", "electrode").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("spike_time")).alias("times"))


def append_images(images: DataFrame, path: str) -> None:
    """Images (neuron_id, n, plane, electrode, wave) added to a table, a folder a plane: 0 the mean, 1 its error."""
    images.write.mode("append").partitionBy("plane").parquet(path)


def read_images(spark: SparkSession, path: str, ids: list[int] | None = None, plane: int = 0) -> DataFrame:
    """neuron_id, n, electrode, wave of one plane, the mean by default: only its folder is read."""
    d = spark.read.parquet(path).where(F.col("plane") == plane)
    return (d if ids is None else d.where(F.col("neuron_id").isin(ids))).drop("plane")


def export_spikes(spikes: DataFrame) -> DataFrame:
    """Integers without amplitude, electrodes counted from 0."""
    return spikes.select(F.col("spike_time").cast("int").alias("spike_time"), (F.col("electrode") - 1).cast("int").alias("electrode"))


def export_neurons(clusters: DataFrame, offset: int = 0) -> DataFrame:
    """(electrode, clust, spike_time) -> neuron_id, electrode, spike_time less the recording's offset; cluster 0 is none."""
    d = clusters.where("clust > 0")
    return d.select(neuron_id(F.col("electrode"), F.col("clust")).alias("neuron_id"), "electrode", (F.col("spike_time") - offset).alias("spike_time"))


def export_triggers(edges: DataFrame) -> DataFrame:
    """Trigger times in order, a single 0 if there are none."""
    zero = edges.sparkSession.range(1).select(F.lit(0).cast("long").alias("sample"))
    none = zero.join(edges.limit(1).select(F.lit(True).alias("some")), how="left").where("some is null").select("sample")
    return edges.select(F.col("sample").cast("long").alias("sample")).unionByName(none)


def export_models(electrodes: DataFrame, models: DataFrame) -> DataFrame:
    """Every electrode with its clusters; one without any gets a single cluster of zeros."""
    zeros = F.array(F.lit(0.0))
    d = electrodes.select("electrode").join(models, "electrode", "left")
    return d.select("electrode", F.coalesce("clust", F.lit(1)).alias("clust"), F.coalesce("centroid", zeros).alias("centroid"), F.coalesce("variance", zeros).alias("variance"), F.coalesce("mix_frac", F.lit(0.0)).alias("mix_frac"))


def export_projections(projections: DataFrame) -> DataFrame:
    return projections.where(F.size("pc") > 0)


def write_projections(projections: DataFrame, path: str) -> None:
    """(electrode, spike_time, pc) of electrodes that have any, kept by electrode."""
    kept_by(export_projections(projections).select("electrode", "spike_time", "pc"), "electrode").write.parquet(path)


def read_projections(spark: SparkSession, path: str, electrode: int | None = None) -> DataFrame:
    """electrode, spike_time, pc: all, or one electrode's, the filter reaching the files' pages; one that has none has no rows."""
    d = spark.read.parquet(path).select("electrode", "spike_time", "pc")
    return d if electrode is None else d.where(F.col("electrode") == electrode)


def copy_selected(neurons: DataFrame, ids: DataFrame, path: str, raw: DataFrame | None = None) -> None:
    """Rows whose id is in the list (and in `raw`, if given), to a new table; refuses an existing one."""
    if raw is not None:
        ids = ids.join(raw.select("neuron_id").distinct(), "neuron_id", "left_semi")
    neurons.join(ids.select("neuron_id").distinct(), "neuron_id", "left_semi").write.mode("errorifexists").parquet(path)


def final_or_raw(final: DataFrame, raw: DataFrame, key: str, value: str) -> DataFrame:
    """The final value where there is one, else the raw one."""
    return final.select(key, F.col(value).alias("f")).join(raw.select(key, F.col(value).alias("r")), key, "full").select(key, F.coalesce("f", "r").alias(value))


def nearest_model(points: DataFrame, models: DataFrame, key: str = "electrode") -> DataFrame:
    """Points assigned to the likeliest diagonal Gaussian of their electrode: key, spike_time, clust."""
    terms = F.zip_with(F.zip_with("pc", "centroid", lambda x, c: (x - c) * (x - c)), "variance", lambda d, v: d / v + F.log(v))
    fit = F.log("mix_frac") - F.aggregate(terms, F.lit(0.0), lambda s, t: s + t) / 2
    d = points.join(models, key).select(key, "spike_time", "clust", fit.alias("fit"))
    return d.groupBy(key, "spike_time").agg(F.max_by("clust", F.struct(F.col("fit"), -F.col("clust"))).alias("clust"))
