"""Each query applies an operator to whole tables. A channel is a user of `events`, its sample number the place in time; a
point is an embedding, its channel the label; a neuron is an embedding too, its electrode by the codec of ids (fifteen an
electrode), its image cut from the vector; trains come from `lineitem`, event counts from `orders`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import STATUS, cluster_of, electrode_of, l2_normalise, neuron_id, pretty, rate, status_label, to_double
from ..operators import clustering, compare, detection, editing, graph, linear, reports
from ..operators import images as imaging
from ..operators.tables import scratch, written
from ..sources import datasource, recordings, settings, stages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# What gives results that are not trivial on these tables.
MAX_WIDTH, MIN_GAP, ALPHA, HEAD = 3, 3, 0.2, 10
BLOCK = 16  # of short channels; runs and gaps go over the blocks' ends
LINK = 1.6
WITHIN, ACROSS = 1.1, 1.0  # of normalised traces
AUTO = [editing.Action("AUTO_RM", ids=[2, 16]), editing.Action("AUTO_MERGE", master_id=3, ids=[1, 5]), editing.Action("AUTO_RM_DUP", master_id=3, ids=[17, 4]), editing.Action("AUTO_MERGE", master_id=2, ids=[7, 8])]
MANUAL = [editing.Action("KEEP", ids=[16]), editing.Action("MERGE", ids=[1, 2]), editing.Action("DELETE", ids=[4]), editing.Action("CONSOLIDATE"), editing.Action("MERGE", ids=[5, 7])]
BASIS = [(1, [1.0, 0.5, -0.5, 0.25, 0.0, 0.0, 1.0, -1.0]), (2, [0.0, 1.0, 1.0, -1.0, 0.5, -0.5, 0.0, 0.25])]  # repeated along the vector


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Sums differ in their last bits with the order of rows; nine digits where six would fall on exact halves."""
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    nth = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("electrode"), (F.row_number().over(nth) - 1).cast("long").alias("sample"), "value", "event_type", "ts")


def upright(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Channels as deflections below their mean, and one standard deviation as threshold."""
    c = channels(spark, sf_dir)
    lim = c.groupBy("electrode").agg(F.avg("value").alias("mu"), F.stddev_samp("value").alias("threshold"))
    return c.join(lim, "electrode").select("electrode", "sample", (F.col("mu") - F.col("value")).alias("value")), lim.select("electrode", "threshold")


def spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detection.detect(*upright(spark, sf_dir), MAX_WIDTH, MIN_GAP)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("label").alias("electrode"), F.col("vec_id").alias("id"), to_double(F.col("embedding")).alias("v"))


def neurons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as neurons, fifteen an electrode."""
    return table(spark, sf_dir, "embeddings").select(electrode_of(F.col("vec_id") + 1).alias("electrode"), F.col("vec_id").alias("id"), to_double(F.col("embedding")).alias("v"))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of neuron id: orders of customer id + 1."""
    return table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") - 1).alias("id")).agg(F.count(F.lit(1)).alias("n"))


def trains(spark: SparkSession, sf_dir: str, by: str) -> DataFrame:
    """Clusterings of lineitem: electrode = supplier, event time = order."""
    d = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("electrode"), F.col(by).alias("neuron_id"), F.col("l_orderkey").alias("spike_time"))
    return compare.by_time(d, d.count()).distinct()


def user_trains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times in microseconds of each user."""
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("neuron_id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("spike_time"))


# ------------------------------------------------------------------------------------------------- detection


@query
def spike_detect(spark, sf_dir):
    return rounded(spikes(spark, sf_dir), "amplitude", digits=9)


@query
def spike_candidates(spark, sf_dir):
    c = detection.keep_rule(detection.candidates(*upright(spark, sf_dir), block=BLOCK), MAX_WIDTH, MIN_GAP, block=BLOCK)
    return rounded(c, "amplitude", digits=9)


@query
def threshold_crossings(spark, sf_dir):
    return detection.crossings(*upright(spark, sf_dir), block=BLOCK)


@query
def threshold_vector(spark, sf_dir):
    noise = channels(spark, sf_dir).groupBy("electrode").agg(F.stddev_samp("value").alias("sigma"))
    return rounded(detection.thresholds(noise), "threshold")


@query
def noise_floor_k5(spark, sf_dir):
    return rounded(detection.noise_rounds(channels(spark, sf_dir).select("electrode", "value"), 5), "sigma", "mu")


@query
def noise_floor_converged(spark, sf_dir):
    return rounded(detection.noise_floor(channels(spark, sf_dir).select("electrode", "value")), "sigma", "mu")


@query
def dc_initial_mean(spark, sf_dir):
    return rounded(detection.first_mean(channels(spark, sf_dir), HEAD, short="drop"), "start_mean")


@query
def dc_removal_ema(spark, sf_dir):
    c = channels(spark, sf_dir).select("electrode", "sample", "value")
    return rounded(detection.remove_drift(c, detection.first_mean(c, HEAD, short="drop"), ALPHA, block=16), "drift", "filtered")


@query
def ttl_edges(spark, sf_dir):
    return detection.trigger_edges(channels(spark, sf_dir), F.col("event_type") == "error", block=BLOCK)


@query
def ttl_intervals(spark, sf_dir):
    return rounded(detection.trigger_intervals(detection.trigger_edges(channels(spark, sf_dir), F.col("event_type") == "error"), block=BLOCK), "mean")


@query
def buffered_scan(spark, sf_dir):
    b = detection.buffers(channels(spark, sf_dir).select("electrode", "sample", "value"), 16, 2, 3)
    return b.groupBy("electrode", "buffer").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.count(F.lit(1)).alias("n"))


@query
def spike_buffer_interior(spark, sf_dir):
    s, _ = upright(spark, sf_dir)
    b = detection.buffers(s, 16, 2, 3).select("electrode", F.col("sample").alias("spike_time"), "buffer", "start", "stop")
    return detection.interior(spikes(spark, sf_dir).select("electrode", "spike_time").join(b, ["electrode", "spike_time"]), 2, 3)


def _recorded(spark, sf_dir):
    """The channels as a recording on disk, in files of sixteen samples of all channels."""
    path = scratch(spark, "recording")
    datasource.write(channels(spark, sf_dir), path, size=16)
    return path


@query
def time_range_scan(spark, sf_dir):
    """The bounds reach the source, which opens only the files that hold them."""
    d = datasource.read(spark, _recorded(spark, sf_dir))
    return d.where((F.col("sample") >= 10) & (F.col("sample") < 20)).select("electrode", "sample", "value")


@query
def recording_electrodes(spark, sf_dir):
    """Two channels from a sample on."""
    return datasource.read(spark, _recorded(spark, sf_dir)).where(F.col("electrode").isin(3, 8) & (F.col("sample") >= 20))


@query
def recording_stream(spark, sf_dir):
    """A recording read as a stream, three files a micro-batch, gives its samples once each."""
    folder = scratch(spark, "recording-stream")
    d = datasource.stream(spark, _recorded(spark, sf_dir), blocks_per_batch=3)
    run = d.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").start()
    run.processAllAvailable()
    run.stop()
    d = spark.read.schema(d.schema).parquet(f"{folder}/out")
    return rounded(d.groupBy("electrode").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("sample").alias("samples"), F.sum("value").alias("total")), "total", digits=4)


@query
def electrode_filter_counts(spark, sf_dir):
    return spikes(spark, sf_dir).groupBy("electrode").agg(F.count(F.lit(1)).alias("n")).where("n >= 5")


def _pseudo_noise(spark, sf_dir):
    """Every sample stands for a noise event."""
    return channels(spark, sf_dir).select("electrode", F.col("sample").alias("spike_time"))


@query
def noise_event_antijoin(spark, sf_dir):
    return detection.drop_near_spikes(_pseudo_noise(spark, sf_dir), spikes(spark, sf_dir), 4.0)


@query
def noise_event_first_only(spark, sf_dir):
    return detection.drop_near_spikes(_pseudo_noise(spark, sf_dir), spikes(spark, sf_dir), 8.0, first_only=True)


@query
def random_noise_events(spark, sf_dir):
    spans = channels(spark, sf_dir).groupBy("electrode").agg(F.min("sample").alias("first"), F.count(F.lit(1)).alias("span"))
    return detection.random_events(spans, 0.2)


def _streamed(spark, rows, run):
    """run over files of rows that follow one another in time, a file a micro-batch, into a Parquet sink; what came out."""
    rows, folder = written(rows, "stream-rows"), scratch(spark, "stream")
    step = max(1, -(-rows.agg(F.max("sample") + 1).collect()[0][0] // 3))
    for i in range(3):
        rows.where(F.floor(F.col("sample") / step) == i).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    found = run(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in"))
    found.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(found.schema).parquet(f"{folder}/out")


def _stream_detect(spark, sf_dir, alpha):
    from ..streaming import detect_stream

    s, lim = upright(spark, sf_dir)
    found = _streamed(spark, s.join(lim, "electrode"), lambda d: detect_stream(d, max_width=MAX_WIDTH, min_gap=MIN_GAP, alpha=alpha))
    return rounded(found, "amplitude", digits=9)


@query
def stream_detect_equals_batch(spark, sf_dir):
    return _stream_detect(spark, sf_dir, 0.0)


@query
def stream_filtered_detect(spark, sf_dir):
    """With the drift filter's memory carried between micro-batches."""
    return _stream_detect(spark, sf_dir, ALPHA)


@query
def stream_windows(spark, sf_dir):
    """Waveforms of the events, cut while the samples pass by."""
    from ..streaming import window_stream

    s, _ = upright(spark, sf_dir)
    hits = spikes(spark, sf_dir).select("electrode", F.col("spike_time").alias("sample"), F.lit(True).alias("hit"))
    rows = s.join(hits, ["electrode", "sample"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
    found = _streamed(spark, rows, lambda d: window_stream(d, 2, 3))
    return rounded(found.select("electrode", "spike_time", F.posexplode("wave").alias("pos", "value")).withColumn("pos", F.col("pos") - 2), "value", digits=9)


@query
def spikes_in_order(spark, sf_dir):
    """The events of all channels with their places in the one order by time, which the sink's files follow."""
    d = detection.in_order(spikes(spark, sf_dir).select("spike_time", "electrode"))
    d = written(d.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("nth")), "in-order")
    before = Window.partitionBy().orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    sizes = d.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return d.join(sizes, "part").select((F.col("base") + F.col("nth")).alias("place"), "spike_time", "electrode")


# -------------------------------------------------------------------------------------- waveforms, linear algebra


def _adjacency(spark, sf_dir, reach):
    e = channels(spark, sf_dir).select("electrode").distinct()
    d = e.select("electrode", F.explode(F.sequence(F.lit(-reach), F.lit(reach))).alias("d")).withColumn("neighbor", F.col("electrode") + F.col("d"))
    return d.join(e.select(F.col("electrode").alias("neighbor")), "neighbor").select("electrode", "neighbor", F.when(F.col("d") == 0, 0).when(F.col("d") < 0, -2 * F.col("d") - 1).otherwise(2 * F.col("d")).cast("int").alias("ord"))


@query
def electrode_adjacency(spark, sf_dir):
    return _adjacency(spark, sf_dir, 3)


@query
def waveform_windows(spark, sf_dir):
    s, _ = upright(spark, sf_dir)
    return rounded(linear.windows(spikes(spark, sf_dir), s, _adjacency(spark, sf_dir, 3), 2, 3), "value", digits=9)


@query
def aligned_waveforms(spark, sf_dir):
    s, _ = upright(spark, sf_dir)
    w = linear.windows(spikes(spark, sf_dir), s, _adjacency(spark, sf_dir, 0), 3, 3)
    return linear.aligned_waveforms(w, 2, 2).select("electrode", "spike_time", F.transform("wave", lambda x: F.round(x, 6)).alias("wave"))


@query
def mean_waveform(spark, sf_dir):
    return rounded(linear.mean_wave(points(spark, sf_dir), "electrode", "v"), "mean")


@query
def covariance_longform(spark, sf_dir):
    return rounded(linear.covariance(linear.moments(points(spark, sf_dir), "electrode", "v"), "electrode"), "cov")


@query
def covariance_merge(spark, sf_dir):
    p = points(spark, sf_dir).withColumn("part", F.concat_ws("-", "electrode", F.col("id") % 2))
    c = linear.covariance(linear.moments(p, "part", "v"), "part").withColumn("electrode", F.split("part", "-")[0].cast("int"))
    return rounded(linear.pooled(c, "electrode", "cov", "i", "j"), "cov")


def _axes(spark, sf_dir):
    return linear.eigen(linear.covariance(linear.moments(points(spark, sf_dir), "electrode", "v"), "electrode"), "electrode", 5)


@query
def eigenvalues_top5(spark, sf_dir):
    return rounded(_axes(spark, sf_dir).select("electrode", "rank", "eigenvalue"), "eigenvalue")


@query
def eigen_invariants(spark, sf_dir):
    """Sum and sum of squares of all eigenvalues, which SQL knows as the trace and the sum of squares of the covariance."""
    c = linear.covariance(linear.moments(points(spark, sf_dir), "electrode", "v"), "electrode")
    e = linear.eigen(c, "electrode", 10**6)
    return rounded(e.groupBy("electrode").agg(F.sum("eigenvalue").alias("trace"), F.sum(F.col("eigenvalue") * F.col("eigenvalue")).alias("squares")), "trace", "squares")


@query
def whitened_covariance(spark, sf_dir):
    c = linear.covariance(linear.moments(points(spark, sf_dir), "electrode", "v"), "electrode")
    n = linear.covariance(linear.moments(points(spark, sf_dir).withColumn("electrode", F.lit(0)), "electrode", "v"), "electrode").drop("electrode")
    return rounded(linear.whitened(c, c.select("electrode").distinct().join(n, how="cross"), "electrode"), "cov")


@query
def whitened_identity(spark, sf_dir):
    """A covariance whitened by itself is the identity: each point as eight waves of eight values."""
    p = points(spark, sf_dir).select("electrode", F.explode(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda j: F.slice("v", 8 * j + 1, F.lit(8)))).alias("v"))
    c = linear.covariance(linear.moments(p, "electrode", "v"), "electrode")
    d = linear.whitened(c, c, "electrode")
    return d.select("electrode", "i", "j", (F.round("cov", 6) + F.lit(0.0)).alias("cov"))


@query
def pc_project(spark, sf_dir):
    p = points(spark, sf_dir)
    m = linear.mean_wave(p, "electrode", "v").groupBy("electrode").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "mean"))), lambda x: x["mean"]).alias("mean"))
    return rounded(linear.project(p, m, _axes(spark, sf_dir), "electrode", "id", "v"), "score")


@query
def pc_energy(spark, sf_dir):
    """Squared scores on all axes, which is each point's squared distance from its channel's mean."""
    p = points(spark, sf_dir)
    c = linear.covariance(linear.moments(p, "electrode", "v"), "electrode")
    m = linear.mean_wave(p, "electrode", "v").groupBy("electrode").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "mean"))), lambda x: x["mean"]).alias("mean"))
    d = linear.project(p, m, linear.eigen(c, "electrode", 10**6), "electrode", "id", "v")
    return rounded(d.groupBy("electrode", "id").agg(F.sum(F.col("score") * F.col("score")).alias("energy")), "energy")


@query
def pc_project_fixed_basis(spark, sf_dir):
    p = points(spark, sf_dir)
    m = linear.mean_wave(p, "electrode", "v").groupBy("electrode").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "mean"))), lambda x: x["mean"]).alias("mean"))
    basis = m.select("electrode", F.size("mean").alias("size")).crossJoin(spark.createDataFrame(BASIS, "rank int, axis array<double>"))
    basis = basis.select("electrode", "rank", F.expr("slice(flatten(array_repeat(axis, cast(ceil(size / size(axis)) as int))), 1, size)").alias("axis"))
    return rounded(linear.project(p, m, basis, "electrode", "id", "v"), "score")


# ------------------------------------------------------------------------------------ distances and clustering


@query
def l2_normalize(spark, sf_dir):
    p = points(spark, sf_dir).withColumn("v", l2_normalise(F.col("v")))
    return rounded(p.select("id", F.posexplode("v").alias("i", "x")), "x")


@query
def pairwise_l2(spark, sf_dir):
    return rounded(graph.distances(neurons(spark, sf_dir), "electrode", "id", "v"), "d2")


@query
def pairwise_l2_channels(spark, sf_dir):
    """All pairs of a channel's points, a tenth of the table in each channel."""
    return rounded(graph.distances_by_parts(points(spark, sf_dir), "electrode", "id", "v"), "d2")


@query
def neighbor_pairs_l2(spark, sf_dir):
    e = neurons(spark, sf_dir).select("electrode").distinct()
    adjacency = e.select("electrode", F.explode(F.array(F.col("electrode") - 1, F.col("electrode") + 1)).alias("neighbor"))
    return rounded(graph.neighbour_distances(neurons(spark, sf_dir), adjacency, "electrode", "id", "v"), "d2")


@query
def nth_neighbor_scale(spark, sf_dir):
    return rounded(clustering.landmark_scales(points(spark, sf_dir), "electrode", "id", "v"), "scale")


@query
def local_affinity(spark, sf_dir):
    return rounded(clustering.landmark_affinity(points(spark, sf_dir), "electrode", "id", "v"), "a")


@query
def power_affinity(spark, sf_dir):
    return rounded(clustering.landmark_affinity(points(spark, sf_dir), "electrode", "id", "v", "power", 0.2), "a")


@query
def cluster_stats(spark, sf_dir):
    p = points(spark, sf_dir).withColumn("clust", (F.col("id") % 3).cast("int"))
    return rounded(clustering.cluster_stats(p, "electrode", "clust", "v"), "centroid", "variance", "mix_frac")


@query
def nearest_centroid(spark, sf_dir):
    p = points(spark, sf_dir).withColumn("clust", (F.col("id") % 3).cast("int"))
    c = p.select("electrode", "clust", F.posexplode("v").alias("i", "x")).groupBy("electrode", "clust", "i").agg(F.avg("x").alias("x"))
    c = c.groupBy("electrode", "clust").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("centroid"))
    return rounded(clustering.nearest_centroid(p.drop("clust"), c, "electrode", "id", "v"), "d2")


@query
def knn_distance_rank(spark, sf_dir):
    s = clustering.landmark_scales(points(spark, sf_dir), "electrode", "id", "v")
    return s.select("electrode", "id", F.row_number().over(Window.partitionBy("electrode").orderBy(F.round("scale", 9), "id")).alias("rank"))


@query
def shrink_prefix(spark, sf_dir):
    r = knn_distance_rank(spark, sf_dir)
    r = r.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("electrode")))
    return r.where(F.col("rank") <= F.floor(0.6 * F.col("n"))).drop("n")


@query
def shrink_to_target(spark, sf_dir):
    p = points(spark, sf_dir).withColumn("t", F.col("id") * 13 % 997)
    return editing.shrink(p, "electrode", "t", "v", 0.8, 0.5, 1000.0)


@query
def spectral_labels(spark, sf_dir):
    return clustering.cluster(points(spark, sf_dir), "electrode", "id", "v", "spectral", least=20)


@query
def spectral_forced_k(spark, sf_dir):
    return clustering.cluster(points(spark, sf_dir), "electrode", "id", "v", "spectral", k=3, least=20)


@query
def kmeans_labels(spark, sf_dir):
    return clustering.cluster(points(spark, sf_dir), "electrode", "id", "v", "kmeans", k=3, least=20)


@query
def gmm_bic(spark, sf_dir):
    return clustering.cluster(points(spark, sf_dir), "electrode", "id", "v", "gmm", least=20)


# ------------------------------------------------------------------------------------- graph and deduplication


def _links(spark, sf_dir):
    return graph.edges(graph.distances(neurons(spark, sf_dir), "electrode", "id", "v"), LINK)


def _kept(spark, sf_dir):
    return graph.keepers(graph.components(neurons(spark, sf_dir), _links(spark, sf_dir), "electrode", "id"), counts(spark, sf_dir), "electrode")


@query
def merge_components(spark, sf_dir):
    return graph.components(neurons(spark, sf_dir), _links(spark, sf_dir), "electrode", "id")


@query
def merge_components_channels(spark, sf_dir):
    """Components of large channels, linked by the exact threshold join."""
    p = points(spark, sf_dir)
    within = graph.trace_links(p, "electrode", "id", "v", 1.1)[1].withColumnRenamed("e", "electrode")
    return graph.components(p, within, "electrode", "id")


@query
def final_forest(spark, sf_dir):
    c = graph.components(neurons(spark, sf_dir), _links(spark, sf_dir), "electrode", "id")
    return c.groupBy("electrode", "component").agg(F.count(F.lit(1)).alias("members")).where("members > 1")


@query
def merge_dendrogram(spark, sf_dir):
    d = graph.dendrogram(neurons(spark, sf_dir), _links(spark, sf_dir), "electrode", "id")
    return rounded(d.select("electrode", "step", "threshold", F.array_join("left", ",").alias("left_ids"), F.array_join("right", ",").alias("right_ids")), "threshold")


@query
def dendrogram_cut(spark, sf_dir):
    """The merge tree cut below 1.5: merges under it, linked by the smallest members of what they join."""
    d = graph.dendrogram(neurons(spark, sf_dir), _links(spark, sf_dir), "electrode", "id").where("threshold < 1.5")
    links = d.select("electrode", F.col("left")[0].alias("id_a"), F.col("right")[0].alias("id_b"))
    return graph.components(neurons(spark, sf_dir), links, "electrode", "id")


@query
def dendrogram_sizes(spark, sf_dir):
    """Merges of each electrode, and how many neurons the largest tree holds."""
    d = graph.dendrogram(neurons(spark, sf_dir), _links(spark, sf_dir), "electrode", "id")
    return d.groupBy("electrode").agg(F.count(F.lit(1)).alias("merges"), F.max(F.size("left") + F.size("right")).cast("long").alias("largest"))


@query
def component_keeper(spark, sf_dir):
    return _kept(spark, sf_dir).select("electrode", "id", "component", "n", "keeper")


@query
def auto_merge_actions(spark, sf_dir):
    return graph.merge_actions(_kept(spark, sf_dir), "electrode").select("electrode", "action", "master_id", F.array_join("ids", ",").alias("ids"))


@query
def global_duplicate_pairs(spark, sf_dir):
    """Each pair of electrodes by itself."""
    p = points(spark, sf_dir)
    across, within = graph.trace_links(p, "electrode", "id", "v", 1.1)
    return graph.spread(graph.across_pairs(p.select("electrode"), across, within, counts(spark, sf_dir)), p.select("electrode"), across)


@query
def duplicates_by_master(spark, sf_dir):
    d = graph.duplicates_by_master(graph.global_duplicates(points(spark, sf_dir), counts(spark, sf_dir), "electrode", "id", "v", 1.1))
    return d.select("master_id", F.array_join("ids", ",").alias("ids"))


@query
def shorten_duplicate_chains(spark, sf_dir):
    """Every customer but each third lost to the one with half its number."""
    k = F.col("c_custkey")
    return graph.shorten_chains(table(spark, sf_dir, "customer").where(k % 3 != 0).select(F.floor(k / 2).cast("int").alias("master_id"), k.cast("int").alias("loser_id")))


# ----------------------------------------------------------------------------------------------- codes, edits


@query
def id_codec(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1).cast("int").alias("electrode"), F.explode(F.sequence(F.lit(1), F.lit(15))).alias("clust"))
    n = s.withColumn("neuron_id", neuron_id(F.col("electrode"), F.col("clust")))
    return n.select("electrode", "clust", "neuron_id", electrode_of(F.col("neuron_id")).alias("back_electrode"), cluster_of(F.col("neuron_id")).alias("back_clust"))


def _statuses(spark, sf_dir):
    """A status for every customer's neuron; merged and duplicate ones have a master."""
    k, code = F.col("c_custkey"), (F.col("c_custkey") * 7 % 6 - 2).cast("int")
    return table(spark, sf_dir, "customer").select((k + 1).cast("int").alias("neuron_id"), code.alias("code"), F.when(code >= 2, F.floor(k / 3) + 1).cast("int").alias("master_id"))


def _label_lines(spark, sf_dir):
    """Classification lines of nations, every fourth of them not one."""
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(F.concat(F.when(n % 4 == 3, F.lit("x")).otherwise(F.lit("")), n.cast("string"), F.lit(" All/"), F.when(n % 5 == 0, F.lit("")).otherwise(F.col("n_name"))).alias("value"))


def _dataset_strings(spark, sf_dir):
    """Strings of all four forms."""
    n = F.col("n_nationkey")
    form = F.when(n % 4 == 0, F.concat(F.lit("("), n, F.lit("-"), n + 10, F.lit(")"))).when(n % 4 == 1, F.concat(F.lit("("), n, F.lit("-)"))).when(n % 4 == 2, F.concat(F.lit("(-"), n, F.lit(".5)"))).otherwise(F.lit(""))
    return table(spark, sf_dir, "nation").select(F.concat(F.lower(F.regexp_replace("n_name", "[^A-Za-z0-9]", "_")), F.lit(".bin"), form).alias("s"))


@query
def status_labels(spark, sf_dir):
    return _statuses(spark, sf_dir).select("neuron_id", status_label(F.col("code"), F.col("master_id")).alias("label"))


@query
def status_summary(spark, sf_dir):
    code = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(-1)
    return reports.status_summary(table(spark, sf_dir, "orders").select(code.alias("code")))


@query
def default_visible(spark, sf_dir):
    return _statuses(spark, sf_dir).where(~F.col("code").isin(1, -2)).select("neuron_id", "code")


@query
def colour_ranks(spark, sf_dir):
    return rounded(reports.colour_ranks(_statuses(spark, sf_dir).withColumn("g", electrode_of(F.col("neuron_id"))), "g").select("neuron_id", "hue"), "hue")


@query
def pretty_print(spark, sf_dir):
    v = F.array(F.col("n_nationkey").cast("double"), F.col("n_nationkey") / 8.0, F.col("n_regionkey").cast("double"))
    return table(spark, sf_dir, "nation").select("n_nationkey", pretty(v).alias("said"))


@query
def cluster_report(spark, sf_dir):
    """What the cluster table shows: id, colour rank, whether displayed, status, events, rate, contamination, classification."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("int").alias("neuron_id"), F.col("o_orderkey").alias("spike_time"))
    labels = stages.parse_labels(_label_lines(spark, sf_dir))
    stats = reports.contamination(o, 500.0, 36_000_000.0)
    d = stats.join(_statuses(spark, sf_dir), "neuron_id", "left").withColumn("code", F.coalesce("code", F.lit(0)))
    d = reports.colour_ranks(d.withColumn("g", electrode_of(F.col("neuron_id"))), "g").drop("g")
    d = stages.label_neurons(d, labels)
    d = d.select("neuron_id", "hue", (~F.col("code").isin(1, -2)).alias("displayed"), status_label(F.col("code"), F.col("master_id")).alias("status"), F.col("n").alias("n_spikes"), rate(F.col("n"), F.lit(36_000_000.0)).alias("hz"), "contamination", "label")
    return rounded(d, "hue", "hz", "contamination").orderBy(F.desc("n_spikes"), "neuron_id")


@query
def contamination(spark, sf_dir):
    e = user_trains(spark, sf_dir)
    span = e.agg((F.max("spike_time") - F.min("spike_time")).cast("double").alias("span"))
    return rounded(reports.contamination(e, 3_600_000_000.0, 1.0).crossJoin(span).withColumn("contamination", F.col("contamination") * F.col("span")).drop("span"), "contamination")


@query
def clean_filter(spark, sf_dir):
    return reports.clean_filter(contamination(spark, sf_dir), 60, 1.0).select("neuron_id", "n", "removed")


def _edited(spark, sf_dir):
    """Events of the twenty neurons that the literal actions are about."""
    return table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 20 + 1).cast("int").alias("neuron_id"))


def _sizes(rows):
    return rows.groupBy("neuron_id").agg(F.count(F.lit(1)).alias("n"))


def _applied(spark, sf_dir, log, elevated=(), automatic=False):
    rows = _edited(spark, sf_dir)
    guarded = spark.createDataFrame([(i,) for i in elevated], "neuron_id int")
    return _sizes(editing.remap_by(rows, editing.fold(log, _sizes(rows), guarded, automatic)))


@query
def apply_auto_actions(spark, sf_dir):
    return _applied(spark, sf_dir, editing.log_table(spark, AUTO), [16], True)


@query
def apply_manual_actions(spark, sf_dir):
    return _applied(spark, sf_dir, editing.log_table(spark, MANUAL))


@query
def incremental_actions(spark, sf_dir):
    return _applied(spark, sf_dir, editing.since_consolidate(editing.log_table(spark, MANUAL)))


@query
def auto_dry_run(spark, sf_dir):
    n = _sizes(_edited(spark, sf_dir))
    return editing.dry_run_by(n, editing.fold(editing.log_table(spark, AUTO), n, spark.createDataFrame([(16,)], "neuron_id int"), True))


def _order_log(spark, sf_dir):
    """An action for each order: on customers' neurons next to each other, those of a hundred at most linked with each other."""
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("int")
    low = c - c % 100 + 1
    ids = F.array(c + 1, low + (c * 7 + k) % 100, low + k % 100)
    action = F.when(k % 4 == 0, "AUTO_RM").when(k % 4 == 1, "AUTO_RM_DUP").otherwise("AUTO_MERGE")
    return table(spark, sf_dir, "orders").select(k.cast("int").alias("seq"), action.alias("action"), F.array_distinct(F.slice(ids, 2, 2)).cast("array<int>").alias("ids"), F.when(action != "AUTO_RM", c + 1).cast("int").alias("master_id"), F.array().cast("array<int>").alias("new_ids"), F.array().cast("array<long>").alias("new_counts"))


@query
def auto_log_applied(spark, sf_dir):
    """A long log of automatic actions on customers' neurons, in the order of orders: status of every neuron."""
    n = _sizes(table(spark, sf_dir, "orders").select((F.col("o_custkey") + 1).cast("int").alias("neuron_id")))
    return editing.dry_run_by(n, editing.fold(_order_log(spark, sf_dir), n, automatic=True))


def _edit_store(spark, sf_dir):
    """A log saved and consolidated twice, the second time with what was added since."""
    raw = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 20 + 1).cast("int").alias("neuron_id"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("spike_time"))
    store = editing.Store(spark, scratch(spark, "edits"))
    for a in MANUAL[:3]:
        store.add(a)
    store.save()
    store.consolidate(raw)
    store.add(MANUAL[4])
    store.add(editing.Action("DELETE", ids=[11]))
    store.undo()
    store.save()
    store.consolidate(raw)
    return store


@query
def edit_log(spark, sf_dir):
    return _edit_store(spark, sf_dir).log().select("seq", "action", F.array_join("ids", ",").alias("ids"))


@query
def consolidated_neurons(spark, sf_dir):
    d = _edit_store(spark, sf_dir).neurons()
    return d.groupBy("neuron_id").agg(F.count(F.lit(1)).alias("n"), F.min("spike_time").alias("first"), F.max("spike_time").alias("last"))


@query
def replay_trains(spark, sf_dir):
    """SHRINK and RECLUSTER with the events that they gave, then a merge and a removal on top."""
    line, key = F.col("l_linenumber"), (F.col("l_orderkey") % 20 + 1).cast("int")
    rows = table(spark, sf_dir, "lineitem").select(key.alias("neuron_id"), (F.col("l_orderkey") * 8 + line).alias("spike_time"), line.alias("line"))
    shrunk = rows.where("neuron_id = 3").select(F.lit(1).alias("seq"), F.when(F.col("line") <= 4, 3).otherwise(21).alias("neuron_id"), "spike_time", "line")
    again = rows.where("neuron_id in (6, 9)").select(F.lit(2).alias("seq"), F.when(F.col("line") % 2 == 1, 6).otherwise(22).alias("neuron_id"), "spike_time", "line")
    actions = [editing.Action("SHRINK", [3], frac=0.8, contam=0.1, new_ids=[21]), editing.Action("RECLUSTER", [6, 9], n_clusters=2, config_tag="", new_ids=[6, 22]), editing.Action("MERGE", [1, 6]), editing.Action("DELETE", [8])]
    out = editing.replay(rows, actions, shrunk.unionByName(again))
    return out.groupBy("neuron_id").agg(F.count(F.lit(1)).alias("n"), F.sum("spike_time").alias("total"), F.max("line").alias("line"))


@query
def merged_trains(spark, sf_dir):
    """Trains of customers, two of each ten merged into the first, as arrays in order; with their places by id."""
    o = table(spark, sf_dir, "orders").select(F.when(F.col("o_custkey") % 10 == 1, F.col("o_custkey") - 1).otherwise(F.col("o_custkey")).alias("neuron_id"), F.col("o_orderkey").alias("spike_time"))
    return editing.merged_trains(o).select("neuron_id", "n", F.array_join("times", ",").alias("times"))


def _supplier_trains(spark, sf_dir):
    """Trains and projections by supplier; one projection a time."""
    d = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("electrode"), F.col("l_linenumber").cast("int").alias("neuron_id"), F.col("l_orderkey").alias("spike_time"), "l_quantity", "l_discount")
    prj = d.where("l_quantity > 10").groupBy("electrode", "spike_time").agg(F.min("l_quantity").cast("double").alias("q"), F.max("l_discount").cast("double").alias("d"))
    return d.select("electrode", "neuron_id", "spike_time").distinct(), prj.select("electrode", "spike_time", F.array("q", "d").alias("pc"))


@query
def train_projections(spark, sf_dir):
    d = editing.train_projections(*_supplier_trains(spark, sf_dir))
    return d.select("electrode", "neuron_id", "spike_time", F.col("pc")[0].alias("pc1"), F.col("pc")[1].alias("pc2"))


@query
def preview_electrode(spark, sf_dir):
    """Merge, delete and recluster on one electrode, one step undone."""
    view = editing.Preview(*_supplier_trains(spark, sf_dir), electrode=3, n_samples=1e6, tau=500)
    view.apply(editing.Action("MERGE", [1, 2]))
    view.apply(editing.Action("DELETE", [5]))
    view.undo()
    view.apply(editing.Action("DELETE", [7]))
    view.apply(editing.Action("RECLUSTER", [3, 4], n_clusters=2, config_tag=""), lambda e: e.withColumn("clust", F.when(F.col("pc")[0] > 30, 1).otherwise(2)))
    return rounded(view.report(), "contamination")


def _log(spark, sf_dir):
    """An order is an action on two customers' neurons; those of a whole thousand consolidate."""
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("int")
    action = F.when(k % 1000 == 0, "CONSOLIDATE").when(k % 3 == 0, "KEEP").when(k % 3 == 1, "DELETE").otherwise("MERGE")
    return table(spark, sf_dir, "orders").select(k.alias("seq"), action.alias("action"), F.when(action == "CONSOLIDATE", F.array().cast("array<int>")).otherwise(F.array(c, c + 7)).alias("ids"))


@query
def actions_since_consolidate(spark, sf_dir):
    return editing.since_consolidate(_log(spark, sf_dir)).select("seq", "action", F.array_join("ids", ",").alias("ids"))


@query
def actions_of_electrode(spark, sf_dir):
    return editing.for_electrode(_log(spark, sf_dir), 3).select("seq", "action")


@query
def action_checks(spark, sf_dir):
    """An action for each order, sound or not, and what is wrong with it."""
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("int")
    action = F.element_at(F.array(*map(F.lit, ["KEEP", "MERGE", "SHRINK", "RECLUSTER", "AUTO_MERGE", "RENAME", "CONSOLIDATE"])), (k % 7 + 1).cast("int"))
    ids = F.when(k % 5 == 0, F.array().cast("array<int>")).when(k % 5 == 1, F.array(c, c)).otherwise(F.array(c - 2, c + 5))
    log = table(spark, sf_dir, "orders").select(k.alias("seq"), action.alias("action"), ids.alias("ids"), F.when(k % 3 > 0, c).alias("master_id"), ((k % 11) / 8).alias("frac"), F.when(k % 13 > 0, k % 4 - 1).cast("double").alias("contam"), (k % 19 - 1).cast("int").alias("n_clusters"), F.when(k % 2 == 0, F.lit("")).alias("config_tag"))
    return editing.invalid(log).select("seq", "action", "wrong")


@query
def missing_ids(spark, sf_dir):
    asked = spark.createDataFrame([(i,) for i in (1, 5, 10**9)], "neuron_id long")
    return editing.missing_ids(asked, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("neuron_id")))


# ----------------------------------------------------------------------------------- datasets, trains, reports


def _weeks(spark, sf_dir):
    e = user_trains(spark, sf_dir)
    first = e.agg(F.min("spike_time").alias("t0"))
    return e.crossJoin(first).withColumn("spike_time", F.col("spike_time") - F.col("t0")).drop("t0"), spark.createDataFrame([("w1", 1, 7 * 86_400_000_000), ("w2", 2, 10 * 86_400_000_000), ("w3", 3, 5 * 86_400_000_000)], "dataset string, ord int, length long")


@query
def split_by_interval(spark, sf_dir):
    return reports.split_by_interval(*_weeks(spark, sf_dir)).select("dataset", "neuron_id", "spike_time")


@query
def concat_offsets(spark, sf_dir):
    events, lengths = _weeks(spark, sf_dir)
    return reports.concat_with_offsets(reports.split_by_interval(events, lengths), lengths).select("dataset", "neuron_id", "spike_time")


@query
def dataset_strings(spark, sf_dir):
    return _dataset_strings(spark, sf_dir).select(*recordings.dataset_columns(F.col("s")))


@query
def classification_labels(spark, sf_dir):
    return stages.parse_labels(_label_lines(spark, sf_dir))


@query
def label_join(spark, sf_dir):
    labels = stages.parse_labels(_label_lines(spark, sf_dir))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("neuron_id"))
    return stages.label_neurons(n, labels)


@query
def export_models(spark, sf_dir):
    p = points(spark, sf_dir).withColumn("clust", (F.col("id") % 2 + 1).cast("int"))
    s = clustering.cluster_stats(p, "electrode", "clust", "v")
    arr = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("i", c))), lambda x: x[c])
    m = s.groupBy("electrode", "clust").agg(arr("centroid").alias("centroid"), arr("variance").alias("variance"), F.max("mix_frac").alias("mix_frac"))
    e = spark.range(0, 14).select(F.col("id").cast("int").alias("electrode")).union(p.select("electrode")).distinct()  # some without points too
    out = stages.export_models(e, m)
    return out.select("electrode", "clust", F.size("centroid").alias("dims"), F.round("mix_frac", 6).alias("mix_frac"))


@query
def export_neurons(spark, sf_dir):
    d = spikes(spark, sf_dir).select((F.col("electrode") + 2).cast("int").alias("electrode"), (F.col("width") % 3).cast("int").alias("clust"), "spike_time")
    return stages.export_neurons(d, offset=5)


@query
def export_spikes(spark, sf_dir):
    return stages.export_spikes(spikes(spark, sf_dir))


@query
def train_intersections(spark, sf_dir):
    return compare.intersections(trains(spark, sf_dir, "l_linenumber"), trains(spark, sf_dir, "l_returnflag"), dealt=True)


@query
def comparator_score(spark, sf_dir):
    return rounded(compare.score(trains(spark, sf_dir, "l_linenumber"), trains(spark, sf_dir, "l_returnflag"), dealt=True), "score")


@query
def comparator_summary(spark, sf_dir):
    s = comparator_score(spark, sf_dir).withColumn("dataset", (F.col("electrode") % 5).cast("int"))
    return rounded(compare.summary(s, "dataset"), "mean", "std", "mean_nonzero", "std_nonzero", digits=9)


@query
def train_correlation(spark, sf_dir):
    e = channels(spark, sf_dir).select(F.col("electrode").alias("neuron_id"), F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 60).alias("spike_time"))
    return rounded(compare.correlation(e, 10), "corr")


@query
def rate_histogram(spark, sf_dir):
    return reports.rate_histogram(channels(spark, sf_dir).select(F.col("electrode").alias("neuron_id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("spike_time")), 20)


def _hours(spark, sf_dir):
    return channels(spark, sf_dir).select(F.col("electrode").alias("neuron_id"), F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600).alias("spike_time"))


@query
def autocorrelogram(spark, sf_dir):
    return rounded(reports.autocorrelogram(_hours(spark, sf_dir), 100, 4), "share")


@query
def acf_smoothed(spark, sf_dir):
    d = reports.smoothed(reports.autocorrelogram(_hours(spark, sf_dir), 100, 4), "neuron_id", "bin", "share")
    return rounded(d.select("neuron_id", "bin", "smooth"), "smooth")


@query
def compound_ei(spark, sf_dir):
    p = points(spark, sf_dir).join(counts(spark, sf_dir), "id").select("electrode", "n", F.posexplode("v").alias("i", "x"))
    return rounded(reports.compound(p, "electrode", "i", "n", "x"), "x")


@query
def ei_stride_sample(spark, sf_dir):
    s = spikes(spark, sf_dir).select(F.col("electrode").alias("neuron_id"), "spike_time")
    return reports.stride_sample(s, 3)


@query
def ei_average(spark, sf_dir):
    s, _ = upright(spark, sf_dir)
    t = ei_stride_sample(spark, sf_dir)
    near = _adjacency(spark, sf_dir, 2).select(F.col("electrode").alias("neuron_id"), F.col("neighbor").alias("electrode"))
    return rounded(reports.average_image(t, s, 2, 6, near), "mean", digits=9)


@query
def asof_trigger(spark, sf_dir):
    c = channels(spark, sf_dir)
    t = detection.trigger_edges(c, F.col("event_type") == "error").select("electrode", F.col("sample").alias("spike_time"))
    return reports.last_trigger(spikes(spark, sf_dir).select("electrode", "spike_time"), t, "electrode", "spike_time")


@query
def sta_average(spark, sf_dir):
    c = channels(spark, sf_dir)
    frames = c.groupBy(F.floor(F.col("sample") / 2).alias("frame")).agg(F.array(F.avg("value")).alias("values"))
    e = spikes(spark, sf_dir).select(F.col("electrode").alias("neuron_id"), F.floor(F.col("spike_time") / 2).alias("frame"))
    return rounded(reports.triggered_average(e, frames, 5).withColumn("mean", F.col("mean")[0]), "mean", digits=9)


@query
def sta_frames(spark, sf_dir):
    """Average of the 30 stimulus frames before an event: a frame is an embedding, 64 values."""
    frames = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("frame"), F.col("embedding").alias("values"))
    e = spikes(spark, sf_dir).select(F.col("electrode").alias("neuron_id"), F.col("spike_time").alias("frame"))
    d = reports.triggered_average(e, frames, 30).select("neuron_id", "back", "n", F.posexplode("mean").alias("i", "mean"))
    return rounded(d, "mean", digits=7)


@query
def display_sample(spark, sf_dir):
    p = points(spark, sf_dir).withColumn("clust", (F.col("id") % 3).cast("int"))
    return reports.display_sample(p, "electrode", "clust", "id", 30).select("electrode", "clust", "id")


@query
def block_diag_order(spark, sf_dir):
    """An order of the channels by how alike their mean points are."""
    p = points(spark, sf_dir)
    m = linear.mean_wave(p, "electrode", "v").groupBy("electrode").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "mean"))), lambda x: x["mean"]).alias("v"))
    near = graph.distances(m.withColumn("all", F.lit(0)), "all", "electrode", "v").select("id_a", "id_b", F.exp(-F.col("d2")).alias("weight"))
    return reports.ordered(m.select("electrode"), near, "electrode")


@query
def electrode_pools(spark, sf_dir):
    return reports.pool_table(table(spark, sf_dir, "supplier"), 12)


# ------------------------------------------------------------------------------- images and their neighbourhoods


def _line(spark, sf_dir):
    """Electrodes on a line, each with those next to it."""
    e = neurons(spark, sf_dir).select("electrode").distinct()
    return e.select("electrode", F.explode(F.array(F.col("electrode") - 1, F.col("electrode"), F.col("electrode") + 1)).alias("neighbor"))


def _images(spark, sf_dir):
    """Eight samples on each of eight electrodes about a neuron's own."""
    cut = lambda j: F.struct((F.col("electrode") + j - 4).alias("at"), F.slice("v", 8 * j + 1, 8).alias("wave"))
    d = neurons(spark, sf_dir).select(F.col("id").alias("neuron_id"), F.explode(F.array(*[cut(j) for j in range(8)])).alias("x"))
    return d.select("neuron_id", F.col("x.at").alias("electrode"), "x.wave")


def _homes(spark, sf_dir):
    return neurons(spark, sf_dir).select(F.col("id").alias("neuron_id"), "electrode")


def _trace_pairs(spark, sf_dir, over):
    pairs = imaging.electrode_pairs(_line(spark, sf_dir), over, adjacent_only=True)
    t = imaging.pair_traces(_images(spark, sf_dir), _homes(spark, sf_dir), pairs)
    return rounded(imaging.trace_distances(t, "pair"), "d2")


@query
def traces_union(spark, sf_dir):
    return _trace_pairs(spark, sf_dir, "union")


@query
def traces_intersection(spark, sf_dir):
    return _trace_pairs(spark, sf_dir, "intersection")


@query
def neighbourhood_sets(spark, sf_dir):
    """Electrodes that the traces of each pair within ten of each other go over, by union and by intersection."""
    both = [imaging.electrode_pairs(_line(spark, sf_dir), o).where("e2 - e1 <= 10").select("e1", "e2", F.lit(o).alias("over"), F.array_join("electrodes", ",").alias("electrodes")) for o in ("union", "intersection")]
    return both[0].unionByName(both[1])


@query
def merge_by_images(spark, sf_dir):
    d = imaging.merge_within(_images(spark, sf_dir), _homes(spark, sf_dir), _line(spark, sf_dir), counts(spark, sf_dir), WITHIN)
    return d.select("electrode", "action", "master_id", F.array_join("ids", ",").alias("ids"))


@query
def discard_by_images(spark, sf_dir):
    """Every pair of electrodes."""
    return imaging.discard_across(_images(spark, sf_dir), _homes(spark, sf_dir), _line(spark, sf_dir), counts(spark, sf_dir), ACROSS, laid_out=True)


@query
def realigned_images(spark, sf_dir):
    d = imaging.realigned(neurons(spark, sf_dir).select(F.col("id").alias("neuron_id"), "electrode", F.col("v").alias("wave")))
    return d.select("neuron_id", "electrode", F.transform("wave", lambda x: F.round(x, 6)).alias("wave"))


@query
def merged_images(spark, sf_dir):
    """Images of two datasets, the second twice as large, averaged by events; some neurons are in one only."""
    own = _images(spark, sf_dir)
    one = own.where("neuron_id % 5 <> 0").withColumn("n", F.col("neuron_id") % 7 + 1)
    two = own.where("neuron_id % 3 <> 0").withColumn("n", F.col("neuron_id") % 4 + 1).withColumn("wave", F.transform("wave", lambda x: 2 * x))
    d = imaging.merge_images(one.unionByName(two)).select("neuron_id", "electrode", "n", F.posexplode("wave").alias("i", "x"))
    return rounded(d, "x")


@query
def clean_datasets(spark, sf_dir):
    """Cleaning of two datasets on one time line: trains of orders by customer, images of embeddings."""
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") - 1).alias("neuron_id"), F.col("o_orderkey").alias("spike_time"))
    t = o.join(neurons(spark, sf_dir).select(F.col("id").alias("neuron_id")), "neuron_id", "left_semi")
    end = table(spark, sf_dir, "orders").agg(F.max("o_orderkey").alias("end"))
    lengths = end.select(F.explode(F.array(F.struct(F.lit("a").alias("dataset"), F.lit(1).alias("ord"), F.floor(F.col("end") / 2).alias("length")), F.struct(F.lit("b").alias("dataset"), F.lit(2).alias("ord"), (F.col("end") + 1 - F.floor(F.col("end") / 2)).alias("length")))).alias("x")).select("x.*")
    own = _images(spark, sf_dir)
    images = own.withColumn("n", F.lit(2)).withColumn("dataset", F.lit("a")).unionByName(own.withColumn("n", F.lit(1)).withColumn("dataset", F.lit("b")))
    d = imaging.clean_datasets(t, lengths, images, _line(spark, sf_dir), _homes(spark, sf_dir), 2, 100.0, 4.0, WITHIN, ACROSS)
    return d.groupBy("dataset", "neuron_id").agg(F.count(F.lit(1)).alias("n"), F.sum("spike_time").alias("total"))


# -------------------------------------------------------------------------------------- recordings and stage tables


@query
def recording_range(spark, sf_dir):
    """Seconds 10 to 20 of a recording at 1 Hz, read back from its blocks, without what its header says is disconnected."""
    path = scratch(spark, "recording")
    recordings.write_recording(channels(spark, sf_dir).select(F.lit("run").alias("dataset"), "electrode", "sample", "value"), path, 1, (1, 4), size=8)
    r = recordings.Recording(spark, path, "run(10-20)")
    return rounded(r.scan(connected=True).select("electrode", "sample", "value"), "value", digits=4)


@query
def synthetic_recording(spark, sf_dir):
    """A made recording: an electrode for each nation, a sample for each customer, a planted unit for each region; written as
    blocks and read back."""
    path = scratch(spark, "synthetic")
    electrodes, samples = (table(spark, sf_dir, t).count() for t in ("nation", "customer"))
    units = [(2 + 4 * r["r_regionkey"], 50 + 10 * r["r_regionkey"], 211 + 30 * r["r_regionkey"]) for r in table(spark, sf_dir, "region").orderBy("r_regionkey").collect()]
    recordings.to_blocks(recordings.synthetic(spark, electrodes, samples, units), 4_096).write.parquet(path)
    d = recordings.scan(spark.read.parquet(path), size=4_096)
    return rounded(d.select("electrode", "sample", "value"), "value", digits=2)


@query
def recording_header(spark, sf_dir):
    path = scratch(spark, "recording")
    recordings.write_recording(channels(spark, sf_dir).select(F.lit("run").alias("dataset"), "electrode", "sample", "value"), path, 1, (1, 4))
    r = recordings.Recording(spark, path, "run(3-)")
    return spark.createDataFrame([(r.header["dataset"], r.n_electrodes, r.start, r.stop, len(r.disconnected))], "dataset string, electrodes int, start long, stop long, disconnected int")


def _grid(spark, sf_dir):
    """Suppliers on a grid ten wide."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(k.alias("electrode"), (k % 10).cast("double").alias("x"), F.floor(k / 10).cast("double").alias("y"))


@query
def adjacency_usage(spark, sf_dir):
    both = [recordings.adjacency(_grid(spark, sf_dir), u).withColumn("usage", F.lit(u)) for u in (0, 1, 2)]
    return both[0].unionByName(both[1]).unionByName(both[2]).select("usage", "electrode", "neighbor", "ord")


@query
def adjacency_degrees(spark, sf_dir):
    return recordings.degrees(recordings.adjacency(_grid(spark, sf_dir), 2))


def _spike_stage(spark, sf_dir, partition_by=None):
    st = stages.Stages(spark, scratch(spark, "stages"))
    st.run("run-spikes", lambda: spikes(spark, sf_dir), partition_by=partition_by)
    return st


@query
def stage_load(spark, sf_dir):
    return rounded(_spike_stage(spark, sf_dir).load("run-spikes"), "amplitude", digits=9)


@query
def stage_columns(spark, sf_dir):
    return _spike_stage(spark, sf_dir).load("run-spikes", "electrode", "spike_time")


@query
def stage_electrode(spark, sf_dir):
    """One electrode's rows of a table that is kept by electrode."""
    d = _spike_stage(spark, sf_dir, "electrode").load("run-spikes", where=F.col("electrode") == 5)
    return rounded(d.select(F.col("electrode").cast("long").alias("electrode"), "spike_time", "width", "amplitude"), "amplitude", digits=9)


@query
def stage_cells(spark, sf_dir):
    """Some electrodes' rows, the bound reaching the files."""
    return _spike_stage(spark, sf_dir).load("run-spikes", "electrode", "spike_time", where=F.col("electrode").isin(2, 3, 7))


@query
def stage_discovery(spark, sf_dir):
    st = _spike_stage(spark, sf_dir)
    st.run("run-edited", lambda: spikes(spark, sf_dir).limit(0))
    rows = []
    for pattern in ("*-spikes", "*-neurons", "run-*"):
        try:
            found = st.find(pattern)
            rows.append((pattern, found and found.rstrip("/").rsplit("/", 1)[1]))
        except ValueError:
            rows.append((pattern, "several"))
    return spark.createDataFrame(rows, "pattern string, found string")


@query
def noise_file(spark, sf_dir):
    """Noise of each channel written as lines, read back by place."""
    nth = Window.partitionBy().orderBy("e")  # a row a channel
    sigma = channels(spark, sf_dir).groupBy(F.col("electrode").alias("e")).agg(F.stddev_samp("value").alias("sigma"))
    d = written(sigma.select(F.row_number().over(nth).alias("electrode"), F.round("sigma", 6).alias("sigma")), "sigma")
    path = scratch(spark, "noise")
    stages.write_noise(d, path)
    return stages.read_noise(spark, path, d.count())


@query
def noise_table(spark, sf_dir):
    """The copy of the noise in binary form."""
    sigma = channels(spark, sf_dir).groupBy(F.col("electrode").alias("electrode")).agg(F.stddev_samp("value").alias("sigma"))
    path = scratch(spark, "noise")
    stages.write_noise(sigma, path, f"{path}-table")
    return rounded(spark.read.parquet(f"{path}-table"), "sigma")


@query
def projections_reader(spark, sf_dir):
    """Projections kept by electrode, read back."""
    path = scratch(spark, "kept-projections")
    p = _supplier_trains(spark, sf_dir)[1]
    stages.write_projections(p, path)
    d = stages.read_projections(spark, path)
    return d.select(F.col("electrode").cast("long").alias("electrode"), "spike_time", F.col("pc")[0].alias("pc1"), F.col("pc")[1].alias("pc2"))


@query
def dataset_list(spark, sf_dir):
    path = scratch(spark, "list")
    blank = spark.createDataFrame([("",), ("  ",)], "value string")
    _dataset_strings(spark, sf_dir).toDF("value").unionByName(blank).write.text(path)
    return stages.read_lines(spark, path).select(*recordings.dataset_columns(F.col("line")))


@query
def spikes_stage(spark, sf_dir):
    c, path = channels(spark, sf_dir), scratch(spark, "spikes")
    edges = detection.trigger_edges(c, F.col("event_type") == "error")
    stages.spikes_stage(spikes(spark, sf_dir), edges, c.agg(F.max("sample") + 1).collect()[0][0]).write.parquet(path)
    return spark.read.parquet(path)


@query
def covariance_stage(spark, sf_dir):
    """Means, counts and variances of a stage, written and read."""
    st, p = stages.Stages(spark, scratch(spark, "stages")), points(spark, sf_dir)
    st.run("run-cov", lambda: linear.covariance(linear.moments(p, "electrode", "v"), "electrode"), partition_by="electrode")
    st.run("run-mean", lambda: linear.mean_wave(p, "electrode", "v"))
    c = st.load("run-cov", where=F.col("i") == F.col("j")).select(F.col("electrode").cast("int").alias("electrode"), "i", "cov")
    return rounded(st.load("run-mean").join(c, ["electrode", "i"]), "mean", "cov")


@query
def model_stage(spark, sf_dir):
    st = stages.Stages(spark, scratch(spark, "stages"))
    p = points(spark, sf_dir).withColumn("clust", (F.col("id") % 3).cast("int"))
    st.run("run-model", lambda: clustering.cluster_stats(p, "electrode", "clust", "v"))
    return rounded(st.load("run-model", "electrode", "clust", "i", "centroid", "n"), "centroid")


@query
def action_stack(spark, sf_dir):
    """Automatic actions of a run: removals first, then merges, as one table."""
    st = stages.Stages(spark, scratch(spark, "stages"))
    n = neurons(spark, sf_dir).select("electrode", "id").join(counts(spark, sf_dir), "id", "left").where(F.coalesce("n", F.lit(0)) < 5)
    gone = n.groupBy("electrode").agg(F.array_sort(F.collect_list("id")).alias("ids")).select("electrode", F.lit("AUTO_RM").alias("action"), F.lit(None).cast("long").alias("master_id"), "ids")
    st.run("run-clean", lambda: gone.unionByName(graph.merge_actions(_kept(spark, sf_dir), "electrode").select("electrode", "action", "master_id", "ids")))
    return st.load("run-clean").select("electrode", "action", "master_id", F.array_join("ids", ",").alias("ids"))


@query
def label_rewrite(spark, sf_dir):
    """Labels are rewritten beside the one classification that there was."""
    folder = scratch(spark, "labels")
    _label_lines(spark, sf_dir).coalesce(1).write.text(f"{folder}/run.classification")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("neuron_id"), F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("Edited/"), F.col("n_name"))).otherwise(F.lit("")).alias("label"))
    return stages.parse_labels(spark.read.text(stages.rewrite_labels(spark, n, folder)))


@query
def neuron_reader(spark, sf_dir):
    path = scratch(spark, "neurons")
    export_neurons(spark, sf_dir).write.parquet(path)
    return stages.read_neurons(spark, path).select("neuron_id", "electrode", "n", F.array_join("times", ",").alias("times"))


@query
def image_reader(spark, sf_dir):
    """Images appended in two goes, a mean and an error plane; the mean of each is read."""
    path, own = scratch(spark, "images"), _images(spark, sf_dir).withColumn("n", F.col("neuron_id") % 5 + 1)
    stages.append_images(own.where("neuron_id % 2 = 0").withColumn("plane", F.lit(0)), path)
    stages.append_images(own.where("neuron_id % 2 = 1").withColumn("plane", F.lit(0)).unionByName(own.withColumn("plane", F.lit(1)).withColumn("wave", F.transform("wave", lambda x: x * 0))), path)
    return rounded(stages.read_images(spark, path).select("neuron_id", "n", "electrode", F.posexplode("wave").alias("i", "x")), "x")


@query
def export_projections(spark, sf_dir):
    p = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("electrode"), F.when(F.col("n_regionkey") > 0, F.array("n_nationkey", "n_regionkey")).otherwise(F.array().cast("array<int>")).alias("pc"))
    path = scratch(spark, "projections")
    stages.export_projections(p).write.parquet(path)
    return spark.read.parquet(path).select("electrode", F.array_join("pc", ",").alias("pc"))


@query
def selected_copy(spark, sf_dir):
    path, n = scratch(spark, "copy"), table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).cast("int").alias("neuron_id"), F.col("o_orderkey").alias("spike_time"))
    ids = spark.createDataFrame([(i,) for i in (1, 5, 9, 9, 99)], "neuron_id int")
    stages.copy_selected(n, ids, path, raw=n.where("neuron_id < 9"))
    return spark.read.parquet(path)


@query
def nearest_model(spark, sf_dir):
    p = points(spark, sf_dir).withColumn("clust", (F.col("id") % 3).cast("int"))
    s = clustering.cluster_stats(p, "electrode", "clust", "v")
    arr = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("i", c))), lambda x: x[c])
    m = s.groupBy("electrode", "clust").agg(arr("centroid").alias("centroid"), arr("variance").alias("variance"), F.max("mix_frac").alias("mix_frac"))
    return stages.nearest_model(p.select("electrode", F.col("id").alias("spike_time"), F.col("v").alias("pc")), m)


@query
def settings_tags(spark, sf_dir):
    """The settings that each supplier's runs have, its tag going by its number."""
    names = ("buffer_size", "landmarks", "retries", "min_spikes", "whitening", "quality_tolerance")
    tags = ["", *settings.TAGS]
    rows = [(i, t, *(getattr(settings.settings(*[t] * bool(t)), f) for f in names)) for i, t in enumerate(tags)]  # a row a tag
    known = spark.createDataFrame(rows, "place long, tag string, buffer_size int, landmarks int, retries int, min_spikes int, whitening boolean, quality_tolerance double")
    runs = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") % len(tags)).alias("place"))
    return runs.join(known, "place").select("s_suppkey", "tag", *names)


@query
def set_operations(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"))
    b = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_nationkey").alias("k"))
    parts = [a.intersect(b).withColumn("kind", F.lit("both")), a.subtract(b).withColumn("kind", F.lit("left")), a.union(b).distinct().withColumn("kind", F.lit("any"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("kind", "k")


@query
def final_or_raw(spark, sf_dir):
    raw = table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("x"))
    final = table(spark, sf_dir, "part").where("p_size > 25").select("p_partkey", (F.col("p_retailprice") * 2).alias("x"))
    return rounded(stages.final_or_raw(final, raw, "p_partkey", "x"), "x")


assert set(STATUS) == {-2, -1, 0, 1, 2, 3}
