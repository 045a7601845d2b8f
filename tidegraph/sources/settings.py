"""Settings: a frozen dataclass of defaults, named sets of overrides, and a reader of registry files. Nothing is evaluated."""

from __future__ import annotations

import re
from dataclasses import dataclass, fields, replace


# The defaults.
@dataclass(frozen=True)
class Settings:
    sampling_hz: int = 20_000
    buffer_size: int = 16_384
    upsampling: int = 16
    noise_seconds: float = 5.0
    noise_skip_seconds: float = 5.0
    spike_threshold: float = 4.0
    ttl_threshold: float = 1_000.0
    drift_seconds: float = 0.01
    max_width: int = 50
    min_gap: int = 5
    left: int = 5
    right: int = 15
    electrode_usage: int = 1
    whitening: bool = True
    dims: int = 5
    landmarks: int = 2_500
    kmeans_points: int = 20_000
    max_clusters: int = 15
    neighbour: int = 5
    quality_tolerance: float = 0.015
    min_cluster_spikes: int = 100
    retries: int = 10
    ei_left: int = 20
    ei_right: int = 60
    ei_spikes: int = 3_000
    sta_depth: int = 30
    sta_offset: int = -1
    min_spikes: int = 100
    max_contamination: float = 0.1
    merge_threshold: float = 0.1
    discard_threshold: float = 0.1
    tau: int = 30
    workers: int = 12
    ei_threads: int = 4
    sta_threads: int = 10
    raw_eis: bool = True
    raw_stas: bool = True
    final_eis: bool = True
    final_stas: bool = True


# The tags that come with it and what each sets.
TAGS: dict[str, dict[str, object]] = {
    "DEFAULT": {"workers": 4, "landmarks": 2_500, "kmeans_points": 20_000, "min_spikes": 100, "max_contamination": 0.1},
    "VINCENT1": {"workers": 14, "buffer_size": 32_768, "retries": 3, "min_spikes": 500, "max_contamination": 0.1, "ei_threads": 14, "sta_threads": 14},
    "LIGHT_CLUST": {"workers": 4, "landmarks": 1_000, "kmeans_points": 10_000, "raw_eis": False, "final_eis": True},
    "VINCENT2": {"workers": 14, "buffer_size": 32_768, "retries": 3, "min_spikes": 500, "max_contamination": 0.1, "ei_threads": 14, "sta_threads": 14, "raw_stas": False, "final_stas": False},
    "QT0.001": {"workers": 8, "buffer_size": 16_384, "retries": 3, "min_spikes": 500, "max_contamination": 0.1, "ei_threads": 10, "sta_threads": 10, "quality_tolerance": 0.001},
    "QT0.005": {"workers": 8, "buffer_size": 16_384, "retries": 3, "min_spikes": 500, "max_contamination": 0.1, "ei_threads": 10, "sta_threads": 10, "quality_tolerance": 0.005},
    "QT0.010": {"workers": 8, "buffer_size": 16_384, "retries": 3, "min_spikes": 500, "max_contamination": 0.1, "ei_threads": 10, "sta_threads": 10, "quality_tolerance": 0.010},
    "QT0.020": {"workers": 8, "buffer_size": 16_384, "retries": 3, "min_spikes": 500, "max_contamination": 0.1, "ei_threads": 10, "sta_threads": 10, "quality_tolerance": 0.020},
    "QT0.025": {"workers": 8, "buffer_size": 16_384, "retries": 3, "min_spikes": 500, "max_contamination": 0.1, "ei_threads": 10, "sta_threads": 10, "quality_tolerance": 0.025},
    "QT0.030": {"workers": 8, "buffer_size": 16_384, "retries": 3, "min_spikes": 500, "max_contamination": 0.1, "ei_threads": 10, "sta_threads": 10, "quality_tolerance": 0.030},
    "NO_WHITE": {"workers": 24, "buffer_size": 16_384, "retries": 3, "min_spikes": 500, "max_contamination": 0.1, "ei_threads": 10, "sta_threads": 10, "whitening": False},
}


def parse_value(text: str, like: object) -> object:
    text = text.strip().rstrip(";").strip().strip("'\"")
    if isinstance(like, bool):
        if text.lower() not in ("true", "false", "0", "1"):
            raise ValueError(f"not a truth value: {text}")
        return text.lower() in ("true", "1")
    return type(like)(float(text)) if isinstance(like, int) else type(like)(text)


def parse_overrides(lines: list[str]) -> dict[str, object]:
    """'name = value' lines; blank ones and those that begin with % are skipped, others raise."""
    known = {f.name: f.default for f in fields(Settings)}
    out: dict[str, object] = {}
    for line in lines:
        line = line.strip()
        if not line or line.startswith("%"):
            continue
        m = re.fullmatch(r"(\w+)\s*=\s*([^%]+)(?:%.*)?", line)
        name = m and NAMES.get(m[1], m[1])
        if name in IGNORED:
            continue
        if name not in known:
            raise ValueError(f"bad line: {line}")
        out[name] = parse_value(m[2], known[name])
    return out


def parse_registry(lines: list[str], header: int = 6) -> dict[str, tuple[str, str]]:
    """TAG::path::comment lines after a header -> tag: (path, comment)."""
    out = {}
    for line in lines[header:]:
        if line.strip():
            parts = line.rstrip("\n").split("::")
            if len(parts) != 3:
                raise ValueError(f"bad line: {line}")
            out[parts[0].strip()] = parts[1].strip(), parts[2].strip()
    return out


# What override files call the fields that are named otherwise here.
NAMES = {
    "nWorkers": "workers", "bufferMaxSize": "buffer_size", "upSampleRatio": "upsampling", "sampleRate": "sampling_hz", "noiseTime": "noise_seconds", "noiseTimeToSkip": "noise_skip_seconds",
    "spikeThreshold": "spike_threshold", "ttlThreshold": "ttl_threshold", "meanTimeConstant": "drift_seconds", "minSpikeSeparation": "min_gap", "maxSpikeWidth": "max_width", "nLPoints": "left", "nRPoints": "right",
    "electrodeUsage": "electrode_usage", "projNDimensions": "dims", "maxClusteringTries": "retries", "minSpikesForClustering": "min_cluster_spikes", "spikesForLaplacian": "landmarks", "spikesForKMeans": "kmeans_points",
    "nthNeighbor": "neighbour", "maxEigenVectAndClusters": "max_clusters", "qualityTol": "quality_tolerance", "computeRawEIs": "raw_eis", "computeRawSTAs": "raw_stas", "computeFinalEIs": "final_eis", "computeFinalSTAs": "final_stas",
    "minSpikes": "min_spikes", "maxContamination": "max_contamination", "EILeftPoints": "ei_left", "EIRightPoints": "ei_right", "EISpikesToAverage": "ei_spikes", "EInThreads": "ei_threads", "STADepth": "sta_depth",
    "STAOffset": "sta_offset", "STAnThreads": "sta_threads", "EIMergeThresholdWithin": "merge_threshold", "EIMergeThresholdGlobal": "discard_threshold",
}
IGNORED = {"paramsnThreads", "computeFinalParams", "keepNeuronsRaw"}  # of jobs that there are none of here


def settings(*tags: str, overrides: dict[str, object] | None = None) -> Settings:
    """Defaults, then each tag's overrides, then others; an unknown tag raises."""
    out = Settings()
    for tag in tags:
        if tag not in TAGS:
            raise ValueError(f"unknown tag {tag}")
        out = replace(out, **TAGS[tag])
    return replace(out, **(overrides or {}))


def load_settings(spark, registry: str, tag: str = "") -> Settings:
    """Defaults with the overrides of the file that the registry names for the tag; without a tag, the defaults. Paths are
    relative to the registry's folder's parent where they begin with a dot. Read by Spark's text reader, so they may lie in
    any store; both files are short. An unknown tag raises."""
    if not tag:
        return Settings()
    lines = lambda path: [r.value for r in spark.read.text(path, wholetext=True).collect()][0].splitlines()
    found = parse_registry(lines(registry))
    if tag not in found:
        raise ValueError(f"unknown tag {tag}")
    path = found[tag][0]
    if path.startswith("."):
        path = registry.rsplit("/", 2)[0] + "/" + path.removeprefix("./")
    return replace(Settings(), **parse_overrides(lines(path)))
