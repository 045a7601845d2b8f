"""Identifiers, status codes and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Most clusters on an electrode; the first electrode is the trigger channel; status codes.
MAX_CLUSTERS = 15
FIRST_ELECTRODE = 2
# What is said of a status code; a merged neuron's names its master, a duplicate's its master and that one's electrode from 0.
STATUS = {-2: "Discard", -1: "Unknown", 0: "Keep", 1: "Contam / Low count", 2: "Merge with %d", 3: "Dup. of ID %d, El %d"}


def neuron_id(electrode: Column, cluster: Column) -> Column:
    return ((electrode - FIRST_ELECTRODE) * MAX_CLUSTERS + cluster).cast("int")


def electrode_of(neuron: Column) -> Column:
    return (F.floor((neuron - 1) / MAX_CLUSTERS) + FIRST_ELECTRODE).cast("int")


def cluster_of(neuron: Column) -> Column:
    return (F.pmod(neuron - 1, F.lit(MAX_CLUSTERS)) + 1).cast("int")


def rate(count: Column, n_samples: Column, sampling_hz: int = 20_000) -> Column:
    return count * F.lit(float(sampling_hz)) / n_samples


def status_label(code: Column, master: Column) -> Column:
    """The code in words."""
    out = F.when(code == 2, F.format_string(STATUS[2], master)).when(code == 3, F.format_string(STATUS[3], master, electrode_of(master) - 1))
    for k in (-2, -1, 0, 1):
        out = out.when(code == k, F.lit(STATUS[k]))
    return out.otherwise(F.lit(STATUS[-1]))
