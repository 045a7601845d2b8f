"""Event detection over a stream of ordered samples, with the state of each channel kept between micro-batches.

A channel's state is the drift filter's memory, the open run beyond the threshold (first sample, lowest value and where it
was) and the time of the last candidate. The result equals the batch detector's on the same samples, however they are cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from ..session import ship

STATE = "drift double, started boolean, open boolean, up long, low double, low_at long, last long"
EMPTY = (0.0, False, False, 0, 0.0, 0, -1)
OUT = "electrode {kind}, spike_time long, width long, amplitude double"


def drift_step(drift: float, value: float, alpha: float) -> tuple[float, float]:
    """The filter's new memory and what it lets through."""
    drift = (1 - alpha) * drift + alpha * value
    return drift, value - drift


def scan_state(state: tuple, rows: Iterator[tuple[int, float]], threshold: float, max_width: int, min_gap: int, alpha: float = 0.0) -> tuple[tuple, list[tuple[int, int, float]]]:
    """State after the rows (sample, value), and the events that were finished: (time, width, amplitude)."""
    drift, started, is_open, up, low, low_at, last = state
    found = []
    for sample, value in rows:
        if alpha:
            if not started:
                drift = value
            drift, value = drift_step(drift, value, alpha)
        started = True
        hot = value < -threshold
        if hot and not is_open:
            is_open, up, low, low_at = True, sample, value, sample
        elif is_open:
            if value < low:
                low, low_at = value, sample
            if not hot:
                if sample - up <= max_width and (last < 0 or low_at - last > min_gap):
                    found.append((low_at, sample - up, -low))
                last, is_open = low_at, False
    return (drift, started, is_open, up, low, low_at, last), found


def detect_stream(samples: DataFrame, threshold: str = "threshold", max_width: int = 50, min_gap: int = 5, alpha: float = 0.0) -> DataFrame:
    """electrode, spike_time, width, amplitude from a streaming (electrode, sample, value, threshold); each micro-batch holds
    later samples of a channel than those before it. Append mode; the state of a channel is one small row."""
    ship(samples.sparkSession)
    kind = {f.name: f.dataType.simpleString() for f in samples.schema}["electrode"]

    def run(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        d = pd.concat(list(frames)).sort_values("sample")
        new, found = scan_state(state.get if state.exists else EMPTY, zip(d["sample"].tolist(), d["value"].tolist()), float(d[threshold].iloc[0]), max_width, min_gap, alpha)
        state.update(new)
        yield pd.DataFrame({"electrode": [key[0]] * len(found), "spike_time": [f[0] for f in found], "width": [f[1] for f in found], "amplitude": [f[2] for f in found]})

    return samples.groupBy("electrode").applyInPandasWithState(run, OUT.format(kind=kind), STATE, "append", "NoTimeout")
