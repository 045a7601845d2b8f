"""Waveforms cut from a stream of samples, with a ring of the latest samples of each channel kept between micro-batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from ..session import ship

STATE = "at array<long>, value array<double>, pending array<long>"
OUT = "electrode {kind}, spike_time long, wave array<double>"


def push(state: tuple, rows: Iterable[tuple[int, float, bool]], left: int, right: int) -> tuple[tuple, list[tuple[int, list[float]]]]:
    """State after the rows (sample, value, hit), and the windows that they completed: (time, values). The ring holds
    left + right + 1 samples, whatever comes; a window that begins before the first sample is left out."""
    at, value, pending = (list(x) for x in state)
    size, found = left + right + 1, []
    for sample, v, hit in rows:
        at.append(sample)
        value.append(v)
        if hit:
            pending.append(sample)
        if len(at) > size:
            del at[0], value[0]
        if pending and sample >= pending[0] + right:
            t = pending.pop(0)
            if len(at) == size and at[0] == t - left and at[-1] == t + right:
                found.append((t, value.copy()))
    return (at, value, pending), found


def window_stream(samples: DataFrame, left: int, right: int, hit: str = "hit") -> DataFrame:
    """electrode, spike_time, wave from a streaming (electrode, sample, value, hit): the samples from `left` before to `right`
    after each hit, as soon as the last has come. Each micro-batch holds later samples of a channel than those before it,
    without gaps. Append mode; a channel's state is left + right + 1 samples and the hits among the last `right`."""
    ship(samples.sparkSession)
    kind = {f.name: f.dataType.simpleString() for f in samples.schema}["electrode"]

    def run(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        d = pd.concat(list(frames)).sort_values("sample")
        held = state.get if state.exists else ((), (), ())
        new, found = push(held, zip(d["sample"].tolist(), d["value"].tolist(), d[hit].tolist()), left, right)
        state.update(new)
        yield pd.DataFrame({"electrode": [key[0]] * len(found), "spike_time": [t for t, _ in found], "wave": [w for _, w in found]})

    return samples.groupBy("electrode").applyInPandasWithState(run, OUT.format(kind=kind), STATE, "append", "NoTimeout")
