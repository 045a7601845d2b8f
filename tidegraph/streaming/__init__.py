"""The detector, and the cutting of waveforms, over a stream of sample batches."""

from .detector import detect_stream, drift_step, scan_state
from .windows import push, window_stream

__all__ = ["detect_stream", "drift_step", "push", "scan_state", "window_stream"]
