"""Column functions: everything here stays inside the JVM."""

from .advice import macd_advice, momentum, rsi_advice, rsi_note, trend, volume_surge
from .candle import candle_pattern, pivot_levels, true_range, volume_profile
from .signals import signal_message, signal_strength
from .timeframes import bucket_start, interval_seconds, local_time

__all__ = [
    "bucket_start", "candle_pattern", "interval_seconds", "local_time", "macd_advice",
    "momentum", "pivot_levels", "rsi_advice", "rsi_note", "signal_message", "signal_strength", "trend",
    "true_range", "volume_profile", "volume_surge",
]
