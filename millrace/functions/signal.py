"""Levels, pitch and onsets of sampled signals held as arrays of numbers.

`rms` is a plain expression; the others run per Arrow batch in numpy, as they need the whole
signal of a row at once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def rms(samples: Column) -> Column:
    """Root mean square of an array; null for empty arrays."""
    total = F.aggregate(samples, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return F.when(F.size(samples) > 0, F.sqrt(total / F.size(samples)))


def frame_pitch(frame: np.ndarray, rate: int, low: float = 60.0, high: float = 400.0, gate: float = 0.02, least: float = 0.35) -> float:
    """Pitch of one frame by the best lag of its autocorrelation; 0 for quiet or aperiodic frames."""
    x = np.asarray(frame, dtype=float)
    if len(x) == 0 or np.sqrt(np.mean(x * x)) < gate:
        return 0.0
    x = x - x.mean()
    energy = float(x @ x)
    first, last = int(rate / high), min(int(rate / low), len(x) - 1)
    if energy <= 0 or first >= last:
        return 0.0
    scores = np.correlate(x, x, "full")[len(x) - 1 :][first : last + 1] / energy
    best = int(np.argmax(scores))
    return rate / (first + best) if scores[best] >= least else 0.0


def median_pitch(rate: int, frame: int, hop: int, least_frames: int = 8):
    """Column function: median pitch of the voiced frames of a signal, 0 with fewer than needed."""

    @F.pandas_udf("double")
    def pitch(signals: pd.Series) -> pd.Series:
        def one(s) -> float | None:
            if s is None:
                return None
            x = np.asarray(s, dtype=float)
            found = [p for i in range(0, len(x) - frame + 1, hop) if (p := frame_pitch(x[i : i + frame], rate))]
            return float(np.median(found)) if len(found) >= least_frames else 0.0

        return signals.map(one)

    return pitch


def onset_seconds(rate: int, window: float = 0.012, factor: float = 2.5, floor: float = 0.0009, hold: float = 0.010):
    """Column function: time at which the level first stays over its threshold for `hold` seconds.

    The threshold is `factor` times the quietest tenth of the windows, at least `floor`.
    """

    @F.pandas_udf("double")
    def onset(signals: pd.Series) -> pd.Series:
        def one(s) -> float | None:
            if s is None:
                return None
            x = np.asarray(s, dtype=float)
            n = max(1, int(rate * window))
            if len(x) < n:
                return None
            power = np.convolve(x * x, np.ones(n) / n, "valid")
            level = np.sqrt(np.maximum(power, 0))
            over = level > max(factor * float(np.quantile(level, 0.1)), floor)
            need = max(1, int(rate * hold))
            run = np.convolve(over.astype(int), np.ones(need, dtype=int), "valid")
            at = np.flatnonzero(run == need)
            return float(at[0] / rate) if len(at) else None

        return signals.map(one)

    return onset
