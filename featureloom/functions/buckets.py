"""Fixed-edge buckets: edges, presets and exact index assignment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cells import _col

# Axis limits and bucket count of the two spectral presets.
PRESETS = {"1H": (-1.0, 16.0, 200), "13C": (-10.0, 230.0, 200)}


def preset(name: str) -> tuple[float, float, int]:
    """``(lo, hi, n)`` of a preset."""
    if name not in PRESETS:
        raise ValueError(f"unknown preset {name!r}, expected one of {sorted(PRESETS)}")
    return PRESETS[name]


def _step(lo: float, hi: float, n: int) -> float:
    if n < 1 or not hi > lo:
        raise ValueError(f"need hi > lo and n >= 1, got lo={lo}, hi={hi}, n={n}")
    return (float(hi) - float(lo)) / n


def bucket_edges(lo: float, hi: float, n: int = 200) -> list[float]:
    """The ``n + 1`` edges; edge ``i`` is ``i * step + lo`` and the last one is ``hi``."""
    step = _step(lo, hi, n)
    return [i * step + float(lo) for i in range(n)] + [float(hi)]


def bucket_index(value, lo: float, hi: float, n: int = 200) -> Column:
    """Index of the half-open bucket that holds ``value``; the top edge is in the last one.

    Null for null, NaN and values outside ``[lo, hi]``. The arithmetic guess can be one
    off next to an edge, so it is corrected against the edges themselves.
    """
    v = _col(value).cast("double")
    step = F.lit(_step(lo, hi, n))
    low = F.lit(float(lo))
    guess = F.least(
        F.greatest(F.floor((v - low) / step).cast("int"), F.lit(0)), F.lit(n - 1)
    )
    index = (
        F.when((guess < n - 1) & (v >= (guess + 1) * step + low), guess + 1)
        .when(v < guess * step + low, guess - 1)
        .otherwise(guess)
    )
    inside = (v >= low) & (v <= F.lit(float(hi))) & ~F.isnan(v)
    return F.when(inside, index)
