"""Numbers and robust statistics as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Makes a median absolute deviation comparable with a standard deviation.
MAD_SCALE = 1.4826


def trunc0(x: Column) -> Column:
    """Towards zero, as a float is cut to an integer."""
    return F.when(x < 0, F.ceil(x)).otherwise(F.floor(x))


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def median(x: Column) -> Column:
    """Exact and interpolated, as an aggregate."""
    return F.percentile(x, F.lit(0.5))
