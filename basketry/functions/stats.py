"""Statistics used by the basket operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stddev_or_zero(col: str | Column) -> Column:
    """Sample standard deviation (n - 1), 0.0 for groups of one value."""
    return F.coalesce(F.stddev_samp(col), F.lit(0.0))
