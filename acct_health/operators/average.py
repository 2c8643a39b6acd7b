"""Averages and sums that do not depend on the order of summation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_avg(c: Column | str, scale: int = 2) -> Column:
    """Mean of a column of at most ``scale`` decimals: summed as decimal, divided once (NULL over no rows)."""
    c = F.col(c) if isinstance(c, str) else c
    total = F.sum(c.cast(f"decimal(28,{scale})")).cast("double")
    return F.when(F.count(c) > 0, total / F.count(c))


def exact_sum(c: Column | str, scale: int = 2, decimals: int = 4) -> Column:
    """Sum of a column of at most ``decimals`` decimals, added as decimal, rounded to ``scale`` (NULL over no values)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(F.sum(c.cast(f"decimal(28,{decimals})")), scale).cast("double")
