"""Latest non-null value per group (ARRAY_AGG(x IGNORE NULLS ORDER BY d DESC LIMIT 1)[0])."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from acct_health.functions.text import _col


def latest_non_null(x: Column | str, by: Column | str) -> Column:
    """Aggregate: the non-null ``x`` with the greatest ``by`` (NULL ``by`` ranks last; ties
    go to the greatest ``x``). Rows with NULL ``x`` are ignored.

    ``max(struct(by, x))`` keeps rows whose ``by`` is NULL (``max_by`` would drop them)
    and is a two-phase aggregate, so it combines map-side.
    """
    xv, bv = _col(x), _col(by)
    return F.max(F.when(xv.isNotNull(), F.struct(bv.alias("by"), xv.alias("x"))))["x"]
