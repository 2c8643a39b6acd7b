"""Distributed global NTILE.

``ntile(k) OVER (ORDER BY ...)`` without PARTITION BY plans as one task that sorts every
row. Here no row is sorted: the k - 1 keys at which tiles begin are found by exact selection
(``operators/selection.py``), for all the rankings asked for at once, and a row's tile is then
the number of those keys that are not behind its own, plus one: a comparison with literals, which stays in the
projection of the plan that follows.

The order ends with a unique tie-break, so the result is reproducible.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acct_health.operators.selection import Order, at_or_behind, key_digits, select_ranks
from acct_health.plans.scratch import written

_PART_BITS = 33  # monotonically_increasing_id: partition << 33 | position in it


def tile_starts(n: int, k: int) -> list[int]:
    """0-based ranks at which tiles 2 to k begin: of n rows, the first n mod k tiles hold n div k + 1, the others n div k.
    A tile without rows begins at no row."""
    small, more = divmod(n, k)
    return [s for s in (small * i + min(i, more) for i in range(1, k)) if s < n]


def tiles(df: DataFrame, k: int, rankings: Mapping[str, Order]) -> dict[str, Column] | None:
    """For each ranking (a list of (column, descending)) the expression of NTILE(k) over it; null if some rows
    that a tile's start falls between are equal in a whole ranking.

    ASC puts NULLs first and DESC puts them last (Spark's and the reference's defaults). Runs jobs over ``df``, a number of scans
    that grows with the width of the keys only; nothing is written or sorted."""
    if k < 1:
        raise ValueError("k must be >= 1")
    keys = [key_digits(df, order) for order in rankings.values()]
    total, found = select_ranks(df, keys, lambda n: [r for s in tile_starts(n, k) for r in (s - 1, s)])
    out = {}
    for name, digits, at in zip(rankings, keys, found):
        tile = F.lit(1)
        for s in tile_starts(total, k):
            if at[s][1] > 1 and at[s - 1] == at[s]:
                return None
            tile = tile + at_or_behind(digits, at[s][0]).cast("int")
        out[name] = tile.cast("int")
    return out


def ntile_many(df: DataFrame, k: int, rankings: Mapping[str, Order]) -> DataFrame:
    """Add a column NTILE(k) for each of ``rankings``, by name: (column, descending), ending with what makes rows unique.
    Rows that are equal in all columns of a ranking get their tiles by a sort."""
    made = tiles(df, k, rankings)
    if made is not None:
        return df.withColumns(made)
    for name, order in rankings.items():
        df = ntile_by_rank(df, k, order, name)
    return df


def ntile_global(df: DataFrame, k: int, order: Order, tie_break: Sequence[str], out: str) -> DataFrame:
    """Add ``out`` = NTILE(k) over ``order`` + ``tie_break`` (ascending): with n rows, the first n mod k tiles hold
    n div k + 1 rows, the others n div k."""
    return ntile_many(df, k, {out: [*order, *[(c, False) for c in tie_break]]})


def global_rank(df: DataFrame, order: Order, rank: str, total: str) -> DataFrame:
    """Add ``rank`` (0-based) over ``order`` (list of (column, descending)), and ``total`` rows, by Spark's range
    partitioning: the sorted rows are written, and each partition's offset is added to the positions in it. ``df`` is computed once."""
    keys = [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_first() for c, desc in order]
    placed = written(df.orderBy(*keys).withColumn("__at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__at", _PART_BITS)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    # one row per sorted partition
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), F.sum("__n").over(everything).alias(total))
    inside = F.col("__at").bitwiseAND((1 << _PART_BITS) - 1)
    return (placed.withColumn("__part", part).join(offsets, "__part")
            .withColumn(rank, inside + F.col("__before")).drop("__at", "__part", "__before"))


def ntile_by_rank(df: DataFrame, k: int, order: Order, out: str) -> DataFrame:
    """NTILE(k) by global ranks, which also parts rows that are equal in all of ``order``."""
    ranked = global_rank(df, order, "__i", "__total")
    large = f"(__total % {k}) * (__total div {k} + 1)"
    tile = F.expr(f"CASE WHEN __i < {large} THEN __i div (__total div {k} + 1) "
                  f"ELSE __total % {k} + (__i - {large}) div greatest(__total div {k}, 1) END")
    return ranked.withColumn(out, (tile + 1).cast("int")).drop("__i", "__total")
