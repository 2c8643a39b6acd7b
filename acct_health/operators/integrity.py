"""Referential-integrity and row-count checks between tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count_match(a: DataFrame, b: DataFrame, a_name: str = "a_rows", b_name: str = "b_rows") -> DataFrame:
    """Row counts of two tables side by side (two one-row aggregates, 1 x 1 cross join)."""
    return a.agg(F.count(F.lit(1)).alias(a_name)).crossJoin(b.agg(F.count(F.lit(1)).alias(b_name)))


def orphan_count(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None,
                 skip_null_keys: bool = False, name: str = "orphaned_rows") -> DataFrame:
    """Fact rows whose key has no dimension row (a NULL key counts unless ``skip_null_keys``).

    The fact is first reduced to (key, rows) with a map-side partial aggregate, so the
    join sees one row per distinct key however skewed the fact is; then a left anti join
    (Catalyst keeps LEFT JOIN ... WHERE dim.key IS NULL as outer join + filter) and a sum.
    The dimension side is left to the planner's size-based broadcast choice.
    """
    dim_key = dim_key or key
    f = fact.select(F.col(key).alias("__k"))
    if skip_null_keys:
        f = f.filter(F.col("__k").isNotNull())
    per_key = f.groupBy("__k").agg(F.count(F.lit(1)).alias("__n"))
    d = dim.select(F.col(dim_key).alias("__k"))
    missing = per_key.join(d, "__k", "left_anti")
    return missing.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias(name))


def dim_coverage(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """For each {name: (dim, key)}: dim rows and distinct keys of the fact, in one row.

    The fact is read once: its distinct (name, key) pairs are counted next to the dimensions' rows as one
    union of small partial counts, which a single aggregate lays out as columns."""
    keys = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(k).cast("string").alias("key")) for n, (_, k) in dims.items()]))
    used = fact.select(keys.alias("x")).select("x.name", "x.key").where("key IS NOT NULL").distinct()
    counts = used.groupBy("name").agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("keys"))
    for n, (dim, _) in dims.items():
        counts = counts.unionByName(dim.agg(F.count(F.lit(1)).alias("n")).withColumns({"name": F.lit(n), "what": F.lit("rows")}))
    pick = lambda n, what: F.coalesce(F.max(F.when((F.col("name") == n) & (F.col("what") == what), F.col("n"))), F.lit(0))
    return counts.agg(*[c for n, (_, k) in dims.items() for c in (pick(n, "rows").alias(f"{n}_rows"), pick(n, "keys").alias(f"distinct_{k}s_in_fact"))])
