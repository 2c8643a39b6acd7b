"""Dominant value per entity: the value with the most distinct events, ties to the most recent."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dominant_value(
    df: DataFrame,
    entity: str,
    value: str,
    event: str,
    when: str,
    out: str | None = None,
) -> DataFrame:
    """One row per ``entity``: the ``value`` with the most distinct ``event`` ids, ties broken
    by the latest ``when``, then by ``value`` ascending (so the choice is reproducible).

    Rows with a NULL ``value`` or ``when`` are ignored. Plan: the distinct count runs as
    two partial/final aggregations keyed (entity, value, event) then (entity, value), so a
    hot entity is reduced map-side; the ranking window only sees one row per
    (entity, value).
    """
    counts = (
        df.filter(F.col(value).isNotNull() & F.col(when).isNotNull())
        .groupBy(entity, value)
        .agg(F.count_distinct(event).alias("__n"), F.max(when).alias("__latest"))
    )
    w = Window.partitionBy(entity).orderBy(
        F.col("__n").desc(), F.col("__latest").desc(), F.col(value).asc()
    )
    return (
        counts.withColumn("__rn", F.row_number().over(w))
        .filter(F.col("__rn") == 1)
        .select(entity, F.col(value).alias(out or f"dominant_{value}"))
    )


def entity_profile(df: DataFrame, entity: str, event: str, when: str, values: Mapping[str, str], member: Column,
                   measures: Mapping[str, Column], counted: str, first: str, last: str) -> DataFrame:
    """One row per ``entity`` with a ``member`` row, from one scan: over its member rows the distinct ``event`` ids (``counted``), the
    ``first`` and ``last`` ``when`` and the sum of each of ``measures``; and for each of ``values`` (output name: column) the dominant value, as ``dominant_value`` has it.

    Rows without ``when`` are ignored; a null entity has no dominant values, like in a join on it.

    Plan: each row gives an entry for its member part and one for each value. Entries are reduced to one per (entity, kind, value, event), then to
    one per (entity, kind, value), then to the entity, where the best value is the minimum of (-events, -latest, value): each step combines map-side
    and merges, so a hot entity is reduced before each exchange and no window ranks it.
    """
    day = F.unix_date(when)
    sums = {f"__s{i}": c for i, c in enumerate(measures.values())}
    none = {n: F.lit(None).cast("decimal(28,4)").alias(n) for n in sums}
    entries = [F.when(member, F.struct(F.lit(0).alias("k"), F.lit(None).cast("string").alias("v"), *[c.cast("decimal(28,4)").alias(n) for n, c in sums.items()]))]
    entries += [F.when(F.col(c).isNotNull(), F.struct(F.lit(i).alias("k"), F.col(c).cast("string").alias("v"), *none.values()))
                for i, c in enumerate(values.values(), 1)]
    rows = df.where(F.col(when).isNotNull()).select(entity, event, day.alias("__d"), F.explode(F.array(*entries)).alias("e")).where("e is not null")
    add = [F.sum(n).alias(n) for n in sums]
    rows = rows.select(entity, event, "__d", "e.*").groupBy(entity, "k", "v", event).agg(F.min("__d").alias("__lo"), F.max("__d").alias("__hi"), *add)
    rows = rows.groupBy(entity, "k", "v").agg(F.count(event).alias("__n"), F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"), *add)
    own = lambda c: F.max(F.when(F.col("k") == 0, c))  # noqa: E731  one row is the member part
    best = [F.min(F.when(F.col("k") == i, F.struct(-F.col("__n"), -F.col("__hi"), F.col("v").alias("v")))).alias(f"__b{i}") for i in range(1, len(values) + 1)]
    out = rows.groupBy(entity).agg(own(F.col("__n")).alias(counted), own(F.date_from_unix_date("__lo")).alias(first),
                                   own(F.date_from_unix_date("__hi")).alias(last), *[own(F.col(n)).alias(n) for n in sums], *best)
    return out.where(F.col(counted).isNotNull()).select(
        entity, counted, first, last, *[F.round(n, 2).cast("double").alias(m) for n, m in zip(sums, measures)],
        *[F.when(F.col(entity).isNotNull(), F.col(f"__b{i}.v")).alias(name) for i, name in enumerate(values, 1)])
