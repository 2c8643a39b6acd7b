"""Data-quality profiling operators: every one is a single aggregate pass (or a grouped
count) over the input, so cost is one scan plus at most one shuffle of small partials."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acct_health.operators.average import exact_avg
from acct_health.operators.dedupe import with_repeated
from acct_health.functions.money import MONEY_NULLS, safe_double, safe_int
from acct_health.functions.text import utrim


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Total rows vs distinct non-null keys (equal when the key is a primary key)."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct(key).alias("distinct_keys"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their counts (HAVING cnt > 1)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)


def column_mismatch_count(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.count_if(F.col(a) != F.col(b)).alias("mismatch_count"))


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each identical full row. Whole rows are compared only where their digests repeat."""
    some = with_repeated(df).where("__repeated").drop("__repeated")
    per = some.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return per.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("duplicate_row_count"))


def schema_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, data_type, present_rows) of the selected columns: the type by the schema, the rows that hold a
    value counted in one pass."""
    wanted = [f for f in df.schema.fields if cols is None or f.name in cols]
    counted = df.agg(*[F.count(f.name).alias(f.name) for f in wanted])
    each = [F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.col(f.name).alias("present_rows")) for f in wanted]
    return counted.select(F.explode(F.array(*each)).alias("c")).select("c.*")


def date_quality_summary(df: DataFrame, order: str = "order_date_clean", ship: str = "shipping_date_clean",
                         flag: str = "is_ship_before_order_flag") -> DataFrame:
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("total_rows"),
        F.count_if(F.col(order).isNull()).alias("missing_order_dates"),
        F.count_if(F.col(ship).isNull()).alias("missing_shipping_dates"),
        F.count_if(F.col(flag)).alias("ship_before_order_cases"),
        F.round(F.count_if(F.col(flag)) / n * 100, 2).alias("pct_ship_before_order"),
    )


def value_counts(df: DataFrame, col: Column | str, name: str | None = None, top: int | None = None,
                 by_value: bool = False) -> DataFrame:
    """Frequency of each value (NULL included) of a column or expression, the most frequent first (the value
    breaks ties), or ``by_value`` in the values' order. With ``top``, the n first — a top-k report,
    planned as TakeOrderedAndProject."""
    c = _c(col)
    name = name or (col if isinstance(col, str) else "value")
    out = df.groupBy(c.alias(name)).agg(F.count(F.lit(1)).alias("cnt"))
    value = F.col(name).asc_nulls_first()
    out = out.orderBy(value) if by_value else out.orderBy(F.col("cnt").desc(), value)
    return out if top is None else out.limit(top)


def int_range_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per text column: min / max of the strict integer reading, negatives, unparseable."""
    aggs = []
    for c in cols:
        v = safe_int(c)
        aggs += [F.min(v).alias(f"min_{c}"), F.max(v).alias(f"max_{c}"),
                 F.count_if(v < 0).alias(f"negative_{c}"),
                 F.count_if(F.col(c).isNotNull() & v.isNull()).alias(f"unparseable_{c}")]
    return df.agg(*aggs)


def magnitude_profile(df: DataFrame, col: str) -> DataFrame:
    """min / max / avg of a money column over its non-null values (summed as cents)."""
    f = df.filter(F.col(col).isNotNull())
    return f.agg(F.min(col).alias(f"min_{col}"), F.max(col).alias(f"max_{col}"),
                 exact_avg(col).alias(f"avg_{col}"))


def flag_consistency(df: DataFrame, real: str, scheduled: str, flag: str) -> DataFrame:
    """Does a 0/1 flag agree with real > scheduled, over rows where both counts exist."""
    f = df.filter(F.col(real).isNotNull() & F.col(scheduled).isNotNull())
    late, on_time = F.col(real) > F.col(scheduled), F.col(real) <= F.col(scheduled)
    return f.agg(
        F.count(F.lit(1)).alias("total_comparable_rows"),
        F.count_if((late & (F.col(flag) == 1)) | (on_time & (F.col(flag) == 0))).alias("consistent_rows"),
        F.count_if((late & (F.col(flag) == 0)) | (on_time & (F.col(flag) == 1))).alias("inconsistent_rows"),
    )


def uncastable_values(df: DataFrame, col: str, to: str = "double", n: int = 30) -> DataFrame:
    """Up to n distinct raw values that are present but do not cast (smallest first, so the
    sample is reproducible)."""
    v = safe_double(col) if to == "double" else safe_int(col)
    return (df.filter(F.col(col).isNotNull() & v.isNull()).select(F.col(col).alias("raw_value")).distinct()
            .orderBy("raw_value").limit(n))


def range_check(df: DataFrame, col: str, lo: float | None = None, hi: float | None = None,
                prefix: str = "") -> DataFrame:
    """min / max of the strict double reading, count outside [lo, hi], raw NULL count."""
    v = safe_double(col)
    aggs = [F.min(v).alias(f"min_{prefix or col}"), F.max(v).alias(f"max_{prefix or col}")]
    if lo is not None or hi is not None:
        out = F.lit(False)
        if lo is not None:
            out = out | (v < lo)
        if hi is not None:
            out = out | (v > hi)
        aggs.append(F.count_if(out).alias("out_of_range_count"))
    aggs.append(F.count_if(F.col(col).isNull()).alias("null_count"))
    return df.agg(*aggs)


def null_counts(df: DataFrame, cols: Sequence[str], prefix: str = "null_") -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{prefix}{c}") for c in cols])


def cardinality_profile(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count_distinct(col).alias("distinct_values"), F.count_if(F.col(col).isNull()).alias("null_values"))


def parse_failure_counts(df: DataFrame, pairs: Mapping[str, str], nulls: Sequence[str] = MONEY_NULLS) -> DataFrame:
    """Per (raw, clean) pair: values present, not blank and not a null flavour, that still
    cleaned to NULL (expected 0)."""
    aggs = []
    for raw, clean in pairs.items():
        t = utrim(raw)
        lost = (F.col(raw).isNotNull() & F.col(clean).isNull() & ~F.upper(t).isin(*nulls) & (t != ""))
        aggs.append(F.count_if(lost).alias(f"bad_{raw}"))
    return df.agg(*aggs)


def flag_counts(df: DataFrame, missing: str, invalid: str) -> DataFrame:
    return df.agg(F.count_if(F.col(missing)).alias("missing_count"),
                  F.count_if(F.col(invalid) & ~F.col(missing)).alias("invalid_count"),
                  F.count(F.lit(1)).alias("total_rows"))
