"""Data-quality flag columns: flags are added, rows are never dropped."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acct_health.functions.text import _col


def flag_nonpositive(c: Column | str) -> Column:
    """Business-invalid quantity: value <= 0; NULL counts as not invalid."""
    return F.coalesce(_col(c) <= 0, F.lit(False))


def flag_out_of_order(earlier: Column | str, later: Column | str) -> Column:
    """TRUE when both are present and ``later`` precedes ``earlier``."""
    return F.coalesce(_col(later) < _col(earlier), F.lit(False))


def add_missing_flags(df: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """Add one boolean ``flag = source IS NULL`` column per ``{flag: source}`` entry."""
    return df.withColumns({flag: F.col(src).isNull() for flag, src in flags.items()})
