"""Column expressions for numbers stored as dirty text (safe casts, currency parsing)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from acct_health.functions.text import _col, utrim

# Null flavours of the money columns (compared after trim + upper).
MONEY_NULLS: tuple[str, ...] = ("NONE", "N/A", "??", "-", "NULL")

# Plain decimal syntax. Spark's string->double cast also takes Java suffixes such as
# "1.5d" and words such as "Infinity"; a strict SQL cast does not, so guard with this.
_DOUBLE_RE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_INT_RE = r"^[+-]?[0-9]+$"


def safe_double(c: Column | str) -> Column:
    """Strict text -> DOUBLE; anything that is not a plain decimal literal -> NULL."""
    s = _col(c).cast("string")
    return F.when(s.rlike(_DOUBLE_RE), s.try_cast("double"))


def safe_int(c: Column | str) -> Column:
    """Strict text -> BIGINT; '3.0', ' 3', '??' -> NULL; out-of-range -> NULL."""
    s = _col(c).cast("string")
    return F.when(s.rlike(_INT_RE), s.try_cast("bigint"))


def parse_money(c: Column | str, nulls: Sequence[str] = MONEY_NULLS) -> Column:
    """Currency text -> DOUBLE.

    Branches in order: blank or null flavour -> NULL; starts with '$' (untrimmed) ->
    drop '$' and thousands commas; contains a comma -> the comma is the decimal mark;
    else a plain number.
    """
    raw = _col(c)
    t = utrim(raw)
    return (
        F.when(F.upper(t).isin(*nulls) | (t == ""), F.lit(None).cast("double"))
        .when(raw.startswith("$"), safe_double(F.replace(F.replace(t, F.lit("$"), F.lit("")), F.lit(","), F.lit(""))))
        .when(raw.contains(","), safe_double(F.replace(t, F.lit(","), F.lit("."))))
        .otherwise(safe_double(t))
    )
