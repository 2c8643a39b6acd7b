"""Column expressions for dates: multi-format parsing, joint day/month resolution,
ceiling correction, calendar keys and month arithmetic."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from acct_health.functions.text import _col, utrim

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's: the two parse-format lists in
# priority order (month-first and day-first conventions), as Spark patterns.
# Single-letter fields accept one or two digits.
# ---------------------------------------------------------------------------
MONTH_FIRST_FORMATS: tuple[str, ...] = (
    "yyyy-M-d H:m:s",
    "M/d/yyyy H:m",
    "M/d/yyyy",
    "d-MMM-yy",
    "MMMM d, yyyy",
    "yyyy/M/d",
)
DAY_FIRST_FORMATS: tuple[str, ...] = (
    "yyyy-M-d H:m:s",
    "d/M/yyyy H:m",
    "d/M/yyyy",
    "d-MMM-yy",
    "MMMM d, yyyy",
    "yyyy/M/d",
)
# Two-digit years: 69..99 belong to the 1900s, 00..68 to the 2000s.
TWO_DIGIT_YEAR_PIVOT = 2069
# Data ceiling / snapshot date of the reference's export.
REFERENCE_CEILING = dt.date(2026, 7, 30)
# ---------------------------------------------------------------------------


# Numeric fields by range (leading zeros allowed), so text that cannot be a valid month,
# day, hour, minute or second is rejected before the formatter is tried.
_FIELD_RANGES = {
    "M": "0*(?:[1-9]|1[0-2])",
    "d": "0*(?:[1-9]|[12][0-9]|3[01])",
    "H": "0*(?:[0-9]|1[0-9]|2[0-3])",
    "m": "0*[0-5]?[0-9]",
    "s": "0*[0-5]?[0-9]",
}


def format_shape(fmt: str) -> str:
    """A regex accepting every text the Spark pattern ``fmt`` can parse (numeric fields ->
    digits within the field's range, text fields -> letters, literals as is). Parsing is
    attempted only on matching text, so non-matching rows (e.g. a day-first date read
    month-first) skip the formatter's failure path, which costs an exception per try."""
    out, i = ["^"], 0
    while i < len(fmt):
        ch = fmt[i]
        j = i
        while j < len(fmt) and fmt[j] == ch:
            j += 1
        run = j - i
        if ch == "M" and run >= 3:
            out.append("[A-Za-z]+")
        elif ch in _FIELD_RANGES:
            out.append(_FIELD_RANGES[ch])
        elif ch in "yh":
            out.append("[0-9]+")
        elif ch == "E":
            out.append("[A-Za-z]+")
        elif ch == "'":
            raise ValueError("quoted literals are not supported in date formats")
        else:
            out.append("\\" + ch if not ch.isalnum() and ch != " " else ch)
            if run > 1:
                out.extend([out[-1]] * (run - 1))
        i = j
    out.append("$")
    return "".join(out)


def _parse_one(t: Column, fmt: str) -> Column:
    ts = F.when(t.rlike(format_shape(fmt)), F.try_to_timestamp(t, F.lit(fmt)))
    if "yy" in fmt and "yyyy" not in fmt:
        # Spark reads 'yy' as 2000..2099; move 2069..2099 back a century.
        ts = F.when(F.year(ts) >= TWO_DIGIT_YEAR_PIVOT, F.add_months(ts, -1200).cast("timestamp")).otherwise(ts)
    return ts


def parse_date(c: Column | str, formats: Sequence[str]) -> Column:
    """First format that parses the trimmed text wins -> DATE; nothing parses -> NULL.

    Invalid calendar dates and trailing text do not parse (``try_to_timestamp``).
    """
    t = utrim(c)
    return F.coalesce(*[_parse_one(t, f) for f in formats]).cast("date")


def parse_date_candidates(
    c: Column | str,
    month_first: Sequence[str] = MONTH_FIRST_FORMATS,
    day_first: Sequence[str] = DAY_FIRST_FORMATS,
) -> tuple[Column, Column]:
    """(month-first reading, day-first reading) of one text date column.

    Formats shared by both lists are parsed once (same expression object, so the
    projection evaluates it once)."""
    t = utrim(c)
    parsed = {f: _parse_one(t, f) for f in dict.fromkeys([*month_first, *day_first])}
    mf = F.coalesce(*[parsed[f] for f in month_first]).cast("date")
    df = F.coalesce(*[parsed[f] for f in day_first]).cast("date")
    return mf, df


def forced_date(mf: Column, df: Column) -> Column:
    """The single certain reading: only one parses, or both agree; else NULL."""
    return (
        F.when(mf.isNull(), df)
        .when(df.isNull(), mf)
        .when(mf == df, mf)
        .otherwise(F.lit(None).cast("date"))
    )


def resolve_date_pair(o_mf: Column, o_df: Column, s_mf: Column, s_df: Column) -> tuple[Column, Column]:
    """Jointly resolve an (order, ship) pair of ambiguous readings.

    One rule for both sides, an ordered list of candidates of which the first that is there wins: the
    certain reading; a reading, month-first before day-first, that stands in order with the other side's certain
    reading (ship not before order); a reading that stands in order with the other side's reading of the
    same convention; the month-first reading.
    """
    order, ship = (o_mf, o_df), (s_mf, s_df)
    sure_order, sure_ship = forced_date(*order), forced_date(*ship)

    def pick(own, sure, other_sure, other, in_order):
        certain = [F.when(in_order(r, other_sure), r) for r in own]
        alike = [F.when(in_order(r, o), r) for r, o in zip(own, other)]
        return F.coalesce(sure, *certain, *alike, own[0])

    return (pick(order, sure_order, sure_ship, ship, lambda own, other: own <= other),
            pick(ship, sure_ship, sure_order, order, lambda own, other: own >= other))


def swap_impossible_date(
    c: Column | str, ceiling: dt.date = REFERENCE_CEILING, null_if_still_after: bool = False
) -> Column:
    """A date after the ceiling is read as day/month swapped when its day can be a month,
    else NULL. ``null_if_still_after`` also nulls a swapped date still after the ceiling."""
    d = _col(c)
    ceil = F.lit(ceiling)
    swapped = F.make_date(F.year(d), F.dayofmonth(d), F.month(d))
    if null_if_still_after:
        swapped = F.when(swapped <= ceil, swapped)
    return (
        F.when((d > ceil) & (F.dayofmonth(d) <= 12), swapped)
        .when(d > ceil, F.lit(None).cast("date"))
        .otherwise(d)
    )


def date_key(c: Column | str) -> Column:
    """DATE -> INT yyyymmdd (integer arithmetic, no string formatting)."""
    d = _col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_diff(later: Column | str, earlier: Column | str) -> Column:
    """Month boundaries crossed from ``earlier`` to ``later`` (31 Jan -> 1 Feb = 1)."""
    a, b = _col(later), _col(earlier)
    return ((F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))).cast("int")
