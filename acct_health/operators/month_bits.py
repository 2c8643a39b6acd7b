"""Active months of entities as bit sets.

A set of months is a few whole numbers of 62 bits each (a bit a month, from a first month on), which merge by OR: the
partial state of an aggregate is 8 bytes for each 62 months, whatever the number of rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acct_health.functions.dates import month_diff

BITS = 62  # of a word; the sign is none of them


def month_words(date: Column | str, first: dt.date, last: dt.date, prefix: str = "__w") -> list[Column]:
    """Aggregates whose results are the words of the months from ``first`` to ``last`` in a group; dates outside are left out."""
    months = (last.year - first.year) * 12 + last.month - first.month + 1
    at = month_diff(F.col(date) if isinstance(date, str) else date, F.lit(first))
    out = []
    for w in range(max(1, -(-months // BITS))):
        low, high = w * BITS, min((w + 1) * BITS, months) - 1
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (at - low).cast("int"))
        out.append(F.coalesce(F.bit_or(F.when(at.between(low, high), bit)), F.lit(0).cast("long")).alias(f"{prefix}{w}"))
    return out


def month_array(words: list[str], first: dt.date) -> Column:
    """The months of a set, as dates in order."""
    def of(i: int) -> Column:
        return F.filter(F.sequence(F.lit(i * BITS), F.lit((i + 1) * BITS - 1)), lambda m: F.getbit(F.col(words[i]), m - i * BITS) == 1)

    return F.transform(F.concat(*[of(i) for i in range(len(words))]), lambda m: F.add_months(F.lit(first), m))
