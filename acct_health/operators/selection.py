"""Exact distributed multi-selection: the rows at given ranks of several orders, without a sort.

An order is a list of columns. Each column becomes one or more order-preserving numbers ("digits"), so a row's key is a
list of digits that compare like the row. The key at a rank is found like in a radix search: the rows that may still be it lie in
an interval of one digit, a histogram of that digit in the interval tells which bucket holds the rank, the
bucket's least and greatest digit are the next interval, and where these are equal the next digit follows. All ranks of all orders are refined
by the same scan, so the number of scans depends on the width of the keys, not on how many
ranks or orders there are. Once no more than ``few`` rows are left in all open intervals, their keys are read and ordered by the driver. It
gets at most ``buckets`` rows for each open interval of a scan, and ``few`` keys.

Digits: whole numbers, dates, timestamps and booleans are one whole number; decimals one or two; floating point
numbers a class (infinite, not a number) and the value; strings seven bytes of their UTF-8 a digit and their length; before each a digit that
tells nulls. Descending orders turn the digits round.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1024
FEW = 5000
AHEAD = 3  # digits whose bounds a scan tells: that of the histogram and those behind it

Order = Sequence[tuple[str, bool]]  # (column, descending)


@dataclass(frozen=True)
class Digit:
    expr: Column
    whole: bool  # whole number, else double


def _long(c: Column, desc: bool) -> Digit:
    c = F.coalesce(c.cast("long"), F.lit(0).cast("long"))
    return Digit(F.bitwise_not(c) if desc else c, True)


def _digits(df: DataFrame, name: str, desc: bool, longest: int) -> list[Digit]:
    """The digits of a column: nulls first ascending, last descending."""
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    out = [_long(F.when(c.isNull(), 0).otherwise(1), desc)]
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return [*out, _long(c, desc)]
    if isinstance(kind, T.DateType):
        return [*out, _long(F.unix_date(c), desc)]
    if isinstance(kind, T.TimestampType):
        return [*out, _long(F.unix_micros(c), desc)]
    if isinstance(kind, T.DecimalType) and kind.precision <= 36:
        unscaled = (c.cast("decimal(38,18)") if kind.precision < 20 else c).cast(T.DecimalType(38, kind.scale))
        whole = F.floor(unscaled).cast("decimal(38,0)")
        parts = [whole] if not kind.scale else [whole, (unscaled - whole) * F.lit(10 ** min(kind.scale, 18)).cast("decimal(20,0)")]
        if kind.precision - kind.scale > 18 or kind.scale > 18:
            raise TypeError(f"{name}: a decimal with more than 18 digits before or behind the point has no order here")
        return [*out, *[_long(p, desc) for p in parts]]
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        c = c.cast("double")
        infinite = F.lit(float("inf"))
        out.append(_long(F.when(F.isnan(c), 2).when(c == infinite, 1).when(c == -infinite, -1).otherwise(0), desc))
        finite = F.when(F.isnan(c) | (F.abs(c) == infinite) | c.isNull() | (c == 0), F.lit(0.0)).otherwise(c)  # -0.0 equals 0.0
        return [*out, Digit(-finite if desc else finite, False)]
    if isinstance(kind, T.StringType):
        data = F.coalesce(c.cast("binary"), F.lit(b""))
        chunk = lambda i: F.conv(F.rpad(F.hex(F.substring(data, 7 * i + 1, 7)), 14, "0"), 16, 10)
        return [*out, *[_long(chunk(i), desc) for i in range(-(-longest // 7))], _long(F.octet_length(data), desc)]
    raise TypeError(f"{name}: {kind.simpleString()} has no order here")


def key_digits(df: DataFrame, order: Order) -> list[Digit]:
    """The digits of a row's key. One scan finds the longest value if there are string columns."""
    texts = [c for c, _ in order if isinstance(df.schema[c].dataType, T.StringType)]
    longest = {}
    if texts:
        row = df.agg(*[F.max(F.octet_length(F.col(f"`{c}`").cast("binary"))).alias(f"l{i}") for i, c in enumerate(texts)]).first()
        longest = {c: row[i] or 0 for i, c in enumerate(texts)}
    return [d for c, desc in order for d in _digits(df, c, desc, longest.get(c, 0))]


@dataclass
class Interval:
    """Rows whose first digits are ``fixed`` and whose next digit is from low to high (None: not known yet). ``ahead``: bounds of the digits behind it, as far as known.
    ``ranks``: wanted ranks among these rows, with their numbers. ``even``: buckets of equal width, else narrower towards low."""

    fixed: tuple
    low: float | int | None
    high: float | int | None
    ahead: tuple
    rows: int
    ranks: list[tuple[int, int]] = field(default_factory=list)
    even: bool = True


def _literal(v) -> Column:
    return F.lit(v).cast("long" if isinstance(v, int) else "double")


def _bucket(digit: Digit, at: Interval, buckets: int) -> Column:
    if at.low is None:
        return F.lit(0).cast("long")
    if digit.whole:
        shift = 0
        while (at.high >> shift) - (at.low >> shift) >= buckets:
            shift += 1
        return F.shiftright(digit.expr, shift)
    # halves, as the difference of two doubles may be infinite; every step keeps the order
    width = at.high / 2 - at.low / 2
    if not width:
        return (digit.expr > _literal(at.low)).cast("long")
    part = (digit.expr / 2 - _literal(at.low / 2)) / _literal(width)
    if not at.even:
        part = F.log1p(part * float(1 << 40)) / _literal(41.0)
    return F.floor(part * float(buckets)).cast("long")


def _settled(at: Interval, n_digits: int) -> tuple[str, Interval]:
    """Go over digits that are equal in all rows. "key": one row is left, or no digit; "open": to be refined."""
    while True:
        if at.rows == 1 or len(at.fixed) == n_digits:
            return "key", at
        if at.low is None or at.low != at.high:
            return "open", at
        low, high = at.ahead[0] if at.ahead else (None, None)
        at = Interval((*at.fixed, at.low), low, high, at.ahead[1:], at.rows, at.ranks)


def select_ranks(df: DataFrame, keys: Sequence[Sequence[Digit]], ranks_of, buckets: int | None = None,
                 few: int | None = None) -> tuple[int, list[dict[int, tuple[tuple, int]]]]:
    """(rows of ``df``, for each of ``keys`` the key at each wanted rank).

    ``ranks_of(n)`` gives the 0-based ranks that are wanted where there are n rows. A key is (its first digits, as many as tell its rows from all
    others, rows with these digits)."""
    buckets, few = BUCKETS if buckets is None else buckets, FEW if few is None else few
    none = {True: F.lit(None).cast("long"), False: F.lit(None).cast("double")}

    def entry(k: int, digits: Sequence[Digit], open_: list[Interval]) -> Column:
        """The open interval that a row lies in, its bucket there, and the row's digits (whole numbers and doubles apart)."""
        out = None
        for i, at in enumerate(open_):
            here = F.lit(True)
            for d, v in zip(digits, at.fixed):
                here = here & (d.expr == _literal(v))
            digit = digits[len(at.fixed)]
            if at.low is not None:
                here = here & (digit.expr >= _literal(at.low)) & (digit.expr <= _literal(at.high))
            value = F.struct(F.lit(i).alias("i"), F.lit(len(at.fixed)).alias("at"), _bucket(digit, at, buckets).alias("bucket"))
            out = (F if out is None else out).when(here, value)
        whole, real = (F.array(*[d.expr if d.whole == w else none[w] for d in digits]) for w in (True, False))
        return F.struct(F.lit(k).alias("k"), out.alias("in"), whole.alias("long"), real.alias("double"))

    def rows_of(open_: list[list[Interval]]) -> DataFrame:
        some = F.array(*[entry(k, digits, open_[k]) for k, digits in enumerate(keys) if open_[k]])
        return df.select(F.explode(some).alias("e")).where("e.in is not null").select("e.k", "e.in.*", "e.long", "e.double")

    def told(row) -> list[tuple]:
        pairs = [(row[f"min_{kind}{j}"], row[f"max_{kind}{j}"]) for j in range(AHEAD) for kind in ("long", "double")]
        return [p for p in pairs if p[0] is not None]

    found: list[dict[int, tuple[tuple, int]]] = [{} for _ in keys]
    open_ = [[Interval((), None, None, (), 0)] for _ in keys]
    bounds = [f(F.get(F.col(kind), F.col("at") + j)).alias(f"{name}_{kind}{j}") for j in range(AHEAD) for kind in ("long", "double")
              for name, f in (("min", F.min), ("max", F.max))]
    total = None
    while any(open_):
        if total is not None and sum(at.rows for some in open_ for at in some) <= few:
            _finish(rows_of(open_).collect(), open_, found)
            break
        got = rows_of(open_).groupBy("k", "i", "bucket").agg(F.count(F.lit(1)).alias("n"), *bounds).collect()
        by: dict[tuple, list] = {}
        for row in sorted(got, key=lambda r: (r["k"], r["i"], r["bucket"])):
            by.setdefault((row["k"], row["i"]), []).append(row)
        if total is None:
            total = by[0, 0][0]["n"] if by else 0
            wanted = sorted(set(ranks_of(total)))
            if not total or not wanted:
                break
            for some in open_:
                some[0].rows, some[0].ranks = total, [(r, r) for r in wanted]
        following: list[list[Interval]] = [[] for _ in keys]
        for (k, i), some in by.items():
            at, before = open_[k][i], 0
            for row in some:
                inside = [(r - before, name) for r, name in at.ranks if before <= r < before + row["n"]]
                before += row["n"]
                if not inside:
                    continue
                pairs = told(row)
                stuck = at.low is not None and row["n"] * 8 > at.rows and pairs[0][0] != pairs[0][1]
                state, new = _settled(Interval(at.fixed, *pairs[0], tuple(pairs[1:]), row["n"], inside, at.even != stuck), len(keys[k]))
                if state == "key":
                    for _, name in inside:
                        found[k][name] = (new.fixed if len(new.fixed) == len(keys[k]) else (*new.fixed, *_one(new, keys[k])), row["n"])
                else:
                    following[k].append(new)
        open_ = following
    return total or 0, found


def _finish(rows: list, open_: list[list[Interval]], found: list[dict[int, tuple[tuple, int]]]) -> None:
    """The keys at the ranks that are left, from all the rows of the open intervals."""
    by: dict[tuple[int, int], list[tuple]] = {}
    for r in rows:
        by.setdefault((r["k"], r["i"]), []).append(tuple(d if w is None else w for w, d in zip(r["long"], r["double"])))
    for (k, i), keys in by.items():
        keys.sort()
        for rank, name in open_[k][i].ranks:
            found[k][name] = (keys[rank], keys.count(keys[rank]))


def _one(at: Interval, digits: Sequence[Digit]) -> tuple:
    """The next digit of the only row left, if it is known."""
    return (at.low,) if at.low is not None and at.low == at.high else ()


def at_or_behind(digits: Sequence[Digit], key: tuple) -> Column:
    """Whether a row's key is not before ``key``, a list of first digits."""
    out = F.lit(True)
    for d, v in reversed(list(zip(digits, key))):
        out = (d.expr > _literal(v)) | ((d.expr == _literal(v)) & out)
    return out
