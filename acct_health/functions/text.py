"""Column expressions for categorical text: junk stripping, trimming, canonical value sets.

Each function takes and returns a ``Column`` so it fuses into one projection and stays
inside whole-stage codegen. Value lists are parameters; the defaults are the
reference's fixed values, listed together below.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's (cleaning constants).
# ---------------------------------------------------------------------------
# Junk snippets, each replaced by one space before trimming.
JUNK_SNIPPETS: tuple[str, ...] = ("&nbsp;", "<br>", "###", "N/A - check later", "\t", "\u200b")
# Null flavours for categorical columns (compared after trim + upper; blank is handled apart).
CATEGORY_NULLS: tuple[str, ...] = ("N/A", "NULL", "NONE", "-", "??")
# shipping_mode: first matching pattern (on the upper-cased value) wins.
SHIPPING_MODE_PATTERNS: tuple[tuple[str, str], ...] = (
    ("STANDARD", "Standard Class"),
    ("FIRST", "First Class"),
    ("2ND|SECOND", "Second Class"),
    ("SAME", "Same Day"),
)
# order_status: spellings merged into one canonical value.
ORDER_STATUS_SYNONYMS: Mapping[str, str] = {"CANCELLED": "CANCELED", "CANCELED": "CANCELED"}
# delivery_status: exact upper-cased value -> canonical value.
DELIVERY_STATUS_VALUES: Mapping[str, str] = {
    "ADVANCE SHIPPING": "Advance shipping",
    "LATE DELIVERY": "Late delivery",
    "SHIPPING CANCELED": "Shipping canceled",
    "SHIPPING ON TIME": "Shipping on time",
}
# late_delivery_risk spellings.
TRUTHY: tuple[str, ...] = ("1", "TRUE", "YES", "Y")
FALSY: tuple[str, ...] = ("0", "FALSE", "NO", "N")
# customer_segment: first matching pattern wins.
SEGMENT_PATTERNS: tuple[tuple[str, str], ...] = (
    ("CONSUMER", "Consumer"),
    ("CORPORATE", "Corporate"),
    ("HOME OFFICE", "Home Office"),
)
# order_region: exact upper-cased value -> canonical value (16 regions).
REGION_VALUES: Mapping[str, str] = {
    "SOUTHEAST ASIA": "Southeast Asia",
    "SOUTH ASIA": "South Asia",
    "OCEANIA": "Oceania",
    "EASTERN ASIA": "Eastern Asia",
    "WEST ASIA": "West Asia",
    "WEST AFRICA": "West Africa",
    "CENTRAL AFRICA": "Central Africa",
    "NORTH AFRICA": "North Africa",
    "WESTERN EUROPE": "Western Europe",
    "NORTHERN EUROPE": "Northern Europe",
    "SOUTHERN EUROPE": "Southern Europe",
    "EASTERN EUROPE": "Eastern Europe",
    "CARIBBEAN": "Caribbean",
    "SOUTH AMERICA": "South America",
    "CENTRAL AMERICA": "Central America",
    "NORTH AMERICA": "North America",
}
# market: exact upper-cased value -> canonical value.
MARKET_VALUES: Mapping[str, str] = {
    "USCA": "USCA",
    "LATAM": "LATAM",
    "PACIFIC ASIA": "Pacific Asia",
    "EUROPE": "Europe",
    "AFRICA": "Africa",
}
# order_country: canonical value <- accepted upper-cased spellings.
COUNTRY_SYNONYMS: Mapping[str, tuple[str, ...]] = {
    "United States": ("USA", "US", "U.S.A.", "UNITED STATES"),
    "Vietnam": ("VN", "VIETNAM", "VIET NAM"),
    "Ireland": ("IE", "IRELAND", "REP. OF IRELAND"),
    "Germany": ("DE", "GERMANY", "DEUTSCHLAND"),
    "Mexico": ("MX", "MEXICO", "MÉXICO"),
    "Brazil": ("BR", "BRAZIL", "BRASIL"),
    "Australia": ("AU", "AUSTRALIA"),
}
# ---------------------------------------------------------------------------

# The Unicode White_Space characters (what a SQL TRIM of "whitespace" removes).
UNICODE_WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def utrim(c: Column | str) -> Column:
    """Trim all Unicode whitespace at both ends (Spark's one-argument ``trim`` strips only
    U+0020). A character-set trim: no regular expression per value."""
    return F.btrim(_col(c), F.lit(UNICODE_WHITESPACE))


def strip_junk(c: Column | str, snippets: Sequence[str] = JUNK_SNIPPETS) -> Column:
    """Replace every junk snippet by one space, then trim.

    One ``regexp_replace`` with quoted alternatives; snippets cannot overlap, so this
    equals replacing them one after another.
    """
    pattern = "|".join(r"\Q" + s + r"\E" for s in snippets)
    return utrim(F.regexp_replace(_col(c), pattern, " "))


def upper_trim(c: Column | str) -> Column:
    """Trimmed and upper-cased: what the value sets below are looked up by."""
    return F.upper(utrim(c))


# The ``by_*`` and ``known_*`` functions take a text that is upper-cased already. Given as a column of an earlier projection it is computed once,
# however often they read it; the functions behind them take the text as it is.

def by_pattern(upper: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """First rule whose regex matches gives the canonical value, else NULL."""
    out: Column | None = None
    for regex, value in rules:
        out = (F if out is None else out).when(upper.rlike(regex), F.lit(value))
    return out.otherwise(F.lit(None).cast("string"))


def by_value(upper: Column, mapping: Mapping[str, object]) -> Column:
    """The value of a literal map, which Spark folds into a constant: one lookup; NULL where there is none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair]), upper)


def by_synonyms(upper: Column, synonyms: Mapping[str, Iterable[str]]) -> Column:
    return by_value(upper, {spelling: value for value, spellings in synonyms.items() for spelling in spellings})


def known_category(upper: Column, nulls: Sequence[str] = CATEGORY_NULLS, synonyms: Mapping[str, str] | None = None) -> Column:
    """Blank and null flavours -> NULL; merge synonyms; keep unknown values."""
    changed = {**dict.fromkeys(nulls, ""), **(synonyms or {})}
    return F.nullif(F.coalesce(by_value(upper, changed), upper) if changed else upper, F.lit(""))


def known_bool01(upper: Column, truthy: Sequence[str] = TRUTHY, falsy: Sequence[str] = FALSY) -> Column:
    return by_value(upper, {**dict.fromkeys(falsy, 0), **dict.fromkeys(truthy, 1)})


def canonicalize_by_pattern(c: Column | str, rules: Sequence[tuple[str, str]]) -> Column:
    """First rule whose regex matches the upper-cased value gives the canonical value, else NULL."""
    return by_pattern(F.upper(_col(c)), rules)


def canonicalize_by_value(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Exact match of the upper-cased value against ``mapping`` keys, else NULL."""
    return by_value(F.upper(_col(c)), mapping)


def canonicalize_by_synonyms(c: Column | str, synonyms: Mapping[str, Iterable[str]]) -> Column:
    """Map trimmed, upper-cased spellings to their canonical value; unknown -> NULL."""
    return by_synonyms(upper_trim(c), synonyms)


def normalize_category(
    c: Column | str,
    nulls: Sequence[str] = CATEGORY_NULLS,
    synonyms: Mapping[str, str] | None = None,
) -> Column:
    """Trim + upper; blank and null flavours -> NULL; merge synonyms; keep unknown values."""
    return known_category(upper_trim(c), nulls, synonyms)


def normalize_bool01(
    c: Column | str, truthy: Sequence[str] = TRUTHY, falsy: Sequence[str] = FALSY
) -> Column:
    """Boolean spellings -> INT 1 / 0; anything else -> NULL."""
    return known_bool01(upper_trim(_col(c).cast("string")), truthy, falsy)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
