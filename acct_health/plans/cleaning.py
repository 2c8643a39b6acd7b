"""Cleaning stages A-D of the raw order-line export, and the whole pipeline.

Each stage is ``DataFrame -> DataFrame``: it keeps every input column and adds
``*_clean`` columns plus ``is_*`` quality flags (rows are never dropped, except
duplicate rows in stage A). Stages B-D are row-local projections that Catalyst
collapses into one narrow stage; stage A holds the only shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acct_health.functions import dates as D
from acct_health.functions import money as M
from acct_health.functions import text as X
from acct_health.functions.flags import add_missing_flags, flag_nonpositive, flag_out_of_order
from acct_health.operators.dedupe import drop_exact_duplicates, keep_earliest_by_lead, keep_earliest_per_key

ID_COLUMNS: tuple[str, ...] = ("order_item_id", "order_id", "customer_id", "order_customer_id",
                               "product_card_id", "order_item_cardprod_id")
MONEY_COLUMNS: tuple[str, ...] = ("sales", "order_item_total", "order_item_product_price", "order_item_discount",
                                  "order_profit_per_order", "benefit_per_order", "sales_per_customer")

# flag <- the cleaned column that is missing
DELIVERY_FLAGS = {
    "is_shipping_mode_missing": "shipping_mode_clean",
    "is_order_status_missing": "order_status_clean",
    "is_delivery_status_missing": "delivery_status_clean",
    "is_late_risk_missing": "late_delivery_risk_clean",
    "is_real_days_missing": "real_shipping_days_clean",
    "is_scheduled_days_missing": "scheduled_days_for_shipment_clean",
}
MONEY_FLAGS = {
    "is_sales_missing": "sales_clean",
    "is_order_item_total_missing": "order_item_total_clean",
    "is_product_price_missing": "order_item_product_price_clean",
    "is_discount_missing": "order_item_discount_clean",
    "is_profit_per_order_missing": "order_profit_per_order_clean",
    "is_benefit_per_order_missing": "benefit_per_order_clean",
    "is_sales_per_customer_missing": "sales_per_customer_clean",
    "is_discount_rate_missing": "order_item_discount_rate_clean",
    "is_profit_ratio_missing": "order_item_profit_ratio_clean",
    "is_quantity_missing": "order_item_quantity_clean",
}
SEGMENT_FLAGS = {
    "is_segment_missing": "customer_segment_clean",
    "is_region_missing": "order_region_clean",
    "is_market_missing": "market_clean",
    "is_country_missing": "order_country_clean",
    "is_state_missing": "order_state_clean",
}


def raw_sources(columns: Sequence[str], raw: Sequence[str]) -> list[str] | None:
    """The raw columns that stages B to D make columns of staging from; dates and flags of dates are there before. None: not known for all."""
    flags = {**DELIVERY_FLAGS, **MONEY_FLAGS, **SEGMENT_FLAGS, "is_quantity_invalid": "order_item_quantity_clean"}
    before = {"order_date_clean", "shipping_date_clean", "is_order_date_missing", "is_shipping_date_missing", "is_ship_before_order_flag",
              "is_order_item_id_invalid"}
    wanted = [c if c in raw else flags.get(c, c).removesuffix("_clean") for c in columns if c not in before]
    return list(dict.fromkeys(wanted)) if set(wanted) <= set(raw) else None


def cast_ids(df: DataFrame, ids: Sequence[str] = ID_COLUMNS) -> DataFrame:
    """Text ids -> BIGINT (strict); stands in for the warehouse's typed load of the ids."""
    return df.withColumns({c: M.safe_int(c) for c in ids if c in df.columns})


def add_date_candidates(df: DataFrame, order_col: str = "order_date", ship_col: str = "shipping_date",
                        month_first: Sequence[str] = D.MONTH_FIRST_FORMATS,
                        day_first: Sequence[str] = D.DAY_FIRST_FORMATS) -> DataFrame:
    o_mf, o_df = D.parse_date_candidates(order_col, month_first, day_first)
    s_mf, s_df = D.parse_date_candidates(ship_col, month_first, day_first)
    return df.withColumns({"order_date_monthfirst": o_mf, "order_date_dayfirst": o_df,
                           "shipping_date_monthfirst": s_mf, "shipping_date_dayfirst": s_df})


def resolve_dates(df: DataFrame) -> DataFrame:
    order, ship = D.resolve_date_pair(F.col("order_date_monthfirst"), F.col("order_date_dayfirst"),
                                      F.col("shipping_date_monthfirst"), F.col("shipping_date_dayfirst"))
    return df.withColumns({"order_date_clean": order, "shipping_date_clean": ship}).drop(
        "order_date_monthfirst", "order_date_dayfirst", "shipping_date_monthfirst", "shipping_date_dayfirst")


def clean_keys_dates(df: DataFrame, key: str = "order_item_id", fuse_dedupe: bool = True,
                     month_first: Sequence[str] = D.MONTH_FIRST_FORMATS,
                     day_first: Sequence[str] = D.DAY_FIRST_FORMATS, few_columns: bool = False,
                     keep: Callable[..., DataFrame] | None = None) -> DataFrame:
    """Stage A: exact-duplicate removal, joint date parsing, one row per key (earliest
    order date, NULL last), date quality flags.

    With ``fuse_dedupe`` both deduplications run as one keyed window (one shuffle): the
    window's order ends with every raw column, so exact duplicates collapse with it.
    ``few_columns``: for plans that read few columns of the result. The same rows; lines of a key that differ in their
    other ids are told apart by these, and only the rest is compared in every raw column. ``keep``: does that in steps of the caller's, given
    the lines, the key's column, the order, all columns that break ties and how many lead.
    """
    raw_cols = df.columns
    if not fuse_dedupe:
        df = drop_exact_duplicates(df)
    # an id that is there but cannot be read is a key of its own, and flagged: such rows are not dropped
    number, bad = M.safe_int(key), f"is_{key}_invalid"
    df = df.withColumns({bad: F.col(key).isNotNull() & number.isNull(),
                         "__key": F.coalesce(number.cast("string"), F.concat(F.lit("?"), F.col(key)))})
    df = resolve_dates(add_date_candidates(cast_ids(df), month_first=month_first, day_first=day_first))
    earliest, tie_break = [F.col("order_date_clean").asc_nulls_last()], [c for c in raw_cols if c != key]
    if few_columns:
        lead = next((i for i, c in enumerate(tie_break) if c not in ID_COLUMNS), len(tie_break))
        df = (keep or keep_earliest_by_lead)(df, "__key", earliest, tie_break, lead)
    else:
        df = keep_earliest_per_key(df, "__key", earliest, tie_break=tie_break, pack=True)
    df = df.drop("__key")
    df = add_missing_flags(df, {"is_order_date_missing": "order_date_clean",
                                "is_shipping_date_missing": "shipping_date_clean"})
    return df.withColumn("is_ship_before_order_flag", flag_out_of_order("order_date_clean", "shipping_date_clean"))


def clean_delivery(df: DataFrame) -> DataFrame:
    """Stage B: shipping mode, order / delivery status, late-risk flag, day counts."""
    upper = {"__mode": F.upper(X.strip_junk("shipping_mode")), **{f"__{n}": X.upper_trim(c) for n, c in (
        ("status", "order_status"), ("delivery", "delivery_status"), ("risk", "late_delivery_risk"))}}
    df = df.withColumns(upper).withColumns({
        "shipping_mode_clean": X.by_pattern(F.col("__mode"), X.SHIPPING_MODE_PATTERNS),
        "order_status_clean": X.known_category(F.col("__status"), X.CATEGORY_NULLS, X.ORDER_STATUS_SYNONYMS),
        "delivery_status_clean": X.by_value(F.col("__delivery"), X.DELIVERY_STATUS_VALUES),
        "late_delivery_risk_clean": X.known_bool01(F.col("__risk")),
        "real_shipping_days_clean": M.safe_int("real_shipping_days"),
        "scheduled_days_for_shipment_clean": M.safe_int("scheduled_days_for_shipment"),
    }).drop(*upper)
    return add_missing_flags(df, DELIVERY_FLAGS)


def clean_money_quantity(df: DataFrame) -> DataFrame:
    """Stage C: currency text, rates, quantity; missing flags and quantity <= 0 flag."""
    df = df.withColumns({
        **{f"{c}_clean": M.parse_money(c) for c in MONEY_COLUMNS},
        "order_item_discount_rate_clean": M.safe_double("order_item_discount_rate"),
        "order_item_profit_ratio_clean": M.safe_double("order_item_profit_ratio"),
        "order_item_quantity_clean": M.safe_int("order_item_quantity"),
    })
    df = add_missing_flags(df, MONEY_FLAGS)
    return df.withColumn("is_quantity_invalid", flag_nonpositive("order_item_quantity_clean"))


def clean_segments(df: DataFrame) -> DataFrame:
    """Stage D: segment, region, market, country, state."""
    upper = {**{f"__{n}": F.upper(X.strip_junk(c)) for n, c in (("segment", "customer_segment"), ("region", "order_region"), ("market", "market"))},
             **{f"__{n}": X.upper_trim(c) for n, c in (("country", "order_country"), ("state", "order_state"))}}
    df = df.withColumns(upper).withColumns({
        "customer_segment_clean": X.by_pattern(F.col("__segment"), X.SEGMENT_PATTERNS),
        "order_region_clean": X.by_value(F.col("__region"), X.REGION_VALUES),
        "market_clean": X.by_value(F.col("__market"), X.MARKET_VALUES),
        "order_country_clean": X.by_synonyms(F.col("__country"), X.COUNTRY_SYNONYMS),
        "order_state_clean": X.known_category(F.col("__state"), X.CATEGORY_NULLS),
    }).drop(*upper)
    return add_missing_flags(df, SEGMENT_FLAGS)


def clean_orders(raw: DataFrame, key: str = "order_item_id", fuse_dedupe: bool = True, few_columns: bool = False,
                 keep: Callable[..., DataFrame] | None = None) -> DataFrame:
    """Raw all-text order lines -> the final staging table (stages A, B, C, D). ``few_columns``, ``keep``: as in stage A."""
    return (raw.transform(lambda d: clean_keys_dates(d, key=key, fuse_dedupe=fuse_dedupe, few_columns=few_columns, keep=keep))
            .transform(clean_delivery).transform(clean_money_quantity).transform(clean_segments))
