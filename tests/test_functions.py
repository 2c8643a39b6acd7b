"""Column functions on literal rows (FIXTURES §3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from acct_health.functions import dates as D
from acct_health.functions import money as M
from acct_health.functions import text as X
from acct_health.functions.flags import flag_nonpositive

d = dt.date


def one_col(spark, values, expr_fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r["o"] for r in df.select("i", expr_fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_parse_date_candidates(spark):
    vals = ["03/05/2024", "13/05/2024", "March 05, 2024", "2024/03/05", "05-Mar-24", "2024-03-05 10:11:12",
            "05-Mar-70", " 2024/03/05 ", "31/13/2026 25:99", "2026-02-30 10:00:00", "0000-00-00", "NaT", "####",
            "2024--3", "", "05-03-2024", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    mf, dfc = D.parse_date_candidates("v")
    got = [(r[0], r[1]) for r in df.select(mf, dfc, "i").orderBy("i").collect()]
    assert got[0] == (d(2024, 3, 5), d(2024, 5, 3))
    assert got[1] == (None, d(2024, 5, 13))
    for i in range(2, 6):
        assert got[i] == (d(2024, 3, 5), d(2024, 3, 5)), vals[i]
    assert got[6] == (d(1970, 3, 5), d(1970, 3, 5))
    assert got[7] == (d(2024, 3, 5), d(2024, 3, 5))
    for i in range(8, len(vals)):
        assert got[i] == (None, None), vals[i]


def test_two_digit_years(spark):
    out = one_col(spark, ["05-Mar-68", "05-Mar-69", "05-Mar-99", "05-Mar-00"],
                  lambda c: D.parse_date(c, ["d-MMM-yy"]))
    assert out == [d(2068, 3, 5), d(1969, 3, 5), d(1999, 3, 5), d(2000, 3, 5)]


def test_format_shape_is_superset():
    import re
    for fmt, text in [("yyyy-M-d H:m:s", "2024-3-5 1:2:3"), ("MMMM d, yyyy", "March 5, 2024"),
                      ("d-MMM-yy", "05-Mar-24"), ("M/d/yyyy H:m", "03/05/2024 10:11")]:
        assert re.match(D.format_shape(fmt), text)


def test_resolve_date_pair(spark):
    rows = [("03/05/2024", "2024/03/07"), ("03/05/2024", None), ("03/05/2024", "04/03/2024")]
    df = spark.createDataFrame(rows, "o string, s string")
    o_mf, o_df = D.parse_date_candidates("o")
    s_mf, s_df = D.parse_date_candidates("s")
    order, ship = D.resolve_date_pair(o_mf, o_df, s_mf, s_df)
    got = df.select(order.alias("o"), ship.alias("s")).collect()
    assert got[0]["o"] == d(2024, 3, 5) and got[0]["s"] == d(2024, 3, 7)
    assert got[1]["o"] == d(2024, 3, 5) and got[1]["s"] is None
    # both ambiguous: month-first (Mar 5 -> Apr 3) is ordered, so month-first wins
    assert got[2]["o"] == d(2024, 3, 5) and got[2]["s"] == d(2024, 4, 3)
    # month-first reversed, day-first ordered -> day-first pair
    df2 = spark.createDataFrame([("05/03/2024", "02/04/2024")], "o string, s string")
    o_mf, o_df = D.parse_date_candidates("o")
    s_mf, s_df = D.parse_date_candidates("s")
    order, ship = D.resolve_date_pair(o_mf, o_df, s_mf, s_df)
    r = df2.select(order.alias("o"), ship.alias("s")).first()
    assert (r["o"], r["s"]) == (d(2024, 3, 5), d(2024, 4, 2))


def test_parse_money(spark):
    vals = ["$1,504.42", "2256,63", " 12.50", "$-12", " $12", "??", "none", "", "1.5d", None, "N/A", "7"]
    out = one_col(spark, vals, M.parse_money)
    assert out == [1504.42, 2256.63, 12.5, -12.0, None, None, None, None, None, None, None, 7.0]


def test_safe_casts(spark):
    assert one_col(spark, ["3", "3.0", " 3", "-4", "??", None], M.safe_int) == [3, None, None, -4, None, None]
    assert one_col(spark, ["0.5", "1.5d", "Infinity", "1e3", ".5"], M.safe_double) == [0.5, None, None, 1000.0, 0.5]


def test_strip_junk_and_pattern(spark):
    vals = ["Second Class<br>", "2nd Class", "standard classN/A - check later", "Same day\t",
            "First Class​", "-", None]
    out = one_col(spark, vals, lambda c: X.canonicalize_by_pattern(X.strip_junk(c), X.SHIPPING_MODE_PATTERNS))
    assert out == ["Second Class", "Second Class", "Standard Class", "Same Day", "First Class", None, None]


def test_utrim_unicode(spark):
    assert one_col(spark, ["\t a  ", "  "], X.utrim) == ["a", ""]


def test_normalize_category(spark):
    vals = [" cancelled ", "Pending ", "n/a", "", "NEW_STATE", None]
    out = one_col(spark, vals, lambda c: X.normalize_category(c, X.CATEGORY_NULLS, X.ORDER_STATUS_SYNONYMS))
    assert out == ["CANCELED", "PENDING", None, None, "NEW_STATE", None]


def test_canonicalize_by_value(spark):
    out = one_col(spark, ["  late delivery ", "LATE DELIVERY<br>", None],
                  lambda c: X.canonicalize_by_value(X.utrim(c), X.DELIVERY_STATUS_VALUES))
    assert out == ["Late delivery", None, None]


def test_canonicalize_by_synonyms(spark):
    out = one_col(spark, ["u.s.a.", "méxico", "Rep. of Ireland", "brasil", "France"],
                  lambda c: X.canonicalize_by_synonyms(c, X.COUNTRY_SYNONYMS))
    assert out == ["United States", "Mexico", "Ireland", "Brazil", None]


def test_normalize_bool01(spark):
    out = one_col(spark, ["True", "y", "1", "no", "FALSE", "0", "maybe", None], X.normalize_bool01)
    assert out == [1, 1, 1, 0, 0, 0, None, None]


def test_flag_nonpositive(spark):
    assert one_col(spark, [-1, 0, 1, None], flag_nonpositive, "bigint") == [True, True, False, False]


def test_swap_impossible_date(spark):
    vals = [d(2026, 12, 7), d(2026, 8, 13), d(2026, 8, 8), d(2026, 7, 30)]
    out = one_col(spark, vals, lambda c: D.swap_impossible_date(c, d(2026, 7, 30)), "date")
    assert out == [d(2026, 7, 12), None, d(2026, 8, 8), d(2026, 7, 30)]
    out = one_col(spark, vals, lambda c: D.swap_impossible_date(c, d(2026, 7, 30), null_if_still_after=True), "date")
    assert out == [d(2026, 7, 12), None, None, d(2026, 7, 30)]


def test_month_diff_and_date_key(spark):
    df = spark.createDataFrame([(d(2024, 1, 31), d(2024, 2, 1))], "a date, b date")
    r = df.select(D.month_diff("b", "a").alias("m"), D.date_key("a").alias("k")).first()
    assert r["m"] == 1 and r["k"] == 20240131


def test_each_text_is_upper_cased_once(spark):
    """Stages B and D: one upper and one trim for each of their nine text columns in the optimised plan."""
    from acct_health.plans.cleaning import clean_delivery, clean_segments
    names = ("shipping_mode", "order_status", "delivery_status", "late_delivery_risk", "real_shipping_days", "scheduled_days_for_shipment",
             "customer_segment", "order_region", "market", "order_country", "order_state")
    df = spark.createDataFrame([("x",) * len(names)], ", ".join(f"{n} string" for n in names)).repartition(1)
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    try:
        plan = clean_segments(clean_delivery(df))._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("upper(") == 9


def test_value_dictionaries_at_the_edges(spark):
    from acct_health.functions import text as X
    df = spark.createDataFrame([(None,), ("",), ("  ",), (" n/a ",), ("??",), ("cancelled",), ("Other",), ("\u00a0yes\u2003",), ("0",), ("2",)], "t string")
    got = df.select(X.normalize_category("t", X.CATEGORY_NULLS, X.ORDER_STATUS_SYNONYMS), X.normalize_category("t", ()), X.normalize_bool01("t")).collect()
    assert [r[0] for r in got] == [None, None, None, None, None, "CANCELED", "OTHER", "YES", "0", "2"]
    assert [r[1] for r in got] == [None, None, None, "N/A", "??", "CANCELLED", "OTHER", "YES", "0", "2"]
    assert [r[2] for r in got] == [None] * 7 + [1, 0, None]
