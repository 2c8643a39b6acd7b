"""Data-quality operators on literal rows."""

from acct_health.operators import integrity as I
from acct_health.operators import profile as P


def test_key_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "c"), (None, "d")], "k int, v string")
    r = P.key_uniqueness(df, "k").first()
    assert (r["total_rows"], r["distinct_keys"]) == (5, 2)
    assert sorted(tuple(x) for x in P.duplicate_keys(df, "k").collect()) == [(1, 2), (2, 2)]
    assert P.duplicate_row_count(df).first()[0] == 1


def test_value_counts_top_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    got = [tuple(r) for r in P.value_counts(df, "v", top=2).collect()]
    assert got == [("c", 2), (None, 1)]


def test_range_and_parse_failures(spark):
    df = spark.createDataFrame([("0.5", "$1", 1.0), ("1.5", "x1", None), (None, "N/A", None), ("??", "", None)],
                               "rate string, sales string, sales_clean double")
    r = P.range_check(df, "rate", 0.0, 1.0, "rate").first()
    assert (r["min_rate"], r["max_rate"], r["out_of_range_count"], r["null_count"]) == (0.5, 1.5, 1, 1)
    assert P.parse_failure_counts(df, {"sales": "sales_clean"}).first()["bad_sales"] == 1


def test_flag_consistency(spark):
    df = spark.createDataFrame([(3, 2, 1), (2, 2, 0), (3, 2, 0), (None, 2, 1)], "r bigint, s bigint, f int")
    r = P.flag_consistency(df, "r", "s", "f").first()
    assert tuple(r) == (3, 2, 1)


def test_orphans_count_rows_and_null_keys(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "k int")
    dim = spark.createDataFrame([(1,), (3,)], "k int")
    assert I.orphan_count(fact, dim, "k").first()[0] == 2
    assert I.orphan_count(fact, dim, "k", skip_null_keys=True).first()[0] == 1
    r = I.row_count_match(fact, dim, "f", "d").first()
    assert (r["f"], r["d"]) == (5, 2)


def test_type_checks_cover_the_reference_lists():
    """Six id, two day-count and ten money and quantity columns, each in a registered profile with SQL."""
    import __spark_entry__ as E
    from acct_health.plans import quality_suite as Q
    lists = {"schema_profile_ids": (Q.ID_COLUMNS, 6), "schema_profile": (Q.DAY_COLUMNS, 2), "schema_profile_amounts": (Q.AMOUNT_COLUMNS, 10)}
    assert set(lists) <= set(E.queries())
    for name, (columns, n) in lists.items():
        assert len(set(columns)) == n
        assert all(f"'{c}' AS column_name" in E.oracle_sql()[name] for c in columns)
