"""DataFrame operators: dedupe, latest value, dominant value, global ntile, cohort censoring."""

import datetime as dt
import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from acct_health.operators.dedupe import drop_exact_duplicates, keep_earliest_per_key, pack_texts, unpack_texts
from acct_health.operators.dominant import dominant_value
from acct_health.operators.latest import latest_non_null
from acct_health.operators.ntile import ntile_by_rank, ntile_global
from acct_health.plans.cohort import drop_censored

d = dt.date


def test_latest_non_null(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, d(2024, 1, 1), None), (2, d(2024, 1, 1), "x"),
                                (2, d(2024, 2, 1), "y"), (2, None, "z")], "k int, dt date, v string")
    got = dict(df.groupBy("k").agg(latest_non_null("v", "dt").alias("v")).collect())
    assert got == {1: "a", 2: "y"}


def test_keep_earliest_and_exact_duplicates(spark):
    rows = [(1, d(2024, 1, 2), "b"), (1, d(2024, 1, 1), "a"), (1, None, "c"), (2, None, "x"), (2, None, "x"),
            (3, d(2024, 1, 1), "q"), (3, d(2024, 1, 1), "p")]
    df = spark.createDataFrame(rows, "k int, dt date, v string")
    assert drop_exact_duplicates(df).count() == 6
    got = {r["k"]: r["v"] for r in keep_earliest_per_key(df, "k", [F.col("dt").asc_nulls_last()]).collect()}
    assert got == {1: "a", 2: "x", 3: "p"}


def test_keep_earliest_plans_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    plan = keep_earliest_per_key(df, "k", [F.col("v").asc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_dominant_value(spark):
    rows = [(1, "A", 10, d(2024, 1, 1)), (1, "A", 11, d(2024, 1, 2)), (1, "B", 12, d(2024, 3, 1)),
            (2, "A", 20, d(2024, 1, 1)), (2, "B", 21, d(2024, 2, 1)), (3, None, 30, d(2024, 1, 1))]
    df = spark.createDataFrame(rows, "c int, r string, o int, dt date")
    got = dict(dominant_value(df, "c", "r", "o", "dt", "dom").collect())
    assert got == {1: "A", 2: "B"}


def _tile_sizes(df, col):
    return [r[1] for r in df.groupBy(col).count().orderBy(col).collect()]


def test_ntile_small_inputs(spark):
    s7 = spark.range(7).select(F.col("id").alias("cid"), F.col("id").alias("v"))
    assert _tile_sizes(ntile_global(s7, 5, [("v", False)], ["cid"], "t"), "t") == [2, 2, 1, 1, 1]
    s3 = spark.range(3).select(F.col("id").alias("cid"), F.col("id").alias("v"))
    assert [r["t"] for r in ntile_global(s3, 5, [("v", False)], ["cid"], "t").orderBy("cid").collect()] == [1, 2, 3]
    assert ntile_global(s3.where("cid < 0"), 5, [("v", False)], ["cid"], "t").count() == 0


def test_ntile_by_rank_matches_builtin_over_many_partitions(spark):
    """Heavily tied values and nulls; without coalescing, so that the sorted table has several partitions."""
    df = spark.range(20000).select(
        F.col("id").alias("cid"), F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 3).alias("v"))
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        for desc in (False, True):
            ours = ntile_by_rank(df, 5, [("v", desc), ("cid", False)], "t")
            o = F.col("v").desc() if desc else F.col("v").asc()
            ref = df.withColumn("t2", F.ntile(5).over(Window.orderBy(o, F.col("cid"))))
            assert ours.join(ref, "cid").filter("t <> t2").count() == 0
            sizes = _tile_sizes(ours, "t")
            assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
            # the rows are in several tasks, and only one row per task meets in a single one
            assert len(ours.inputFiles()) > 1
    finally:
        spark.conf.unset(name)


def test_ntile_by_rank_reads_its_input_once(spark):
    """The plan that ranks reads the written table only, and no exchange is by a literal or for all rows."""
    df = spark.range(5000).select(F.col("id").alias("cid"), (F.col("id") % 3).alias("v"))
    ranked = ntile_by_rank(ntile_by_rank(df, 5, [("v", False), ("cid", False)], "t"), 5, [("v", True), ("cid", False)], "u")
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Range (" not in plan
    for line in plan.splitlines():
        if "SinglePartition" in line or "Window" in line:
            assert "cid" not in line
    assert "hashpartitioning(0" not in plan


def test_rows_with_unreadable_ids_are_kept_and_flagged(spark):
    from acct_health.plans.cleaning import clean_keys_dates
    rows = [("A1", "2024/03/05", None), ("B2", "2024/03/05", None), ("C3", None, None), ("7", "2024/03/06", None), ("7", "2024/03/05", None),
            ("A1", "2024/03/05", None)]
    out = clean_keys_dates(spark.createDataFrame(rows, "order_item_id string, order_date string, shipping_date string")).collect()
    assert sorted(((r["order_item_id"], r["is_order_item_id_invalid"], str(r["order_date_clean"])) for r in out), key=str) == sorted(
        [(None, True, "2024-03-05"), (None, True, "2024-03-05"), (None, True, "None"), (7, False, "2024-03-05")], key=str)


def test_null_customers_are_nobody(spark):
    from acct_health.plans.cohort import mart_cohort
    rows = [(1, d(2024, 1, 3)), (2, d(2024, 1, 9)), (None, d(2024, 1, 1)), (None, d(2024, 3, 1)), (1, d(2024, 2, 1))]
    out = mart_cohort(spark.createDataFrame(rows, "customer_id int, order_date_clean date"), d(2026, 1, 1)).collect()
    assert {(str(r["cohort_month"]), r["month_index"]): (r["active_customers"], r["cohort_size"]) for r in out} == {
        ("2024-01-01", 0): (2, 2), ("2024-01-01", 1): (1, 2), ("2024-01-01", 2): (0, 2)}


def test_exact_average(spark):
    from acct_health.operators.average import exact_avg
    df = spark.createDataFrame([(28.79,), (28.8,)], "v double")
    r = df.agg(F.round(exact_avg("v"), 2).alias("a"), exact_avg(F.when(F.col("v") < 0, F.col("v"))).alias("n")).first()
    assert r["a"] == 28.8 and r["n"] is None


def test_dim_coverage_reads_the_fact_once(spark):
    from acct_health.operators.integrity import dim_coverage
    path = tempfile.mkdtemp(prefix="acct-cov-") + "/fact"
    spark.createDataFrame([(1, 10), (1, 11), (2, None)], "a int, b int").write.parquet(path)
    dims = {"da": (spark.range(3).withColumnRenamed("id", "a"), "a"), "db": (spark.range(2).withColumnRenamed("id", "b"), "b")}
    out = dim_coverage(spark.read.parquet(path), dims)
    assert out.first().asDict() == {"da_rows": 3, "distinct_as_in_fact": 2, "db_rows": 2, "distinct_bs_in_fact": 2}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1


def test_reports_are_sorted(spark):
    from acct_health.operators.profile import value_counts
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "v string")
    assert [tuple(r) for r in value_counts(df, "v").collect()] == [("b", 2), (None, 1), ("a", 1)]
    assert [r["v"] for r in value_counts(df, "v", by_value=True).collect()] == [None, "a", "b"]


def test_drop_censored(spark):
    df = spark.createDataFrame([(d(2024, 1, 1), 29), (d(2024, 1, 1), 30)], "cohort_month date, month_index int")
    got = [r["month_index"] for r in drop_censored(df, d(2026, 7, 30)).collect()]
    assert got == [29]


def test_cohort_index(spark):
    """The fixture of M6: 31 January to 1 February is one month."""
    import datetime as dt

    from acct_health.plans.cohort import cohort_index
    jan, feb, mar = (dt.date(2024, m, 1) for m in (1, 2, 3))
    df = spark.createDataFrame([(1, [feb, jan]), (2, [mar]), (3, [])], "customer_id long, months array<date>")
    assert sorted(map(tuple, cohort_index(df).collect())) == [(1, jan, 0), (1, jan, 1), (2, mar, 0)]


def test_entity_profile_matches_its_parts(spark):
    """Base and dominant values of one scan equal separate aggregates: ties, nulls, repeated and invalid rows, a null and a hot entity."""
    import random

    from acct_health.operators.dominant import entity_profile
    r = random.Random(4)
    rows = [(r.choice([1, 1, 1, 1, 2, 3, 4, None]), r.choice([None, *range(40)]), r.choice(["A", "B", "C", None]), r.choice(["x", "y", None]),
             r.choice([None, *(d(2024, m, 1) for m in (1, 2, 3))]), r.choice([True, False, False, None]), r.choice([None, 1.25, 2.5, 0.1])) for _ in range(600)]
    df = spark.createDataFrame([*rows, (9, 1, "A", "x", d(2024, 1, 1), True, 5.0), (10, 1, None, None, d(2024, 1, 1), False, None)],
                               "c int, o int, r string, m string, dt date, bad boolean, s double")
    got = entity_profile(df, "c", "o", "dt", {"dr": "r", "dm": "m"}, ~F.col("bad"), {"total": F.col("s")}, "orders", "lo", "hi")
    base = df.where("dt is not null and not bad").groupBy("c").agg(
        F.count_distinct("o").alias("orders"), F.min("dt").alias("lo"), F.max("dt").alias("hi"), F.round(F.sum("s"), 2).alias("total"))
    want = (base.join(dominant_value(df, "c", "r", "o", "dt", "dr"), "c", "left").join(dominant_value(df, "c", "m", "o", "dt", "dm"), "c", "left"))
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def _rows_with_duplicates():
    import random
    r = random.Random(8)
    some = [(r.choice([None, 1, 2]), r.choice([None, "", "a", "b"]), r.choice([None, "", "a", "b"]), r.choice([None, 0.5, -0.0, 0.0])) for _ in range(300)]
    return [*some, (7, "x", None, None), (7, None, "x", None), (8, "hot", "hot", 1.0)] + [(9, "hot", "hot", 1.0)] * 50


def test_exact_duplicates_by_digest(spark):
    """Equal to Spark's distinct; values that only move between null columns differ; digests that collide for all rows, or all but a few, change nothing."""
    from acct_health.operators.dedupe import drop_exact_duplicates, row_digest, with_repeated
    from acct_health.operators.profile import duplicate_row_count
    df = spark.createDataFrame(_rows_with_duplicates(), "a int, b string, c string, d double").repartition(4)
    df = df.withColumn("d", F.when(F.col("d") == 0, 0.0).otherwise(F.col("d")))  # which of -0.0 and 0.0 stays is open
    want = sorted(map(str, df.distinct().collect()))
    same = lambda cols: (F.lit(3).cast("long"), F.lit(4).cast("long"))
    few = lambda cols: tuple(F.pmod(x, F.lit(5)).cast("long") for x in row_digest(cols))
    for digest in (row_digest, same, few):
        assert sorted(map(str, drop_exact_duplicates(df, digest).collect())) == want
    assert duplicate_row_count(df).first()[0] == df.count() - len(want)
    alone = with_repeated(df).where("not __repeated").drop("__repeated")
    assert 0 < alone.count() == alone.distinct().count()
    assert drop_exact_duplicates(df.where("false")).count() == 0


def test_whole_rows_are_not_shuffled_for_a_digest(spark):
    from acct_health.operators.dedupe import with_repeated
    df = spark.createDataFrame(_rows_with_duplicates(), "a int, b string, c string, d double")
    plan = with_repeated(df)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any(f"{c}#" in line for line in exchanges for c in ("(a", " a", "(b", " b", "(c", " c", "(d", " d"))


def test_month_sets(spark):
    """Cohorts of bit sets equal those of sets of months, over more months than a word holds and with a null entity."""
    import random

    from acct_health.plans.cohort import mart_cohort
    r = random.Random(6)
    rows = [(r.choice([None, *range(60)]), r.choice([None, d(r.randint(1990, 2003), r.randint(1, 12), r.randint(1, 28))])) for _ in range(900)]
    rows += [(100 + i, d(1990 + i, 1, 31)) for i in range(14)] + [(100, d(2003, 12, 31))]
    df = spark.createDataFrame(rows, "customer_id int, order_date_clean date")
    months = {}
    for c, day in rows:
        if day:
            months.setdefault(c, set()).add(day.year * 12 + day.month - 1)
    cells, ceiling = {}, d(2003, 6, 15)
    for c, some in months.items():
        for m in some:
            key = (min(some), m - min(some))
            cells[key] = cells.get(key, 0) + (c is not None)
    last = 2003 * 12 + 4  # May 2003 ends before the ceiling less a month
    want = sorted((d(k // 12, k % 12 + 1, 1), i, n, cells[k, 0]) for (k, i), n in cells.items() if k + i <= last)
    got = sorted(tuple(r)[:4] for r in mart_cohort(df, ceiling).collect())
    assert got == want
    assert mart_cohort(df.where("order_date_clean is null"), ceiling).count() == 0


def test_packed_texts_sort_as_their_columns_and_come_back(spark):
    values = [None, "", "a", "ab", "\x00", "\x01", "\x02", "\x00\x01", "\x01\x00", "\x01\x02", "a\x00", "a\x01b", "é", "\U0001F600"]
    rows = [(i, i % 3 or None, x, y, i % 2, z) for i, (x, y, z) in enumerate(
        (x, y, z) for x in values for y in values for z in (None, "", "z"))]
    df = spark.createDataFrame(rows, "i int, k int, a string, `b c` string, n int, z string")
    packed = df.select("*", pack_texts(["a", "b c", "z"]).alias("p"))
    plain = [r.i for r in df.orderBy(F.asc_nulls_first("a"), F.asc_nulls_first("`b c`"), F.asc_nulls_first("z")).collect()]
    assert [r.i for r in packed.orderBy("p").collect()] == plain
    back = unpack_texts(packed.select("i", "k", "n", "p"), "p", ["a", "b c", "z"]).select(*[f"`{c}`" for c in df.columns])
    assert sorted(map(tuple, back.collect())) == sorted(rows, key=lambda r: r[0])
    for tie in (["a", "b c", "n", "z", "i"], ["n", "z", "b c", "a"]):
        keep = lambda pack: sorted(map(tuple, keep_earliest_per_key(df, "k", [F.col("n").desc()], tie, pack=pack).collect()), key=str)
        assert keep(True) == keep(False)


def test_cleaning_shuffles_one_text_for_all_raw_columns(spark):
    from acct_health.plans.cleaning import clean_orders
    from acct_health.sources.order_lines import order_lines
    raw = order_lines(spark, "/root/testdata/sf0.001")
    plan = clean_orders(spark.createDataFrame([], raw.schema))._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if " Sort [" in line]
    assert sorts and all("__pack" in line and "order_country" not in line for line in sorts)


def test_the_methods_limit_holds_while_writing_only(spark):
    from acct_health.plans.warehouse import METHOD_BYTES, short_methods
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    with short_methods(spark):
        assert int(spark.conf.get(name)) <= METHOD_BYTES
    assert spark.conf.get(name) == before


def test_keep_earliest_by_lead_is_keep_earliest(spark):
    import random

    from acct_health.operators.dedupe import keep_earliest_by_lead
    r = random.Random(5)
    some = lambda *values: r.choice([None, *values])
    rows = [(some("a", "b", "c", "d", *map(str, range(150))), some(1, 2), some(1, 2, 3), some("x", "y", ""), some("p", "q\x00", "\x01")) for _ in range(500)]
    df = spark.createDataFrame(rows + rows[:40], "k string, day int, id long, t string, u string").repartition(3)
    order, ties = [F.col("day").asc_nulls_last()], ["id", "t", "u"]
    want = sorted(map(repr, keep_earliest_per_key(df, "k", order, tie_break=ties).collect()))
    for lead, bits in ((0, 8), (1, 7), (1, 20), (3, 12)):
        assert sorted(map(repr, keep_earliest_by_lead(df, "k", order, ties, lead, bits).collect())) == want


def test_a_part_renders_few_columns_of_most_lines(spark):
    import datetime as dt

    from acct_health.plans.warehouse import star_tables
    plan = star_tables(spark, "/root/testdata/sf0.001", dt.date(2001, 8, 1))._lines().select("order_region_clean")
    sorts = [line for line in plan._jdf.queryExecution().executedPlan().toString().splitlines() if " Sort [__key" in line]
    assert sorts and any("__pack" not in line for line in sorts)  # lines that differ in their ids are not packed
    windows = [line for line in plan._jdf.queryExecution().optimizedPlan().toString().splitlines() if " Window [" in line]
    assert len(windows) == 2


def test_tied_keys_are_settled_whole(spark):
    """Rows told apart by date and lead stay; keys whose best rows tie in these, the null key among them, are settled by all columns."""
    import random

    from acct_health.operators.dedupe import TIED, earliest_of_keys, earliest_or_tied
    r = random.Random(6)
    some = lambda *values: r.choice([None, *values])
    rows = [(some("a", "n", "s", *map(str, range(200))), some(1, 2), some(1, 2, 3), some("x", "y", ""), some("p", "q\x00", "\x01")) for _ in range(500)]
    df = spark.createDataFrame(rows + rows[:40] + [("hot", 1, 1, "x", "p")] * 500, "k string, day int, id long, t string, u string").repartition(3)
    order, ties = [F.col("day").asc_nulls_last()], ["id", "t", "u"]
    want = sorted(map(repr, keep_earliest_per_key(df, "k", order, tie_break=ties).collect()))
    for lead, bits, pack in ((0, 8, ()), (1, 7, ("t", "u")), (1, 26, ("t",)), (3, 12, ())):
        first = earliest_or_tied(df, "k", order, ties[:lead], pack)
        tied = first.where(f"{TIED} is not null").select(TIED)
        settled = first.where(f"{TIED} is null").drop(TIED)
        assert 0 < tied.count() == tied.distinct().count() and settled.count() > 0
        assert sorted(map(repr, settled.unionByName(earliest_of_keys(df, "k", order, ties, tied, bits)).collect())) == want
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning(k")[1]  # a hot key costs two rows a task


def test_few_columns_are_read_in_one_pass(spark, tmp_path, monkeypatch):
    """A part's lines are joined once, not once for digests and once more; lines equal in all ids that differ elsewhere are settled as in whole tables,
    also where a mart drops some of them; parts whose key is there twice multiply lines as in a plain join."""
    import datetime as dt
    import shutil

    import pyarrow as pa
    import pyarrow.parquet as pq

    from acct_health.plans import funnel, warehouse
    from acct_health.sources.tables import TableStore
    plans, replace = [], TableStore.replace

    def noted(store, name, df, **options):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        replace(store, name, df, **options)

    monkeypatch.setattr(TableStore, "replace", noted)
    sf = shutil.copytree("/root/testdata/sf0.001", tmp_path / "sf")
    lines = pq.read_table(sf / "lineitem.parquet")
    more = lines.slice(0, 300)
    more = more.set_column(more.schema.get_field_index("l_extendedprice"), "l_extendedprice", pa.array([float(i % 7) for i in range(300)]))
    for again in (False, True):  # then with some parts twice
        pq.write_table(pa.concat_tables([lines, more]), sf / "lineitem.parquet")
        if again:
            parts = pq.read_table(sf / "part.parquet")
            dear = parts.slice(0, 40).set_column(parts.schema.get_field_index("p_size"), "p_size", pa.array([77] * 40, parts.schema.field("p_size").type))
            pq.write_table(pa.concat_tables([parts, dear]), sf / "part.parquet")
        star = warehouse.StarTables(spark, str(sf), dt.date(2001, 8, 1))
        columns, plans[:] = ("order_item_id", "sales_clean", "order_status_clean"), []
        part = star.part("stg_orders_final", columns)
        mart = star.part("fact_order_item", ("order_item_id", "is_delivered", "late_delivery_risk"), of=funnel.mart_funnel)
        assert len(plans) == 4 and [sum("Relation [l_orderkey" in line for line in plan.splitlines()) for plan in (plans[0], plans[2])] == [1, 1]
        assert plans[0].count("Window [") == 2 and ("p_partkey" in plans[0]) == again
        staging, rows = star["stg_orders_final"], lambda df: sorted(map(repr, df.collect()))  # noqa: B023,E731
        assert rows(part) == rows(staging.select(*columns))
        assert rows(mart) == rows(funnel.mart_funnel(star["fact_order_item"]).select(*mart.columns))


def test_fact_columns_are_all(spark):
    from acct_health.plans.cleaning import clean_orders, raw_sources
    from acct_health.plans.star import FACT_COLUMNS, build_fact, fact_sources
    from acct_health.sources.order_lines import order_lines
    raw = order_lines(spark, "/root/testdata/sf0.001")
    stg = clean_orders(raw)
    assert build_fact(stg).columns == list(FACT_COLUMNS) and set(fact_sources(FACT_COLUMNS)) <= set(stg.columns)
    assert raw_sources(("is_sales_missing", "sales_clean", "order_date_clean"), raw.columns) == ["sales"] and raw_sources(("is_placed",), raw.columns) is None


def test_suppliers_join_before_lines_are_shuffled(spark):
    """The join of lines and orders, which shuffles lines, is the last; suppliers are broadcast whatever the session's threshold."""
    from acct_health.sources.order_lines import order_lines
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        plan = order_lines(spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set(name, before)
    joins = [line for line in plan.splitlines() if "Join [" in line]
    assert "l_orderkey" in joins[0] and any("BroadcastHashJoin [l_suppkey" in j for j in joins) and "SortMergeJoin [l_suppkey" not in plan


def test_one_number_of_a_digest_is_shuffled(spark):
    """Rows that share it and differ are flagged and compared whole; no more than it is grouped by."""
    from acct_health.operators.dedupe import drop_exact_duplicates, with_repeated
    df = spark.createDataFrame(_rows_with_duplicates(), "a int, b string, c string, d double")
    plan = with_repeated(df)._jdf.queryExecution().executedPlan().toString()
    grouped = [line for line in plan.splitlines() if "Exchange hashpartitioning(__a" in line]
    assert grouped and "__b" not in plan
    half = lambda cols: (F.coalesce(F.col("a").cast("long"), F.lit(-1).cast("long")), F.xxhash64(*cols))  # noqa: E731  the first alone takes many rows for equal
    df = df.where("d is null or d <> 0")
    assert sorted(map(str, drop_exact_duplicates(df, half).collect())) == sorted(map(str, df.distinct().collect()))
