"""End-to-end invariants on sf0.001, oracle agreement on a subset, and plan checks."""

import os
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def qs():
    return E.queries()


def test_entry_runs(spark):
    r = E.entry(spark).collect()
    assert len(r) == 1
    vals = [r[0][c] for c in ("orders_placed", "orders_shipped", "orders_delivered", "orders_delivered_on_time")]
    assert vals == sorted(vals, reverse=True) and vals[0] > 0


def test_queries_and_oracle_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    # every query of the reference's own operators has its SQL
    assert {k for k in q if not re.match(r"op\d+_|pipeline$", k)} <= set(o)


def test_staging_key_is_unique(spark, qs):
    r = qs["key_uniqueness_staging"](spark, SF_SMALL).first()
    assert r["total_rows"] == r["distinct_keys"]


def test_cohort_month_zero_is_100(spark, qs):
    m = qs["mart_cohort"](spark, SF_SMALL)
    assert m.filter("month_index = 0 AND retention_pct <> 100").count() == 0


def test_rfm_tiles_balanced(spark, qs):
    m = qs["mart_churn_rfm"](spark, SF_SMALL).cache()
    for c in ("r_score", "f_score", "m_score"):
        sizes = [r[1] for r in m.groupBy(c).count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_ltv_formula_agrees(spark, qs):
    assert qs["ltv_formula_check"](spark, SF_SMALL).first()["mismatch_count"] == 0


def test_no_orphans(spark, qs):
    for name in ("orphan_customers", "orphan_products", "orphan_dates"):
        assert qs[name](spark, SF_SMALL).first()[0] == 0


def test_no_python_udfs_in_plans(spark, qs):
    for name in ("clean_orders", "mart_funnel", "mart_ltv", "mart_cohort"):
        plan = qs[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def _explain(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filters_and_pruning_reach_the_scan(spark, qs):
    plan = _explain(qs["slice_mart"](spark, SF_SMALL))
    pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters")]
    assert pushed and "GreaterThanOrEqual(order_date_clean" in pushed[0] and "In(market" in pushed[0]
    schema = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")][0]
    assert "sales" not in schema  # only the mart's columns are read


@pytest.mark.parametrize("names", [["funnel_counts", "mart_cohort", "mart_churn_rfm", "mart_ltv",
                                    "date_quality_summary", "clean_orders"]])
def test_oracle_subset(names):
    out = subprocess.run([sys.executable, "tools/check_oracle.py", SF_SMALL, *names], cwd=REPO,
                         capture_output=True, text=True, timeout=1500)
    assert "mismatches: 0" in out.stdout, out.stdout[-3000:]


def test_a_query_builds_only_what_it_reads(spark):
    import shutil
    import tempfile

    from acct_health.plans.warehouse import star_tables

    d = tempfile.mkdtemp(prefix="acct-in-") + "/sf"
    shutil.copytree(SF_SMALL, d)
    star = star_tables(spark, d, E.CEILING)
    star["fact_order_item"].count()
    assert [t for t in star if star.written(t)] == ["stg_orders_final", "fact_order_item"]
    before = star["fact_order_item"].inputFiles()
    assert star_tables(spark, d, E.CEILING)["fact_order_item"].inputFiles() == before
    old = star["fact_order_item"]
    os.utime(f"{d}/lineitem.parquet", (1, 1))  # the input has changed
    again = star_tables(spark, d, E.CEILING)
    assert not again.written("fact_order_item")
    assert again["fact_order_item"].inputFiles() != before
    assert old.count() == again["fact_order_item"].count() > 0  # the old version is there for those who read it


def test_no_local_folder_off_local_masters():
    from types import SimpleNamespace

    from acct_health.session import ensure_checkpoint_dir

    for master, good in (("spark://host:7077", False), ("local-cluster[2,1,1024]", False), ("local[2]", True)):
        kept = []
        sc = SimpleNamespace(getCheckpointDir=lambda: None, setCheckpointDir=kept.append, master=master)
        session = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda key, default: default))
        if good:
            assert ensure_checkpoint_dir(session) == kept[0]
        else:
            with pytest.raises(RuntimeError):
                ensure_checkpoint_dir(session)


def test_without_dated_rows_the_calendar_is_empty(spark):
    from acct_health.plans.star import build_dim_date, calendar_span

    fact = spark.createDataFrame([(None,)], "order_date_clean date")
    assert build_dim_date(spark, *calendar_span(fact)).count() == 0


def test_ltv_scans_the_fact_once(spark, qs):
    plan = qs["mart_ltv"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", plan)) == 2  # the fact and the customers
    assert "Window" not in plan
