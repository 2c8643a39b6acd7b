"""Tables that are replaced while they are read."""
import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from acct_health.plans import warehouse
from acct_health.sources.tables import TableStore


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="acct-tables-")


def versions(root, name):
    return sorted(n for n in os.listdir(f"{root}/{name}") if not n.startswith(("_", ".")))


def test_a_reader_before_a_replacement_ends_right(spark, root):
    with TableStore(spark, root) as store:
        store.replace("t", spark.range(5))
        before = store.read("t").where("id > 1")
        store.replace("t", spark.range(100, 103))
        store.replace("t", store.read("t").select((F.col("id") + 1).alias("id")))  # from itself
        assert [r[0] for r in before.orderBy("id").collect()] == [2, 3, 4]
        assert sorted(r[0] for r in store.read("t").collect()) == [101, 102, 103]
        assert store.tables() == ["t"]
    assert len(versions(root, "t")) == 1  # nothing is left of the others


def test_a_later_session_reads_it_and_pins_of_others_hold(spark, root):
    first, second = TableStore(spark, root), TableStore(spark, root)
    first.replace("t", spark.range(3))
    held = second.read("t")
    first.replace("t", spark.range(4))
    assert len(versions(root, "t")) == 2 and held.count() == 3
    first.close()
    assert len(versions(root, "t")) == 2
    second.close()
    assert len(versions(root, "t")) == 1
    assert TableStore(spark, root).read("t").count() == 4


def test_a_failed_write_leaves_the_table(spark, root):
    store = TableStore(spark, root)
    with pytest.raises(KeyError):
        store.read("t")
    store.replace("t", spark.range(3))
    with pytest.raises(Exception):
        store.replace("t", spark.range(3).select(F.raise_error(F.lit("no")).alias("id")))
    assert store.read("t").count() == 3 and len(versions(root, "t")) == 1
    store.drop("t")
    assert store.tables() == []


def test_two_commits_at_once_and_open_versions(spark, root):
    store = TableStore(spark, root)
    store.replace("t", spark.range(1))
    # another writer's version without a commit yet, and one with a commit of the same number
    for v in ("open", "zzzz"):
        spark.range(7).write.parquet(f"{root}/t/{v}")
    open(f"{root}/t/_commits/000000000001-zzzz", "w").close()
    assert store.read("t").count() == 7
    store.vacuum("t")
    assert versions(root, "t") == ["open", "zzzz"]
    store.vacuum("t", open_hours=-1)
    assert versions(root, "t") == ["zzzz"]


def test_tasks_that_write_star_tables_stay_small(spark, monkeypatch):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(n) for n in names]
    within = []
    monkeypatch.setattr(TableStore, "replace", lambda store, name, df, **k: within.append([int(spark.conf.get(n)) for n in names]))
    monkeypatch.setattr(TableStore, "current", lambda store, name: "version")
    monkeypatch.setattr(TableStore, "read", lambda store, name: None)
    for size in (1, 100 << 20, 1000 << 20):
        tables = warehouse.StarTables(spark, "/root/testdata/sf0.001", dt.date(2001, 8, 1))
        tables.sf_dir, tables.stamp = f"/root/testdata/sf0.001?{size}", (("file", size, 0),)
        monkeypatch.setattr(tables, "_plan", lambda name: None)
        tables["raw_order_lines"]
    assert [n for n, _ in within] == [int(before[0]), 50, 500] and {b for _, b in within} == {4 << 20}
    assert [spark.conf.get(n) for n in names] == before
    for size in ("16k", "1m"):  # a smaller value of the session holds
        spark.conf.set(names[1], size)
        with warehouse.small_partitions(spark, 1):
            assert int(spark.conf.get(names[1])) == {"16k": 16 << 10, "1m": 1 << 20}[size]
        assert spark.conf.get(names[1]) == size
    spark.conf.set(names[1], before[1])


def test_few_parts_are_written_before_whole_tables(spark, tmp_path):
    import shutil

    sf = shutil.copytree("/root/testdata/sf0.001", tmp_path / "sf")
    star = warehouse.StarTables(spark, str(sf), dt.date(2001, 8, 1))
    stg, fact, customers = star.parts(("order_item_id",), ("customer_id", "is_order_date_missing"), ("dim_customer",))
    day = star.part("fact_order_item", ("order_date_key", "sales"))
    assert not any(star.written(t) for t in star) and day.columns == ["order_date_key", "sales"]
    assert star.part("fact_order_item", ("order_date_key", "sales")).inputFiles() == day.inputFiles()
    market = star.part("stg_orders_final", ("market_clean",))
    assert market.columns == ["market_clean"] or star.written("stg_orders_final")
    whole = star["fact_order_item"]
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(day) == rows(whole.select("order_date_key", "sales"))
    assert rows(fact) == rows(whole.select("customer_id", "is_order_date_missing"))
    assert rows(stg.select("order_item_id")) == rows(star["stg_orders_final"].select("order_item_id"))
    assert rows(customers) == rows(star["dim_customer"])
    assert rows(market.select("market_clean")) == rows(star["stg_orders_final"].select("market_clean"))
    assert "sales_clean" in star.part("stg_orders_final", ("sales_clean",)).columns and star.written("stg_orders_final")
