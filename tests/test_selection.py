"""Exact multi-selection and the NTILE built on it, against Spark's own NTILE."""
import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from acct_health.operators import selection
from acct_health.operators.ntile import ntile_many, tile_starts
from acct_health.operators.selection import key_digits, select_ranks

SCHEMA = ("id long, whole long, small int, flag boolean, day date, at timestamp, real double, money decimal(10,2), "
          "wide decimal(30,12), word string, tied long")


def rows(seed, n):
    r = random.Random(seed)
    odd = [float("inf"), float("-inf"), float("nan"), 0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, 1e-300, 0.1, 0.30000000000000004]
    words = ["", "a", "aa", "a\0", "é", "你好", "straße", "prefix-that-is-long-1", "prefix-that-is-long-2", "z" * 30, "Z", " "]
    some = lambda v: None if r.random() < 0.1 else v
    for i in range(n):
        yield (i, some(r.choice([r.randint(-(1 << 63), (1 << 63) - 1), r.randint(-5, 5), (1 << 63) - 1, -(1 << 63)])), some(r.randint(-3, 3)),
               some(r.random() < 0.5), some(dt.date(1900, 1, 1) + dt.timedelta(r.randint(0, 90000))),
               some(dt.datetime(1960, 1, 1) + dt.timedelta(seconds=r.randint(0, 3 * 10**9), microseconds=r.randint(0, 9))),
               some(r.choice([r.choice(odd), r.uniform(-10, 10), 2.0 ** r.randint(-900, 900)])), some(decimal.Decimal(r.randint(-10**6, 10**6)) / 100),
               some(decimal.Decimal(r.randint(-10**26, 10**26)).scaleb(-12)), some(r.choice(words)), 1)


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame(list(rows(1, 700)), SCHEMA).repartition(5).cache()


def builtin(df, k, order):
    keys = [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_first() for c, desc in order]
    return {r[0]: r[1] for r in df.select("id", F.ntile(k).over(Window.orderBy(*keys))).collect()}


@pytest.mark.parametrize("k,few", [(1, 0), (4, 0), (7, 0), (7, 100), (7, 5000)])
def test_every_type_in_one_selection(mixed, k, few, monkeypatch):
    monkeypatch.setattr(selection, "BUCKETS", 16)
    monkeypatch.setattr(selection, "FEW", few)
    columns = ["whole", "small", "flag", "day", "at", "real", "money", "wide", "word", "tied"]
    rankings = {f"{c}_{desc}": ((c, desc), ("id", not desc)) for c in columns for desc in (False, True)}
    for some in (dict(list(rankings.items())[:8]), dict(list(rankings.items())[8:14]), dict(list(rankings.items())[14:])):
        got = ntile_many(mixed, k, some).collect()
        for name, order in some.items():
            assert {r["id"]: r[name] for r in got} == builtin(mixed, k, order), name


@pytest.mark.parametrize("n", [0, 1, 3, 5, 6])
def test_few_rows(spark, n):
    df = spark.createDataFrame(list(rows(2, n)), SCHEMA)
    got = {r["id"]: r["t"] for r in ntile_many(df, 5, {"t": (("real", True), ("word", False), ("id", False))}).collect()}
    assert got == builtin(df, 5, (("real", True), ("word", False), ("id", False)))


def test_rows_equal_in_the_whole_ranking(spark):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("v"))
    sizes = lambda d: sorted(r[1] for r in d.groupBy("t").count().collect())
    assert sizes(ntile_many(df, 5, {"t": (("v", False),)})) == [2] * 5  # by a sort, for the values don't tell rows
    assert sizes(ntile_many(df, 2, {"t": (("v", False),)})) == [5, 5]


def test_tile_starts():
    for n in range(12):
        for k in range(1, 8):
            sizes = [n // k + (i < n % k) for i in range(k)]
            assert tile_starts(n, k) == [s for s in (sum(sizes[:i]) for i in range(1, k)) if s < n]


def test_plan_and_scans_do_not_grow_with_rankings(spark, monkeypatch):
    df = spark.range(100_000).select("id", (F.xxhash64("id") % 1000).alias("v"), F.sin("id").alias("x"))
    one = {"a": (("v", False), ("id", False))}
    many = one | {"b": (("x", True), ("id", False)), "c": (("id", True),), "d": (("v", True), ("id", False))}
    scans = []
    real = type(df).groupBy
    monkeypatch.setattr(type(df), "groupBy", lambda self, *a: scans.append(1) or real(self, *a))
    made = []
    for rankings in (one, many):
        scans.clear()
        out = ntile_many(df, 100, rankings)
        made.append(len(scans))
    assert made[1] <= made[0] + 2 and made[1] <= 6
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Sort", "Window", "Exchange"))


def test_ranks_are_exact(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"))
    digits = key_digits(df, [("v", False)])
    for few in (0, 100, 10_000):
        total, (found,) = select_ranks(df, [digits], lambda n: [0, 17, n // 2, n - 1], buckets=4, few=few)
        assert total == 5000 and {r: key[-1] for r, (key, _) in found.items()} == {0: 0, 17: 17, 2500: 2500, 4999: 4999}
