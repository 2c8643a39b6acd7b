"""Operator 1 against brute force."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from acct_health.llm import embeddings as e


def brute(rows, cosine=0.98):
    good = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])]
    root = {r[0]: r[0] for r in good}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    count = [0] * len(good)
    for i, a in enumerate(good):
        for j in range(i + 1, len(good)):
            b = good[j]
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = (np.array(v[1], np.float64) / np.abs(v[1]).max() for v in (a, b))
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine:
                    count[i] += 1
                    count[j] += 1
                    p, q = find(a[0]), find(b[0])
                    root[max(p, q)] = min(p, q)
    out = [(r[0], c, find(r[0]), r[0] == find(r[0])) for r, c in zip(good, count)]
    kept = {id(r) for r in good}
    return out + [(r[0], 0, r[0], True) for r in rows if id(r) not in kept]


def made(seed=1):
    rng = np.random.default_rng(seed)
    f = lambda x: [float(v) for v in np.float32(x)]
    rows, centre = [], rng.normal(size=8)
    for i in range(120):
        rows.append((i, f(rng.normal(size=8)), int(rng.integers(0, 3))))
    for i in range(120, 260):  # chains and dense groups
        rows.append((i, f(centre + rng.normal(size=8) * (0.05 if i % 2 else 0.16)), 1))
    for i in range(260, 300):  # equal vectors, under two labels
        rows.append((i, f(centre), i % 2))
    rows += [(300, f(np.float32(centre) * 4), 1), (301, None, 1), (302, [0.0] * 8, 1), (303, [1.0, None] + [0.0] * 6, 1), (304, [float("nan")] * 8, 1),
             (305, [float("inf")] + [1.0] * 7, 1), (306, f(centre), None), (307, [], 1), (308, [1.0, 2.0], 1), (309, [1.0, 2.0], 1), (None, f(centre), 1)]
    return rows


@pytest.mark.parametrize("block", [16, 2048])
def test_near_duplicates(spark, block):
    rows = made()
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, kept string, n long").repartition(3)
    got = sorted(map(tuple, e.near_duplicates(table, block=block).collect()), key=str)
    assert got == sorted(brute(rows), key=str)


def test_empty(spark):
    assert e.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label string")).count() == 0


def test_tree_covers():
    x = np.random.default_rng(2).normal(size=(300, 5))
    x[100:200] = x[0] + 0.01 * x[100:200]
    x /= np.linalg.norm(x, axis=1)[:, None]
    tree = e.CoverTree(x)
    assert sorted(tree.order.tolist()) == list(range(300))
    for i, kids in enumerate(tree.kids):
        members = tree.order[tree.begin[i]:tree.end[i]]
        assert tree.centre[i] in members
        assert np.arccos(np.clip(x[members] @ x[tree.centre[i]], -1, 1)).max() <= tree.radius[i] + 1e-6
        if kids.tolist() != [i]:
            assert sorted(m for k in kids for m in tree.order[tree.begin[k]:tree.end[k]]) == sorted(members)
            assert tree.centre[kids[0]] == tree.centre[i]


def test_large_and_tiny_components(spark):
    """Norms of finite vectors that would overflow or vanish."""
    rng = np.random.default_rng(7)
    base = rng.normal(size=(12, 6))
    rows = [(4 * i + j, [float(v) for v in b * scale + b * scale * 1e-3 * rng.normal(size=6)], 0)
            for i, b in enumerate(base) for j, scale in enumerate((1.0, 1e200, 1e-200, 1e-310))]
    rows += [(100, [1.7e308, -1.7e308], 0), (101, [1.7e308, -1.6e308], 0), (102, [5e-324, 0.0], 0), (103, [5e-324, 5e-324], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, e.near_duplicates(df, block=8).collect())) == sorted(brute(rows))
