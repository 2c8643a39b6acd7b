"""Operator 13 against brute force."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from acct_health.llm import lexical_search as L
from acct_health.llm import scan

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain(docs, items, k):
    """(item_id, rank, doc_id, score) by a score for each document."""
    of = lambda t: TERM.findall((t or "").translate(LOWER))
    bags = [(i, Counter(of(t))) for i, t in docs]
    size = [sum(b.values()) for _, b in bags]
    n_docs, n_terms = sum(n > 0 for n in size), sum(size)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, t in items:
        scored = []
        for (i, b), n in zip(bags, size):
            if n:
                m = 75 + 25 * n * n_docs // n_terms
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * b[x] // (1000 * b[x] + 12 * m)) for x in of(t) if b[x])
                if s > 0:
                    scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return out


@pytest.mark.parametrize("shape", [(1, 1), (1, 40), (50, 1), (300, 20), (20, 300), (64, 64)])
def test_treap(shape):
    r = np.random.default_rng(sum(shape))
    some = r.random(shape) < 0.2
    some.flat[0] = True
    row, col = np.nonzero(some)
    value = r.integers(1, 1000, len(row))
    grid = np.zeros(shape, np.int64)
    grid[row, col] = value
    treap = L.K2Treap.unpacked(**L.K2Treap.packed(row, col, value))
    assert treap.most[0] == value.max()
    for _ in range(20):
        rows = r.choice(row.max() + 1, min(5, row.max() + 1), replace=False)
        weights = r.integers(1, 50, len(rows))
        best = L.Best(7)
        best.ids = list(range(shape[1]))
        treap.search(rows, weights, best)
        want = sorted((-s, False, i) for i, s in enumerate((weights @ grid[rows]).tolist()) if s > 0)[:7]
        assert best.held == want


@pytest.mark.parametrize("which", ["documents", "odd", "empty"])
def test_ranking(request, spark, which):
    docs = request.getfixturevalue(which)
    items = [(7, "two words again"), (8, None), (9, ""), (7, "the SAME the same, 12 x5!"), (None, "é 你好 cat-sat")]
    if which == "documents":
        items += [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in L.ranked_documents(docs, benchmark, 20, block_docs=16).collect()]
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()], items, 20)
    low = lambda rows: sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, x[1], x[3], x[2] or 0))
    assert low(got) == low(want)


def test_long_texts_in_parts(monkeypatch):
    import pyarrow as pa

    r = random.Random(1)
    texts = [" ".join(r.choices(["a", "bb", "Ccc", "word" * 300, "x,y"], k=n)) for n in (0, 1, 200, 3, 50)]
    data, starts, ends = scan.flat(pa.array(texts))
    whole = L.postings(data, starts, ends, scan.SpanHash())
    monkeypatch.setattr(L, "CHUNK", 100)
    parts = L.postings(data, starts, ends, scan.SpanHash())
    told = [sorted(((w[0][t], d, f) for t, d, f in zip(*(x.tolist() for x in w[1:])))) for w in (whole, parts)]
    want = sorted((t.encode(), i, n) for i, x in enumerate(texts) for t, n in Counter(TERM.findall(x.translate(LOWER))).items())
    assert told == [want, want]


def test_items_in_blocks(spark, documents, monkeypatch):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").limit(7)
    whole = L.ranked_documents(documents, items, 5).collect()
    monkeypatch.setattr(L, "QUERY_ITEMS", 3)
    assert sorted(map(tuple, L.ranked_documents(documents, items, 5).collect())) == sorted(map(tuple, whole))


def test_few_rows_of_the_index_are_held_at_once(spark, tmp_path, monkeypatch):
    """An index in files of a partition each: its rows, some MB each at size, don't go to a task as one batch, whatever the session's settings."""
    plain_map = L.map_arrow

    def noted(df, work, schema):
        if df.columns[0] != "doc_ids":
            return plain_map(df, work, schema)

        def seen(batches):
            def each():
                for n, batch in enumerate(batches):
                    (tmp_path / f"{id(batches)}-{n}").write_text(str(batch.num_rows))
                    yield batch
            yield from work(each())
        return plain_map(df, seen, schema)

    monkeypatch.setattr(L, "map_arrow", noted)
    names = [*L.OF_TEXTS, *L.OF_INDEX]
    before = [spark.conf.get(n) for n in names]
    docs = [(i, f"w{i % 3} w{i}") for i in range(60)]
    items = [(1, "w1 w7"), (2, "w0")]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    got = L.ranked_documents(df, spark.createDataFrame(items, "item_id long, text string"), 5, block_docs=1)
    assert sorted(map(tuple, got.collect())) == plain(docs, items, 5)
    sizes = [int(f.read_text()) for f in tmp_path.iterdir()]
    assert sum(sizes) == 60 and max(sizes) <= L.INDEX_ROWS  # one row for each document here
    assert [spark.conf.get(n) for n in names] == before
