"""Operator 6 against brute force."""
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from acct_health.llm import simhash
from acct_health.llm.components import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def reach(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def near(fps, distance):
    x = np.array(fps, np.uint64)
    return [(i, j) for i in range(len(x)) for j in np.flatnonzero(np.bitwise_count(x[i] ^ x[i + 1:]) <= distance) + i + 1]


def test_fingerprint_in_segments(monkeypatch):
    texts = [None, "", "  ", "A b", "One TWO three four", "É é one two " * 40, "w" * 90 + " x y z"]
    monkeypatch.setattr(simhash, "SEGMENT", 16)
    assert [simhash.fingerprint(t.encode() if t is not None else None) for t in texts] == [plain_fingerprint(t) for t in texts]


@pytest.mark.parametrize("which", ["documents", "odd", "empty"])
def test_components(request, which):
    docs = request.getfixturevalue(which)
    rows = docs.select("doc_id", "text").collect()
    fps = [plain_fingerprint(r["text"]) for r in rows]
    roots = reach(len(rows), near(fps, 3))
    low = {}
    for r, k in zip(rows, roots):
        if r["doc_id"] is not None:
            low[k] = min(low.get(k, 1 << 60), r["doc_id"])
    want = [(r["doc_id"], fp - (1 << 64) if fp >> 63 else fp, low.get(k)) for r, fp, k in zip(rows, fps, roots)]
    assert sorted(map(tuple, simhash.simhash_components(docs).collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("block", [4, 2048])
def test_links_of_a_dense_group(spark, block):
    """A ball of near copies and far ones; small blocks, so that the group is cut."""
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    fps = sorted({centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for _ in range(200)} | {rng.getrandbits(64) for _ in range(300)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    index = {f: i for i, f in enumerate(signed)}
    found = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long").repartition(4), 3, block).collect()
    pairs = [(index[r["a"]], index[r["b"]]) for r in found]
    assert all(bin(fps[a] ^ fps[b]).count("1") <= 64 for a, b in pairs)
    assert reach(len(fps), pairs) == reach(len(fps), near(fps, 3))


@pytest.mark.parametrize("count", [10, 10**5, 10**8, 10**11])
def test_thresholds_cover_the_distance(count):
    both = np.full((64, 64), count // 4)
    np.fill_diagonal(both, count // 2)
    parts = simhash.allocate(count, both, 3)
    assert sum(t + 1 for _, t in parts) == 4
    bits = [b for p, _ in parts for b in p]
    assert len(bits) == len(set(bits))


def test_large_links_and_chains(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, 7), (5, 3), (3, 5), (None, 4)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 100 for i in range(100, 161)}, 3: 3, 5: 3}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_row_of_each_group_stays(odd):
    kept = simhash.drop_near_copies(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids))
    low = simhash.simhash_components(odd)
    assert sorted(i for i in ids if i is not None) == sorted(r[0] for r in low.where("component_id IS NOT NULL").select("component_id").distinct().collect())
    assert kept.where(F.col("text") == "same text again").count() == 1


def test_rows_without_an_id_or_with_a_shared_one(spark):
    """As many rows stay as there are components, one of each; of groups that have an id, its row."""
    texts = ["the quick brown fox jumps over the lazy dog", "a wholly different line about ships and harbours", "numbers one two three four five six seven",
             "rain fell on the old town all through the night", "she wrote the letter and sent it to the north", "copper tin and iron were traded for salt"]
    rows = [(None, texts[0]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (7, texts[4]), (None, texts[4]), (None, texts[5]), (None, texts[5]), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = reach(len(rows), near(fps, 3))
    assert len(set(roots)) == 7
    got = [tuple(r) for r in simhash.drop_near_copies(docs).collect()]
    assert sorted(got, key=str) == sorted({(7, texts[4]), *(r for r in rows if r[1] != texts[4])}, key=str)
    assert simhash.drop_near_copies(docs.where("false")).count() == 0
