"""Operator 11 against brute force."""
import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from acct_health.llm import suffix_dedup as S


def plain(texts, length, first=False):
    """The spans of each text, by all of its windows."""
    texts = [(t or "").encode() for t in texts]
    where = defaultdict(list)
    for i, t in enumerate(texts):
        for p in range(len(t) - length + 1):
            where[t[p:p + length]].append((i, p))
    marks = [np.zeros(len(t) + 1, np.int8) for t in texts]
    for places in where.values():
        for i, p in sorted(places)[1:] if first else places if len(places) > 1 else []:
            marks[i][p:p + length] = 1
    out = []
    for m in marks:
        edge = np.diff(np.concatenate([[0], m]))
        out.append(list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())))
    return out


def made_up(seed, n=60):
    r = random.Random(seed)
    base = ["".join(r.choices("abé ", k=r.randint(0, 60))) for _ in range(n)]
    out = []
    for i, t in enumerate(base):
        other = r.choice(base)
        cut = r.randint(0, len(other))
        out.append(r.choice([t, t + other[cut:], other[:cut] + t, other, t * 3, "a" * r.randint(0, 90), t.replace("a", "b", 1)]))
    return [*out, None, "", "\0" * 40, "x\0" * 30, "same text again " * 3, "same text again " * 3]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("most", [S.MOST, 3])
def test_spans(spark, seed, keep, most):
    texts = made_up(seed)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_bytes string").repartition(1).sortWithinPartitions("doc_id")
    got = {r["doc_id"]: [tuple(s) for s in r["repeat_spans"]] for r in S.repeat_spans(docs, 12, keep, most=most).collect()}
    assert got == dict(enumerate(plain(texts, 12, keep == "first")))


def test_long_texts_in_parts_and_batches(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 64)
    r = random.Random(5)
    long = "".join(r.choices("ab", k=3000))
    texts = [long, "b" + long[500:900] + "c", "q" * 700, long[:90]]
    from acct_health.llm.scan import flat
    import pyarrow as pa

    data, starts, ends = flat(pa.array(texts))
    parts = list(S._excerpts(data, starts, ends, 40))
    windows = np.zeros(len(data), int)
    for row, at, h, digest, left, right in parts:
        for i, a, lo, hi in zip(row.tolist(), at.tolist(), left.tolist(), right.tolist()):
            windows[starts[i] + a - lo:starts[i] + a + hi - 40 + 1] += 1
    for s, e in zip(starts, ends):  # each window is in one excerpt
        assert (windows[s:max(s, e - 39)] == 1).all() and not windows[max(s, e - 39):e].any()


def test_smaller_neighbours():
    r = random.Random(3)
    for _ in range(50):
        n = r.randint(1, 40)
        place = np.array(r.sample(range(100), n))
        lcp = np.array([-1, *(r.randint(0, 9) for _ in range(n - 1))])
        want = [max([0, *(min(lcp[min(i, j) + 1:max(i, j) + 1]) for j in range(n) if place[j] < place[i])]) for i in range(n)]
        assert S.longest_factors(place, lcp, 1).tolist() == want


@pytest.mark.parametrize("which", ["documents", "odd", "empty"])
def test_operator(request, which):
    docs = request.getfixturevalue(which)
    rows = docs.select("text").collect()
    spans = plain([r[0] for r in rows], 200)
    want = []
    for r, some in zip(rows, spans):
        b = (r[0] or "").encode()
        kept = b"".join(b[x:y] for x, y in zip([0, *(e for _, e in some)], [*(s for s, _ in some), len(b)]))
        want.append((len(b), sum(e - s for s, e in some), len(some), hashlib.sha256(kept).hexdigest()))
    got = S.without_repeats(docs, 200, "none").select("n_bytes", "n_removed", "n_spans", F.sha2(F.coalesce("kept", F.lit(b"")), 256))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    if which == "odd":
        assert set(docs.columns) < set(S.without_repeats(docs).columns)
        assert S.without_repeats(docs).where("text is null and kept is not null").count() == 0
