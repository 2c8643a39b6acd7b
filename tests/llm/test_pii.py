"""Operator 8: base spans against plain patterns, places, masking, added spans, odd rows."""
import random
import re

import pytest
from pyspark.sql import functions as F

from acct_health.llm import pii


def passes(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


PLAIN = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
         ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and passes(d)),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15)]


def plain(text):
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p, good in PLAIN for m in re.finditer(p, text or "") if good(m.group()))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    made = ["".join(rng.choice("aB1.@-+ %_()09 4é😀") for _ in range(rng.randrange(120))) for _ in range(1500)]
    return made + ["", None, "x@y.com_z@w.com", "4111 1111 1111 1111,4111111111111111", "256.1.1.1 001.002.003.004 0000.1.1.1", "1.2.3.4 " * 300,
                   "+1 (415) 555-2671 and 4111-1111-1111-1111", "My name is John Smith, call (415) 555-2671. Apache License"]


def test_base_spans_and_masks(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = pii.with_spans(docs, pii.train(docs))
    for r in rows.select("doc_id", pii.told(F.col("base_spans")).alias("base"), "spans", pii.masked(F.col("text"), F.col("spans")).alias("masked")).collect():
        text = texts[r["doc_id"]]
        assert r["base"] == plain(text)
        out, at = "", 0
        for s in sorted(r["spans"], key=lambda s: (s["start"], s["end"], s["kind"])):
            out += (text[at:s["start"]] if s["start"] > at else "") + (f"[{s['kind'].upper()}]" if s["start"] >= at else "")
            at = max(at, s["end"])
        assert r["masked"] == (None if text is None else out + text[at:])


def test_long_runs_are_linear(spark):
    long = ["1" * 50000, "a." * 50000, "a" * 50000 + "@b.c", "1 " * 50000, "+1" + "(" * 50000, "1." * 20000]
    docs = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string").repartition(3)
    rows = {r["doc_id"]: r["base"] for r in pii.with_base(docs, "text", "s").select("doc_id", pii.told(F.col("s")).alias("base")).collect()}
    assert rows[2] == "email:0:50004" and rows[0] == rows[1] == rows[3] == rows[4] == ""
    assert rows[5] == ",".join(f"ip:{i}:{i + 7}" for i in range(0, 40000, 8))


def test_added_spans(spark):
    people = [f"My name is {n} Smith{i} and I live here." for i in range(6) for n in ("John", "Mary", "Peter")]
    people = [re.sub(r"Smith(\d)", lambda m: "Smith" + "abcdef"[int(m[1])], p) for p in people]
    texts = people + ["The Apache License applies. The Red House stands. Old Town is far."] * 20 + ["mail bob (at) site (dot) com now"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r["s"] for r in pii.with_spans(docs, pii.train(docs)).select("doc_id", pii.told(F.col("spans")).alias("s")).collect()}
    assert all(rows[i].startswith("person:11:") for i in range(len(people)))
    assert all(rows[i] == "" for i in range(len(people), len(people) + 20))


def test_reliabilities_follow_the_votes(spark):
    votes = [("k", [2, 1, 2, 2], 90.0), ("k", [0, 1, 0, 0], 100.0), ("k", [2, 1, 0, 2], 10.0), ("k", [0, 1, 2, 0], 5.0)]
    rows = pii.reliabilities(spark.createDataFrame(votes, "kind string, votes array<int>, n double"))
    theta = rows.collect()[0]["theta"]
    assert 0.4 < theta[0] < 0.6
    good, fair = theta[1 + 4 + 1], theta[1 + 12 + 4 + 1]  # how often labelers 0 and 2 vote for a true one
    assert good > 0.9 and good > fair
    # the same by plain code
    t = [0.5] + [x for _ in range(4) for x in (0.7, 0.1, 0.2, 0.2, 0.1, 0.7)]
    for _ in range(pii.ROUNDS):
        q = []
        for _, v, n in votes:
            like = [t[0] if y else 1 - t[0] for y in (0, 1)]
            for y in (0, 1):
                for j in range(4):
                    like[y] *= t[1 + 6 * j + 2 * v[j] + y]
            q.append(like[1] / sum(like))
        total, true = sum(n for *_, n in votes), sum(n * p for (*_, n), p in zip(votes, q))
        new = [(true + 1) / (total + 2)]
        for j in range(4):
            for v in range(3):
                for y in (0, 1):
                    s = sum(n * (p if y else 1 - p) for (_, vs, n), p in zip(votes, q) if vs[j] == v)
                    new.append((s + 1) / ((true if y else total - true) + 3))
        t = new
    assert theta == pytest.approx(t)


def test_odd(odd, empty):
    out = pii.mask_documents(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert sorted(map(str, out.collect())) == sorted(map(str, odd.collect()))
    assert pii.mask_documents(empty).count() == 0
    plan = pii.with_spans(odd, pii.train(odd))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
