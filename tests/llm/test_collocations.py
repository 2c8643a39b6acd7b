"""Operator 12 against brute force."""
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from acct_health.llm import collocations as C
from acct_health.llm import scan

LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def pieces(text):
    for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        w = re.findall(r"[^\x20\x09]+", p)
        if w:
            yield w


def plain(rows, least, top, longest=5):
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            total[lang] += len(w)
            counts.update((lang, tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    often = {k: n for k, n in counts.items() if n >= least}
    out = []
    for (lang, p), a in often.items():
        if len(p) < 2:
            continue
        if any(x == lang and len(q) > len(p) and n >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for (x, q), n in often.items()):
            continue
        n = total[lang]
        score, k = min((1000 * a * n // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p)))
        out.append((lang, -score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]], n))
    ranked = []
    for lang in total:
        some = sorted(x for x in out if x[0] == lang)[:top]
        ranked += [(lang, i + 1, x[3].decode(), -x[2], x[4], x[5], x[6], -x[1]) for i, x in enumerate(some)]
    return sorted(ranked)


def made_up(seed, n=80):
    r = random.Random(seed)
    words = ["the", "The", "of", "é", "你好", "cat", "dog", "x", "same", "again"]
    text = lambda: "".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "; "]) for _ in range(r.randint(0, 40)))
    passage = "one two three four five six seven eight nine ten"
    rows = [(r.choice(["en", "de", None, "und"]), r.choice([text(), text() + " " + passage + " " + text(), passage + ".", ""])) for _ in range(n)]
    return [*rows, ("en", None), (None, None), ("fr", ""), ("en", "loop " * 50), ("en", "a b " * 30)]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("bits", [C.BITS, 7])
def test_ranking(spark, seed, bits):
    rows = made_up(seed)
    docs = spark.createDataFrame([(i, *x, "y") for i, x in enumerate(rows)], "doc_id long, lang string, text string, phrase string").repartition(3)
    got = C.collocations(docs, least=4 + seed, top=50, bits=bits).collect()
    assert sorted(map(tuple, got)) == plain(rows, 4 + seed, 50)


@pytest.mark.parametrize("which", ["documents", "odd", "empty"])
def test_operator(request, which):
    docs = request.getfixturevalue(which)
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    least = 25 if which == "documents" else 2
    assert sorted(map(tuple, C.collocations(docs, least=least, top=300).collect())) == plain(rows, least, 300)


def test_long_texts_in_parts(spark, monkeypatch):
    r = random.Random(2)
    texts = [" ".join(r.choices(["aa", "b", "ccc", "d e f g h"], k=2000)), "x y. z, " * 400, "w" * 3000, "q" * 500 + " r " + "s" * 900]
    data, starts, ends = scan.flat(pa.array(texts))
    for limit in (64, 1 << 20):
        parts = list(C.words_of(data, starts, ends, limit))
        words = [p.data[s:e].tobytes().decode() for p in parts for s, e in zip(p.begin[p.fresh:], p.end[p.fresh:])]
        assert words == [w for t in texts for p in pieces(t) for w in p]
        assert any(p.cut for p in parts) == (limit == 64)
    # all edges and ends of runs, whatever the cut
    want, whole = None, None
    for limit in (1 << 20, 64, 100):
        got = Counter()
        hashes = scan.SpanHash()
        for p in C.words_of(data, starts, ends, limit):
            h1, h2 = hashes(p.data, p.begin, p.end)
            some, tails = C.paths(p, h1, h2, p.joined[1:], 5)
            text = p.data.tobytes()
            for first, last, n, stops in some:
                w = C._phrase(text, p.begin, p.end, first, last).split()
                if stops:
                    got["end", *w[-4:]] += stops
                for i in range(len(w) - 4):
                    got[tuple(w[i:i + 5])] += n
            for first, last, n in tails:
                got["end", *C._phrase(text, p.begin, p.end, first, last).split()] += n
        whole = got if want is None else whole
        want = want or got
        assert got == whole


def test_paths_are_compacted():
    data, starts, ends = scan.flat(pa.array(["one two three four five six seven eight nine ten. " * 3]))
    (p,) = C.words_of(data, starts, ends)
    some, tails = C.paths(p, *scan.SpanHash()(p.data, p.begin, p.end), p.joined[1:], 5)
    assert [(last - first + 1, n, stops) for first, last, n, stops in some] == [(10, 3, 3)] and not tails
    assert np.array_equal(p.joined[:10], [False] + [True] * 9)
