"""Operator 9: the law, the mixture, and a plain ranking."""
import zlib
from collections import Counter

import pytest

from acct_health.llm.sharding import interleaved_shards


@pytest.mark.parametrize("per_slice", [4, 512])
@pytest.mark.parametrize("which", ["documents", "odd", "empty"])
def test_shards(request, which, per_slice):
    docs = request.getfixturevalue(which)
    given = docs.select("doc_id", "text", "source").collect()
    rows = interleaved_shards(docs, shards=16, rows_per_slice=per_slice).collect()
    want = Counter((r["doc_id"], r["source"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in given)
    assert Counter((r["doc_id"], r["source"], r["size"], r["text_crc32"]) for r in rows) == want
    counts = Counter(r["shard"] for r in rows)
    if rows:
        every = [counts[s] for s in range(16)]
        assert max(every) - min(every) <= 1
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    # each source is spread evenly: its share of a run of shards is off by a row or two at most
    for source, n in Counter(r["source"] for r in rows).items():
        share = Counter(r["shard"] for r in rows if r["source"] == source)
        assert all(abs(share[s] - n / 16) <= 2.5 for s in range(16)), source


def test_slices_do_not_change_the_order(documents):
    a, b = (sorted((r["shard"], r["slot"], r["doc_id"]) for r in interleaved_shards(documents, rows_per_slice=k).collect()) for k in (3, 1000))
    assert a == b
