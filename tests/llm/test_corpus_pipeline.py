"""The corpus pipeline against a plain run of its stages."""
import base64
import hashlib
import os
import sys

import public_tokenizers as P
import tiktoken

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from acct_health.llm import pii, simhash  # noqa: E402
from acct_health.llm.common import written  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = first = spark.read.parquet(f"{SF}/documents.parquet")
    ids, after = {r["doc_id"]: r["text"] for r in docs.collect()}, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), f"test-{name}")
        after[name] = docs
    assert all(after[n].columns == first.columns for n in ("language", "near_copies", "benchmark", "personal_data"))
    kept = {r["doc_id"]: r["text"] for r in after["personal_data"].collect()}
    assert set(kept) < set(ids)
    # the groups of copies among what was kept first
    low = simhash.simhash_components(after["language"])
    assert {r["doc_id"] for r in after["near_copies"].collect()} == {r[0] for r in low.select("component_id").distinct().collect()}
    assert pii.with_base(after["personal_data"], "text", "s").where("size(s) > 0").count() == 0
    assert after["personal_data"].where("n_chars <> length(text)").count() == 0
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in after["tokens"].collect():
        told = library.encode_ordinary(kept[r["doc_id"]])
        assert r["n_tokens"] == len(told)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, told)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(kept[r["doc_id"]].encode()).hexdigest()
    assert after["tokens"].count() == len(kept)
