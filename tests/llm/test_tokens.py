"""Operators 3, 4 and 5 against the libraries themselves."""
import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from acct_health.llm import bpe, token_binary, token_counts, units
from acct_health.llm.common import scratch

BYTE, MULTI, WORD = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")


def random_texts(n=300, seed=4):
    rng = random.Random(seed)
    alphabet = ["a", "B", "the", "'s", " ", "  ", "\n", "\n ", ".", ",", "é", "ß.", "9", "\t", " ", " ", "你", "😀", "-", "<|endoftext|>", "\r\n", "é"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_pack_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    for n in (0, 1, 255, 256, 257, 900):
        for high in (1, 2, 50_000, 1 << 32):
            ids = rng.integers(0, high, n).astype(np.uint32)
            ids[::50] = high - 1
            payload, starts = token_binary.pack(ids)
            assert (token_binary.unpack(payload, starts) == ids).all()
            assert (token_binary.unpack(payload, starts, n // 3, n // 2) == ids[n // 3:n // 2]).all()


def test_units_concatenate():
    library = Tokenizer.from_file(BYTE)
    texts = random_texts()
    for text, got in zip(texts, token_binary.encoded(texts, BYTE)):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert ["".join(units.segments(t, 5)) for t in texts] == texts


@pytest.mark.parametrize("which", ["documents", "odd", "empty"])
def test_token_binary(spark, request, which):
    docs = request.getfixturevalue(which)
    target = scratch(spark, "test-ids")
    token_binary.write_ids(docs, target, BYTE, 2)
    got = sorted(map(tuple, token_binary.read_ids(spark, target).collect()), key=lambda r: r[1])
    library = Tokenizer.from_file(BYTE)
    rows = [(r["doc_id"], np.array(library.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")) for r in docs.collect()]
    want = sorted((r[0] is not None, r[0] or 0, len(r[1]), zlib.crc32(r[1].tobytes())) for r in rows)
    assert sorted((r[0] is not None, r[0] or 0, r[2], r[3]) for r in got) == want
    ids = [r[0] for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got)])[:-1].tolist() if got else True


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(MULTI, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_coder(library):
    coder = bpe.Coder(MULTI, P.PATTERN)
    texts = random_texts(seed=9) + ["y" * 3000, "ab" * 500]
    ids = coder.encode(texts)
    assert [x.tolist() for x in ids] == [library.encode_ordinary(t) for t in texts]
    assert coder.decode(ids) == [t.encode() for t in texts]
    with pytest.raises(ValueError):
        coder.decode([np.array([10**6], np.int32)])


@pytest.mark.parametrize("which", ["documents", "odd", "empty"])
def test_bpe(request, library, which):
    docs = request.getfixturevalue(which)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for r in docs.collect():
        ids = library.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(ids), sha(",".join(map(str, ids)).encode()), sha((r["text"] or "").encode())))
    assert sorted(map(tuple, bpe.round_trip(docs).collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("which", ["documents", "odd", "empty"])
@pytest.mark.parametrize("chunk,overlap", [(32768, 512), (200, 30)])
def test_token_counts(request, which, chunk, overlap):
    docs = request.getfixturevalue(which)
    library = Tokenizer.from_file(WORD)
    want = [(r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect()]
    got = token_counts.token_counts(docs, WORD, chunk, overlap)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_counts_widen_without_white_space(spark):
    library = Tokenizer.from_file(WORD)
    texts = ["q" * 3000, "ab-" * 700 + " end", " ".join(random_texts(80))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs, WORD, 64, 8).collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_words_are_encoded_together():
    library = token_binary.Library(BYTE)
    words = [f" {a}{b}" for a in ["alpha", "Häuser", "x-1", "你好", "<|endoftext|>", "it's"] for b in range(300)] + random_texts(300)
    asked, whole = [], library.library

    class Counted:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return whole.encode_batch_fast(texts, **options)

    library.library = Counted()
    assert [np.frombuffer(x, "<u4").tolist() for x in library.encode(words)] == [whole.encode(w, add_special_tokens=False).ids for w in words]
    assert len(asked) < 400  # one for all that begin with a space, before one for each


def test_words_are_encoded_alone_where_a_token_goes_over_their_ends(tmp_path):
    whole = Tokenizer.from_file(BYTE)
    whole.add_special_tokens(["one two"])
    whole.save(str(tmp_path / "t.json"))
    library = token_binary.Library(str(tmp_path / "t.json"))
    words = [" one", " two", " three"]
    assert [np.frombuffer(x, "<u4").tolist() for x in library.encode(words)] == [whole.encode(w, add_special_tokens=False).ids for w in words]


def test_queries_of_the_coder_are_small(library, monkeypatch):
    coder, sizes = bpe.Coder(MULTI, P.PATTERN), []
    ask = coder._ask
    monkeypatch.setattr(coder, "_ask", lambda name, rows, query: sizes.append(rows.nbytes) or ask(name, rows, query))
    text = "one two " * 200_000
    ids = coder.encode([text])
    assert ids[0].tolist() == library.encode_ordinary(text) and coder.decode(ids) == [text.encode()]
    assert max(sizes) <= 2 << 20  # 12 bytes a token


def test_a_unit_known_under_another_kind_is_not_encoded_again():
    from acct_health.llm.units import Memory

    asked = []

    def encode(texts):
        asked.extend(texts)
        return [f"<{t}>".encode() for t in texts]

    memory = Memory(encode)
    assert memory.values(["alpha beta gamma"]) == [[b"<alpha>", b"< beta>", b"< gamma>"]]
    assert memory.values(["alpha, beta. gamma\nalpha"]) == [[b"<alpha><,>", b"< beta><.>", b"< gamma><\n><alpha>"]]
    assert len(asked) == len(set(asked))
