"""Byte-level BPE encoding and decoding by recursive DuckDB queries in each partition (operator 4).

Encoding: the pieces of a text's pre-tokenisation become lists of byte tokens. A recursive query
lays the neighbouring tokens of every unfinished piece out as rows with their position, joins
them to the merge table, and contracts each piece's pair of the smallest rank, the leftmost if
it occurs more than once; a piece without a joined pair has reached its fixpoint. The merge table
holds every split of a vocabulary entry into two entries, so a pair's rank is that of its
concatenation, as in the rank files' own definition.

Decoding: token-position rows join the vocabulary and an ordered aggregation puts the bytes
together.

DuckDB runs inside the Python workers, in memory and on one thread, over a bounded number of
pieces or tokens at a time. Spark deals the documents. Repeated pieces are contracted once, as far
as a bounded memory of earlier ones goes.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acct_health.llm.common import map_arrow, only_memory_of, read_table
from acct_health.llm.units import Memory, grouped

PIECE_BYTES = 1 << 18  # bytes of pieces in one query
DECODE_TOKENS = 1 << 16  # tokens in one query
GROUP = 1 << 20  # characters whose new units are contracted together
REMEMBERED = 1_500_000  # units that a worker keeps, some 200 bytes each
ROWS = 2048  # documents encoded or decoded together

# The state keeps the last tokens of each piece. best: a piece's smallest rank, then position, as rank * 2**32 + position.
CONTRACT = """
WITH RECURSIVE state(piece, tokens) USING KEY (piece) AS (
    SELECT piece, tokens FROM pieces
    UNION
    SELECT s.piece, list_concat(list_append(s.tokens[:(b.best % 4294967296 - 1)], (b.best // 4294967296)::INTEGER), s.tokens[(b.best % 4294967296 + 2):])
    FROM state s JOIN (
        SELECT p.piece, min(m.merged::BIGINT * 4294967296 + p.pos) AS best
        FROM (
            SELECT piece, unnest(tokens[:-2])::BIGINT * 4294967296 + unnest(tokens[2:]) AS pair, generate_subscripts(tokens[2:], 1) AS pos
            FROM state WHERE len(tokens) > 1
        ) p JOIN merges m USING (pair)
        GROUP BY p.piece
    ) b USING (piece)
)
SELECT tokens FROM state ORDER BY piece
"""

JOIN_BYTES = """
SELECT string_agg(v.hex, '' ORDER BY t.pos) AS hex
FROM tokens t JOIN vocabulary v USING (id) GROUP BY t.doc ORDER BY t.doc
"""


class Coder:
    """A rank file, its pattern and a DuckDB connection of one Python worker."""

    def __init__(self, path: str, pattern: str, remembered: int = REMEMBERED):
        import duckdb
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.find = regex.compile(pattern).findall
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        # nothing goes to a folder of the worker's machine: what is asked at once is bounded
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "500MB", "temp_directory": ""})
        ranks = self.ranks
        splits = np.array([(ranks[k[:i]], ranks[k[i:]], m) for k, m in ranks.items() for i in range(1, len(k))
                           if k[:i] in ranks and k[i:] in ranks], np.int32).reshape(-1, 3)
        self._table("merges", pa.table({"pair": splits[:, 0].astype(np.int64) << 32 | splits[:, 1], "merged": splits[:, 2]}))
        self._table("vocabulary", pa.table({"id": pa.array(ranks.values(), pa.int32()), "hex": [k.hex() for k in ranks]}))
        self.known = np.zeros(max(ranks.values()) + 1, bool)
        self.known[list(ranks.values())] = True
        self.memory = Memory(self._units, remembered)
        self.figures = list(map(str, range(len(self.known))))

    def _table(self, name: str, rows: pa.Table) -> None:
        self.db.register("given", rows)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _ask(self, name: str, rows: pa.Table, query: str) -> pa.Table:
        self.db.register(name, rows)
        try:
            return self.db.sql(query).to_arrow_table()
        finally:
            self.db.unregister(name)

    def contract(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as little-endian 32-bit integers."""
        out: list[bytes] = []
        at = 0
        while at < len(pieces):
            end, size = at, 0
            while end < len(pieces) and (end == at or size + len(pieces[end]) <= PIECE_BYTES):
                size, end = size + len(pieces[end]), end + 1
            part = pieces[at:end]
            ends = np.cumsum([0, *map(len, part)])
            tokens = self.bytes[np.frombuffer(b"".join(part), np.uint8)]
            rows = pa.table({"piece": np.arange(len(part)),
                             "tokens": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens, pa.int32()))})
            lists = self._ask("pieces", rows, CONTRACT).column("tokens").combine_chunks()
            raw = lists.flatten().to_numpy(zero_copy_only=False).astype("<i4").tobytes()
            bounds = (4 * (lists.offsets.to_numpy() - lists.offsets[0].as_py())).tolist()
            out += [raw[a:b] for a, b in zip(bounds, bounds[1:])]
            at = end
        return out

    def _units(self, texts: list[str]) -> list[bytes]:
        split = [self.find(t) for t in texts]
        ids, new = {}, []
        for p in set().union(*split):
            # a piece that is an entry itself is that entry, as the library has it
            rank = self.ranks.get(p.encode())
            value = self.memory.known(p) if rank is None else rank.to_bytes(4, "little")
            # what was kept is that of the text alone, which must be this piece alone
            if value is None or rank is None and self.find(p) != [p]:
                new.append(p)
            else:
                ids[p] = value
        ids.update(zip(new, self.contract([p.encode() for p in new])))
        return [b"".join(map(ids.__getitem__, ps)) for ps in split]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as the library's ``encode_ordinary``."""
        parts: list[list[bytes]] = [[] for _ in texts]
        for group in grouped(texts, GROUP):
            for (i, _), values in zip(group, self.memory.values([t for _, t in group])):
                parts[i].append(b"".join(values))
        return [np.frombuffer(b"".join(p), "<i4") for p in parts]

    def decimal(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by commas."""
        return ",".join(map(self.figures.__getitem__, ids.tolist())).encode()

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each list of ids; an id that the vocabulary lacks is an error."""
        out: list[list[bytes]] = [[] for _ in ids]
        held: list[tuple[int, np.ndarray]] = []
        size = 0
        for i, x in enumerate(ids):
            if len(x) and not (x.min() >= 0 and x.max() < len(self.known) and self.known[x].all()):
                raise ValueError("an id is not in the vocabulary")
            for at in range(0, len(x), DECODE_TOKENS):
                held.append((i, x[at:at + DECODE_TOKENS]))
                size += len(held[-1][1])
                if size >= DECODE_TOKENS:
                    self._join(held, out)
                    held, size = [], 0
        if held:
            self._join(held, out)
        return [b"".join(x) for x in out]

    def _join(self, held: list[tuple[int, np.ndarray]], out: list[list[bytes]]) -> None:
        rows = pa.table({"doc": np.repeat(np.arange(len(held), dtype=np.int32), [len(x) for _, x in held]),
                         "pos": np.concatenate([np.arange(len(x), dtype=np.int32) for _, x in held]),
                         "id": np.concatenate([x for _, x in held])})
        got = self._ask("tokens", rows, JOIN_BYTES).column("hex").to_pylist()
        for (i, _), h in zip(held, got, strict=True):
            out[i].append(bytes.fromhex(h))


_CODERS: dict[tuple[str, str, int], Coder] = {}


def coder(path: str, pattern: str, remembered: int = REMEMBERED) -> Coder:
    """The worker's coder, made once."""
    only_memory_of("bpe", _CODERS.clear)
    key = (path, pattern, remembered)
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(*key)
    return _CODERS[key]


def encode_documents(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row of ``docs``; null text is empty and has no ids, an
    empty table no rows; rows that repeat are encoded like any other. Further columns are not
    looked at."""
    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids = coder(path, pattern).encode([t or "" for t in part.column(1).to_pylist()])
                ends = np.cumsum([0, *map(len, ids)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
                yield pa.record_batch([part.column(0), lists], names=["doc_id", "ids"])

    return map_arrow(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), work,
                     "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded binary) of (doc_id, ids) rows; null ids are empty."""
    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                lists = part.column(1)
                ids = [np.zeros(0, np.int32) if not x.is_valid else x.values.to_numpy(zero_copy_only=False) for x in lists]
                told = [hashlib.sha256(coder(path, pattern).decimal(x)).hexdigest() for x in ids]
                yield pa.record_batch([part.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array(told),
                                       pa.array(coder(path, pattern).decode(ids), pa.binary())],
                                      names=["doc_id", "n_tokens", "ids_sha256", "decoded"])

    return map_arrow(encoded.select("doc_id", "ids"), work, "doc_id long, n_tokens long, ids_sha256 string, decoded binary")


def round_trip_documents(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text",
                         remembered: int = REMEMBERED) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of ``docs``: as ``decode_documents`` of ``encode_documents``, but in one pass, so that
    a worker holds one set of tables and ids go from the encoder to the decoder in its memory. Same results for nulls and the like. ``remembered``: how many units a worker keeps, a matter of
    speed and memory."""
    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part, coded = batch.slice(at, ROWS), coder(path, pattern, remembered)
                n, ids, data = [], [], []
                for group in _few(part.column(1).to_pylist()):
                    some = coded.encode(group)
                    n += map(len, some)
                    ids += [hashlib.sha256(coded.decimal(x)).hexdigest() for x in some]
                    data += [hashlib.sha256(x).hexdigest() for x in coded.decode(some)]
                yield pa.record_batch([part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(data, pa.string())],
                                      names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_arrow(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), work,
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _few(texts: list[str | None]) -> Iterator[list[str]]:
    """Texts (null: empty) in groups of about GROUP characters."""
    held, size = [], 0
    for t in texts:
        held.append(t or "")
        size += len(held[-1])
        if size >= GROUP:
            yield held
            held, size = [], 0
    if held:
        yield held


def round_trip(docs: DataFrame, remembered: int = REMEMBERED) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document, by byte_bpe_multi_50k."""
    import public_tokenizers

    return round_trip_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, remembered=remembered)


def op4_bpe(spark, sf_dir: str) -> DataFrame:
    """All documents, encoded and decoded."""
    return round_trip(read_table(spark, sf_dir, "documents"))
