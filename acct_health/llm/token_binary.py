"""Token ids in a compact binary file format (operator 3): patched frame-of-reference blocks.

Rows are dealt by ranges of doc_id, each range is encoded in order and cut into segments,
and a segment is one row of a Parquet table: Spark's own writer commits it, in whatever store
``spark.checkpoint.dir`` names, and a lost task is done again from the start.

A segment's payload is a run of blocks of up to 256 ids. A block, little-endian:
    u32 minimum, u16 ids, u8 width, u16 exceptions,
    (id - minimum) modulo 2**width of each id, width bits each, lowest bit first, padded to a byte,
    u16 position of each exception, u32 (id - minimum) of each exception.
The width is the smallest that holds ``PERCENTILE`` of the block's values; those it doesn't
hold are the exceptions. ``block_starts`` is the index: the byte at which each block begins, so
any run of ids is read without the blocks before it.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acct_health.llm.common import map_arrow, read_table, running_before, scratch
from acct_health.llm.units import Memory, grouped

BLOCK = 256
PERCENTILE = 0.9
HEAD = struct.Struct("<IHBH")
SEGMENT_IDS = 1 << 16
REMEMBERED = 1_200_000  # units and their parts that a worker keeps
JOINS = re.compile(r" \S(?:.*\S)?\Z", re.DOTALL)  # texts in a row of which each is a unit

FILE_SCHEMA = ("part int, segment long, ids long, payload binary, block_starts array<long>, "
               "doc_ids array<long>, doc_tokens array<long>")


def pack(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Payload and block starts of an array of unsigned 32-bit ids."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    sizes = np.full(blocks, BLOCK)
    if n % BLOCK:
        sizes[-1] = n % BLOCK
    padded = np.zeros(blocks * BLOCK, np.int64)
    padded[:n] = ids
    if blocks:
        padded[n:] = padded[(blocks - 1) * BLOCK:n].min(initial=1 << 32)
    padded = padded.reshape(blocks, BLOCK)
    low = padded.min(axis=1, keepdims=True) if blocks else padded[:, :1]
    offset = padded - low
    lengths = np.frexp(offset.astype(np.float64))[1].astype(np.int8)
    ordered = np.sort(np.where(np.arange(BLOCK) < sizes[:, None], lengths, np.int8(99)), axis=1)
    width = ordered[np.arange(blocks), np.ceil(sizes * PERCENTILE).astype(int) - 1] if blocks else np.zeros(0, int)
    bodies: list[bytes] = [b""] * blocks
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        kind = np.dtype("<u2" if w <= 16 else "<u4")
        bits = np.unpackbits(offset[at].astype(kind).view(np.uint8).reshape(-1), bitorder="little")
        bits = bits.reshape(len(at), BLOCK, 8 * kind.itemsize)[:, :, :w].reshape(len(at), BLOCK * w)
        for i, row in zip(at.tolist(), np.packbits(bits, axis=1, bitorder="little")):
            bodies[i] = row[:-(-int(sizes[i]) * w // 8)].tobytes()
    out, starts, at = [], np.zeros(blocks, np.int64), 0
    large = lengths > width[:, None]
    for i in range(blocks):
        odd = np.flatnonzero(large[i, :sizes[i]])
        block = (HEAD.pack(int(low[i, 0]), int(sizes[i]), int(width[i]), len(odd)) + bodies[i]
                 + odd.astype("<u2").tobytes() + offset[i, odd].astype("<u4").tobytes())
        starts[i], at = at, at + len(block)
        out.append(block)
    return b"".join(out), starts


def unpack(payload: bytes, starts: np.ndarray, first: int = 0, end: int | None = None) -> np.ndarray:
    """The ids numbered ``first`` up to ``end`` of a payload; only the blocks that hold them are read."""
    if not len(starts):
        return np.zeros(0, np.uint32)
    lowest = first // BLOCK
    chosen = range(lowest, len(starts) if end is None else min(len(starts), -(-end // BLOCK)))
    heads = [HEAD.unpack_from(payload, int(starts[i])) for i in chosen]
    values = np.zeros((len(heads), BLOCK), np.int64)
    by_width: dict[int, list[int]] = {}
    for k, (_, n, w, _) in enumerate(heads):
        by_width.setdefault(w, []).append(k)
    for w, ks in by_width.items():
        if not w:
            continue
        packed = np.zeros((len(ks), BLOCK * w // 8), np.uint8)
        for j, k in enumerate(ks):
            size = -(-heads[k][1] * w // 8)
            packed[j, :size] = np.frombuffer(payload, np.uint8, size, int(starts[chosen[k]]) + HEAD.size)
        bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(ks), BLOCK, w)
        kind = np.dtype("<u2" if w <= 16 else "<u4")
        whole = np.zeros((len(ks), BLOCK, 8 * kind.itemsize), np.uint8)
        whole[:, :, :w] = bits
        values[ks] = np.packbits(whole.reshape(-1), bitorder="little").view(kind).reshape(len(ks), BLOCK)
    for k, (low, n, w, odd) in enumerate(heads):
        if odd:
            at = int(starts[chosen[k]]) + HEAD.size + -(-n * w // 8)
            values[k, np.frombuffer(payload, "<u2", odd, at)] = np.frombuffer(payload, "<u4", odd, at + 2 * odd)
        values[k] += low
    flat = values.reshape(-1)
    ids = flat[:(len(heads) - 1) * BLOCK + heads[-1][1]] if heads else flat
    return ids[first - lowest * BLOCK:None if end is None else end - lowest * BLOCK].astype(np.uint32)


_MEMORY: dict[str, Memory] = {}  # of this Python worker


class Library:
    """The tokenizers library's ids of parts of texts, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker for each core already
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.lengths = None  # UTF-8 bytes that each id stands for, where the vocabulary tells them
        if self.library.normalizer is None and self.library.model.__class__.__name__ == "BPE":
            vocabulary, added = self.library.get_vocab(with_added_tokens=False), self.library.get_added_tokens_decoder()
            if set("".join(vocabulary)) <= set(pre_tokenizers.ByteLevel.alphabet()).union(*[t.content for t in added.values()]):
                self.lengths = np.zeros(1 + max([*vocabulary.values(), *added]), np.int64)
                self.lengths[list(vocabulary.values())] = list(map(len, vocabulary))
                for i, token in added.items():
                    self.lengths[i] = len(token.content.encode())

    def alone(self, texts: list[str]) -> list[bytes]:
        """Each text by itself."""
        ids = [array("I", e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        if sys.byteorder == "big":
            for x in ids:
                x.byteswap()
        return [x.tobytes() for x in ids]

    def together(self, texts: list[str]) -> list[bytes]:
        """Texts that each begin at a unit boundary, as one; the ids are dealt by the bytes that they stand for. Should a token
        go over a boundary after all, each text by itself."""
        ids = np.array(self.library.encode_batch_fast(["".join(texts)], add_special_tokens=False)[0].ids, "<u4")
        ends, wanted = np.cumsum(self.lengths[ids]), np.cumsum([len(t.encode()) for t in texts])
        at = np.searchsorted(ends, wanted)
        if not len(ends) or ends[-1] != wanted[-1] or (ends[at] != wanted).any():
            return self.alone(texts)
        raw, bounds = ids.tobytes(), (4 * (at + 1)).tolist()
        return [raw[a:b] for a, b in zip([0, *bounds], bounds)]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        joins = [i for i, t in enumerate(texts) if JOINS.match(t)] if self.lengths is not None else []
        rest = sorted(set(range(len(texts))).difference(joins))
        for which, by in ((joins, self.together), (rest, self.alone)):
            for at in range(0, len(which), 8192):
                some = which[at:at + 8192]
                for i, x in zip(some, by([texts[i] for i in some])):
                    out[i] = x
        return out


def tokenizers_memory(path: str) -> Memory:
    """Unit -> its ids as little-endian unsigned 32-bit integers, by the tokenizers library."""
    if path not in _MEMORY:
        _MEMORY[path] = Memory(Library(path).encode, REMEMBERED)
    return _MEMORY[path]


def encoded(texts: list[str], path: str) -> list[bytes]:
    memory, out = tokenizers_memory(path), [[] for _ in texts]
    for group in grouped(texts):
        for (i, _), values in zip(group, memory.values([t for _, t in group])):
            out[i] += values
    return [b"".join(x) for x in out]


def write_ids(docs: DataFrame, target: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Encode every text (null: empty) with the tokenizers library, append ``end_id`` and write the
    ids of all documents in ascending ``key`` order (null first, rows that repeat in a row).
    Special strings in texts are handled as the library does by default. An empty table gives
    a table without segments. Further columns are not looked at."""
    tail = np.array([end_id], "<u4").tobytes()

    def work(batches):
        part, segment = TaskContext.get().partitionId(), 0
        keys, parts, held = [], [], 0

        def row():
            sizes = [len(p) // 4 for p in parts]
            payload, starts = pack(np.frombuffer(b"".join(parts), "<u4"))
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([segment], pa.int64()), pa.array([sum(sizes)], pa.int64()),
                                    pa.array([payload], pa.binary()), pa.array([starts], pa.list_(pa.int64())),
                                    pa.array([keys], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64()))],
                                   names=["part", "segment", "ids", "payload", "block_starts", "doc_ids", "doc_tokens"])

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for at in range(0, len(ids), 256):
                group = [t or "" for t in texts[at:at + 256].to_pylist()]
                for k, got in zip(ids[at:at + 256], encoded(group, tokenizer)):
                    keys.append(k)
                    parts.append(got + tail)
                    held += len(got) // 4 + 1
                    if held >= SEGMENT_IDS:
                        yield row()
                        keys, parts, held, segment = [], [], 0, segment + 1
        if keys:
            yield row()

    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, "doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    map_arrow(ranged, work, FILE_SCHEMA).write.parquet(target)


def read_ids(spark, target: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents of a written table, from its files."""
    files = spark.read.parquet(target)

    def work(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids = unpack(r["payload"], np.array(r["block_starts"], np.int64)).astype("<u4").tobytes()
                ends = np.cumsum(r["doc_tokens"])
                begins = ends - r["doc_tokens"]
                crcs = [zlib.crc32(ids[4 * b:4 * e]) for b, e in zip(begins.tolist(), ends.tolist())]
                n = len(crcs)
                yield pa.record_batch([pa.array([r["part"]] * n, pa.int32()), pa.array([r["segment"]] * n, pa.int64()),
                                       pa.array(r["doc_ids"], pa.int64()), pa.array(begins, pa.int64()),
                                       pa.array(r["doc_tokens"], pa.int64()), pa.array(crcs, pa.int64())],
                                      names=["part", "segment", "doc_id", "inside", "n_tokens", "ids_crc32"])

    docs = map_arrow(files.select("part", "segment", "payload", "block_starts", "doc_ids", "doc_tokens"), work,
                     "part int, segment long, doc_id long, inside long, n_tokens long, ids_crc32 long")
    index = files.select("part", "segment", "ids")
    within = running_before(index, ["part"], "segment", "ids", "in_part")
    parts = index.groupBy("part").agg(F.sum("ids").alias("ids")).withColumn("all", F.lit(0))
    parts = running_before(parts, ["all"], "part", "ids", "ahead").select("part", "ahead")
    base = within.join(parts, "part").select("part", "segment", (F.col("in_part") + F.col("ahead")).alias("base"))
    return docs.join(base, ["part", "segment"]).select("doc_id", (F.col("base") + F.col("inside")).alias("start"),
                                                       "n_tokens", "ids_crc32")


def op3_token_binary(spark, sf_dir: str) -> DataFrame:
    """All documents by byte_bpe_50k.json, each followed by id 2, written and read back."""
    import public_tokenizers

    target = scratch(spark, "token-ids")
    write_ids(read_table(spark, sf_dir, "documents"), target, public_tokenizers.path("byte_bpe_50k.json"), 2)
    return read_ids(spark, target)
