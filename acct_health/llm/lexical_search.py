"""Ranked lexical search in K2-treaps over the grid of terms and documents (operator 13).

The documents are indexed in blocks, a row of the written index each: the block's terms, how many of its documents hold each,
and a K2-treap. That is a quadtree over the grid (a row for each term, a column for each document) without its empty
quadrants, whose cells store the greatest impact of a term in a document that lies below. It is kept
as four bits a cell (which quadrants are not empty; children are found by counting bits) and the difference of each cell's
maximum to that of the cell above. Terms that many documents of the block hold come first, so full cells lie together.

A search takes the paths of all rows of an item at once. A range of documents has a cell on the path of each of the item's terms,
and the sum of their maxima by weight bounds the score of each document in it. The ranges of the greatest bounds are
halved first, some at once, until no bound reaches the item's k-th best score so far, which goes from block to block of a task.
At single documents the bound is the score, so the ranking is exact.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acct_health.llm.common import at_most, discard, map_arrow, read_table, written
from acct_health.llm.scan import CHUNK, SpanHash, cut_ranges, flat, groups, row_ranges

BLOCK_DOCS, BLOCK_BYTES = 2048, 4 << 20
TOP = 20
WIDTH = 32  # ranges that are halved at once
QUERY_BYTES, QUERY_ITEMS = 1 << 20, 1000  # items that are searched for in one pass over the index
INDEX_ROWS, FILE_ROWS = 2, 16  # rows of the index, some MB each, that go to a Python worker at once; that stand in a file of it

# How much a task holds at once, in Spark's Parquet reader and on the way to Python, whatever the session's settings and the size of files:
# some thousands of rows are the default, which is all rows of the index that a task reads.
OF_TEXTS = {"spark.sql.parquet.columnarReaderBatchSize": 512, "spark.sql.execution.arrow.maxBytesPerBatch": 1 << 24}
OF_INDEX = {"spark.sql.parquet.columnarReaderBatchSize": INDEX_ROWS, "spark.sql.execution.arrow.maxRecordsPerBatch": INDEX_ROWS,
            "spark.sql.files.maxPartitionBytes": 1 << 24}

# bytes of terms: digits, letters and all that is not ASCII
IN_TERM = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


# terms

def term_places(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the terms of rows that follow each other in ``data`` start and end."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = IN_TERM[data]
    before, after = inside[:-2].copy(), inside[2:].copy()
    before[starts[starts < len(data)]] = False
    after[ends[ends > 0] - 1] = False
    return np.flatnonzero(inside[1:-1] & ~before), np.flatnonzero(inside[1:-1] & ~after) + 1


def _chunks(data, starts, ends):
    """(first row, last row, start, end): pieces of about CHUNK bytes, of whole rows or of a part of a long one, cut behind a term."""
    for a, b in row_ranges(starts, ends, CHUNK):
        if b - a == 1:
            for s, e in cut_ranges(data, int(starts[a]), int(ends[a]), ~IN_TERM, CHUNK):
                yield a, b, s, e
        else:
            yield a, b, int(starts[a]), int(ends[b - 1])


def _terms_of(data, starts, ends, a, b, s, e):
    part = LOWER[data[s:e]]
    begin, end = term_places(part, np.maximum(starts[a:b], s) - s, np.minimum(ends[a:b], e) - s)
    return part, begin, end, a + np.searchsorted(ends[a:b], s + begin, "right")


def postings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: SpanHash) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(terms, term number, row, tf) of the rows' terms; ``starts`` and ``ends`` are those of the rows in ``data``."""
    names: dict[bytes, int] = {}
    found = []
    for a, b, s, e in _chunks(data, starts, ends):
        part, begin, end, row = _terms_of(data, starts, ends, a, b, s, e)
        if not len(begin):
            continue
        order, first = groups(*hashes(part, begin, end))
        term = np.empty(len(order), np.int64)
        term[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        key, tf = np.unique(term * len(starts) + row, return_counts=True)
        some, whole = order[first], part.tobytes()
        number = np.array([names.setdefault(whole[x:y], len(names)) for x, y in zip(begin[some].tolist(), end[some].tolist())])
        found.append(np.stack([number[key // len(starts)] * len(starts) + key % len(starts), tf]))
    if not found:
        return [], *[np.zeros(0, np.int64)] * 3
    key, tf = np.concatenate(found, axis=1)
    if len(found) > 1:
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
        key, tf = key[new], np.add.reduceat(tf[order], new)
    return list(names), key // len(starts), key % len(starts), tf


# the treap

_HAS = (np.arange(16)[:, None] >> np.arange(4) & 1).astype(bool)
_RANK = np.array([[(n & (1 << i) - 1).bit_count() for i in range(4)] for n in range(16)])


@dataclass
class K2Treap:
    """Cells of all levels, root first. child: number of a cell's first child; the last cell is the empty one."""

    row_bits: int
    col_bits: int
    quadrants: np.ndarray
    child: np.ndarray
    most: np.ndarray

    @staticmethod
    def packed(row: np.ndarray, col: np.ndarray, value: np.ndarray) -> dict:
        """The stored form of the treap of ``value`` at distinct (row, col): row_bits, col_bits, sizes of the levels, quadrants, drops."""
        r, c = (int(x.max()).bit_length() for x in (row, col))
        code, low = np.zeros(len(row), np.int64), min(r, c)
        for i in range(low):
            code |= (col >> i & 1) << 2 * i | (row >> i & 1) << 2 * i + 1
        code |= (row >> low) << 2 * low | (col >> low) << 2 * low  # one of both is 0
        order = np.argsort(code)
        code, most = code[order], value[order]
        masks, drops, sizes = [], [], [len(code)]
        for level in range(max(r, c)):
            shift = 2 if level < low else 1
            up = code >> shift
            new = np.concatenate([[0], np.flatnonzero(up[1:] != up[:-1]) + 1])
            masks.append(np.bitwise_or.reduceat(1 << (code & (1 << shift) - 1), new).astype(np.uint8))
            greatest = np.maximum.reduceat(most, new)
            drops.append(np.repeat(greatest, np.diff(np.append(new, len(code)))) - most)
            code, most = up[new], greatest
            sizes.append(len(code))
        quadrants = np.concatenate([np.zeros(0, np.uint8), *masks[::-1]])
        quadrants = np.append(quadrants, np.zeros(len(quadrants) % 2, np.uint8))
        return {"row_bits": r, "col_bits": c, "sizes": sizes[::-1], "quadrants": (quadrants[::2] | quadrants[1::2] << 4).tobytes(),
                "drops": np.concatenate([most, *drops[::-1]]).astype(np.int32).tobytes()}

    @classmethod
    def unpacked(cls, row_bits: int, col_bits: int, sizes: list[int], quadrants: bytes, drops: bytes) -> K2Treap:
        pairs, cells = np.frombuffer(quadrants, np.uint8), sum(sizes)
        masks = np.zeros(cells + 1, np.uint8)
        inner = cells - sizes[-1]
        masks[:inner] = np.stack([pairs & 15, pairs >> 4], axis=1).ravel()[:inner]
        count = np.bitwise_count(masks).astype(np.int64)
        child = 1 + np.cumsum(count) - count  # children stand level by level in the order of their parents
        drop, most, at = np.frombuffer(drops, np.int32).astype(np.int64), np.zeros(cells + 1, np.int64), 1
        most[0] = drop[0]
        for above, size in zip(sizes, sizes[1:]):
            most[at:at + size] = np.repeat(most[at - above:at], count[at - above:at]) - drop[at:at + size]
            at += size
        return cls(row_bits, col_bits, masks, child, most)

    def step(self, cells: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """The child cells in the quadrants; the empty cell where there is none."""
        mask = self.quadrants[cells]
        return np.where(_HAS[mask, quadrant], self.child[cells] + _RANK[mask, quadrant], len(self.most) - 1)

    def search(self, rows: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Offer ``best`` the columns with the greatest sums of weight times value over ``rows``, all that may be among its own."""
        cells, depth = np.zeros((1, len(rows)), np.int64), max(self.row_bits, self.col_bits)
        low = min(self.row_bits, self.col_bits)
        if self.row_bits > self.col_bits:  # rows alone are halved first
            for i in range(self.row_bits - 1, low - 1, -1):
                cells = self.step(cells, rows >> i & 1)
        level, col = np.array([depth - low if self.row_bits > self.col_bits else 0]), np.zeros(1, np.int64)
        bound = self.most[cells] @ weights
        if level[0] == depth:  # one document
            best.offer(bound[bound >= best.least], col)
            return
        while True:
            open_ = np.flatnonzero(bound >= best.least)
            if not len(open_):
                return
            taken = np.zeros(len(bound), bool)
            taken[open_ if len(open_) <= WIDTH else open_[np.argpartition(bound[open_], len(open_) - WIDTH)[-WIDTH:]]] = True
            some, rest = np.flatnonzero(taken), open_[~taken[open_]]
            i = depth - 1 - level[some]
            bit = np.where((i < low)[:, None], (rows >> np.minimum(i, low)[:, None] & 1) << 1, 0)
            new = np.concatenate([self.step(cells[some], bit + half) for half in (0, 1)])
            bounds, levels = self.most[new] @ weights, np.tile(level[some] + 1, 2)
            cols = np.concatenate([col[some] * 2, col[some] * 2 + 1])
            single = np.flatnonzero((levels == depth) & (bounds >= best.least))
            if len(single):
                best.offer(bounds[single], cols[single])
            fit = (levels < depth) & (bounds >= best.least)
            cells, level = np.concatenate([cells[rest], new[fit]]), np.concatenate([level[rest], levels[fit]])
            col, bound = np.concatenate([col[rest], cols[fit]]), np.concatenate([bound[rest], bounds[fit]])


class Best:
    """The k best (score, doc_id) of an item so far; equal scores by ascending id, ids that are null last."""

    def __init__(self, k: int):
        self.k, self.held, self.least, self.ids = k, [], 1, None

    def offer(self, scores: np.ndarray, cols: np.ndarray) -> None:
        for s, c in zip(scores.tolist(), cols.tolist()):
            i = self.ids[c]
            self.held.append((-s, i is None, i or 0))
        self.held.sort()
        del self.held[self.k:]
        if len(self.held) == self.k:
            self.least = -self.held[-1][0]


# index and search on Spark

def corpus_size(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """(documents with a term, all their terms)."""
    def work(batches):
        for batch in batches:
            data, starts, ends = flat(batch.column(0))
            holds, terms = np.zeros(len(starts), bool), 0
            for a, b, s, e in _chunks(data, starts, ends):
                _, begin, _, row = _terms_of(data, starts, ends, a, b, s, e)
                holds[row], terms = True, terms + len(begin)
            yield pa.record_batch([pa.array([int(holds.sum())]), pa.array([terms])], names=["docs", "terms"])

    sums = map_arrow(docs.select(F.col(text).cast("string")), work, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return sums[0] or 0, sums[1] or 0


INDEX = ("doc_ids array<long>, terms array<binary>, held_by array<int>, row_bits int, col_bits int, sizes array<int>, "
         "quadrants binary, drops binary")


def build_index(docs: DataFrame, size: tuple[int, int], key: str = "doc_id", text: str = "text",
                block_docs: int = BLOCK_DOCS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each block of ``docs``; ``size``: their ``corpus_size``. Documents without terms are in no block's grid."""
    n_docs, n_terms = size

    def work(batches):
        hashes = SpanHash()
        for batch in batches:
            data, starts, ends = flat(batch.column(1))
            for a, b in ((x, min(x + block_docs, y)) for lo, y in row_ranges(starts, ends, block_bytes) for x in range(lo, y, block_docs)):
                terms, term, row, tf = postings(data, starts[a:b], ends[a:b], hashes)
                if not terms:
                    continue
                length = np.bincount(row, tf, b - a).astype(np.int64)
                m = np.array([75 + 25 * n * n_docs // n_terms for n in length.tolist()], np.int64)
                held_by = np.bincount(term)
                rank = np.argsort(-held_by, kind="stable")
                place = np.empty_like(rank)
                place[rank] = np.arange(len(rank))
                treap = K2Treap.packed(place[term], row, 1_000_000_000 * tf // (1000 * tf + 12 * m[row]))
                yield pa.RecordBatch.from_pylist([{"doc_ids": batch.column(0).slice(a, b - a), "terms": [terms[i] for i in rank.tolist()],
                                                   "held_by": held_by[rank], **treap}], schema)

    schema = pa.schema([("doc_ids", pa.list_(pa.int64())), ("terms", pa.list_(pa.binary())), ("held_by", pa.list_(pa.int32())), ("row_bits", pa.int32()),
                        ("col_bits", pa.int32()), ("sizes", pa.list_(pa.int32())), ("quadrants", pa.binary()), ("drops", pa.binary())])
    return map_arrow(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), work, INDEX)


def _query_blocks(items: DataFrame, text: str):
    """Lists of (row, terms with their counts) of the items, of bounded size each."""
    held, size = [], 0
    for r in items.select("row", F.col(text).cast("string").alias("text")).toLocalIterator():
        t = LOWER[np.frombuffer((r["text"] or "").encode(), np.uint8)]
        begin, end = term_places(t, np.zeros(1, np.int64), np.array([len(t)]))
        whole = t.tobytes()
        terms = Counter(whole[x:y] for x, y in zip(begin.tolist(), end.tolist()))
        if terms:
            held.append((r["row"], terms))
            size += sum(map(len, terms))
        if size > QUERY_BYTES or len(held) >= QUERY_ITEMS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _weights(index: DataFrame, terms: list[bytes], n_docs: int) -> list[int]:
    """The weight of each term, by the number of documents of the whole index that hold it."""
    def work(batches):
        known = pa.array(terms, pa.binary())
        for batch in batches:
            for i in range(batch.num_rows):
                at = pc.index_in(known, value_set=batch.column(0)[i].values)
                there = pc.is_valid(at).to_numpy(zero_copy_only=False)
                n = batch.column(1)[i].values.to_numpy()[at.filter(pa.array(there)).to_numpy()]
                yield pa.record_batch([pa.array(np.flatnonzero(there).astype(np.int32)), pa.array(n.astype(np.int64))], names=["term", "n"])

    df = map_arrow(index.select("terms", "held_by"), work, "term int, n long").groupBy("term").agg(F.sum("n").alias("df"))
    by = {r["term"]: r["df"] for r in df.toLocalIterator()}  # no more rows than ``terms``
    return [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * by.get(i, 0) + 1))) for i in range(len(terms))]


def search(index: DataFrame, size: tuple[int, int], items: DataFrame, k: int = TOP, text: str = "text") -> DataFrame:
    """(row, doc_id, score) of the k best documents of ``index`` for each of ``items`` (row, text), best of each task's blocks: a superset
    of the k best, to be ranked by the caller. Items go through the index in blocks of bounded size."""
    spark, out = items.sparkSession, None
    for block in _query_blocks(items, text):
        terms = sorted({t for _, some in block for t in some})
        weights = _weights(index, terms, size[0])
        number = {t: i for i, t in enumerate(terms)}
        queries = [(row, np.array([number[t] for t in some]), np.array([weights[number[t]] * c for t, c in some.items()])) for row, some in block]
        sent = spark.sparkContext.broadcast((terms, queries))  # of bounded size, see _query_blocks

        def work(batches, sent=sent):
            terms, queries = sent.value
            known, best = pa.array(terms, pa.binary()), [Best(k) for _ in queries]
            for batch in batches:
                for r in range(batch.num_rows):
                    got = {name: batch.column(i)[r] for i, name in enumerate(batch.schema.names)}
                    at = pc.fill_null(pc.index_in(known, value_set=got["terms"].values), -1).to_numpy()
                    ids = got["doc_ids"].as_py()
                    treap = K2Treap.unpacked(*(got[c].as_py() for c in ("row_bits", "col_bits", "sizes", "quadrants", "drops")))
                    for (_, some, weight), found in zip(queries, best):
                        there = (at[some] >= 0) & (weight > 0)
                        if there.any():
                            found.ids = ids
                            treap.search(at[some[there]], weight[there], found)
            rows = [(q[0], None if null else i, -s) for q, b in zip(queries, best) for s, null, i in b.held]
            yield pa.record_batch([pa.array([x[j] for x in rows], pa.int64()) for j in range(3)], names=["row", "doc_id", "score"])

        some = map_arrow(index.select("doc_ids", "terms", "row_bits", "col_bits", "sizes", "quadrants", "drops"), work, "row long, doc_id long, score long")
        out = some if out is None else out.unionByName(some)
    return spark.createDataFrame([], "row long, doc_id long, score long") if out is None else out


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = TOP, key: str = "doc_id", item: str = "item_id", text: str = "text",
                     item_text: str = "text", block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of greatest score above 0 for each row of ``items``, ranks from 1.

    Null and empty texts, and texts without terms, are found by no item, and such items find nothing. Equal scores are
    ranked by ascending doc_id, null ids last. Repeated documents rank each for itself; repeated items are ranked each for itself. An empty table on either side gives
    no rows. Further columns are not looked at.
    """
    spark = docs.sparkSession
    with at_most(spark, OF_TEXTS):
        size = corpus_size(docs, text)
        index = written(build_index(docs, size, key, text, block_docs), "search-index", "zstd", FILE_ROWS)
    queries = written(items.select(F.monotonically_increasing_id().alias("row"), F.col(item).alias("item_id"), F.col(item_text).alias("text")), "search-items")
    with at_most(spark, OF_INDEX):
        found = written(search(index, size, queries, k), "search-found")
    discard(index)
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(queries.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")


def op13_lexical_search(spark, sf_dir: str) -> DataFrame:
    """The 20 best of all documents for each benchmark item."""
    return ranked_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_UPPER = "".join(map(chr, range(65, 91)))
OP13_SQL = rf"""
WITH d AS (
    SELECT row, doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
    FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)
), q AS (
    SELECT item, item_id, t, count(*) AS times
    FROM (SELECT item, item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
          FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark))
    GROUP BY ALL
), tf AS (
    SELECT row, doc_id, t, count(*) AS tf FROM d GROUP BY ALL
), size AS (
    SELECT row, sum(tf)::BIGINT AS n FROM tf GROUP BY row
), corpus AS (
    SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM size
), weight AS (
    SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, corpus GROUP BY t, docs
), scored AS (
    SELECT item, item_id, doc_id, row, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // terms))))::BIGINT AS score
    FROM q JOIN weight USING (t) JOIN tf USING (t) JOIN size USING (row), corpus GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= {TOP}
"""
