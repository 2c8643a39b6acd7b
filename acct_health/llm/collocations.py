"""Phrase collocations from a weighted de Bruijn graph of words (operator 12).

Nodes are phrases of ``longest`` - 1 words, edges phrases of ``longest`` words between the nodes of their first and their
last words, and an edge's weight is how often it occurs. Only edges are counted in the texts. How often a node occurs is its flow, the
weights of the edges that leave it, and how often a run of words ends with it; phrases one word shorter follow
from the nodes in the same way, and so on.

Words that occur less than ``least`` times, and pairs of neighbours that do, are in no candidate: pieces are cut there
into runs, and the counts of what is left are exact. What is rare is told from bitmaps of fixed size, of
hashes, so a few rare words or pairs may stay, which costs work but changes no count.

Before they are shuffled, the edges of a part of a text are compacted: a node that one edge enters and one leaves
within the part is inner to a path, and a path goes out as one row, its words and its weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acct_health.llm.common import discard, map_arrow, read_table, release, written
from acct_health.llm.scan import CHUNK, ODD, SpanHash, flat, groups, mixed, row_ranges

LONGEST, LEAST, TOP = 5, 100, 2000
BITS = 26  # log2 of the bits of a bitmap
HELD = 250_000  # rows that a task gathers before it hands them on
PATHS = 600_000  # the same for paths and ends of runs

BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Words:
    """The words of a part of the texts. joined[i]: word i follows word i - 1 in its piece. Words before ``fresh`` belong to the part before;
    ``cut``: the last piece goes on in the next part."""

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    row: np.ndarray
    joined: np.ndarray
    fresh: int
    cut: bool


def _parts(data: np.ndarray, start: int, end: int, limit: int, overlap: int) -> Iterator[tuple[int, int, bool, bool]]:
    """(start, end, goes on from before, goes on) of parts of a long text: cut behind a piece, or in a piece of more
    than ``limit`` bytes behind a word, the next part then beginning ``overlap`` words earlier."""
    before = False
    while end - start > 2 * limit:
        at = start + limit
        some = np.flatnonzero(BREAK[data[at:at + limit]])
        if len(some):
            at += int(some[0]) + 1
            yield start, at, before, False
            start, before = at, False
            continue
        at += limit
        spaces = np.flatnonzero(SPACE[data[at:end]]) if at < end else []
        if not len(spaces):
            break
        at += int(spaces[0])
        inside = ~(SPACE | BREAK)[data[start:at]]
        first = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
        if len(first) <= 2 * overlap:  # words of enormous length
            break
        yield start, at, before, True
        start, before = start + int(first[-overlap]), True
    if end > start:
        yield start, end, before, False


def words_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, limit: int = CHUNK, overlap: int = LONGEST - 1) -> Iterator[Words]:
    for a, b in row_ranges(starts, ends, limit):
        long = b - a == 1
        for s, e, before, cut in _parts(data, int(starts[a]), int(ends[a]), limit, overlap) if long else ((int(starts[a]), int(ends[b - 1]), False, False),):
            part = LOWER[data[s:e]]
            inside = np.zeros(len(part) + 2, bool)
            breaks = BREAK[part]
            inside[1:-1] = ~(breaks | SPACE[part])
            left, right = inside[:-2].copy(), inside[2:].copy()
            first, last = np.maximum(starts[a:b], s) - s, np.minimum(ends[a:b], e) - s
            left[first[first < len(part)]] = False
            right[last[last > 0] - 1] = False
            begin, end = np.flatnonzero(inside[1:-1] & ~left), np.flatnonzero(inside[1:-1] & ~right) + 1
            if not len(begin):
                continue
            row = a + np.searchsorted(ends[a:b], s + begin, "right")
            piece = np.cumsum(breaks)[begin]
            joined = np.concatenate([[False], (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])])
            yield Words(part, begin, end, row, joined, overlap if before else 0, cut)


class Reader:
    """Words with hashes that tell languages apart."""

    def __init__(self):
        self.hashes, self.salts = SpanHash(), {}

    def parts(self, batch) -> Iterator[tuple[list[str], Words, np.ndarray, np.ndarray]]:
        """(language of each row, words, first and second hash of each word) for batches of (lang, text)."""
        langs = batch.column(0).to_pylist()
        salt = np.array([self.salts.setdefault(x, xxhash.xxh3_64_intdigest(x)) for x in langs], np.uint64)
        data, starts, ends = flat(batch.column(1))
        for words in words_of(data, starts, ends):
            h1, h2 = self.hashes(words.data, words.begin, words.end)
            yield langs, words, mixed(h1 ^ salt[words.row]), h2


def _bit(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    place = h & np.uint64(len(bits) * 8 - 1)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bitmap(hashes: DataFrame, bits: int = BITS) -> np.ndarray:
    """2**bits bits, those of the low bits of ``h`` set. The driver gets 2**(bits - 6) rows at most."""
    place = F.col("h").bitwiseAND((1 << bits) - 1)
    got = hashes.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(h & {63}L as int))")).alias("set")).toArrow()
    out = np.zeros(1 << bits - 6, np.int64)
    out[got.column("word").to_numpy()] = got.column("set").to_numpy()
    return out.view(np.uint8)


def _counted(found: dict, schema: pa.Schema):
    rows = [(lang, text, *more) for (lang, text), more in found.items()]
    found.clear()
    return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)] if rows else [pa.array([], t) for t in schema.types], schema=schema)


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, phrase, h, n): each word of ``texts`` (lang, text), how often it occurs, and its hash."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("h", pa.int64()), ("n", pa.int64())])

    def work(batches):
        reader, found = Reader(), {}
        for batch in batches:
            for langs, w, h1, h2 in reader.parts(batch):
                order, first = groups(h1[w.fresh:], h2[w.fresh:])
                n, some, whole = np.diff(np.append(first, len(order))), order[first] + w.fresh, w.data.tobytes()
                for row, s, e, h, c in zip(w.row[some].tolist(), w.begin[some].tolist(), w.end[some].tolist(), h1[some].view(np.int64).tolist(), n.tolist()):
                    key = (langs[row], whole[s:e])
                    held = found.get(key)
                    found[key] = (h, c) if held is None else (h, held[1] + c)
                if len(found) >= HELD:
                    yield from sliced(_counted(found, schema))
        yield from sliced(_counted(found, schema))

    rows = map_arrow(texts, work, "lang string, phrase binary, h long, n long")
    return rows.groupBy("lang", F.col("phrase").cast("string").alias("phrase")).agg(F.first("h").alias("h"), F.sum("n").alias("n"))


def pair_hash(h1: np.ndarray) -> np.ndarray:
    """The hash of word i and the word behind it."""
    return mixed(h1[:-1] * ODD + h1[1:])


def sliced(batch: pa.RecordBatch, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    for at in range(0, max(1, batch.num_rows), rows):
        yield batch.slice(at, rows)


def frequent_pairs(texts: DataFrame, sent, least: int) -> DataFrame:
    """(h,): hashes of neighbours in a piece, both words marked in the bitmap ``sent``, that occur ``least`` times or more."""
    def work(batches):
        reader, held, size = Reader(), [], 0

        def counted():
            h = np.concatenate([x for x, _ in held])
            order = np.argsort(h)
            h, n = h[order], np.concatenate([x for _, x in held])[order]
            new = np.concatenate([np.zeros(min(1, len(h)), np.int64), np.flatnonzero(h[1:] != h[:-1]) + 1])
            return pa.record_batch([pa.array(h[new].view(np.int64)), pa.array(np.add.reduceat(n, new) if len(new) else n)], names=["h", "n"])

        for batch in batches:
            for _, w, h1, _ in reader.parts(batch):
                often = _bit(sent.value, h1)
                pair = w.joined[1:] & often[1:] & often[:-1]
                pair[:max(0, w.fresh - 1)] = False  # those are the part's before
                held.append(np.unique(pair_hash(h1)[pair], return_counts=True))
                size += len(held[-1][0])
                if size >= 3 * HELD:
                    yield from sliced(counted())
                    held, size = [], 0
        if held:
            yield from sliced(counted())

    return map_arrow(texts, work, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("h")


def _phrase(data: bytes, begin: np.ndarray, end: np.ndarray, first: int, last: int) -> bytes:
    """Words ``first`` to ``last`` joined by spaces."""
    text = data[begin[first]:end[last]]
    if b"\t" in text or b"  " in text:
        return b" ".join(text.split())  # bytes that part words here are spaces and tabs only
    return text


def paths(w: Words, h1: np.ndarray, h2: np.ndarray, pair: np.ndarray, longest: int) -> tuple[list, list]:
    """((first word, last word, weight, ends) of the compacted paths, ends: how often a run ends with the path, and (first word, last word, count)
    of the distinct ends of runs that are no edge long.

    pair[i]: words i and i + 1 are in a run. An edge is ``longest`` words of a run."""
    n, out, tails, both = len(h1), [], [], [h1, h2]
    if n < 2:
        return out, tails
    number, triple = np.arange(n - 1), pair[1:] & pair[:-1]
    start = np.maximum.accumulate(np.where(np.concatenate([[False], triple]), 0, number))  # of the run that pair i is in
    edge = np.flatnonzero(pair[longest - 2:] & (start[longest - 2:] <= number[:max(0, n - longest + 1)]))
    edge = edge[edge + longest - 1 >= w.fresh]  # the others are the part's before
    if len(edge):
        keys = []
        for h in both:
            k = np.zeros(len(edge), np.uint64)
            for j in range(longest):
                k = mixed(k * ODD + h[edge + j])
            keys.append(k)
        order, first = groups(*keys)
        count = np.diff(np.append(first, len(order)))
        which = np.empty(len(edge), np.int64)
        which[order] = np.repeat(np.arange(len(first)), count)
        follows = np.concatenate([edge[1:] == edge[:-1] + 1, [False]])
        after = np.where(follows, np.append(which[1:], -1), -1)
        before = np.where(np.concatenate([[False], follows[:-1]]), np.concatenate([[-1], which[:-1]]), -1)
        around = [(np.minimum.reduceat(x[order], first), np.maximum.reduceat(x[order], first)) for x in (after, before)]
        one_after = np.where(around[0][0] == around[0][1], around[0][0], -1)
        one_before = np.where(around[1][0] == around[1][1], around[1][0], -1)
        unary = (one_after >= 0) & (one_before[one_after] == np.arange(len(first)))  # the node behind the edge
        loose = np.ones(len(first), bool)
        loose[one_after[unary]] = False  # edges that begin a path
        # a circle of unary nodes would need an edge before its first occurrence, which that has not
        stops = np.flatnonzero(~unary[which])
        heads = order[first[loose]]
        last = stops[np.searchsorted(stops, heads)]
    stop = np.flatnonzero(pair & ~np.append(triple, False))
    if w.cut:
        stop = stop[stop < n - 2]
    if w.fresh:
        stop = stop[stop + 1 >= w.fresh - 1]
    whole = (stop + 2 - start[stop] >= longest) & (stop + 1 >= w.fresh)  # those that end with an edge
    if len(edge):
        ends = np.bincount(which[np.searchsorted(edge, stop[whole] + 2 - longest)], minlength=len(first))
        out = list(zip(edge[heads].tolist(), (edge[last] + longest - 1).tolist(), count[loose].tolist(), ends[which[last]].tolist()))
    stop = stop[~whole]
    if len(stop):
        size = np.minimum(stop + 2 - start[stop], longest - 1)
        keys = [size.astype(np.uint64), size.astype(np.uint64)]
        for j in range(longest - 1):
            keys = [np.where(j < size, mixed(k * ODD + h[np.maximum(stop + 1 - j, 0)]), k) for k, h in zip(keys, both)]
        order, first = groups(*keys)
        some = order[first]
        tails = list(zip((stop[some] + 2 - size[some]).tolist(), (stop[some] + 1).tolist(), np.diff(np.append(first, len(order))).tolist()))
    return out, tails


def path_counts(texts: DataFrame, words, pairs, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, size, n, ends): compacted paths of ``longest`` words or more by their weight and how often a run ends with them, and ends of
    other runs, of fewer words."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("size", pa.int32()), ("n", pa.int64()), ("ends", pa.int64())])

    def work(batches):
        reader, found = Reader(), {}
        for batch in batches:
            for langs, w, h1, h2 in reader.parts(batch):
                often = _bit(words.value, h1)
                pair = w.joined[1:] & often[1:] & often[:-1] & _bit(pairs.value, pair_hash(h1))
                whole, begin, end, row = w.data.tobytes(), w.begin, w.end, w.row
                for some in paths(w, h1, h2, pair, longest):
                    for first, last, n, *ends in some:
                        key = (langs[row[first]], _phrase(whole, begin, end, first, last))
                        _, n_held, ends_held = found.get(key, (0, 0, 0))
                        found[key] = (last - first + 1, n + n_held, sum(ends) + ends_held)
                if len(found) >= PATHS:
                    yield from sliced(_counted(found, schema))
        yield from sliced(_counted(found, schema))

    rows = map_arrow(texts, work, "lang string, phrase binary, size int, n long, ends long")
    return rows.groupBy("lang", F.col("phrase").cast("string").alias("phrase")).agg(
        F.first("size").alias("size"), F.sum("n").alias("n"), F.sum("ends").alias("ends"))


def phrase_counts(texts: DataFrame, longest: int = LONGEST, least: int = LEAST, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """((lang, n): all words of each language; (lang, phrase, size, n): phrases of 1 to ``longest`` words that occur ``least`` times or more)."""
    spark = texts.sparkSession
    words = written(word_counts(texts), "words", "zstd")
    total = written(words.groupBy("lang").agg(F.sum("n").alias("total")), "word-totals")
    often = spark.sparkContext.broadcast(bitmap(words.where(F.col("n") >= least), bits))  # of fixed size
    pairs = spark.sparkContext.broadcast(bitmap(frequent_pairs(texts, often, least), bits))  # of fixed size
    release(spark)
    found = written(path_counts(texts, often, pairs, longest), "paths", "zstd")
    release(spark)
    split = F.split("phrase", " ")
    inner = F.transform(F.sequence(F.lit(2), F.col("size") - longest), lambda i: F.array_join(F.slice(split, i, longest), " "))
    end = lambda n: F.substring_index("phrase", " ", n).alias("phrase")
    # the first edge of each path, the last of those that have another, and those between
    level = (found.where(F.col("size") >= longest).select("lang", "n", end(longest))
             .unionByName(found.where(F.col("size") > longest).select("lang", "n", end(-longest)))
             .unionByName(found.where(F.col("size") > longest + 1).select("lang", "n", F.explode(inner).alias("phrase"))))
    level = written(level.groupBy("lang", "phrase").agg(F.sum("n").alias("n")), f"phrases-{longest}", "zstd")
    tails = found.where(F.col("size") < longest).select("lang", "phrase", "size", "n").unionByName(
        found.where((F.col("size") >= longest) & (F.col("ends") > 0)).select("lang", end(1 - longest), F.lit(longest - 1).alias("size"), F.col("ends").alias("n")))
    used, kept = [words, found, level], [level.where(F.col("n") >= least).withColumn("size", F.lit(longest))]
    for size in range(longest - 1, 1, -1):
        flow = level.select("lang", F.substring_index("phrase", " ", size).alias("phrase"), "n")
        ends = tails.where(F.col("size") >= size).select("lang", F.substring_index("phrase", " ", -size).alias("phrase"), "n")
        level = written(flow.unionByName(ends).groupBy("lang", "phrase").agg(F.sum("n").alias("n")), f"phrases-{size}", "zstd")
        used.append(level)
        kept.append(level.where(F.col("n") >= least).withColumn("size", F.lit(size)))
    kept.append(words.where(F.col("n") >= least).select("lang", "phrase", "n", F.lit(1).alias("size")))
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    out = written(out.select("lang", "phrase", "size", "n"), "phrases")
    discard(*used)
    release(spark)
    return total, out


def _whole(column: Column | str) -> Column:
    return F.col(column).cast("decimal(19,0)") if isinstance(column, str) else column.cast("decimal(19,0)")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, lang: str = "lang", text: str = "text",
                 bits: int = BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``top`` phrases of 2 to ``longest`` words that occur ``least`` times or more.

    A phrase's score is floor(1000 a n / (l r)) at the cut where that is smallest (the first of equal ones): a, l and r count the phrase, its
    part before and its part behind the cut, n all words of the language. A phrase within a longer one that occurs as often is dropped.
    Null and empty texts hold no words; a null language is ``und``. Repeated rows count each. Equal scores are ranked by descending a, then by
    the phrase's UTF-8 bytes. An empty table gives no rows. Further columns are not looked at.
    """
    if longest < 2:
        raise ValueError("longest: 2 words at least")
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    total, known = phrase_counts(texts, longest, least, bits)
    of = lambda name: known.select("lang", F.col("phrase").alias(name), F.col("n").alias(f"n_{name}"))
    # a phrase as frequent as one that has a word more: longer ones are as frequent only if that one is
    longer = known.where("size > 2")
    inside = longer.select("lang", F.expr("substring_index(phrase, ' ', size - 1)").alias("phrase"), "n").unionByName(
        longer.select("lang", F.expr("substring_index(phrase, ' ', 1 - size)").alias("phrase"), "n"))
    cand = known.where("size > 1").join(inside, ["lang", "phrase", "n"], "left_anti")
    cuts = cand.select("lang", "phrase", "n", "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.withColumns({"first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - size)")})
    cuts = cuts.join(of("first"), ["lang", "first"]).join(of("rest"), ["lang", "rest"]).join(total, "lang")
    # decimals of 38 digits: no product passes them below 10**15 words of a language
    cuts = cuts.withColumns({"above": (_whole(F.col("n") * 1000) * _whole("total")).cast("decimal(38,0)"),
                             "below": (_whole("n_first") * _whole("n_rest")).cast("decimal(38,0)")})
    cuts = cuts.withColumn("score", F.expr("above div below"))
    best = cuts.groupBy("lang", "phrase").agg(F.first("n").alias("a"), F.first("total").alias("n"), F.min(F.struct(
        "score", "k", F.col("n_first").alias("l"), F.col("n_rest").alias("r"))).alias("cut")).select("lang", "phrase", "a", "n", "cut.*")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    return (best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    """All documents: each language's 2000 best phrases of 2 to 5 words that occur 100 times or more."""
    return collocations(read_table(spark, sf_dir, "documents"))


_UPPER = "".join(map(chr, range(65, 91)))
OP12_SQL = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (SELECT lang, unnest(regexp_split_to_array(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), grams AS (
    SELECT lang, k, w[i:i + k - 1] AS words
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (SELECT unnest(range(1, {LONGEST + 1})) AS k))
), counts AS (
    SELECT lang, k, words, count(*) AS f FROM grams GROUP BY ALL
), total AS (
    SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang
), often AS (
    SELECT lang, k, words, f, ' ' || array_to_string(words, ' ') || ' ' AS padded FROM counts WHERE k > 1 AND f >= {LEAST}
), kept AS (
    SELECT * FROM often c WHERE NOT EXISTS (
        SELECT 1 FROM often o WHERE o.lang = c.lang AND o.k > c.k AND 100 * o.f >= 100 * c.f AND contains(o.padded, c.padded))
), cuts AS (
    SELECT kept.lang, kept.words, kept.f AS a, cut, l.f AS l, r.f AS r, n, ((1000::HUGEINT * kept.f * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept) kept JOIN total USING (lang)
    JOIN counts l ON l.lang = kept.lang AND l.words = kept.words[:cut] JOIN counts r ON r.lang = kept.lang AND r.words = kept.words[cut + 1:]
), best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, cut) = 1
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, array_to_string(words, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' ')) AS rank FROM best)
WHERE rank <= {TOP}
"""
