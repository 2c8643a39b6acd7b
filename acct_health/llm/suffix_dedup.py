"""Removal of repeated passages by suffix order and longest-previous-factor arrays (operator 11).

A window is a string of ``length`` bytes within one text. Windows that repeat are told from the order of
the suffixes: the longest earlier match of a suffix is with the nearest suffix before or behind it in
that order that starts earlier in the table (its previous and next smaller position), the longest
later match with the nearest that starts later. A window repeats an earlier one where the former
is ``length`` bytes or more.

No task sorts all suffixes. Each window has an anchor, the leftmost of its ``gram``-byte strings with the
smallest hash, so equal windows have equal anchors at the same place. The windows of one anchor are one excerpt
of the text, and only excerpts of one anchor string can hold equal windows: they make a class.
Classes of one occurrence are gone after a count; of equal excerpts one is kept, with their number. The suffixes of the
excerpts of a class are sorted at the anchor first, then one byte further to the left at a time: a stable sort by
that byte keeps the order of what follows it, and the common prefixes of neighbours follow by minima over ranges.

A class of more than ``most`` different excerpts is not sorted in one task; its windows are counted by digest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from acct_health.llm.common import discard, map_arrow, read_table, release, written
from acct_health.llm.scan import CHUNK, byte_values, flat, mixed, row_ranges

LENGTH = 200
MOST = 50_000  # excerpts of a class that are sorted in one task
TOGETHER = 8000  # excerpts that are sorted at once, of whole classes


# anchors

def gram_size(length: int) -> int:
    """The largest power of two up to a quarter of ``length``, 32 at most."""
    return 1 << max(0, min(5, (length // 4).bit_length() - 1))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    h, step, power = byte_values(11)[data], 1, 0xD1342543DE82EF95
    while step < gram:
        h = h[:-step] * np.uint64(power) + h[step:]
        step, power = 2 * step, power * power % (1 << 64)
    return mixed(h)


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(first window, last window, anchor, hash of its string) of the runs of windows with one anchor; the texts
    follow each other in ``data``, no window crosses them."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.astype(np.uint64)
    gram = gram_size(length)
    h = gram_hashes(data, gram)
    low = np.uint64((1 << len(h).bit_length()) - 1)
    least, step, span = (h & ~low) | np.arange(len(h), dtype=np.uint64), 1, length - gram + 1
    while 2 * step <= span:
        least, step = np.minimum(least[:-step], least[step:]), 2 * step
    if span > step:
        least = np.minimum(least[:len(least) - (span - step)], least[span - step:])
    crossing = np.zeros(len(least) + 1, np.int32)
    np.add.at(crossing, np.minimum(np.maximum(ends - length + 1, starts), len(least)), 1)
    np.add.at(crossing, np.minimum(ends, len(least)), -1)
    at = np.flatnonzero(np.cumsum(crossing[:-1]) == 0)
    if not len(at):
        return none, none, none, none.astype(np.uint64)
    anchor = (least[at] & low).astype(np.int64)
    edge = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
    first, last = np.concatenate([[0], edge]), np.concatenate([edge, [len(at)]]) - 1
    return at[first], at[last], anchor[first], h[anchor[first]]


def _excerpts(data, starts, ends, length):
    """Batches of (row, place of the anchor in its text, hash, digest, left, right) arrays."""
    for a, b in row_ranges(starts, ends, CHUNK):
        offset, over = int(starts[a]), int(ends[b - 1])
        for begin in range(offset, max(over, offset + 1), CHUNK) if b - a == 1 else (offset,):  # a long text: by its windows
            stop = min(over, begin + CHUNK + length - 1) if b - a == 1 else over
            part = data[begin:stop]
            first, last, anchor, h = anchors(part, np.maximum(starts[a:b], begin) - begin, np.minimum(ends[a:b], stop) - begin, length)
            left, right = anchor - first, last + length - anchor
            view, digest = memoryview(part), xxhash.xxh3_64_intdigest
            digests = np.fromiter((digest(view[s:e], d) for s, e, d in zip(first.tolist(), (last + length).tolist(), left.tolist())),
                                  np.uint64, len(first))
            row = a + np.searchsorted(ends[a:b], begin + anchor, "right")
            yield row, begin + anchor - starts[row], h, digests, left, right


def anchor_rows(texts: DataFrame, length: int) -> DataFrame:
    """(id, row, at, hash, digest, left, right) of the anchors of ``texts`` (row, text); ids rise with row and place."""
    def work(batches):
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            data, starts, ends = flat(batch.column(1))
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            for row, at, h, digest, left, right in _excerpts(data, starts, ends, length):
                yield pa.record_batch([pa.array(np.arange(number, number + len(row))), pa.array(rows[row]), pa.array(at), pa.array(h.view(np.int64)),
                                       pa.array(digest.view(np.int64)), pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32))], names=names)
                number += len(row)

    names = ["id", "row", "at", "hash", "digest", "left", "right"]
    return map_arrow(texts.select("row", "text"), work, "id long, row long, at long, hash long, digest long, left int, right int")


# suffix order of the excerpts of some classes

def _least(lcp: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min(lcp[a + 1], ..., lcp[b]) of each a < b."""
    out = lcp[b]
    far = np.flatnonzero(b > a + 1)
    if len(far):
        ranges = np.stack([a[far] + 1, b[far] + 1], axis=1).ravel()
        out[far] = np.minimum.reduceat(np.append(lcp, 0), ranges)[::2]
    return out


def smaller_match(place: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """Longest common prefix of each suffix with its previous smaller ``place`` in suffix order; lcp[i] is that
    of suffixes i - 1 and i. Values below ``least`` may be given as 0."""
    n = len(place)
    to, common = np.arange(-1, n - 1), lcp.copy()
    open_ = np.arange(n)
    while len(open_):
        open_ = open_[(to[open_] >= 0) & (common[open_] >= least)]
        open_ = open_[place[to[open_]] > place[open_]]
        nearer = to[open_]
        common[open_], to[open_] = np.minimum(common[open_], common[nearer]), to[nearer]
    return np.where((to >= 0) & (common >= least), common, 0)


def longest_factors(place: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """Longest match of each suffix with one of smaller place: that of its previous and its next smaller place."""
    behind = np.append(lcp[1:], -1)[::-1]
    return np.maximum(smaller_match(place, lcp, least), smaller_match(place[::-1], behind, least)[::-1])


def repeated(cls: np.ndarray, data: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray, place: np.ndarray,
             length: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether the window that starts d bytes before anchor i has an equal one earlier, and later: two arrays [i, d].

    Excerpt i is data[at - left:at + right], of class cls[i] (whole numbers in order), its place in the table place[i]."""
    n, width = len(at), int(right.max())
    reach = np.arange(width, dtype=np.int32)
    tail = data[np.minimum(at.astype(np.int32)[:, None] + reach, np.int32(len(data) - 1))]
    tail[reach >= right[:, None]] = 0
    order = np.lexsort((right, np.ascontiguousarray(tail).view(f"S{width}").ravel(), cls))
    tail = tail[order]
    same = tail[1:] == tail[:-1]
    lcp = np.full(n, -1, np.int64)
    lcp[1:] = np.where(same.all(axis=1), width, same.argmin(axis=1))
    lcp[1:] = np.minimum(lcp[1:], np.minimum(right[order[1:]], right[order[:-1]]))
    lcp[1:][cls[order[1:]] != cls[order[:-1]]] = -1
    earlier, later = (np.zeros((n, int(left.max()) + 1), bool) for _ in range(2))
    del tail, same
    for d in range(int(left.max()) + 1):
        alive = np.flatnonzero(left[order] >= d)
        if len(alive) < len(order):
            lcp = np.concatenate([[-1], _least(lcp, alive[:-1], alive[1:])])
            order = order[alive]
        if d:
            byte = cls[order] * 256 + data[at[order] - d]
            moved = np.arange(len(order))
            wrong = np.flatnonzero(byte[1:] < byte[:-1])
            if len(wrong):  # only classes whose bytes differ are sorted anew
                open_ = np.zeros(int(cls[-1]) + 1, bool)
                open_[cls[order[wrong]]] = True
                some = np.flatnonzero(open_[cls[order]])
                moved[some] = some[np.argsort(byte[some], kind="stable")]
            byte = byte[moved]
            joined = np.flatnonzero(byte[1:] == byte[:-1])
            new = np.where(byte[1:] >> 8 == byte[:-1] >> 8, 0, -1)
            new[joined] = _least(lcp, moved[joined], moved[joined + 1]) + 1
            order, lcp = order[moved], np.concatenate([[-1], new])
        whole = np.flatnonzero(right[order] >= length - d)  # those that hold a window here
        if len(whole) < 2:
            continue
        common = np.concatenate([[-1], _least(lcp, whole[:-1], whole[1:])])
        match = common >= length
        some = np.flatnonzero(match | np.append(match[1:], False))
        if len(some):
            here, common = order[whole[some]], common[some]
            for out, sign in ((earlier, 1), (later, -1)):
                out[here, d] = longest_factors(sign * place[here], common, length) >= length
    return earlier, later


def _runs(flags: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(excerpt, start, end) of the bytes covered by the marked windows, from the anchor on."""
    edge = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    i, low = np.nonzero(edge == 1)
    _, high = np.nonzero(edge == -1)
    return i, -(high - 1), length - low


def sorted_covers(excerpts: DataFrame, length: int, first: bool, together: int = TOGETHER) -> DataFrame:
    """(hash, digest, start, end): repeated bytes of the different excerpts of classes, by suffix order."""
    def found(rows: pa.Table):
        hashes = rows.column("hash").to_numpy()
        left, right = (rows.column(c).to_numpy().astype(np.int64) for c in ("left", "right"))
        data, starts, _ = flat(rows.column("excerpt").combine_chunks().cast(pa.large_binary()))
        cls = np.concatenate([[0], np.cumsum(hashes[1:] != hashes[:-1])])
        earlier, later = repeated(cls, data, starts + left, left, right, rows.column("id").to_numpy(), length)
        i, start, end = _runs(earlier if first else earlier | later, length)
        return pa.record_batch([pa.array(hashes[i]), pa.array(rows.column("digest").to_numpy()[i]), pa.array(start), pa.array(end)],
                               names=["hash", "digest", "start", "end"])

    def work(batches):
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) >= together:
                rows = pa.Table.from_batches(held)
                hashes = rows.column("hash").to_numpy()
                cut = int(np.searchsorted(hashes, hashes[-1]))  # whole classes only
                if cut:
                    yield found(rows.slice(0, cut))
                held = rows.slice(cut).combine_chunks().to_batches()
        if held:
            yield found(pa.Table.from_batches(held))

    dealt = excerpts.select("hash", "digest", "id", "left", "right", "excerpt").repartition("hash").sortWithinPartitions("hash")
    return map_arrow(dealt, work, "hash long, digest long, start long, end long")


def counted_covers(excerpts: DataFrame, length: int, first: bool) -> DataFrame:
    """The same by counts of window digests (128 bits), for classes too large to sort in one task."""
    def work(batches):
        for batch in batches:
            data, starts, ends = flat(batch.column(batch.schema.get_field_index("excerpt")))
            left = batch.column(batch.schema.get_field_index("left")).to_numpy()
            i = np.repeat(np.arange(len(starts)), ends - starts - length + 1)
            at = np.arange(len(i)) - np.repeat(np.cumsum(ends - starts - length + 1) - (ends - starts - length + 1), ends - starts - length + 1)
            view = memoryview(data)
            digests = [xxhash.xxh3_128_digest(view[s:s + length]) for s in (starts[i] + at).tolist()]
            yield pa.record_batch([pa.array(digests, pa.binary()), pa.array((left[i] - at).astype(np.int64)),
                                   *(batch.column(batch.schema.get_field_index(c)).take(pa.array(i)) for c in ("hash", "digest", "id"))],
                                  names=["window", "d", "hash", "digest", "id"])

    windows = written(map_arrow(excerpts.select("hash", "digest", "id", "left", "excerpt"), work,
                                "window binary, d long, hash long, digest long, id long"), "windows")
    many = windows.groupBy("window").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).where("n > 1")
    hit = windows.join(many, "window").where(F.col("id") > F.col("first") if first else F.lit(True))
    return hit.select("hash", "digest", (-F.col("d")).alias("start"), (length - F.col("d")).alias("end"))


# the operator

def repeat_spans(docs: DataFrame, length: int = LENGTH, keep: str = "none", text: str = "text", most: int = MOST) -> DataFrame:
    """``docs`` with ``repeat_spans``: array of (start, end), the byte ranges of the UTF-8 text that windows of ``length``
    bytes cover which occur elsewhere too, in the same text or another. Ranges are in order and apart from each other.

    ``keep``: "none" marks all occurrences, "first" all but the first in the order of the table as read.
    Null and empty texts, and texts of fewer than ``length`` bytes, have no spans. Repeated rows repeat each other. An empty table
    gives no rows. A column ``repeat_spans`` of ``docs`` is replaced, other names don't matter.
    Excerpts are taken as equal if their digests and the hashes of their anchors are (128 bits in all).
    """
    if keep not in ("none", "first"):
        raise ValueError("keep: none or first")
    first, spark = keep == "first", docs.sparkSession
    own = [c for c in docs.columns if c != "repeat_spans"]
    table = written(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[docs[f"`{c}`"] for c in own]).alias("doc")), "texts", "zstd")
    texts = table.select("row", F.col(f"doc.`{text}`").cast("string").cast("binary").alias("text"))
    found = written(anchor_rows(texts, length), "anchors")
    # what is joined to all occurrences is written first: Spark can then part a hot key's rows over tasks
    common = written(found.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"), "common-hashes")
    every_anchor, found = found, written(found.join(common, "hash", "left_semi"), "common-anchors")
    discard(every_anchor, common)
    release(spark)
    same = written(found.groupBy("hash", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("id"), F.min_by("row", "id").alias("row"), F.min_by("at", "id").alias("at"),
        F.first("left").alias("left"), F.first("right").alias("right")), "excerpt-groups")
    # the different excerpts of an anchor are sorted, one of each
    sizes = written(same.groupBy("hash").agg(F.count(F.lit(1)).alias("different")).where("different > 1"), "class-sizes")
    wanted = same.join(sizes, "hash").select("row", F.struct("hash", "digest", "id", "at", "left", "right", "different").alias("x"))
    excerpts = written(texts.join(wanted, "row").select(
        "x.*", F.expr("substring(text, cast(x.at - x.left + 1 as int), x.left + x.right)").alias("excerpt")), "excerpts", "zstd")
    release(spark)
    covers = sorted_covers(excerpts.where(F.col("different") <= most), length, first)
    if not excerpts.where(F.col("different") > most).isEmpty():
        covers = covers.unionByName(counted_covers(excerpts.where(F.col("different") > most), length, first))
    covers = covers.groupBy("hash", "digest").agg(F.collect_list(F.struct("start", "end")).alias("some"))
    # back to all occurrences; of equal excerpts all windows repeat (the first one's where it is not kept)
    known = written(same.select("hash", "digest", "n", F.col("id").alias("first")).join(covers, ["hash", "digest"], "left")
                    .where("n > 1 or some is not null"), "covers")
    every = F.col("id") > F.col("first") if first else F.col("n") > 1
    whole = F.array(F.struct((-F.col("left")).cast("long").alias("start"), F.col("right").cast("long").alias("end")))
    spans = found.join(known, ["hash", "digest"]).select("row", "at", F.explode(F.when(every, whole).otherwise(F.col("some"))).alias("s"))
    spans = spans.select("row", F.struct((F.col("at") + F.col("s.start")).alias("start"), (F.col("at") + F.col("s.end")).alias("end")).alias("s"))
    spans = written(map_arrow(spans.groupBy("row").agg(F.sort_array(F.collect_list("s")).alias("spans")), _merged,
                              "row long, spans array<struct<start:long,end:long>>"), "spans")
    discard(found, same, sizes, excerpts, known)
    release(spark)
    return table.join(spans, "row", "left").select("doc.*", F.coalesce("spans", F.array()).alias("repeat_spans"))


def _merged(batches):
    """Sorted spans of each row as spans that are apart from each other."""
    kind = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        offsets, starts, ends = [0], [], []
        spans = batch.column(1)
        for i in range(batch.num_rows):
            one = spans[i].values
            s, e = one.field(0).to_numpy(), np.maximum.accumulate(one.field(1).to_numpy())
            new = np.flatnonzero(s[1:] > e[:-1]) + 1
            starts.append(s[np.concatenate([[0], new])])
            ends.append(e[np.concatenate([new - 1, [len(e) - 1]])])
            offsets.append(offsets[-1] + len(new) + 1)
        flat_spans = pa.StructArray.from_arrays([pa.array(np.concatenate(starts or [[]]), pa.int64()), pa.array(np.concatenate(ends or [[]]), pa.int64())],
                                                fields=list(kind))
        yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat_spans)], names=["row", "spans"])


def without_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "first", text: str = "text", most: int = MOST) -> DataFrame:
    """``docs`` with ``kept``, the bytes of the text outside its repeats (binary, for a cut may part a character; null for a null
    text), and n_bytes, n_removed, n_spans (0 for a null text). Columns of these names are replaced. Else as ``repeat_spans``."""
    new = ["kept", "n_bytes", "n_removed", "n_spans"]
    if text in new:
        raise ValueError(f"the text column may not be called {text}")
    found = repeat_spans(docs.drop(*new), length, keep, text, most)
    own = [c for c in found.columns if c != "repeat_spans"]
    schema = StructType([*(found.schema[c] for c in own), StructField("kept", BinaryType()), *(StructField(c, LongType()) for c in new[1:])])

    def work(batches):
        for batch in batches:
            at = [batch.schema.get_field_index(c) for c in (text, "repeat_spans")]
            data, starts, ends = flat(batch.column(at[0]).cast(pa.large_string()))
            null = batch.column(at[0]).is_null().to_pylist()
            offsets = batch.column(at[1]).offsets.to_numpy()
            lows, highs = (batch.column(at[1]).values.field(i).to_numpy() for i in range(2))
            view, kept, removed = memoryview(data), [], []
            for i, (start, end) in enumerate(zip(starts.tolist(), ends.tolist())):
                low, high = lows[offsets[i]:offsets[i + 1]], highs[offsets[i]:offsets[i + 1]]
                bounds = zip([0, *high.tolist()], [*low.tolist(), end - start])
                kept.append(None if null[i] else b"".join([view[start + a:start + b] for a, b in bounds]))
                removed.append(int((high - low).sum()))
            yield pa.record_batch([*(batch.column(batch.schema.get_field_index(c)) for c in own), pa.array(kept, pa.binary()), pa.array(ends - starts),
                                   pa.array(removed, pa.int64()), pa.array(np.diff(offsets).astype(np.int64))], names=[*own, *new])

    return map_arrow(found, work, schema)


def op11_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents; every byte under a 200-byte string that also starts elsewhere is removed."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = without_repeats(docs, LENGTH, "none")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans",
                        F.sha2(F.coalesce("kept", F.lit(b"")), 256).alias("kept_sha256"))


# texts as hexadecimal digits, two for each byte
OP11_SQL = f"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id, hex(coalesce(text, '')) AS h FROM documents
), windows AS (
    SELECT row, pos, md5_number(substr(h, 2 * pos + 1, {2 * LENGTH})) AS digest
    FROM (SELECT row, h, unnest(range(0, len(h) // 2 - {LENGTH - 1})) AS pos FROM d)
), hits AS (
    SELECT row, pos FROM windows WHERE digest IN (SELECT digest FROM windows GROUP BY digest HAVING count(*) > 1)
), runs AS (
    SELECT row, pos, sum(new) OVER (PARTITION BY row ORDER BY pos) AS run
    FROM (SELECT row, pos, (pos - lag(pos, 1, -{LENGTH + 1}) OVER (PARTITION BY row ORDER BY pos) > {LENGTH})::INT AS new FROM hits)
), spans AS (
    SELECT row, run, min(pos) AS low, max(pos) + {LENGTH} AS high FROM runs GROUP BY row, run
), cut AS (
    SELECT row, low, high, lag(high, 1, 0) OVER (PARTITION BY row ORDER BY low) AS since FROM spans
), kept AS (
    SELECT row, sum(high - low)::BIGINT AS n_removed, count(*) AS n_spans, max(high) AS last,
        string_agg(substr(h, 2 * since + 1, 2 * (low - since)), '' ORDER BY low) AS head
    FROM cut JOIN d USING (row) GROUP BY row
)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
    sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE head || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN kept USING (row)
"""
