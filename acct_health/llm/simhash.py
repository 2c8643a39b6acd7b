"""SimHash near-duplicates by the generalised pigeonhole principle (operator 6).

Fingerprints: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of 3 words joined by a
space (repeats count), each hashed by XXH64 with seed 42; a bit is 1 if it is set in more
than half of the hashes.

Links: two fingerprints at most ``distance`` bits apart. The 64 bits are dealt into parts,
correlated bits together (their correlations are counted over all fingerprints). Part i gets a
threshold t_i >= -1 with sum(t_i + 1) = distance + 1: two fingerprints within ``distance`` are
then within t_i in some part i, for else they would differ in more bits. Dynamic programming
picks the thresholds with the smallest estimated cost, the estimate being the number of
probe keys plus the number of candidate pairs at the bits' counted frequencies. Each
fingerprint goes to the bucket of its own part value (at home) and to those of all
values within t_i (away); the pairs of a bucket with one at home are verified on all 64 bits.

Equal fingerprints are one row from the start. A bucket with more than ``block`` rows is cut into
blocks whose pairs are compared in as many tasks. From a bucket comes a spanning forest of
its links, not every pair, so a group of n near copies gives n - 1 rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acct_health.llm.common import map_arrow, only_memory_of, read_table, written
from acct_health.llm.components import components

SEED = 42
SEGMENT = 1 << 20  # bytes of a text whose words are held at once


# fingerprints

def _segments(text: bytes) -> Iterator[list[bytes]]:
    """The words of ``text``, a bounded number of bytes at a time, cut at white space."""
    at = 0
    while at < len(text):
        end = min(len(text), at + SEGMENT)
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield text[at:end].lower().split()  # bytes: only A-Z change, only ASCII white space parts
        at = end


def _hashes(words: list[bytes], n: int) -> np.ndarray:
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts[:len(words) - n + 1].tolist(), ends[n - 1:].tolist())),
                       np.uint64, len(words) - n + 1)


def fingerprint(text: bytes | None, n: int = 3) -> int:
    """The fingerprint of a UTF-8 text; fewer than ``n`` words: of the whole sequence; none or null: 0."""
    ones, total, carried = np.zeros(64, np.int64), 0, []
    for words in _segments(text or b""):
        words = carried + words
        if len(words) >= n:
            for at in range(0, len(words) - n + 1, 65536):
                h = _hashes(words[at:at + 65536 + n - 1], n)
                ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
                total += len(h)
        carried = words[-(n - 1):] if n > 1 else []
    if not total and carried:
        return xxhash.xxh64_intdigest(b" ".join(carried), SEED)
    return sum(1 << i for i in range(64) if 2 * ones[i] > total)


def fingerprints(docs: DataFrame, shingle: int = 3, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row as a signed long; with ``digest`` also the SHA-256 of its text."""
    def work(batches):
        only_memory_of("simhash")
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in batch.column(1).cast(pa.large_binary()).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64)), *batch.columns[2:]],
                                  names=["doc_id", "fp", *batch.schema.names[2:]])

    more = [F.sha2(text, 256).alias("digest")] if digest else []
    ids = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), *more)
    return map_arrow(ids, work, "doc_id long, fp long" + (", digest string" if digest else ""))


# parts and thresholds

def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints, and how often bits i and j are both set, over all rows."""
    def work(batches):
        only_memory_of("simhash")
        total, n = np.zeros((64, 64)), 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(values), 8192):
                part = values[at:at + 8192].astype(np.int64)
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
                total, n = total + bits.T @ bits, n + len(bits)
        yield pa.record_batch([pa.array(range(4097), pa.int32()), pa.array([*total.ravel().astype(np.int64).tolist(), n])], names=["at", "n"])

    rows = map_arrow(fps.select("fp"), work, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()  # 4097 rows
    counts = np.zeros(4097, np.int64)
    for r in rows:
        counts[r["at"]] = r["n"]
    return int(counts[4096]), counts[:4096].reshape(64, 64)


def correlated_parts(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """64 bits in ``parts`` groups of nearly equal size; each grows by the bit that is most correlated with it."""
    f = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(f * (1 - f), 1e-9))
    corr = np.abs((both / max(n, 1) - np.outer(f, f)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    free, out = set(range(64)), []
    for i in range(parts):
        size = len(free) // (parts - i)
        rest = sorted(free)
        group = [max(rest, key=lambda b: (corr[b, rest].sum(), -b))]
        while len(group) < size:
            rest = sorted(free - set(group))
            group.append(max(rest, key=lambda b: (corr[b, group].sum(), -b)))
        free -= set(group)
        out.append(sorted(group))
    return out


def near_share(f: np.ndarray, most: int) -> np.ndarray:
    """For t = 0 to ``most``: the share of random pairs that differ in at most t bits of frequencies ``f``."""
    dist = np.zeros(most + 2)
    dist[0] = 1
    for p in 2 * f * (1 - f):
        moved = dist * p
        dist = dist * (1 - p)
        dist[1:] += moved[:-1]
        dist[-1] += moved[-1]
    return np.cumsum(dist[:most + 1])


def allocate(n: int, both: np.ndarray, distance: int, key_cost: float = 1.0, pair_cost: float = 0.02) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each probed part: the cheapest allocation over 2 to distance + 1 parts."""
    f = np.diag(both) / max(n, 1)
    best: tuple[float, list] | None = None
    for count in range(min(2, distance + 1), distance + 2):
        groups = correlated_parts(n, both, count)
        table: dict[int, tuple[float, list]] = {0: (0.0, [])}  # by the sum of t + 1 so far
        for bits in groups:
            shares, grown = near_share(f[bits], distance), {}
            for used, (cost, chosen) in table.items():
                for t in range(-1, distance - used + 1):
                    keys = n * sum(comb(len(bits), k) for k in range(t + 1))
                    pairs = n * n / 2 * shares[t] if t >= 0 else 0.0
                    c = cost + key_cost * keys + pair_cost * pairs
                    if used + t + 1 not in grown or c < grown[used + t + 1][0]:
                        grown[used + t + 1] = (c, [*chosen, (bits, t)])
            table = grown
        if best is None or table[distance + 1][0] < best[0]:
            best = table[distance + 1]
    return [(bits, t) for bits, t in best[1] if t >= 0]


# buckets and links

def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def probes(fps: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """(part, value, fp, home): a row for each bucket that a fingerprint goes to."""
    out = None
    for i, (bits, t) in enumerate(parts):
        own = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))
        flips = [_signed(sum(1 << b for b in some)) for k in range(t + 1) for some in combinations(bits, k)]
        rows = fps.select("fp", F.explode(F.array(*[F.lit(x) for x in flips])).alias("flip")) if t else fps.select("fp", F.lit(0).alias("flip"))
        rows = rows.select(F.lit(i).alias("part"), own.bitwiseXOR(F.col("flip")).cast("long").alias("value"), "fp",
                           (F.col("flip") == 0).alias("home"))
        out = rows if out is None else out.unionByName(rows)
    return out


def forest(fp: np.ndarray, home: np.ndarray, side: np.ndarray, first: int, second: int, distance: int) -> list[tuple[int, int]]:
    """Links that connect what the pairs of a bucket connect: pairs at most ``distance`` bits apart with one
    at home, between the rows of block ``first`` and those of ``second``."""
    pairs = []
    a = np.flatnonzero(side == first)
    b = a if first == second else np.flatnonzero(side == second)
    for at in range(0, len(a), 512):
        rows = a[at:at + 512]
        near = np.bitwise_count(fp[rows, None] ^ fp[None, b]) <= distance
        near &= home[rows, None] | home[None, b]
        i, j = np.nonzero(near)
        i, j = rows[i], b[j]
        pairs.append(np.stack([i, j])[:, i < j] if first == second else np.stack([i, j]))
    i, j = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
    if len(i) <= len(fp):
        return list(zip(fp[i].tolist(), fp[j].tolist()))
    label = np.arange(len(fp))
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        low = low[low]
        if (low == label).all():
            break
        label = low
    return [(int(fp[x]), int(fp[y])) for x, y in enumerate(label.tolist()) if x != y]


def links(fps: DataFrame, distance: int = 3, block: int = 2048) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints ``fps`` as all pairs within ``distance`` would."""
    n, both = bit_counts(fps)
    parts = allocate(n, both, distance)
    rows = probes(fps, parts)
    hot = (rows.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
           .select("part", "value", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    rows = rows.join(hot, ["part", "value"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("side", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("part", "value", F.least("side", "other").alias("first"), F.greatest("side", "other").alias("second"),
                       "side", "fp", "home")
    bucket = ["part", "value", "first", "second"]

    def work(batches):
        only_memory_of("simhash")
        held: list[np.ndarray] = []  # columns of the bucket that the batches so far end in

        def columns(batch):
            return [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]

        def found(cols, ends):
            a, b = [], []
            for s, e in ends:
                if e - s > 1:
                    for x, y in forest(cols[5][s:e], cols[6][s:e].astype(bool), cols[4][s:e], int(cols[2][s]), int(cols[3][s]), distance):
                        a.append(x)
                        b.append(y)
            return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            cols = columns(batch)
            if not len(cols[0]):
                continue
            if held:
                cols = [np.concatenate([x, y]) for x, y in zip(held, cols)]
            new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0)) + 1
            edges = [0, *new.tolist()]
            yield found(cols, zip(edges, edges[1:]))
            held = [c[edges[-1]:] for c in cols]
        if held:
            yield found(held, [(0, len(held[0]))])

    dealt = rows.repartition(*[F.col(c) for c in bucket]).sortWithinPartitions(*bucket)
    return map_arrow(dealt, work, "a long, b long")


def rooted(prints: DataFrame, distance: int = 3) -> DataFrame:
    """``prints`` with ``component``, a fingerprint that stands for the component, and ``component_id``."""
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    found = components(written(links(distinct.select("fp"), distance), "simhash-links"))
    root = (distinct.join(found.select(F.col("node").alias("fp"), "component"), "fp", "left")
            .withColumn("component", F.coalesce("component", "fp")))
    root = written(root, "roots")
    lowest = root.groupBy("component").agg(F.min("low").alias("component_id"))
    of = written(root.join(lowest, "component").select("fp", "component", "component_id"), "component-of")
    return prints.join(of, "fp")


def simhash_components(docs: DataFrame, shingle: int = 3, distance: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``; component_id is the smallest doc_id that links reach.

    Null and empty texts and texts without words have fingerprint 0, which links like any other.
    Repeated rows are equal fingerprints, so one component. A null doc_id is never the smallest
    unless its component has no other. An empty table gives no rows; further columns are not looked at.
    """
    prints = written(fingerprints(docs, shingle, key, text), "fingerprints")
    return rooted(prints, distance).select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row of each component of ``docs``, that of its smallest doc_id, of rows that share this id or
    have none the one with the smallest text; all columns as they came.

    A component's candidates are told by their id and the SHA-256 of their text, as the id alone, null or
    shared, may stand for texts of several components."""
    found = rooted(written(fingerprints(docs, shingle, digest=True), "fingerprints"), distance)
    keep = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("__kept"), F.col("digest").alias("__digest"), F.col("component").alias("__component")).distinct()
    first = Window.partitionBy("__component").orderBy(F.col("text").asc_nulls_last(), *[F.col(c).cast("string") for c in docs.columns if c != "text"])
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("__kept")) & F.sha2(docs["text"], 256).eqNullSafe(F.col("__digest"))
    out = docs.join(keep, same).withColumn("__first", F.row_number().over(first))
    return out.where("__first = 1").select(*docs.columns)


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    """All documents; 3-word shingles, links at 3 bits or fewer."""
    found = simhash_components(read_table(spark, sf_dir, "documents"), 3, 3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
