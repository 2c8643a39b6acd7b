"""Benchmark decontamination by canonical templates (operator 10).

A text becomes a row of template tokens: white-space-separated words, lower-cased, without the
punctuation around them; a number is ``<number>``, a unit after a number ``<unit:kind>``, a name
``<name>``: a capitalised word that doesn't begin a sentence, or one of a few common first names.
Windows of ``window`` template tokens (a shorter item: all of it) are joined by equality of
their template and, by the same join, of their plain lower-cased words, which are a template without slots:
a passage that is copied word for word is found whatever its case, its place in a sentence and its share of
placeholders. A document window that joins brings what stands in its slots. The windows
whose slots are equal are hits by themselves. Those with changed slots that line a document up with an item
at one offset are judged together: an item's slot value must stand for one value of the document
throughout, and two names for two. So a passage with other numbers and names is caught, one that
merely shares a template with other relations isn't, and an edit further on hides no copy.

Before anything is shuffled, document windows are held against a bitmap of fixed size of the
benchmark's window hashes; the join on the templates themselves then removes what only
the bitmap let pass. Equal benchmark texts are one item (the smallest item_id).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acct_health.llm.common import map_arrow, only_memory_of, read_table, written

WINDOW = 8
LITERALS = 0.6  # share of a window's tokens that must be no placeholder
BITMAP_BITS = 24
REMEMBERED = 300_000
RUN = 1 << 16  # words of a text looked at together

# Units by kind and common first names.
UNITS = {
    "length": "m meter meters metre metres km kilometer kilometers kilometre kilometres cm centimeter centimeters mm "
              "millimeter millimeters mile miles foot feet ft inch inches yard yards".split(),
    "mass": "g gram grams kg kilogram kilograms mg milligram milligrams pound pounds lb lbs ounce ounces oz ton tons tonne tonnes".split(),
    "time": "second seconds minute minutes min hour hours day days week weeks month months year years".split(),
    "money": "dollar dollars cent cents euro euros pound-sterling pence".split(),
    "volume": "l liter liters litre litres ml milliliter milliliters gallon gallons cup cups pint pints".split(),
    "share": "percent percentage %".split(),
}
NAMES = set("alice bob carol carlos david emma james john julia kevin laura lisa maria mark mary michael natalia nina olivia "
            "paul peter robert sam sarah susan thomas tom weng".split())
KIND_OF_UNIT = {word: kind for kind, words in UNITS.items() for word in words}
EDGE = re.compile(r"^[^\w%$€£+-]+|[^\w%]+$")
NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,]*%?")
LITERAL, NAME, NUMBER_SLOT, UNIT, CAPITAL, EMPTY = range(6)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))


HASH_OF = {NAME: _hash("<name>"), NUMBER_SLOT: _hash("<number>")}


class Lexicon:
    """What is known of raw words by themselves, kept up to a bound: a matter of speed alone."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.index: dict[str, int] = {}
        self.words: list[str] = []
        self.kinds = np.zeros(1024, np.int8)
        self.plain = np.zeros(1024, np.uint64)
        self.unit = np.zeros(1024, np.uint64)
        self.ends = np.zeros(1024, bool)

    def _add(self, raw: str) -> None:
        common = raw.isalpha() and raw.islower()
        core = raw if common else EDGE.sub("", raw)
        low = core.lower()
        if common:
            kind = UNIT if low in KIND_OF_UNIT else LITERAL
        elif not core:
            kind = EMPTY
        elif NUMBER.fullmatch(core):
            kind = NUMBER_SLOT
        elif low in NAMES and core[0].isupper():
            kind = NAME
        elif low in KIND_OF_UNIT:
            kind = UNIT
        elif core[0].isupper() and core[1:].islower():
            kind = CAPITAL
        else:
            kind = LITERAL
        at = len(self.words)
        if at == len(self.kinds):
            self.kinds, self.plain, self.unit, self.ends = (np.concatenate([a, np.zeros_like(a)]) for a in (
                self.kinds, self.plain, self.unit, self.ends))
        self.index[raw] = at
        self.words.append(low)
        self.kinds[at] = kind
        self.plain[at] = _hash(low)
        if kind == UNIT:
            self.unit[at] = _hash(f"<unit:{KIND_OF_UNIT[low]}>")
        self.ends[at] = raw[-1] in ".!?:;\"”»" or (not core and any(c in ".!?:;" for c in raw))

    def look(self, raws: list[str]) -> tuple[np.ndarray, ...]:
        if len(self.words) > REMEMBERED:
            self.clear()
        for raw in set(raws).difference(self.index):
            self._add(raw)
        at = np.fromiter(map(self.index.__getitem__, raws), np.int64, len(raws))
        return at, self.kinds[at], self.plain[at], self.unit[at], self.ends[at]


_LEXICON = Lexicon()


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * MULTIPLIER
    h += b
    h ^= h >> np.uint64(29)
    return h


def _mixed(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash, never 0, of each ``size`` neighbours in ``hashes``, joined of those of 1, 2, 4 ... neighbours."""
    n = len(hashes) - size + 1
    h, done, step = np.full(n, size, np.uint64), 0, 1
    while True:
        if size & step:
            h = _join(h, hashes[done:done + n])
            done += step
        if done == size:
            return np.maximum(h, np.uint64(1))
        hashes, step = _join(hashes[:-step], hashes[step:]), 2 * step


class Template:
    """Words, kinds and hashes of the template tokens of a run of words."""

    def __init__(self, raws: list[str], begins: bool = True):
        at, kinds, plain, unit, ends = _LEXICON.look(raws)
        solid = np.flatnonzero(kinds != EMPTY)
        self.solid, self.ends = solid, ends
        # a word begins a sentence if one of the raw words since the last solid one ends one
        closed = np.concatenate([[0], np.cumsum(ends)])
        before = np.concatenate([[-1], solid[:-1]]) if len(solid) else solid
        opens = closed[solid] > np.where(before < 0, 0, closed[before])
        if begins and len(opens):
            opens[0] = True
        self.at, k = at[solid], kinds[solid].copy()
        k[(k == CAPITAL) & ~opens] = NAME
        k[k == CAPITAL] = LITERAL
        after_number = np.concatenate([[False], k[:-1] == NUMBER_SLOT]) if len(k) else np.zeros(0, bool)
        k[(k == UNIT) & ~after_number] = LITERAL
        self.kinds = k
        self.plain = plain[solid]
        self.hashes = np.where(k == UNIT, unit[solid], self.plain)
        for kind, h in HASH_OF.items():
            self.hashes[k == kind] = h

    def __len__(self):
        return len(self.at)

    def windows(self, size: int) -> np.ndarray:
        """The hash of each window of ``size`` tokens; 0 where placeholders prevail."""
        return self.keys(size)[0]

    def keys(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each window of ``size`` tokens the hash of its template, 0 where placeholders prevail, and
        that of its plain words, 0 where it has no placeholder: there its template is its plain words."""
        n = len(self) - size + 1
        if n < 1:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        literal = np.concatenate([[0], np.cumsum(self.kinds == LITERAL)])
        literal = literal[size:] - literal[:-size]
        template, exact = _mixed(self.hashes, size), _mixed(self.plain, size)
        template[literal < LITERALS * size] = 0
        exact[literal == size] = 0
        return template, exact

    def shown(self, start: int, size: int, exact: bool = False) -> tuple[str, list[str]]:
        """The template of a window, and the contents of its slots as ``kind:value``. ``exact``: its plain words, no slots."""
        text, slots = [], []
        for j in range(start, start + size):
            word, kind = _LEXICON.words[int(self.at[j])], int(self.kinds[j])
            if kind == LITERAL or exact:
                text.append(word)
                continue
            text.append({NAME: "<name>", NUMBER_SLOT: "<number>"}.get(kind) or f"<unit:{KIND_OF_UNIT[word]}>")
            slots.append(f"{'-ndu'[kind]}:{word}")
        return " ".join(text), slots


def runs(text: str, overlap: int) -> Iterator[tuple[int, Template]]:
    """Templates of runs of a text's words that overlap by ``overlap`` - 1 tokens at least, with the number of the first token.

    A run begins with the last tokens of what was before it, however many words without a token lie between them: so its first windows,
    and what tells their kinds, are whole."""
    raws, carried, done = text.split(), [], 0
    for first in range(0, max(len(raws), 1), RUN):
        now = carried + raws[first:first + RUN]
        t = Template(now, begins=not done)
        yield done, t
        last, carried = t.solid[-(overlap + 2):].tolist(), []
        for s, following in zip(last, [*last[1:], len(now)]):
            carried.append(now[s])
            if t.ends[s + 1:following].any():  # a sentence ends in the words between
                carried.append(".")
        done += len(t) - len(last)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, at, size, h, template, slots) of the windows of the distinct benchmark texts."""
    items = benchmark.where(F.col(text).isNotNull()).groupBy(F.col(text).alias("text")).agg(F.min(F.col(key).cast("long")).alias("item_id"))

    def work(batches):
        for batch in batches:
            for item, t in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist()):
                seen = set()
                for done, template in runs(t, window):
                    size = min(window, len(template)) if not done else window
                    if not size:
                        continue
                    rows = []
                    for exact, hashes in enumerate(template.keys(size)):
                        for i, h in enumerate(hashes.tolist()):
                            if h and (done + i, exact) not in seen:
                                seen.add((done + i, exact))
                                shown, slots = template.shown(i, size, bool(exact))
                                rows.append({"item_id": item, "at": done + i, "size": size, "h": h - (1 << 64) if h >> 63 else h,
                                             "template": shown, "slots": slots})
                    yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("item_id", pa.int64()), ("at", pa.int64()), ("size", pa.int32()), ("h", pa.int64()),
                        ("template", pa.string()), ("slots", pa.list_(pa.string()))])
    return map_arrow(items.select("text", "item_id"), work,
                     "item_id long, at long, size int, h long, template string, slots array<string>")


def bitmap(windows: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """2**bits bits, those of the windows' hashes set. What comes to the driver is bounded by the bitmap."""
    place = F.col("h").bitwiseAND((1 << bits) - 1)
    words = windows.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast((h & {(1 << bits) - 1}L) & 63 AS INT))")).alias("set")).collect()
    out = np.zeros(1 << bits - 6, np.int64)
    for r in words:
        out[r["word"]] = r["set"]
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool) if words else np.zeros(1 << bits, bool)


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text",
                 item: str = "item_id") -> DataFrame:
    """doc_id, text_hash, item_id, n_windows, first_word, same_slots for each row of ``docs`` and each item it holds a passage of.

    A row whose text is null or empty holds none. Repeated rows give a row each. Items that are null
    or empty give no windows, windows of mostly placeholders count by their plain words alone; an empty table on either side gives no rows.
    same_slots: at some offset all windows that count have equal slots. item_id stands for all items of equal text. A null doc_id stays null. Further columns are not looked at.
    """
    known = written(benchmark_windows(benchmark, window, item), "benchmark-windows")
    sizes = sorted(r["size"] for r in known.select("size").distinct().collect())  # at most ``window``
    spark = docs.sparkSession
    marked = spark.sparkContext.broadcast(np.packbits(bitmap(known)))  # of fixed size

    def work(batches):
        only_memory_of("decontamination", _LEXICON.clear)
        hit = np.unpackbits(marked.value).astype(bool)
        low = np.uint64((1 << BITMAP_BITS) - 1)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part, rows = batch.slice(i, 1024), []
                for doc, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    row += 1
                    for done, template in runs(t, window) if t and sizes else ():
                        for size in sizes:
                            for exact, h in enumerate(template.keys(size)):
                                some = np.flatnonzero(h)
                                for at in some[hit[h[some] & low]].tolist():
                                    shown, slots = template.shown(at, size, bool(exact))
                                    rows.append({"row": row, "doc_id": doc, "text_hash": xxhash.xxh64_intdigest(t.encode(), 42) - (1 << 63),
                                                 "at": done + at, "size": size, "template": shown, "slots": slots})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("at", pa.int64()), ("size", pa.int32()),
                        ("template", pa.string()), ("slots", pa.list_(pa.string()))])
    found = map_arrow(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), work,
                      "row long, doc_id long, text_hash long, at long, size int, template string, slots array<string>")
    theirs = known.select("template", "size", "item_id", F.col("at").alias("item_at"), F.col("slots").alias("item_slots"))
    pairs = found.join(theirs, ["template", "size"])
    changed = F.col("slots") != F.col("item_slots")
    lined = pairs.groupBy("row", "doc_id", "text_hash", "item_id", (F.col("at") - F.col("item_at")).alias("offset")).agg(
        F.collect_set(F.when(~changed, F.col("at"))).alias("equal"), F.collect_set(F.when(changed, F.col("at"))).alias("changed"),
        F.flatten(F.collect_set(F.when(changed, F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d"))))).alias("slots"))
    slots = F.array_distinct("slots")
    one = lambda a, side: F.size(F.array_distinct(F.transform(a, lambda s: s[side])))
    names = F.filter(slots, lambda s: s["i"].startswith("n:"))
    agree = (one(slots, "i") == F.size(slots)) & (one(names, "d") == F.size(names))
    # windows with equal slots are hits by themselves
    lined = lined.withColumn("hits", F.when(agree, F.array_union("equal", "changed")).otherwise(F.col("equal"))).where(F.size("hits") > 0)
    lined = lined.select("row", "doc_id", "text_hash", "item_id", F.size("hits").alias("n_windows"), F.array_min("hits").alias("first_word"),
                         (F.size("hits") == F.size("equal")).alias("same"))
    return lined.groupBy("row", "doc_id", "text_hash", "item_id").agg(
        F.sum("n_windows").alias("n_windows"), F.min("first_word").alias("first_word"), F.max("same").alias("same_slots")).drop("row")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a passage of the benchmark; all columns as they came."""
    bad = contaminated(docs, benchmark).select(F.col("doc_id").alias("__bad"), F.col("text_hash").alias("__bad_text")).distinct()
    # the hash in ``contaminated`` is XXH64 with seed 42, shifted by 2**63; Spark's is the same, signed
    mine = F.xxhash64("text").bitwiseXOR(F.lit(-(1 << 63)))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("__bad")) & (mine == F.col("__bad_text"))
    return docs.join(bad, same, "left_anti")


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    """All documents against the whole benchmark: a row for each document and item it holds a passage of."""
    found = contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_windows", "first_word", "same_slots")
