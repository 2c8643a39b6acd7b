"""Token counts with overlap resynchronisation (operator 5).

Texts up to ``chunk`` characters are encoded at once. A longer one is cut into chunks that
overlap; each chunk is encoded on its own, with offsets, in whatever task it lands. Two
neighbours are spliced at a position in their overlap where both have a token begin and the
character before is white space of ASCII. Such a position is proven stable: this tokeniser's
matches never hold white space, its normaliser composes nothing across it, special strings
hold none, so what follows is encoded alike whatever stands before it, and no token of the
left side reaches it. Documents with a pair that has no such position are cut anew with
overlaps and chunks four times as long, until all align; at last a document is one chunk.

The same positions let whole texts be counted by their runs between white space, each distinct run
encoded by the library once per worker as far as a bounded memory goes.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acct_health.llm.common import map_arrow, read_table, written

REMEMBERED = 400_000
SPACE = " \t\n\r\x0b\x0c"

_COUNTERS: dict[str, Counter] = {}


class Counter:
    """The library's tokeniser in one Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker for each core already
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.known: dict[bytes, int] = {}

    @classmethod
    def at(cls, path: str) -> Counter:
        if path not in _COUNTERS:
            _COUNTERS[path] = cls(path)
        return _COUNTERS[path]

    def counts(self, texts: list[bytes]) -> list[int]:
        """Tokens of each whole text."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        runs = [t.split() for t in texts]  # of bytes: at ASCII white space only
        new = list(set().union(*runs).difference(self.known))
        for at in range(0, len(new), 8192):
            part = new[at:at + 8192]
            got = self.library.encode_batch_fast([r.decode() for r in part], add_special_tokens=False)
            self.known.update(zip(part, map(len, got)))
        return [sum(map(self.known.__getitem__, r)) for r in runs]

    def starts(self, text: str) -> np.ndarray:
        """The character at which each token of ``text`` begins, in token order."""
        e = self.library.encode(text, add_special_tokens=False)
        return np.fromiter((o[0] for o in e.offsets), np.int64, len(e.offsets))


def stable(text: str, starts: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions from ``low`` to ``high`` where a token begins after ASCII white space, and the tokens before each."""
    first = np.searchsorted(starts, max(low, 1), "left")
    last = np.searchsorted(starts, high, "left")
    at, index = np.unique(starts[first:last], return_index=True)
    good = np.array([text[p - 1] in SPACE for p in at.tolist()], bool)
    return at[good], index[good] + first


def _first_pass(docs: DataFrame, path: str, chunk: int, key: str, text: str) -> DataFrame:
    """Counts of the texts up to ``chunk`` characters; the longer ones with their text."""
    def work(batches):
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or b"" for t in part.column(1).cast(pa.large_binary()).to_pylist()]
                # characters are no more than bytes
                long = [len(t) > chunk and len(t.decode()) > chunk for t in texts]
                short = iter(Counter.at(path).counts([t for t, x in zip(texts, long) if not x]))
                counts = [None if x else next(short) for x in long]
                yield pa.record_batch([part.column(0), pa.array(range(row, row + len(texts)), pa.int64()),
                                       pa.array([len(t) for t in texts], pa.int64()), pa.array(counts, pa.int64()),
                                       pa.array([t.decode() if x else None for t, x in zip(texts, long)], pa.string())],
                                      names=["doc_id", "row", "n_bytes", "n_tokens", "text"])
                row += len(texts)

    return map_arrow(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), work,
                     "doc_id long, row long, n_bytes long, n_tokens long, text string")


def _chunks(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(row, number, last, begin, text) of the overlapping chunks of the long texts."""
    step = chunk - overlap

    def work(batches):
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                last = max(0, -(-(len(text) - overlap) // step) - 1)
                for k in range(last + 1):
                    yield pa.record_batch([pa.array([row], pa.int64()), pa.array([k], pa.int64()), pa.array([k == last]),
                                           pa.array([k * step], pa.int64()), pa.array([text[k * step:k * step + chunk]])],
                                          names=["row", "number", "last", "begin", "text"])

    return map_arrow(long.select("row", "text"), work, "row long, number long, last boolean, begin long, text string")


def _encoded_chunks(chunks: DataFrame, path: str, overlap: int) -> DataFrame:
    """Per chunk its tokens, and the stable positions in its two overlaps with the tokens before them."""
    def work(batches):
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for r in rows:
                text, starts = r["text"], Counter.at(path).starts(r["text"])
                left, before_left = stable(text, starts, 0, overlap) if r["number"] else (np.zeros(0, int),) * 2
                right, before_right = stable(text, starts, len(text) - overlap, len(text)) if not r["last"] else (np.zeros(0, int),) * 2
                out.append({"row": r["row"], "number": r["number"], "last": r["last"], "tokens": len(starts),
                            "left": (left + r["begin"]).tolist(), "before_left": before_left.tolist(),
                            "right": (right + r["begin"]).tolist(), "before_right": before_right.tolist()})
            yield pa.RecordBatch.from_pylist(out, schema)

    lists = pa.list_(pa.int64())
    schema = pa.schema([("row", pa.int64()), ("number", pa.int64()), ("last", pa.bool_()), ("tokens", pa.int64()),
                        ("left", lists), ("before_left", lists), ("right", lists), ("before_right", lists)])
    return map_arrow(chunks.repartition("row", "number"), work,
                     "row long, number long, last boolean, tokens long, left array<long>, before_left array<long>, "
                     "right array<long>, before_right array<long>")


def spliced(encoded: DataFrame) -> DataFrame:
    """(row, n_tokens): the tokens of each long text; null where a pair of neighbours has no common stable position."""
    after = encoded.select("row", (F.col("number") - 1).alias("number"), "left", "before_left")
    pair = encoded.where(~F.col("last")).select("row", "number", "right", "before_right").join(after, ["row", "number"])
    at = F.array_min(F.array_intersect("right", "left"))
    # of the tokens up to a splice the left chunk's count, not the right one's
    kept = F.element_at(F.map_from_arrays("right", "before_right"), F.col("at"))
    dropped = F.element_at(F.map_from_arrays("left", "before_left"), F.col("at"))
    gains = pair.withColumn("at", at).select("row", (kept - dropped).alias("gain"), F.col("at").isNull().alias("failed"))
    ends = encoded.where("last").select("row", F.col("tokens").alias("gain"), F.lit(False).alias("failed"))
    total = gains.unionByName(ends).groupBy("row").agg(F.sum("gain").alias("n"), F.max("failed").alias("failed"))
    return total.select("row", F.when(~F.col("failed"), F.col("n")).alias("n_tokens"))


def token_counts(docs: DataFrame, path: str, chunk: int = 32768, overlap: int = 512, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs``, as the library counts the whole text
    without added special tokens. Null text is empty: 0 bytes, 0 tokens. Rows that repeat are
    counted each; an empty table gives no rows. Further columns are not looked at."""
    if not 0 < overlap < chunk:
        raise ValueError("overlap must be between 0 and chunk")
    first = written(_first_pass(docs, path, chunk, key, text), "counted")
    out = first.where("n_tokens IS NOT NULL").select("doc_id", "n_bytes", "n_tokens")
    long = first.where("n_tokens IS NULL")
    while not long.isEmpty():
        counted = written(spliced(_encoded_chunks(_chunks(long, chunk, overlap), path, overlap)), "spliced")
        whole = long.drop("n_tokens").join(counted, "row")
        out = out.unionByName(whole.where("n_tokens IS NOT NULL").select("doc_id", "n_bytes", "n_tokens"))
        long = whole.where("n_tokens IS NULL")
        chunk, overlap = 4 * chunk, 4 * overlap
    return out


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    """All documents by word_bpe_49k.json."""
    import public_tokenizers

    counted = token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)
