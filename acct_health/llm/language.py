"""Language identification by a string kernel (operator 7).

Two texts are as alike as the character n-grams (1 to 3, blended) that both hold:
k(x, y) = |x & y| / sqrt(|x| |y|) over their sets of n-grams. Kernel ridge regression, one class
against the rest, is learned on the Nystroem features that a set of landmark texts spans,
and each class's score is a sum over the landmarks. That sum is linear in the indicator of x's
n-grams, so it is folded into one weight per n-gram and class, and a batch of texts is
scored by one matrix product.

Letters are lower-cased; every run of other characters is one space. Letters that no learned
text holds are one letter, 0.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acct_health.llm.common import map_arrow, only_memory_of, read_table

UNDETERMINED = "und"
PER_LANGUAGE = 256  # learned texts of each language
LANDMARKS = 64  # of these, landmarks
LONGEST = 20_000  # characters: texts up to this length are learned first
SLICES = 64  # of each language, from which learned texts are chosen
RIDGE = 1e-2
SLICE = 1 << 20  # characters of a text looked at together

_TABLES: dict[str, np.ndarray] = {}


def letters() -> np.ndarray:
    """For each code point the lower-cased letter, or 0 if it is no letter."""
    if "letters" not in _TABLES:
        table = np.zeros(sys.maxunicode + 1, np.uint32)
        for i in range(sys.maxunicode + 1):
            c = chr(i)
            if unicodedata.category(c)[0] == "L":
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        _TABLES["letters"] = table
    return _TABLES["letters"]


class Spectrum:
    """Sets of n-grams over an alphabet; number 0 is any other letter, 1 the space."""

    def __init__(self, alphabet: np.ndarray):
        self.size = len(alphabet) + 2
        table = np.ones(sys.maxunicode + 1, np.uint32)
        low = letters()
        known = np.zeros(sys.maxunicode + 1, np.uint32)
        known[alphabet] = np.arange(2, self.size)
        table[low > 0] = known[low[low > 0]]
        self.table = table

    def grams(self, text: str) -> tuple[np.ndarray, bool]:
        """The sorted codes of the n-grams of ``text``, and whether it has a letter."""
        a = self.size
        dense = a ** 3 <= 1 << 24
        seen = np.zeros(a + a * a + a ** 3, bool) if dense else set()
        tail, lettered = np.ones(1, np.int64), False
        for at in range(0, max(len(text), 1), SLICE):
            part = text[at:at + SLICE]
            ids = self.table[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
            if at + SLICE >= len(text):
                ids = np.append(ids, 1)
            ids = np.concatenate([tail, ids])
            lettered = lettered or bool((ids != 1).any())
            ids = ids[np.append(True, (ids[1:] != 1) | (ids[:-1] != 1))]
            two = ids[:-1] * a + ids[1:]
            codes = (ids, a + two, a + a * a + two[:-1] * a + ids[2:])
            for c in codes:
                if dense:
                    seen[c] = True
                else:
                    seen.update(np.unique(c).tolist())
            tail = ids[-2:]
        return (np.flatnonzero(seen) if dense else np.array(sorted(seen), np.int64)), lettered


class Model:
    """Learned languages, the alphabet, and a weight for each n-gram and language."""

    def __init__(self, texts: list[str], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE):
        self.langs = sorted(set(langs))
        low = letters()
        held = [np.unique(low[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)]) for t in texts]
        self.alphabet = np.unique(np.concatenate(held)) if held else np.zeros(0, np.uint32)
        self.alphabet = self.alphabet[self.alphabet > 0]
        if not self.langs:
            return
        spectrum = Spectrum(self.alphabet)
        sets = [spectrum.grams(t)[0] for t in texts]
        taken: dict[str, int] = {}
        marks = []
        for i, lang in enumerate(langs):
            taken[lang] = taken.get(lang, 0) + 1
            if taken[lang] <= landmarks:
                marks.append(i)
        self.vocabulary = np.unique(np.concatenate([sets[i] for i in marks]))
        holds = np.zeros((len(marks), len(self.vocabulary)), np.float32)  # landmark x n-gram
        for k, i in enumerate(marks):
            holds[k, np.searchsorted(self.vocabulary, sets[i])] = 1
        holds /= np.sqrt([[len(sets[i])] for i in marks])
        kernel = np.zeros((len(sets), len(marks)))  # text x landmark
        for i, s in enumerate(sets):
            at = np.searchsorted(self.vocabulary, s)
            at = at[(at < len(self.vocabulary)) & (self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] == s)]
            kernel[i] = holds[:, at].sum(axis=1) / np.sqrt(len(s))
        values, vectors = np.linalg.eigh(kernel[marks])
        good = values > 1e-6 * values.max()
        nystroem = vectors[:, good] / np.sqrt(values[good])
        phi = np.column_stack([kernel @ nystroem, np.ones(len(sets))])
        y = np.where(np.array(langs)[:, None] == np.array(self.langs)[None, :], 1.0, -1.0)
        weigh = np.array([1.0 / langs.count(x) for x in langs])[:, None]  # languages count alike
        penalty = ridge * np.eye(phi.shape[1])
        penalty[-1, -1] = 0
        beta = np.linalg.solve(phi.T @ (weigh * phi) + penalty / len(self.langs), phi.T @ (weigh * y))
        self.weights = (holds.T @ (nystroem @ beta[:-1])).astype(np.float32)  # n-gram x language
        self.bias = beta[-1]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language of each text and a score from 0 to 1: that of its class, -1 to 1, rescaled."""
        if not self.langs:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if not hasattr(self, "spectrum"):
            self.spectrum = Spectrum(self.alphabet)
        langs, scores = [], []
        for at in range(0, len(texts), 256):
            some = texts[at:at + 256]
            found = [self.spectrum.grams(t or "") for t in some]
            holds = np.zeros((len(some), len(self.vocabulary)), np.float32)
            for i, (s, _) in enumerate(found):
                k = np.searchsorted(self.vocabulary, s)
                k = np.minimum(k, len(self.vocabulary) - 1)
                holds[i, k[self.vocabulary[k] == s]] = 1
            got = (holds @ self.weights) / np.sqrt([[len(s)] for s, _ in found]) + self.bias
            for row, (_, lettered) in zip(got, found):
                best = int(row.argmax())
                langs.append(self.langs[best] if lettered else UNDETERMINED)
                scores.append(float(np.clip((row[best] + 1) / 2, 0, 1)) if lettered else 0.0)
        return langs, scores

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "spectrum"}


def held_out(key: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text, modulo 3, is 1."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE, longest: int = LONGEST, key: str = "doc_id", text: str = "text",
          lang: str = "lang") -> Model:
    """A model from at most ``per_language`` texts of each language, chosen by a hash of the id among
    those not held out, texts up to ``longest`` characters first; whole texts are learned."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.lit(7), F.col(key)).alias("h"),
                       (F.length(text) > longest).alias("late"), held_out(key).alias("out"))
    rows = rows.where("NOT out AND text IS NOT NULL AND lang IS NOT NULL")
    # first within slices of a language, so that no task meets the candidates of all tasks for a large one
    sliced = F.row_number().over(Window.partitionBy("lang", "slice").orderBy("late", "h", "text"))
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("h", "text"), F.lit(SLICES))).withColumn("n", sliced).where(F.col("n") <= per_language)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("late", "h", "text"))
    chosen = rows.withColumn("n", rank).where(F.col("n") <= per_language).select("lang", "n", "text").collect()
    chosen.sort(key=lambda r: (r["lang"], r["n"]))
    return Model([r["text"] for r in chosen], [r["lang"] for r in chosen])


def identified(docs: DataFrame, model: Model, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score; a column that has one of these names already is replaced.

    Null texts and texts without a letter are ``und`` with score 0, as is every text if nothing was
    learned. Equal texts get equal results, whatever the other columns hold; an empty table stays empty.
    """
    spark = docs.sparkSession
    kept = docs.drop(pred, score)
    shared = spark.sparkContext.broadcast(model)  # bounded by the learned sample
    at = kept.columns.index(text)

    def work(batches):
        only_memory_of("language")
        for batch in batches:
            langs, scores = [], []
            for i in range(0, batch.num_rows, 1024):
                a, b = shared.value.predict(batch.column(at).slice(i, 1024).to_pylist())
                langs += a
                scores += b
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names, pred, score])

    schema = kept.withColumns({pred: F.lit("").cast("string"), score: F.lit(0.0)}).schema
    return map_arrow(kept, work, schema)


def op7_language(spark, sf_dir: str) -> DataFrame:
    """All documents; learned from those not held out."""
    docs = read_table(spark, sf_dir, "documents")
    model = learn(docs)
    rows = docs.select("doc_id", held_out().alias("held_out"), F.col("text").alias("text"))
    return identified(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def drop_undetermined(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that op7 calls ``und``: those of null text or without a letter, all if nothing
    was learned. The letter rule alone rejects; text in a language that wasn't learned stays, whatever its score."""
    found = identified(docs, learn(docs), pred="__lang_pred", score="__score")
    return found.where(F.col("__lang_pred") != UNDETERMINED).select(*docs.columns)
