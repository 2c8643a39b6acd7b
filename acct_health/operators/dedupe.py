"""Row deduplication: exact full-row duplicates and one-row-per-key selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


DIGEST_BITS = 26  # log2 of the bits of the map of repeated digests: as a table 2**20 rows of two numbers at most
TIED = "__tied"  # see earliest_or_tied


def row_digest(columns: Sequence[str]) -> tuple[Column, Column]:
    """128 bits of a row as two whole numbers. Nulls count: the hashes leave them out, so which columns are null is hashed too."""
    cols = [F.col(f"`{c}`") for c in columns]
    nulls = F.concat(*[c.isNull().cast("int").cast("string") for c in cols]) if cols else F.lit("")
    return F.xxhash64(nulls, *cols), F.xxhash64(F.lit(1), *reversed(cols), nulls)


def word_of(place: Column, bits: int) -> Column:
    """The word of a map of 2**``bits`` bits that holds the bit of a whole number; within it the number's lowest 6 bits tell the bit."""
    return F.shiftright(place.bitwiseAND((1 << bits) - 1), 6)


def bit_map(rows: DataFrame, place: str, bits: int) -> DataFrame:
    """(__word, __set): a map of 2**``bits`` bits, those of the numbers in column ``place`` set; words without a bit have no row."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col(place).bitwiseAND(63).cast("int"))
    return rows.groupBy(word_of(F.col(place), bits).alias("__word")).agg(F.bit_or(bit).alias("__set"))


def in_map(rows: DataFrame, column: str, place: Column, bits: int) -> Column:
    """Whether the bit of ``place`` is set in a map of 2**``bits`` bits, those of the numbers in ``column`` of ``rows`` set. The map is a scalar
    subquery, so a filter on it goes below joins whose columns ``place`` doesn't read."""
    none = rows.sparkSession.range(1 << bits - 6).select(F.col("id").alias("__word"), F.lit(0).cast("long").alias("__set"))
    words = bit_map(rows, column, bits).unionByName(none).groupBy("__word").agg(F.bit_or("__set").alias("__set"))
    whole = words.agg(F.sort_array(F.collect_list(F.struct("__word", "__set"))).alias("__map")).select(F.col("__map.__set"))
    word = F.get(whole.scalar(), word_of(place, bits).cast("int"))
    return F.getbit(word, place.bitwiseAND(63).cast("int")) == 1


def with_repeated(df: DataFrame, flag: str = "__repeated", digest=row_digest, bits: int = DIGEST_BITS) -> DataFrame:
    """Add ``flag``: whether a row may be equal to another one, and is not surely alone.

    Only digests are shuffled, and of these only the first number, as rows that share it and differ are but flagged; those that occur twice
    set a bit in a map of 2**``bits`` bits, which is broadcast (its size is fixed). Where
    far more digests repeat than the map has bits, most rows are flagged, which costs work later but loses nothing.
    """
    one, _ = digest(df.columns)
    twice = df.select(one.alias("__a")).groupBy("__a").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    words = bit_map(twice, "__a", bits)
    told = df.withColumn("__d", one).withColumn("__at", word_of(F.col("__d"), bits))
    told = told.join(F.broadcast(words), told["__at"] == words["__word"], "left")
    hit = F.coalesce(F.getbit(F.col("__set"), F.col("__d").bitwiseAND(63).cast("int")) == 1, F.lit(False))
    return told.withColumn(flag, hit).drop("__d", "__at", "__word", "__set")


def drop_exact_duplicates(df: DataFrame, digest=row_digest) -> DataFrame:
    """One row per identical full row (NULLs compare equal).

    Rows whose digest occurs once pass as they are; the others are compared whole, by a hash aggregate over all columns with a map-side
    partial step. So whole rows are shuffled only where digests repeat, and a row repeated millions of times is collapsed before.
    ``df`` is read three times; of columns that can't be hashed or compared (maps) this is no more able than ``distinct``.
    """
    told = with_repeated(df, digest=digest)
    again = told.where("__repeated").drop("__repeated").dropDuplicates()
    return told.where("not __repeated").drop("__repeated").unionByName(again)


# A packed text ends each value by the first of these; the second begins what stands for a null or, within a value, for one of both.
END, MARK = "\x00", "\x01"


def pack_texts(columns: Sequence[str]) -> Column:
    """One text of text columns that sorts as they do one after another, nulls first, and from which ``unpack_texts`` gets them back.

    A row of many short texts takes 8 bytes and padding for each; packed, sorts and shuffles carry little but the texts themselves."""
    def one(c: str) -> Column:
        safe = F.replace(F.replace(F.col(f"`{c}`"), F.lit(MARK), F.lit(MARK + "\x02")), F.lit(END), F.lit(MARK + MARK))
        return F.coalesce(F.concat(F.lit("\x02"), safe, F.lit(END)), F.lit(MARK + END))

    return F.concat(*[one(c) for c in columns])


def unpack_texts(df: DataFrame, packed: str, columns: Sequence[str]) -> DataFrame:
    """Replace the column ``packed`` by the text columns it was made of."""
    values = f"{packed}_values"

    def one(i: int) -> Column:
        v = F.col(values)[i]
        plain = F.replace(F.replace(F.substr(v, F.lit(2)), F.lit(MARK + MARK), F.lit(END)), F.lit(MARK + "\x02"), F.lit(MARK))
        return F.when(v != MARK, plain)

    split = df.withColumn(values, F.split(packed, END))
    return split.withColumns({c: one(i) for i, c in enumerate(columns)}).drop(packed, values)


def keep_earliest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[Column],
    tie_break: Sequence[str] | None = None,
    pack: bool = False,
) -> DataFrame:
    """Keep the first row per ``key`` under ``order`` (e.g. a date ASC NULLS LAST).

    ``tie_break`` (default: every other column, ascending) makes the choice total, hence
    reproducible. Because the order is total, rows that are exact duplicates collapse
    too, so a preceding ``drop_exact_duplicates`` is redundant; callers may fuse both.

    ``row_number() == 1`` is planned with ``WindowGroupLimit`` on both sides of the
    shuffle: each map task keeps only its best row per key, so a hot key costs one row
    per map partition in the exchange, not all of its rows.

    With ``pack``, text columns that stand together in ``tie_break`` are sorted and shuffled as one text, in the
    same order; ``order`` must not name them then.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns, kinds = df.columns, dict(df.dtypes)
    if tie_break is None:
        tie_break = [c for c in columns if c not in keys]
    runs: list[list[str] | str] = []  # texts that stand together, and other columns
    for c in tie_break:
        text = pack and kinds[c] == "string" and c not in keys
        if text and runs and isinstance(runs[-1], list):
            runs[-1].append(c)
        else:
            runs.append([c] if text else c)
    packs = {f"__pack{i}": r for i, r in enumerate(runs) if isinstance(r, list)}
    by = [f"__pack{i}" if isinstance(r, list) else r for i, r in enumerate(runs)]
    if packs:
        df = df.withColumns({p: pack_texts(r) for p, r in packs.items()}).drop(*[c for r in packs.values() for c in r])
    w = Window.partitionBy(*keys).orderBy(*order, *[F.col(c).asc_nulls_first() for c in by])
    df = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
    for p, r in packs.items():
        df = unpack_texts(df, p, r)
    return df.select(*[f"`{c}`" for c in columns]) if packs else df


def keep_earliest_by_lead(
    df: DataFrame,
    key: str,
    order: Sequence[Column],
    tie_break: Sequence[str],
    lead: int,
    bits: int = DIGEST_BITS + 1,
) -> DataFrame:
    """The rows of ``keep_earliest_per_key``, for plans that read few of the columns: most rows are told apart by the first ``lead`` tie breaks.

    Where a key's rows differ in these, the others can't matter, so they are neither computed nor shuffled unless they are read. Keys with
    two rows equal in them (found by digests, as in ``with_repeated``) set a bit in a map of fixed size; the rows of all keys whose bit is set
    are compared in the whole order. A bit that is set for nothing costs work and changes no row. ``df`` is read three times; the map is
    a scalar subquery in a filter on the key alone, which Catalyst pushes below what is computed for whole rows.
    """
    first = list(tie_break[:lead])
    one, two = row_digest([key, *first])
    place = F.xxhash64(F.col(key))
    twice = (df.select(place.alias("__p"), one.alias("__a"), two.alias("__b")).groupBy("__p", "__a", "__b")
             .agg(F.count(F.lit(1)).alias("__n")).where("__n > 1"))
    tied = in_map(twice, "__p", place, bits)
    apart = keep_earliest_per_key(df.where(~tied), key, order, tie_break=first)
    return apart.unionByName(keep_earliest_per_key(df.where(tied), key, order, tie_break=tie_break, pack=True))


def key_text(key: str) -> Column:
    """A text for each value of a key, null among them."""
    return F.coalesce(F.concat(F.lit("s"), F.col(key).cast("string")), F.lit("n"))


def earliest_or_tied(df: DataFrame, key: str, order: Sequence[Column], lead: Sequence[str], pack: Sequence[str] = ()) -> DataFrame:
    """The first row per ``key`` under ``order`` and the columns ``lead``, with ``TIED``: null, or ``key_text`` where the key's second row is equal to
    it in these. Such keys are to be looked at again (``earliest_of_keys``).

    As in ``keep_earliest_per_key`` map tasks keep only a key's best rows, two of them, however many are equal. ``df`` is read once. The text columns
    ``pack``, all of which should be read later, are sorted and shuffled as one."""
    columns = df.columns
    if pack:
        df = df.withColumn("__pack", pack_texts(pack)).drop(*pack)
    w = Window.partitionBy(key).orderBy(*order, *[F.col(c).asc_nulls_first() for c in lead])
    best = df.withColumns({"__rn": F.row_number().over(w), "__rank": F.rank().over(w)}).where("__rn <= 2")
    tied = F.max((F.col("__rn") == 2) & (F.col("__rank") == 1)).over(Window.partitionBy(key))
    best = best.withColumn(TIED, F.when(tied, key_text(key))).where("__rn = 1")
    return (unpack_texts(best, "__pack", pack) if pack else best).select(*[f"`{c}`" for c in columns], TIED)


def earliest_of_keys(df: DataFrame, key: str, order: Sequence[Column], tie_break: Sequence[str], tied: DataFrame, bits: int = DIGEST_BITS) -> DataFrame:
    """``keep_earliest_per_key`` of the rows whose ``key_text`` is in the column ``TIED`` of ``tied`` (each once).

    A map of fixed size lets through the rows of these keys and few others, so that only they are shuffled to meet the keys."""
    own = key_text(key)
    near = df.where(in_map(tied.select(F.xxhash64(TIED).alias("__p")), "__p", F.xxhash64(own), bits))
    some = near.join(tied.select(F.col(TIED).alias("__of")), own == F.col("__of"), "left_semi")
    return keep_earliest_per_key(some, key, order, tie_break=tie_break, pack=True)
