"""Sharding by proportional stratified interleaving (operator 9).

Rows are shuffled by a seeded hash and ranked within their source; a row's fractional rank
(rank + 1/2) / (rows of its source) spreads each source evenly over 0 to 1. Sorted by
fractional rank and cut into equal runs, every shard holds the mixture of the whole.

Neither of the two orders is made in one task. Both sort keys are uniform by construction
(the hash, the fractional rank), so equal slices of their range hold nearly equal numbers of
rows, whatever the sizes of the sources: a row's rank is the count of the slices before its
own plus its rank within the slice. A source with a third of all rows has as many slices
as any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acct_health.llm.common import group_key, read_table, running_before


def interleaved_shards(docs: DataFrame, shards: int = 16, seed: int = 9, key: str = "doc_id", text: str = "text",
                       source: str = "source", rows_per_slice: int = 512) -> DataFrame:
    """doc_id, source, size, text_crc32, shard, slot of every row of ``docs``.

    The law is ``rows``: counts of two shards differ by one at most. Null text has size 1
    (no bytes, plus 1) and the crc32 of nothing, 0; rows with a null source form a source of
    their own; rows that repeat (equal ids too) are rows like any other, each with a slot; rows
    equal in hash and id are ordered by text_crc32, and are the same row if that is equal too.
    An empty table gives no rows. Further columns are not looked at.
    """
    base = docs.select(
        F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"), group_key(source).alias("stratum"),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 1).alias("h"))  # 63 bits
    rows = docs.count()
    slices = max(1, -(-rows // rows_per_slice))

    # rank in the source: slices of the hash's range
    base = base.withColumn("slice", F.shiftright(F.shiftright("h", 32) * F.lit(slices), 31))
    counts = base.groupBy("stratum", "slice").agg(F.count(F.lit(1)).alias("n"))
    counts = running_before(counts, ["stratum"], "slice", "n", "before")
    totals = counts.groupBy("stratum").agg(F.sum("n").alias("stratum_rows"))
    counts = counts.join(totals, "stratum").select("stratum", "slice", "before", "stratum_rows")
    in_slice = Window.partitionBy("stratum", "slice").orderBy("h", "doc_id", "text_crc32", "size")
    spread = (base.join(counts, ["stratum", "slice"])
              .withColumn("at", (F.row_number().over(in_slice) + F.col("before") - F.lit(0.5)) / F.col("stratum_rows"))
              .drop("slice", "before", "stratum_rows"))

    # rank in all: slices of the fractional rank's range
    spread = spread.withColumn("slice", F.least(F.floor(F.col("at") * slices), F.lit(slices - 1)).cast("long"))
    ahead = running_before(spread.groupBy("slice").agg(F.count(F.lit(1)).alias("n")).withColumn("all", F.lit(0)),
                           ["all"], "slice", "n", "before").select("slice", "before")
    across = Window.partitionBy("slice").orderBy("at", "stratum", "h", "doc_id", "text_crc32", "size")
    placed = (spread.join(ahead, "slice")
              .withColumn("rank", F.row_number().over(across) - 1 + F.col("before"))
              .withColumn("shard", F.expr(f"rank * {shards} div {max(rows, 1)}").cast("int")))
    start = F.expr(f"(shard * {rows}L + {shards - 1}) div {shards}")
    return placed.select("doc_id", "source", "size", "text_crc32", "shard", (F.col("rank") - start).cast("long").alias("slot"))


def op9_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15 by the law ``rows``; grown_shard is null under that law."""
    placed = interleaved_shards(read_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "source")
