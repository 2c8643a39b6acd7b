"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from acct_health.session import ensure_checkpoint_dir


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str, compression: str = "snappy", rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the lineage ends there,
    so the loss of an executor costs a re-read, not the work before. ``rows_per_file``: for rows of several MB, as the writer
    looks at the size of what it holds only after 100 rows."""
    path = scratch(df.sparkSession, tag)
    df.write.option("compression", compression).option("maxRecordsPerFile", rows_per_file).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``written`` gave and that nothing reads any more."""
    for table in tables:
        sc = table.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def at_most(spark: SparkSession, limits: Mapping[str, int]) -> Iterator[None]:
    """While it holds, these settings of the session, counts or bytes, are no greater than ``limits`` (0 and less: without limit). The
    session's own values hold again afterwards."""
    number = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    before = {name: spark.conf.get(name) for name in limits}
    for name, limit in limits.items():
        value = before[name].strip()
        now = 0 if value.startswith("-") else number(value)
        spark.conf.set(name, str(min(now, limit) if now > 0 else limit))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of DataFrames that are no longer in use, which it does when the driver
    collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per application, so that their Python
    workers can import it wherever it is installed on the driver."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="acct-health-src-"), "acct_health_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


_KEPT: dict[str, Callable[[], None]] = {}  # of this Python worker: how to forget what an operator remembers


def only_memory_of(operator: str, forget: Callable[[], None] = lambda: None) -> None:
    """Spark uses a Python worker again for later stages. What other operators remember there for speed goes, back to the machine, so that one
    operator's bound is the worker's."""
    others = [n for n in _KEPT if n != operator]
    for name in others:
        _KEPT.pop(name)()
    _KEPT[operator] = forget
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # the C library's own, where there is one
            ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_arrow(df: DataFrame, work, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` with this package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(work, schema)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def group_key(column: Column | str) -> Column:
    """A text key under which null is a group of its own."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), c.cast("string")))


def running_before(counts: DataFrame, group: list[str], order: str, value: str, out: str, fan: int = 4096) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same ``group`` with a smaller
    ``order`` (a whole number, unique in its group). Two levels: within runs of ``fan``
    consecutive orders, then over the totals of the runs, so one task orders 1/fan of the rows."""
    fine = counts.withColumn("__run", F.floor(F.col(order) / fan))
    inner = Window.partitionBy(*group, "__run").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    runs = fine.groupBy(*group, "__run").agg(F.sum(value).alias("__total"))
    outer = Window.partitionBy(*group).orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*group, "__run", F.coalesce(F.sum("__total").over(outer), F.lit(0)).alias("__ahead"))
    return (fine.withColumn("__within", F.coalesce(F.sum(value).over(inner), F.lit(0)))
            .join(runs, [*group, "__run"])
            .withColumn(out, (F.col("__within") + F.col("__ahead")).cast("long"))
            .drop("__run", "__within", "__ahead"))
