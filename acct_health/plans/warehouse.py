"""Staging and star tables, each written when it is first asked for.

The reference materialises its staging and star-schema tables and recomputes only the
mart views. Here a table is written as Parquet under the session's ``spark.checkpoint.dir``
(a shared folder on a cluster) by the first query that reads it, from the table it is built from;
later queries read the files. The first ``FEW_PARTS`` queries of a session that read but few columns write these alone
(``StarTables.part``), as it doesn't pay to render and clean the others for them. Written tables also cut the lineage: a lost executor re-reads files
instead of recomputing the cleaning. A query builds only what it reads: one on the fact
writes staging and fact, or parts of them, no dimension and no copy of the raw text.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import hashlib
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acct_health.operators.dedupe import TIED, earliest_of_keys, earliest_or_tied
from acct_health.plans.cleaning import ID_COLUMNS, clean_orders, raw_sources
from acct_health.plans.scratch import scratch_path
from acct_health.plans.star import CUSTOMER_SOURCES, PRODUCT_SOURCES, build_dim_customer, build_dim_product, build_fact, fact_sources
from acct_health.sources.order_lines import SOURCE_TABLES, order_lines
from acct_health.sources.tables import TableStore

TABLES = ("raw_order_lines", "stg_orders_final", "fact_order_item", "dim_customer", "dim_product")

_WRITTEN: dict[tuple, tuple[tuple, str]] = {}  # (application, input, ceiling, table) -> (stamp of the input, version)
_FACTS: dict[tuple, object] = {}  # what is known of written tables, by their versions
_STORES: dict[str, TableStore] = {}  # by application
_PARTS: dict[tuple, set[tuple]] = {}  # (application, input, ceiling, stamp) -> parts written
DIMENSIONS = {"dim_customer": (build_dim_customer, CUSTOMER_SOURCES), "dim_product": (build_dim_product, PRODUCT_SOURCES)}


def _store(spark: SparkSession) -> TableStore:
    app = spark.sparkContext.applicationId
    if app not in _STORES:
        _STORES[app] = TableStore(spark, scratch_path(spark, "star"))
    return _STORES[app]


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def input_stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and modification times of the source tables' files."""
    out = []
    for table in SOURCE_TABLES:
        where, fs = _file_system(spark, f"{sf_dir}/{table}.parquet")
        out += sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(where))
    return tuple(out)


PARTITION_INPUT = 1 << 21  # bytes of source files whose lines make one shuffle partition: some 90,000 lines of the driver tables
PARTITION_BYTES = 1 << 22  # of shuffled data that adaptive execution puts together: joined lines grow some twenty-fold when they are rendered
PART_INPUT, PART_BYTES = 1 << 24, 1 << 25  # the same for parts of few columns, whose lines stay narrow
MANY_TEXTS = 4  # so many text columns of a part are shuffled as one
FEW_PARTS = 3  # different parts that a session writes before it writes whole tables, which serve all queries to come
METHOD_BYTES = 8000  # the JVM compiles no longer method, it only interprets it


@contextlib.contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """While tables are written, stages whose generated code has methods too long for the JVM's compiler run operator by operator, whose
    expressions Spark puts into short methods. The session's own limit holds again afterwards."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), METHOD_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextlib.contextmanager
def small_partitions(spark: SparkSession, input_bytes: int, partition_input: int = PARTITION_INPUT,
                     partition_bytes: int = PARTITION_BYTES) -> Iterator[None]:
    """While tables are written, shuffles have partitions in proportion to the input, and adaptive execution joins only small ones: it goes by the
    narrow rows that are shuffled, but the tasks behind them sort the text lines made of these, which must fit in their memory or are spilled.
    The session's own values hold again afterwards."""
    ours = {"spark.sql.shuffle.partitions": lambda v: str(max(int(v), -(-input_bytes // partition_input))),
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": lambda v: str(min(_bytes(spark, v), partition_bytes))}
    before = {name: spark.conf.get(name) for name in ours}
    for name, value in ours.items():
        spark.conf.set(name, value(before[name]))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _bytes(spark: SparkSession, size: str) -> int:
    """Of a size as a session's configuration gives it (``64MB``, ``16k``, ``67108864b``)."""
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


class StarTables(Mapping):
    """The tables of one input by name; a table is written when it is first taken, and again, as a new version, when the
    input's files have changed. What was made from the old version before reads that to its end."""

    def __init__(self, spark: SparkSession, sf_dir: str, ceiling: dt.date):
        self.spark, self.sf_dir, self.ceiling = spark, sf_dir, ceiling
        self.stamp = input_stamp(spark, sf_dir)

    def __iter__(self) -> Iterator[str]:
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)

    def raw_lines(self) -> DataFrame:
        """The raw lines, for a query that reads them once: of the written table if there is one, else rendered as they are read."""
        return self["raw_order_lines"] if self.written("raw_order_lines") else order_lines(self.spark, self.sf_dir)

    @contextlib.contextmanager
    def writing(self) -> Iterator[None]:
        """While whole lines are written."""
        with short_methods(self.spark), small_partitions(self.spark, sum(size for _, size, _ in self.stamp)):
            yield

    def _plan(self, name: str) -> DataFrame:
        if name == "raw_order_lines":
            return order_lines(self.spark, self.sf_dir)
        if name == "stg_orders_final":
            # the written raw lines where there are some, else rendered in the same job
            return clean_orders(self.raw_lines())
        stg = self["stg_orders_final"]
        return {"fact_order_item": lambda: build_fact(stg, self.ceiling), "dim_customer": lambda: build_dim_customer(stg),
                "dim_product": lambda: build_dim_product(stg)}[name]()

    def written(self, name: str) -> bool:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, self.ceiling, name)
        return key in _WRITTEN and _WRITTEN[key][0] == self.stamp

    def first_date(self) -> dt.date | None:
        """The earliest order date of the fact, found once for each written table."""
        fact = self["fact_order_item"]
        key = ("first_date", _WRITTEN[self.spark.sparkContext.applicationId, self.sf_dir, self.ceiling, "fact_order_item"][1])
        if key not in _FACTS:
            _FACTS[key] = fact.agg(F.min("order_date_clean")).first()[0]
        return _FACTS[key]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(name)
        key = (self.spark.sparkContext.applicationId, self.sf_dir, self.ceiling, name)
        store, table = _store(self.spark), f"{name}-{hashlib.md5(f'{self.sf_dir} {self.ceiling}'.encode()).hexdigest()}"
        if not self.written(name):
            plan = self._plan(name)
            with self.writing():
                store.replace(table, plan, compression="zstd")
            _WRITTEN[key] = (self.stamp, store.current(table))
        return store.read(table)

    def _kept_lines(self, key: tuple, made: Callable[[DataFrame], DataFrame], columns: Sequence[str], sources: Sequence[str]) -> DataFrame:
        """``columns`` of what ``made``, which works line by line, gives from the cleaned lines, of which it reads ``sources``. Two tables: the lines of
        all keys, told apart by their other ids, which reads the input once and few columns of it; and, if keys are tied in these, the lines of such keys, compared whole."""
        def first(df, key, order, ties, lead):
            texts = [c for c in raw_sources(sources, df.columns) or () if c not in ID_COLUMNS]
            return earliest_or_tied(df, key, order, ties[:lead], texts if len(texts) >= MANY_TEXTS else ())

        def rest(df, key, order, ties, lead):
            return earliest_of_keys(df, key, order, ties, tied)

        lines = lambda keep: clean_orders(order_lines(self.spark, self.sf_dir), few_columns=True, keep=keep)
        apart = self._kept_table((*key, "apart"), lambda: made(lines(first)).select(*columns, TIED))
        tied = _store(self.spark).read(apart).where(F.col(TIED).isNotNull()).select(TIED)
        at = ("tied", apart, _store(self.spark).current(apart))
        if at not in _FACTS:
            _FACTS[at] = not tied.isEmpty()
        whole = [self._kept_table((*key, "tied"), lambda: made(lines(rest)).select(*columns, F.lit(None).cast("string").alias(TIED)))] if _FACTS[at] else []
        return _store(self.spark).read(apart, *whole).where(F.col(TIED).isNull()).select(*columns)

    def _kept(self, key: tuple, plan: Callable[[], DataFrame]) -> DataFrame:
        """What ``plan`` gives, written once as a table of few columns."""
        return _store(self.spark).read(self._kept_table(key, plan))

    def _kept_table(self, key: tuple, plan: Callable[[], DataFrame]) -> str:
        at = (self.spark.sparkContext.applicationId, self.sf_dir, self.ceiling, key)
        store, table = _store(self.spark), f"part-{hashlib.md5(f'{self.sf_dir} {self.ceiling} {key}'.encode()).hexdigest()}"
        if at not in _WRITTEN or _WRITTEN[at][0] != self.stamp:
            df = plan()
            with short_methods(self.spark), small_partitions(self.spark, sum(size for _, size, _ in self.stamp), PART_INPUT, PART_BYTES):
                store.replace(table, df, compression="zstd")
            _WRITTEN[at] = (self.stamp, store.current(table))
        return table

    def _few(self, key: tuple) -> bool:
        if any(self.written(t) for t in ("raw_order_lines", "stg_orders_final")):
            return False
        parts = _PARTS.setdefault((self.spark.sparkContext.applicationId, self.sf_dir, self.ceiling, self.stamp), set())
        if len(parts) < FEW_PARTS:
            parts.add(key)
        return key in parts

    def _lines(self) -> DataFrame:
        return clean_orders(order_lines(self.spark, self.sf_dir), few_columns=True)

    def part(self, name: str, columns: Sequence[str], of: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """At least ``columns`` of staging or fact, or of what ``of`` makes of it: every row, for a query that reads no other columns."""
        key, of = (name, getattr(of, "__name__", None), *columns), of or (lambda table: table)
        if not self._few(key):
            return of(self[name])
        table = {"stg_orders_final": lambda lines: lines, "fact_order_item": lambda lines: build_fact(lines, self.ceiling)}[name]
        return self._kept_lines(key, lambda lines: of(table(lines)), columns, fact_sources(columns) if name == "fact_order_item" else columns)

    def parts(self, stg: Sequence[str], fact: Sequence[str], dims: Sequence[str] = ()) -> tuple[DataFrame, ...]:
        """At least these columns of staging and of the fact, and whole dimensions, from one part of staging."""
        needed = list(dict.fromkeys([*stg, *fact_sources(fact), *[c for d in dims for c in DIMENSIONS[d][1]]]))
        if not self._few(("stg_orders_final", None, *needed)):
            return self["stg_orders_final"], self["fact_order_item"], *[self[d] for d in dims]
        part = self.part("stg_orders_final", needed)
        return (part, build_fact(part, self.ceiling, columns=fact),
                *[self._kept((d,), lambda d=d: DIMENSIONS[d][0](part)) for d in dims])


def star_tables(spark: SparkSession, sf_dir: str, ceiling: dt.date) -> StarTables:
    return StarTables(spark, sf_dir, ceiling)
