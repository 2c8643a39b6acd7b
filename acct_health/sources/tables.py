"""Named Parquet tables that are replaced as a whole, while others read them.

A table is a folder. Each replacement writes a new version beside the others and then commits it by creating one empty file whose name
holds a number and the version; the highest is the table. Creating a file either happens or not, so readers see the old version or the
new one, never a part. A reader pins the version it was given by an empty file of its own, and a version goes when it is
not the table any more and no pin is left. The tables stay for later sessions.

    store = TableStore(spark, "hdfs:///analytics")
    store.replace("fact_order_item", build_fact(store.read("stg_orders_final")))
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

COMMITS, PINS = "_commits", "_pins"


class TableStore:
    """Tables below ``root``, a folder that all executors share. Used as a context manager, or ended by ``close``, it takes back its pins."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.session = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
        self._pinned: set[tuple[str, str]] = set()

    def __enter__(self) -> TableStore:
        return self

    def __exit__(self, *error) -> None:
        self.close()

    def _path(self, *parts: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, *parts: str) -> dict[str, int]:
        """Names in a folder and when they were last changed (seconds)."""
        path, fs = self._path(*parts)
        return {s.getPath().getName(): s.getModificationTime() // 1000 for s in fs.listStatus(path)} if fs.exists(path) else {}

    def _remove(self, *parts: str) -> None:
        path, fs = self._path(*parts)
        fs.delete(path, True)

    def tables(self) -> list[str]:
        return sorted(n for n in self._names() if self.current(n))

    def current(self, name: str) -> str | None:
        """The version that is the table now. Of two commits of one number, made at once, the greater version is."""
        commits = self._names(name, COMMITS)
        return max(commits).split("-", 1)[1] if commits else None

    def replace(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = (), compression: str | None = None) -> None:
        """Make ``df`` the table ``name``, which ``df`` may read. Until it is written whole, and if writing fails, the table is the old one.
        ``compression``: a codec of the Parquet writer; the session's if not given."""
        version = uuid.uuid4().hex
        path, _ = self._path(name, version)
        try:
            df.write.partitionBy(*partition_by).parquet(path.toString(), compression=compression)
        except Exception:
            self._remove(name, version)
            raise
        commits = self._names(name, COMMITS)
        number = int(max(commits).split("-", 1)[0]) + 1 if commits else 1
        commit, fs = self._path(name, COMMITS, f"{number:012d}-{version}")
        fs.create(commit, False).close()
        self.vacuum(name)

    def read(self, *names: str) -> DataFrame:
        """The table as it is now; several tables of the same columns: their rows together, in one scan. What is made from it reads these versions to
        the end, whatever replaces them."""
        return self.spark.read.parquet(*[self._current_path(name) for name in names])

    def _current_path(self, name: str) -> str:
        for _ in range(10):
            version = self.current(name)
            if version is None:
                raise KeyError(f"no table {name} in {self.root}")
            if (name, version) not in self._pinned:
                pin, fs = self._path(name, PINS, version, self.session)
                fs.create(pin, True).close()
                self._pinned.add((name, version))
            path, fs = self._path(name, version)
            if fs.exists(path):  # else it went between the look and the pin
                return path.toString()
        raise RuntimeError(f"table {name} in {self.root} is replaced faster than it can be read")

    def vacuum(self, name: str, pin_hours: float = 168, open_hours: float = 24) -> None:
        """Remove versions that are not the table and not pinned. Pins older than ``pin_hours`` are of sessions that ended without ``close``,
        versions without a commit that are older than ``open_hours`` of writers that did."""
        now, version = time.time(), self.current(name)
        commits = {c.split("-", 1)[1]: c for c in self._names(name, COMMITS)}
        for v, changed in self._names(name).items():
            if v.startswith("_") or v == version or (v not in commits and now - changed < 3600 * open_hours):
                continue
            if not any(now - t < 3600 * pin_hours for t in self._names(name, PINS, v).values()):
                self._remove(name, v)
                self._remove(name, PINS, v)
                if v in commits:  # last, so that a version without a commit is never an old one
                    self._remove(name, COMMITS, commits[v])

    def drop(self, name: str) -> None:
        """Remove the table, also from those who still read it."""
        self._remove(name)

    def close(self) -> None:
        """Take back this session's pins and remove what nobody reads any more."""
        for name, version in self._pinned:
            self._remove(name, PINS, version, self.session)
        for name in {n for n, _ in self._pinned}:
            self.vacuum(name)
        self._pinned.clear()
