"""Intermediate tables written to the shared folder.

A written table cuts lineage in a way that survives the loss of any executor,
and it carries real file sizes, so the optimizer chooses between a broadcast
and a shuffled join from measured bytes instead of from a hint.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

from ledgerweave.session import shared_folder


T = TypeVar("T")

# Jobs submitted at once; Spark shares the executors between them.
CONCURRENT_JOBS = 8


def in_parallel(actions: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Run independent Spark actions side by side and return their results by name."""
    with ThreadPoolExecutor(CONCURRENT_JOBS) as pool:
        running = {name: pool.submit(action) for name, action in actions.items()}
        return {name: job.result() for name, job in running.items()}


class Workspace:
    """Names each intermediate table once and writes it on first use.

    What is still there when the session ends is removed with it; ``release`` removes
    it earlier.
    """

    def __init__(self, spark: SparkSession, label: str = "work", root: str | None = None):
        self.spark = spark
        base = (root or shared_folder(spark)).rstrip("/")
        self.root = f"{base}/{label}-{uuid.uuid4().hex}"
        self._tables: dict[str, DataFrame] = {}
        self._attempts: dict[str, int] = {}
        self._started = False
        self._names = threading.Lock()
        self._building: dict[str, threading.Lock] = {}

    def path(self, name: str) -> str:
        """Folder of a table; a table whose write failed gets a new one."""
        failed = self._attempts.get(name, 0)
        return f"{self.root}/{name}.retry{failed}" if failed else f"{self.root}/{name}"

    def _root(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _start(self) -> None:
        with self._names:
            if not self._started:
                path, files = self._root()
                files.mkdirs(path)
                files.deleteOnExit(path)
                self._started = True

    def table(
        self,
        name: str,
        build: Callable[[], DataFrame],
        partition_by: Sequence[str] = (),
    ) -> DataFrame:
        """The table called ``name``, built and written if this is the first request.

        Threads that ask for a table under construction wait for it, so tables can
        be requested side by side and order themselves by what they read.
        """
        with self._names:
            own = self._building.setdefault(name, threading.Lock())
        with own:
            if name not in self._tables:
                frame = build()
                self._start()
                writer = frame.write.mode("errorifexists")
                if partition_by:
                    writer = writer.partitionBy(*partition_by)
                try:
                    writer.parquet(self.path(name))
                except Exception:
                    self._attempts[name] = self._attempts.get(name, 0) + 1
                    raise
                stored = self.spark.read.schema(frame.schema).parquet(self.path(name))
                self._tables[name] = stored.select(*frame.columns)
            return self._tables[name]

    def release(self) -> None:
        """Remove the written tables, for instance once their batch is published."""
        path, files = self._root()
        files.delete(path, True)
        self._tables.clear()

    def names(self) -> list[str]:
        return sorted(self._tables)

    def stored(self) -> dict[str, DataFrame]:
        """The tables written so far."""
        return dict(self._tables)
