"""One built warehouse per session and input folder.

Reports read a warehouse that was built once, as they would on a schedule. The
build is redone, and the old one removed, when a file of an input table changes.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerweave.operators.workspace import Workspace
from ledgerweave.plans.loose import LooseWarehouse
from ledgerweave.plans.warehouse import Warehouse
from ledgerweave.sources.bank_adapter import bank_sources
from ledgerweave.sources.loose_adapter import loose_sources

_TABLES = ("customer", "supplier", "orders", "lineitem", "events")
_built: dict[tuple, tuple[tuple, Warehouse | LooseWarehouse]] = {}


def signature(spark: SparkSession, sf_dir: str) -> tuple:
    """Name, size and time of every input file, from the file system without opening any."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    marks = []
    for table in _TABLES:
        path = hadoop.Path(f"{sf_dir.rstrip('/')}/{table}.parquet")
        files = path.getFileSystem(conf)
        if files.exists(path):
            found = files.listFiles(path, True)
            while found.hasNext():
                status = found.next()
                marks.append((str(status.getPath()), status.getLen(), status.getModificationTime()))
    return tuple(sorted(marks))


def _once(kind: str, spark: SparkSession, sf_dir: str, version: str | None, build):
    """The build for this folder. A caller that names a ``version`` saves the file listing."""
    key = (kind, spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    mark = (version,) if version is not None else signature(spark, sf_dir)
    held = _built.get(key)
    if held is None or held[0] != mark:
        _built[key] = (mark, build())
        if held is not None:
            held[1].ws.release()
    return _built[key][1]


def warehouse(spark: SparkSession, sf_dir: str, version: str | None = None) -> Warehouse:
    return _once(
        "strict", spark, sf_dir, version,
        lambda: Warehouse(spark, bank_sources(spark, sf_dir), Workspace(spark, "strict")),
    )


def loose_warehouse(spark: SparkSession, sf_dir: str, version: str | None = None) -> LooseWarehouse:
    return _once(
        "loose", spark, sf_dir, version,
        lambda: LooseWarehouse(spark, loose_sources(spark, sf_dir), workspace=Workspace(spark, "loose")),
    )
