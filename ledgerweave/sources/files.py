"""Source scans with declared schemas, batch-tagged snapshots and CSV exchange."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.operators.workspace import Workspace
from ledgerweave.sources.schemas import CORE_SOURCES, EXPECTED_IDENTITY


def scan(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def scan_all(
    spark: SparkSession, folder: str, schemas: Mapping[str, str] = CORE_SOURCES, fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Every source table below ``folder``, one path per table."""
    return {name: scan(spark, f"{folder}/{name}", ddl, fmt) for name, ddl in schemas.items()}


def snapshot(df: DataFrame, batch_id: str) -> DataFrame:
    """Every source column plus the batch that took it."""
    return df.withColumn("batch_id", F.lit(batch_id))


class Staged(Mapping[str, DataFrame]):
    """Batch-tagged sources by name.

    Written copies keep later stages apart from a source that moves on. Sources
    that never change under their path need only the tag.
    """

    def __init__(
        self, ws: Workspace, sources: Mapping[str, DataFrame], batch_id: str, written: bool
    ):
        self._ws, self._sources, self._batch_id, self._written = ws, sources, batch_id, written
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            tagged = snapshot(self._sources[name], self._batch_id)
            self._frames[name] = (
                self._ws.table(f"stg_{name}", lambda: tagged) if self._written else tagged
            )
        return self._frames[name]

    def __iter__(self):
        return iter(self._sources)

    def __len__(self) -> int:
        return len(self._sources)


def scan_expected_identities(spark: SparkSession, path: str) -> DataFrame:
    """Expected-identity file: CSV with header, UTF-8 with or without a byte-order mark."""
    blank_as_null = [
        F.nullif(F.col(c), F.lit("")).alias(c)
        for c in (part.split()[0] for part in EXPECTED_IDENTITY.split(", "))
    ]
    return scan(spark, path, EXPECTED_IDENTITY, "csv").select(*blank_as_null)


def export_csv(report: DataFrame, path: str) -> None:
    """Report as CSV part files in the order of its first column, without gathering it."""
    report.orderBy(report.columns[0]).write.mode("errorifexists").option("header", True).csv(path)
