"""Helpers shared by the training-data operators: words, scratch tables, range buckets."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.session import shared_folder


def words_of(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8, A-Z in lower case; null has none.

    A word is a run of anything but the six ASCII blanks, which is what ``bytes.split``
    cuts at; ``bytes.lower`` touches A-Z alone.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, which may not have it installed."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="ledgerweave-")) / "ledgerweave_modules.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes: ten thousand whole texts, Spark's default, can be any size, and
    executor and Python worker hold several copies of a batch. A limit that the session has stays."""
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, "4m")


class Scratch:
    """Tables of one operator call below the session's shared folder.

    A written table cuts lineage: losing an executor repeats one stage, never the
    whole chain. ``drop`` removes the tables nothing reads any more; the others go when
    the session ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, name: str, frame: DataFrame) -> DataFrame:
        frame.write.option("compression", "zstd").parquet(self.path(name))
        return self.read(name, frame)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        conf = self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = hadoop.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)


def per_batch(
    work: Callable[[dict[str, list]], dict[str, object]], schema: pa.Schema, rows: int = 512
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow mapper that hands ``work`` plain lists of at most ``rows`` rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                out = work({n: part.column(n).to_pylist() for n in part.schema.names})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in schema], schema=schema
                )

    return run


def id_buckets(docs: DataFrame, key: str, buckets: int) -> list[int]:
    """Inner borders that cut ``key`` into about equal ranges; one narrow pass over the ids.

    The list has ``buckets - 1`` numbers, so it follows the number of partitions asked
    for and not the rows.
    """
    if buckets < 2:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    borders = docs.where(F.col(key).isNotNull()).approxQuantile(key, shares, 0.2 / buckets)
    return sorted({int(b) for b in borders})


def bucket_of(key: Column, borders: list[int]) -> Column:
    """How many borders are at or below ``key``: 0 .. len(borders); null keys take 0.

    Nested comparisons, so that a row meets log2(borders) of them.
    """

    def halve(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(key >= F.lit(borders[mid]), halve(mid + 1, high)).otherwise(halve(low, mid))

    return halve(0, len(borders))


# Estimates from here on are Spark's way to say that it does not know.
_UNKNOWN_BYTES = 1 << 50


def input_bytes(docs: DataFrame, text: str = "text") -> int:
    """Size of the input, to choose a number of partitions from: Catalyst's estimate where it
    rests on files, otherwise the bytes of the text column, summed in one pass."""
    estimate = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if estimate < _UNKNOWN_BYTES:
        return estimate
    size = F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0))
    return int(docs.agg(size.alias("size")).first()["size"])
