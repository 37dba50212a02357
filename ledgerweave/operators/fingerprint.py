"""Order-free table fingerprints.

Each row is rendered as JSON with every field present, hashed once, and the two
halves of the hash are summed separately. Sums do not depend on row order or on
partitioning, so nothing is sorted or gathered. As sums they also add up: marks
per month and key bucket, kept with a batch, give the fingerprint of a table without
reading it, and say where two batches differ.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.operators.union import union_all

# Columns that differ between two builds of the same data.
VOLATILE = ("batch_id", "first_seen_at", "rejected_at", "run_at")

MARKS = "table_name string, month int, bucket int, rows bigint, hash_a decimal(38,0), hash_b decimal(38,0)"
BUCKETS = 64
_HEX_DIGITS = 15


def _hashed(df: DataFrame, columns: Sequence[str] | None, *more: Column) -> DataFrame:
    used = sorted(columns or [c for c in df.columns if c not in VOLATILE])
    text = F.to_json(
        F.struct(*[F.col(c).cast("string").alias(c) for c in used]), {"ignoreNullFields": "false"}
    )
    return df.select(F.md5(text.cast("binary")).alias("_h"), *more)


def _half(start: int) -> Column:
    number = F.conv(F.substring("_h", start, _HEX_DIGITS), 16, 10).cast("decimal(38,0)")
    return F.coalesce(F.sum(number), F.lit(0)).cast("decimal(38,0)")


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), _half(1).alias("hash_a"), _half(17).alias("hash_b")]


def table_fingerprint(df: DataFrame, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: table_name, rows, and two 60-bit hash sums over the business columns."""
    return _hashed(df, columns).agg(F.lit(name).alias("table_name"), *_sums())


def fingerprints(
    tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    chosen = columns or {}
    return union_all(
        table_fingerprint(df, name, chosen.get(name)) for name, df in tables.items()
    )


def table_marks(df: DataFrame, name: str, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Fingerprints per month of ``date_key`` (null where there is none) and bucket of ``key``.

    At most months x BUCKETS rows, whatever the size of the table.
    """
    day = F.floor(F.col("date_key") / 100) if "date_key" in df.columns and name != "dim_date" else F.lit(None)
    bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(BUCKETS)).cast("int")
    parts = _hashed(df, columns, day.cast("int").alias("month"), bucket.alias("bucket"))
    return parts.groupBy("month", "bucket").agg(*_sums()).select(F.lit(name).alias("table_name"), "*")


def add_marks(marks: DataFrame, names: Sequence[str]) -> DataFrame:
    """Fingerprints of whole tables from their marks; a table without rows has none."""
    spark = marks.sparkSession
    known = spark.createDataFrame([(n,) for n in names], "table_name string")
    summed = marks.groupBy("table_name").agg(
        F.sum("rows").alias("rows"), *(F.sum(c).cast("decimal(38,0)").alias(c) for c in ("hash_a", "hash_b"))
    )
    zero = F.lit(0).cast("decimal(38,0)")
    return known.join(summed, "table_name", "left").select(
        "table_name", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce("hash_a", zero).alias("hash_a"), F.coalesce("hash_b", zero).alias("hash_b"),
    )


def differing_marks(first: DataFrame, second: DataFrame) -> DataFrame:
    """Months and key buckets in which two sets of marks differ, with their rows."""
    place = ["table_name", "month", "bucket"]
    a = first.select(*place, F.struct("rows", "hash_a", "hash_b").alias("a"))
    b = second.select(*place, F.struct("rows", "hash_a", "hash_b").alias("b"))
    # A month can be null, so the sides meet by grouping instead of a join on equality.
    both = a.unionByName(b, allowMissingColumns=True).groupBy(*place).agg(F.first("a", True).alias("a"), F.first("b", True).alias("b"))
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select(
        *place, F.coalesce("a.rows", F.lit(0)).alias("first_rows"), F.coalesce("b.rows", F.lit(0)).alias("second_rows")
    )


def compare_builds(first: DataFrame, second: DataFrame) -> DataFrame:
    """Per table: ``equal`` only if both builds have it, non-empty, with equal sums."""
    a, b = first.alias("a"), second.alias("b")
    joined = a.join(b, F.col("a.table_name") == F.col("b.table_name"), "full_outer")
    equal = (
        (F.col("a.rows") > 0)
        & (F.col("a.rows") == F.col("b.rows"))
        & (F.col("a.hash_a") == F.col("b.hash_a"))
        & (F.col("a.hash_b") == F.col("b.hash_b"))
    )
    return joined.select(
        F.coalesce("a.table_name", "b.table_name").alias("table_name"),
        F.col("a.rows").alias("first_rows"),
        F.col("b.rows").alias("second_rows"),
        F.coalesce(equal, F.lit(False)).alias("equal"),
    )
