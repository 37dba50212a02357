"""Row edits as joins: update by key, delete by key, derived inserts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def update_rows(
    df: DataFrame,
    edits: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    order: Sequence[str] = (),
) -> DataFrame:
    """Set ``columns`` from the edit row of the same key. An edit may set NULL.

    Of several edits for one key the last one by ``order`` counts, then the one with the
    larger values, so no edit can multiply a row.
    """
    last = edits.groupBy(*key).agg(F.max(F.struct(*order, *columns)).alias("_edit"))
    renamed = last.select(
        *key, *[F.col("_edit")[c].alias(f"_new_{c}") for c in columns], F.lit(True).alias("_edited")
    )
    joined = df.join(renamed, list(key), "left")
    return joined.select(
        *[
            F.when(F.col("_edited"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in columns
            else c
            for c in df.columns
        ]
    )


def delete_rows(df: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.join(keys.select(*key), list(key), "left_anti")


def derive_rows(df: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """The input plus an altered copy of the rows that meet the condition."""
    return df.unionByName(df.where(condition).withColumns(dict(changes)))
