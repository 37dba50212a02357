"""Dense surrogate keys and ranks without a single-partition sort.

Rows are range-partitioned and sorted on the natural order, numbered inside
their partition and written once. Only the row counts per partition (one row
per range partition) are needed to turn local positions into global ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerweave.functions.compare import join_null_safe
from ledgerweave.operators.workspace import Workspace

# monotonically_increasing_id: partition index above bit 33, row position below.
_POSITION_BITS = 33
_SLOT = "_slot"


def ordered_rows(
    ws: Workspace,
    name: str,
    df: DataFrame,
    order: Sequence[Column | str],
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Rows written in global order, each with a ``_slot`` (partition, position)."""
    return ws.table(
        name,
        lambda: df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_SLOT, F.monotonically_increasing_id()),
        partition_by,
    )


def with_position(ws: Workspace, name: str, ordered: DataFrame, key: str) -> DataFrame:
    """Replace ``_slot`` by the dense 1-based global position ``key``."""

    def offsets() -> DataFrame:
        part = F.shiftright(_SLOT, _POSITION_BITS).alias("_part")
        counts = ordered.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
        # One row per range partition, so an unpartitioned running sum is bounded.
        before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        return counts.select(
            "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
        )

    starts = F.broadcast(ws.table(f"{name}_offsets", offsets))
    position = F.col(_SLOT).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    keyed = ordered.withColumn("_part", F.shiftright(_SLOT, _POSITION_BITS)).join(starts, "_part")
    columns = [c for c in ordered.columns if c != _SLOT]
    return keyed.select((F.col("_offset") + position + 1).alias(key), *columns)


def dense_key(
    ws: Workspace,
    name: str,
    df: DataFrame,
    order: Sequence[Column | str],
    key: str,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Add ``key`` = 1..n in the order given, which must identify a row."""
    ordered = ordered_rows(ws, f"{name}_rows", df, order, partition_by)
    return with_position(ws, name, ordered, key)


def repeated_groups(ws: Workspace, name: str, df: DataFrame, group: Sequence[str]) -> DataFrame:
    """Group keys held by more than one row, with their row count ``_n``."""
    return ws.table(
        f"{name}_repeated",
        lambda: df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1),
    )


def _position_in_group(
    ws: Workspace, name: str, rows: DataFrame, group: Sequence[str], order: Sequence[str], rank: str
) -> DataFrame:
    """Exact rank inside each group; a large group spans many range partitions."""
    placed = dense_key(ws, name, rows, [*group, *order], "_pos")
    # Written, so the join below reads two plain shuffles and a huge group can be split.
    first = ws.table(
        f"{name}_first", lambda: placed.groupBy(*group).agg(F.min("_pos").alias("_first"))
    )
    return join_null_safe(placed, first, group).select(
        *rows.columns, (F.col("_pos") - F.col("_first") + 1).alias(rank)
    )


# Groups of more rows than this are ranked across range partitions, if the sketch sees them.
HOT_ROWS = 1_000_000
# A group that holds this share of all rows is always seen.
_TRACKED, _MOST = 100_000, 1_000


def hot_groups(df: DataFrame, group: Sequence[str], hot_rows: int) -> list[int]:
    """Hashes of the groups of more than ``hot_rows`` rows, from a mergeable sketch of frequent
    items: one scan of the group columns, no shuffle, a bounded answer."""
    found = df.select(F.xxhash64(*group).alias("_mark")).agg(
        F.expr(f"approx_top_k(_mark, {_MOST}, {_TRACKED})").alias("top")
    ).first()["top"]
    return [r["item"] for r in found or () if r["count"] > hot_rows]


def rank_rows(
    ws: Workspace,
    name: str,
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    rank: str = "rn",
    hot_rows: int | None = None,
) -> DataFrame:
    """``row_number`` per group, safe for one huge group.

    Rows are shuffled once, on the group. Groups too large for one task are taken out before and
    ranked by their position in range partitions. The sort compares a hash of the group first:
    ids that differ only behind a long common prefix are slow to compare.
    """
    in_group = Window.partitionBy(F.xxhash64(*group), *group).orderBy(*order)
    place = F.row_number().over(in_group).cast("bigint").alias(rank)
    hot = hot_groups(df, group, HOT_ROWS if hot_rows is None else hot_rows)
    if not hot:
        return df.select("*", place)
    is_hot = F.xxhash64(*group).isin(hot)
    return df.where(~is_hot).select("*", place).unionByName(
        _position_in_group(ws, name, df.where(is_hot), group, order, rank)
    )


def rank_by_id(
    ws: Workspace, name: str, df: DataFrame, group: Sequence[str], row_id: str, rank: str = "rn",
    hot_rows: int | None = None,
) -> DataFrame:
    """``row_number`` per group ordered by a unique id."""
    return rank_rows(ws, name, df, group, [row_id], rank, hot_rows)
