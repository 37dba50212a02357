"""Connected components of an undirected link table, by large-star and small-star rounds.

Every round hangs neighbours on their smallest neighbour, first the larger ones, then the
smaller ones, until all links are stars around the smallest member. Hubs cost one row per
link and never a pair of links. Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import Scratch


def _hang(links: DataFrame, larger: bool) -> DataFrame:
    """One star step over links ``a > b``; the result again has ``a > b``, without repeats."""
    if larger:
        near = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        near = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("hub"), F.least("u", "m").alias("m")
    )
    joined = near.join(least, F.col("u") == F.col("hub"))
    if larger:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("hub").alias("a"), F.col("m").alias("b"))
        )
    return out.where("a <> b").distinct()


def components(links: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """``node, root`` for every node with a link; the root is the smallest node reachable.

    ``links`` has integer columns ``a`` and ``b`` in any order, repeats and loops allowed.
    """
    def state(frame: DataFrame):
        row = frame.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("mark"),
        ).first()
        return row["n"], row["mark"]

    current = scratch.write(
        f"{label}-0",
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b").distinct(),
    )
    before, step = state(current), 0
    while before[0]:
        step += 1
        current = scratch.write(f"{label}-{step}", _hang(_hang(current, True), False))
        scratch.drop(f"{label}-{step - 1}")
        now = state(current)
        if now == before:
            break
        before = now
    # The caller reads the last round; the rounds before are gone.
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
