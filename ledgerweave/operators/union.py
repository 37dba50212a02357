"""Unions of many frames."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def union_all(frames: Iterable[DataFrame], missing: bool = False) -> DataFrame:
    """Union by name, paired up level by level so that the plan stays shallow."""
    level = list(frames)
    while len(level) > 1:
        pairs = [level[i : i + 2] for i in range(0, len(level), 2)]
        level = [
            p[0].unionByName(p[1], allowMissingColumns=missing) if len(p) == 2 else p[0] for p in pairs
        ]
    return level[0]
