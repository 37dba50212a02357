"""Null-safe comparison."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def differs(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys meet each other. Keeps the left copy of the keys."""
    other = right.select(*[c if c not in on else right[c].alias(f"_r_{c}") for c in right.columns])
    matches = reduce(lambda a, b: a & b, [same(left[c], other[f"_r_{c}"]) for c in on])
    joined = left.join(other, matches, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"_r_{c}" for c in on])
