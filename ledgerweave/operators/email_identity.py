"""Permissive identity rule: an e-mail used once on both sides.

Comparison is exact and case-sensitive. A source row is matched when its e-mail
belongs to one core person and to no other row of its own source; any other hit
is ambiguous, and no hit leaves it unmatched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions import join_null_safe
from ledgerweave.operators.identity import AMBIGUOUS, MATCHED, UNMATCHED
from ledgerweave.operators.workspace import Workspace

# Rule labels of the permissive contract.
R1_EXACT_ID, R2_EMAIL, NONE = "R1_EXACT_ID", "R2_EMAIL", "NONE"
PERSON = ["full_name", "date_of_birth", "email"]


def distinct_persons(customers: DataFrame) -> DataFrame:
    """One row per (name, birth date, e-mail); the lowest customer id supplies the rest.

    ``min_by`` combines on the map side, so a person repeated very often reaches
    the reducer as one row per task.
    """
    quality = F.when(F.col("email").isNull(), "SINGLE_SOURCE").otherwise("EMAIL_MATCH")
    return (
        customers.groupBy(*PERSON)
        .agg(F.min_by("state", "customer_id").alias("state"))
        .select(*PERSON, "state", quality.alias("match_quality"))
    )


def exact_ids(customers: DataFrame, persons: DataFrame) -> DataFrame:
    """Every core id with the person it belongs to, missing facts matching each other."""
    keys = persons.select(*PERSON, "customer_key")
    return join_null_safe(customers.select("customer_id", *PERSON), keys, PERSON).select(
        F.lit("S1").alias("source_system"),
        F.col("customer_id").alias("source_customer_id"),
        "customer_key",
        F.lit(R1_EXACT_ID).alias("match_rule"),
        F.lit(MATCHED).alias("match_status"),
    )


def email_lookup(persons: DataFrame, sources: DataFrame, systems: Sequence[str]) -> DataFrame:
    """Per core e-mail: persons, lowest key and source rows per system."""
    core = persons.where(F.col("email").isNotNull()).select(
        "email", "customer_key", F.lit(None).cast("string").alias("source_system")
    )
    rows = sources.where(F.col("email").isNotNull()).select(
        "email", F.lit(None).cast("bigint").alias("customer_key"), "source_system"
    )
    return (
        core.unionByName(rows)
        .groupBy("email")
        .agg(
            F.count("customer_key").alias("hits"),
            F.min("customer_key").alias("lowest"),
            *[F.count_if(F.col("source_system") == s).alias(f"rows_{s}") for s in systems],
        )
        .where(F.col("hits") > 0)
    )


def by_email(
    ws: Workspace, name: str, persons: DataFrame, sources: DataFrame, systems: Sequence[str]
) -> DataFrame:
    """Identity of every source row; ``sources`` has source_system, source_customer_id, email."""
    lookup = ws.table(f"{name}_emails", lambda: email_lookup(persons, sources, systems))
    own_rows: Column = F.lit(0)
    for s in systems:
        own_rows = F.when(F.col("source_system") == s, F.col(f"rows_{s}")).otherwise(own_rows)
    once = (F.col("hits") == 1) & (own_rows == 1)
    hit = F.col("hits").isNotNull()
    asked = sources.where(F.col("email").isNotNull()).join(lookup, "email", "left")
    resolved = asked.select(
        "source_system",
        "source_customer_id",
        F.when(once, F.col("lowest")).alias("customer_key"),
        F.when(hit, R2_EMAIL).otherwise(NONE).alias("match_rule"),
        F.when(once, MATCHED).when(hit, AMBIGUOUS).otherwise(UNMATCHED).alias("match_status"),
    )
    silent = sources.where(F.col("email").isNull()).select(
        "source_system",
        "source_customer_id",
        F.lit(None).cast("bigint").alias("customer_key"),
        F.lit(NONE).alias("match_rule"),
        F.lit(UNMATCHED).alias("match_status"),
    )
    return resolved.unionByName(silent)
