"""One disposition per source event.

Precedence matters: the duplicate test comes first, so a repeated business
reference is rejected even when the row that was kept fails a later test.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.operators.keys import rank_by_id
from ledgerweave.operators.workspace import Workspace

# Disposition labels.
LOAD = "LOAD"
EXCLUDE_STATUS = "EXCLUDE_STATUS"
REJECT_DUPLICATE = "REJECT_DUPLICATE"
REJECT_ACCOUNT = "REJECT_ACCOUNT"
REJECT_CUSTOMER_REFERENCE = "REJECT_CUSTOMER_REFERENCE"
REJECT_IDENTITY = "REJECT_IDENTITY"


def is_reject(c: Column) -> Column:
    return c.startswith("REJECT")


def is_exclude(c: Column) -> Column:
    return c.startswith("EXCLUDE")


def identities_of(xref: DataFrame, system: str, id_column: str) -> DataFrame:
    """Xref rows of one source system, keyed by that system's customer id."""
    return xref.where(F.col("source_system") == system).select(
        F.col("source_customer_id").alias(id_column), "customer_key", F.lit(True).alias("_known")
    )


def decide_transactions(
    ws: Workspace, name: str, tx: DataFrame, xref: DataFrame, accounts: DataFrame, system: str = "S2"
) -> DataFrame:
    """Transactions with ``rn``, ``customer_key``, ``account_key`` and ``disposition``.

    Every row carries its columns through the rank and the lookups. ``tx`` holds only what later
    tables read, so this moves fewer bytes than sorting and joining narrow rows back on their id.
    """
    ranked = rank_by_id(ws, name, tx, ["source_transaction_ref"], "transaction_id")
    payer = identities_of(xref, system, "payment_customer_id")
    looked_up = ranked.join(payer, "payment_customer_id", "left").join(
        accounts.select("account_id", "account_key"), "account_id", "left"
    )
    disposition = (
        F.when(F.col("rn") > 1, REJECT_DUPLICATE)
        .when(F.col("account_key").isNull(), REJECT_ACCOUNT)
        .when(F.col("_known").isNull(), REJECT_CUSTOMER_REFERENCE)
        .when(F.col("customer_key").isNull(), REJECT_IDENTITY)
        .when(F.col("status") != "ACCEPTED", EXCLUDE_STATUS)
        .otherwise(LOAD)
    )
    return looked_up.withColumn("disposition", disposition).select(
        *tx.columns, "rn", "customer_key", "account_key", "disposition"
    )


def decide_digital(
    events: DataFrame, xref: DataFrame, id_column: str = "digital_customer_id", system: str = "S3"
) -> DataFrame:
    """Activities or service cases with ``customer_key`` and ``disposition``."""
    disposition = (
        F.when(F.col("_known").isNull(), REJECT_CUSTOMER_REFERENCE)
        .when(F.col("customer_key").isNull(), REJECT_IDENTITY)
        .otherwise(LOAD)
    )
    return events.join(identities_of(xref, system, id_column), id_column, "left").select(
        *events.columns, "customer_key", disposition.alias("disposition")
    )


def rejects(tx: DataFrame, activity: DataFrame, case: DataFrame) -> DataFrame:
    """Every rejected event; only transactions carry an amount."""
    no_amount = F.lit(None).cast("decimal(15,2)")

    def of(df: DataFrame, system: str, table: str, key: str, amount: Column) -> DataFrame:
        return df.where(is_reject(F.col("disposition"))).select(
            F.lit(system).alias("source_system"),
            F.lit(table).alias("source_table"),
            F.col(key).alias("source_key"),
            F.col("disposition").alias("reason"),
            "batch_id",
            amount.alias("amount_aud"),
        )

    return (
        of(tx, "S2", "transaction", "transaction_id", F.col("amount").try_cast("decimal(15,2)"))
        .unionByName(of(activity, "S3", "activity", "activity_id", no_amount))
        .unionByName(of(case, "S3", "service_case", "case_id", no_amount))
    )


def run_log(tx: DataFrame, activity: DataFrame, case: DataFrame, batch_id: str) -> DataFrame:
    """Source, loaded, rejected and excluded counts per step."""

    def of(step: str, df: DataFrame) -> DataFrame:
        d = F.col("disposition")
        return df.agg(
            F.lit(step).alias("step"),
            F.count(F.lit(1)).alias("source_count"),
            F.count_if(d == LOAD).alias("loaded_count"),
            F.count_if(is_reject(d)).alias("rejected_count"),
            F.count_if(is_exclude(d)).alias("excluded_count"),
            F.lit(batch_id).alias("batch_id"),
        )

    return (
        of("transaction", tx)
        .unionByName(of("activity", activity))
        .unionByName(of("service_case", case))
    )
