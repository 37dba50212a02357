"""What a batch of either contract consists of, for the protocol that builds and publishes it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.operators.scorecard import Check
from ledgerweave.operators.workspace import Workspace, in_parallel
from ledgerweave.plans import guards, loose, reports
from ledgerweave.plans import warehouse as strict
from ledgerweave.sources.schemas import CORE_SOURCES, LOOSE_SOURCES

FACTS = ("fact_transaction", "fact_activity", "fact_service_case")


@dataclass(frozen=True)
class Contract:
    """Tables, sources, build and checks of a kind of batch.

    ``schemas`` declares every table that is written; ``keys`` the column that deals its rows to
    buckets of fingerprints, ``content`` the columns that count there (default: all but those
    that differ between builds). ``open`` makes a lazy build over sources, ``build`` its tables,
    ``checks`` the lines a written batch must pass, and ``negative`` the lines of a test that must
    fail on altered facts.
    """

    name: str
    sources: Mapping[str, str]
    schemas: Mapping[str, str]
    keys: Mapping[str, str]
    open: Callable[[SparkSession, Mapping[str, DataFrame], Workspace, str], Any]
    build: Callable[[Any], dict[str, DataFrame]]
    checks: Mapping[str, Callable[[Any], DataFrame]]
    negative: Callable[[Any], DataFrame]
    steps: Callable[[Any, str], DataFrame]
    content: Mapping[str, Sequence[str]] = field(default_factory=dict)
    facts: Sequence[str] = FACTS

    def columns(self, table: str) -> list[str]:
        return [part.split()[0] for part in self.schemas[table].split(", ")]


STRICT = Contract(
    name="strict",
    sources=CORE_SOURCES,
    schemas=strict.SCHEMAS,
    keys={
        "dim_customer": "core_customer_id", "dim_account": "account_id", "dim_date": "date_key",
        "dim_channel": "channel_code", "customer_xref": "source_customer_id", "fact_transaction": "transaction_id",
        "fact_activity": "activity_id", "fact_service_case": "case_id", "rejected_record": "source_key",
        "etl_run_log": "step",
    },
    open=lambda spark, sources, ws, batch_id: strict.Warehouse(spark, sources, ws, batch_id),
    build=lambda wh: wh.build(),
    checks=guards.CHECKS,
    negative=guards.negative_amount,
    steps=lambda tables, batch_id: tables.etl_run_log,
)


def _loose_build(wh: loose.LooseWarehouse) -> dict[str, DataFrame]:
    calendar = in_parallel({"dim_date": lambda: wh.dim_date, "dim_channel": lambda: wh.dim_channel})
    return {**loose.fingerprint_tables(wh), **calendar, "run_log": wh.run_log}


# Tables and columns of the permissive contract.
LOOSE_SCHEMAS = {
    "dim_customer": "customer_key bigint, full_name string, date_of_birth date, email string, state string, "
    "match_quality string",
    "dim_account": "account_key bigint, account_id string, customer_key bigint, account_type string, "
    "opened_date date, status string, source_system string",
    "dim_date": "date_key int, full_date date, day_of_week string, month_no int, quarter_no int, year_no int",
    "dim_channel": "channel_key bigint, channel_code string, channel_name string",
    "customer_xref": "xref_key bigint, source_system string, source_customer_id string, customer_key bigint, "
    "match_rule string, match_status string",
    "fact_transaction": "transaction_id string, customer_key bigint, account_key bigint, date_key int, "
    "channel_key bigint, amount_aud decimal(12,2), transaction_count int, status string",
    "fact_activity": "activity_id string, customer_key bigint, date_key int, channel_key bigint, "
    "activity_type string, activity_count int",
    "fact_service_case": "case_id string, customer_key bigint, date_key int, case_type string, status string, "
    "severity string, case_count int",
    "rejected_record": "source_system string, source_table string, source_key string, reason string",
    "run_log": "step string, source_count bigint, loaded_count bigint, rejected_count bigint",
}
LOOSE_CHECKS: dict[str, Callable[[Any], DataFrame]] = {
    "settled reconciliation": loose.settled_reconciliation,
    "orphan keys": loose.orphan_keys,
    "duplicate natural keys": loose.duplicate_natural_keys,
    "merged names": loose.merged_names,
    "account links": loose.account_links_kept,
    "attribution totals": lambda wh: guards.attribution_balance(
        reports.attribution(wh.transaction_rows, wh.activity_rows, wh.case_rows)
    ),
    "run log": loose.run_log_agrees,
}

PERMISSIVE = Contract(
    name="permissive",
    sources=LOOSE_SOURCES,
    schemas=LOOSE_SCHEMAS,
    keys={
        "dim_customer": "customer_key", "dim_account": "account_id", "dim_date": "date_key",
        "dim_channel": "channel_code", "customer_xref": "source_customer_id", "fact_transaction": "transaction_id",
        "fact_activity": "activity_id", "fact_service_case": "case_id", "rejected_record": "source_key",
        "run_log": "step",
    },
    open=lambda spark, sources, ws, batch_id: loose.LooseWarehouse(spark, sources, ws),
    build=_loose_build,
    checks=LOOSE_CHECKS,
    negative=loose.negative_amount,
    steps=lambda tables, batch_id: tables["run_log"].select(
        F.lit(batch_id).alias("batch_id"), "*", F.lit(0).cast("bigint").alias("excluded_count")
    ),
    content=loose.FINGERPRINT_COLUMNS,
)

# Source checks of the permissive contract: its primary keys, and what its rules rely on.
LOOSE_SOURCE_CHECKS = tuple(
    Check(f"unique_{table}_{key}", table, "duplicates", columns=(key,))
    for table, key in {
        "customers": "customer_id", "accounts": "account_id", "payers": "payer_id",
        "transactions": "transaction_id", "digital_users": "digital_user_id", "digital_activity": "activity_id",
        "service_cases": "case_id",
    }.items()
) + (
    Check("amount_present", "transactions", condition="amount_aud IS NULL"),
    Check("status_present", "transactions", condition="status IS NULL"),
)
