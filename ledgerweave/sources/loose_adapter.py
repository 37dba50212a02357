"""Sources of the permissive contract derived from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.sources.bank_adapter import (
    STATES, Sources, _select, chosen, days_after, every, pick, prefixed,
)

# Code lists of the permissive sources.
ACCOUNT_TYPES = ["SAVINGS", "TRANSACTION", "CREDIT"]
CHANNELS = ["APP", "WEB", "ATM", "BRANCH", "EFTPOS"]
TX_STATUS = {"F": "SETTLED", "O": "PENDING", "P": "FAILED"}
ACTIVITY_TYPES = {"click": "VIEW_BALANCE", "view": "VIEW_BALANCE", "purchase": "PAY_SOMEONE"}
CASE_TYPES = ["CARD_DISPUTE", "LOGIN_ISSUE", "FEE_ENQUIRY", "ADDRESS_UPDATE"]
SEVERITIES = ["LOW", "MEDIUM", "HIGH"]


def _email(k: Column) -> Column:
    return F.concat(F.lit("user"), k.cast("string"), F.lit("@example.com"))


def customers(customer: DataFrame) -> DataFrame:
    """Every fiftieth customer repeats the person before under another id."""
    k = F.col("c_custkey")
    person = F.when(every(k, 50, 1), k - 1).otherwise(k)
    mail = F.when(every(person, 60, 3), person - 1).otherwise(person)
    return _select(
        customer,
        {
            "customer_id": prefixed("C", k),
            "full_name": F.concat(F.lit("Customer#"), F.lpad(person.cast("string"), 9, "0")),
            "date_of_birth": F.when(
                ~every(person, 31), days_after("1950-01-01", (person * 37) % 20000)
            ),
            "email": F.when(~every(person, 17), _email(mail)),
            "phone": F.concat(F.lit("04"), F.lpad(k.cast("string"), 8, "0")),
            "state": pick(STATES, k),
            "created_at": F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"),
        },
    )


def accounts(customer: DataFrame) -> DataFrame:
    """One account per customer; every 173rd customer adds one with an unknown owner."""
    k = F.col("c_custkey")

    def rows(df: DataFrame, prefix: str, owner: Column) -> DataFrame:
        return _select(
            df,
            {
                "account_id": prefixed(prefix, k),
                "customer_id": owner,
                "account_type": pick(ACCOUNT_TYPES, k),
                "opened_date": days_after("2018-01-01", k % 1500),
                "status": F.lit("ACTIVE"),
            },
        )

    return rows(customer, "A", prefixed("C", k)).unionByName(
        rows(customer.where(every(k, 173)), "AX", F.lit("CUNKNOWN"))
    )


def payers(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    mail = F.when(every(k, 29), _email(k + 1)).otherwise(_email(k))
    return _select(
        customer.where(k % 20 != 4),
        {
            "payer_id": prefixed("P", k),
            "payer_name": F.col("c_name"),
            "email": F.when(every(k, 19), F.lit(None).cast("string"))
            .when(every(k, 23), F.upper(mail))
            .otherwise(mail),
            "created_at": F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"),
        },
    )


def transactions(orders: DataFrame) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return _select(
        orders,
        {
            "transaction_id": prefixed("T", k),
            "payer_id": F.when(~every(k, 37), prefixed("P", c)),
            "account_id": F.when(every(k, 211), "AUNKNOWN")
            .when(every(k, 41), F.lit(None).cast("string"))
            .when(every(k, 43), prefixed("AX", c))
            .otherwise(prefixed("A", c)),
            "txn_date": F.col("o_orderdate").cast("date"),
            "channel": F.when(every(k, 503), "KIOSK").otherwise(pick(CHANNELS, k)),
            "amount_aud": F.col("o_totalprice").cast("decimal(12,2)"),
            "status": chosen(TX_STATUS, F.col("o_orderstatus"), "FAILED"),
        },
    )


def digital_users(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return _select(
        customer.where(k % 15 != 3),
        {
            "digital_user_id": prefixed("U", k),
            "full_name": F.col("c_name"),
            "email": F.when(~every(k, 13), _email(k)),
        },
    )


def _user(k: Column) -> Column:
    return F.when(~every(k, 499), prefixed("U", F.col("user_id")))


def digital_activity(events: DataFrame) -> DataFrame:
    k = F.col("event_id")
    return _select(
        events,
        {
            "activity_id": prefixed("D", k),
            "digital_user_id": _user(k),
            "activity_date": F.col("ts").cast("date"),
            "channel": F.when(every(k, 2), "APP").otherwise("WEB"),
            "activity_type": chosen(ACTIVITY_TYPES, F.col("event_type"), "LOGIN"),
        },
    )


def service_cases(events: DataFrame) -> DataFrame:
    k = F.col("event_id")
    return _select(
        events.where(F.col("event_type") == "error"),
        {
            "case_id": prefixed("SC", k),
            "digital_user_id": _user(k),
            "opened_date": F.col("ts").cast("date"),
            "case_type": pick(CASE_TYPES, k),
            "status": F.when(every(k, 5), "OPEN").when(every(k, 5, 1), "PENDING").otherwise("CLOSED"),
            "severity": pick(SEVERITIES, k),
        },
    )


def loose_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The seven source tables of the permissive contract."""
    return Sources(
        spark,
        sf_dir,
        {
            "customers": (customers, "customer"),
            "accounts": (accounts, "customer"),
            "payers": (payers, "customer"),
            "transactions": (transactions, "orders"),
            "digital_users": (digital_users, "customer"),
            "digital_activity": (digital_activity, "events"),
            "service_cases": (service_cases, "events"),
        },
    )
