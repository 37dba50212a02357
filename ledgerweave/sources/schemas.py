"""Declared schemas of the source systems. Nothing is inferred.

Fixed values: table and column names, types and the required columns follow the
published source contracts, one DDL string per table.
"""

from __future__ import annotations

CORE_SOURCES: dict[str, str] = {
    "customer": (
        "customer_id string, first_name string, last_name string, date_of_birth date, email string, "
        "phone string, address_line string, suburb string, state string, postcode string, "
        "customer_segment string, created_date date, status string"
    ),
    "account": (
        "account_id string, account_type string, product_name string, open_date date, "
        "balance decimal(15,2), currency string, status string"
    ),
    "customer_account": (
        "customer_id string, account_id string, ownership_type string, relationship_from date"
    ),
    "payment_customer": (
        "payment_customer_id string, first_name string, last_name string, date_of_birth date, "
        "email string, phone string, registered_date date"
    ),
    "payment_transaction": (
        "transaction_id string, source_transaction_ref string, payment_customer_id string, "
        "account_id string, transaction_ts timestamp_ntz, transaction_type string, "
        "amount decimal(15,2), currency string, channel string, merchant_category string, status string"
    ),
    "digital_customer": (
        "digital_customer_id string, first_name string, last_name string, date_of_birth date, "
        "email string, phone string, signup_date date, preferred_channel string"
    ),
    "activity": (
        "activity_id string, digital_customer_id string, activity_ts timestamp_ntz, channel string, "
        "activity_type string, device_type string, session_minutes decimal(8,2)"
    ),
    "service_case": (
        "case_id string, digital_customer_id string, opened_ts timestamp_ntz, closed_ts timestamp_ntz, "
        "case_type string, priority string, status string"
    ),
}

OPTIONAL_COLUMNS: dict[str, set[str]] = {
    "customer": {"email", "phone", "address_line", "suburb", "state", "postcode"},
    "payment_customer": {"email", "phone"},
    "digital_customer": {"email", "phone"},
    "service_case": {"closed_ts"},
}

PRIMARY_KEYS: dict[str, list[str]] = {
    "customer": ["customer_id"],
    "account": ["account_id"],
    "customer_account": ["customer_id", "account_id"],
    "payment_customer": ["payment_customer_id"],
    "payment_transaction": ["transaction_id"],
    "digital_customer": ["digital_customer_id"],
    "activity": ["activity_id"],
    "service_case": ["case_id"],
}

LOOSE_SOURCES: dict[str, str] = {
    "customers": (
        "customer_id string, full_name string, date_of_birth date, email string, phone string, "
        "state string, created_at timestamp_ntz"
    ),
    "accounts": (
        "account_id string, customer_id string, account_type string, opened_date date, status string"
    ),
    "payers": "payer_id string, payer_name string, email string, created_at timestamp_ntz",
    "transactions": (
        "transaction_id string, payer_id string, account_id string, txn_date date, channel string, "
        "amount_aud decimal(12,2), status string"
    ),
    "digital_users": "digital_user_id string, full_name string, email string",
    "digital_activity": (
        "activity_id string, digital_user_id string, activity_date date, channel string, "
        "activity_type string"
    ),
    "service_cases": (
        "case_id string, digital_user_id string, opened_date date, case_type string, status string, "
        "severity string"
    ),
}

EXPECTED_IDENTITY = (
    "core_customer_id string, payment_customer_id string, digital_customer_id string, "
    "expected_outcome string, expected_group string, notes string"
)
