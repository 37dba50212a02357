"""Catalogues of source checks: the published contract and the derived sources."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.functions import id_number
from ledgerweave.operators.scorecard import Check
from ledgerweave.operators.union import union_all
from ledgerweave.sources import bank_adapter as bank
from ledgerweave.sources.schemas import CORE_SOURCES, OPTIONAL_COLUMNS, PRIMARY_KEYS

# How the published scorecard names tables and rules.
TABLE_LABEL = {"customer": "core_customer", "payment_transaction": "transaction"}
KEY_LABEL = {
    "customer": "core_customer_id",
    "account": "account_id",
    "customer_account": "customer_account_pair",
    "payment_customer": "payment_customer_id",
    "payment_transaction": "transaction_id",
    "digital_customer": "digital_customer_id",
    "activity": "activity_id",
    "service_case": "case_id",
}
DOMAINS: dict[str, tuple[str, str, list[str]]] = {
    "domain_customer_segment": ("customer", "customer_segment", ["RETAIL", "BUSINESS", "PREMIUM"]),
    "domain_customer_status": ("customer", "status", ["ACTIVE", "INACTIVE"]),
    "domain_account_status": ("account", "status", ["ACTIVE", "CLOSED"]),
    "domain_account_type": ("account", "account_type", bank.ACCOUNT_TYPES),
    "domain_customer_state": ("customer", "state", bank.STATES),
    "domain_transaction_channel": ("payment_transaction", "channel", bank.CHANNELS),
    "domain_transaction_status": (
        "payment_transaction", "status", ["ACCEPTED", "DECLINED", "REVERSED"],
    ),
    "domain_transaction_type": (
        "payment_transaction", "transaction_type", bank.TRANSACTION_TYPES,
    ),
    "domain_merchant_category": ("payment_transaction", "merchant_category", bank.MERCHANTS),
    "domain_activity_type": (
        "activity", "activity_type",
        ["LOGIN", "VIEW_ACCOUNT", "TRANSFER_FUNDS", "VIEW_TRANSACTION", "UPDATE_PROFILE", "PAY_BILL"],
    ),
    "domain_activity_channel": ("activity", "channel", ["MOBILE", "WEB"]),
    "domain_device_type": ("activity", "device_type", bank.DEVICES),
    "domain_preferred_channel": ("digital_customer", "preferred_channel", bank.PREFERRED_CHANNELS),
    "domain_case_priority": ("service_case", "priority", bank.PRIORITIES),
    "domain_case_status": ("service_case", "status", ["OPEN", "CLOSED", "IN_PROGRESS"]),
    "domain_case_type": ("service_case", "case_type", bank.CASE_TYPES),
}


OUTER_SPACE = "first_name <> TRIM(first_name) OR last_name <> TRIM(last_name)"


@dataclass(frozen=True)
class Contract:
    """What differs between one delivery of the sources and another."""

    id_patterns: Mapping[str, str]
    window: tuple[str, str]
    row_counts: Mapping[str, int]
    # Labelled defects left out of the clean reference checks, as SQL conditions.
    not_fixture: Mapping[str, str]
    fixtures: tuple[Check, ...] = ()


def _columns(table: str) -> list[str]:
    return [part.split()[0] for part in CORE_SOURCES[table].split(", ")]


def required_columns(table: str) -> list[str]:
    optional = OPTIONAL_COLUMNS.get(table, set())
    return [c for c in _columns(table) if c not in optional]


def _label(table: str) -> str:
    return TABLE_LABEL.get(table, table)


def _quoted(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _table_checks(contract: Contract) -> list[Check]:
    checks = []
    for table, keys in PRIMARY_KEYS.items():
        rows = contract.row_counts.get(table, 0)
        checks.append(
            Check(f"row_count_{_label(table)}", table, "rows", expected=rows, family="row_count")
        )
        checks.append(
            Check(
                f"duplicate_{KEY_LABEL[table]}", table, "duplicates", columns=tuple(keys),
                family="duplicate_keys",
            )
        )
        missing = " OR ".join(f"{c} IS NULL" for c in required_columns(table))
        checks.append(
            Check(
                f"null_required_{_label(table)}", table, condition=missing, family="required_null",
                notes=" ".join(required_columns(table)),
            )
        )
    for table, pattern in contract.id_patterns.items():
        checks.append(
            Check(
                f"format_{KEY_LABEL[table]}", table, "format", columns=tuple(PRIMARY_KEYS[table]),
                pattern=pattern, family="id_format", notes=pattern,
            )
        )
    for name, (table, column, values) in DOMAINS.items():
        checks.append(
            Check(
                name, table, condition=f"{column} NOT IN ({_quoted(values)})", family="domain",
                notes=" ".join(values),
            )
        )
    return checks


def _rule_checks(contract: Contract) -> list[Check]:
    lo, hi = contract.window

    def where(name: str, table: str, condition: str, family: str, notes: str = "") -> Check:
        return Check(name, table, condition=condition, family=family, notes=notes)

    def orphans(name: str, table: str, column: str, other: str, other_column: str, family: str) -> Check:
        return Check(
            name, table, "orphans", columns=(column,), other=other, other_columns=(other_column,),
            condition=contract.not_fixture.get(name), family=family,
        )

    return [
        orphans("ownership_customer_missing", "customer_account", "customer_id", "customer", "customer_id", "ownership"),
        orphans("ownership_account_missing", "customer_account", "account_id", "account", "account_id", "ownership"),
        orphans("account_without_owner", "account", "account_id", "customer_account", "account_id", "ownership"),
        Check(
            "account_not_single_owner", "customer_account", "groups", columns=("account_id",),
            having="n <> 1", family="ownership",
        ),
        where("ownership_type_domain", "customer_account", "ownership_type <> 'PRIMARY'", "ownership"),
        where("core_email_null_count", "customer", "email IS NULL", "required_null"),
        where(
            "service_case_close_before_open", "service_case",
            "closed_ts IS NOT NULL AND opened_ts > closed_ts", "temporal",
        ),
        where(
            "service_case_status_timestamp_mismatch", "service_case",
            "(status = 'CLOSED' AND closed_ts IS NULL) OR "
            "(status IN ('OPEN', 'IN_PROGRESS') AND closed_ts IS NOT NULL)", "temporal",
            "a closing time belongs to closed cases only",
        ),
        Check(
            "transaction_outside_90_day_window", "payment_transaction", "window",
            columns=("transaction_ts",), lo=lo, hi=hi, family="window",
        ),
        Check(
            "activity_outside_90_day_window", "activity", "window", columns=("activity_ts",),
            lo=lo, hi=hi, family="window",
        ),
        where("non_positive_transaction_amount", "payment_transaction", "amount <= 0", "amount"),
        where("non_positive_session_minutes", "activity", "session_minutes <= 0", "amount"),
        where("account_currency_not_aud", "account", "currency <> 'AUD'", "amount"),
        where("transaction_currency_not_aud", "payment_transaction", "currency <> 'AUD'", "amount"),
        where("core_name_whitespace", "customer", OUTER_SPACE, "whitespace"),
        orphans("invalid_account_excluding_fixture", "payment_transaction", "account_id", "account", "account_id", "orphans"),
        orphans("missing_payment_customer_excluding_fixture", "payment_transaction", "payment_customer_id", "payment_customer", "payment_customer_id", "orphans"),
        orphans("orphan_activity_excluding_fixture", "activity", "digital_customer_id", "digital_customer", "digital_customer_id", "orphans"),
        orphans("orphan_service_case_excluding_fixture", "service_case", "digital_customer_id", "digital_customer", "digital_customer_id", "orphans"),
        Check(
            "duplicate_business_ref_excluding_fixture", "payment_transaction", "groups",
            columns=("source_transaction_ref",), having="n > 1",
            condition=contract.not_fixture.get("duplicate_business_ref_excluding_fixture"),
            family="group_violation",
        ),
    ]


def source_checks(contract: Contract) -> list[Check]:
    return _table_checks(contract) + _rule_checks(contract) + list(contract.fixtures)


def _present(name: str, expected: int, *parts: tuple[str, str]) -> Check:
    (table, condition), *more = parts
    return Check(
        name, table, condition=condition, expected=expected, group="FIXTURE",
        family="fixture_presence", more=tuple(more),
    )


def _exact(**values: str) -> str:
    return " AND ".join(f"{c} = '{v}'" for c, v in values.items())


# Labelled defects of the published source delivery.
PUBLISHED_FIXTURES = (
    _present(
        "ec01_ec02_core_email", 1,
        ("customer", _exact(customer_id="C0001", email="olivia.nguyen@example.test", phone="0412001001")
         + " AND date_of_birth = DATE '1991-04-12'"),
    ),
    _present(
        "ec02_payment_email_case", 1,
        ("payment_customer", _exact(payment_customer_id="P1001", email="Olivia.Nguyen@EXAMPLE.TEST")
         + " AND date_of_birth = DATE '1991-04-12'"),
    ),
    _present(
        "ec02_digital_email_case", 1,
        ("digital_customer", _exact(digital_customer_id="D1001", email="OLIVIA.NGUYEN@example.test")
         + " AND date_of_birth = DATE '1991-04-12'"),
    ),
    _present("ec04_core_phone", 1, ("customer", _exact(customer_id="C0002", phone="0412345678", email="liam.patel@example.test"))),
    _present("ec04_payment_phone", 1, ("payment_customer", _exact(payment_customer_id="P1002", phone="+61 412 345 678", email="liam.patel@example.test"))),
    _present("ec04_digital_phone", 1, ("digital_customer", _exact(digital_customer_id="D1002", phone="0412 345 678", email="liam.patel@example.test"))),
    _present(
        "ec05_missing_phone_three_sources", 3,
        ("customer", "customer_id = 'C0005' AND phone IS NULL"),
        ("payment_customer", "payment_customer_id = 'P1005' AND phone IS NULL"),
        ("digital_customer", "digital_customer_id = 'D1005' AND phone IS NULL"),
    ),
    Check(
        "ec06_unmatched_p9999", "payment_customer", "orphans", condition="payment_customer_id = 'P9999'",
        columns=("UPPER(TRIM(first_name))", "UPPER(TRIM(last_name))", "date_of_birth"), other="customer",
        other_columns=("UPPER(TRIM(first_name))", "UPPER(TRIM(last_name))", "date_of_birth"),
        expected=1, group="FIXTURE", family="fixture_no_core_match",
    ),
    _present("ec07_duplicate_bref_000100", 2, ("payment_transaction", "source_transaction_ref = 'BREF-000100' AND transaction_id IN ('T000100', 'T002001')")),
    _present("ec08_invalid_account_a99999", 1, ("payment_transaction", _exact(transaction_id="T000250", account_id="A99999"))),
    _present("ec09_ambiguous_core_name", 2, ("customer", _exact(first_name="Alex", last_name="Nguyen"))),
    Check(
        "ec09_ambiguous_payment_p8888", "payment_customer", "orphans",
        condition=_exact(payment_customer_id="P8888", first_name="Alex", last_name="Nguyen"),
        columns=("date_of_birth", "LOWER(email)"), other="customer",
        other_columns=("date_of_birth", "LOWER(email)"),
        expected=1, group="FIXTURE", family="fixture_no_core_match",
    ),
    _present(
        "ec10_whitespace_and_gmail_case", 3,
        ("customer", _exact(customer_id="C0010", first_name="John", last_name="Smith", email="john.smith@gmail.com")),
        ("payment_customer", _exact(payment_customer_id="P1010", first_name=" John ", last_name="SMITH", email="John.Smith@GMAIL.COM")),
        ("digital_customer", _exact(digital_customer_id="D1010", first_name="JOHN", last_name=" Smith ", email="john.smith@gmail.com")),
    ),
    _present("ec11_orphan_activity", 1, ("activity", _exact(activity_id="ACT000050", digital_customer_id="D0000"))),
    _present("ec12_orphan_service_case", 1, ("service_case", _exact(case_id="SC00020", digital_customer_id="D0000"))),
    _present("ec13_unknown_payment_customer", 1, ("payment_transaction", _exact(transaction_id="T002002", payment_customer_id="P0000"))),
    _present("ec14_no_digital_profile", 0, ("digital_customer", "digital_customer_id = 'D1003'")),
    _present("ec14_payment_profile_present", 1, ("payment_customer", "payment_customer_id = 'P1003'")),
    _present("ec15_no_payment_profile", 0, ("payment_customer", "payment_customer_id = 'P1004'")),
    _present("ec15_digital_profile_present", 1, ("digital_customer", "digital_customer_id = 'D1004'")),
    _present("payment_name_whitespace_rows", 1, ("payment_customer", OUTER_SPACE)),
    _present("digital_name_whitespace_rows", 1, ("digital_customer", OUTER_SPACE)),
)

# Identifiers, sizes and observation window of the published delivery.
PUBLISHED = Contract(
    id_patterns={
        "customer": "^C[0-9]{4}$",
        "account": "^A[0-9]{5}$",
        "payment_customer": "^P[0-9]{4}$",
        "payment_transaction": "^T[0-9]{6}$",
        "digital_customer": "^D[0-9]{4}$",
        "activity": "^ACT[0-9]{6}$",
        "service_case": "^SC[0-9]{5}$",
    },
    window=("2026-01-01 00:00:00", "2026-04-01 00:00:00"),
    row_counts={
        "customer": 200, "account": 300, "customer_account": 300, "payment_customer": 191,
        "payment_transaction": 2002, "digital_customer": 186, "activity": 1000, "service_case": 100,
    },
    not_fixture={
        "invalid_account_excluding_fixture": "transaction_id <> 'T000250'",
        "missing_payment_customer_excluding_fixture": "transaction_id <> 'T002002'",
        "orphan_activity_excluding_fixture": "activity_id <> 'ACT000050'",
        "orphan_service_case_excluding_fixture": "case_id <> 'SC00020'",
        "duplicate_business_ref_excluding_fixture": "source_transaction_ref <> 'BREF-000100'",
    },
    fixtures=PUBLISHED_FIXTURES,
)

DERIVED_FIXTURES = (
    _present("payment_upper_email", 0, ("payment_customer", "email <> LOWER(email)")),
    _present("digital_upper_email", 0, ("digital_customer", "email <> LOWER(email)")),
    _present("payment_international_phone", 0, ("payment_customer", "phone LIKE '+61%'")),
    _present(
        "missing_phone_two_sources", 0,
        ("payment_customer", "phone IS NULL"),
        ("digital_customer", "phone IS NULL"),
    ),
    _present("unknown_account_rows", 0, ("payment_transaction", "account_id = 'AUNKNOWN'")),
    _present("unknown_payer_rows", 0, ("payment_transaction", "payment_customer_id = 'PUNKNOWN'")),
    _present("orphan_activity_rows", 0, ("activity", "digital_customer_id = 'DUNKNOWN'")),
    _present("orphan_case_rows", 0, ("service_case", "digital_customer_id = 'DUNKNOWN'")),
    Check(
        "payer_without_core_person", "payment_customer", "orphans",
        condition="date_of_birth IS NOT NULL",
        columns=("UPPER(TRIM(first_name))", "UPPER(TRIM(last_name))", "date_of_birth"),
        other="customer",
        other_columns=("UPPER(TRIM(first_name))", "UPPER(TRIM(last_name))", "date_of_birth"),
        group="FIXTURE", family="fixture_no_core_match",
    ),
    Check(
        "payer_without_core_contact", "payment_customer", "orphans",
        condition="email IS NOT NULL",
        columns=("date_of_birth", "LOWER(email)"), other="customer",
        other_columns=("date_of_birth", "LOWER(email)"),
        group="FIXTURE", family="fixture_no_core_match",
    ),
    _present("payment_name_whitespace_rows", 0, ("payment_customer", OUTER_SPACE)),
    _present("digital_name_whitespace_rows", 0, ("digital_customer", OUTER_SPACE)),
)

DERIVED = Contract(
    id_patterns={
        "customer": "^C[0-9]{12}$",
        "account": "^A[0-9]{12}$",
        "payment_customer": "^[PXY][0-9]{12}$",
        "payment_transaction": "^T[0-9]{12}$",
        "digital_customer": "^D[0-9]{12}$",
        "activity": "^ACT[0-9]{12}$",
        "service_case": "^SC[0-9]{12}$",
    },
    window=("1995-01-01 00:00:00", "2024-02-01 00:00:00"),
    row_counts={},
    not_fixture={
        "invalid_account_excluding_fixture": "account_id <> 'AUNKNOWN'",
        "missing_payment_customer_excluding_fixture": "payment_customer_id <> 'PUNKNOWN'",
        "orphan_activity_excluding_fixture": "digital_customer_id <> 'DUNKNOWN'",
        "orphan_service_case_excluding_fixture": "digital_customer_id <> 'DUNKNOWN'",
        "duplicate_business_ref_excluding_fixture":
            "CAST(SUBSTRING(source_transaction_ref, 6) AS BIGINT) % 97 <> 0",
    },
    fixtures=DERIVED_FIXTURES,
)


def derived_expectations(spark: SparkSession, sf_dir: str, names: set[str]) -> DataFrame | None:
    """(check_name, expected_count) of the named checks, from the keys of the test tables.

    One pass per table; tables without a named check are not read.
    """
    n = F.count(F.lit(1))
    k, o, e = F.col("c_custkey"), F.col("o_orderkey"), F.col("event_id")
    payer, digital, is_case = (k % 20) != 4, (k % 15) != 3, F.col("event_type") == "error"
    without_profile = (e % 499 != 0) & (F.col("user_id") % 15 == 3)
    accounts = n + F.count_if(k % 2 == 0)
    measures = {
        "customer": {
            "row_count_core_customer": n,
            "row_count_account": accounts,
            "row_count_customer_account": accounts,
            # The profile (if any) plus the twin (if any); suppliers are added below.
            "row_count_payment_customer": F.count_if(payer) + F.count_if(k % 121 == 0),
            "row_count_digital_customer": F.count_if(digital),
            "payment_upper_email": F.count_if(payer & (k % 17 != 0) & (k % 3 == 0)),
            "digital_upper_email": F.count_if(digital & (k % 19 != 0) & (k % 4 == 0)),
            "payment_international_phone": F.count_if(payer & (k % 19 != 0) & (k % 5 == 0)),
            "missing_phone_two_sources": F.count_if(payer & (k % 19 == 0))
            + F.count_if(k % 121 == 0)
            + F.count_if(digital & (k % 11 == 0)),
            "payment_name_whitespace_rows": F.count_if(payer & (k % 7 == 0)),
            "digital_name_whitespace_rows": F.count_if(digital & (k % 9 == 0)),
            "null_required_payment_customer": F.count_if(payer & (k % 11 == 0)) + F.count_if(k % 121 == 0),
            "null_required_digital_customer": F.count_if(digital & (k % 13 == 0)),
            # A wrong birth date hides the person, a missing one the contact; twins have none.
            "payer_without_core_person": F.count_if(payer & (k % 11 != 0) & (k % 13 == 0)),
            "payer_without_core_contact": F.count_if(
                payer & (k % 17 != 0) & ((k % 11 == 0) | (k % 13 == 0))
            )
            + F.count_if(k % 121 == 0),
        },
        "supplier": {
            "row_count_payment_customer": n, "missing_phone_two_sources": n, "payer_without_core_person": n,
        },
        "orders": {
            "row_count_transaction": n,
            "unknown_account_rows": F.count_if(o % 211 == 0),
            "unknown_payer_rows": F.count_if(o % 223 == 0),
            "missing_payment_customer_excluding_fixture": F.count_if(
                (o % 223 != 0) & (F.col("o_custkey") % 20 == 4)
            ),
        },
        "events": {
            "row_count_activity": n,
            "row_count_service_case": F.count_if(is_case),
            "orphan_activity_rows": F.count_if(e % 499 == 0),
            "orphan_case_rows": F.count_if(is_case & (e % 499 == 0)),
            "orphan_activity_excluding_fixture": F.count_if(without_profile),
            "orphan_service_case_excluding_fixture": F.count_if(is_case & without_profile),
        },
    }
    parts = []
    for table, all_lines in measures.items():
        lines = {name: m for name, m in all_lines.items() if name in names}
        if lines:
            row = bank.read_table(spark, sf_dir, table).agg(
                *[m.cast("bigint").alias(name) for name, m in lines.items()]
            )
            parts.append(row.unpivot([], list(lines), "check_name", "expected_count"))
    if not parts:
        return None
    return (
        union_all(parts)
        .groupBy("check_name")
        .agg(F.sum("expected_count").cast("bigint").alias("expected_count"))
    )


def defect_list(
    tables: Mapping[str, DataFrame], repeated_refs: DataFrame
) -> DataFrame:
    """Every row with a broken reference or a repeated business reference."""

    def orphans(kind: str, table: str, key: str, column: str, other: str, other_column: str) -> DataFrame:
        partner = tables[other].select(F.col(other_column).alias(column))
        return tables[table].join(partner, column, "left_anti").select(
            F.lit(kind).alias("fixture_type"),
            F.col(key).alias("entity_id"),
            F.col(column).alias("detail_value"),
        )

    tx = tables["payment_transaction"]
    repeated = tx.join(repeated_refs, "source_transaction_ref", "left_semi").select(
        F.lit("DUPLICATE_SOURCE_REF").alias("fixture_type"),
        F.col("transaction_id").alias("entity_id"),
        F.col("source_transaction_ref").alias("detail_value"),
    )
    return (
        repeated.unionByName(orphans("INVALID_ACCOUNT", "payment_transaction", "transaction_id", "account_id", "account", "account_id"))
        .unionByName(orphans("MISSING_PAYMENT_CUSTOMER", "payment_transaction", "transaction_id", "payment_customer_id", "payment_customer", "payment_customer_id"))
        .unionByName(orphans("ORPHAN_ACTIVITY", "activity", "activity_id", "digital_customer_id", "digital_customer", "digital_customer_id"))
        .unionByName(orphans("ORPHAN_SERVICE_CASE", "service_case", "case_id", "digital_customer_id", "digital_customer", "digital_customer_id"))
    )


def identity_side_by_side(
    tables: Mapping[str, DataFrame], offset: int = 1000, length: int = 4
) -> DataFrame:
    """Core, payment and digital copies of a person on one line, paired by id number.

    Payment profiles whose number belongs to no core customer follow with an
    empty core side.
    """
    fields = {"first_name": "first_name", "last_name": "last_name", "date_of_birth": "dob",
              "email": "email", "phone": "phone"}

    def side(table: str, prefix: str, id_column: str, shift: int) -> DataFrame:
        return tables[table].select(
            (id_number(F.col(id_column), 2, length) - shift).alias("_n"),
            F.col(id_column).alias(f"{prefix}_customer_id"),
            *[F.col(c).alias(f"{prefix}_{short}") for c, short in fields.items()],
        )

    core = side("customer", "core", "customer_id", 0)
    pay = side("payment_customer", "payment", "payment_customer_id", offset)
    dig = side("digital_customer", "digital", "digital_customer_id", offset)
    columns = [f"{p}_customer_id" for p in ("core", "payment", "digital")] + [
        f"{p}_{short}" for short in fields.values() for p in ("core", "payment", "digital")
    ]
    paired = core.join(pay, "_n", "left").join(dig, "_n", "left").select(*columns)
    alone = pay.join(core.select("_n"), "_n", "left_anti")
    return paired.unionByName(alone.drop("_n"), allowMissingColumns=True).select(*columns)
