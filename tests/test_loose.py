"""The permissive contract on its five-customer sources (names are made up)."""

from datetime import date
from decimal import Decimal

import pytest

from ledgerweave.operators.fingerprint import compare_builds, fingerprints
from ledgerweave.plans import loose, reports
from ledgerweave.plans.loose import LooseWarehouse
from ledgerweave.sources.schemas import LOOSE_SOURCES


def day(d: int) -> date:
    return date(2026, 8, d)


def rows():
    shared = ("Ada Moss", date(1988, 4, 12), "ada@example.com")
    return {
        "customers": [
            ("C001", *shared, None, "NSW", None),
            ("C002", "Ben Hale", date(1975, 11, 3), "ben@example.com", None, "VIC", None),
            ("C003", "Cleo Dunn", date(1992, 7, 21), None, None, "QLD", None),
            ("C004", *shared, None, "NSW", None),
            ("C005", "Dan Frost", date(2000, 2, 29), "dan@example.com", None, "WA", None),
        ],
        "accounts": [
            (a, c, "SAVINGS", date(2020, 1, 1), "ACTIVE")
            for a, c in [("A1001", "C001"), ("A1002", "C001"), ("A1003", "C002"), ("A1004", "C003"), ("A1005", "C005")]
        ],
        "payers": [
            ("P001", "Ada Moss", "ada@example.com", None), ("P002", "Ben Hale", "ben@example.com", None),
            ("P003", "Eve Lark", "eve@example.com", None), ("P004", "A Moss", "ada@example.com", None),
            ("P005", "Cleo Dunn", None, None),
        ],
        "transactions": [
            (t, p, a, day(d), ch, Decimal(amount), status)
            for t, p, a, d, ch, amount, status in [
                ("T0001", "P001", "A1001", 1, "APP", "125.50", "SETTLED"),
                ("T0002", "P001", "A1002", 1, "EFTPOS", "64.00", "SETTLED"),
                ("T0003", "P002", "A1003", 2, "WEB", "980.75", "SETTLED"),
                ("T0004", "P003", None, 2, "APP", "15.00", "SETTLED"),
                ("T0005", "P004", None, 3, "ATM", "200.00", "SETTLED"),
                ("T0006", "P005", "A1004", 3, "BRANCH", "450.25", "SETTLED"),
                ("T0007", "P001", "A9999", 4, "APP", "33.10", "SETTLED"),
                ("T0008", "P002", "A1003", 4, "APP", "12.00", "PENDING"),
            ]
        ],
        "digital_users": [
            ("U001", "Ada Moss", "ada@example.com"), ("U002", "Ben Hale", "ben@example.com"),
            ("U003", "Fay Blue", "fay@example.com"), ("U004", "Cleo Dunn", None),
        ],
        "digital_activity": [
            (f"D{i:04d}", u, day(1 + i // 2), "APP", "LOGIN")
            for i, u in enumerate(["U001", "U001", "U002", "U003", "U004", "U001"], 1)
        ],
        "service_cases": [
            (f"SC{i:03d}", u, day(1 + i), "CARD_DISPUTE", "OPEN", "HIGH")
            for i, u in enumerate(["U001", "U002", "U003", "U001"], 1)
        ],
    }


@pytest.fixture(scope="module")
def wh(spark):
    sources = {n: spark.createDataFrame(r, LOOSE_SOURCES[n]) for n, r in rows().items()}
    return LooseWarehouse(spark, sources)


def test_published_totals(wh):
    assert wh.dim_customer.count() == 4
    status = [r["match_status"] for r in wh.xref_rows.collect()]
    assert (status.count("matched"), status.count("ambiguous"), status.count("unmatched")) == (8, 2, 4)
    ambiguous = {r["source_customer_id"] for r in wh.xref_rows.collect() if r["match_status"] == "ambiguous"}
    assert ambiguous == {"P001", "P004"}
    money = reports.attribution(wh.transaction_rows, wh.activity_rows, wh.case_rows).first()
    assert money["total_rows"] == 6 and money["unattributed_rows"] == 5
    assert money["total_amount_aud"] == Decimal("1835.50")
    assert money["attributed_amount_aud"] == Decimal("980.75")
    assert [r["source_key"] for r in wh.rejected_record.collect()] == ["T0007"]


def test_every_check_passes(wh):
    for check in (loose.settled_reconciliation, loose.orphan_keys, loose.duplicate_natural_keys,
                  loose.account_links_kept, loose.merged_names):
        assert all(r["result"] == "PASS" for r in check(wh).collect()), check.__name__


def test_accounts_are_linked(wh):
    keys = {r["transaction_id"]: r["account_key"] for r in wh.transaction_rows.collect()}
    assert keys["T0001"] is not None and keys["T0004"] is None


def test_fingerprints_ignore_layout_but_not_content(wh):
    tables = loose.fingerprint_tables(wh)
    first = fingerprints(tables, loose.FINGERPRINT_COLUMNS)
    moved = fingerprints({n: df.repartition(3) for n, df in tables.items()}, loose.FINGERPRINT_COLUMNS)
    assert all(r["equal"] for r in compare_builds(first, moved).collect())
    changed = dict(tables, dim_customer=tables["dim_customer"].na.fill("?", ["email"]))
    again = fingerprints(changed, loose.FINGERPRINT_COLUMNS)
    wrong = [r["table_name"] for r in compare_builds(first, again).collect() if not r["equal"]]
    assert wrong == ["dim_customer"]
    assert not any(r["equal"] for r in compare_builds(first.limit(0), first).collect())
