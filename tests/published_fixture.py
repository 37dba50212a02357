"""The published bank sources rebuilt by rule: sizes, gaps and labelled defects.

People and amounts are generated; identifiers, missing profiles and defects are
those of the source contract, because the scorecard names them.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

from ledgerweave.sources.schemas import CORE_SOURCES
from ledgerweave.sources import bank_adapter as bank

NO_PAYMENT = {4, *range(20, 201, 20)}
NO_DIGITAL = {3, *range(15, 201, 15)}
SPECIAL = {
    1: ("Olivia", "Nguyen", date(1991, 4, 12), "olivia.nguyen@example.test", "0412001001"),
    2: ("Liam", "Patel", date(1988, 11, 3), "liam.patel@example.test", "0412345678"),
    10: ("John", "Smith", date(1986, 6, 15), "john.smith@gmail.com", "0412001010"),
    11: ("Alex", "Nguyen", date(1990, 3, 15), "alex.nguyen.11@example.test", "0411110011"),
    12: ("Alex", "Nguyen", date(1985, 7, 22), "alex.nguyen.12@example.test", "0411110012"),
}
OTHER_COPY = {
    "P": {
        1: ("Olivia", "Nguyen", SPECIAL[1][2], "Olivia.Nguyen@EXAMPLE.TEST", "0412001001"),
        2: (*SPECIAL[2][:4], "+61 412 345 678"),
        10: (" John ", "SMITH", SPECIAL[10][2], "John.Smith@GMAIL.COM", "0412001010"),
    },
    "D": {
        1: ("Olivia", "Nguyen", SPECIAL[1][2], "OLIVIA.NGUYEN@example.test", "0412001001"),
        2: (*SPECIAL[2][:4], "0412 345 678"),
        10: ("JOHN", " Smith ", SPECIAL[10][2], "john.smith@gmail.com", "0412001010"),
    },
}


def person(n: int, system: str = "C") -> tuple:
    own = (f"Given{n}", f"Family{n}", date(1960, 1, 1) + timedelta(days=61 * n),
           f"person{n}@example.test", None if n == 5 else f"04{n:08d}")
    return OTHER_COPY.get(system, {}).get(n) or SPECIAL.get(n) or own


def rows() -> dict[str, list[tuple]]:
    start = datetime(2026, 1, 1, 0, 17)
    everyone = range(1, 201)
    payers = [n for n in everyone if n not in NO_PAYMENT]
    users = [n for n in everyone if n not in NO_DIGITAL]
    owner = {a: a if a <= 100 else a - 100 for a in range(1, 301)}
    day = date(2018, 1, 1)
    out = {
        "customer": [
            (f"C{n:04d}", *person(n), "1 Road", "Town", bank.STATES[n % 8], "2000", "RETAIL", day, "ACTIVE")
            for n in everyone
        ],
        "account": [
            (f"A{a:05d}", "SAVINGS", "Saver", day, Decimal("10.00"), "AUD", "ACTIVE") for a in owner
        ],
        "customer_account": [(f"C{n:04d}", f"A{a:05d}", "PRIMARY", day) for a, n in owner.items()],
        "payment_customer": [(f"P{1000 + n}", *person(n, "P"), day) for n in payers]
        + [
            ("P9999", "Quinn", "Harper", date(1995, 12, 1), "quinn.harper.p9999@example.test", "0419999999", day),
            ("P8888", "Alex", "Nguyen", date(1979, 1, 1), "alex.nguyen.other@example.test", None, day),
        ],
        "digital_customer": [(f"D{1000 + n}", *person(n, "D"), day, "WEB") for n in users],
        "activity": [
            (f"ACT{i:06d}", "D0000" if i == 50 else f"D{1000 + users[i % len(users)]}",
             start + timedelta(hours=2 * i), ["MOBILE", "WEB"][i % 2], "LOGIN", "TABLET", Decimal("4.25"))
            for i in range(1, 1001)
        ],
        "service_case": [
            (f"SC{i:05d}", "D0000" if i == 20 else f"D{1000 + users[i]}", start + timedelta(days=i % 90),
             None if i % 5 < 2 else start + timedelta(days=i % 90, hours=3), "CARD_ISSUE",
             bank.PRIORITIES[i % 3], ["OPEN", "IN_PROGRESS", "CLOSED", "CLOSED", "CLOSED"][i % 5])
            for i in range(1, 101)
        ],
    }

    def tx(i: int, ref: int, ts: datetime, status: str) -> tuple:
        n = payers[i % len(payers)]
        account = "A99999" if i == 250 else f"A{n:05d}" if n <= 100 else f"A{n + 100:05d}"
        return (f"T{i:06d}", f"BREF-{ref:06d}", f"P{1000 + n}", account, ts, "PURCHASE",
                Decimal(i) + Decimal("0.25"), "AUD", bank.CHANNELS[i % 5], "FUEL", status)

    moments = {i: start + timedelta(minutes=60 * i) for i in range(1, 2001)}
    status = {i: "DECLINED" if i % 10 == 3 else "ACCEPTED" for i in moments}
    transactions = [tx(i, i, moments[i], status[i]) for i in moments]
    first = transactions[99]
    transactions.append(("T002001", *first[1:4], first[4] + timedelta(minutes=5), *first[5:10], "ACCEPTED"))
    transactions.append(
        ("T002002", "BREF-ORPHAN-0001", "P0000", "A00001", datetime(2026, 2, 15, 10, 30), "PURCHASE",
         Decimal("42.50"), "AUD", "WEB", "RETAIL", "ACCEPTED")
    )
    out["payment_transaction"] = transactions
    return out


def sources(spark):
    return {name: spark.createDataFrame(data, CORE_SOURCES[name]) for name, data in rows().items()}
