"""Test people added to the sources, and how the identity rules must treat them.

The people are laid over the batch's own sources, and the overlay goes through the plan that the
batch was built with, so a rule that changes for a reason nobody saw shows up here.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions import differs
from ledgerweave.operators import identity as idn
from ledgerweave.operators.workspace import Workspace

_PERSON = "first_name string, last_name string, dob string, email string, phone string"


@dataclass(frozen=True)
class Cases:
    """Invented customers, payers and users as (id, first and last name, birth date, e-mail, phone).

    ``expected`` has (source id, core customer or None, rule, status) of every payer and user.
    """

    name: str
    customers: Sequence[tuple]
    payers: Sequence[tuple]
    users: Sequence[tuple]
    expected: Sequence[tuple]


# One core customer stands alone, two share their name and mailbox.
BOUNDARY = Cases(
    "boundary",
    [
        ("ZC-lone", "Mira", "Okafor", "1977-05-09", "mira.okafor@mailbox.test", "0455123987"),
        ("ZC-pair1", "Jonas", "Lindqvist", "1969-02-27", "lindqvist.home@mailbox.test", None),
        ("ZC-pair2", "Jonas", "Lindqvist", "1998-10-30", "lindqvist.home@mailbox.test", None),
    ],
    [
        ("ZP-case-and-blanks", "MIRA", "okafor", None, " Mira.Okafor@Mailbox.Test", None),
        ("ZP-name-only", "Mira", "Okafor", None, None, None),
        ("ZP-shared-mail", "Jonas", "Lindqvist", None, "lindqvist.home@mailbox.test", None),
        ("ZP-married-name", "Mira", "Delacroix", "1977-05-09", None, "+61 455 123 987"),
        ("ZP-blank-mail", "Mira", "Okafor", None, "  ", None),
        ("ZP-stranger", "Tevita", "", None, None, None),
    ],
    # Shares name and e-mail with the first payer, so it comes from another source.
    [("ZU-other-birthday", "Mira", "Okafor", "2003-08-14", "mira.okafor@mailbox.test", None)],
    [
        ("ZP-case-and-blanks", "ZC-lone", idn.R3, idn.MATCHED),
        ("ZP-name-only", None, idn.NONE, idn.UNMATCHED),
        ("ZP-shared-mail", None, idn.R3, idn.AMBIGUOUS),
        ("ZP-married-name", "ZC-lone", idn.R2, idn.MATCHED),
        ("ZP-blank-mail", None, idn.NONE, idn.UNMATCHED),
        ("ZP-stranger", None, idn.NONE, idn.UNMATCHED),
        ("ZU-other-birthday", None, idn.NONE, idn.UNMATCHED),
    ],
)
PAIRS = Cases(
    "pairs",
    [
        ("ZC-solo", "Priya", "Venter", "1984-12-02", "p.venter@mailbox.test", "0466200311"),
        ("ZC-double", "Hugo", "Marsh", "1959-07-21", "hugo@mailbox.test", "0466200312"),
    ],
    [
        ("ZP-solo-open", "Priya", "Venter", None, "p.venter@mailbox.test", None),
        ("ZP-double-1", "Hugo", "Marsh", None, "hugo@mailbox.test", None),
        ("ZP-double-2", "Hugo", "Marsh", None, "hugo@mailbox.test", None),
        ("ZP-solo-conflict", "Priya", "Venter", "1991-03-18", "p.venter@mailbox.test", None),
    ],
    [],
    [
        ("ZP-solo-open", None, idn.R3, idn.AMBIGUOUS),
        ("ZP-double-1", None, idn.R3, idn.AMBIGUOUS),
        ("ZP-double-2", None, idn.R3, idn.AMBIGUOUS),
        ("ZP-solo-conflict", None, idn.NONE, idn.UNMATCHED),
    ],
)
STANDARD = (BOUNDARY, PAIRS)


def overlay(sources: Mapping[str, DataFrame], cases: Cases) -> dict[str, DataFrame]:
    """The sources with the test people added; what a case does not give is null."""
    added = {
        "customer": (cases.customers, "customer_id"),
        "payment_customer": (cases.payers, "payment_customer_id"),
        "digital_customer": (cases.users, "digital_customer_id"),
    }
    out = dict(sources)
    for name, (rows, key) in added.items():
        spark = sources[name].sparkSession
        people = spark.createDataFrame(list(rows), f"{key} string, {_PERSON}")
        people = people.withColumn("date_of_birth", F.col("dob").cast("date")).drop("dob")
        out[name] = sources[name].unionByName(people, allowMissingColumns=True)
    return out


def resolved(
    sources: Mapping[str, DataFrame], cases: Cases, build: Callable[[Mapping[str, DataFrame], Workspace], Any],
    ws: Workspace,
) -> DataFrame:
    """Every payer and user, the batch's and the test people, as the batch's plan resolves them."""
    wh = build(overlay(sources, cases), ws)
    ids = wh.dim_customer.select("customer_key", "core_customer_id")
    found = wh.xref_rows.where(F.col("source_system") != "S1")
    linked = found.where(F.col("customer_key").isNotNull()).join(ids, "customer_key")
    loose_ends = found.where(F.col("customer_key").isNull())
    return linked.unionByName(loose_ends, allowMissingColumns=True).select(
        "source_customer_id", "core_customer_id", "match_rule", "match_status"
    )


def disagreements(
    sources: Mapping[str, DataFrame], every: Sequence[Cases],
    build: Callable[[Mapping[str, DataFrame], Workspace], Any],
) -> int:
    """Test people who are not resolved as expected, or not at all."""
    lost = 0
    for cases in every:
        spark = next(iter(sources.values())).sparkSession
        ws = Workspace(spark, f"cases-{cases.name}")
        try:
            wanted = spark.createDataFrame(
                list(cases.expected), "source_customer_id string, core string, rule string, status string"
            )
            found = resolved(sources, cases, build, ws)
            both = F.broadcast(wanted).join(found, "source_customer_id", "left")
            wrong = (
                differs(F.col("core_customer_id"), F.col("core"))
                | differs(F.col("match_rule"), F.col("rule"))
                | differs(F.col("match_status"), F.col("status"))
            )
            lost += both.where(wrong).count()
        finally:
            ws.release()
    return lost

