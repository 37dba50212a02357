"""Declared table constraints as violation counts; Spark enforces none of them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.operators import one_scan
from ledgerweave.operators.union import union_all


@dataclass(frozen=True)
class Rules:
    """Constraints of one table. A unique key may be one column or several together."""

    unique: Sequence[str | tuple[str, ...]] = ()
    not_null: Sequence[str] = ()
    max_length: Mapping[str, int] = field(default_factory=dict)
    references: Mapping[str, tuple[str, str]] = field(default_factory=dict)


def dense_keys(tables: Mapping[str, DataFrame], keys: Iterable[tuple[str, str]]) -> dict[tuple[str, str], int]:
    """Which of the (table, column) keys hold exactly 1..n, and n. One job for all of them."""
    spans = [
        tables[table].agg(
            F.lit(table).alias("table"), F.lit(column).alias("column"), F.count(column).alias("n"),
            F.count(F.lit(1)).alias("rows"), F.count_distinct(column).alias("different"),
            F.min(column).cast("bigint").alias("lo"), F.max(column).cast("bigint").alias("hi"),
        )
        for table, column in sorted(set(keys))
    ]
    if not spans:
        return {}
    whole = "lo = 1 AND hi = n AND different = n AND rows = n"
    return {(r["table"], r["column"]): r["n"] for r in union_all(spans).where(whole).collect()}


def reference(
    name: str, table: str, column: str, other: tuple[str, str], dense: Mapping[tuple[str, str], int],
    null_counts: bool = False,
) -> one_scan.Question:
    """Rows whose key has no partner. Where the keys referred to are 1..n, a comparison decides
    and nothing is shuffled; other keys are counted beside those they refer to."""
    size = dense.get(other)
    if size is not None:
        outside = f"coalesce({column} < 1 OR {column} > {size}, {str(null_counts).lower()})"
        return one_scan.holds(name, table, outside)
    return one_scan.orphans(name, table, [column], other[0], [other[1]], open_counts=null_counts)


def violations(tables: Mapping[str, DataFrame], rules: Mapping[str, Rules]) -> DataFrame:
    """(table_name, constraint, violations) for every declared constraint; each table is read once
    (and its key before, where a table refers to it)."""
    dense = dense_keys(tables, (other for rule in rules.values() for other in rule.references.values()))
    questions = []
    for name, rule in rules.items():
        def named(constraint: str, name: str = name) -> str:
            return f"{name}.{constraint}"

        questions += [one_scan.holds(named(f"not_null {c}"), name, f"{c} IS NULL") for c in rule.not_null]
        questions += [
            one_scan.holds(named(f"length {c} <= {n}"), name, f"length({c}) > {n}") for c, n in rule.max_length.items()
        ]
        for unique in rule.unique:
            columns = (unique,) if isinstance(unique, str) else unique
            question = one_scan.repeated_keys(
                named("unique " + ", ".join(columns)), name, columns, len(columns) > 1
            )
            questions.append(question)
        questions += [
            reference(named(f"references {c}"), name, c, other, dense) for c, other in rule.references.items()
        ]
    found = one_scan.answers(tables, questions)
    return found.select(
        F.substring_index("name", ".", 1).alias("table_name"),
        F.expr("substring(name, instr(name, '.') + 1)").alias("constraint"),
        F.col("observed").alias("violations"),
    )


def lossless(tables: Mapping[str, DataFrame], casts: Mapping[str, tuple[str, str, str, str]]) -> DataFrame:
    """(table_name, constraint, violations): values that the declared type of a column cannot hold.

    ``casts`` names, per ``table.column`` of the warehouse, the frame, the rows and the column that
    it is made from, and its declared type. A value fits if casting it there changes nothing.
    """
    questions = []
    for target, (frame, rows, column, kind) in casts.items():
        fits = f"try_cast({column} AS {kind}) <=> {column}"
        questions.append(one_scan.holds(f"{target}.{kind}", frame, f"({rows}) AND NOT ({fits})"))
    parts = F.split("name", "[.]")
    return one_scan.answers(tables, questions).select(
        parts[0].alias("table_name"),
        F.concat(F.lit("lossless "), parts[1], F.lit(" "), parts[2]).alias("constraint"),
        F.col("observed").alias("violations"),
    )


# Constraints declared on the warehouse tables.
WAREHOUSE_RULES: dict[str, Rules] = {
    "dim_customer": Rules(
        unique=["customer_key", "core_customer_id"],
        not_null=["full_name", "match_quality"],
        max_length={"full_name": 120, "email": 120, "state": 3, "match_quality": 40},
    ),
    "dim_account": Rules(
        unique=["account_key", "account_id"],
        not_null=["account_id", "customer_key", "account_type", "opened_date", "status", "source_system"],
        max_length={"account_id": 40, "account_type": 40, "status": 40, "source_system": 2},
        references={"customer_key": ("dim_customer", "customer_key")},
    ),
    "dim_date": Rules(
        unique=["date_key", "full_date"],
        not_null=["full_date", "day_of_week", "month_no", "quarter_no", "year_no"],
        max_length={"day_of_week": 40},
    ),
    "dim_channel": Rules(
        unique=["channel_key", "channel_code"],
        not_null=["channel_code", "channel_name"],
        max_length={"channel_code": 40, "channel_name": 40},
    ),
    "customer_xref": Rules(
        unique=["xref_key", ("source_system", "source_customer_id")],
        not_null=["source_system", "source_customer_id", "match_rule", "match_status"],
        max_length={"source_system": 2, "source_customer_id": 50, "match_rule": 40, "match_status": 40},
        references={"customer_key": ("dim_customer", "customer_key")},
    ),
    "fact_transaction": Rules(
        unique=["transaction_key", "transaction_id", "source_transaction_ref"],
        not_null=[
            "transaction_id", "date_key", "channel_key", "amount_aud", "transaction_count", "status",
        ],
        max_length={"transaction_id": 50, "status": 40},
        references={
            "customer_key": ("dim_customer", "customer_key"),
            "account_key": ("dim_account", "account_key"),
            "date_key": ("dim_date", "date_key"),
            "channel_key": ("dim_channel", "channel_key"),
        },
    ),
    "fact_activity": Rules(
        unique=["activity_key", "activity_id"],
        not_null=["activity_id", "date_key", "channel_key", "activity_type", "activity_count"],
        max_length={"activity_id": 50, "activity_type": 50},
        references={
            "customer_key": ("dim_customer", "customer_key"),
            "date_key": ("dim_date", "date_key"),
            "channel_key": ("dim_channel", "channel_key"),
        },
    ),
    "fact_service_case": Rules(
        unique=["case_key", "case_id"],
        not_null=["case_id", "date_key", "case_type", "status", "severity", "case_count"],
        max_length={"case_id": 50, "case_type": 50, "status": 40, "severity": 40},
        references={
            "customer_key": ("dim_customer", "customer_key"),
            "date_key": ("dim_date", "date_key"),
        },
    ),
    "rejected_record": Rules(
        not_null=["source_system", "source_table", "source_key", "reason"],
        max_length={"source_system": 2, "source_table": 40, "source_key": 40, "reason": 80},
    ),
}

# Declared types that may be narrower than what they are made from, as
# table.column -> (frame, rows of it, column, type).
WAREHOUSE_CASTS = {
    "fact_transaction.amount_aud": ("tx_decision", "disposition = 'LOAD'", "amount", "decimal(12,2)"),
    "rejected_record.amount_aud": ("tx_decision", "disposition LIKE 'REJECT%'", "amount", "decimal(15,2)"),
}
