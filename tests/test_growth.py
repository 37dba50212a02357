"""Steps that must not grow faster than their input, in time or in the memory of one task."""

import re

from pyspark.sql import functions as F

from conftest import SF_DIR
from ledgerweave.operators import disposition as dp
from ledgerweave.operators import identity as idn
from ledgerweave.operators import one_scan
from ledgerweave.plans.warehouse import Warehouse
from ledgerweave.sources.bank_adapter import bank_sources


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_transactions_are_not_joined_back_on_their_id(spark, ws):
    """Rows keep their columns on the way, so rows without an id stay what they are."""
    tx = spark.createDataFrame(
        [(None, "R1", "P1", "A1", "ACCEPTED", 1), (None, "R2", "P1", "A1", "ACCEPTED", 2),
         ("T3", "R3", "P1", "A1", "ACCEPTED", 3), ("T4", "R3", "P1", "A1", "ACCEPTED", 4)],
        "transaction_id string, source_transaction_ref string, payment_customer_id string, "
        "account_id string, status string, amount int",
    )
    xref = spark.createDataFrame(
        [("S2", "P1", 7)], "source_system string, source_customer_id string, customer_key bigint"
    )
    accounts = spark.createDataFrame([("A1", 9)], "account_id string, account_key bigint")
    decided = dp.decide_transactions(ws, "r", tx, xref, accounts)
    assert "transaction_id" not in "".join(re.findall(r"(?:Join|Exchange) [^\n]*", plan_of(decided)))
    got = sorted((r["amount"], r["rn"], r["customer_key"], r["account_key"], r["disposition"]) for r in decided.collect())
    assert got == [
        (1, 1, 7, 9, dp.LOAD), (2, 1, 7, 9, dp.LOAD), (3, 1, 7, 9, dp.LOAD), (4, 2, 7, 9, dp.REJECT_DUPLICATE),
    ]


def test_decisions_are_taken_side_by_side(spark, ws, monkeypatch):
    """No decision waits for another one's write."""
    asked = []
    monkeypatch.setattr(Warehouse, "ready", lambda self, *names: asked.append(names) or dict.fromkeys(names))
    assert Warehouse(spark, bank_sources(spark, SF_DIR), ws).decisions == (None, None, None)
    assert asked == [("tx_decision", "activity_decision", "case_decision")]


def test_sources_of_one_row_group_are_derived_in_several_tasks(spark, ws):
    """A million customers fit into one row group; their profiles are dealt out before they are made."""
    sources = bank_sources(spark, SF_DIR)
    for name in ("customer", "account", "customer_account", "payment_customer", "digital_customer"):
        assert "hashpartitioning(c_custkey" in plan_of(sources[name]), name
    raw = spark.read.parquet(f"{SF_DIR}/customer.parquet").count()
    assert sources["customer"].select("customer_id").distinct().count() == sources["customer"].count() == raw


def test_lookup_keys_sort_by_a_number(spark):
    """Kinds, dates and names share long prefixes; kinds stay apart where their texts are equal."""
    cols = [F.lit("1950-01-01"), F.lit("a")]
    marks = [
        r["m"] for kind in idn._KINDS
        for r in spark.range(1).select(idn._key(kind, *cols)["kind_mark"].alias("m")).collect()
    ]
    assert [m & 3 for m in marks] == [0, 1, 2, 3] and len({m >> 2 for m in marks}) == 1


def test_keys_of_one_scan_task_are_dealt_out(spark):
    """Keys are counted in as many tasks as a shuffle has, however few tasks read the table."""
    rows = spark.range(0, 30_000, 1, 1).select("id", (F.col("id") % 7).alias("g"))
    asked = [
        one_scan.spare_rows("spare", "t", ["id"]), one_scan.groups("groups", "t", ["g"], "n > 1"),
        one_scan.orphans("lost", "t", ["id"], "t", ["g"]), one_scan.holds("small", "t", "id < 5"),
    ]
    lines = one_scan.answers({"t": rows}, asked)
    assert {r["name"]: r["observed"] for r in lines.collect()} == {
        "spare": 0, "groups": 7, "lost": 30_000 - 7, "small": 5,
    }
    assert "REPARTITION_BY_NUM" in plan_of(lines)
    # Without keys there is nothing to hold, so nothing is moved.
    assert "REPARTITION_BY_NUM" not in plan_of(one_scan.answers({"t": rows}, asked[-1:]))
