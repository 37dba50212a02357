"""Plans and hot groups: what must hold when one key carries a third of all rows."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from ledgerweave.operators import disposition as dp
from ledgerweave.operators import identity as idn
from ledgerweave.operators import keys
from ledgerweave.operators.keys import ordered_rows
from ledgerweave.operators.workspace import Workspace
from ledgerweave.plans import reports
from ledgerweave.plans.shared import warehouse
from ledgerweave.session import shared_folder
from ledgerweave.sources import bank_adapter as bank


@pytest.fixture
def tight(spark):
    """No broadcasts and tiny skew limits, so that small data meets the large-data plans."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.files.maxPartitionBytes": "64KB",
        "spark.sql.files.openCostInBytes": "1KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed_plan(df) -> str:
    df.collect()
    return plan_of(df)


def hot_transactions(spark, hot_ref: bool):
    """Thirty thousand payments, a third of them by one payer (and under one reference)."""
    i = F.col("id")
    hot = i % 3 == 0
    ref = F.when(hot, "HOT").otherwise(bank.prefixed("R", i)) if hot_ref else bank.prefixed("R", i)
    return spark.range(0, 30_000, 1, 8).select(
        bank.prefixed("T", i).alias("transaction_id"),
        ref.alias("source_transaction_ref"),
        F.when(hot, "P0").otherwise(bank.prefixed("P", i % 997)).alias("payment_customer_id"),
        F.when(hot, "A0").otherwise(bank.prefixed("A", i % 991)).alias("account_id"),
        i.cast("decimal(15,2)").alias("amount"),
        F.when(i % 7 == 0, "DECLINED").otherwise("ACCEPTED").alias("status"),
    )


def lookups(spark, ws):
    n = spark.range(2000)
    xref = n.select(
        F.lit("S2").alias("source_system"),
        F.when(F.col("id") == 0, "P0").otherwise(bank.prefixed("P", F.col("id"))).alias("source_customer_id"),
        (F.col("id") + 1).alias("customer_key"),
    )
    accounts = n.select(
        F.when(F.col("id") == 0, "A0").otherwise(bank.prefixed("A", F.col("id"))).alias("account_id"),
        (F.col("id") + 1).alias("account_key"),
    )
    return ws.table("x", lambda: xref), ws.table("a", lambda: accounts)


def test_hot_payer_is_split(spark, ws, tight):
    xref, accounts = lookups(spark, ws)
    tx = ws.table("tx", lambda: hot_transactions(spark, hot_ref=False))
    decided = dp.decide_transactions(ws, "r", tx, xref, accounts)
    joins = re.findall(r"SortMergeJoin\(skew=true\) \[(\w+)#", executed_plan(decided))
    assert {"payment_customer_id", "account_id"} <= set(joins)
    assert decided.count() == 30_000


def test_hot_contact_is_split(spark, ws, tight):
    """A third of all source rows carry the same birth date and e-mail."""
    i = F.col("id")
    anchors = spark.range(500).select(
        (i + 1).alias("customer_key"),
        F.concat(F.lit("name "), i).alias("full_name"),
        F.date_add(F.lit("1960-01-01").cast("date"), i.cast("int")).alias("date_of_birth"),
        F.concat(i, F.lit("@x")).alias("email"),
        F.lit(None).cast("string").alias("phone"),
    )
    who = F.when(i % 3 == 0, 0).otherwise(i % 500)
    people = spark.range(0, 30_000, 1, 8).select(
        F.lit("S2").alias("source_system"),
        bank.prefixed("P", i).alias("source_customer_id"),
        F.concat(F.lit("name "), i).alias("name"),
        F.date_add(F.lit("1960-01-01").cast("date"), who.cast("int")).alias("dob"),
        F.concat(who, F.lit("@x")).alias("email"),
        F.lit(None).cast("string").alias("phone"),
    )
    people = ws.table("people", lambda: people)
    found = idn.resolve(ws, "id", anchors, people, ["S2"])
    assert "SortMergeJoin(skew=true) [kind" in executed_plan(found)
    assert found.where("match_status = 'matched' and customer_key = 1").count() >= 10_000


@pytest.mark.parametrize("limit", [5_000, 1_000_000])  # across range partitions, in one window
def test_hot_reference_is_ranked_exactly(spark, ws, tight, monkeypatch, limit):
    monkeypatch.setattr(keys, "HOT_ROWS", limit)
    xref, accounts = lookups(spark, ws)
    tx = ws.table("tx", lambda: hot_transactions(spark, hot_ref=True))
    decided = dp.decide_transactions(ws, "r", tx, xref, accounts)
    got = {r["disposition"]: r["count"] for r in decided.groupBy("disposition").count().collect()}
    assert got["REJECT_DUPLICATE"] == 9_999
    kept = decided.where("source_transaction_ref = 'HOT' and rn = 1").collect()
    assert [r["transaction_id"] for r in kept] == ["T000000000000"]
    assert decided.agg(F.max("rn")).first()[0] == 10_000


def test_key_order_needs_no_single_partition(spark, ws):
    df = bank.read_table(spark, SF_DIR, "orders").select("o_orderkey")
    seen = {}

    class Spy(Workspace):
        def table(self, name, build, partition_by=()):
            seen[name] = plan_of(build())
            return super().table(name, build, partition_by)

    spy = Spy(spark, "spy")
    ordered_rows(spy, "k", df, ["o_orderkey"])
    assert "rangepartitioning" in seen["k"] and "SinglePartition" not in seen["k"]


def test_scan_reads_only_what_the_report_needs(spark):
    plan = plan_of(reports.transactions_by_channel(warehouse(spark, SF_DIR)))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    facts = [s for s in schemas if "amount_aud" in s]
    assert facts == ["channel_key:bigint,amount_aud:decimal(12,2)"]


def test_identity_filter_prunes_to_one_system(spark):
    wh = warehouse(spark, SF_DIR)
    plan = plan_of(dp.identities_of(wh.xref_rows, "S2", "payment_customer_id"))
    assert re.search(r"PartitionFilters: \[[^\]]*source_system[^\]]*= S2", plan)


def test_no_python_in_the_plans(spark):
    wh = warehouse(spark, SF_DIR)
    for report in reports.REPORTS.values():
        plan = plan_of(report(wh))
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_shared_folder_is_the_configured_one(spark, ws):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir", folder)
    assert ws.root.startswith(folder.rstrip("/"))


def test_released_workspace_is_gone(spark, ws):
    ws.table("t", lambda: spark.range(3).toDF("v"))
    ws.release()
    assert not Path(ws.root).exists() and ws.names() == []
