"""Ad-hoc inspection queries over sources and warehouse."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.operators.keys import repeated_groups
from ledgerweave.operators.union import union_all
from ledgerweave.plans import reports
from ledgerweave.plans.warehouse import BatchTables, Warehouse

MONEY = reports.MONEY


def row_counts(tables: Mapping[str, DataFrame], name: str = "source") -> DataFrame:
    return union_all(
        [df.agg(F.lit(t).alias(name), F.count(F.lit(1)).alias("rows")) for t, df in tables.items()]
    )


def event_window(wh: Warehouse) -> DataFrame:
    """Event span and batch count of the transactions beside the calendar span."""
    tx = wh.stg["payment_transaction"].agg(
        F.min("transaction_ts").alias("first_ts"),
        F.max("transaction_ts").alias("last_ts"),
        F.count_distinct("batch_id").alias("batches"),
    )
    calendar = wh.dim_date.agg(
        F.min("full_date").alias("first_day"),
        F.max("full_date").alias("last_day"),
        F.count(F.lit(1)).alias("days"),
    )
    return reports.one_row(tx, calendar)


def identity_counts(xref: DataFrame) -> DataFrame:
    return xref.groupBy("source_system", "match_rule", "match_status").agg(
        F.count(F.lit(1)).alias("rows")
    )


def identity_anchors(wh: Warehouse) -> DataFrame:
    """Every source identity beside the core customer it resolved to."""
    anchors = wh.dim_customer.select("customer_key", "core_customer_id")
    resolved = wh.xref_rows.where(F.col("customer_key").isNotNull()).join(anchors, "customer_key")
    # Unresolved rows have nothing to look up; keeping them out of the join keeps NULLs out of it.
    open_rows = wh.xref_rows.where(F.col("customer_key").isNull()).withColumn(
        "core_customer_id", F.lit(None).cast("string")
    )
    columns = [
        "source_system", "source_customer_id", "customer_key", "core_customer_id",
        "match_rule", "match_status",
    ]
    return resolved.select(*columns).unionByName(open_rows.select(*columns))


def disposition_counts(tx_decision: DataFrame) -> DataFrame:
    return tx_decision.groupBy("disposition").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("amount").cast(MONEY).alias("amount_aud")
    )


def duplicate_reference_trace(wh: Warehouse) -> DataFrame:
    """Every transaction whose business reference occurs more than once."""
    repeated = repeated_groups(
        wh.ws, "trace", wh.tx_decision.select("source_transaction_ref"), ["source_transaction_ref"]
    )
    return wh.tx_decision.join(repeated, "source_transaction_ref", "left_semi").select(
        "transaction_id", "source_transaction_ref", "rn", "disposition"
    )


def customer_trace(wh: Warehouse, core_customer_id: str | None = None) -> DataFrame:
    """Lineage of customers from source rows through the xref to facts and report.

    Without an id, every customer is traced.
    """
    customers = wh.dim_customer.select("customer_key", "core_customer_id")
    if core_customer_id is not None:
        customers = customers.where(F.col("core_customer_id") == core_customer_id)
    xref = wh.xref_rows.join(customers, "customer_key")

    def step(name: str, df: DataFrame, key: str, detail: Column) -> DataFrame:
        return df.select(
            "core_customer_id",
            F.lit(name).alias("step"),
            F.col(key).alias("record_id"),
            detail.cast("string").alias("detail"),
        )

    def source(name: str, system: str, table: str, id_column: str) -> DataFrame:
        ids = xref.where(F.col("source_system") == system).select(
            "core_customer_id", F.col("source_customer_id").alias(id_column)
        )
        rows = wh.stg[table].select(id_column, "email")
        return step(name, rows.join(ids, id_column), id_column, F.col("email"))

    facts = wh.transaction_rows.join(customers, "customer_key")
    report = reports.customer_360(wh)
    if core_customer_id is not None:
        report = report.where(F.col("core_customer_id") == core_customer_id)
    return union_all(
        [
            source("1 core", "S1", "customer", "customer_id"),
            source("2 payments", "S2", "payment_customer", "payment_customer_id"),
            source("3 digital", "S3", "digital_customer", "digital_customer_id"),
            step("4 xref", xref, "source_customer_id", F.col("match_rule")),
            step("5 fact", facts, "transaction_id", F.col("amount_aud")),
            step("6 report", report, "core_customer_id", F.col("amount_aud")),
        ]
    )


def overview(wh: Warehouse) -> DataFrame:
    """Headline sizes as text rows."""
    counts = row_counts(
        {
            "customers": wh.dim_customer,
            "accounts": wh.dim_account,
            "transactions": wh.transaction_rows,
            "activities": wh.activity_rows,
            "cases": wh.case_rows,
        },
        "metric",
    ).select("metric", F.col("rows").cast("string").alias("value"))
    amount = wh.transaction_rows.agg(
        F.lit("accepted_amount_aud").alias("metric"),
        F.sum("amount_aud").cast(MONEY).cast("string").alias("value"),
    )
    return counts.unionByName(amount)


def scan_roots(df: DataFrame) -> set[str]:
    """Root folders of all file scans in the plan of ``df``."""
    roots = set()
    scans = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
    while scans.hasNext():
        leaf = scans.next()
        if "LogicalRelation" in leaf.getClass().getName():
            relation = leaf.relation()
            if "HadoopFsRelation" in relation.getClass().getName():
                found = relation.location().rootPaths().iterator()
                while found.hasNext():
                    roots.add(str(found.next().toString()))
    return roots


def report_lineage(wh: Warehouse | BatchTables) -> DataFrame:
    """Which written warehouse tables each report reads, with their sizes.

    The folders come from the scans of each report's plan, one per table however many files
    it has; a report that bypasses the warehouse shows up as a path outside its root. A
    published batch is traced in its own folder, in any session.
    """
    root = wh.root if isinstance(wh, BatchTables) else wh.ws.root
    marker = "/".join(root.rstrip("/").split("/")[-2:])
    pairs = set()
    for name, report in reports.REPORTS.items():
        for path in scan_roots(report(wh)):
            inside = f"/{marker}/" in path
            table = path.split(f"/{marker}/")[1].split("/")[0] if inside else "outside:" + path
            pairs.add((name, table))
    stored = wh.stored() if isinstance(wh, BatchTables) else wh.ws.stored()
    names = sorted({t for _, t in pairs if not t.startswith("outside:")})
    sizes = row_counts({t: stored[t] for t in names}, "table_name")
    edges = wh.spark.createDataFrame(sorted(pairs), "report string, table_name string")
    return edges.join(sizes, "table_name", "left").select("report", "table_name", "rows")


def latest(log: DataFrame, by: str, n: int) -> DataFrame:
    return log.orderBy(F.desc(by)).limit(n)
