"""Report views over the warehouse.

Every fact is aggregated on its own before it meets a dimension, so no join can
multiply an amount or a count. No report gives service cases a channel.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.operators.union import union_all
from ledgerweave.plans.warehouse import Warehouse

MONEY = "decimal(18,2)"
FACT_ROWS = ("transaction_rows", "activity_rows", "case_rows")


def _rows() -> Column:
    return F.count(F.lit(1))


def _money(c: Column | str) -> Column:
    return F.sum(c).cast(MONEY)


def _zero(c: str, dtype: str = "bigint") -> Column:
    return F.coalesce(F.col(c), F.lit(0)).cast(dtype).alias(c)


def customer_360(wh: Warehouse) -> DataFrame:
    """One row per customer: accounts, transactions, activities and cases."""
    wh.ready("dim_account", *FACT_ROWS)
    accounts = wh.dim_account.groupBy("customer_key").agg(_rows().alias("accounts"))
    tx = wh.transaction_rows.groupBy("customer_key").agg(
        _rows().alias("transactions"), _money("amount_aud").alias("amount_aud")
    )
    activity = wh.activity_rows.groupBy("customer_key").agg(
        _rows().alias("digital_activities"), F.max("event_ts").alias("last_activity")
    )
    cases = wh.case_rows.groupBy("customer_key").agg(
        _rows().alias("service_cases"), F.count_if(F.col("status") == "OPEN").alias("open_cases")
    )
    base = wh.dim_customer.select("customer_key", "full_name", "core_customer_id", "match_quality")
    joined = reduce(
        lambda left, right: left.join(right, "customer_key", "left"),
        [accounts, tx, activity, cases],
        base,
    )
    return joined.select(
        "customer_key",
        "full_name",
        "core_customer_id",
        "last_activity",
        "match_quality",
        _zero("accounts"),
        _zero("transactions"),
        _zero("amount_aud", MONEY),
        _zero("digital_activities"),
        _zero("service_cases"),
        _zero("open_cases"),
    )


def transactions_by_date_channel(wh: Warehouse) -> DataFrame:
    totals = wh.transaction_rows.groupBy("date_key", "channel_key").agg(
        _rows().alias("txn_count"), _money("amount_aud").alias("amount_aud")
    )
    return (
        totals.join(wh.dim_date, "date_key")
        .join(wh.dim_channel, "channel_key")
        .select("full_date", "day_of_week", "channel_code", "channel_name", "txn_count", "amount_aud")
    )


def transactions_by_channel(wh: Warehouse) -> DataFrame:
    totals = wh.transaction_rows.groupBy("channel_key").agg(
        _rows().alias("txn_count"), _money("amount_aud").alias("amount_aud")
    )
    return totals.join(wh.dim_channel, "channel_key").select(
        "channel_code", "channel_name", "txn_count", "amount_aud"
    )


def channel_engagement(wh: Warehouse) -> DataFrame:
    """Active customers and activities per channel, channels without activity included."""
    per_customer = wh.activity_rows.groupBy("channel_key", "customer_key").agg(
        _rows().alias("activities")
    )
    per_channel = per_customer.groupBy("channel_key").agg(
        F.count("customer_key").alias("active_customers"),
        F.sum("activities").alias("activity_count"),
    )
    return wh.dim_channel.join(per_channel, "channel_key", "left").select(
        "channel_code", "channel_name", _zero("active_customers"), _zero("activity_count")
    )


def activity_mix(activity_rows: DataFrame) -> DataFrame:
    return activity_rows.groupBy("activity_type").agg(
        _rows().alias("events"), F.count_distinct("customer_key").alias("customers")
    )


def case_summary(wh: Warehouse) -> DataFrame:
    return wh.case_rows.groupBy("status").agg(
        _rows().alias("case_count"),
        F.count_distinct("customer_key").alias("customers"),
        F.count_if(F.col("severity") == "HIGH").alias("high_severity"),
    )


def one_row(*frames: DataFrame) -> DataFrame:
    """Put one-row frames with different columns side by side, without a cross join."""
    stacked = union_all(frames, missing=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def data_quality_kpi(wh: Warehouse) -> DataFrame:
    """Twelve metrics, one aggregate per table."""
    wh.ready("dim_account", "reject_rows", *FACT_ROWS)
    status = F.col("match_status")
    xref = wh.xref_rows.agg(
        _rows().alias("xref_rows"),
        *[F.count_if(status == s).alias(f"xref_{s}") for s in ("matched", "ambiguous", "unmatched")],
    )
    tx = wh.transaction_rows.agg(
        _rows().alias("transaction_rows"),
        F.count_if(F.col("customer_key").isNull()).alias("transactions_unresolved"),
        F.coalesce(_money("amount_aud"), F.lit(0)).cast(MONEY).alias("transaction_amount_aud"),
    )
    return one_row(
        wh.dim_customer.agg(_rows().alias("dim_customer_rows")),
        wh.dim_account.agg(_rows().alias("dim_account_rows")),
        xref,
        tx,
        wh.activity_rows.agg(_rows().alias("activity_rows")),
        wh.case_rows.agg(_rows().alias("service_case_rows")),
        wh.reject_rows.agg(_rows().alias("rejected_rows")),
    )


def attribution(tx: DataFrame, activity: DataFrame, case: DataFrame) -> DataFrame:
    """Per fact: total = attributed + unattributed, in rows and in money."""
    known = F.col("customer_key").isNotNull()

    def of(name: str, df: DataFrame, amount: str | None) -> DataFrame:
        def part(condition: Column | None) -> Column:
            if amount is None:
                return F.lit(None).cast(MONEY)
            value = F.col(amount) if condition is None else F.when(condition, F.col(amount))
            return F.coalesce(F.sum(value), F.lit(0)).cast(MONEY)

        return df.agg(
            F.lit(name).alias("fact"),
            _rows().alias("total_rows"),
            F.count_if(known).alias("attributed_rows"),
            F.count_if(~known).alias("unattributed_rows"),
            part(None).alias("total_amount_aud"),
            part(known).alias("attributed_amount_aud"),
            part(~known).alias("unattributed_amount_aud"),
        )

    return (
        of("fact_transaction", tx, "amount_aud")
        .unionByName(of("fact_activity", activity, None))
        .unionByName(of("fact_service_case", case, None))
    )


def attribution_report(wh: Warehouse) -> DataFrame:
    wh.ready(*FACT_ROWS)
    return attribution(wh.transaction_rows, wh.activity_rows, wh.case_rows)


# Tile labels and the metric behind each.
TILES = {
    "Customers": "dim_customer_rows",
    "Accepted transactions": "transaction_rows",
    "Accepted AUD volume": "transaction_amount_aud",
    "Rejected events": "rejected_rows",
}


def kpi_tiles(kpi: DataFrame) -> DataFrame:
    """Headline metrics as label and value rows."""
    values = kpi.select(*[F.col(m).cast(MONEY).alias(label) for label, m in TILES.items()])
    return values.unpivot([], list(TILES), "label", "value")


def bar_share(report: DataFrame, label: str, value: str) -> DataFrame:
    """Each value as a percentage of the largest one (at least 1)."""
    top = report.agg(F.greatest(F.lit(1.0), F.max(F.col(value).cast("double")))).scalar()
    amount = F.col(value).cast("double")
    return report.select(F.col(label).alias("label"), amount.alias("value"), (amount / top * 100).alias("share"))


def report_search(report: DataFrame, text: str) -> DataFrame:
    """Rows in which any column holds the text, ignoring case."""
    line = F.lower(F.concat_ws(" ", *[F.col(c).cast("string") for c in report.columns]))
    return report.where(line.contains(text.lower()))


REPORTS = {
    "v_r1_customer_360": customer_360,
    "v_r2_transaction_by_date_channel": transactions_by_date_channel,
    "v_r2b_transaction_by_channel": transactions_by_channel,
    "v_r3_channel_engagement": channel_engagement,
    "v_r4_service_case_summary": case_summary,
    "v_r5_data_quality_kpi": data_quality_kpi,
    "v_r6_attribution_reconciliation": attribution_report,
}
