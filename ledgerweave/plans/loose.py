"""The permissive warehouse: unresolved events load with an empty customer key."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.functions import date_key, date_spine, differs, map_value, quarter_columns
from ledgerweave.operators import constraints, one_scan
from ledgerweave.operators import email_identity as em
from ledgerweave.operators.keys import dense_key, ordered_rows, with_position
from ledgerweave.operators.union import union_all
from ledgerweave.operators.workspace import Workspace, in_parallel
from ledgerweave.plans import guards, reports

MONEY = reports.MONEY
SETTLED = "SETTLED"
EVENT_DAYS = {
    "transactions": "txn_date", "digital_activity": "activity_date", "service_cases": "opened_date",
}

# Channel names and reject reasons.
CHANNEL_NAMES = {
    "APP": "Mobile app",
    "WEB": "Internet banking",
    "ATM": "ATM",
    "BRANCH": "Branch",
    "EFTPOS": "EFTPOS terminal",
}
ORPHAN_ACCOUNT = "unknown account_id (orphan)"
ORPHAN_OWNER = "customer_id not present in s1_core.customers"


def identities(xref: DataFrame, system: str, id_column: str) -> DataFrame:
    """Customer keys of one source system, keyed by that system's id."""
    return xref.where(F.col("source_system") == system).select(
        F.col("source_customer_id").alias(id_column), "customer_key"
    )


class LooseWarehouse:
    def __init__(
        self,
        spark: SparkSession,
        sources: Mapping[str, DataFrame],
        workspace: Workspace | None = None,
    ):
        self.spark = spark
        self.src = sources
        self.ws = workspace or Workspace(spark, "loose")

    # ------------------------------------------------------------ dimensions

    @cached_property
    def dim_customer(self) -> DataFrame:
        # Missing facts sort last, as in the key order of the contract.
        order = [F.col(c).asc_nulls_last() for c in em.PERSON]
        return self.ws.table(
            "dim_customer",
            lambda: dense_key(
                self.ws, "persons", em.distinct_persons(self.src["customers"]), order, "customer_key"
            ),
        )

    @cached_property
    def dim_channel(self) -> DataFrame:
        def build() -> DataFrame:
            codes = (
                self.src["transactions"]
                .select(F.col("channel").alias("channel_code"))
                .union(self.src["digital_activity"].select("channel"))
                .distinct()
            )
            name = map_value(F.col("channel_code"), CHANNEL_NAMES).alias("channel_name")
            return dense_key(
                self.ws, "channels", codes.select("channel_code", name), ["channel_code"], "channel_key"
            )

        return self.ws.table("dim_channel", build)

    @cached_property
    def dim_date(self) -> DataFrame:
        """Every day between the first and the last event of any kind."""

        def build() -> DataFrame:
            parts = [
                self.src[name].agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
                for name, day in EVENT_DAYS.items()
            ]
            span = union_all(parts).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
            return date_spine(span).select(*quarter_columns(F.col("full_date")))

        return self.ws.table("dim_date", build)

    # ------------------------------------------------------------ identities

    @cached_property
    def xref_rows(self) -> DataFrame:
        payers = self.src["payers"].select(
            F.lit("S2").alias("source_system"), F.col("payer_id").alias("source_customer_id"), "email"
        )
        users = self.src["digital_users"].select(
            F.lit("S3").alias("source_system"),
            F.col("digital_user_id").alias("source_customer_id"),
            "email",
        )
        found = em.exact_ids(self.src["customers"], self.dim_customer).unionByName(
            em.by_email(self.ws, "identity", self.dim_customer, payers.unionByName(users), ["S2", "S3"])
        )
        return ordered_rows(
            self.ws, "customer_xref_rows", found,
            ["source_system", "source_customer_id"], ["source_system"],
        )

    @cached_property
    def customer_xref(self) -> DataFrame:
        return with_position(self.ws, "customer_xref", self.xref_rows, "xref_key")

    # -------------------------------------------------------------- accounts

    @cached_property
    def orphan_accounts(self) -> DataFrame:
        return self.src["accounts"].join(
            self.src["customers"].select("customer_id"), "customer_id", "left_anti"
        )

    @cached_property
    def dim_account(self) -> DataFrame:
        """Accounts of known customers, linked through the null-safe person match."""
        rows = (
            self.src["accounts"]
            .join(identities(self.xref_rows, "S1", "customer_id"), "customer_id")
            .select(
                "account_id", "customer_key", "account_type", "opened_date", "status",
                F.lit("S1").alias("source_system"),
            )
        )
        return self.ws.table(
            "dim_account", lambda: dense_key(self.ws, "accounts", rows, ["account_id"], "account_key")
        )

    @cached_property
    def account_links(self) -> DataFrame:
        """Every source account id with its warehouse key, if it has one."""
        return self.ws.table(
            "account_links",
            lambda: self.src["accounts"]
            .select("account_id")
            .join(self.dim_account.select("account_id", "account_key"), "account_id", "left")
            .withColumn("_exists", F.lit(True)),
        )

    # ---------------------------------------------------------------- events

    @cached_property
    def settled(self) -> DataFrame:
        """Settled transactions with account link and whether the account is an orphan."""
        tx = self.src["transactions"].where(F.col("status") == SETTLED)
        return self.ws.table(
            "settled",
            lambda: tx.join(self.account_links, "account_id", "left").select(
                *tx.columns,
                "account_key",
                (F.col("account_id").isNotNull() & F.col("_exists").isNull()).alias("orphan"),
            ),
        )

    def _linked(self, events: DataFrame, system: str, id_column: str, day: str) -> DataFrame:
        """Attach the customer (if resolved) and the day, which the calendar holds by its making.
        An event without a date keeps an empty day."""
        dated = events.withColumn("date_key", date_key(F.col(day)))
        return dated.join(identities(self.xref_rows, system, id_column), id_column, "left")

    def _with_channel(self, rows: DataFrame) -> DataFrame:
        channel = self.dim_channel.select("channel_key", F.col("channel_code").alias("channel"))
        return rows.join(channel, "channel", "left")

    @cached_property
    def transaction_rows(self) -> DataFrame:
        kept = self.settled.where(~F.col("orphan"))
        rows = self._with_channel(self._linked(kept, "S2", "payer_id", "txn_date"))
        return self.ws.table(
            "fact_transaction",
            lambda: rows.select(
                "transaction_id", "customer_key", "account_key", "date_key", "channel_key",
                "amount_aud", F.lit(1).alias("transaction_count"), "status",
            ),
        )

    @cached_property
    def activity_rows(self) -> DataFrame:
        rows = self._with_channel(
            self._linked(self.src["digital_activity"], "S3", "digital_user_id", "activity_date")
        )
        return self.ws.table(
            "fact_activity",
            lambda: rows.select(
                "activity_id", "customer_key", "date_key", "channel_key", "activity_type",
                F.lit(1).alias("activity_count"),
            ),
        )

    @cached_property
    def case_rows(self) -> DataFrame:
        rows = self._linked(self.src["service_cases"], "S3", "digital_user_id", "opened_date")
        return self.ws.table(
            "fact_service_case",
            lambda: rows.select(
                "case_id", "customer_key", "date_key", "case_type", "status", "severity",
                F.lit(1).alias("case_count"),
            ),
        )

    @cached_property
    def rejected_record(self) -> DataFrame:
        orphan_tx = self.settled.where("orphan").select(
            F.lit("S2").alias("source_system"), F.lit("transactions").alias("source_table"),
            F.col("transaction_id").alias("source_key"), F.lit(ORPHAN_ACCOUNT).alias("reason"),
        )
        orphan_accounts = self.orphan_accounts.select(
            F.lit("S1").alias("source_system"), F.lit("accounts").alias("source_table"),
            F.col("account_id").alias("source_key"), F.lit(ORPHAN_OWNER).alias("reason"),
        )
        return self.ws.table("rejected_record", lambda: orphan_accounts.unionByName(orphan_tx))

    @cached_property
    def run_log(self) -> DataFrame:
        """Source, loaded and rejected counts per fact."""

        def count(df: DataFrame, step: str, column: str) -> DataFrame:
            return df.agg(F.lit(step).alias("step"), F.count(F.lit(1)).alias(column))

        rejected = self.rejected_record.where(F.col("source_table") == "transactions")
        parts = []
        for step, source, loaded in [
            ("fact_transaction", self.settled, self.transaction_rows),
            ("fact_activity", self.src["digital_activity"], self.activity_rows),
            ("fact_service_case", self.src["service_cases"], self.case_rows),
        ]:
            parts.append(count(source, step, "source_count"))
            parts.append(count(loaded, step, "loaded_count"))
        parts.append(count(rejected, "fact_transaction", "rejected_count"))
        return union_all(parts, missing=True).groupBy("step").agg(
            *[
                F.coalesce(F.max(c), F.lit(0)).alias(c)
                for c in ("source_count", "loaded_count", "rejected_count")
            ]
        )


def fingerprint_tables(wh: LooseWarehouse) -> dict[str, DataFrame]:
    """Every table of the batch, built side by side where they do not depend on each other."""
    return in_parallel(
        {
            "dim_customer": lambda: wh.dim_customer,
            "dim_account": lambda: wh.dim_account,
            "customer_xref": lambda: wh.customer_xref,
            "fact_transaction": lambda: wh.transaction_rows,
            "fact_activity": lambda: wh.activity_rows,
            "fact_service_case": lambda: wh.case_rows,
            "rejected_record": lambda: wh.rejected_record,
        }
    )


# --------------------------------------------------------------------- reports


def customer_360(wh: LooseWarehouse) -> DataFrame:
    """Customer 360 without the last activity and the core id."""
    n = F.count(F.lit(1))
    tx = wh.transaction_rows.where(F.col("customer_key").isNotNull()).groupBy("customer_key").agg(
        n.alias("transactions"), F.sum("amount_aud").cast(MONEY).alias("amount_aud")
    )
    activity = wh.activity_rows.where(F.col("customer_key").isNotNull()).groupBy("customer_key").agg(
        n.alias("digital_activities")
    )
    cases = wh.case_rows.where(F.col("customer_key").isNotNull()).groupBy("customer_key").agg(
        n.alias("service_cases"), F.count_if(F.col("status") == "OPEN").alias("open_cases")
    )
    accounts = wh.dim_account.groupBy("customer_key").agg(n.alias("accounts"))
    joined = wh.dim_customer
    for part in (accounts, tx, activity, cases):
        joined = joined.join(part, "customer_key", "left")

    def zero(c: str, dtype: str = "bigint") -> Column:
        return F.coalesce(F.col(c), F.lit(0)).cast(dtype).alias(c)

    return joined.select(
        "customer_key", "full_name", "match_quality", zero("accounts"), zero("transactions"),
        zero("amount_aud", MONEY), zero("digital_activities"), zero("service_cases"), zero("open_cases"),
    )


# -------------------------------------------------------------- reconciliation


def settled_reconciliation(wh: LooseWarehouse, facts: DataFrame | None = None) -> DataFrame:
    """Settled minus orphans equals loaded, in rows and in money; neither is empty.

    The orphans must also be the rejects on record.
    """
    kept = ~F.col("orphan")

    def money(c: Column | str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast(MONEY)

    both = reports.one_row(
        wh.settled.agg(
            F.count(F.lit(1)).alias("source_settled"),
            F.count_if("orphan").alias("orphans"),
            money(F.when(kept, F.col("amount_aud"))).alias("source_amount"),
        ),
        wh.rejected_record.where(F.col("reason") == ORPHAN_ACCOUNT).agg(
            F.count(F.lit(1)).alias("rejected_orphans")
        ),
        (wh.transaction_rows if facts is None else facts).agg(
            F.count(F.lit(1)).alias("actual_loaded"), money("amount_aud").alias("warehouse_amount")
        ),
    )
    return both.select(
        "source_settled", "orphans", "rejected_orphans", "actual_loaded",
        "source_amount", "warehouse_amount",
        guards.verdict(
            (F.col("source_settled") > 0)
            & (F.col("orphans") == F.col("rejected_orphans"))
            & (F.col("source_settled") - F.col("orphans") == F.col("actual_loaded"))
            & (F.col("source_amount") == F.col("warehouse_amount"))
        ),
    )


def orphan_keys(wh: LooseWarehouse) -> DataFrame:
    """Fact and account keys that point nowhere. Empty customer keys are allowed."""
    dims = {
        "customer_key": wh.dim_customer,
        "account_key": wh.dim_account,
        "date_key": wh.dim_date,
        "channel_key": wh.dim_channel,
    }
    tables = {
        "fact_transaction": (wh.transaction_rows, ["customer_key", "account_key", "date_key", "channel_key"]),
        "fact_activity": (wh.activity_rows, ["customer_key", "date_key", "channel_key"]),
        "fact_service_case": (wh.case_rows, ["customer_key", "date_key"]),
        "dim_account": (wh.dim_account, ["customer_key"]),
    }
    read = {name: df for name, (df, _) in tables.items()} | {f"dim of {key}": df for key, df in dims.items()}
    dense = constraints.dense_keys(read, ((f"dim of {key}", key) for key in dims if key != "date_key"))
    found = one_scan.answers(read, [
        constraints.reference(f"{name}.{key}", name, key, (f"dim of {key}", key), dense)
        for name, (_, keys) in tables.items() for key in keys
    ])
    return found.select(
        F.substring_index("name", ".", 1).alias("table_name"), F.substring_index("name", ".", -1).alias("key_column"),
        F.col("observed").alias("orphans"),
    ).select("*", guards.verdict(F.col("orphans") == 0))


def duplicate_natural_keys(wh: LooseWarehouse) -> DataFrame:
    """Natural keys loaded more than once."""
    tables = {
        "fact_transaction": (wh.transaction_rows, "transaction_id"),
        "fact_activity": (wh.activity_rows, "activity_id"),
        "fact_service_case": (wh.case_rows, "case_id"),
        "dim_account": (wh.dim_account, "account_id"),
    }
    found = one_scan.answers(
        {name: df for name, (df, _) in tables.items()},
        [one_scan.repeated_keys(name, name, [key], open_too=True) for name, (_, key) in tables.items()],
    )
    return found.select(F.col("name").alias("table_name"), F.col("observed").alias("duplicates")).select(
        "*", guards.verdict(F.col("duplicates") == 0)
    )


def merged_names(wh: LooseWarehouse) -> DataFrame:
    """Warehouse customers that unite differently named source rows.

    Names come from the sources; the warehouse's own name would agree with itself.
    """
    named = union_all(
        [
            wh.src["customers"].select(
                F.lit("S1").alias("source_system"), F.col("customer_id").alias("source_customer_id"),
                F.col("full_name").alias("name"),
            ),
            wh.src["payers"].select(
                F.lit("S2").alias("source_system"), F.col("payer_id").alias("source_customer_id"),
                F.col("payer_name").alias("name"),
            ),
            wh.src["digital_users"].select(
                F.lit("S3").alias("source_system"), F.col("digital_user_id").alias("source_customer_id"),
                F.col("full_name").alias("name"),
            ),
        ]
    )
    linked = wh.xref_rows.where(F.col("customer_key").isNotNull()).join(
        named, ["source_system", "source_customer_id"]
    )
    return (
        linked.groupBy("customer_key")
        .agg(F.count_distinct("name").alias("distinct_names"))
        .select("*", guards.verdict(F.col("distinct_names") == 1))
    )


def unresolved_identities(wh: LooseWarehouse) -> DataFrame:
    """Every source identity without a match."""
    return wh.xref_rows.where(F.col("match_status") != "matched").select(
        "source_system", "source_customer_id", "match_rule", "match_status"
    )


def account_links_kept(wh: LooseWarehouse) -> DataFrame:
    """Accounts are linked, account identities agree, keys follow the status, no event is lost.

    Every fact with a source account is compared: an account of a known customer must carry
    its warehouse key, one whose owner was rejected must carry none and is counted apart.
    """
    owner = wh.src["accounts"].select("account_id", "customer_id")
    tx = wh.src["transactions"].select("transaction_id", "account_id")
    facts = wh.transaction_rows.select("transaction_id", "account_key").join(tx, "transaction_id")
    on_account = facts.join(
        wh.account_links.select("account_id", F.col("account_key").alias("own_key")), "account_id"
    )
    owned = F.col("own_key").isNotNull()

    def line(df: DataFrame, name: str, checked: Column, wrong: Column) -> DataFrame:
        return df.agg(
            F.lit(name).alias("check_name"),
            F.count_if(checked).alias("checked"),
            F.count_if(checked & wrong).alias("violations"),
        )

    core = identities(wh.xref_rows, "S1", "customer_id").withColumnRenamed("customer_key", "xref_key")
    identity = (
        wh.dim_account.select("account_id", "customer_key")
        .join(owner, "account_id")
        .join(core, "customer_id", "left")
    )
    matched = F.col("match_status") == "matched"

    def kept(name: str, source: DataFrame, rows: DataFrame, key: str) -> DataFrame:
        there = source.select(key).join(rows.select(key, F.lit(True).alias("_there")), key, "left")
        return line(there, name, F.lit(True), F.col("_there").isNull())

    return union_all(
        [
            line(on_account, "valid account linked", owned, differs(F.col("account_key"), F.col("own_key"))),
            line(on_account, "account of a rejected owner unlinked", ~owned, F.col("account_key").isNotNull()),
            line(identity, "account identity agrees", F.lit(True),
                 differs(F.col("customer_key"), F.col("xref_key"))),
            line(wh.xref_rows, "key follows status", F.lit(True),
                 differs(matched, F.col("customer_key").isNotNull())),
            kept("transaction rows kept", wh.settled.where(~F.col("orphan")), wh.transaction_rows, "transaction_id"),
            kept("activity rows kept", wh.src["digital_activity"], wh.activity_rows, "activity_id"),
            kept("case rows kept", wh.src["service_cases"], wh.case_rows, "case_id"),
        ]
    ).select("*", guards.verdict(F.col("violations") == 0))


def run_log_agrees(wh: LooseWarehouse) -> DataFrame:
    """Logged steps: what is not loaded is rejected, and the counts are those of the facts."""
    facts = {
        "fact_transaction": wh.transaction_rows, "fact_activity": wh.activity_rows,
        "fact_service_case": wh.case_rows,
    }
    loaded = union_all(
        [df.agg(F.lit(name).alias("step"), F.count(F.lit(1)).alias("fact_rows")) for name, df in facts.items()]
    )
    return loaded.join(wh.run_log, "step", "left").select(
        "step", "source_count", "loaded_count", "rejected_count", "fact_rows",
        guards.verdict(
            (F.col("source_count") == F.col("loaded_count") + F.col("rejected_count"))
            & (F.col("loaded_count") == F.col("fact_rows"))
        ),
    )


def negative_amount(wh: LooseWarehouse) -> DataFrame:
    """The settled reconciliation must fire on corrupted facts and pass on the real ones."""

    def line(data: str, facts: DataFrame) -> DataFrame:
        return settled_reconciliation(wh, facts).select(F.lit(data).alias("data"), "*")

    return line("real", wh.transaction_rows).unionByName(
        line("corrupted", guards.corrupted_amounts(wh.transaction_rows))
    )


# Columns named by the small-contract fingerprint.
FINGERPRINT_COLUMNS = {
    "dim_customer": ["customer_key", "full_name", "date_of_birth", "email", "state", "match_quality"],
    "dim_account": [
        "account_key", "account_id", "customer_key", "account_type", "opened_date", "status", "source_system",
    ],
    "customer_xref": [
        "xref_key", "source_system", "source_customer_id", "customer_key", "match_rule", "match_status",
    ],
    "fact_transaction": [
        "transaction_id", "customer_key", "account_key", "date_key", "channel_key", "amount_aud",
        "transaction_count", "status",
    ],
    "fact_activity": [
        "activity_id", "customer_key", "date_key", "channel_key", "activity_type", "activity_count",
    ],
    "fact_service_case": [
        "case_id", "customer_key", "date_key", "case_type", "status", "severity", "case_count",
    ],
    "rejected_record": ["source_system", "source_table", "source_key", "reason"],
}
