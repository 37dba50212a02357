"""Reconciliation checks and guards over a built warehouse.

Each returns comparison rows with a PASS/FAIL ``result``, so a failing number is
visible; ``assert_checks`` turns any FAIL into an error.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions import differs, same
from ledgerweave.operators import constraints
from ledgerweave.operators import disposition as dp
from ledgerweave.operators import identity as idn
from ledgerweave.operators import one_scan
from ledgerweave.operators.fingerprint import fingerprints
from ledgerweave.operators.union import union_all
from ledgerweave.operators.workspace import in_parallel
from ledgerweave.plans import reports
from ledgerweave.plans.warehouse import BatchTables, Warehouse

MONEY = reports.MONEY


class CheckFailed(AssertionError):
    pass


def verdict(ok: Column) -> Column:
    return F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise("FAIL").alias("result")


def _rows() -> Column:
    return F.count(F.lit(1))


def _money(c: Column | str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast(MONEY)


def dimension_counts(wh: Warehouse) -> DataFrame:
    """Dimension sizes against the source rows they must cover."""
    owned = wh.stg["customer_account"].where(F.col("ownership_type") == "PRIMARY")

    def side(df: DataFrame, table: str, column: str) -> DataFrame:
        return df.agg(F.lit(table).alias("table_name"), _rows().alias(column))

    built = union_all([side(wh.dim_customer, "dim_customer", "observed_rows"), side(wh.dim_account, "dim_account", "observed_rows")])
    wanted = union_all([side(wh.stg["customer"], "dim_customer", "expected_rows"), side(owned, "dim_account", "expected_rows")])
    return built.join(wanted, "table_name").select(
        "table_name", "observed_rows", "expected_rows",
        verdict(F.col("observed_rows") == F.col("expected_rows")),
    )


def disposition_balance(wh: Warehouse) -> DataFrame:
    accounted = F.col("loaded_count") + F.col("rejected_count") + F.col("excluded_count")
    return wh.etl_run_log.select(
        "step", "source_count", accounted.alias("accounted_count"),
        verdict(F.col("source_count") == accounted),
    )


def load_totals(
    tx_decision: DataFrame, tx_fact: DataFrame, others: Mapping[str, tuple[DataFrame, DataFrame]]
) -> DataFrame:
    """Rows and amount of each fact against its LOAD decisions."""

    def of(name: str, decision: DataFrame, fact: DataFrame, amounts: tuple[str, str] | None) -> DataFrame:
        def amount(c: str | None) -> Column:
            return F.lit(None).cast(MONEY) if c is None else _money(c)

        load = decision.where(F.col("disposition") == dp.LOAD)
        paid, booked = amounts or (None, None)
        both = reports.one_row(
            load.agg(F.lit(name).alias("fact"), _rows().alias("load_rows"), amount(paid).alias("load_amount")),
            fact.agg(_rows().alias("fact_rows"), amount(booked).alias("fact_amount")),
        )
        return both.select(
            "fact", "load_rows", "fact_rows", "load_amount", "fact_amount",
            verdict(
                (F.col("load_rows") == F.col("fact_rows"))
                & same(F.col("load_amount"), F.col("fact_amount"))
            ),
        )

    return union_all(
        [of("fact_transaction", tx_decision, tx_fact, ("amount", "amount_aud"))]
        + [of(name, d, f, None) for name, (d, f) in others.items()]
    )


def warehouse_load_totals(wh: Warehouse, tx_fact: DataFrame | None = None) -> DataFrame:
    return load_totals(
        wh.tx_decision,
        wh.transaction_rows if tx_fact is None else tx_fact,
        {
            "fact_activity": (wh.activity_decision, wh.activity_rows),
            "fact_service_case": (wh.case_decision, wh.case_rows),
        },
    )


def event_rows_agree(wh: Warehouse) -> DataFrame:
    """Activity and case facts against their decisions, row by row."""

    def of(name: str, decision: DataFrame, fact: DataFrame, key: str, pairs: list[tuple[str, str]]) -> DataFrame:
        left = decision.select(
            key, "disposition", *[F.col(a).alias(f"d{i}") for i, (a, _) in enumerate(pairs)]
        )
        right = fact.select(key, *[F.col(b).alias(f"f{i}") for i, (_, b) in enumerate(pairs)])
        wrong = F.col("disposition") != dp.LOAD
        for i in range(len(pairs)):
            wrong = wrong | differs(F.col(f"d{i}"), F.col(f"f{i}"))
        return left.join(right, key).agg(
            F.lit(name).alias("fact"), _rows().alias("compared_rows"), F.count_if(wrong).alias("mismatches")
        )

    both = union_all(
        [
            of("fact_activity", wh.activity_decision, wh.activity_rows, "activity_id",
               [("customer_key", "customer_key"), ("activity_ts", "event_ts")]),
            of("fact_service_case", wh.case_decision, wh.case_rows, "case_id",
               [("customer_key", "customer_key"), ("status", "status")]),
        ]
    )
    return both.select("*", verdict(F.col("mismatches") == 0))


def amount_total(wh: Warehouse) -> DataFrame:
    """Every dollar of the source is loaded, rejected or excluded."""
    excluded = wh.tx_decision.where(F.col("disposition") == dp.EXCLUDE_STATUS)
    rejected = wh.reject_rows.where(F.col("source_table") == "transaction")
    both = reports.one_row(
        wh.stg["payment_transaction"].agg(_money("amount").alias("source_amount")),
        wh.transaction_rows.agg(_money("amount_aud").alias("loaded_amount")),
        rejected.agg(_money("amount_aud").alias("rejected_amount")),
        excluded.agg(_money("amount").alias("excluded_amount")),
    )
    parts = F.col("loaded_amount") + F.col("rejected_amount") + F.col("excluded_amount")
    return both.select("*", verdict(F.col("source_amount") == parts))


def transaction_rows_agree(wh: Warehouse) -> DataFrame:
    """LOAD decisions and transaction facts compared row by row, both ways."""
    s = (
        wh.tx_decision.where(F.col("disposition") == dp.LOAD)
        .select("transaction_id", "amount", "account_key", "customer_key")
        .alias("s")
    )
    f = wh.transaction_rows.select("transaction_id", "amount_aud", "account_key", "customer_key").alias("f")
    joined = s.join(f, F.col("s.transaction_id") == F.col("f.transaction_id"), "full_outer")
    no_fact, no_decision = F.col("f.transaction_id").isNull(), F.col("s.transaction_id").isNull()
    wrong = (
        differs(F.col("s.amount"), F.col("f.amount_aud"))
        | differs(F.col("s.account_key"), F.col("f.account_key"))
        | differs(F.col("s.customer_key"), F.col("f.customer_key"))
    )
    return joined.agg(
        _rows().alias("compared_rows"),
        F.count_if(no_fact).alias("missing_in_fact"),
        F.count_if(no_decision).alias("missing_in_decision"),
        F.count_if(~no_fact & ~no_decision & wrong).alias("mismatches"),
    ).select(
        "*",
        verdict(F.col("missing_in_fact") + F.col("missing_in_decision") + F.col("mismatches") == 0),
    )


# Dimensions that each fact must have.
FACT_DIMENSIONS = {
    "fact_transaction": ["dim_account", "dim_customer", "dim_date", "dim_channel"],
    "fact_activity": ["dim_customer", "dim_date", "dim_channel"],
    "fact_service_case": ["dim_customer", "dim_date"],
}
DIMENSION_KEYS = {
    "dim_customer": "customer_key", "dim_account": "account_key", "dim_date": "date_key", "dim_channel": "channel_key",
}
FACT_ROWS = {"fact_transaction": "transaction_rows", "fact_activity": "activity_rows", "fact_service_case": "case_rows"}


def missing_dimensions(wh: Warehouse) -> DataFrame:
    """Fact rows without a partner, per fact and dimension. NULL keys count as missing.

    Each fact is read once. A surrogate key is compared with the range of its dimension, so only
    days are counted and meet the calendar; a dimension whose keys are not 1..n is met by its keys.
    """
    tables = {fact: getattr(wh, rows) for fact, rows in FACT_ROWS.items()}
    tables |= {name: getattr(wh, name) for name in DIMENSION_KEYS}
    dense = constraints.dense_keys(tables, ((d, k) for d, k in DIMENSION_KEYS.items() if d != "dim_date"))
    lines = one_scan.answers(tables, [
        constraints.reference(f"{fact}.{d}", fact, DIMENSION_KEYS[d], (d, DIMENSION_KEYS[d]), dense, True)
        for fact, used in FACT_DIMENSIONS.items() for d in used
    ])
    return lines.select(
        F.substring_index("name", ".", 1).alias("fact"), F.substring_index("name", ".", -1).alias("dimension"),
        F.col("observed").alias("missing"),
    ).select("*", verdict(F.col("missing") == 0))


def account_identity(wh: Warehouse) -> DataFrame:
    """An account's customer agrees with its owner and with the xref."""
    owner = wh.stg["customer_account"].where(F.col("ownership_type") == "PRIMARY")
    core = wh.xref_rows.where(F.col("source_system") == "S1").select(
        F.col("source_customer_id").alias("customer_id"), F.col("customer_key").alias("xref_key")
    )
    anchors = wh.dim_customer.select("customer_key", "core_customer_id")
    joined = (
        wh.dim_account.select("account_id", "customer_key")
        .join(owner.select("account_id", "customer_id"), "account_id")
        .join(core, "customer_id", "left")
        .join(anchors, "customer_key", "left")
    )
    return joined.agg(
        _rows().alias("accounts"),
        F.count_if(F.col("core_customer_id") != F.col("customer_id")).alias("owner_mismatches"),
        F.count_if(differs(F.col("customer_key"), F.col("xref_key"))).alias("xref_mismatches"),
    ).select("*", verdict(F.col("owner_mismatches") + F.col("xref_mismatches") == 0))


# Words that must not occur in the columns of these tables.
FORBIDDEN_COLUMNS = {
    "service_case": "channel",
    "v_r3_channel_engagement": "case",
    "v_r4_service_case_summary": "channel",
}


def columns_with(df: DataFrame, word: str) -> list[str]:
    return [c for c in df.columns if word.lower() in c.lower()]


def channel_attribution(wh: Warehouse) -> DataFrame:
    """Cases carry no channel, the channel report no case measure."""
    frames = {
        "service_case": wh.stg["service_case"],
        "v_r3_channel_engagement": reports.channel_engagement(wh),
        "v_r4_service_case_summary": reports.case_summary(wh),
    }
    return union_all(
        [
            df.agg(
                F.lit(name).alias("object_name"),
                _rows().alias("rows"),
                F.lit(len(columns_with(df, FORBIDDEN_COLUMNS[name]))).cast("bigint").alias("offending_columns"),
            ).select("*", verdict(F.col("offending_columns") == 0))
            for name, df in frames.items()
        ]
    )


# Labels of the two ways in the published fan-out demonstration, and the column names
# of the published report of unresolved identities (``unresolved_visible``).
RIGHT_WAY, WRONG_WAY = "RIGHT_separate_aggregation", "WRONG_direct_fact_join"


def fanout_totals(wh: Warehouse) -> DataFrame:
    """Right and wrong way to total three facts.

    The wrong way joins the facts per customer first. Its totals follow from the
    per-customer counts, so the multiplied rows are counted without being built.
    """
    per = "customer_key"
    tx = wh.transaction_rows.where(F.col(per).isNotNull()).groupBy(per).agg(
        F.sum("amount_aud").cast(MONEY).alias("amount"), _rows().alias("t")
    )
    act = wh.activity_rows.groupBy(per).agg(_rows().alias("a"))
    case = wh.case_rows.groupBy(per).agg(_rows().alias("c"))
    copies = F.col("a") * F.col("c")
    wrong = tx.join(act, per).join(case, per).agg(
        F.lit(WRONG_WAY).alias("approach"),
        F.coalesce(F.sum(F.col("amount") * copies.cast("decimal(18,0)")), F.lit(0))
        .cast("decimal(38,2)")
        .alias("total_amount_aud"),
        F.coalesce(F.sum(F.col("t") * copies), F.lit(0)).cast("bigint").alias("rows"),
    )
    right = wh.transaction_rows.agg(
        F.lit(RIGHT_WAY).alias("approach"),
        _money("amount_aud").cast("decimal(38,2)").alias("total_amount_aud"),
        _rows().alias("rows"),
    )
    return right.unionByName(wrong)


# The controlled case, two payments and three activities of one customer.
CONTROL_KEY = -99
CONTROL_AMOUNTS, CONTROL_ACTIVITIES = ("100.00", "50.00"), 3
CONTROL_RIGHT, CONTROL_WRONG = 150, 450


def fanout_guard(wh: Warehouse) -> DataFrame:
    """The multiplied total is known where the case is controlled, and no report has it.

    The controlled customer is added to the warehouse's own facts, so both lines run through
    the same aggregation.
    """
    spark, per = wh.spark, "customer_key"
    paid = spark.createDataFrame([(CONTROL_KEY, a) for a in CONTROL_AMOUNTS], f"{per} bigint, amount string")
    acts = spark.createDataFrame([(CONTROL_KEY,)] * CONTROL_ACTIVITIES, f"{per} bigint")
    tx = wh.transaction_rows.select(per, F.col("amount_aud").alias("amount")).unionByName(
        paid.select(per, F.col("amount").cast("decimal(12,2)"))
    )
    totals = tx.where(F.col(per).isNotNull()).groupBy(per).agg(F.sum("amount").cast(MONEY).alias("amount"))
    copies = wh.activity_rows.select(per).unionByName(acts).groupBy(per).agg(_rows().alias("a"))
    control = F.col(per) == CONTROL_KEY
    case = F.when(control, F.lit("controlled")).otherwise(F.lit("warehouse")).alias("case_name")
    wide = "decimal(38,2)"
    both = totals.join(copies, per, "left").groupBy(case).agg(
        F.sum("amount").cast(wide).alias("right_total"),
        F.coalesce(F.sum(F.col("amount") * F.col("a").cast("decimal(18,0)")), F.lit(0)).cast(wide).alias("wrong_total"),
    )
    reported = reports.customer_360(wh).agg(F.sum("amount_aud").cast(wide)).scalar()
    known = F.col("case_name") == "controlled"
    return both.withColumn("reported_total", F.when(~known, reported)).select(
        "*",
        verdict(
            F.when(known, (F.col("right_total") == CONTROL_RIGHT) & (F.col("wrong_total") == CONTROL_WRONG))
            .otherwise(F.col("right_total") == F.col("reported_total"))
        ),
    )


def report_totals(wh: Warehouse) -> DataFrame:
    """Report totals equal the facts they summarise."""
    r1 = reports.customer_360(wh).agg(
        _money("amount_aud").alias("R1 amount"),
        _money("digital_activities").alias("R1 activities"),
        _money("service_cases").alias("R1 cases"),
    )
    r2 = reports.transactions_by_date_channel(wh).agg(_money("amount_aud").alias("R2 amount"))
    r3 = reports.channel_engagement(wh).agg(_money("activity_count").alias("R3 activities"))
    r4 = reports.case_summary(wh).agg(_money("case_count").alias("R4 cases"))
    names = ["R1 amount", "R1 activities", "R1 cases", "R2 amount", "R3 activities", "R4 cases"]
    reported = reports.one_row(r1, r2, r3, r4).unpivot([], names, "measure", "report_total")
    facts = reports.one_row(
        wh.transaction_rows.agg(_money("amount_aud").alias("amount")),
        wh.activity_rows.agg(_rows().cast(MONEY).alias("activities")),
        wh.case_rows.agg(_rows().cast(MONEY).alias("cases")),
    ).unpivot([], ["amount", "activities", "cases"], "kind", "fact_total")
    return (
        reported.withColumn("kind", F.substring("measure", 4, 20))
        .join(facts, "kind")
        .select(
            "measure", "report_total", "fact_total",
            verdict(F.col("report_total") == F.col("fact_total")),
        )
    )


def unresolved_visible(wh: Warehouse) -> DataFrame:
    """Unresolved identities are counted, not dropped."""
    open_key = F.count_if(F.col("customer_key").isNull())
    return reports.one_row(
        wh.transaction_rows.agg(
            _rows().alias("transactions_loaded"), open_key.alias("transactions_without_customer")
        ),
        wh.activity_rows.agg(open_key.alias("activities_without_customer")),
        wh.case_rows.agg(open_key.alias("cases_without_customer")),
        wh.xref_rows.agg(
            _rows().alias("xref_rows"),
            F.count_if(F.col("match_status") != idn.MATCHED).alias("xref_not_matched"),
        ),
        wh.people.agg(_rows().alias("source_people")),
        wh.dim_customer.agg(_rows().alias("core_people")),
    ).select(
        "transactions_loaded", "transactions_without_customer", "activities_without_customer",
        "cases_without_customer", "xref_rows", "xref_not_matched",
        verdict(F.col("xref_rows") == F.col("source_people") + F.col("core_people")),
    )


def attribution_balance(attribution: DataFrame) -> DataFrame:
    """Attributed plus unattributed equals the total, in rows and in money."""
    rows_ok = F.col("total_rows") == F.col("attributed_rows") + F.col("unattributed_rows")
    reconciled = F.col("attributed_amount_aud") + F.col("unattributed_amount_aud")
    money_ok = F.col("total_amount_aud").isNull() | (F.col("total_amount_aud") == reconciled)
    return attribution.select(
        "fact", "total_rows", "total_amount_aud",
        reconciled.cast(MONEY).alias("reconciled_amount_aud"), verdict(rows_ok & money_ok),
    )


RULES = [idn.R1, idn.R2, idn.R3, idn.NONE]


def rule_coverage(xref: DataFrame) -> DataFrame:
    """Source rows per rule; rules that matched nothing are listed with zero."""
    status = F.col("match_status")
    counted = xref.groupBy("match_rule").agg(
        _rows().alias("source_rows"),
        F.count_if(status == idn.MATCHED).alias("resolved"),
        F.count_if(status == idn.AMBIGUOUS).alias("ambiguous"),
        F.count_if(status == idn.UNMATCHED).alias("unmatched"),
    )
    rules = xref.sparkSession.createDataFrame([(r,) for r in RULES], "rule string")
    numbers = ["source_rows", "resolved", "ambiguous", "unmatched"]
    return rules.join(counted, F.col("rule") == F.col("match_rule"), "left").select(
        "rule", *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers]
    )


def identity_status(xref: DataFrame) -> DataFrame:
    """A key is present exactly when the status is matched."""
    conflict = differs(F.col("match_status") == idn.MATCHED, F.col("customer_key").isNotNull())
    return xref.groupBy("source_system").agg(
        _rows().alias("rows"), F.count_if(conflict).alias("conflicts")
    ).select("*", verdict(F.col("conflicts") == 0))


def rejects_agree(wh: Warehouse) -> DataFrame:
    """Recorded rejects against the reject decisions, row by row, both ways."""
    key = ["source_table", "source_key"]
    wanted = dp.rejects(*wh.decisions).select(
        *key, F.struct("reason", "amount_aud").alias("want"), F.lit(True).alias("_decided")
    )
    found = wh.reject_rows.select(
        *key, F.struct("reason", "amount_aud").alias("got"), F.lit(True).alias("_recorded")
    )
    lost, extra = F.col("_recorded").isNull(), F.col("_decided").isNull()
    wrong = lost | extra | ~F.col("want").eqNullSafe(F.col("got"))
    return wanted.join(found, key, "full_outer").groupBy("source_table").agg(
        _rows().alias("compared_rows"), F.count_if(wrong).alias("mismatches")
    ).select("*", verdict(F.col("mismatches") == 0))


def equal_sums(built: DataFrame, written: DataFrame) -> DataFrame:
    """Whether two sets of fingerprints agree, table by table."""
    a, b = built.alias("a"), written.alias("b")
    equal = F.lit(True)
    for c in ("rows", "hash_a", "hash_b"):
        equal = equal & same(F.col(f"a.{c}"), F.col(f"b.{c}"))
    return a.join(b, F.col("a.table_name") == F.col("b.table_name"), "left").select(
        "a.table_name", F.col("a.rows").alias("built_rows"), F.col("b.rows").alias("written_rows"),
        verdict(equal),
    )


def same_content(built: Mapping[str, DataFrame], written: Mapping[str, DataFrame]) -> DataFrame:
    """Whether each published table holds exactly the rows that were built."""
    return equal_sums(fingerprints(dict(built)), fingerprints({name: written[name] for name in built}))


def expected_rejects(rejects: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected rejects against actual ones: found, missing and additional, per reason."""
    key = ["source_table", "source_key", "reason"]
    a = expected.select(*key, F.lit(True).alias("_wanted"))
    b = rejects.select(*key, F.lit(True).alias("_found"))
    wanted, found = F.col("_wanted").isNotNull(), F.col("_found").isNotNull()
    return a.join(b, key, "full_outer").groupBy("source_table", "reason").agg(
        F.count_if(wanted & found).alias("found"),
        F.count_if(wanted & ~found).alias("missing"),
        F.count_if(found & ~wanted).alias("additional"),
    ).select("*", verdict(F.col("missing") + F.col("additional") == 0))


def expected_identity(xref: DataFrame, anchors: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected against resolved identity, per system and expected status.

    ``expected`` has source_system, source_id, core_id, status. Identities that nobody
    expected are a line of their own per system, with the status ``unexpected``.
    """
    ids = anchors.select("customer_key", "core_customer_id")
    x = xref.select(
        "source_system", F.col("source_customer_id").alias("source_id"), "customer_key", "match_status"
    )
    known = x.where(F.col("customer_key").isNotNull()).join(ids, "customer_key", "left")
    unknown = x.where(F.col("customer_key").isNull())
    resolved = known.unionByName(unknown, allowMissingColumns=True)
    named = expected.withColumn("_named", F.lit(True))
    joined = named.join(resolved, ["source_system", "source_id"], "full_outer").withColumn(
        "status", F.when(F.col("_named"), F.col("status")).otherwise("unexpected")
    )
    wanted = F.col("status") == idn.MATCHED
    wrong = (
        F.col("match_status").isNull()
        | (F.col("match_status") != F.col("status"))
        | (wanted & differs(F.col("core_customer_id"), F.col("core_id")))
        | (~wanted & F.col("customer_key").isNotNull())
    )
    return joined.groupBy("source_system", "status").agg(
        _rows().alias("expected_ids"), F.count_if(wrong).alias("disagreements")
    ).select("*", verdict(F.col("disagreements") == 0))


def expected_by_source(expected: DataFrame) -> DataFrame:
    """One expected person per row turned into one row per source id."""
    systems = {"core_customer_id": "S1", "payment_customer_id": "S2", "digital_customer_id": "S3"}
    status = (
        F.when(F.col("expected_outcome").isin("MATCH", "CORE_ONLY"), idn.MATCHED)
        .when(F.col("expected_outcome") == "AMBIGUOUS", idn.AMBIGUOUS)
        .when(F.col("expected_outcome") == "UNMATCHED", idn.UNMATCHED)
    )
    base = expected.select(F.col("core_customer_id").alias("core_id"), status.alias("status"), *systems)
    long = base.unpivot(["core_id", "status"], list(systems), "column", "source_id")
    system = F.element_at(F.create_map(*[F.lit(v) for kv in systems.items() for v in kv]), F.col("column"))
    return long.where(F.col("source_id").isNotNull()).select(
        system.alias("source_system"), "source_id", "core_id", "status"
    )


def corrupted_amounts(tx_fact: DataFrame) -> DataFrame:
    """The facts with one amount raised by one, as a derived frame."""
    first = tx_fact.agg(F.min("transaction_id")).scalar()
    changed = F.when(F.col("transaction_id") == first, F.col("amount_aud") + 1).otherwise(F.col("amount_aud"))
    return tx_fact.withColumn("amount_aud", changed.cast("decimal(13,2)"))


def negative_amount(wh: Warehouse) -> DataFrame:
    """The load-total check must fire on corrupted facts and pass on the real ones."""
    real = warehouse_load_totals(wh).select(F.lit("real").alias("data"), "*")
    bad = warehouse_load_totals(wh, corrupted_amounts(wh.transaction_rows)).select(
        F.lit("corrupted").alias("data"), "*"
    )
    return real.unionByName(bad)


def table_constraints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Declared constraints of the warehouse tables."""
    found = constraints.violations(tables, constraints.WAREHOUSE_RULES)
    return found.select("*", verdict(F.col("violations") == 0))


def warehouse_constraints(wh: Warehouse) -> DataFrame:
    return table_constraints({name: getattr(wh, name) for name in constraints.WAREHOUSE_RULES})


def lossless_casts(wh: Warehouse) -> DataFrame:
    """Values of decided events that the declared type of their column cannot hold."""
    frames = {"tx_decision": wh.tx_decision.select("disposition", "amount")}
    found = constraints.lossless(frames, constraints.WAREHOUSE_CASTS)
    return found.select("*", verdict(F.col("violations") == 0))


CHECKS = {
    "dimension counts": dimension_counts,
    "disposition balance": disposition_balance,
    "load totals": warehouse_load_totals,
    "event rows agree": event_rows_agree,
    "amount total": amount_total,
    "transaction rows agree": transaction_rows_agree,
    "missing dimensions": missing_dimensions,
    "T9 account identity": account_identity,
    "T10 case channel": channel_attribution,
    "T11 report totals": report_totals,
    "T12 unresolved visibility": unresolved_visible,
    "T13 attribution totals": lambda wh: attribution_balance(reports.attribution_report(wh)),
    "identity status": lambda wh: identity_status(wh.xref_rows),
    "rejects agree": rejects_agree,
    "controlled fan-out": fanout_guard,
    "constraints": lambda wh: warehouse_constraints(wh),
    "lossless casts": lossless_casts,
}


def failed_lines(
    checks: Mapping[str, Callable[[Warehouse], DataFrame]], seen: Warehouse | BatchTables
) -> dict[str, int]:
    """Failed lines per check, checks running side by side; each brings back one number."""

    def count(name: str) -> int:
        return checks[name](seen).where(F.col("result") != "PASS").count()

    return in_parallel({name: lambda name=name: count(name) for name in checks})


def failures(wh: Warehouse, tables: Mapping[str, DataFrame] | None = None) -> dict[str, int]:
    """Failed lines per check.

    With ``tables``, for instance a published batch, every check reads those instead of the
    warehouse's own; sources and decisions stay the ones they are held against.
    """
    if tables is None:
        return failed_lines(CHECKS, wh)
    same = {"published equals built": lambda _: same_content(wh.build(), tables)}
    return failed_lines(CHECKS | same, BatchTables(wh.spark, tables, wh))


def raise_failed(counts: Mapping[str, int]) -> None:
    """Raise if any check has a failed line."""
    failed = sorted(name for name, n in counts.items() if n > 0)
    if failed:
        raise CheckFailed("checks failed: " + ", ".join(failed))


def assert_checks(wh: Warehouse, tables: Mapping[str, DataFrame] | None = None) -> None:
    raise_failed(failures(wh, tables))
