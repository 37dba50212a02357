"""Every operator and query by name, over a folder of star-schema test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.functions import (
    date_key, differs, full_name, map_value, norm_phone, norm_text, same,
)
from ledgerweave.operators import audit, edits, scorecard
from ledgerweave.operators import identity as idn
from ledgerweave.operators.fingerprint import compare_builds, fingerprints
from ledgerweave.operators.keys import dense_key, rank_by_id, rank_rows, repeated_groups
from ledgerweave.operators.union import union_all
from ledgerweave.operators.workspace import Workspace, in_parallel
from ledgerweave.plans import guards, identity_cases, inspection, loose, reports
from ledgerweave.plans import source_checks as sc
from ledgerweave.plans.shared import loose_warehouse, warehouse
from ledgerweave.plans.warehouse import TABLES, Warehouse
from ledgerweave.sources import bank_adapter as bank
from ledgerweave.sources.files import Staged, export_csv, scan, scan_expected_identities

Query = Callable[[SparkSession, str], DataFrame]
MONEY = reports.MONEY
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return add


def strict(name: str, fn: Callable[..., DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: fn(warehouse(spark, sf_dir))


def permissive(name: str, fn: Callable[..., DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: fn(loose_warehouse(spark, sf_dir))




# ------------------------------------------------------- scans, sinks, row edits


@query("scan_counts")
def scan_counts(spark, sf_dir):
    return inspection.row_counts(bank.bank_sources(spark, sf_dir))


@query("stage_snapshot")
def stage_snapshot(spark, sf_dir):
    """All eight sources tagged, written, read back and counted per batch."""
    ws = Workspace(spark, "snapshot")
    staged = Staged(ws, bank.bank_sources(spark, sf_dir), "batch_1", written=True)
    in_parallel({name: lambda name=name: staged[name] for name in staged})
    rows = F.count(F.lit(1)).alias("rows")
    return union_all(
        [
            staged[name].groupBy("batch_id").agg(rows).select(F.lit(name).alias("source"), "batch_id", "rows")
            for name in staged
        ]
    )


def expected_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the id numbers say about every person: profiles of one number belong together.

    Twins of the payment source are expected to stay ambiguous, merchants unmatched.
    Profiles with planted defects cannot all meet this, so the comparison shows how
    many identities the missing and wrong facts cost.
    """
    src = bank.bank_sources(spark, sf_dir)
    payer = F.col("payment_customer_id")

    def number(c: str):
        return F.substring(c, 2, bank.ID_DIGITS).alias("number")

    core = src["customer"].select(number("customer_id"), F.col("customer_id").alias("core_customer_id"))
    paid = src["payment_customer"].where(payer.startswith("P")).select(number("payment_customer_id"), payer)
    digital = src["digital_customer"].select(number("digital_customer_id"), "digital_customer_id")
    known = F.coalesce("payment_customer_id", "digital_customer_id").isNotNull()
    persons = (
        core.join(paid, "number", "left")
        .join(digital, "number", "left")
        .withColumn("expected_outcome", F.when(known, "MATCH").otherwise("CORE_ONLY"))
    )
    others = src["payment_customer"].where(~payer.startswith("P")).select(
        payer, F.when(payer.startswith("X"), "AMBIGUOUS").otherwise("UNMATCHED").alias("expected_outcome")
    )
    group = F.concat(F.lit("E"), F.coalesce("core_customer_id", "payment_customer_id"))
    return persons.unionByName(others, allowMissingColumns=True).select(
        "core_customer_id", "payment_customer_id", "digital_customer_id", "expected_outcome",
        group.alias("expected_group"), F.lit("by number").alias("notes"),
    )


@query("expected_identity_scan")
def expected_identity_scan(spark, sf_dir):
    path = Workspace(spark, "expected").path("expected")
    expected_people(spark, sf_dir).write.option("header", True).csv(path)
    return scan_expected_identities(spark, path)


@query("expected_identity_unpivot")
def expected_identity_unpivot(spark, sf_dir):
    return guards.expected_by_source(expected_people(spark, sf_dir))


@query("report_export")
def report_export(spark, sf_dir):
    path = Workspace(spark, "export").path("r2")
    export_csv(reports.transactions_by_date_channel(warehouse(spark, sf_dir)), path)
    ddl = (
        "full_date date, day_of_week string, channel_code string, channel_name string, "
        f"txn_count bigint, amount_aud {MONEY}"
    )
    return scan(spark, path, ddl, "csv")


@query("edit_rows")
def edit_rows(spark, sf_dir):
    """Clear the phone and replace the e-mail of customers whose supplier twin exists."""
    customers = bank.core_customers(bank.read_table(spark, sf_dir, "customer"))
    key = bank.prefixed("C", F.col("s_suppkey"))
    changes = bank.read_table(spark, sf_dir, "supplier").select(
        key.alias("customer_id"),
        F.lit(None).cast("string").alias("phone"),
        F.concat(F.lit("edited"), F.col("s_suppkey").cast("string")).alias("email"),
    )
    edited = edits.update_rows(customers, changes, ["customer_id"], ["phone", "email"])
    return edited.select("customer_id", "first_name", "last_name", "email", "phone")


@query("delete_rows")
def delete_rows(spark, sf_dir):
    """Payment profiles without those of the suppliers' customer numbers."""
    customers = bank.read_table(spark, sf_dir, "customer")
    supplier = bank.read_table(spark, sf_dir, "supplier")
    profiles = bank.payment_customers(customers, supplier)
    gone = supplier.select(bank.prefixed("P", F.col("s_suppkey")).alias("payment_customer_id"))
    kept = edits.delete_rows(profiles, gone, ["payment_customer_id"])
    return kept.select("payment_customer_id", "first_name", "last_name")


@query("derive_rows")
def derive_rows(spark, sf_dir):
    """Every reversed transaction gets a copy five minutes later under a new id."""
    tx = bank.payment_transactions(bank.read_table(spark, sf_dir, "orders"))
    changes = {
        "transaction_id": F.concat(F.col("transaction_id"), F.lit("-2")),
        "transaction_ts": F.col("transaction_ts") + F.expr("interval 5 minutes"),
        "status": F.lit("ACCEPTED"),
    }
    rows = edits.derive_rows(tx, F.col("status") == "REVERSED", changes)
    return rows.select("transaction_id", "source_transaction_ref", "transaction_ts", "status", "amount")


# ---------------------------------------------------------------- scalar functions


@query("norm_text")
def norm_text_query(spark, sf_dir):
    src = bank.bank_sources(spark, sf_dir)["payment_customer"]
    return src.select(
        "payment_customer_id",
        norm_text(full_name(F.col("first_name"), F.col("last_name"))).alias("name"),
        norm_text(F.col("email")).alias("email"),
    )


@query("norm_phone")
def norm_phone_query(spark, sf_dir):
    src = bank.bank_sources(spark, sf_dir)["payment_customer"]
    return src.select("payment_customer_id", "phone", norm_phone(F.col("phone")).alias("normal"))


@query("full_name")
def full_name_query(spark, sf_dir):
    src = bank.bank_sources(spark, sf_dir)["digital_customer"]
    return src.select(
        "digital_customer_id",
        full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        full_name(F.col("first_name"), F.col("email")).alias("null_part"),
    )


@query("date_key")
def date_key_query(spark, sf_dir):
    events = bank.read_table(spark, sf_dir, "events")
    return events.groupBy(date_key(F.col("ts")).alias("date_key")).agg(
        F.count(F.lit(1)).alias("events")
    )


@query("channel_name_map")
def channel_name_map(spark, sf_dir):
    tx = loose_warehouse(spark, sf_dir).src["transactions"]
    return tx.groupBy("channel").agg(F.count(F.lit(1)).alias("rows")).select(
        "channel", map_value(F.col("channel"), loose.CHANNEL_NAMES).alias("channel_name"), "rows"
    )


@query("null_safe_compare")
def null_safe_compare(spark, sf_dir):
    """Contact details of payment and digital profiles of one number, compared null-safely."""
    src = bank.bank_sources(spark, sf_dir)
    pay = src["payment_customer"].select(
        F.substring("payment_customer_id", 2, 12).alias("n"),
        F.substring("payment_customer_id", 1, 1).alias("kind"),
        F.col("email").alias("pay_email"), F.col("phone").alias("pay_phone"),
    ).where(F.col("kind") == "P")
    dig = src["digital_customer"].select(
        F.substring("digital_customer_id", 2, 12).alias("n"), "email", "phone"
    )
    return pay.join(dig, "n").select(
        "n",
        same(F.col("pay_email"), F.col("email")).alias("same_email"),
        differs(F.col("pay_phone"), F.col("phone")).alias("phone_differs"),
        (F.col("pay_phone") == F.col("phone")).alias("plain_phone_equal"),
    )


# -------------------------------------------------------- dimensions and identity

strict("dim_customer", lambda wh: wh.dim_customer)
strict("dim_account", lambda wh: wh.dim_account)
strict("dim_channel", lambda wh: wh.dim_channel)
strict("dim_date", lambda wh: wh.dim_date)
strict("customer_xref", lambda wh: wh.customer_xref)


@query("surrogate_key")
def surrogate_key(spark, sf_dir):
    orders = bank.read_table(spark, sf_dir, "orders")
    rows = orders.select("o_orderdate", "o_orderkey")
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey")]
    return dense_key(Workspace(spark, "keys"), "orders", rows, order, "order_seq")


def _resolved(wh, rule: str | None = None) -> DataFrame:
    rows = wh.xref_rows.where(F.col("source_system") != "S1")
    if rule is not None:
        rows = rows.where(F.col("match_rule") == rule)
    return rows.select("source_system", "source_customer_id", "customer_key", "match_rule", "match_status")


strict("identity_resolve", _resolved)
strict("identity_r1", lambda wh: idn.core_identities(wh.dim_customer))
strict("identity_r2", lambda wh: _resolved(wh, idn.R2))
strict("identity_r3", lambda wh: _resolved(wh, idn.R3))
strict("identity_none", lambda wh: _resolved(wh, idn.NONE))


@query("identity_pair_count")
def identity_pair_count(spark, sf_dir):
    """Source rows per (system, name, e-mail) pair that occurs more than once."""
    people = warehouse(spark, sf_dir).people
    known = people.where(F.col("name").isNotNull() & F.col("email").isNotNull())
    return (
        known.groupBy("source_system", "name", "email")
        .agg(F.count(F.lit(1)).alias("pair_count"))
        .where(F.col("pair_count") > 1)
    )


def _cases(cases: identity_cases.Cases):
    """Both whole sources with test people and test customers added, through a build's own plan."""

    def run(wh) -> DataFrame:
        def build(sources, ws):
            return Warehouse(wh.spark, sources, ws, wh.batch_id)

        return identity_cases.resolved(wh.src, cases, build, Workspace(wh.spark, cases.name))

    return run


strict("identity_boundary_cases", _cases(identity_cases.BOUNDARY))
strict("identity_pair_cases", _cases(identity_cases.PAIRS))

# --------------------------------------------------------- dispositions and facts


@query("tx_ranked")
def tx_ranked(spark, sf_dir):
    tx = bank.payment_transactions(bank.read_table(spark, sf_dir, "orders"))
    rows = tx.select("source_transaction_ref", "transaction_id")
    return rank_by_id(
        Workspace(spark, "ranked"), "tx", rows, ["source_transaction_ref"], "transaction_id"
    )


@query("tx_ranked_lines")
def tx_ranked_lines(spark, sf_dir):
    """Rank of every line item within its (order, line number), no id of its own."""
    lines = bank.read_table(spark, sf_dir, "lineitem")
    order = [c for c in lines.columns if c not in ("l_orderkey", "l_linenumber")]
    return rank_rows(
        Workspace(spark, "ranked"), "lines", lines, ["l_orderkey", "l_linenumber"], order
    )


@query("line_rank_summary")
def line_rank_summary(spark, sf_dir):
    """How many line items hold each rank, with their value."""
    ranked = tx_ranked_lines(spark, sf_dir)
    return ranked.groupBy("rn").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).cast(MONEY).alias("amount"),
    )


strict(
    "tx_disposition",
    lambda wh: wh.tx_decision.select(
        "transaction_id", "source_transaction_ref", "rn", "customer_key", "account_key", "amount", "disposition"
    ),
)
strict("activity_disposition", lambda wh: wh.activity_decision.select("activity_id", "customer_key", "disposition"))
strict("case_disposition", lambda wh: wh.case_decision.select("case_id", "customer_key", "disposition"))
strict("reject_rows", lambda wh: wh.rejected_record)
strict("fact_transaction", lambda wh: wh.fact_transaction)
strict("fact_activity", lambda wh: wh.fact_activity)
strict("fact_service_case", lambda wh: wh.fact_service_case)
strict("etl_run_log", lambda wh: wh.etl_run_log)

# ------------------------------------------------------------------------ reports

strict("r1_customer_360", reports.customer_360)
strict("r2_tx_by_date_channel", reports.transactions_by_date_channel)
strict("r2b_tx_by_channel", reports.transactions_by_channel)
strict("r3_channel_engagement", reports.channel_engagement)
strict("r3b_activity_mix", lambda wh: reports.activity_mix(wh.activity_rows))
strict("r4_case_summary", reports.case_summary)
strict("r5_dq_kpi", reports.data_quality_kpi)
strict("r6_attribution", reports.attribution_report)
strict("kpi_tiles", lambda wh: reports.kpi_tiles(reports.data_quality_kpi(wh)))
strict(
    "bar_share",
    lambda wh: reports.bar_share(reports.transactions_by_channel(wh), "channel_code", "amount_aud").select(
        "label", "value", F.round("share", 6).alias("share")
    ),
)
strict(
    "report_search",
    lambda wh: reports.report_search(
        reports.customer_360(wh).select("customer_key", "full_name", "core_customer_id", "transactions"),
        "customer 00000012",
    ),
)

# --------------------------------------------------------------------- inspection

strict("event_window", inspection.event_window)
strict("identity_counts", lambda wh: inspection.identity_counts(wh.xref_rows))
strict("identity_lookup", inspection.identity_anchors)
strict("disposition_counts", lambda wh: inspection.disposition_counts(wh.tx_decision))
strict("duplicate_ref_trace", inspection.duplicate_reference_trace)
strict("customer_trace", inspection.customer_trace)
strict("overview", inspection.overview)
strict("report_lineage", inspection.report_lineage)

# -------------------------------------------------------------- quality scorecard


def family(name: str, *families: str) -> None:
    checks = [c for c in sc.source_checks(sc.DERIVED) if not families or c.family in families]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        expected = sc.derived_expectations(spark, sf_dir, {c.name for c in checks})
        return scorecard.scorecard(bank.bank_sources(spark, sf_dir), checks, expected)

    QUERIES[name] = run


family("dq_scorecard")
family("dq_row_count", "row_count")
family("dq_duplicate_keys", "duplicate_keys")
family("dq_id_format", "id_format")
family("dq_ownership", "ownership")
family("dq_required_null", "required_null")
family("dq_temporal", "temporal")
family("dq_window", "window")
family("dq_amount_currency", "amount")
family("dq_domain", "domain")
family("dq_whitespace", "whitespace")
family("dq_orphans", "orphans")
family("dq_group_violation", "group_violation")
family("dq_fixture_presence", "fixture_presence")
family("dq_fixture_no_core_match", "fixture_no_core_match")


@query("dq_defect_list")
def dq_defect_list(spark, sf_dir):
    tables = bank.bank_sources(spark, sf_dir)
    refs = tables["payment_transaction"].select("source_transaction_ref")
    repeated = repeated_groups(Workspace(spark, "defects"), "refs", refs, ["source_transaction_ref"])
    return sc.defect_list(tables, repeated)


@query("identity_side_by_side")
def identity_side_by_side(spark, sf_dir):
    return sc.identity_side_by_side(bank.bank_sources(spark, sf_dir), offset=0, length=12)


# ------------------------------------------------------------------ reconciliation

strict("check_dim_counts", guards.dimension_counts)
strict("check_disposition_balance", guards.disposition_balance)
strict("check_load_totals", guards.warehouse_load_totals)
strict("check_event_rowwise", guards.event_rows_agree)
strict("check_amount_total", guards.amount_total)
strict("check_tx_rowwise", guards.transaction_rows_agree)
strict("check_missing_dims", guards.missing_dimensions)
strict("guard_t9_account", guards.account_identity)
strict("guard_t10_schema", guards.channel_attribution)
strict("guard_schema_attribution", guards.channel_attribution)
strict("guard_t11_fanout", guards.fanout_guard)
strict("fanout_demo", guards.fanout_totals)
strict("guard_t12_unresolved", guards.unresolved_visible)
strict("guard_t13_attribution", lambda wh: guards.attribution_balance(reports.attribution_report(wh)))
strict("identity_rule_coverage", lambda wh: guards.rule_coverage(wh.xref_rows))
strict("check_identity_status", lambda wh: guards.identity_status(wh.xref_rows))
strict("check_report_totals", guards.report_totals)
strict("check_constraints", guards.warehouse_constraints)
strict("check_precision", guards.lossless_casts)
strict("negative_amount", guards.negative_amount)


def planted_status(k, rule: dict[str, int], twins: bool) -> tuple:
    """Status and core number that the planted facts of a profile lead to.

    Neighbours by number share facts: (120j, 120j + 1) birth date, e-mail and name,
    (40j, 40j + 1) the name, and profile 120j + 2 carries the phone of 120j + 3, who has
    the same birth date.
    """
    def every(period: int, *rests: int):
        return (k % period).isin(*rests)

    no_dob, wrong_dob = every(rule["no_dob"], 0), every(rule["wrong_dob"], 0)
    email, phone = ~every(rule["no_email"], 0), ~every(rule["no_phone"], 0)
    has_next = F.col("has_next")
    shared = every(120, 1) | (every(120, 0) & has_next)
    borrowed = every(120, 2) & has_next & phone
    by_name = F.when(every(40, 1) | (every(40, 0) & has_next), idn.AMBIGUOUS).otherwise(idn.UNMATCHED)
    twin = every(121, 0) if twins else F.lit(False)
    status = (
        F.when(no_dob & email, F.when(shared | twin, idn.AMBIGUOUS).otherwise(idn.MATCHED))
        .when(no_dob | wrong_dob, by_name)
        .when(email, F.when(shared | borrowed, idn.AMBIGUOUS).otherwise(idn.MATCHED))
        .when(phone, idn.MATCHED)
        .otherwise(by_name)
    )
    other = borrowed & ~email & ~no_dob & ~wrong_dob
    return status, F.when(other, k + 1).otherwise(k)


def planted_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected identity of every source id, from the numbers alone."""
    customer = bank.read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    last = customer.agg(F.max("k")).scalar()
    people = customer.withColumn("has_next", F.col("k") < last)
    k = F.col("k")
    payer, user = (k % 20) != 4, (k % 15) != 3

    def rows(df: DataFrame, system: str, prefix: str, status, core) -> DataFrame:
        known = df.select(
            F.lit(system).alias("source_system"), bank.prefixed(prefix, k).alias("source_id"),
            bank.prefixed("C", core).alias("core_id"), status.alias("status"),
        )
        return known.withColumn("core_id", F.when(F.col("status") == idn.MATCHED, F.col("core_id")))

    shared = (k % 120 == 1) | ((k % 120 == 0) & F.col("has_next"))
    alone = ~payer | (k % 17 == 0)
    twin = F.when(alone & ~shared, idn.MATCHED).otherwise(idn.AMBIGUOUS)
    merchants = bank.read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"))
    return union_all(
        [
            rows(people, "S1", "C", F.lit(idn.MATCHED), k),
            rows(people.where(payer), "S2", "P", *planted_status(k, bank.PAYMENT_RULE, True)),
            rows(people.where(k % 121 == 0), "S2", "X", twin, k),
            rows(merchants, "S2", "Y", F.lit(idn.UNMATCHED), k),
            rows(people.where(user), "S3", "D", *planted_status(k, bank.DIGITAL_RULE, False)),
        ]
    )


def planted_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects that follow from the planted rules: repeated references, unknown accounts,
    missing profiles, and events of profiles that should not resolve."""
    o, e = F.col("o_orderkey"), F.col("event_id")
    open_ids = planted_identities(spark, sf_dir).where(F.col("status") != idn.MATCHED).select(
        "source_id", F.lit(True).alias("open")
    )
    orders = bank.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    before = orders.select((o + 1).alias("o_orderkey"), F.lit(True).alias("repeats"))
    c = F.col("o_custkey")
    tx = (
        orders.join(before, "o_orderkey", "left")
        .withColumn("source_id", bank.prefixed("P", c))
        .join(open_ids, "source_id", "left")
        .select(
            F.lit("transaction").alias("source_table"),
            bank.prefixed("T", o).alias("source_key"),
            F.when((o % 97 == 1) & F.col("repeats"), "REJECT_DUPLICATE")
            .when(o % 211 == 0, "REJECT_ACCOUNT")
            .when((o % 223 == 0) | (c % 20 == 4), "REJECT_CUSTOMER_REFERENCE")
            .when(F.col("open"), "REJECT_IDENTITY")
            .alias("reason"),
        )
    )
    events = (
        bank.read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
        .withColumn("source_id", bank.prefixed("D", F.col("user_id")))
        .join(open_ids, "source_id", "left")
        .withColumn(
            "reason",
            F.when((e % 499 == 0) | (F.col("user_id") % 15 == 3), "REJECT_CUSTOMER_REFERENCE")
            .when(F.col("open"), "REJECT_IDENTITY"),
        )
    )

    def of(df: DataFrame, table: str, prefix: str) -> DataFrame:
        return df.select(F.lit(table).alias("source_table"), bank.prefixed(prefix, e).alias("source_key"), "reason")

    cases = events.where(F.col("event_type") == "error")
    found = union_all([tx, of(events, "activity", "ACT"), of(cases, "service_case", "SC")])
    return found.where(F.col("reason").isNotNull())


@query("check_expected_rejects")
def check_expected_rejects(spark, sf_dir):
    return guards.expected_rejects(
        warehouse(spark, sf_dir).reject_rows, planted_rejects(spark, sf_dir)
    )


@query("check_expected_identity")
def check_expected_identity(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return guards.expected_identity(wh.xref_rows, wh.dim_customer, planted_identities(spark, sf_dir))


# ------------------------------------------------------------ fingerprint and audit


def _fingerprint(wh) -> DataFrame:
    built = wh.build()
    return fingerprints({name: built[name] for name in TABLES})


strict("fingerprint", _fingerprint)


@query("fingerprint_compare")
def fingerprint_compare(spark, sf_dir):
    """The shared build against a second build of its own from the same sources."""
    ws = Workspace(spark, "again")
    try:
        again = _fingerprint(Warehouse(spark, bank.bank_sources(spark, sf_dir), ws, "batch_2"))
        # One row per table; the second warehouse need not outlive them.
        second = spark.createDataFrame(again.collect(), again.schema)
    finally:
        ws.release()
    return compare_builds(_fingerprint(warehouse(spark, sf_dir)), second)


def batch_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch per day of events: RUNNING at its first event, FAIL if its last is an error."""
    day = F.date_format("ts", "yyyyMMdd")
    failed = F.max_by("event_type", F.struct("ts", "event_id")) == "error"
    days = (
        bank.read_table(spark, sf_dir, "events")
        .groupBy(day.alias("batch_id"))
        .agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"), failed.alias("failed"))
    )
    running = days.select(
        "batch_id", F.col("lo").alias("event_at"), F.lit("RUNNING").alias("status"),
        F.lit(None).cast("string").alias("error"),
    )
    done = days.select(
        "batch_id", F.col("hi").alias("event_at"),
        F.when(F.col("failed"), "FAIL").otherwise("PASS").alias("status"),
        F.when(F.col("failed"), "ended with an error event").alias("error"),
    )
    return running.unionByName(done)


@query("audit_batch")
def audit_batch(spark, sf_dir):
    return audit.batch_states(batch_events(spark, sf_dir))


@query("audit_latest")
def audit_latest(spark, sf_dir):
    return inspection.latest(audit.batch_states(batch_events(spark, sf_dir)), "started_at", 10)


@query("audit_step_counts")
def audit_step_counts(spark, sf_dir):
    """Step counts of two batches appended to one history and read back."""
    log = warehouse(spark, sf_dir).etl_run_log
    history = audit.AuditLog(spark, Workspace(spark, "audit").path("log"))
    for batch_id in ("batch_1", "batch_2"):
        history.record_steps(log.withColumn("batch_id", F.lit(batch_id)))
    return history.steps()


# ------------------------------------------------------------- permissive contract

permissive("dim_customer_dedup", lambda wh: wh.dim_customer)
permissive("permissive_dim_channel", lambda wh: wh.dim_channel)
permissive("permissive_dim_date", lambda wh: wh.dim_date)
permissive(
    "xref_exact_id",
    lambda wh: wh.xref_rows.where(F.col("source_system") == "S1").select(
        "source_system", "source_customer_id", "customer_key", "match_rule", "match_status"
    ),
)
permissive("identity_email_rule", lambda wh: wh.customer_xref)
permissive("permissive_dim_account", lambda wh: wh.dim_account)
permissive(
    "settled_with_valid_account",
    lambda wh: wh.settled.where(~F.col("orphan")).select("transaction_id", "account_id", "amount_aud"),
)
permissive("reject_orphan_account", lambda wh: wh.rejected_record)
permissive("permissive_facts", lambda wh: wh.transaction_rows)
permissive("permissive_activity", lambda wh: wh.activity_rows)
permissive("permissive_cases", lambda wh: wh.case_rows)
permissive("permissive_run_log", lambda wh: wh.run_log)
permissive("r1_permissive", loose.customer_360)
permissive("recon_t1", loose.settled_reconciliation)
permissive("recon_t2", loose.orphan_keys)
permissive("recon_t3", loose.duplicate_natural_keys)
permissive("recon_t4", lambda wh: inspection.identity_counts(wh.xref_rows))
permissive("recon_t4b", loose.unresolved_identities)
permissive("recon_t4c", loose.merged_names)
permissive("check_account_link", loose.account_links_kept)
permissive(
    "permissive_attribution",
    lambda wh: reports.attribution(wh.transaction_rows, wh.activity_rows, wh.case_rows),
)
permissive(
    "fingerprint_named",
    lambda wh: fingerprints(loose.fingerprint_tables(wh), loose.FINGERPRINT_COLUMNS),
)
