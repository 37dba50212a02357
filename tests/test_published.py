"""The published contract end to end on its rebuilt sources."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import published_fixture
from ledgerweave.operators import scorecard
from ledgerweave.operators.batch_store import BatchStore
from ledgerweave.operators.disposition import REJECT_ACCOUNT
from ledgerweave.plans import guards, identity_cases, inspection, publish, reports
from ledgerweave.operators.scorecard import Check
from ledgerweave.operators.workspace import Workspace
from ledgerweave.plans import source_checks as sc
from ledgerweave.plans import warehouse
from ledgerweave.plans.warehouse import SCHEMAS, BatchTables, Warehouse
from ledgerweave.session import shared_folder
from ledgerweave.sources.files import scan, scan_expected_identities
from ledgerweave.sources.schemas import EXPECTED_IDENTITY


REJECTS = [
    ("transaction", "T000250", "REJECT_ACCOUNT"),
    ("transaction", "T002001", "REJECT_DUPLICATE"),
    ("transaction", "T002002", "REJECT_CUSTOMER_REFERENCE"),
    ("activity", "ACT000050", "REJECT_CUSTOMER_REFERENCE"),
    ("service_case", "SC00020", "REJECT_CUSTOMER_REFERENCE"),
]


def people():
    """The expected person behind every source id."""
    out = []
    for n in range(1, 201):
        pay = None if n in published_fixture.NO_PAYMENT else f"P{1000 + n}"
        dig = None if n in published_fixture.NO_DIGITAL else f"D{1000 + n}"
        out.append((f"C{n:04d}", pay, dig, "MATCH" if pay or dig else "CORE_ONLY", f"E{n:04d}", None))
    out.append((None, "P8888", None, "AMBIGUOUS", "E0201", None))
    out.append((None, "P9999", None, "UNMATCHED", "E0202", None))
    return out


# A gate of one source check, for tests of other parts.
ONE_CHECK = (Check("customers", "customer", "rows", expected=200),)
SHORT = publish.Gate(ONE_CHECK, cases=(), twice=False)


@pytest.fixture(scope="module")
def src(spark):
    return published_fixture.sources(spark)


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("published"))


@pytest.fixture(scope="module")
def batch(spark, src, root):
    """A batch through the whole gate."""
    rejects = spark.createDataFrame(REJECTS, "source_table string, source_key string, reason string")
    identities = guards.expected_by_source(spark.createDataFrame(people(), EXPECTED_IDENTITY))
    gate = publish.Gate(sc.source_checks(sc.PUBLISHED), None, identities, rejects)
    return publish.build_batch(spark, src, root, "b1", gate=gate)


@pytest.fixture(scope="module")
def wh(spark, src):
    return Warehouse(spark, src, Workspace(spark, "published"), "b0")


def test_all_89_source_checks_pass(src):
    checks = sc.source_checks(sc.PUBLISHED)
    assert len(checks) == 89 and len({c.name for c in checks}) == 89
    assert sum(c.group == "FIXTURE" for c in checks) == 22
    lines = scorecard.scorecard(src, checks).collect()
    assert len(lines) == 89
    assert [r["check_name"] for r in lines if r["result"] != "PASS"] == []


def test_identity_counts(wh):
    got = {tuple(r)[:3]: r["rows"] for r in inspection.identity_counts(wh.xref_rows).collect()}
    assert got == {
        ("S1", "R1_CORE_ID", "matched"): 200,
        ("S2", "R2_DOB_CONTACT", "matched"): 189,
        ("S3", "R2_DOB_CONTACT", "matched"): 186,
        ("S2", "NONE", "ambiguous"): 1,
        ("S2", "NONE", "unmatched"): 1,
    }


def test_rejects_and_log(spark, wh):
    expected = spark.createDataFrame(REJECTS, "source_table string, source_key string, reason string")
    lines = guards.expected_rejects(wh.reject_rows, expected).collect()
    assert sum(r["found"] for r in lines) == 5
    assert sum(r["missing"] + r["additional"] for r in lines) == 0
    assert all(r["result"] == "PASS" for r in lines)
    fewer = guards.expected_rejects(wh.reject_rows, expected.where("reason <> 'REJECT_ACCOUNT'")).collect()
    assert [r["reason"] for r in fewer if r["result"] == "FAIL"] == ["REJECT_ACCOUNT"]
    log = {r["step"]: (r["source_count"], r["loaded_count"], r["rejected_count"]) for r in wh.etl_run_log.collect()}
    assert log["activity"] == (1000, 999, 1) and log["service_case"] == (100, 99, 1)
    assert log["transaction"][0] == 2002 and log["transaction"][2] == 3


def test_channels_and_calendar(wh):
    assert wh.dim_channel.count() == 5
    engaged = {r["channel_code"]: r["activity_count"] for r in reports.channel_engagement(wh).collect()}
    assert engaged["ATM"] == 0 and sum(engaged.values()) == 999
    assert wh.dim_date.first()["day_of_week"] in {"Thursday", "Friday", "Saturday", "Sunday", "Monday", "Tuesday", "Wednesday"}


def test_duplicate_comes_first_even_if_the_kept_row_is_bad(spark, src, ws):
    bad = F.when(F.col("transaction_id") == "T000100", "A99999").otherwise(F.col("account_id"))
    broken = dict(src, payment_transaction=src["payment_transaction"].withColumn("account_id", bad))
    wh = Warehouse(spark, broken, ws)
    got = {r["transaction_id"]: r["disposition"] for r in wh.tx_decision.where("source_transaction_ref = 'BREF-000100'").collect()}
    assert got == {"T000100": REJECT_ACCOUNT, "T002001": "REJECT_DUPLICATE"}


def test_published_batch_and_two_equal_builds(spark, src, root, batch):
    publish.build_batch(spark, src, root, "b2", SHORT)
    equal = publish.builds_equal(spark, root, "b1", "b2").collect()
    assert len(equal) == 9 and all(r["equal"] for r in equal)
    assert publish.differences(spark, root, "b1", "b2").count() == 0
    newest = publish.published(spark, root)
    assert newest["fact_transaction"].select("batch_id").first()[0] == "b2"
    assert publish.published(spark, root, batch_id="b1")["fact_transaction"].select("batch_id").first()[0] == "b1"
    log = publish.audit_log(spark, root)
    assert {r["batch_id"]: r["status"] for r in log.batches().collect()} == {"b1": "PASS", "b2": "PASS"}
    assert log.steps().count() == 6


def test_reports_read_a_published_batch(spark, src, root, batch, wh):
    """The batch's workspace is gone; its reports equal those of a live warehouse."""
    newest = publish.published(spark, root)
    for name, ddl in SCHEMAS.items():
        assert ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in newest[name].schema) == ddl
    for report in reports.REPORTS.values():
        ours, theirs = report(newest), report(wh)
        assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()


def damaged_facts(df):
    return df.withColumn("amount_aud", (F.col("amount_aud") + 1).cast("decimal(12,2)"))


DAMAGE = {
    "half the transactions": ("fact_transaction", lambda df: df.where("transaction_key % 2 = 0")),
    "amounts raised": ("fact_transaction", damaged_facts),
    "three activities": ("fact_activity", lambda df: df.limit(3)),
    "case status": ("fact_service_case", lambda df: df.withColumn("status", F.lit("OPEN"))),
    "rejects emptied": ("rejected_record", lambda df: df.limit(0)),
    "identities shifted": (
        "customer_xref", lambda df: df.withColumn("customer_key", F.col("customer_key") % 200 + 1),
    ),
    "customers lost": ("dim_customer", lambda df: df.where("customer_key > 5")),
    "accounts moved": ("dim_account", lambda df: df.withColumn("customer_key", F.lit(1).cast("bigint"))),
    "a day lost": ("dim_date", lambda df: df.where(F.col("date_key") > df.agg(F.min("date_key")).first()[0])),
    "channel renamed": ("dim_channel", lambda df: df.withColumn("channel_name", F.lit("?"))),
    "log altered": ("etl_run_log", lambda df: df.withColumn("loaded_count", F.col("loaded_count") - 1)),
}


def test_every_damage_to_a_published_table_is_found(wh):
    tables = {name: getattr(wh, name) for name in SCHEMAS}
    assert set(guards.failures(wh, tables).values()) == {0}
    for label, (name, hurt) in DAMAGE.items():
        found = guards.failures(wh, dict(tables, **{name: hurt(tables[name])}))
        assert sum(found.values()) > 0, label
        # Not only the comparison with the build notices what the batch's numbers show.
        if label in ("half the transactions", "amounts raised", "three activities", "rejects emptied"):
            assert sum(n for check, n in found.items() if check != "published equals built") > 0, label


def test_damage_while_writing_leaves_the_batch_unpublished(spark, src, tmp_path, monkeypatch):
    real = publish.read_tables

    def read(spark, attempt, contract):
        tables = real(spark, attempt, contract)
        return tables | {"fact_transaction": damaged_facts(tables["fact_transaction"])}

    monkeypatch.setattr(publish, "read_tables", read)
    with pytest.raises(guards.CheckFailed, match="amount total"):
        publish.build_batch(spark, src, str(tmp_path), "bad", SHORT)
    monkeypatch.undo()
    with pytest.raises(LookupError):
        publish.published(spark, str(tmp_path))
    assert not list(tmp_path.glob("batch=*/attempt=*"))


def test_checks_and_lineage_of_a_published_batch(spark, root, batch):
    """Nothing of the build is left: sources come from the batch's snapshot."""
    assert set(publish.recheck(spark, root, batch_id="b1").values()) == {0}
    traced = inspection.report_lineage(publish.published(spark, root, batch_id="b1")).collect()
    assert {r["report"] for r in traced} == set(reports.REPORTS)
    assert not any(r["table_name"].startswith("outside:") for r in traced)
    sizes = {r["table_name"]: r["rows"] for r in traced}
    assert sizes["dim_customer"] == 200 and sizes["fact_activity"] == 999


def test_an_amount_beyond_the_declared_type_is_a_line_and_no_crash(spark, src):
    huge = F.when(F.col("transaction_id") == "T000700", F.lit("12345678901.25")).otherwise(F.col("amount"))
    wide = dict(src, payment_transaction=src["payment_transaction"].withColumn("amount", huge.cast("decimal(15,2)")))
    wh = Warehouse(spark, wide, Workspace(spark, "wide"), "b0")
    lines = {(r["table_name"], r["result"]): r["violations"] for r in guards.lossless_casts(wh).collect()}
    assert lines == {("fact_transaction", "FAIL"): 1, ("rejected_record", "PASS"): 0}
    assert guards.CHECKS["lossless casts"] is guards.lossless_casts
    assert wh.transaction_rows.where("amount_aud IS NULL").count() == 1


@pytest.mark.parametrize("part", ["source checks", "expected identities", "expected rejects", "identity cases"])
def test_gate_parts_stop_a_batch(spark, src, wh, part):
    found = identity_cases.PAIRS.expected[0]
    other = identity_cases.Cases(
        "wrong", identity_cases.PAIRS.customers, identity_cases.PAIRS.payers, [], [(found[0], "ZC-solo", "R3_NAME_EMAIL", "matched")]
    )
    wrong = {
        "source checks": {"checks": [*ONE_CHECK, Check("too_many", "customer", "rows", expected=1)]},
        "expected identities": {
            "identities": guards.expected_by_source(spark.createDataFrame(people()[1:], EXPECTED_IDENTITY))
        },
        "expected rejects": {
            "rejects": spark.createDataFrame(REJECTS[1:], "source_table string, source_key string, reason string")
        },
        "identity cases": {"cases": [other]},
    }[part]
    gate = publish.Gate(**({"checks": ONE_CHECK, "cases": (), "twice": False} | wrong))
    seen = BatchTables(spark, {name: getattr(wh, name) for name in SCHEMAS}, wh)
    folder = Path(shared_folder(spark))
    before = set(folder.iterdir())
    lines = publish.gate_failures(spark, src, seen, "bad", gate, publish.STRICT, Workspace(spark, "again"))
    assert [name for name, n in lines.items() if n] == [part]
    assert set(folder.iterdir()) == before  # the workspaces are gone


def test_a_changed_rule_is_found_by_the_test_people(spark, src, monkeypatch):
    def build(sources, ws):
        return Warehouse(spark, sources, ws, "b0")

    real = warehouse.idn.people

    def careless(source, system, id_column):
        # Birth dates ignored: the user with another birthday now looks like the customer.
        return real(source.withColumn("date_of_birth", F.lit(None).cast("date")), system, id_column)

    assert identity_cases.disagreements(src, [identity_cases.BOUNDARY], build) == 0
    monkeypatch.setattr(warehouse.idn, "people", careless)
    assert identity_cases.disagreements(src, [identity_cases.BOUNDARY], build) > 0


def test_files_per_month_are_bounded(spark, wh, tmp_path):
    """Ids and months do not go together; sixteen tasks still write each month once."""
    spread = {n: getattr(wh, n).repartition(16) if n in publish.STRICT.facts else getattr(wh, n) for n in SCHEMAS}
    attempt = BatchStore(spark, str(tmp_path)).begin("b")
    publish.write_tables(spread, attempt, publish.STRICT)
    for fact in publish.STRICT.facts:
        for month in Path(attempt.table(fact)).glob("event_month=*"):
            assert len(list(month.glob("*.parquet"))) == 1


def test_a_failed_write_can_be_repeated(spark):
    ws = Workspace(spark, "retry")
    bad = spark.range(3).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception, match="no"):
        ws.table("t", lambda: bad)
    assert ws.table("t", lambda: spark.range(3)).count() == 3


def test_controlled_fanout(wh):
    lines = {r["case_name"]: r for r in guards.fanout_guard(wh).collect()}
    assert (lines["controlled"]["right_total"], lines["controlled"]["wrong_total"]) == (150, 450)
    assert all(r["result"] == "PASS" for r in lines.values())


def test_corrupted_amount_is_found(wh):
    lines = {(r["data"], r["fact"]): r["result"] for r in guards.negative_amount(wh).collect()}
    assert lines[("corrupted", "fact_transaction")] == "FAIL"
    assert all(v == "PASS" for (data, _), v in lines.items() if data == "real")


def test_constraints_find_violations(wh):
    tables = wh.build()
    broken = dict(tables, dim_customer=tables["dim_customer"].unionByName(tables["dim_customer"]))
    broken["fact_transaction"] = broken["fact_transaction"].withColumn("account_key", F.lit(10**6).cast("bigint"))
    lines = {(r[0], r[1]): r["violations"] for r in guards.table_constraints(broken).collect()}
    assert lines[("dim_customer", "unique core_customer_id")] == 200
    assert lines[("fact_transaction", "references account_key")] == tables["fact_transaction"].count()
    assert lines[("dim_account", "unique account_id")] == 0


def test_expected_identity_file_with_byte_order_mark(spark, wh, tmp_path):
    lines = ["core_customer_id,payment_customer_id,digital_customer_id,expected_outcome,expected_group,notes"]
    lines += [",".join(v or "" for v in person) for person in people()]
    path = tmp_path / "expected.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8-sig")
    scanned = scan_expected_identities(spark, str(path))
    assert scanned.where("expected_outcome = 'CORE_ONLY'").count() == 3
    expected = guards.expected_by_source(scanned)
    assert expected.count() == 577 == wh.xref_rows.count()
    lines = guards.expected_identity(wh.xref_rows, wh.dim_customer, expected).collect()
    assert sum(r["expected_ids"] for r in lines) == 577 and all(r["result"] == "PASS" for r in lines)
    fewer = guards.expected_identity(wh.xref_rows, wh.dim_customer, expected.where("source_id <> 'P9999'"))
    assert [r["status"] for r in fewer.collect() if r["result"] == "FAIL"] == ["unexpected"]


def test_side_by_side(src):
    rows = {r["core_customer_id"] or r["payment_customer_id"]: r for r in sc.identity_side_by_side(src).collect()}
    assert rows["C0010"]["payment_first_name"] == " John " and rows["C0003"]["digital_customer_id"] is None
    assert rows["P8888"]["core_customer_id"] is None and len(rows) == 202


def test_report_export(spark, wh, tmp_path):
    publish.export_reports(wh, str(tmp_path))
    back = scan(spark, str(tmp_path / "v_r4_service_case_summary"), "status string, n bigint, c bigint, h bigint", "csv")
    assert sum(r["n"] for r in back.collect()) == 99


def test_reports_read_only_the_warehouse(wh):
    tables = {r["table_name"] for r in inspection.report_lineage(wh).collect()}
    assert not any(t.startswith("outside:") for t in tables)


def test_wrong_fanout_is_counted_without_building_it(wh):
    t, a, c = wh.transaction_rows, wh.activity_rows, wh.case_rows
    joined = t.select("customer_key", "amount_aud").join(a.select("customer_key"), "customer_key").join(
        c.select("customer_key"), "customer_key"
    )
    want = joined.agg(F.sum("amount_aud"), F.count(F.lit(1))).first()
    got = guards.fanout_totals(wh).where(F.col("approach").startswith("WRONG")).first()
    assert (got["total_amount_aud"], got["rows"]) == tuple(want)
