"""Permissive batches through the same protocol: gate, damage, publication, comparison."""

import pytest
from pyspark.sql import functions as F

import test_loose
from ledgerweave.plans import guards, publish
from ledgerweave.plans.contracts import LOOSE_SCHEMAS, LOOSE_SOURCE_CHECKS, PERMISSIVE
from ledgerweave.plans.loose import LooseWarehouse
from ledgerweave.plans.warehouse import BatchTables
from ledgerweave.sources.schemas import LOOSE_SOURCES

GATE = publish.Gate(LOOSE_SOURCE_CHECKS)
SHORT = publish.Gate(LOOSE_SOURCE_CHECKS, twice=False)


@pytest.fixture(scope="module")
def src(spark):
    return {n: spark.createDataFrame(r, LOOSE_SOURCES[n]) for n, r in test_loose.rows().items()}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("permissive"))


@pytest.fixture(scope="module")
def batch(spark, src, root):
    return publish.build_batch(spark, src, root, "b1", GATE, PERMISSIVE)


def test_published_batch_in_a_new_session(spark, root, batch):
    held = publish.published(spark, root, PERMISSIVE)
    for name, ddl in LOOSE_SCHEMAS.items():
        assert ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in held[name].schema) == ddl
    assert held["fact_transaction"].count() == 6 and held["dim_customer"].count() == 4
    assert set(publish.recheck(spark, root, PERMISSIVE).values()) == {0}
    steps = {r["step"]: r["loaded_count"] for r in publish.audit_log(spark, root).steps().collect()}
    assert steps == {"fact_transaction": 6, "fact_activity": 6, "fact_service_case": 4}


def test_two_builds_are_equal_and_a_changed_source_is_not(spark, src, root, batch):
    publish.build_batch(spark, src, root, "b2", SHORT, PERMISSIVE)
    rows = {r["table_name"]: r for r in publish.builds_equal(spark, root, "b1", "b2", PERMISSIVE).collect()}
    assert len(rows) == 9 and all(r["equal"] for r in rows.values())
    moved = dict(src, service_cases=src["service_cases"].withColumn("severity", F.lit("LOW")))
    publish.build_batch(spark, moved, root, "b3", SHORT, PERMISSIVE)
    assert {r["table_name"] for r in publish.differences(spark, root, "b1", "b3").collect()} == {"fact_service_case"}


DAMAGE = {
    "dim_customer": lambda df: df.where("customer_key > 1"),
    "dim_account": lambda df: df.withColumn("customer_key", F.lit(9).cast("bigint")),
    "dim_date": lambda df: df.limit(1),
    "dim_channel": lambda df: df.withColumn("channel_name", F.lit("?")),
    "customer_xref": lambda df: df.withColumn("customer_key", F.lit(1).cast("bigint")),
    "fact_transaction": lambda df: df.withColumn("amount_aud", (F.col("amount_aud") + 1).cast("decimal(12,2)")),
    "fact_activity": lambda df: df.limit(2),
    "fact_service_case": lambda df: df.unionByName(df),
    "rejected_record": lambda df: df.limit(0),
    "run_log": lambda df: df.withColumn("loaded_count", F.col("loaded_count") + 1),
}


def test_every_damaged_table_is_found(spark, root, batch):
    """By the comparison that stops a batch, and by the contract's own checks where they look."""
    attempt = publish.published_attempt(spark, root, "b1")
    held = publish.open_batch(spark, attempt, PERMISSIVE)
    kept = publish.add_marks(publish.read_marks(spark, attempt), list(LOOSE_SCHEMAS))
    hurt = {name: DAMAGE[name](held[name]) for name in LOOSE_SCHEMAS}
    lines = guards.equal_sums(publish._fingerprints(hurt, PERMISSIVE), kept).collect()
    assert {r["table_name"] for r in lines if r["result"] == "FAIL"} == set(LOOSE_SCHEMAS)
    seen = BatchTables(spark, hurt, reopen=lambda: LooseWarehouse(spark, publish.read_sources(spark, attempt, PERMISSIVE)))
    found = guards.failed_lines(PERMISSIVE.checks, seen)
    assert {name for name, n in found.items() if n} >= {
        "settled reconciliation", "orphan keys", "duplicate natural keys", "merged names", "account links", "run log",
    }


def test_a_damaged_table_leaves_the_batch_unpublished(spark, src, tmp_path, monkeypatch):
    real = publish.read_tables

    def read(spark, attempt, contract):
        tables = real(spark, attempt, contract)
        return tables | {"fact_transaction": DAMAGE["fact_transaction"](tables["fact_transaction"])}

    monkeypatch.setattr(publish, "read_tables", read)
    with pytest.raises(guards.CheckFailed, match="published equals built, settled reconciliation"):
        publish.build_batch(spark, src, str(tmp_path), "bad", SHORT, PERMISSIVE)
    monkeypatch.undo()
    with pytest.raises(LookupError):
        publish.published(spark, str(tmp_path), PERMISSIVE)
    assert publish.audit_log(spark, str(tmp_path)).batches().first()["status"] == "FAIL"
