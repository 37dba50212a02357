"""The batch protocol on a contract of one small table: attempts, pointers, audit, comparison."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerweave.operators.batch_store import BatchStore
from ledgerweave.operators.scorecard import Check
from ledgerweave.plans import guards, inspection, publish
from ledgerweave.plans.contracts import Contract


class Build:
    def __init__(self, spark, sources, ws, batch_id):
        self.spark, self.src, self.ws, self.batch_id = spark, sources, ws, batch_id

    @property
    def loaded(self):
        return self.src["events"].where("amount IS NOT NULL")


def total_agrees(wh):
    told = wh.loaded.agg(F.sum("amount").alias("a"))
    found = wh["fact"].agg(F.sum("amount").alias("b"))
    return told.join(found).select(guards.verdict(F.col("a") == F.col("b")))


TOY = Contract(
    name="toy",
    sources={"events": "id bigint, date_key int, amount bigint"},
    schemas={"fact": "id bigint, date_key int, amount bigint", "log": "step string, n bigint"},
    keys={"fact": "id", "log": "step"},
    open=Build,
    build=lambda b: {"fact": b.loaded, "log": b.loaded.agg(F.lit("fact").alias("step"), F.count("*").alias("n"))},
    checks={"total agrees": total_agrees},
    negative=lambda wh: wh["log"].selectExpr("inline(array(struct('real' AS data, 'PASS' AS result), struct('corrupted' AS data, 'FAIL' AS result)))"),
    steps=lambda tables, batch_id: tables["log"].selectExpr(
        f"'{batch_id}' AS batch_id", "step", "n AS source_count", "n AS loaded_count", "0L AS rejected_count", "0L AS excluded_count"
    ),
    facts=("fact",),
)
GATE = publish.Gate((Check("ids", "events", "duplicates", columns=("id",)),))


@pytest.fixture(scope="module")
def src(spark):
    return {"events": spark.range(300).selectExpr("id", "CAST(20260101 + 100 * (id % 3) AS INT) AS date_key", "id * 2 AS amount")}


def build(spark, src, root, batch_id="b1", **more):
    return publish.build_batch(spark, src, str(root), batch_id, GATE, TOY, **more)


def damaged_reads(monkeypatch):
    real = publish.read_tables

    def read(spark, attempt, contract):
        tables = real(spark, attempt, contract)
        return tables | {"fact": tables["fact"].withColumn("amount", F.col("amount") + 1)}

    monkeypatch.setattr(publish, "read_tables", read)


def states(spark, root):
    return {r["batch_id"]: r["status"] for r in publish.audit_log(spark, str(root)).batches().collect()}


def test_a_passed_batch_survives_every_later_attempt(spark, src, tmp_path, monkeypatch):
    first = build(spark, src, tmp_path)
    events = publish.audit_log(spark, str(tmp_path)).events
    before = events().count()
    # Sent again: the batch that is there, and nothing done.
    assert build(spark, src, tmp_path).root == first.root and events().count() == before
    damaged_reads(monkeypatch)
    with pytest.raises(guards.CheckFailed, match="published equals built, total agrees, two equal builds"):
        build(spark, src, tmp_path, rebuild=True)
    monkeypatch.undo()
    held = publish.published(spark, str(tmp_path), TOY)
    assert held.root == first.root and held["fact"].count() == 300
    assert states(spark, tmp_path) == {"b1": "PASS"}
    log = publish.audit_log(spark, str(tmp_path))
    assert sorted(r["status"] for r in log.attempts().collect()) == ["FAIL", "PASS"]
    # A rebuild that passes takes the place of the first one.
    second = build(spark, src, tmp_path, rebuild=True)
    assert publish.published(spark, str(tmp_path), TOY).root == second.root != first.root
    assert len(BatchStore(spark, str(tmp_path)).expire(1)) == 1 and not Path(first.root).exists()
    assert publish.published(spark, str(tmp_path), TOY)["fact"].count() == 300


def test_a_failed_or_abandoned_batch_can_be_built_again(spark, src, tmp_path, monkeypatch):
    class DriverGone(BaseException):
        pass

    def dies(*_):
        raise DriverGone

    monkeypatch.setattr(publish, "check_attempt", dies)
    with pytest.raises(DriverGone):  # nothing is tidied up, as if the driver had been killed
        build(spark, src, tmp_path)
    monkeypatch.undo()
    assert len(list(tmp_path.glob("batch=b1/attempt=*"))) == 1
    damaged_reads(monkeypatch)
    with pytest.raises(guards.CheckFailed):
        build(spark, src, tmp_path)
    monkeypatch.undo()
    assert states(spark, tmp_path) == {"b1": "FAIL"}
    with pytest.raises(LookupError):
        publish.published(spark, str(tmp_path), TOY)
    build(spark, src, tmp_path)
    assert publish.published(spark, str(tmp_path), TOY)["fact"].count() == 300
    assert states(spark, tmp_path) == {"b1": "PASS"}


def test_a_pointer_whose_audit_event_was_lost(spark, src, tmp_path, monkeypatch):
    real = publish.AuditLog.record

    def loses_pass(self, batch_id, status, *more, **named):
        if status == "PASS":
            raise OSError("gone")
        real(self, batch_id, status, *more, **named)

    monkeypatch.setattr(publish.AuditLog, "record", loses_pass)
    with pytest.raises(OSError):
        build(spark, src, tmp_path)
    monkeypatch.undo()
    assert publish.published(spark, str(tmp_path), TOY)["fact"].count() == 300
    build(spark, src, tmp_path)
    assert states(spark, tmp_path) == {"b1": "PASS"}


def test_source_checks_cannot_be_left_out(spark, src, tmp_path):
    with pytest.raises(ValueError):
        publish.Gate(())
    twice = {"events": src["events"].unionByName(src["events"])}
    with pytest.raises(guards.CheckFailed, match="source checks"):
        build(spark, twice, tmp_path)
    assert not list(tmp_path.glob("batch=*/attempt=*")) and states(spark, tmp_path) == {"b1": "FAIL"}


def test_two_batches_differ_in_one_month(spark, src, tmp_path):
    build(spark, src, tmp_path, "b1")
    changed = F.when(F.col("id") == 7, 1).otherwise(F.col("amount")).cast("bigint")
    build(spark, {"events": src["events"].withColumn("amount", changed)}, tmp_path, "b2")
    found = publish.differences(spark, str(tmp_path), "b1", "b2")
    assert [(r["table_name"], r["month"]) for r in found.collect()] == [("fact", 202602)]
    read = inspection.scan_roots(found)
    assert read and all(p.endswith("/marks") for p in read)
    unequal = {r["table_name"]: r["equal"] for r in publish.builds_equal(spark, str(tmp_path), "b1", "b2", TOY).collect()}
    assert unequal == {"fact": False, "log": True}
    assert publish.differences(spark, str(tmp_path), "b1", "b1").count() == 0


def test_damage_after_publication_is_found(spark, src, tmp_path):
    build(spark, src, tmp_path)
    assert set(publish.recheck(spark, str(tmp_path), TOY).values()) == {0}
    held = publish.published_attempt(spark, str(tmp_path))
    spark.createDataFrame([("fact", 299)], TOY.schemas["log"]).write.mode("overwrite").parquet(held.table("log"))
    assert publish.recheck(spark, str(tmp_path), TOY)["tables as published"] == 1


def test_batches_of_any_name_and_expiry(spark, src, tmp_path):
    names = ["2026-03-31", "a/b c", "x,y=z%"]
    for name in names:
        build(spark, src, tmp_path, name)
    store = BatchStore(spark, str(tmp_path))
    assert [p.batch_id for p in store.publications()] == names
    assert publish.published(spark, str(tmp_path), TOY, batch_id="a/b c")["fact"].count() == 300
    with pytest.raises(ValueError):
        store.discard(store.published("a/b c"))
    with pytest.raises(ValueError):
        store.expire(0)
    assert [p.batch_id for p in store.expire(2)] == ["2026-03-31"]
    with pytest.raises(LookupError):
        publish.published(spark, str(tmp_path), TOY, batch_id="2026-03-31")
    assert publish.published(spark, str(tmp_path), TOY)["log"].first()["n"] == 300
