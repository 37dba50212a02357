from datetime import datetime

from pyspark.sql import functions as F

from ledgerweave.operators.audit import batch_states, latest_pass
from ledgerweave.operators.edits import delete_rows, derive_rows, update_rows


def test_update_may_set_null(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string")
    edits = spark.createDataFrame([("a", None)], "k string, v string")
    assert sorted(tuple(r) for r in update_rows(df, edits, ["k"], ["v"]).collect()) == [("a", None), ("b", "2")]


def test_delete_and_derive(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert delete_rows(df, df.where("v = 1"), ["k"]).first()["k"] == "b"
    out = derive_rows(df, F.col("k") == "a", {"k": F.lit("c"), "v": F.col("v") + 5})
    assert sorted(tuple(r) for r in out.collect()) == [("a", 1), ("b", 2), ("c", 6)]


def test_batch_states(spark):
    t = [datetime(2026, 1, 1, h) for h in range(4)]
    events = spark.createDataFrame(
        [("b1", t[0], "RUNNING", None), ("b1", t[1], "PASS", None), ("b2", t[2], "RUNNING", None),
         ("b2", t[2], "FAIL", "broken"), ("b3", t[3], "RUNNING", None)],
        "batch_id string, event_at timestamp, status string, error string",
    )
    states = {r["batch_id"]: r for r in batch_states(events).collect()}
    assert [states[b]["status"] for b in ("b1", "b2", "b3")] == ["PASS", "FAIL", "RUNNING"]
    assert states["b2"]["error"] == "broken" and states["b3"]["finished_at"] is None
    assert latest_pass(batch_states(events)).first()["batch_id"] == "b1"


def test_a_pass_is_never_revoked(spark):
    t = [datetime(2026, 1, 1, h) for h in range(6)]
    events = spark.createDataFrame(
        [("b1", t[0], "RUNNING", None, "x"), ("b1", t[1], "PASS", None, "x"),
         ("b1", t[2], "RUNNING", None, "y"), ("b1", t[3], "FAIL", "broken", "y"),
         ("b2", t[1], "RUNNING", None, "p"), ("b2", t[2], "FAIL", "first", "p"), ("b2", t[4], "RUNNING", None, "q")],
        "batch_id string, event_at timestamp, status string, error string, attempt string",
    )
    states = {r["batch_id"]: r for r in batch_states(events).collect()}
    assert (states["b1"]["status"], states["b1"]["finished_at"], states["b1"]["error"]) == ("PASS", t[1], None)
    assert (states["b2"]["status"], states["b2"]["started_at"]) == ("RUNNING", t[1])
