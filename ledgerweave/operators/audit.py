"""Append-only audit: events of every attempt to build a batch, and step counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_EVENT = "batch_id string, event_at timestamp, status string, error string, attempt string"
STEP_COUNT = (
    "batch_id string, step string, source_count bigint, loaded_count bigint, rejected_count bigint, "
    "excluded_count bigint, attempt string"
)

# Batch states.
RUNNING, PASS, FAIL = "RUNNING", "PASS", "FAIL"


class AuditLog:
    """Two growing Parquet tables below one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.batch_path = f"{folder.rstrip('/')}/batch_events"
        self.step_path = f"{folder.rstrip('/')}/step_counts"

    def record(self, batch_id: str, status: str, error: str | None = None, attempt: str | None = None) -> None:
        event = self.spark.range(1).select(
            F.lit(batch_id).alias("batch_id"),
            F.current_timestamp().alias("event_at"),
            F.lit(status).alias("status"),
            F.lit(error).cast("string").alias("error"),
            F.lit(attempt).cast("string").alias("attempt"),
        )
        event.write.mode("append").parquet(self.batch_path)

    def record_steps(self, run_log: DataFrame, attempt: str | None = None) -> None:
        run_log.select(
            "batch_id", "step", "source_count", "loaded_count", "rejected_count", "excluded_count",
            F.lit(attempt).cast("string").alias("attempt"),
        ).coalesce(1).write.mode("append").parquet(self.step_path)

    def events(self) -> DataFrame:
        return self.spark.read.schema(BATCH_EVENT).parquet(self.batch_path)

    def batches(self) -> DataFrame:
        return batch_states(self.events())

    def attempts(self) -> DataFrame:
        return attempt_states(self.events())

    def steps(self) -> DataFrame:
        """Step counts of all attempts, without saying which attempt."""
        return self.spark.read.schema(STEP_COUNT).parquet(self.step_path).drop("attempt")


def attempt_states(events: DataFrame) -> DataFrame:
    """Current state of every attempt from its events."""
    done = F.col("status") != RUNNING
    # A terminal event wins over RUNNING even when both carry the same instant.
    order = F.struct("event_at", done)
    return events.groupBy("batch_id", "attempt").agg(
        F.min("event_at").alias("started_at"),
        F.max(F.when(done, F.col("event_at"))).alias("finished_at"),
        F.max_by("status", order).alias("status"),
        F.max_by("error", order).alias("error"),
    )


def batch_states(events: DataFrame) -> DataFrame:
    """Current state of every batch: that of its newest attempt, but a PASS is never revoked."""
    if "attempt" not in events.columns:
        events = events.withColumn("attempt", F.lit(None).cast("string"))
    attempts = attempt_states(events)
    order = F.struct(F.col("status") == PASS, "started_at", "attempt")
    return attempts.groupBy("batch_id").agg(
        F.min("started_at").alias("started_at"),
        F.max_by("finished_at", order).alias("finished_at"),
        F.max_by("status", order).alias("status"),
        F.max_by("error", order).alias("error"),
    )


def latest_pass(batches: DataFrame) -> DataFrame:
    """The newest batch that passed its checks."""
    return batches.where(F.col("status") == PASS).orderBy(F.desc("started_at")).limit(1)
