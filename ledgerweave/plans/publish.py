"""Batch builds: a fresh attempt, checks, audit, then one pointer that publishes it.

The protocol is the same for both contracts. Every attempt has a folder of its own with a
snapshot of the sources, the tables and their marks. Readers follow the pointer that is written
last, so a failed attempt, or one whose driver died, leaves them where they are, and its batch can be
built again under the same id. A batch that is published stays so whatever later attempts do.

As the snapshot lives and goes with the batch, every check, and the lineage of every report, can be
repeated on a published batch in any later session.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.operators.audit import FAIL, PASS, RUNNING, AuditLog
from ledgerweave.operators.batch_store import Attempt, BatchStore
from ledgerweave.operators.fingerprint import (
    MARKS,
    add_marks,
    compare_builds,
    differing_marks,
    fingerprints,
    table_marks,
)
from ledgerweave.operators.scorecard import Check, scorecard
from ledgerweave.operators.union import union_all
from ledgerweave.operators.workspace import Workspace, in_parallel
from ledgerweave.plans import guards, identity_cases, reports
from ledgerweave.plans.contracts import PERMISSIVE, STRICT, Contract
from ledgerweave.plans.warehouse import BatchTables, Warehouse
from ledgerweave.sources.files import export_csv

MONTH = "event_month"


@dataclass(frozen=True)
class Gate:
    """What a batch must meet besides the checks of its own tables.

    ``checks`` are source checks with their ``expectations``; there is no batch without them.
    ``identities`` and ``rejects`` are expected outcomes as ``guards`` reads them; ``cases`` are test
    people whose identity is resolved over the batch's sources (strict contract); ``twice`` builds the
    batch a second time and compares the two.
    """

    checks: Sequence[Check]
    expectations: DataFrame | None = None
    identities: DataFrame | None = None
    rejects: DataFrame | None = None
    cases: Sequence[identity_cases.Cases] = identity_cases.STANDARD
    twice: bool = True

    def __post_init__(self):
        if not self.checks:
            raise ValueError("a gate needs source checks")


def audit_log(spark: SparkSession, root: str) -> AuditLog:
    return AuditLog(spark, f"{root.rstrip('/')}/audit")


def write_sources(sources: Mapping[str, DataFrame], attempt: Attempt, contract: Contract) -> None:
    """The snapshot that the attempt reads, whatever becomes of the sources meanwhile."""
    in_parallel({
        name: lambda name=name: sources[name].write.mode("errorifexists").parquet(attempt.source(name))
        for name in contract.sources
    })


def read_sources(spark: SparkSession, attempt: Attempt, contract: Contract) -> dict[str, DataFrame]:
    return {name: spark.read.schema(ddl).parquet(attempt.source(name)) for name, ddl in contract.sources.items()}


def write_tables(built: Mapping[str, DataFrame], attempt: Attempt, contract: Contract) -> None:
    """All tables of the contract, facts partitioned by month.

    Ids and dates do not go together, so facts are gathered by month first; adaptive
    execution cuts a large month into files of the advisory partition size.
    """

    def write(name: str) -> None:
        df = built[name].select(*contract.columns(name))
        if name in contract.facts:
            month = F.floor(F.col("date_key") / 100).cast("int")
            writer = df.withColumn(MONTH, month).hint("rebalance", MONTH).write.partitionBy(MONTH)
        else:
            writer = df.write
        writer.mode("errorifexists").parquet(attempt.table(name))

    in_parallel({name: lambda name=name: write(name) for name in contract.schemas})


def read_tables(spark: SparkSession, attempt: Attempt, contract: Contract) -> dict[str, DataFrame]:
    """The written tables with the columns that the contract declares."""
    return {
        name: spark.read.schema(ddl).parquet(attempt.table(name)).select(*contract.columns(name))
        for name, ddl in contract.schemas.items()
    }


def open_batch(spark: SparkSession, attempt: Attempt, contract: Contract = STRICT) -> BatchTables:
    """A written batch; what it does not hold is derived from its snapshot when asked for."""

    def reopen():
        ws = Workspace(spark, f"{contract.name}-reopened")
        return contract.open(spark, read_sources(spark, attempt, contract), ws, attempt.batch_id)

    return BatchTables(
        spark, read_tables(spark, attempt, contract), reopen=reopen, root=f"{attempt.path}/tables"
    )


def _marks(tables: Mapping[str, DataFrame], contract: Contract) -> DataFrame:
    return union_all([
        table_marks(tables[name], name, contract.keys[name], contract.content.get(name)) for name in contract.schemas
    ])


def _fingerprints(tables: Mapping[str, DataFrame], contract: Contract) -> DataFrame:
    return fingerprints({name: tables[name] for name in contract.schemas}, contract.content)


def gate_failures(
    spark: SparkSession, sources: Mapping[str, DataFrame], seen: BatchTables, batch_id: str, gate: Gate,
    contract: Contract, again: Workspace,
) -> dict[str, int]:
    """Failed lines of everything the gate asks for, by name."""

    def source_checks() -> int:
        """Lines that fail, and checks that have no line."""
        lines = scorecard(sources, gate.checks, gate.expectations)
        passed = lines.where("result = 'PASS'").select("check_name").distinct().count()
        return len({c.name for c in gate.checks}) - passed

    def negative() -> int:
        """The corrupted copy must fail, the written facts must not."""
        lines = contract.negative(seen)
        fires = F.max((F.col("data") == "corrupted") & (F.col("result") == "FAIL"))
        quiet = F.count_if((F.col("data") == "real") & (F.col("result") != "PASS")) == 0
        return 0 if lines.agg((fires & quiet).alias("ok")).first()["ok"] else 1

    def test_people() -> int:
        def build(overlaid, ws):
            return contract.open(spark, overlaid, ws, batch_id)

        return identity_cases.disagreements(sources, gate.cases, build)

    def second_build() -> int:
        built = contract.build(contract.open(spark, sources, again, batch_id))
        again.table("fingerprints", lambda: _fingerprints(built, contract))
        return 0

    def failed(lines: DataFrame) -> int:
        return lines.where("result <> 'PASS'").count()

    actions = {"source checks": source_checks, "negative test": negative}
    if gate.identities is not None:
        actions["expected identities"] = lambda: failed(
            guards.expected_identity(seen.xref_rows, seen.dim_customer, gate.identities)
        )
    if gate.rejects is not None:
        actions["expected rejects"] = lambda: failed(guards.expected_rejects(seen.reject_rows, gate.rejects))
    if gate.cases and contract is STRICT:
        actions["identity cases"] = test_people
    if gate.twice:
        actions["second build"] = second_build
    return in_parallel(actions)


def check_attempt(
    spark: SparkSession, sources: Mapping[str, DataFrame], wh: Warehouse, built: Mapping[str, DataFrame],
    attempt: Attempt, gate: Gate, contract: Contract,
) -> dict[str, int]:
    """Failed lines of the gate and of the batch's own checks, all on the written tables.

    The own checks and the comparison with the build come last, so they also show that the tests
    before have left the batch untouched. The marks they compare are kept with the batch.
    """
    seen = BatchTables(spark, read_tables(spark, attempt, contract), wh)
    again = Workspace(spark, f"{attempt.batch_id}-again")
    try:
        failed = gate_failures(spark, sources, seen, attempt.batch_id, gate, contract, again)
        _marks(seen, contract).coalesce(1).write.mode("errorifexists").parquet(attempt.marks)
        written = add_marks(spark.read.schema(MARKS).parquet(attempt.marks), list(contract.schemas))
        checks = dict(contract.checks)
        checks["published equals built"] = lambda _: guards.equal_sums(_fingerprints(built, contract), written)
        if gate.twice:
            second = again.table("fingerprints", lambda: written.limit(0))
            checks["two equal builds"] = lambda _: guards.equal_sums(second, written)
        return failed | guards.failed_lines(checks, seen)
    finally:
        again.release()


def build_batch(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    root: str,
    batch_id: str,
    gate: Gate,
    contract: Contract = STRICT,
    rebuild: bool = False,
) -> BatchTables:
    """Build, check and publish one batch. A failure is recorded and raised.

    A batch that is published already is returned as it is; ``rebuild`` makes a new attempt,
    which takes its place if it passes and changes nothing if it does not. The tables of a failed
    attempt are removed, its audit events stay.
    """
    store, audit = BatchStore(spark, root), audit_log(spark, root)
    held = store.published(batch_id)
    if held is not None and not rebuild:
        passed = audit.attempts().where((F.col("attempt") == held.attempt) & (F.col("status") == PASS))
        if passed.isEmpty():  # the driver was lost between the pointer and the event
            audit.record(batch_id, PASS, attempt=held.attempt)
        return open_batch(spark, held, contract)
    attempt = store.begin(batch_id)
    audit.record(batch_id, RUNNING, attempt=attempt.attempt)
    ws = Workspace(spark, batch_id)
    try:
        write_sources(sources, attempt, contract)
        snapshot = read_sources(spark, attempt, contract)
        wh = contract.open(spark, snapshot, ws, batch_id)
        built = contract.build(wh)
        write_tables(built, attempt, contract)
        audit.record_steps(contract.steps(BatchTables(spark, built), batch_id), attempt.attempt)
        guards.raise_failed(check_attempt(spark, snapshot, wh, built, attempt, gate, contract))
    except Exception as error:
        audit.record(batch_id, FAIL, str(error)[:500], attempt.attempt)
        store.discard(attempt)
        raise
    finally:
        ws.release()
    store.publish(attempt)
    audit.record(batch_id, PASS, attempt=attempt.attempt)
    return open_batch(spark, attempt, contract)


def published_attempt(spark: SparkSession, root: str, batch_id: str | None = None) -> Attempt:
    held = BatchStore(spark, root).published(batch_id)
    if held is None:
        raise LookupError(f"no passed batch{f' {batch_id}' if batch_id else ''} below {root}")
    return held


def published(
    spark: SparkSession, root: str, contract: Contract = STRICT, batch_id: str | None = None
) -> BatchTables:
    """Tables of the newest published batch, or of one batch; every report reads them."""
    return open_batch(spark, published_attempt(spark, root, batch_id), contract)


def recheck(
    spark: SparkSession, root: str, contract: Contract = STRICT, batch_id: str | None = None
) -> dict[str, int]:
    """Failed lines of every check on a published batch, from its own snapshot, in any session.

    Its tables are also held against the marks that were kept when it was published.
    """
    attempt = published_attempt(spark, root, batch_id)
    seen = open_batch(spark, attempt, contract)
    kept = add_marks(read_marks(spark, attempt), list(contract.schemas))
    checks = dict(contract.checks)
    checks["tables as published"] = lambda _: guards.equal_sums(_fingerprints(seen, contract), kept)
    return guards.failed_lines(checks, seen)


def read_marks(spark: SparkSession, attempt: Attempt) -> DataFrame:
    return spark.read.schema(MARKS).parquet(attempt.marks)


def builds_equal(
    spark: SparkSession, root: str, first: str, second: str, contract: Contract = STRICT
) -> DataFrame:
    """Table by table, whether two published batches hold the same business data.

    Only the marks kept with the batches are read.
    """
    names = [n for n in contract.schemas if n not in ("etl_run_log", "run_log")]
    a, b = (add_marks(read_marks(spark, published_attempt(spark, root, x)), names) for x in (first, second))
    return compare_builds(a, b)


def differences(spark: SparkSession, root: str, first: str, second: str) -> DataFrame:
    """Where two published batches differ: table, month, bucket of keys and the rows on each side."""
    return differing_marks(*(read_marks(spark, published_attempt(spark, root, x)) for x in (first, second)))


def export_reports(batch: Warehouse | BatchTables, folder: str) -> None:
    for name, report in reports.REPORTS.items():
        export_csv(report(batch), f"{folder.rstrip('/')}/{name}")


__all__ = ["PERMISSIVE", "STRICT", "Gate", "build_batch", "builds_equal", "differences", "published", "recheck"]
