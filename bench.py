"""Headline timings: one JSON line.

``full_build`` is every dimension, identity, decision, fact and log of one batch from the
source tables, written. ``small_build_and_checks`` is the counterpart of the published baseline
at the nearest size: build, checks, scorecard and fingerprint. Names under ``reads_built``
time a report over the warehouse built before, as a reader would run it; queries marked
``fresh_`` start from the source tables again.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame

from ledgerweave.operators.fingerprint import fingerprints
from ledgerweave.operators.workspace import Workspace
from ledgerweave.plans import guards
from ledgerweave.plans.catalog import QUERIES
from ledgerweave.plans.loose import LooseWarehouse, fingerprint_tables
from ledgerweave.plans.shared import warehouse
from ledgerweave.plans.warehouse import TABLES, Warehouse
from ledgerweave.session import local_session
from ledgerweave.sources.bank_adapter import bank_sources
from ledgerweave.sources.loose_adapter import loose_sources

REPORT_QUERIES = [
    "r1_customer_360", "r2_tx_by_date_channel", "r2b_tx_by_channel", "r3_channel_engagement",
    "r4_case_summary", "r5_dq_kpi", "r6_attribution", "fanout_demo", "check_tx_rowwise",
    "check_missing_dims", "fingerprint",
]
FRESH_QUERIES = [
    "tx_ranked", "tx_ranked_lines", "surrogate_key", "dq_scorecard", "dq_defect_list",
    "identity_side_by_side", "identity_pair_cases",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))

    def strict_build() -> None:
        wh = Warehouse(spark, bank_sources(spark, sf_dir), Workspace(spark, "bench"))
        wh.build()

    def loose_build() -> None:
        wh = LooseWarehouse(spark, loose_sources(spark, sf_dir), Workspace(spark, "bench"))
        fingerprint_tables(wh)
        run(wh.run_log)

    # Class loading and code generation are paid once per cluster, not per batch.
    first = timed(strict_build)
    queries = {"full_build": timed(strict_build), "permissive_build": timed(loose_build)}
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):

        def small_batch() -> None:
            wh = Warehouse(spark, bank_sources(spark, small), Workspace(spark, "small"))
            wh.build()
            guards.assert_checks(wh)
            run(QUERIES["dq_scorecard"](spark, small))
            run(fingerprints({name: getattr(wh, name) for name in TABLES}))
            wh.ws.release()

        small_batch()
        queries["small_build_and_checks"] = timed(small_batch)
    shared = warehouse(spark, sf_dir)
    shared.build()
    queries["all_checks"] = timed(lambda: guards.assert_checks(shared))
    for name in REPORT_QUERIES:
        queries[name] = timed(lambda: run(QUERIES[name](spark, sf_dir)))
    for name in FRESH_QUERIES:
        queries[f"fresh_{name}"] = timed(lambda: run(QUERIES[name](spark, sf_dir)))
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": sf_dir.rstrip("/").split("sf")[-1],
                "first_build_cold": first,
                "reads_built": ["all_checks", *REPORT_QUERIES],
            }
        )
    )


if __name__ == "__main__":
    main()
