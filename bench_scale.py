"""How the batch grows: full build on replicated test tables.

Usage: python bench_scale.py SF_DIR OUT_DIR FACTOR [FACTOR ...]

Each factor copies every table that many times with shifted keys, writes the
copies below OUT_DIR and times one warm build of all warehouse tables, the
checks and the customer report.
"""

from __future__ import annotations

import json
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.operators.workspace import Workspace
from ledgerweave.plans import guards, reports
from ledgerweave.plans.warehouse import Warehouse
from ledgerweave.session import local_session
from ledgerweave.sources.bank_adapter import bank_sources, read_table

# Key columns of each table and the table whose size shifts them.
KEYS = {
    "customer": {"c_custkey": "customer"},
    "supplier": {"s_suppkey": "supplier"},
    "orders": {"o_orderkey": "orders", "o_custkey": "customer"},
    "lineitem": {"l_orderkey": "orders"},
    "events": {"event_id": "events", "user_id": "customer"},
}


def replicate(spark: SparkSession, sf_dir: str, out: str, factor: int) -> None:
    sizes = {t: read_table(spark, sf_dir, t).count() for t in ("customer", "supplier", "orders", "events")}
    copies = spark.range(factor).withColumnRenamed("id", "_copy")
    for table, keys in KEYS.items():
        df = read_table(spark, sf_dir, table)
        spread: DataFrame = df.join(F.broadcast(copies))
        shifted = {k: F.col(k) + F.col("_copy") * sizes[by] for k, by in keys.items()}
        if table == "customer":
            shifted["c_name"] = F.concat(
                F.lit("Customer#"), F.lpad(shifted["c_custkey"].cast("string"), 9, "0")
            )
        # Several files, as a large table has; one small row group would run as one task.
        spread.withColumns(shifted).drop("_copy").repartition(16).write.parquet(f"{out}/{table}.parquet")


def main(sf_dir: str, out_dir: str, factors: list[int]) -> None:
    spark = local_session("scale")
    Warehouse(spark, bank_sources(spark, sf_dir), Workspace(spark, "warm")).build()
    for factor in factors:
        folder = f"{out_dir}/x{factor}"
        replicate(spark, sf_dir, folder, factor)
        times = {}
        start = time.perf_counter()
        wh = Warehouse(spark, bank_sources(spark, folder), Workspace(spark, f"x{factor}"))
        wh.build()
        times["build"] = round(time.perf_counter() - start, 2)
        start = time.perf_counter()
        guards.assert_checks(wh)
        times["checks"] = round(time.perf_counter() - start, 2)
        start = time.perf_counter()
        reports.customer_360(wh).write.format("noop").mode("overwrite").save()
        times["customer_360"] = round(time.perf_counter() - start, 2)
        events = sum(wh.src[t].count() for t in ("payment_transaction", "activity", "service_case"))
        print(json.dumps({"factor": factor, "source_events": events, **times}), flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], [int(f) for f in sys.argv[3:]])
