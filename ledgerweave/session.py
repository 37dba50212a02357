"""Session construction and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import tempfile
from functools import cache

from pyspark.sql import SparkSession


def local_session(app_name: str = "ledgerweave", cores: int | str = 8) -> SparkSession:
    """Session for tests and the bench. A cluster brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LEDGERWEAVE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own; on a cluster the
    setting is required, because a machine-local path dies with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder(context.applicationId)


@cache
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"ledgerweave-{application_id}-")
