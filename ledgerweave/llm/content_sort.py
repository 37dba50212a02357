"""Exact duplicates by sorting contents.

Rows are dealt into ranges by sampled splitters and each range is sorted externally, so equal
texts become neighbours; neighbours are compared in full. Splitters are the first ``HEAD`` bytes
of the normalised text, its digest and the identifier: the sample that reaches the driver is
bounded whatever the length of the texts, texts with a long common beginning still spread, and a
text that a third of all rows share is cut by identifier and spans many ranges. Equal texts at
the two ends of every range are compared again across ranges; there are two of them per range.

The row that stays is the first of its run: identifiers are sorted ascending (``keep="smallest"``)
or descending (``keep="largest"``), nulls last either way.

Defined results for unusual input: a null text counts as empty; a null identifier stays only
where no row of the group has one; of rows that share text and identifier exactly one stays; an
empty table has no rows; other columns of the input are ignored, whatever their names. A text may
be as long as a row may be: two rows of text are compared at a time.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, IntegerType, LongType, StructField, StructType

from ledgerweave.llm.common import Scratch, input_bytes

HEAD = 64
RANGE_BYTES = 64 << 20


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row with its run's first identifier, size and its place in the run.

    A run is written once it has ended. Runs that touch an end of the range are marked 0 (the
    first one) or 1 (the last one), and the first row of such a run carries the text.
    """
    part = TaskContext.get().partitionId()
    held: list[pa.RecordBatch] = []  # identifiers and digests of the run that goes on
    size, ended = 0, 0  # its rows; runs before it
    text: pa.Scalar | None = None

    def finished(rows: pa.Table, starts: np.ndarray, end: int | None, body: pa.Scalar | None) -> Iterator[pa.RecordBatch]:
        """Whole runs that begin at ``starts``; ``end`` marks them as the end of a range."""
        counts = np.diff(np.append(starts, rows.num_rows))
        first = np.repeat(starts, counts)
        bodies = pa.nulls(rows.num_rows, pa.binary())
        if end is not None and rows.num_rows:
            bodies = pa.concat_arrays([pa.array([body.as_py()], pa.binary()), bodies[1:]])
        ids = rows.column("id").combine_chunks()
        out = pa.table({
            "id": ids,
            "digest": rows.column("digest").combine_chunks(),
            "first": ids.take(pa.array(first)),
            "size": pa.array(np.repeat(counts, counts), pa.int64()),
            "opens": pa.array(np.arange(rows.num_rows) == first),
            "part": pa.array(np.full(rows.num_rows, part), pa.int32()),
            "border": pa.nulls(rows.num_rows, pa.int32()) if end is None
            else pa.array(np.full(rows.num_rows, end), pa.int32()),
            "body": bodies,
        })
        yield from out.to_batches(max_chunksize=20_000)

    for batch in batches:
        if not batch.num_rows:
            continue
        bodies, narrow = batch.column("body"), batch.select(["id", "digest"])
        same = pc.equal(bodies[1:], bodies[:-1]).to_numpy(zero_copy_only=False)
        new = np.flatnonzero(np.concatenate(([text is None or bodies[0].as_py() != text.as_py()], ~same)))
        # Rows before the first new run belong to the one that is open.
        lead = int(new[0]) if len(new) else batch.num_rows
        if lead:
            held.append(narrow.slice(0, lead))
            size += lead
        if not len(new):
            continue
        if size:
            yield from finished(pa.Table.from_batches(held), np.array([0]), 0 if not ended else None, text)
            ended += 1
        last = int(new[-1])
        between = new[:-1]
        if len(between) and not ended:  # the range begins in this batch with a run that ends in it
            stop = int(new[1])
            yield from finished(pa.Table.from_batches([narrow.slice(int(new[0]), stop - int(new[0]))]), np.array([0]), 0, bodies[int(new[0])])
            ended, between = 1, new[1:-1]
        if len(between):
            rows = pa.Table.from_batches([narrow.slice(int(between[0]), last - int(between[0]))])
            yield from finished(rows, between - int(between[0]), None, None)
            ended += len(between)
        held, size, text = [narrow.slice(last)], batch.num_rows - last, bodies[last]
    if size:
        yield from finished(pa.Table.from_batches(held), np.array([0]), 1, text)


def exact_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    keep: str = "smallest",
) -> DataFrame:
    """One row per row of ``docs``: ``key``, keep_id, group_size, kept, text_sha256.

    ``normalise`` maps the text column to what is compared and digested.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is smallest or largest, not {keep}")
    spark = docs.sparkSession
    scratch = Scratch(spark, "content-sort")
    body = F.coalesce((normalise or (lambda c: c))(F.col(text).cast("string")), F.lit(""))
    order = F.col("id").asc_nulls_last() if keep == "smallest" else F.col("id").desc_nulls_last()
    ranges = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(input_bytes(docs, text) / RANGE_BYTES)
    )
    lines = docs.select(F.col(key).alias("id"), body.cast("binary").alias("body"), F.unhex(F.sha2(body, 256)).alias("digest"))
    lines = lines.withColumn("head", F.substring("body", 1, HEAD))
    lines = lines.repartitionByRange(ranges, "head", "digest", order)
    lines = lines.sortWithinPartitions("head", "digest", "body", order)
    kind = docs.schema[key].dataType
    placed = scratch.write("placed", lines.select("id", "digest", "body").mapInArrow(_runs, StructType([
        StructField("id", kind), StructField("digest", BinaryType()), StructField("first", kind),
        StructField("size", LongType()), StructField("opens", BooleanType()),
        StructField("part", IntegerType()), StructField("border", IntegerType()),
        StructField("body", BinaryType()),
    ])))
    # At most two runs per range touch its ends; equal ones are one group over several ranges.
    ends = placed.where("border IS NOT NULL AND opens")
    place = F.struct("part", "border")
    groups = ends.groupBy("digest", "body").agg(
        F.sum("size").alias("total"), F.min(place).alias("at"), F.min_by("first", place).alias("keep")
    ).drop("body")
    ends = scratch.write("ends", ends.select("part", "border", "digest").join(groups, "digest").select(
        "part", "border", "total", "keep", (F.col("at") == place).alias("leads")
    ))
    inner = placed.where("border IS NULL").select("id", "digest", "first", "size", F.col("opens").alias("kept"))
    outer = placed.where("border IS NOT NULL").join(ends, ["part", "border"]).select(
        "id", "digest", F.col("keep").alias("first"), F.col("total").alias("size"),
        F.expr("opens AND leads").alias("kept"),
    )
    return inner.unionByName(outer).select(
        F.col("id").alias(key), F.col("first").alias("keep_id"), F.col("size").alias("group_size"),
        "kept", F.lower(F.hex("digest")).alias("text_sha256"),
    )
