"""How far sources of a language stand apart in their terms, by count cells.

Terms are runs of letters A-Z (in lower case) and of anything beyond ASCII. A language keeps the
terms that at least ``least`` of its documents have. A group is a (language, source); it and its
language give every kept term the share ``p = 1 + floor(SCALE * (count + 5) / (N + 5 * V))``, with
N the sum of its counts of kept terms and V the number of kept terms.

* ``term`` rows: the kept terms whose share is larger in the group than in its language, by the
  difference. All terms with the same (group count, language count) have the same difference, so
  differences are worked out per cell and not per term; equal values are merged, ranked by
  cumulative multiplicity, and only the cells that reach the wanted ranks are expanded to terms,
  in UTF-8 order.
* ``pair`` rows: every other source of the language by the sum of differences over all kept terms.
  Terms that only one of the two has count by cells of that one, terms that neither has by their
  number, so only terms that both have are met one by one.

Texts are counted where they are read, and what leaves a task is one row per (group, term); no
task holds a group. Per (language, term) the sources that have the term come together, at most
one entry per source. Arithmetic is exact: shares are worked out in decimals of 38 digits.

Defined results for unusual input: null text, language and source are empty strings; a group
without terms has pair rows and no term rows; a language without kept terms has pair rows of
value 0; repeated rows are documents of their own; an empty table has no rows; other columns of
the input are ignored, whatever their names. Texts are counted whole; a task flushes its counts
when they pass ``FLUSH`` entries, so its memory is bounded by that and one document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerweave.llm.common import Scratch

SCALE = 1_000_000_000
FLUSH = 300_000
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
COUNTS = "lang string, source string, term string, n bigint, docs bigint"
_COUNTS = pa.schema([
    ("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64()),
])


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8; every byte of a letter beyond ASCII is above 0x7F."""
    return text.translate(_TERM_BYTES).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            for start in range(0, len(terms), 50_000):
                part = terms[start:start + 50_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                    pa.array(part, pa.binary()).cast(pa.string()), pa.array([n[t] for t in part], pa.int64()),
                    pa.array([docs[t] for t in part], pa.int64()),
                ], schema=_COUNTS)
        held.clear()

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("lang", "source")]
        for row, (lang, source, text) in enumerate(zip(*columns, batch.column("text"))):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            terms = terms_of(text.as_py())
            n.update(terms)
            docs.update(set(terms))
            if row % 64 == 63 and sum(len(x) for x, _ in held.values()) > FLUSH:
                yield from flush()
        if sum(len(x) for x, _ in held.values()) > FLUSH:
            yield from flush()
    yield from flush()


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 5) / (total + 5 * kept)), exact; null where nothing is kept."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 5).cast("decimal(20,0)")
    below = (total + 5 * kept).cast("decimal(20,0)")
    return F.when(kept > 0, F.lit(1) + F.call_function("div", above, below))


def divergence(docs: DataFrame, least: int = 30, ranks: int = 50) -> DataFrame:
    """Columns lang, source, part, item, value, rank; see above."""
    scratch = Scratch(docs.sparkSession, "count-cells")
    known = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")),
                        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    counts = known.mapInArrow(_count, COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )
    kept = scratch.write("kept", counts.groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("docs").alias("docs"),
        F.collect_list(F.struct("source", "n")).alias("sources"),
    ).where(F.col("docs") >= least).drop("docs"))
    flat = kept.select("lang", "term", "total", F.inline("sources").alias("source", "n"))

    # One row per group: its counted terms, and those of its language.
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    own = flat.groupBy("lang", "source").agg(F.sum("n").alias("own_n"), F.count("*").alias("own_terms"))
    groups = (
        known.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left")
        .na.fill(0, ["own_n", "own_terms", "v", "lang_n"])
    )
    groups = scratch.write("groups", groups.withColumn(
        "zero", F.coalesce(share(F.lit(0).cast("bigint"), F.col("own_n"), F.col("v")), F.lit(0).cast("bigint"))
    ))
    cells = scratch.write("cells", flat.groupBy("lang", "source", "n", "total").count().join(groups, ["lang", "source"]).select(
        "lang", "source", "n", "total", "count", share(F.col("n"), F.col("own_n"), F.col("v")).alias("p"),
        share(F.col("total"), F.col("lang_n"), F.col("v")).alias("q"),
    ))
    return _terms(flat, cells, ranks).unionByName(_pairs(flat, cells, groups))


def _terms(flat: DataFrame, cells: DataFrame, ranks: int) -> DataFrame:
    above = cells.where("p > q").withColumn("value", F.col("p") - F.col("q"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    merged = above.groupBy("lang", "source", "value").agg(F.sum("count").alias("count"))
    # A value has one term at least, so no value behind the first ``ranks`` ones can be reached.
    merged = merged.withColumn("place", F.row_number().over(by_value)).where(F.col("place") <= ranks)
    earlier = F.sum("count").over(by_value.rowsBetween(Window.unboundedPreceding, -1))
    merged = merged.withColumn("earlier", F.coalesce(earlier, F.lit(0))).where(F.col("earlier") < ranks)
    reached = above.join(merged.select("lang", "source", "value"), ["lang", "source", "value"]).select(
        "lang", "source", "n", "total", "value"
    )
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    return flat.join(reached, ["lang", "source", "n", "total"]).withColumn("rank", rank).where(F.col("rank") <= ranks).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"
    )


def _pairs(flat: DataFrame, cells: DataFrame, groups: DataFrame) -> DataFrame:
    """Sums over all kept terms: as if neither had any term, then what the terms of each one
    change, then what the terms of both change once more."""
    a = groups.select("lang", F.col("source").alias("a"), F.col("zero").alias("a0"), F.col("own_terms").alias("a_terms"), "v")
    b = groups.select("lang", F.col("source").alias("b"), F.col("zero").alias("b0"), F.col("own_terms").alias("b_terms"))
    neither = a.join(b, "lang").where("a <> b").select(
        "lang", "a", "b", F.expr("(v - a_terms - b_terms) * abs(a0 - b0)").alias("value")
    )
    merged = cells.groupBy("lang", F.col("source").alias("a"), "p").agg(F.sum("count").alias("count"))
    alone = merged.join(b, "lang").where("a <> b").groupBy("lang", "a", "b").agg(
        F.sum(F.expr("count * abs(p - b0)")).alias("value")
    )
    # The shares return to their terms, and the sources of a term meet in pairs a < b.
    priced = flat.join(cells.select("lang", "source", "n", "total", "p"), ["lang", "source", "n", "total"]).join(
        groups.select("lang", "source", "zero"), ["lang", "source"]
    )
    together = priced.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "p", "zero"))).alias("all"))
    met = together.select("lang", "all", F.posexplode("all").alias("place", "x")).select(
        "lang", "x", F.explode(F.slice("all", F.col("place") + 2, F.size("all"))).alias("y")
    )
    both = met.groupBy("lang", F.col("x.source").alias("a"), F.col("y.source").alias("b")).agg(F.sum(F.expr(
        "abs(x.p - y.p) - abs(x.p - y.zero) - abs(x.zero - y.p) + abs(x.zero - y.zero)"
    )).alias("value"))
    turned = [x.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value") for x in (alone, both)]
    every = neither
    for x in (alone, both, *turned):
        every = every.unionByName(x)
    value = every.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "a").orderBy(F.desc("value"), "b"))
    return value.select(
        "lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value",
        rank.alias("rank"),
    )
