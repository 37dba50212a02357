"""Corpus preparation: the stages in order, each over all that its predecessor kept.

Every stage reads whole texts and keeps the columns of ``documents``; the last one adds the
encoded text. Null texts have no letters and leave at the first stage. An empty table stays
empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerweave.llm import language_id, lsh_forest, piece_viterbi, string_tiling
from ledgerweave.llm.common import Scratch, ship, small_batches
from ledgerweave.llm.queries import piece_model

# The first and last stages hold a learned model and a tokenizer, which SQL cannot express;
# tests/llm/test_pipeline.py compares every stage with a brute-force version.
ORACLE_SQL = None

# A text is rejected if it has no letters or if no language holds half of the posterior.
LEAST_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach."""
    ship(spark)
    small_batches(spark)
    model = language_id.fit(docs)
    return language_id.keep_known(docs, model, LEAST_SCORE)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: five-word shingles, similarity 0.8.

    Documents without words are in no class and stay; so do rows with a null id. Rows that
    share an id are one document, of which the first row in the order of its columns stays.
    """
    ship(spark)
    small_batches(spark)
    found = lsh_forest.near_duplicates(docs, width=5, percent=80)
    gone = found.where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    left = docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    # An id that comes more than once is one document; its rows are few and narrowed first.
    again = left.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL")
    again = again.select(F.col("doc_id").alias("_again"))
    if again.isEmpty():
        return left
    single = left.join(again, left["doc_id"] == again["_again"], "left_anti")
    repeated = left.join(again, left["doc_id"] == again["_again"], "left_semi")
    order = Window.partitionBy("doc_id").orderBy(*(c for c in docs.columns if c != "doc_id"))
    first = repeated.withColumn("_place", F.row_number().over(order)).where("_place = 1")
    return single.unionByName(first.drop("_place"))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship(spark)
    small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return string_tiling.clean(docs, benchmark)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their piece ids; ``decoded`` is the text read back from them."""
    ship(spark)
    small_batches(spark)
    return piece_viterbi.with_pieces(docs, piece_model)


STAGES = [
    ("language identification", known_language),
    ("near duplicates", distinct_texts),
    ("benchmark decontamination", uncontaminated),
    ("sentencepiece", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.write(f"stage-{number}", stage(spark, docs, sf_dir))
    scratch.drop(*(f"stage-{n}" for n in range(len(STAGES) - 1)))
    return docs
