"""Each stage against a brute-force version of its decision."""

import corpus_pipeline
import pyarrow as pa
import pytest

from ledgerweave.llm import common, queries, string_tiling
from llm_cases import docs_of, shipped  # noqa: F401
from test_lsh_forest import brute

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def ids(frame):
    return sorted(r["doc_id"] for r in frame.select("doc_id").collect())


def test_stages_in_order(spark, docs):
    known, distinct, clean, encoded = (stage for _, stage in corpus_pipeline.STAGES)
    first = known(spark, docs, SF_DIR)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    letters = {i for i, t in texts.items() if any(c.isalpha() for c in t or "")}
    kept = ids(first)
    assert first.columns == COLUMNS and set(kept) <= letters and len(kept) >= 0.99 * len(letters)
    second = distinct(spark, first, SF_DIR)
    want = brute([(i, texts[i]) for i in kept], 5, 80)
    assert second.columns == COLUMNS and ids(second) == sorted(i for i, v in want.items() if v[2])
    third = clean(spark, second, SF_DIR)
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    hashes = string_tiling.WordHashes()
    leaks = set()
    for i in ids(second):
        text = hashes.of(texts[i])
        for item in map(hashes.of, items):
            if sum(r[0] for r in string_tiling.tiles(item, text, 5)) >= 0.5 * len(item):
                leaks.add(i)
    assert third.columns == COLUMNS and ids(third) == [i for i in ids(second) if i not in leaks] and leaks
    last = encoded(spark, third, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in last) == ids(third)
    assert all(r["decoded"] == r["text"] and len(r["piece_ids"]) == r["n_pieces"] > 0 for r in last)
    assert ids(corpus_pipeline.run(spark, SF_DIR)) == ids(third)


def test_odd_tables(spark, docs_of):
    rows = [(1, "the cat sat on the mat today", "en"), (1, "the cat sat on the mat today", "en"), (2, None, "en"),
            (3, "", "en"), (4, "123 !!", "en"), (5, "the dog ran far away again", "en"), (None, "the end is near", "en"),
            (6, "the cat sat on the mat today", None)]
    found = docs_of(rows)
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, found, SF_DIR)
    assert sorted((r["doc_id"] or 0 for r in found.collect())) == [0, 1, 5]
    empty = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF_DIR)
    assert empty.count() == 0 and queries.piece_model()


def test_arrow_batches_of_every_stage_are_bounded_by_bytes(spark, docs_of):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]})

    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.unset(common.ARROW_BYTES)
            stage(spark, docs_of([(1, "the cat sat")]), SF_DIR)
            long = spark.range(0, 3000, 1, 1).selectExpr("repeat('word ', 1000) AS text")
            found = [r["bytes"] for r in long.mapInArrow(sizes, "bytes bigint").collect()]
            assert sum(found) > 14e6 and max(found) < 5e6
        spark.conf.set(common.ARROW_BYTES, "1m")
        corpus_pipeline.known_language(spark, docs_of([(1, "the cat sat")]), SF_DIR)
        assert spark.conf.get(common.ARROW_BYTES) == "1m"
    finally:
        spark.conf.unset(common.ARROW_BYTES)
