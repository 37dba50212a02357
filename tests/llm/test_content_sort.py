"""Exact duplicates against a dictionary of texts."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from compare import differences, duck
from conftest import SF_DIR
from ledgerweave.llm import content_sort, queries
from llm_cases import ODD_TEXTS, docs_of, shipped  # noqa: F401


def brute(rows, keep, normalise=lambda t: t):
    groups = {}
    for i, text in rows:
        groups.setdefault(normalise(text or ""), []).append(i)
    found = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (min if keep == "smallest" else max)(known) if known else None
        stays = sorted(ids, key=lambda i: (i is None, i != best))
        for place, i in enumerate(stays):
            found.append((i, best, len(ids), place == 0, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(found, key=str)


def run(frame, **more):
    return sorted((tuple(r) for r in content_sort.exact_duplicates(frame, **more).collect()), key=str)


def test_query_equals_sql(spark):
    found = queries.op12_exact_dedup(spark, SF_DIR)
    assert differences(found, duck(SF_DIR), queries.OP12_SQL) is None


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("rows", ["random", "odd", "one text", "long heads"])
def test_brute_force(docs_of, keep, rows):
    rng = random.Random(7)
    cases = {
        "random": [(i, rng.choice("abcdef") * rng.randrange(3)) for i in rng.sample(range(999), 300)],
        # repeated rows, repeated ids, null ids beside known ones and alone
        "odd": [(i % 7, t) for i, t in enumerate(ODD_TEXTS * 3)] + [(None, t) for t in ("", "x", "x", "a")],
        # one text fills every range
        "one text": [(i, "the same") for i in range(400)] + [(1000, "other")],
        # all splitters share their first bytes
        "long heads": [(i, "license " * 100 + str(i % 90)) for i in range(300)],
    }[rows]
    assert run(docs_of(cases), keep=keep) == brute(cases, keep)


def test_normalised_texts_and_small_batches(spark, docs_of):
    rows = [(i, "Ab"[i % 2] * (i % 5) + " ") for i in range(200)]
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "3")  # runs end inside, at and across batches
    try:
        found = run(docs_of(rows), normalise=lambda c: F.trim(F.lower(c)))
    finally:
        spark.conf.set(size, before)
    assert found == brute(rows, "smallest", lambda t: t.lower().strip())


def test_empty_table_clashing_columns_and_other_keys(spark, docs_of):
    assert run(docs_of([])) == []
    names = ("id", "body", "digest", "head", "first", "size", "part", "border", "kept", "keep_id")
    odd = docs_of([(1, "a"), (2, "a")]).select("doc_id", "text", *(F.lit(0).alias(n) for n in names))
    assert run(odd) == brute([(1, "a"), (2, "a")], "smallest")
    named = spark.createDataFrame([("b", "t"), ("a", "t")], "name string, content string")
    assert [r[:3] for r in run(named, key="name", text="content")] == [("a", "a", 2), ("b", "a", 2)]
    with pytest.raises(ValueError):
        content_sort.exact_duplicates(named, "name", "content", keep="any")


def test_a_hot_text_spans_ranges_and_no_range_takes_it_whole(spark, docs_of, monkeypatch):
    monkeypatch.setattr(content_sort, "RANGE_BYTES", 4096)
    rows = [(i, "hot " * 20) for i in range(3000)] + [(9000 + i, f"text {i}") for i in range(3000)]
    frame = docs_of(rows)
    assert run(frame, keep="largest") == brute(rows, "largest")
