import hashlib
import math
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerweave.llm import lexicon_print as lp
from llm_cases import ODD_TEXTS, docs_of, shipped  # noqa: F401

SF_DIR = "/root/testdata/sf0.001"


def h(*values, seed=42):
    """Spark's xxhash64 of strings and longs, each seeded with the hash before it."""
    for v in values:
        data = v.encode() if isinstance(v, str) else (v & (2**64 - 1)).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def terms_of(text):
    return set(re.findall(r"[^\W_]+", (text or "").lower()))


def brute(text, band):
    terms = sorted(terms_of(text))
    kept = sorted(set(terms) & band, key=lambda t: t.encode())
    if kept:
        whole = h("band", *kept)
    elif terms:
        whole = h("terms", *sorted(terms, key=lambda t: t.encode()))
    else:
        whole = h("text", text or "")
    out, shift = [f"{whole % 2**32:08x}"], 0
    for bits, count in lp.SUBSETS:
        for i in range(count):
            own = [t for t in kept if (h(t, "subset") >> shift) % 2**bits == i]
            values = []
            for t in own:
                mark = h(t, "subset")
                values += [t, mark]
            out.append(f"{h(*values) % 2**16:04x}" if own else None)
        shift += bits
    return out


def alike(a, b):
    either = [(x, y) for x, y in zip(a, b) if x or y]
    return sum(x == y for x, y in either) / len(either)


def check(rows, docs):
    """Rows of compare_with_edits against the same by hand; ``docs`` in descending order."""
    df = {}
    for _, text in docs:
        for t in terms_of(text):
            df[t] = df.get(t, 0) + 1
    low, high = max(2.0, 0.001 * len(docs)), max(2.0, 0.1 * len(docs))
    band = {t for t, n in df.items() if low <= n <= high}
    want = []
    for n, (i, text) in enumerate(docs):
        text, following = text or "", docs[(n + 1) % len(docs)][1] or ""
        half = len(text) // 2
        edit = text[: len(text) - half] + following[:half]
        mine, edits, nexts = brute(text, band), brute(edit, band), brute(following, band)
        want.append((i, len(text), hashlib.sha256(edit.encode()).hexdigest(),
                     "".join(x or "...." for x in mine), "".join(x or "...." for x in edits),
                     round(alike(mine, edits), 12), round(alike(mine, nexts), 12)))
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"],
            round(r["near_edited"], 12), round(r["near_next"], 12)) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("n_chars < 3000")
    texts = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)
    rows = lp.compare_with_edits(docs).collect()
    check(rows, texts)
    longer = [r for r in rows if r["n_chars"] > 300]
    assert sum(r["near_edited"] > r["near_next"] for r in longer) > 0.8 * len(longer)


def test_next_row_over_many_ranges(spark, docs_of):
    ids = [i * 37 % 1009 for i in range(1, 300)]
    docs = docs_of([(i, f"text of {i}") for i in ids]).repartition(7)
    rows, _ = lp.with_next(docs, bucket_bytes=400)
    got = {r["id"]: r["next"] for r in rows.where("NOT ghost").collect()}
    down = sorted(ids, reverse=True)
    assert got == {i: f"text of {down[(n + 1) % len(down)]}" for n, i in enumerate(down)}
    assert rows.select("bucket").distinct().count() > 3


def test_odd_rows(spark, docs_of):
    texts = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    docs = docs_of(texts).withColumnRenamed("lang", "bucket").withColumnRenamed("source", "ghost")
    check(lp.compare_with_edits(docs).collect(), texts[::-1])
    check(lp.compare_with_edits(docs.where("doc_id = 4")).collect(), [(4, "é")])
    ties = [(2, "b"), (2, "b"), (2, "a"), (1, "c"), (None, "n")]
    check(lp.compare_with_edits(docs_of(ties)).collect(), [(2, "a"), (2, "b"), (2, "b"), (1, "c"), (None, "n")])
    assert lp.compare_with_edits(docs.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [lp.CONSTANT_TERMS, -1])
def test_both_ways_to_meet_the_lexicon(spark, limit):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").limit(60)
    band = lp.lexicon(docs)
    found = lp.fingerprints(docs, ["text"], constant_terms=limit, found=band).collect()
    names = {r["term"] for r in band.collect()}
    assert len(found) == 60
    for r in found:
        assert r["text_hashes"] == brute(r["text"], names)
    assert math.isclose(lp.lexicon(docs.withColumn("text", F.lit("same"))).count(), 0)


def test_compare_by_join_over_many_partitions(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("n_chars < 3000").select("doc_id", "text")
    docs = docs.repartition(7)
    texts = sorted(map(tuple, docs.collect()), reverse=True)
    check(lp.compare_with_edits(docs, constant_terms=0).collect(), texts)
