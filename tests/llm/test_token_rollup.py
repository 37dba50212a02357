import base64
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from ledgerweave.llm import queries, token_rollup
from ledgerweave.llm.common import Scratch
from llm_cases import docs_of, shipped  # noqa: F401

SF_DIR = "/root/testdata/sf0.001"


def rollup(spark):
    return token_rollup.Rollup(spark, Scratch(spark, "rollup").path("r"))


def changes(spark, rows):
    return spark.createDataFrame(rows, token_rollup.CHANGES)


def totals(r):
    return {(x["source"], x["lang"], x["tokenizer"]): (x["documents"], x["tokens"]) for x in r.totals().collect()}


def test_signed_batches_once_each(spark):
    r = rollup(spark)
    assert totals(r) == {}
    first = [("insert", "a", "en", "v1", 10, None), ("insert", "a", "en", "v1", 5, None),
             ("insert", None, None, "v1", None, None)]
    assert r.commit("1", changes(spark, first)) and not r.commit("1", changes(spark, first))
    assert totals(r) == {("a", "en", "v1"): (2, 15), (None, None, "v1"): (1, 0)}
    second = [("revise", "a", "en", "v1", 7, 10), ("delete", "a", "en", "v1", 5, None), ("delete", None, None, "v1", None, None)]
    assert r.commit("2", changes(spark, second)) and r.commit("empty", changes(spark, []))
    assert totals(r) == {("a", "en", "v1"): (1, 7)}
    r.compact()
    assert totals(r) == {("a", "en", "v1"): (1, 7)}
    assert not r.commit("2", changes(spark, second)) and r.commit("3", changes(spark, first))
    r.compact()
    assert totals(r) == {("a", "en", "v1"): (3, 22), (None, None, "v1"): (1, 0)}
    with pytest.raises(Exception, match="unknown change"):
        r.commit("4", changes(spark, [("upsert", "a", "en", "v1", 1, None)]))
    assert totals(r)[("a", "en", "v1")] == (3, 22)


def test_query_equals_a_plain_count(spark):
    found = {(r["source"], r["lang"], r["tokenizer"]): (r["documents"], r["tokens"])
             for r in queries.op4_token_rollup(spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    want, seen = {}, set()
    for name, ranks in queries.TOKENIZERS.items():
        path, pattern = ranks()
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        encode = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary
        seen.clear()
        for d in docs:
            if d["text"] not in seen:
                seen.add(d["text"])
                n, t = want.get((d["source"], d["lang"], name), (0, 0))
                want[d["source"], d["lang"], name] = (n + 1, t + len(encode(d["text"] or "")))
    assert found == want


def test_counts_of_odd_texts(spark, docs_of):
    docs = docs_of([(None, None), (1, ""), (1, "hello"), (1, "hello")]).withColumn("tokenizer", F.lit("clash"))
    got = token_rollup.count_tokens(docs, {"v": queries.byte_bpe_ranks}).collect()
    assert sorted(r["counts"][0]["tokens"] for r in got) == [0, 0, 1, 1]
    assert public_tokenizers and Counter(r["id"] for r in got) == {None: 1, 1: 3}


def test_query_with_null_and_repeated_ids(spark, docs_of, tmp_path):
    texts = ["hello there, world " * 5, "another text of some words", "x" * 40]
    rows = [(None, texts[0]), (None, texts[0], "de"), (3, texts[0], "fr"), (None, texts[1]), (7, texts[2]),
            (7, texts[2]), (7, None), (None, None, "de")]
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = {(r["lang"], r["tokenizer"]): (r["documents"], r["tokens"])
             for r in queries.op4_token_rollup(spark, str(tmp_path)).collect()}
    want = {}
    for name, ranks in queries.TOKENIZERS.items():
        encode = token_rollup._encoding(*ranks()).encode_ordinary
        one, two, three = (len(encode(t)) for t in texts)
        want |= {("fr", name): (1, one), ("en", name): (3, two + three)}
    assert found == want


def test_a_writer_lost_half_way_leaves_nothing_that_counts(spark, monkeypatch):
    r = rollup(spark)
    rows = [("insert", "a", "en", "v1", 10, None)]

    def lost(*_):
        raise OSError("gone before the marker")

    monkeypatch.setattr(token_rollup.Rollup, "_mark", lost)
    with pytest.raises(OSError):
        r.commit("1", changes(spark, rows))
    with pytest.raises(OSError):
        r.compact()
    monkeypatch.undo()
    assert totals(r) == {} and r.commit("1", changes(spark, rows)) and not r.commit("1", changes(spark, rows))
    assert totals(r) == {("a", "en", "v1"): (1, 10)}


def test_compaction_that_was_cut_off_counts_no_batch_twice(spark, monkeypatch):
    r = rollup(spark)
    for name in ("1", "a,b/c%"):
        assert r.commit(name, changes(spark, [("insert", "a", "en", "v1", 10, None)]))
    monkeypatch.setattr(token_rollup.Rollup, "_remove", lambda *_: None)
    r.compact()  # the base is there, and so are the batches it holds
    monkeypatch.undo()
    assert totals(r) == {("a", "en", "v1"): (2, 20)} and not r.commit("a,b/c%", changes(spark, []))
    r.compact()
    assert totals(r) == {("a", "en", "v1"): (2, 20)} and not r._markers("batches") and len(r._markers("bases")) == 1
    assert not r.commit("1", changes(spark, []))
