import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerweave.llm import queries, token_files
from ledgerweave.llm.common import Scratch
from llm_cases import ODD_TEXTS, docs_of, shipped  # noqa: F401

PATH = queries.word_bpe_path()


def test_elias_fano():
    rng = random.Random(4)
    for size, top in [(0, 0), (1, 0), (1, 10**12), (5, 3), (3000, 10**9), (2000, 10), (600, 600)]:
        values = np.array(sorted(rng.randrange(top + 1) for _ in range(size)), np.int64)
        coded, used = token_files.EliasFano.from_bytes(token_files.EliasFano.encode(values).to_bytes() + b"more")
        assert [v for block in coded.blocks() for v in block.tolist()] == values.tolist()
        assert len(coded.samples) == -(-size // token_files.SAMPLE)
        assert [coded.select(i) for i in range(size)] == values.tolist()
        if size > 500:
            assert used * 8 < size * (2.5 + max(0, np.log2(max(1, top / size)))) + 500  # near-minimal space


ODD = [
    "", "  a  b ", "Don't it's I'LL 'S", "x<|endoftext|>y <|STARTOFTEXT|> <|startoftext|>", "ΑΣ ΣΑΣ. İstanbul", "é é É",
    "a\xa0b　c", "ß ﬁ 12a a12 ½ _a_ a_ ...,", "日本語。日本", "a\x1cb\x85c", "😀a 😀! é! É!!", "naïve%%% Àé.###",
    "it's.", "a'", "x" * 500, "a.b,c. d ,e .f", "e.g., (no) \"yes\".", "3.14, 2.7", "end.\nNext, line.",
]


@pytest.mark.parametrize("text", ODD)
def test_words_side_by_side_equal_the_whole_text(text):
    whole = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    encoder = token_files.WordEncoder(PATH)
    assert encoder.encode([text], 1)[0].tolist() == whole + [1]
    assert encoder.encode([text, text], 1)[1].tolist() == whole + [1]


def test_files_read_back(spark, docs_of):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(50).collect()]
    rows = [(1000 - 7 * i, t) for i, t in enumerate(texts + ODD_TEXTS)] + [(None, "null id"), (1000, "again")]
    docs = docs_of(rows).withColumnRenamed("lang", "shard").withColumnRenamed("source", "start")
    whole = Tokenizer.from_file(PATH)
    want, start = [], 0
    hashes = {r["text"]: r["h"] for r in docs.selectExpr("text", "xxhash64(text) AS h").collect()}
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]])):
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    for sizes in ({}, {"range_bytes": 20_000}, {"shard_bytes": 1}):
        scratch = Scratch(spark, "files")
        manifest = token_files.write(docs, scratch, PATH, **sizes)
        got = sorted(map(tuple, token_files.read(scratch, manifest).collect()), key=lambda r: r[1])
        assert got == want
        total = manifest.agg({"tokens": "sum", "documents": "sum"}).first()
        assert tuple(total) in ((start, len(rows)), (len(rows), start))


def test_files_are_cut_by_bytes_and_ranges_are_not_counted_in_the_plan(spark):
    """Thousands of ranges and files: nothing in the plan or on the driver is one per range."""
    docs = spark.range(6000).selectExpr("id AS doc_id", "concat('word', id % 7, repeat(' and more', 3)) AS text")
    scratch = Scratch(spark, "files")
    manifest = token_files.write(docs, scratch, PATH, shard_bytes=40, range_bytes=100)
    assert manifest.count() >= 1000 and manifest.select("part").distinct().count() >= 1000
    assert len(manifest._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    found = token_files.read(scratch, manifest)
    assert found.selectExpr("count(*) = 6000 AND sum(n_tokens) > 0 AS ok").first()["ok"]
    starts = [tuple(r) for r in found.orderBy("doc_id").select("start", "n_tokens").collect()]
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_rows_without_id_spread_over_files(spark):
    docs = spark.range(2000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "concat('text ', id) AS text")
    scratch = Scratch(spark, "files")
    manifest = token_files.write(docs, scratch, PATH, range_bytes=1000)
    rows = [r["documents"] for r in manifest.collect()]
    assert sum(rows) == 2000 and max(rows) < 500 and token_files.read(scratch, manifest).count() == 2000


def test_empty_table_and_random_access(spark, docs_of):
    scratch = Scratch(spark, "files")
    manifest = token_files.write(docs_of([]), scratch, PATH)
    assert token_files.read(scratch, manifest).count() == 0
    tokens = [np.arange(n, dtype=np.uint32) for n in (3, 0, 5)]
    shard = token_files.Shard(token_files.pack_shard([4, None, 9], tokens, 2))
    assert [shard.document(i).tolist() for i in range(3)] == [[0, 1, 2], [], [0, 1, 2, 3, 4]]
    assert [shard.doc_id(i) for i in range(3)] == [4, None, 9]
    with pytest.raises(ValueError, match="not a token file"):
        token_files.Shard(b"x" * 100)


def test_control_characters_beside_marks():
    whole, encoder = Tokenizer.from_file(PATH), token_files.WordEncoder(PATH)
    controls = [chr(c) for c in (*range(32), *range(127, 161), 0x1680, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF)]
    texts = [f for c in controls for m in ".,!" for f in (f"a{m}{c}b", f"a{c}{m}b", f"a {c}{m}", f"{m}{c} b", f"a{m}{c}{m}b")]
    for text, found in zip(texts, encoder.encode(texts, 1)):
        assert found.tolist() == whole.encode(text, add_special_tokens=False).ids + [1], repr(text)
