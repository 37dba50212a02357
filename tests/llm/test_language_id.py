import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerweave.llm import language_id, queries
from llm_cases import ODD_TEXTS, docs_of, shipped  # noqa: F401

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = queries.op10_language_id(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    row = found.join(docs, "doc_id").groupBy("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("share"), F.count("*").alias("n"),
        F.min("score").alias("low"), F.max("score").alias("high"),
    ).orderBy("held_out").collect()
    assert sum(r["n"] for r in row) == docs.count() and row[1]["held_out"]
    assert all(r["share"] > 0.99 and 0 <= r["low"] <= r["high"] <= 1 for r in row)


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, "the cat sat on the mat", "en") for i in range(5)] + [(9 + i, "le chat est sur la table", "fr") for i in range(5)]
    rows += [(30, None, "en"), (31, "kein Etikett", None), (None, "the mat", "en")]
    return language_id.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))


def test_words_first_then_shorter_grams(spark, docs_of, model):
    assert model.languages == ["en", "fr"]
    scorer = language_id._Scorer(model)
    assert (scorer.weight_of("cat") == model.weights[model.keys.index(("cat", 0))]).all()
    rows = [model.weights[model.keys.index((g, 4))] for g in ("<cat", "cats") if (g, 4) in model.keys]
    assert (scorer.weight_of("cats") == sum(rows) / len(rows)).all()  # no known 5-gram, one known 4-gram
    assert (scorer.weight_of("Ωж") == 0).all()
    for odd, want in [("the mats", "en"), ("CHATS sur tables", "fr"), ("Ωж", "en"), ("12 !!", "und"), (None, "und")]:
        assert scorer.predict(odd)[0] == want


def test_odd_rows(spark, docs_of, model):
    docs = docs_of([(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "le chat"), (3, "the")]).withColumnRenamed("source", "score")
    got = language_id.predict(docs, model).collect()
    assert len(got) == len(ODD_TEXTS) + 2 and all(0 <= r["score"] <= 1 for r in got)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (0, 1, 2)} == {"und"}
    assert [r["lang_pred"] for r in got if r["doc_id"] is None] == ["fr"]
    kept = language_id.keep_known(docs, model, 0.5)
    assert kept.columns == docs.columns and kept.where("doc_id in (0, 1, 2)").count() == 0
    empty = language_id.fit(docs.limit(0))
    assert {r["lang_pred"] for r in language_id.predict(docs, empty).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), model).count() == 0


def test_words_are_letters_with_their_marks(spark, docs_of, model):
    assert language_id.LETTERS.findall("½ ² Ⅷ ① हि a²b e\u0301t 12 x_y") == ["हि", "a", "b", "e\u0301t", "x", "y"]
    docs = docs_of([(1, "½ ²"), (2, "Ⅷ ①"), (3, "\u0301 \u0308"), (4, "the ²")])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.predict(docs, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] == "en"


def brute_scores(training, texts):
    """Posterior by plain counting: whole words, then the longest order with a known n-gram."""
    import math
    from collections import Counter

    counts = {}
    for text, lang in training:
        by = counts.setdefault(lang, {n: Counter() for n in range(6)})
        for word in language_id.LETTERS.findall(text.lower()):
            by[0][word] += 1
            for n in (5, 4, 3, 2, 1):
                by[n].update(language_id._grams(word, n))
    langs = sorted(counts)
    known = {n: set().union(*(counts[x][n] for x in langs)) for n in range(6)}

    def log_share(lang, n, key):
        c = counts[lang][n]
        return math.log((c[key] + 0.5) / (sum(c.values()) + 0.5 * (len(c) + 1)))

    found = []
    for text in texts:
        total = dict.fromkeys(langs, 0.0)
        for word in language_id.LETTERS.findall(text.lower()):
            if word in known[0]:
                keys, n = [word], 0
            else:
                n = next((n for n in (5, 4, 3, 2, 1) if any(g in known[n] for g in language_id._grams(word, n))), None)
                keys = [g for g in language_id._grams(word, n) if g in known[n]] if n else []
            for lang in langs if keys else ():
                total[lang] += sum(log_share(lang, n, k) for k in keys) / len(keys)
        best = max(langs, key=lambda x: (total[x], -langs.index(x)))
        found.append((best, 1 / sum(math.exp(total[x] - total[best]) for x in langs)))
    return found


def test_scores_equal_plain_counting(spark, docs_of):
    training = [("the cat sat on the mat hearing", "en"), ("le chat est sur la table haute", "fr"),
                ("die katze sitzt auf der matte", "de"), ("the mat was there", "en"), ("la table est là", "fr")]
    texts = ["the cat", "katzen und matten", "hauteur", "chatte sur tables", "qqq", "the la die", "sitting there on tables"]
    model = language_id.fit(docs_of([(i, t, x) for i, (t, x) in enumerate(training)]))
    got = language_id.predict(docs_of(list(enumerate(texts))), model).orderBy("doc_id").collect()
    for row, (lang, score) in zip(got, brute_scores(training, texts)):
        assert row["lang_pred"] == lang and abs(row["score"] - score) < 1e-4, (texts[row["doc_id"]], row, lang, score)


def test_every_counted_key_is_kept_unless_bounded(spark, docs_of):
    rows = [(i, " ".join(f"w{chr(97 + i % 26)}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)), "en") for i in range(40)]
    whole = language_id.fit(docs_of(rows))
    words = {w for _, text, _ in rows for w in language_id.LETTERS.findall(text)}
    assert {k for k, order in whole.keys if order == 0} == words
    small = language_id.fit(docs_of(rows), top_words=50, top_grams={5: 7, 1: 2})
    sizes = {n: sum(order == n for _, order in small.keys) for n in range(6)}
    assert sizes[0] == 50 and sizes[5] == 7 and sizes[1] == 2
    assert sizes[3] == sum(order == 3 for _, order in whole.keys)


def test_rows_without_id_are_drawn_by_their_text(spark, docs_of):
    rows = [(None, f"wort{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}", "de") for i in range(2000)]
    model = language_id.fit(docs_of(rows), sample_docs=500)
    drawn = sum(order == 0 for _, order in model.keys)
    assert 350 < drawn < 650


def test_a_task_holds_no_second_model_and_no_batch_of_plain_texts(spark, docs_of):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(3000)})
    model = language_id.fit(docs_of([(i, " ".join(words[i::40]), "en") for i in range(40)]))
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(rng.choices(words, k=400)) for _ in range(2000)]})
    shape = (None, "", "!! 12", "zzz " + words[0])
    want = [language_id._Scorer(model).predict(t) for t in shape]
    tracemalloc.start()
    scorer = language_id._Scorer(model)
    assert tracemalloc.get_traced_memory()[1] < 2 * len(model.marked)
    parts = list(language_id._parts(batch, "text"))
    found = [p for part in parts for p in scorer.predict_all(part.column("text").to_pylist())]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 2000 and peak < 2 * batch.nbytes and max(p.num_rows for p in parts) <= language_id.ROWS
    assert scorer.predict_all(list(shape)) == want and want[0] == want[1] == want[2] == ("und", 0.0)
    long = pa.RecordBatch.from_pydict({"text": ["a" * (language_id.TEXT_BYTES + 1), None, "b", "c" * language_id.TEXT_BYTES]})
    assert [p.num_rows for p in language_id._parts(long, "text")] == [1, 2, 1]


def test_equal_hashes_are_told_apart(monkeypatch):
    whole = language_id._hashes
    monkeypatch.setattr(language_id, "_hashes", lambda keys, seed: whole(keys, seed) % np.uint64(5 if seed == 0 else 1 << 20))
    keys = [f"0{c}{d}" for c in "abcdef" for d in "abcdef"]
    model = language_id._model(["en"], pa.array(keys), np.arange(36, dtype=np.float32).reshape(36, 1))
    scorer = language_id._Scorer(model)
    assert model.seed > 0 and [scorer.weight_of(k[1:])[0] for k in keys] == list(range(36))
    monkeypatch.setattr(language_id, "_hashes", lambda keys, seed: np.full(len(keys), model.hashes[7]))
    assert (scorer.rows_of(["0zz", model.marked[7].as_py()]) == [-1, 7]).all()


def test_words_are_counted_whole_in_every_language_of_a_batch(monkeypatch):
    monkeypatch.setattr(language_id, "WORDS", 3)
    monkeypatch.setattr(language_id, "ROWS", 2)
    rows = [("en", "a b A"), ("fr", "a c"), ("en", None), ("en", "b d"), ("fr", "a")]
    batch = pa.RecordBatch.from_pydict({"lang": [r[0] for r in rows], "text": [r[1] for r in rows]})
    got = {}
    for part in language_id._count_words(iter([batch])):
        for lang, word, n in zip(*(part.column(c).to_pylist() for c in ("lang", "word", "n"))):
            got[lang, word] = got.get((lang, word), 0) + n
    assert got == {("en", "a"): 2, ("en", "b"): 2, ("en", "d"): 1, ("fr", "a"): 2, ("fr", "c"): 1}
