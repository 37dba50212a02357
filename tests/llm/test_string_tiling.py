import random

import numpy as np

from ledgerweave.llm import string_tiling as tiling
from llm_cases import ODD_TEXTS, docs_of, shipped  # noqa: F401


def brute_tiles(item, text, least):
    free_item, free_text, out = [True] * len(item), [True] * len(text), []
    while True:
        best, runs = least - 1, []
        for i in range(len(item)):
            for j in range(len(text)):
                k = 0
                while (i + k < len(item) and j + k < len(text) and item[i + k] == text[j + k]
                       and free_item[i + k] and free_text[j + k]):
                    k += 1
                if k > best:
                    best, runs = k, [(i, j)]
                elif k == best and k >= least:
                    runs.append((i, j))
        if best < least:
            return out
        for i, j in runs:
            if all(free_item[i : i + best]) and all(free_text[j : j + best]):
                free_item[i : i + best] = free_text[j : j + best] = [False] * best
                out.append((best, i, j))


def test_tiles_equal_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        letters = rng.choice([2, 3, 8])
        item = [rng.randrange(1, letters + 1) for _ in range(rng.randrange(0, 40))]
        text = [rng.randrange(1, letters + 1) for _ in range(rng.randrange(0, 60))]
        if len(item) > 10 and rng.random() < 0.5:
            cut = rng.randrange(len(item))
            text = text[:10] + item[cut:] + text[10:20] + item[:cut] + text[20:]
        got = tiling.tiles(np.array(item, np.uint64), np.array(text, np.uint64), 3)
        assert sum(r[0] for r in got) == sum(r[0] for r in brute_tiles(item, text, 3))


WORDS = [f"term{i}" for i in range(200)]


def test_find_and_clean(spark, docs_of):
    items = [" ".join(WORDS[:30]), " ".join(WORDS[40:60]), "tiny item", None, ""]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    turned = " ".join(WORDS[15:30] + ["other"] * 5 + WORDS[:15])
    decorated = " ".join(w.upper() + "!!" for w in WORDS[40:60])
    rows = [
        (1, "before " + items[0] + " after"), (2, turned), (3, decorated), (4, " ".join(WORDS[:10])),
        (5, "a tiny item here"), (6, " ".join(WORDS[100:])), (None, items[1]), (1, "again " + items[0]),
    ] + [(20 + i, t) for i, t in enumerate(ODD_TEXTS)]
    docs = docs_of(rows)
    got = sorted((r["doc_id"] or -1, r["item_id"], r["n_tiles"], r["covered_words"])
                 for r in tiling.find(docs, benchmark).collect())
    assert got == [(-1, 1, 1, 20), (1, 0, 1, 30), (1, 0, 1, 30), (2, 0, 2, 30), (3, 1, 1, 20), (5, 2, 1, 2)]
    kept = tiling.clean(docs.withColumnRenamed("source", "item_id"), benchmark)
    assert kept.columns == ["doc_id", "text", "lang", "item_id", "n_chars"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 6, *range(20, 20 + len(ODD_TEXTS))]
    assert tiling.find(docs.limit(0), benchmark).count() == 0
    assert tiling.find(docs, benchmark.limit(0)).count() == 0
    assert tiling.clean(docs, benchmark.limit(0)).count() == len(rows)


def test_blocks_of_the_benchmark_add_up(spark, docs_of, monkeypatch):
    items = [(i, " ".join(WORDS[i : i + 12])) for i in range(0, 120, 12)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = docs_of([(i, "x " + t) for i, t in items])
    whole = {(r["doc_id"], r["item_id"]) for r in tiling.find(docs, benchmark).collect()}
    monkeypatch.setattr(tiling, "BLOCK_WORDS", 20)
    parts = {(r["doc_id"], r["item_id"]) for r in tiling.find(docs, benchmark).collect()}
    assert whole == parts == {(i, i) for i, _ in items}
