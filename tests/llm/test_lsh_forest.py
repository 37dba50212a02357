import random

import numpy as np
import pytest

from compare import differences, duck
from ledgerweave.llm import lsh_forest, queries
from ledgerweave.llm.common import Scratch, words_of
from ledgerweave.llm.components import components
from llm_cases import ODD_TEXTS, docs_of, shipped  # noqa: F401

SF_DIR = "/root/testdata/sf0.001"


def test_query_equals_sql(spark):
    found = queries.op9_near_duplicates(spark, SF_DIR)
    assert differences(found, duck(SF_DIR), queries.OP9_SQL) is None


def brute(rows, width, percent):
    sets = {}
    for i, text in rows:
        words = words_of(text)
        span = min(width, len(words))
        sets[i] = {tuple(words[k : k + span]) for k in range(len(words) - span + 1)} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def family(rng, size, count, edits):
    """Copies of one text, each with some words of its own."""
    base = [f"w{rng.randrange(400)}" for _ in range(size)]
    out = []
    for _ in range(count):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(size)] = f"own{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def corpus():
    rng = random.Random(11)
    texts = family(rng, 120, 120, 5) + family(rng, 300, 20, 8) + family(rng, 40, 30, 2) + family(rng, 8, 10, 1)
    passage = " ".join(f"common{i}" for i in range(40))
    texts += [passage + " " + " ".join(f"p{k}x{i}" for i in range(rng.randrange(5, 120))) for k in range(80)]
    texts += ["exact copy of a text " * 3] * 40 + [f"alone{k} " * 5 + str(k) for k in range(40)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_equals_brute_force(spark, docs_of, width, percent):
    rows = corpus()
    got = lsh_forest.near_duplicates(docs_of(rows), width=width, percent=percent)
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == brute(rows, width, percent)


def test_crowded_regions_and_many_cells(spark, docs_of, monkeypatch):
    """With tiny limits most regions are cut into blocks and clusters are dealt into cells."""
    monkeypatch.setattr(lsh_forest, "REGION", 25)
    monkeypatch.setattr(lsh_forest, "BLOCK", 10)
    rows = corpus()
    got = lsh_forest.near_duplicates(docs_of(rows), width=3, percent=85)
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == brute(rows, 3, 85)


def test_shared_counts():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)

    def member():
        own = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
        few = rng.integers(0, 200, 3).astype(np.uint64)
        return np.unique(np.concatenate([base[rng.random(300) > 0.1], own, few]))

    left, right = [member() for _ in range(90)], [member() for _ in range(40)]
    want = [[len(np.intersect1d(a, b)) for b in right] for a in left]
    assert lsh_forest._shared_counts(left, right).tolist() == want


def test_components(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(0, 200)] + [(500, i) for i in range(501, 700)] + [(900, 901), (901, 900), (950, 950)]
    rng.shuffle(links)
    frame = spark.createDataFrame(links, "a bigint, b bigint").repartition(5)
    got = {r["node"]: r["root"] for r in components(frame, Scratch(spark, "cc"), "t").collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 500 for i in range(500, 700)}, 900: 900, 901: 900}
    assert components(frame.limit(0), Scratch(spark, "cc"), "t").count() == 0


def test_odd_rows(spark, docs_of):
    rows = list(enumerate(ODD_TEXTS)) + [(None, "same text here"), (None, None), (4, "é")]
    docs = docs_of(rows).withColumnRenamed("lang", "component_id").withColumnRenamed("source", "digest")
    got = sorted(map(tuple, lsh_forest.near_duplicates(docs).collect()), key=repr)
    assert len(got) == len(rows)
    by_id = {r[0]: r[1:] for r in got if r[0] is not None}
    assert by_id[0] == (0, 0, True) and by_id[1] == (0, 1, True) and by_id[2] == (0, 2, True)
    assert by_id[7][1:] == (7, True) and by_id[8][1:] == (7, False) and by_id[6][0] == 1
    assert [r[2:] for r in got if r[0] is None] == [(None, True), (None, True)]
    assert lsh_forest.near_duplicates(docs.limit(0)).count() == 0


def test_crowded_regions_lose_no_pair(spark, docs_of, monkeypatch):
    """Signatures that agree by half: pairs that share a prefix stay together, however crowded."""
    monkeypatch.setattr(lsh_forest, "REGION", 30)
    rng = np.random.default_rng(6)
    sigs = rng.choice(3, (1500, lsh_forest.SIZE), p=(0.66, 0.2, 0.14)).astype(np.uint16)
    near = sigs[:500].copy()
    changed = rng.random(near.shape) < 0.25
    near[changed] = rng.choice(3, int(changed.sum()), p=(0.66, 0.2, 0.14))
    sigs[500:1000] = near
    least = 0.7
    want = set()
    for tree in range(lsh_forest.TREES):
        regions = {}
        for i, prefix in enumerate(sigs[:, 4 * tree : 4 * tree + 4].tolist()):
            regions.setdefault(tuple(prefix), []).append(i)
        for ids in regions.values():
            alike = (sigs[ids][:, None, :] == sigs[ids][None, :, :]).mean(axis=2) >= least
            want |= {(ids[a], ids[b]) for a, b in zip(*np.nonzero(alike)) if a < b}
    reps = spark.createDataFrame(
        [(i, 100, bytearray(s.tobytes())) for i, s in enumerate(sigs)], "id bigint, n bigint, sig binary"
    )
    members, inner = lsh_forest._regions(reps, Scratch(spark, "regions"), least, 80)
    found = members.join(reps, "id").groupBy("region").applyInArrow(
        lsh_forest._spanning(least, 80), "a bigint, b bigint, alike float"
    ).unionByName(inner).select("a", "b")
    links = {(min(r), max(r)) for r in map(tuple, found.collect())}
    assert links <= want
    root = list(range(1500))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        root[find(a)] = find(b)
    assert len(want) > 450 and [p for p in want if find(p[0]) != find(p[1])] == []


def crowd(rng, families, count, noise):
    """Signatures of families of near copies that all share their first values."""
    sigs = []
    for _ in range(families):
        base = rng.integers(0, 1 << 16, lsh_forest.SIZE)
        copies = np.where(rng.random((count, lsh_forest.SIZE)) < noise, rng.integers(0, 1 << 16, (count, lsh_forest.SIZE)), base)
        sigs.append(copies)
    sigs = np.concatenate(sigs).astype(np.uint16)
    sigs[:, : lsh_forest.FIRST] = 7
    return sigs


def test_sorted_neighbours_spare_most_comparisons():
    rng = np.random.default_rng(3)
    for families, noise, most in ((1, 0.05, 0.1), (3, 0.05, 0.05), (1, 0.0, 0.01)):
        sigs = crowd(rng, families, 1000, noise)
        sigs = sigs[np.lexsort(sigs[:, ::-1].T)]
        sizes = np.full(len(sigs), 50)
        links = lsh_forest.Links(np.arange(len(sigs)))
        lsh_forest._sorted_neighbours(links, sigs, sizes, 0.7, 80)
        lsh_forest._left_apart(links, sigs, sizes, 0.7, 80)
        assert len(np.unique(links.names)) == families
        assert links.compared < most * len(sigs) ** 2 / 2, (families, links.compared)


def test_a_crowd_is_cut_into_blocks_that_need_not_meet(spark, monkeypatch):
    """Families far apart in one region: most blocks are ruled out by their radii, and blocks of one
    family are known to be one group. What meets are blocks with strays of another family."""
    monkeypatch.setattr(lsh_forest, "REGION", 100)
    rng = np.random.default_rng(4)
    sigs = crowd(rng, 6, 400, 0.04)
    reps = spark.createDataFrame(
        [(i, 100, bytearray(s.tobytes())) for i, s in enumerate(sigs)], "id bigint, n bigint, sig binary"
    )
    members, inner = lsh_forest._regions(reps, Scratch(spark, "regions"), 0.7, 80)
    pairs = members.where("side > 0").groupBy("region").agg({"id": "count"}).selectExpr("`count(id)` AS n")
    compared = sum(r["n"] ** 2 // 4 for r in pairs.collect())
    assert compared < 0.25 * len(sigs) ** 2 / 2
    found = members.join(reps, "id").groupBy("region").applyInArrow(
        lsh_forest._spanning(0.7, 80), "a bigint, b bigint, alike float").unionByName(inner)
    roots = {r["node"]: r["root"] for r in components(found.select("a", "b"), Scratch(spark, "cc"), "t").collect()}
    assert {roots[i] for i in range(len(sigs))} == {400 * k for k in range(6)}
