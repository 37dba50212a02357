import random
from collections import defaultdict

import pytest

from ledgerweave.operators import keys
from ledgerweave.operators.keys import dense_key, rank_by_id, rank_rows


def test_dense_key_follows_order(spark, ws):
    ids = list(range(5000))
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(f"K{i:06d}",) for i in ids], "k string").repartition(7)
    rows = dense_key(ws, "k", df, ["k"], "key").collect()
    assert [r["key"] for r in sorted(rows, key=lambda r: r["k"])] == list(range(1, 5001))


def test_dense_key_empty(spark, ws):
    assert dense_key(ws, "k", spark.createDataFrame([], "k string"), ["k"], "key").count() == 0


def hot_groups():
    """A third of all rows in one group, some pairs, a NULL group, the rest alone."""
    rng = random.Random(7)
    rows = [("hot", i) for i in range(1000)] + [(f"pair{i // 2}", 1000 + i) for i in range(200)]
    rows += [(None, 5000 + i) for i in range(5)] + [(f"one{i}", 10_000 + i) for i in range(1800)]
    rng.shuffle(rows)
    return rows


def brute_ranks(rows):
    groups = defaultdict(list)
    for ref, i in rows:
        groups[ref].append(i)
    return {(ref, i): n for ref, ids in groups.items() for n, i in enumerate(sorted(ids), 1)}


@pytest.mark.parametrize("limit", [None, 900, 3])  # no hot group, one, and the NULL group as well
def test_rank_by_id(spark, ws, limit):
    rows = hot_groups()
    df = spark.createDataFrame(rows, "ref string, id int").repartition(5)
    want = brute_ranks(rows)
    assert len(keys.hot_groups(df, ["ref"], limit or keys.HOT_ROWS)) == {None: 0, 900: 1, 3: 2}[limit]
    got = rank_by_id(ws, "ids", df, ["ref"], "id", hot_rows=limit).collect()
    assert {(r["ref"], r["id"]): r["rn"] for r in got} == want
    assert len(got) == len(rows)


@pytest.mark.parametrize("limit", [None, 300])
def test_rank_rows_with_ties(spark, ws, limit):
    rows = [("hot", i // 2) for i in range(400)] + [(f"one{i}", i) for i in range(300)]
    df = spark.createDataFrame(rows, "ref string, v int").repartition(5)
    got = rank_rows(ws, "rows", df, ["ref"], ["v"], hot_rows=limit).collect()
    hot = sorted((r["rn"], r["v"]) for r in got if r["ref"] == "hot")
    assert hot == [(n + 1, n // 2) for n in range(400)]
    assert all(r["rn"] == 1 for r in got if r["ref"] != "hot") and len(got) == len(rows)


def test_ranks_of_an_empty_table(spark, ws):
    empty = spark.createDataFrame([], "ref string, v int")
    assert rank_rows(ws, "none", empty, ["ref"], ["v"]).count() == 0
