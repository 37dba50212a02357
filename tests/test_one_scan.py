"""Counts of many questions against plain Python, and the plans behind them."""

import random
import re
from collections import Counter

import pytest
from ledgerweave.operators import constraints, one_scan
from ledgerweave.plans import guards
from ledgerweave.plans import source_checks as sc
from ledgerweave.plans.shared import warehouse
from ledgerweave.operators.scorecard import observed_counts
from ledgerweave.sources.bank_adapter import bank_sources
from conftest import SF_DIR


def scans(df) -> Counter:
    """Files scanned by a plan, by their last folder or file."""
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves, found = plan.collectLeaves().iterator(), Counter()
    while leaves.hasNext():
        leaf = leaves.next()
        if "LogicalRelation" in leaf.getClass().getName():
            paths = leaf.relation().location().rootPaths().iterator()
            found.update(re.sub(r".*/", "", str(paths.next().toString())) for _ in range(1))
    return found


@pytest.mark.parametrize("seed", range(4))
def test_questions_against_brute_force(spark, seed):
    rng = random.Random(seed)
    left = [(rng.choice([None, *range(6)]), rng.choice([None, "x", "y"])) for _ in range(rng.choice([0, 40]))]
    right = [(k, rng.choice([None, "x"])) for k in rng.sample(range(6), 3)] + [(None, "x")]
    tables = {n: spark.createDataFrame(r, "a int, b string") for n, r in (("left", left), ("right", right))}
    a, b = "a", "b"
    asked = [
        one_scan.holds("rows", "left", "true"), one_scan.holds("x", "left", "b = 'x'"),
        one_scan.holds("x", "right", "b = 'x'"),  # one name, two tables: added up
        one_scan.spare_rows("spare", "left", [a, b]),
        one_scan.repeated_keys("repeated", "left", [a]), one_scan.repeated_keys("repeated open", "left", [a], True),
        one_scan.groups("pairs", "left", [a, b], "n = 2", "b IS NOT NULL"),
        one_scan.orphans("lost", "left", [a], "right", [a]),
        one_scan.orphans("lost known", "left", [a], "right", [a], open_counts=False),
        one_scan.orphans("lost both", "left", [a, b], "right", [a, b], "b = 'x'"),
    ]
    got = {r["name"]: r["observed"] for r in one_scan.answers(tables, asked).collect()}
    keys, firsts = Counter(left), Counter(k for k, _ in left)
    known = {k for k, _ in right if k is not None}
    pairs = {r for r in right if None not in r}
    assert got == {
        "rows": len(left), "x": sum(r[1] == "x" for r in left + right),
        "spare": len(left) - sum(None not in k for k in keys),
        "repeated": sum(n > 1 for k, n in firsts.items() if k is not None),
        "repeated open": sum(n > 1 for n in firsts.values()),
        "pairs": sum(n == 2 for k, n in keys.items() if k[1] is not None),
        "lost": sum(k not in known for k, _ in left),
        "lost known": sum(k is not None and k not in known for k, _ in left),
        "lost both": sum(r[1] == "x" and r not in pairs for r in left),
    }


def test_dense_keys_are_compared_and_others_are_met(spark):
    def frame(keys):
        return spark.createDataFrame([(k,) for k in keys], "k bigint")

    facts = [None, 1, 2, 3, 4, 5, 5, 0]
    for name, dim, lost in (
        ("dense", [1, 2, 3, 4, 5], 1), ("hole", [1, 2, 4, 5], 2), ("repeated", [1, 2, 2, 4, 5], 2),
        ("empty", [], 7), ("null", [1, 2, 3, 4, None], 3), ("shifted", [0, 1, 2, 3, 4], 2),
    ):
        tables = {"fact": frame(facts), "dim": frame(dim)}
        dense = constraints.dense_keys(tables, [("dim", "k")])
        assert (("dim", "k") in dense) == (name == "dense"), name
        for nulls in (False, True):
            question = constraints.reference("q", "fact", "k", ("dim", "k"), dense, nulls)
            assert one_scan.answers(tables, [question]).first()["observed"] == lost + nulls, name


def test_every_source_is_read_once_by_the_scorecard(spark):
    sources = {n: df for n, df in bank_sources(spark, SF_DIR).items()}
    written = {}
    from ledgerweave.operators.workspace import Workspace

    ws = Workspace(spark, "once")
    for name, df in sources.items():
        written[name] = ws.table(name, lambda df=df: df)
    found = scans(observed_counts(written, sc.source_checks(sc.PUBLISHED)))
    assert found and set(found.values()) == {1}


def test_every_fact_is_read_once_by_the_reference_checks(spark):
    wh = warehouse(spark, SF_DIR)
    wh.build()
    for lines in (guards.missing_dimensions(wh), guards.warehouse_constraints(wh)):
        found = scans(lines)
        for fact in ("fact_transaction_rows", "fact_activity_rows", "fact_service_case_rows"):
            assert found[fact] == 1, found
