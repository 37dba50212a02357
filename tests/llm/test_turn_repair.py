"""Repairs against all edit sequences of short conversations, and whole conversations cut small."""

import hashlib
import random
import re
from itertools import product

import pytest
from pyspark.sql import functions as F

from compare import differences, duck
from conftest import SF_DIR
from ledgerweave.llm import queries, turn_repair
from llm_cases import shipped  # noqa: F401

TURNS = "conv_id bigint, turn bigint, role string, text string"
SHAPE = re.compile(r"(s?(ua)+)?")


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append("b" if not bare else "d" if (role, text) in seen else "" if bare[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def ordered(rows):
    return sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def every_repair(rows, inserts=2):
    """All (cost, audit, lines) with at most ``inserts`` insertions before each row and at the end."""
    bad = faults(rows)
    choices = []
    for (_, role, text), fault in zip(rows, bad):
        own = [(2, "D", [])]
        if fault not in ("b", "d"):
            add = 5 * (fault == "t")
            own += [(add, "K", [(role, text)])] if role else []
            own += [(1 + add, "R", [(new, text)]) for new in ("user", "assistant")]
        choices.append(own)
    gap = [(5 * n, "I" * n, [(r, "") for r in new]) for n in range(inserts + 1)
           for new in product(("user", "assistant"), repeat=n)]
    steps = [x for own in choices for x in (gap, own)] + [gap]
    best = None
    for way in product(*steps):
        lines = [line for _, _, made in way for line in made]
        if SHAPE.fullmatch("".join(r[0] for r, _ in lines)):
            found = (sum(w[0] for w in way), "".join(w[1] for w in way), lines)
            best = min(best or found, found)
    return best


def brute(rows):
    rows = ordered(rows)
    bad, known = faults(rows), [r[0] for r in rows if r[0] is not None]
    cost, audit, lines = every_repair(rows)
    initials = [r[1][:1] for r in rows]
    return (
        max(known) - min(known) + 1 - len(set(known)) if known else 0, bad.count("b"), bad.count("d"), bad.count("t"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest(),
    )


def run(spark, rows):
    turns = spark.createDataFrame(rows, TURNS)
    report, repaired = turn_repair.repair(turns)
    digest = {r[0]: r[1] for r in turn_repair.digests(repaired).collect()}
    empty = hashlib.sha256().hexdigest()
    return {r[0]: (*r[1:], digest.get(r[0], empty)) for r in report.collect()}


def conversations(seed, n, most):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for _ in range(rng.randrange(1, most + 1)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "cut off", "", " ", None, "a?", "b. ", f"{rng.random()}."])
            rows.append((conv, rng.choice([None, 0, 1, 2, 3, 7]), role, text))
    return rows


def by_conversation(rows):
    convs = {}
    for conv, *row in rows:
        convs.setdefault(conv, []).append(row)
    return convs


def test_query_equals_sql(spark):
    found = queries.op13_structure_repair(spark, SF_DIR)
    assert differences(found, duck(SF_DIR), queries.OP13_SQL) is None


def test_every_repair_of_short_conversations(spark):
    rows = conversations(5, 150, 3)
    assert run(spark, rows) == {c: brute(r) for c, r in by_conversation(rows).items()}


@pytest.mark.parametrize("piece", [1, 3])
def test_pieces_chain_to_the_same_repair(spark, monkeypatch, piece):
    # One conversation has most rows, so it spans ranges as well.
    rows = conversations(6, 12, 6) + [(99, i // 2, *r[2:]) for i, r in enumerate(conversations(8, 80, 5))]
    turns = spark.createDataFrame(rows, TURNS)
    whole = run(spark, rows)
    monkeypatch.setattr(turn_repair, "PIECE_ROWS", piece)
    made = turn_repair._cut(turn_repair._arrow("bigint"))
    assert made and run_cut(spark, turns, piece) == whole


def run_cut(spark, turns, piece):
    """As ``run``, with pieces cut on the executors at ``piece`` rows."""
    cut = turn_repair._cut

    def small(kind):
        inner = cut(kind)

        def mapper(batches):
            from ledgerweave.llm import turn_repair as there

            there.PIECE_ROWS = piece
            return inner(batches)

        return mapper

    turn_repair._cut = small
    try:
        report, repaired = turn_repair.repair(turns)
        digest = {r[0]: r[1] for r in turn_repair.digests(repaired).collect()}
        return {r[0]: (*r[1:], digest.get(r[0], hashlib.sha256().hexdigest())) for r in report.collect()}
    finally:
        turn_repair._cut = cut


def test_agenda_equals_every_repair():
    rng = random.Random(3)
    for _ in range(300):
        rows = [(i, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["Yes.", "cut", "", f"{i}!"])) for i in range(rng.randrange(4))]
        items = tuple((r[1][:1], f, 1) for r, f in zip(rows, faults(rows)))
        (weight,) = turn_repair.lightest(items, turn_repair.START, True).values()
        assert weight == every_repair(rows)[:2]


def test_copies_count_as_rows(spark):
    rows = [(1, 0, "user", "Hello.")] * 500 + [(1, 1, "assistant", "Hi.")] + [(2, None, "user", "")] * 300 + [(None, 0, "user", "x.")]
    found = run(spark, rows)
    assert found[1][:7] == (0, 0, 499, 0, 499, 998, "K" + "D" * 499 + "K")
    assert found[2][:7] == (0, 300, 0, 0, 299, 600, "D" * 300)
    assert found[None][5:7] == (2, "D")


def test_long_texts_empty_tables_and_clashing_columns(spark):
    assert run(spark, []) == {}
    rows = [(1, 0, "user", "word " * 100_000 + "."), (1, 1, "assistant", "ok.")]
    names = ("conv", "copies", "head", "seq", "spans", "known", "first", "id")
    turns = spark.createDataFrame(rows, TURNS).select("*", *(F.lit(0).alias(n) for n in names))
    report, repaired = turn_repair.repair(turns, turns.unionByName(turns.withColumn("conv_id", F.lit(5).cast("bigint"))))
    assert sorted((r["conv_id"], r["cost"], r["audit"]) for r in report.collect()) == [(1, 0, "KK"), (5, 0, "")]
    assert repaired.orderBy("seq", "place").select("role").collect()[0]["role"] == "user"
    damaged = turn_repair.damaged(spark.createDataFrame([(None, None, None, None), (None, 3, None, "x.")], TURNS))
    assert {tuple(r)[2:] for r in damaged.collect()} <= {(" ", " "), (" ", "x."), (" ", "x"), (" ", ""), ("user", " "), ("user", "x.")}
