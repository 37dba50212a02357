"""Divergence against plain counting in whole numbers."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from compare import differences, duck
from conftest import SF_DIR
from ledgerweave.llm import count_cells, queries
from llm_cases import DOCS, ODD_TEXTS, shipped  # noqa: F401

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, least, ranks):
    counts, df = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = terms(text)
        counts[lang, source].update(found)
        df[lang].update(set(found))
    out = []
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in df[lang].items() if n >= least]
        groups = {s: c for (x, s), c in counts.items() if x == lang}
        whole = Counter()
        for c in groups.values():
            whole.update(c)

        def shares(c):
            below = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // below for t in kept}

        q, p = shares(whole), {s: shares(c) for s, c in groups.items()}
        for s, c in groups.items():
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in groups if o != s]
            above = [(p[s][t] - q[t], t) for t in kept if c[t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", above)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                for rank, (value, item) in enumerate(items if part == "pair" else items[:ranks], 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


def run(spark, rows, least, ranks):
    full = [(i, t, lang, s, 0) for i, (t, lang, s) in enumerate(rows)]
    found = count_cells.divergence(spark.createDataFrame(full, DOCS), least, ranks)
    return sorted(tuple(r) for r in found.collect())


def random_rows(seed, n, langs="xy", sources="abcde"):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "kéЖñZ" for b in "aeiou"] + ["😀", "Word", "wORD"]
    rows = []
    for _ in range(n):
        lang, source = rng.choice(langs), rng.choice(sources)
        pool = words[: 8 + 4 * (ord(source) % 5)]
        rows.append((rng.choice(" .,1-_").join(rng.choices(pool, k=rng.randrange(12))), lang, source))
    return rows


def test_query_equals_sql(spark):
    found = queries.op11_divergence_audit(spark, SF_DIR)
    assert differences(found, duck(SF_DIR), queries.OP11_SQL) is None


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_brute_force(spark, seed):
    rows = random_rows(seed, 150)
    assert run(spark, rows, 5, 7) == brute(rows, 5, 7)


def test_ties_are_cut_in_utf8_order(spark):
    # All terms of a source have one count, so one cell holds more terms than there are ranks.
    marks = [chr(c) for c in (*range(0x61, 0x7B), *range(0xE0, 0xF6), 0xFF5E, 0x10400)]
    rows = [(" ".join(marks), "x", "s")] * 2 + [("other " * 50, "x", "t")] * 2
    found = run(spark, rows, 1, 10)
    assert found == brute(rows, 1, 10) and sum(r[2] == "term" for r in found) == 11


def test_odd_rows(spark):
    rows = [(t, None, s) for t in ODD_TEXTS for s in (None, "s", "s")] + [("", "empty", "a"), (None, "empty", "b"), ("few", "rare", "c")]
    found = run(spark, rows, 2, 50)
    assert found == brute(rows, 2, 50)
    assert ("empty", "a", "pair", "b", 0, 1) in found and not [r for r in found if r[0] == "rare"]
    assert run(spark, [], 1, 5) == []


def test_clashing_columns(spark):
    rows = random_rows(9, 40)
    full = spark.createDataFrame([(i, t, lang, s, 0) for i, (t, lang, s) in enumerate(rows)], DOCS)
    names = ("term", "n", "total", "p", "q", "value", "rank", "count", "v", "zero", "a", "b")
    found = count_cells.divergence(full.select("*", *(F.lit("z").alias(n) for n in names)), 3, 5)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 3, 5)


def test_counts_that_are_flushed_add_up(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(count_cells, "FLUSH", 3)
    rows = random_rows(4, 200)
    batch = pa.RecordBatch.from_pydict({
        "lang": [r[1] for r in rows], "source": [r[2] for r in rows],
        "text": pa.array([r[0].encode() for r in rows], pa.binary()),
    })
    sums, want = Counter(), Counter()
    parts = list(count_cells._count(iter([batch])))
    for part in parts:
        for r in part.to_pylist():
            sums[r["lang"], r["source"], r["term"]] += r["n"]
    for text, lang, source in rows:
        want.update((lang, source, t) for t in terms(text))
    assert sums == want and len(parts) > 10


def test_shares_beyond_64_bits(spark):
    row = spark.range(1).select(count_cells.share(
        F.lit(4_000_000_000_000).cast("bigint"), F.lit(9_000_000_000_000_007).cast("bigint"), F.lit(12_345).cast("bigint")
    ).alias("p")).first()
    assert row["p"] == 1 + 1_000_000_000 * 4_000_000_000_005 // (9_000_000_000_000_007 + 5 * 12_345)
