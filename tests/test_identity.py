import random

import pytest
from pyspark.sql import functions as F

from ledgerweave.operators import identity as idn
from ledgerweave.plans import catalog
from ledgerweave.plans.shared import warehouse
from conftest import SF_DIR


def test_boundary_cases(spark):
    rows = catalog.QUERIES["identity_boundary_cases"](spark, SF_DIR).where(
        F.col("source_customer_id").rlike("^Z[PU]-")
    )
    got = {r[0]: tuple(r)[1:] for r in rows.collect()}
    assert got["ZP-case-and-blanks"] == ("ZC-lone", "R3_NAME_EMAIL", "matched")
    assert got["ZP-shared-mail"] == (None, "R3_NAME_EMAIL", "ambiguous")
    assert got["ZP-married-name"] == ("ZC-lone", "R2_DOB_CONTACT", "matched")
    assert got["ZP-stranger"] == (None, "NONE", "unmatched")
    assert all(got[b][0] is None for b in ("ZP-name-only", "ZU-other-birthday", "ZP-blank-mail"))


def test_pair_cases(spark):
    rows = catalog.QUERIES["identity_pair_cases"](spark, SF_DIR).where(
        F.col("source_customer_id").rlike("^ZP-(solo|double)")
    )
    got = {r[0]: tuple(r)[1:] for r in rows.collect()}
    assert got["ZP-solo-open"] == (None, "R3_NAME_EMAIL", "ambiguous")
    assert got["ZP-double-1"] == got["ZP-double-2"] == (None, "R3_NAME_EMAIL", "ambiguous")
    assert got["ZP-solo-conflict"][0] is None


def brute(anchors, people):
    out = {}
    for system, pid, name, dob, email, phone in people:
        hit = [a for a in anchors if dob is not None and a[2] == dob and (
            (email is not None and a[3] == email) or (phone is not None and a[4] == phone))]
        rule, keys, pair = "R2_DOB_CONTACT", hit, 1
        if not hit and dob is None and email is not None and name is not None:
            keys = [a for a in anchors if a[1] == name and a[3] == email]
            rule = "R3_NAME_EMAIL"
            pair = sum(1 for p in people if p[0] == system and p[2] == name and p[4] == email)
        if keys:
            sure = len(keys) == 1 and pair == 1
            out[(system, pid)] = (keys[0][0] if sure else None, rule, "matched" if sure else "ambiguous")
        else:
            namesakes = sum(1 for a in anchors if name is not None and a[1] == name)
            out[(system, pid)] = (None, "NONE", "ambiguous" if namesakes > 1 else "unmatched")
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_lookup_equals_brute_force(spark, ws, seed):
    """Few distinct values, so every rule, conflict and shared contact occurs, one contact very often."""
    rng = random.Random(seed)

    def some(values, empty=0.2):
        return None if rng.random() < empty else rng.choice(values)

    names, dobs = ["ann lee", "bo li", "cy fox", "di ray"], [f"19{y}-01-01" for y in range(60, 72)]
    emails = [f"e{i}@x" for i in range(12)]
    phones = [f"04{i}" for i in range(12)]
    anchors = [(k, rng.choice(names), rng.choice(dobs), some(emails), some(phones)) for k in range(1, 41)]
    people = [
        (rng.choice(["S2", "S3"]), f"p{i}", some(names, 0.1), some(dobs, 0.4),
         "e0@x" if i % 3 == 0 else some(emails), some(phones, 0.5))
        for i in range(300)
    ]
    a = spark.createDataFrame(anchors, "customer_key bigint, full_name string, dob string, email string, phone string")
    a = a.withColumn("date_of_birth", F.col("dob").cast("date"))
    p = spark.createDataFrame(
        people, "source_system string, source_customer_id string, name string, dob string, email string, phone string"
    ).withColumn("dob", F.col("dob").cast("date"))
    got = idn.resolve(ws, "id", a, p, ["S2", "S3"]).collect()
    assert len(got) == len(people)
    assert {(r[0], r[1]): tuple(r)[2:] for r in got} == brute(anchors, people)


def test_every_source_row_is_kept(spark):
    wh = warehouse(spark, SF_DIR)
    assert wh.xref_rows.count() == wh.people.count() + wh.dim_customer.count()
