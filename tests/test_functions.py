import datetime

from pyspark.sql import functions as F

from ledgerweave.functions import (
    date_key, date_spine, differs, full_name, has_outer_space, id_number, join_null_safe, map_value,
    norm_phone, norm_text, same,
)


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column).first()[0]


def test_norm_text(spark):
    for text, want in [("  Ann   LEE ", "ann lee"), ("   ", None), (None, None), ("a\t b", "a b")]:
        assert one(spark, norm_text(F.col("t")), t=text) == want


def test_norm_phone(spark):
    cases = [("+61 412 345 678", "0412345678"), ("0412 345 678", "0412345678"), ("", None),
             ("none", None), (None, None), ("61", "0")]
    for text, want in cases:
        assert one(spark, norm_phone(F.col("t")), t=text) == want


def test_full_name_keeps_null(spark):
    assert one(spark, full_name(F.col("a"), F.col("b")), a=" Ann ", b=" Lee ") == "Ann Lee"
    assert one(spark, full_name(F.col("a"), F.col("b")), a="Ann", b=None) is None


def test_small_functions(spark):
    assert one(spark, id_number(F.col("t")), t="P1010") == 1010
    assert one(spark, map_value(F.col("t"), {"APP": "Mobile app"}), t="APP") == "Mobile app"
    assert one(spark, map_value(F.col("t"), {"APP": "Mobile app"}), t="KIOSK") == "KIOSK"
    assert one(spark, has_outer_space(F.col("t")), t=" x") is True
    assert one(spark, same(F.col("a"), F.col("b")), a=None, b=None) is True
    assert one(spark, differs(F.col("a"), F.col("b")), a=None, b="x") is True
    assert one(spark, date_key(F.col("t").cast("date")), t="2026-03-09") == 20260309


def test_date_spine(spark):
    bounds = spark.sql("select date'2026-01-01' lo, date'2026-03-31' hi")
    days = [r[0] for r in date_spine(bounds).collect()]
    assert len(days) == 90 and days[-1] == datetime.date(2026, 3, 31)
    assert date_spine(spark.sql("select cast(null as date) lo, cast(null as date) hi")).count() == 0


def test_join_null_safe(spark):
    left = spark.createDataFrame([(1, None), (2, "x")], "id int, k string")
    right = spark.createDataFrame([(None, 10), ("y", 20)], "k string, v int")
    assert [tuple(r) for r in join_null_safe(left, right, ["k"]).collect()] == [(1, None, 10)]
    assert join_null_safe(left, right, ["k"], "left_anti").first()["id"] == 2
