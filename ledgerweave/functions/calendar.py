"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_key(c: Column) -> Column:
    """Integer yyyymmdd of a date or timestamp."""
    return F.date_format(c, "yyyyMMdd").cast("int")


def quarter_columns(c: Column) -> list[Column]:
    """Calendar attributes of a date column, in dimension order."""
    return [
        date_key(c).alias("date_key"),
        c.alias("full_date"),
        F.date_format(c, "EEEE").alias("day_of_week"),
        F.month(c).alias("month_no"),
        F.quarter(c).alias("quarter_no"),
        F.year(c).alias("year_no"),
    ]


def date_spine(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """One row per day between the bounds of a one-row frame, both included."""
    days = F.explode(F.sequence(F.col(lo), F.col(hi), F.expr("interval 1 day")))
    return bounds.where(F.col(lo).isNotNull()).select(days.alias("full_date"))
