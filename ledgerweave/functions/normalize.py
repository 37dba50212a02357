"""Text normalisation as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm_text(c: Column) -> Column:
    """Trim, collapse inner whitespace, lower-case; blank becomes NULL."""
    return F.nullif(F.lower(F.regexp_replace(F.trim(c), r"\s+", " ")), F.lit(""))


def norm_phone(c: Column) -> Column:
    """Digits only, country code 61 rewritten to a leading 0; blank becomes NULL."""
    digits = F.regexp_replace(c, "[^0-9]", "")
    return F.when(
        digits.startswith("61"), F.concat(F.lit("0"), F.substring(digits, 3, 1 << 30))
    ).otherwise(F.nullif(digits, F.lit("")))


def full_name(first: Column, last: Column) -> Column:
    """Trimmed first and last name. NULL in either part gives NULL."""
    return F.concat(F.trim(first), F.lit(" "), F.trim(last))


def case_key(c: Column) -> Column:
    """Trimmed upper-case form for case-blind equality."""
    return F.upper(F.trim(c))


def has_outer_space(c: Column) -> Column:
    return c != F.trim(c)


def id_number(c: Column, start: int = 2, length: int = 4) -> Column:
    """Numeric part of a prefixed identifier."""
    return F.substring(c, start, length).cast("bigint")


def map_value(c: Column, mapping: dict[str, str]) -> Column:
    """Replace mapped values; anything unmapped passes through."""
    pairs = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return F.coalesce(F.try_element_at(pairs, c), c)
