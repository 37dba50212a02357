"""Deterministic identity resolution against the core customers.

Rules, first hit wins:
  R2  same birth date and (same e-mail or same phone)
  R3  birth date missing in the source, same name and e-mail, and that pair
      occurs once among all rows of the source system
  NONE never a key; ambiguous when several core customers carry the name

No candidate pair is generated. Each side is turned into lookup keys, the core
side is aggregated to one row per key (how many customers, lowest key), and a
source row meets at most one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions import full_name, norm_phone, norm_text
from ledgerweave.operators.workspace import Workspace

# Rule and status labels.
R1, R2, R3, NONE = "R1_CORE_ID", "R2_DOB_CONTACT", "R3_NAME_EMAIL", "NONE"
MATCHED, AMBIGUOUS, UNMATCHED = "matched", "ambiguous", "unmatched"

# Kinds of lookup key.
DOB_EMAIL, DOB_PHONE, NAME_EMAIL, NAME = "dob_email", "dob_phone", "name_email", "name"
_KINDS = [DOB_EMAIL, DOB_PHONE, NAME_EMAIL, NAME]
# A hash of k1 and k2 whose lowest bits are the kind: sorting compares it first, and equal marks
# with equal k1 and k2 are equal keys. Text that differs only behind a long common prefix, as
# kinds, birth dates and names do, is slow to sort.
_KIND_BITS = 2
_KEY = ["kind_mark", "k1", "k2"]


def anchor_customers(customer: DataFrame) -> DataFrame:
    """One row per core customer, contact details normalised."""
    return customer.select(
        full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        "date_of_birth",
        norm_text(F.col("email")).alias("email"),
        "state",
        F.lit("CORE_ANCHOR").alias("match_quality"),
        F.col("customer_id").alias("core_customer_id"),
        norm_phone(F.col("phone")).alias("phone"),
    )


def people(source: DataFrame, system: str, id_column: str) -> DataFrame:
    """Rows of a source system in the common shape the rules work on."""
    return source.select(
        F.lit(system).alias("source_system"),
        F.col(id_column).alias("source_customer_id"),
        norm_text(full_name(F.col("first_name"), F.col("last_name"))).alias("name"),
        F.col("date_of_birth").alias("dob"),
        norm_text(F.col("email")).alias("email"),
        norm_phone(F.col("phone")).alias("phone"),
    )


def _key(kind: str, k1: Column, k2: Column, when: Column | None = None) -> Column:
    k1, k2 = k1.cast("string"), k2.cast("string")
    mark = F.shiftleft(F.xxhash64(k1, k2), _KIND_BITS).bitwiseOR(F.lit(_KINDS.index(kind)).cast("bigint"))
    key = F.struct(mark.alias("kind_mark"), k1.alias("k1"), k2.alias("k2"))
    usable = k1.isNotNull() & k2.isNotNull()
    return F.when(usable if when is None else usable & when, key)


def _lookup_keys(df: DataFrame, keys: Sequence[Column], keep: Sequence[Column | str]) -> DataFrame:
    """One row per usable key of each input row."""
    exploded = df.select(*keep, F.explode(F.array(*keys)).alias("_k")).where(F.col("_k").isNotNull())
    return exploded.select("_k.*", *[c for c in exploded.columns if c != "_k"])


def _contact_keys(name: Column, dob: Column, email: Column, phone: Column) -> list[Column]:
    return [
        _key(DOB_EMAIL, dob, email),
        _key(DOB_PHONE, dob, phone),
        _key(NAME_EMAIL, name, email),
        _key(NAME, name, F.lit("")),
    ]


def anchor_lookup(anchors: DataFrame, persons: DataFrame, systems: Sequence[str]) -> DataFrame:
    """Per lookup key: core customers, lowest customer key, and source rows per system.

    Both sides share one partial aggregation, so a contact detail carried by a
    third of all rows arrives at its reducer as one row per map task.
    """
    # Names and dates become text once per row, not once per key that holds them.
    texts = anchors.select(
        "customer_key", norm_text(F.col("full_name")).alias("name"),
        F.col("date_of_birth").cast("string").alias("dob"), "email", "phone",
    )
    core = _lookup_keys(
        texts,
        _contact_keys(*map(F.col, ("name", "dob", "email", "phone"))),
        ["customer_key", F.lit(None).cast("string").alias("source_system")],
    )
    pairs = _lookup_keys(
        persons,
        [_key(NAME_EMAIL, F.col("name"), F.col("email"))],
        [F.lit(None).cast("bigint").alias("customer_key"), "source_system"],
    )
    rows_of = [F.count_if(F.col("source_system") == s).alias(f"rows_{s}") for s in systems]
    return (
        core.unionByName(pairs)
        .groupBy(*_KEY)
        .agg(
            F.count("customer_key").alias("hits"),
            F.min("customer_key").alias("lowest"),
            *rows_of,
        )
        .where(F.col("hits") > 0)
    )


def resolve(
    ws: Workspace, name: str, anchors: DataFrame, persons: DataFrame, systems: Sequence[str]
) -> DataFrame:
    """(source_system, source_customer_id, customer_key, match_rule, match_status) per source row.

    ``anchors`` carries ``customer_key`` and the columns of ``anchor_customers``;
    ``persons`` the columns of ``people``. Source ids are unique per system. The
    lookup is written so that a contact shared by very many source rows is split
    at the join: skew handling needs a plain shuffle on both of its sides.
    """
    lookup = ws.table(f"{name}_lookup", lambda: anchor_lookup(anchors, persons, systems))
    no_dob = F.col("dob").isNull()
    probes = _lookup_keys(
        persons.withColumn("dob", F.col("dob").cast("string")),
        [
            _key(DOB_EMAIL, F.col("dob"), F.col("email")),
            _key(DOB_PHONE, F.col("dob"), F.col("phone")),
            _key(NAME_EMAIL, F.col("name"), F.col("email"), no_dob),
            # A row without a name still needs one probe to stay in the result.
            _key(
                NAME,
                F.coalesce("name", F.concat(F.lit("\u0000"), "source_customer_id")),
                F.lit(""),
            ),
        ],
        ["source_system", "source_customer_id"],
    )
    own_rows = F.lit(0)
    for s in systems:
        own_rows = F.when(F.col("source_system") == s, F.col(f"rows_{s}")).otherwise(own_rows)
    kind_of = F.col("kind_mark").bitwiseAND(F.lit((1 << _KIND_BITS) - 1))
    found = probes.join(lookup, _KEY, "left").select(
        "source_system", "source_customer_id", kind_of.alias("kind"), "hits", "lowest",
        own_rows.alias("pair_rows"),
    )

    def of(kind: str, column: str) -> Column:
        return F.max(F.when(F.col("kind") == _KINDS.index(kind), F.col(column)))

    gathered = found.groupBy("source_system", "source_customer_id").agg(
        of(DOB_EMAIL, "hits").alias("e_hits"),
        of(DOB_EMAIL, "lowest").alias("e_key"),
        of(DOB_PHONE, "hits").alias("p_hits"),
        of(DOB_PHONE, "lowest").alias("p_key"),
        of(NAME_EMAIL, "hits").alias("n_hits"),
        of(NAME_EMAIL, "lowest").alias("n_key"),
        of(NAME_EMAIL, "pair_rows").alias("pair_rows"),
        of(NAME, "hits").alias("namesakes"),
    )
    by_contact = F.col("e_hits").isNotNull() | F.col("p_hits").isNotNull()
    several = (
        (F.coalesce("e_hits", F.lit(0)) > 1)
        | (F.coalesce("p_hits", F.lit(0)) > 1)
        | F.coalesce(F.col("e_key") != F.col("p_key"), F.lit(False))
    )
    by_name = F.col("n_hits").isNotNull()
    unclear = (F.col("n_hits") > 1) | (F.col("pair_rows") > 1)
    return gathered.select(
        "source_system",
        "source_customer_id",
        F.when(by_contact, F.when(~several, F.coalesce("e_key", "p_key")))
        .when(by_name, F.when(~unclear, F.col("n_key")))
        .alias("customer_key"),
        F.when(by_contact, R2).when(by_name, R3).otherwise(NONE).alias("match_rule"),
        F.when(by_contact, F.when(several, AMBIGUOUS).otherwise(MATCHED))
        .when(by_name, F.when(unclear, AMBIGUOUS).otherwise(MATCHED))
        .otherwise(F.when(F.col("namesakes") > 1, AMBIGUOUS).otherwise(UNMATCHED))
        .alias("match_status"),
    )


def core_identities(anchors: DataFrame) -> DataFrame:
    """Every core id maps to itself."""
    return anchors.select(
        F.lit("S1").alias("source_system"),
        F.col("core_customer_id").alias("source_customer_id"),
        "customer_key",
        F.lit(R1).alias("match_rule"),
        F.lit(MATCHED).alias("match_status"),
    )
