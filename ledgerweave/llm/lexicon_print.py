"""I-Match fingerprints with randomised lexicon subsets, in DataFrame expressions only.

The lexicon holds the terms whose inverse document frequency lies in a band. A text's terms in
the lexicon, distinct and sorted, are hashed whole and once per random lexicon subset; subsets
of several rates (``SUBSETS``) keep their hash through a few or through many changed terms.
The fingerprint is the row of hashes; two texts are as alike as the share of subsets that one
of them has terms in and that agree.

The band is a share of the documents, so the lexicon has at most (distinct terms of a mean
text) / ``rarest`` terms however large the corpus is. Its measured size decides how terms meet
it: as a constant inside the expression up to ``CONSTANT_TERMS``, by a shuffled join beyond.

Defined results for unusual input: null text is empty. A text without lexicon terms is hashed
over all its terms, one without terms over itself, so equal texts have equal fingerprints
always. An empty table gives no rows. Ids may be null or repeat: rows are ordered by id
descending, nulls last, and by text among equal ids. Other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerweave.llm.common import Scratch, bucket_of, id_buckets, input_bytes

# (bits, subsets): so many disjoint subsets that each keep one lexicon term in 2 ** bits.
SUBSETS = ((3, 4), (5, 8), (7, 16), (9, 32))
CONSTANT_TERMS = 250_000


def terms_of(text: Column) -> Column:
    """Distinct runs of letters and digits, in lower case."""
    return F.array_distinct(
        F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")
    )


def lexicon(docs: DataFrame, text: str = "text", rarest: float = 0.001,
            commonest: float = 0.1) -> DataFrame:
    """``term, df`` for terms in at least 2 and ``rarest``, at most ``commonest`` of all rows,
    as a written table.

    A term in the band has an inverse document frequency of log(1 / commonest) to
    log(1 / rarest).
    """
    total = docs.count()
    counts = (
        docs.select(F.explode(terms_of(F.col(text))).alias("term"))
        .groupBy("term").agg(F.count("*").alias("df"))
    )
    band = counts.where(
        (F.col("df") >= max(2.0, rarest * total)) & (F.col("df") <= max(2.0, commonest * total))
    )
    return Scratch(docs.sparkSession, "lexicon").write("band", band)


def _cell(term: Column, cells: int) -> Column:
    return F.pmod(F.xxhash64(term, F.lit("cell")), F.lit(cells)).cast("int")


class _Band:
    """Finds lexicon terms inside expressions: a term is looked for in its own cell only."""

    def __init__(self, found: DataFrame, size: int):
        self.cells = 1 << max(4, size.bit_length())
        rows = found.select(_cell(F.col("term"), self.cells).alias("cell"), "term").collect()
        cells: list[list[str]] = [[] for _ in range(self.cells)]
        for row in rows:
            cells[row["cell"]].append(row["term"])
        # Folded once while the plan is optimised; rows meet a ready array.
        self.table = F.from_json(F.lit(json.dumps(cells)), "array<array<string>>")

    def keep(self, terms: Column) -> Column:
        return F.filter(
            terms,
            lambda t: F.array_contains(F.element_at(self.table, _cell(t, self.cells) + 1), t),
        )


def _hex(value: Column, digits: int) -> Column:
    return F.lpad(F.lower(F.hex(F.pmod(value, F.lit(1 << (4 * digits))))), digits, "0")


def hashes(kept: Column, terms: Column, text: Column) -> Column:
    """The whole hash and one per subset; null for subsets without a term."""
    whole = (
        F.when(F.size(kept) > 0, F.xxhash64(F.lit("band"), F.sort_array(kept)))
        .when(F.size(terms) > 0, F.xxhash64(F.lit("terms"), F.sort_array(terms)))
        .otherwise(F.xxhash64(F.lit("text"), text))
    )
    return F.array(_hex(whole, 8))


def _subset_of(shift: int, bits: int) -> Callable[[Column], Column]:
    return lambda x: F.shiftrightunsigned(x["h"], shift).bitwiseAND(F.lit((1 << bits) - 1))


def _below(cell: Callable[[Column], Column], count: int) -> Callable[[Column], Column]:
    return lambda x: cell(x) < count


def _equal(cell: Callable[[Column], Column], number: int) -> Callable[[Column], Column]:
    return lambda x: cell(x) == number


def with_hashes(frame: DataFrame, kept: str, terms: str, text: str, into: str) -> DataFrame:
    """Add the array of hashes of the kept terms as column ``into``.

    Each rate first keeps the terms of its subsets together and then takes them apart, so a
    term is looked at a few times and not once per subset.
    """
    marked = F.transform(
        F.sort_array(F.col(kept)),
        lambda t: F.struct(t.alias("term"), F.xxhash64(t, F.lit("subset")).alias("h")),
    )
    frame = frame.withColumn("_marked", marked)
    shift, parts = 0, []
    for number, (bits, count) in enumerate(SUBSETS):
        name = f"_rate{number}"
        cell = _subset_of(shift, bits)
        frame = frame.withColumn(name, F.filter("_marked", _below(cell, count)))
        for i in range(count):
            subset = F.filter(name, _equal(cell, i))
            parts.append(F.when(F.size(subset) > 0, _hex(F.xxhash64(subset), 4)))
        shift += bits
    own = hashes(F.col(kept), F.col(terms), F.col(text))
    rates = [f"_rate{n}" for n in range(len(SUBSETS))]
    return frame.withColumn(into, F.concat(own, F.array(*parts))).drop("_marked", *rates)


def as_text(found: Column) -> Column:
    """Fingerprint as a string: hashes side by side, dots for subsets without a term."""
    return F.array_join(found, "", "....")


def likeness(left: Column, right: Column) -> Column:
    """Share of agreeing hashes among those that at least one side has."""
    agree = F.size(F.filter(F.zip_with(left, right, lambda a, b: a == b), lambda x: x))
    either = F.size(
        F.filter(F.zip_with(left, right, lambda a, b: a.isNotNull() | b.isNotNull()), lambda x: x)
    )
    return agree / either


def _kept_by_join(frame: DataFrame, terms: str, found: DataFrame, into: str) -> DataFrame:
    """Lexicon terms of each row by a shuffled join; ``_row`` names rows and is read from a table."""
    pairs = frame.select("_row", F.explode(terms).alias("term")).join(found.select("term"), "term")
    lists = pairs.groupBy("_row").agg(F.collect_list("term").alias(into))
    return frame.join(lists, "_row", "left").withColumn(
        into, F.coalesce(into, F.slice(terms, 1, 0))
    )


def fingerprints(docs: DataFrame, texts: list[str], lexicon_text: str | None = None,
                 constant_terms: int = CONSTANT_TERMS, found: DataFrame | None = None) -> DataFrame:
    """``docs`` with a column of hashes ``<name>_hashes`` for each text column named."""
    band = lexicon(docs, lexicon_text or texts[0]) if found is None else found
    size = band.count()
    constant = _Band(band, size) if size <= constant_terms else None
    out = docs
    if not constant:  # written, so that both sides of the joins read the same names
        named = docs.withColumn("_row", F.expr("uuid()"))
        out = Scratch(docs.sparkSession, "lexicon-rows").write("named", named)
    for name in texts:
        out = out.withColumn("_terms", terms_of(F.col(name)))
        if constant:
            out = out.withColumn("_kept", constant.keep(F.col("_terms")))
        else:
            out = _kept_by_join(out, "_terms", band, "_kept")
        out = with_hashes(out, "_kept", "_terms", name, f"{name}_hashes").drop("_terms", "_kept")
    return out if constant else out.drop("_row")


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text",
              bucket_bytes: int = 8 << 20) -> tuple[DataFrame, Window]:
    """Rows ``bucket, ghost, id, text, next`` and their window, without a global sort.

    Ids are cut into ranges; the first row of a range is also sent, as a ghost, to the range
    before it in descending order, where it follows the last row. The first row of all follows
    the last of all.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    ids = docs.select(F.col(key).cast("long").alias("id"))
    borders = id_buckets(ids, "id", max(1, -(-input_bytes(docs, text) // bucket_bytes)))
    heads = {
        r["bucket"]: r["head"]
        for r in ids.groupBy(bucket_of(F.col("id"), borders).alias("bucket"))
        .agg(F.max("id").alias("head")).collect()
    }
    own = bucket_of(F.col("id"), borders)
    higher = sorted(heads)  # the head of each range goes to the next higher one, the top's to the lowest
    ghost_of = dict(zip(higher, [*higher[1:], *higher[:1]]))
    at = [(F.lit(heads[b]).cast("long"), ghost_of[b]) for b in higher]
    target = F.lit(None).cast("int")
    if at:
        table = F.array(*(F.struct(h.alias("head"), F.lit(t).alias("to")) for h, t in at))
        match = F.filter(table, lambda x: x["head"].eqNullSafe(F.col("id")))
        target = F.when(F.size(match) > 0, F.element_at(match, 1)["to"])
    places = F.array(
        F.struct(own.alias("bucket"), F.lit(False).alias("ghost")),
        F.struct(target.alias("bucket"), F.lit(True).alias("ghost")),
    )
    placed = rows.select(
        F.explode(F.filter(places, lambda p: p["bucket"].isNotNull())).alias("p"), "id", "text"
    ).select("p.bucket", "p.ghost", "id", "text")
    order = Window.partitionBy("bucket").orderBy("ghost", F.desc_nulls_last("id"), "text")
    return placed.withColumn("next", F.lead("text").over(order)), order


def edited(text: Column, following: Column) -> Column:
    """The text with its last half replaced by the start of the following one."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(
        F.substring(text, F.lit(1), (F.char_length(text) - half).cast("int")),
        F.substring(following, F.lit(1), half),
    )


def compare_with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text",
                       constant_terms: int = CONSTANT_TERMS) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how near the edit and the next are."""
    band = lexicon(docs, text)
    rows, order = with_next(docs, key, text)
    rows = rows.withColumn("edit", F.when(~F.col("ghost"), edited(F.col("text"), F.col("next"))))
    rows = fingerprints(rows.drop("next"), ["text", "edit"], None, constant_terms, band)
    rows = rows.withColumn("next_hashes", F.lead("text_hashes").over(order))
    return rows.where("NOT ghost").select(
        F.col("id").alias(key), F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edit", 256).alias("edited_sha256"),
        as_text(F.col("text_hashes")).alias("fingerprint"),
        as_text(F.col("edit_hashes")).alias("edited_fingerprint"),
        likeness(F.col("text_hashes"), F.col("edit_hashes")).alias("near_edited"),
        likeness(F.col("text_hashes"), F.col("next_hashes")).alias("near_next"),
    )
