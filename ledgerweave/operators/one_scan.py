"""Many counts over many tables: one scan per table, one count for all of them.

A row of a table hands out the parts of questions that it takes part in, and its keys. Rows with
keys are dealt out to bounded tasks; there each part becomes one small tagged key: a key to be
counted, a key of a referencing or a referenced side, or nothing but the tag where a condition
holds. The tagged keys of all tables are counted together, with map-side combination, so a value that a
third of all rows hold is one row per task before it is shuffled for counting. What a question wants
to know follows from its groups.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.operators.union import union_all


@dataclass(frozen=True)
class Part:
    """What a table contributes to a question: keys, where, and on which side; all as SQL."""

    table: str
    keys: Sequence[str] = ()
    where: str | None = None
    other: bool = False


@dataclass(frozen=True)
class Question:
    """A number summed over the groups of its parts.

    ``answer`` is the share of one group, as SQL over its rows ``n``, the rows of the other side
    ``m``, and ``open``, whether a part of the key is null.
    """

    name: str
    parts: Sequence[Part]
    answer: str = "n"


def holds(name: str, table: str, where: str) -> Question:
    """Rows of a table that meet a condition."""
    return Question(name, (Part(table, where=where),))


def spare_rows(name: str, table: str, keys: Sequence[str]) -> Question:
    """Rows beyond the first of every key; all rows without a full key."""
    return Question(name, (Part(table, keys),), "n - IF(open, 0, 1)")


def repeated_keys(name: str, table: str, keys: Sequence[str], open_too: bool = False) -> Question:
    """Keys held by more than one row."""
    return Question(name, (Part(table, keys),), "IF(n > 1, 1, 0)" if open_too else "IF(n > 1 AND NOT open, 1, 0)")


def groups(name: str, table: str, keys: Sequence[str], having: str, where: str | None = None) -> Question:
    """Keys whose number of rows ``n`` meets a condition."""
    return Question(name, (Part(table, keys, where),), f"IF({having}, 1, 0)")


def orphans(
    name: str, table: str, keys: Sequence[str], other: str, other_keys: Sequence[str],
    where: str | None = None, open_counts: bool = True,
) -> Question:
    """Rows without a partner in another table; a key with a null has none, or is left out."""
    lost = f"CASE WHEN open THEN {'n' if open_counts else '0'} WHEN m = 0 THEN n ELSE 0 END"
    return Question(name, (Part(table, keys, where), Part(other, other_keys, other=True)), lost)


def _taken(parts: Sequence[tuple[int, Part]], keys: Sequence[str], width: int) -> list[str]:
    """SQL of what a row of a table hands out: the parts that it takes part in, and each key once."""
    marks = [f"IF({p.where}, {number}, NULL)" if p.where else f"CAST({number} AS INT)" for number, p in parts]
    told = f"filter(array({', '.join(marks)}), t -> t IS NOT NULL) AS told"
    texts = [f"CAST(({k}) AS STRING) AS c{i}" for i, k in enumerate(keys)]
    return [told, *texts, *[f"CAST(NULL AS STRING) AS c{i}" for i in range(len(keys), width)]]


def _chosen(of_part: Mapping[int, str], default: str) -> str:
    """SQL of a value that depends on the part; parts of one value are listed together."""
    alike: dict[str, list[str]] = {}
    for number, value in of_part.items():
        alike.setdefault(value, []).append(str(number))
    alike.pop(default, None)
    cases = " ".join(f"WHEN part IN ({', '.join(numbers)}) THEN {value}" for value, numbers in alike.items())
    return f"CASE {cases} ELSE {default} END" if cases else default


def _dealt_out(handed: DataFrame, width: int) -> DataFrame:
    """Rows of equal keys together, in as many tasks as the session asks of a shuffle.

    A task that reads a few MB may hold millions of short rows, each with several keys; counted
    where they are read, its keys would all be in memory at once.
    """
    tasks = int(handed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return handed.repartition(tasks, *[f"c{i}" for i in range(width)])


def answers(tables: Mapping[str, DataFrame], questions: Sequence[Question]) -> DataFrame:
    """(name, observed) of every question; each table is read once."""
    spark = next(iter(tables.values())).sparkSession
    parts = [(tag, part) for tag, question in enumerate(questions) for part in question.parts]
    by_table: dict[str, list[tuple[int, Part]]] = {}
    for number, (_, part) in enumerate(parts):
        by_table.setdefault(part.table, []).append((number, part))
    keys_of = {name: list(dict.fromkeys(k for _, p in held for k in p.keys)) for name, held in by_table.items()}
    width = max(map(len, keys_of.values()), default=0)
    handed = {name: tables[name].selectExpr(*_taken(held, keys_of[name], width)) for name, held in by_table.items()}
    with_keys = [df for name, df in handed.items() if keys_of[name]]
    plain = [df for name, df in handed.items() if not keys_of[name]]
    rows = union_all(([_dealt_out(union_all(with_keys), width)] if with_keys else []) + plain)

    # Which column holds which key of a part.
    held = [[f"c{keys_of[part.table].index(k)}" for k in part.keys] for _, part in parts]
    longest = max(map(len, held), default=0)
    names = [f"k{i}" for i in range(longest)]
    null = "CAST(NULL AS STRING)"
    keyed = rows.selectExpr("explode(told) AS part", *[f"c{i}" for i in range(width)]).selectExpr(
        _chosen({n: f"{tag}" for n, (tag, _) in enumerate(parts)}, "NULL") + " AS tag",
        _chosen({n: str(p.other).lower() for n, (_, p) in enumerate(parts)}, "false") + " AS other",
        _chosen({n: " OR ".join(f"{c} IS NULL" for c in columns) or "false" for n, columns in enumerate(held)}, "false")
        + " AS open",
        *[
            _chosen({n: columns[i] if i < len(columns) else null for n, columns in enumerate(held)}, null) + f" AS {k}"
            for i, k in enumerate(names)
        ],
    )
    grouped = keyed.groupBy("tag", "open", *names).agg(
        F.expr("count_if(NOT other) AS n"), F.expr("count_if(other) AS m")
    )
    # Questions of one kind have equal answers, so the choice is short.
    kinds: dict[str, list[str]] = {}
    for tag, question in enumerate(questions):
        kinds.setdefault(question.answer, []).append(str(tag))
    choice = " ".join(f"WHEN tag IN ({', '.join(tags)}) THEN {answer}" for answer, tags in kinds.items())
    counted = grouped.groupBy("tag").agg(F.expr(f"sum(CAST(CASE {choice} END AS BIGINT)) AS observed"))
    # One row per question: bounded by the catalogue, not by the data.
    asked = spark.createDataFrame([(i, q.name) for i, q in enumerate(questions)], "tag int, name string")
    return F.broadcast(asked).join(counted, "tag", "left").groupBy("name").agg(
        F.expr("CAST(sum(coalesce(observed, 0)) AS BIGINT) AS observed")
    )
