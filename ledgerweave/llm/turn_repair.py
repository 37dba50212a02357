"""Repair of the turn structure of conversations by Knuth's lightest derivation.

Rows are taken by (turn, role, text), nulls first. A row's first fault counts: *blank* (nothing
but ASCII blanks), *duplicate* (role and text seen earlier), *truncated* (the last character that
is not blank is none of ``.!?``). Edits: Keep costs 0, Rerole to user or assistant 1, Delete 2 (the
only one for blank and duplicate rows), Insert of an empty user or assistant turn anywhere 5; a
truncated row that stays adds 5. The repaired role initials must read ``(s?(ua)+)?``. Of the
cheapest repairs the one whose edit initials (K, R, D, I) are least in ASCII order is taken.

The repair is a weighted deduction. An item (i, q) says that the first i rows can be repaired so
that the grammar stands in state q; every row is an axiom of weight (0, ""); the rules

    (i, q), row i  =>  (i + 1, q')   by Keep, Rerole or Delete
    (i, q)         =>  (i, q')       by Insert
    (n, q)         =>  goal          if q accepts

add their cost and their letter to the weight (cost, audit). Weights only grow, and of two weights of
an item with equal cost neither audit begins with the other, so the rules are monotone and
superior, and the agenda, popped by least weight, has the right weight of an item when it pops it
first. It stops when the goal pops.

No conversation has to fit into a task: rows are range-partitioned by (conversation, turn, role,
beginning of the text) and sorted; a task reads its range as a stream and cuts it into pieces of
at most ``PIECE_ROWS`` distinct rows or ``PIECE_BYTES`` of text. A conversation that lies in one
piece is decided there. A piece whose conversation goes on elsewhere carries the lightest weight from
every state to every state; the pieces of such a conversation are chained by the same agenda, on
costs and letters only. Rows equal in all columns are counted before they are moved, so a row
repeated without end is one row with a number. What a single task must hold of a conversation is
its audit, as that is one string of the result.

Defined results for unusual input: null role and null text are one space; a null turn comes first;
a null conversation is one conversation; an empty role has no initial and cannot be kept; repeated
rows are duplicates; a conversation given only by ``ids`` has zeros and an empty audit; an empty
table has no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import Scratch, input_bytes

START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTS = (START, ASSISTANT)
# Where each initial leads, by state: the automaton of (s?(ua)+)?
NEXT = (
    {"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER},
)
LEGAL = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
PIECE_ROWS, PIECE_BYTES, HEAD = 4096, 4 << 20, 64
RANGE_BYTES = 64 << 20
ROLES = {USER: "user", ASSISTANT: "assistant"}
_SEEN = re.compile(r"[^\x20\x09-\x0D]")

Row = tuple[str, str, int]  # initial, fault of its first copy, copies


def lightest(rows: tuple[Row, ...], start: int, to_goal: bool) -> dict[int, tuple[int, str]]:
    """Weight of every state after all rows; with ``to_goal`` only the lightest accepting one."""
    found: dict[tuple[int, int], tuple[int, str]] = {}
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    last = len(rows)
    while agenda:
        cost, audit, i, state = heapq.heappop(agenda)
        if (i, state) in found:
            continue
        found[i, state] = cost, audit
        if i == last and to_goal and state in ACCEPTS:
            return {state: (cost, audit)}
        for initial, after in NEXT[state].items():
            if initial != "s":
                heapq.heappush(agenda, (cost + INSERT, audit + "I", i, after))
        if i == last:
            continue
        initial, fault, copies = rows[i]
        # All copies behind the first one are duplicates; an insertion among them is never least.
        more, letters = DELETE * (copies - 1), "D" * (copies - 1)
        heapq.heappush(agenda, (cost + DELETE + more, audit + "D" + letters, i + 1, state))
        if fault in ("b", "d"):
            continue
        more += TRUNCATED * (fault == "t")
        for letter, after in NEXT[state].items():
            if letter == initial:
                heapq.heappush(agenda, (cost + KEEP + more, audit + "K" + letters, i + 1, after))
            if letter != "s":
                heapq.heappush(agenda, (cost + REROLE + more, audit + "R" + letters, i + 1, after))
    return {state: weight for (i, state), weight in found.items() if i == last}


# Most conversations are short, and few shapes of them are frequent.
_short = lru_cache(maxsize=20_000)(lightest)


def replay(audit: str, state: int, rows: Iterator[tuple[str, str, int]]) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired rows, from (role, text, copies) and the letters."""
    role, text, copies = "", "", 0
    for letter in audit:
        if letter == "I":
            state = USER if state in (START, SYSTEM, ASSISTANT) else ASSISTANT
            yield ROLES[state], ""
            continue
        if not copies:
            role, text, copies = next(rows)
        copies -= 1
        if letter == "K":
            state = NEXT[state][role[0]]
            yield role, text
        elif letter == "R":
            state = USER if state != USER else ASSISTANT
            yield ROLES[state], text


_SPAN = pa.struct([("from", pa.int32()), ("to", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_NUMBERS = ("blank", "duplicate", "truncated", "illegal", "turns")
_PIECE = "seq bigint, whole boolean, least bigint, most bigint, opens string, closes string, " + ", ".join(
    f"{n} bigint" for n in _NUMBERS
) + (", roles array<string>, texts array<string>, copies array<bigint>, "
     "spans array<struct<`from`: int, `to`: int, cost: bigint, audit: string>>")


class _Piece:
    """Rows of one conversation that follow each other in a range."""

    def __init__(self, conv: object, opening: bool):
        self.conv, self.opening = conv, opening  # opening: the conversation begins here
        self.rows: list[Row] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.bytes = 0
        self.numbers = dict.fromkeys(_NUMBERS, 0)
        self.least = self.most = None

    def add(self, turn: int | None, role: str, text: str, copies: int, repeats: bool) -> None:
        seen = _SEEN.search(text)
        if not seen:
            fault, name = "b", "blank"
        elif repeats:
            fault, name = "d", "duplicate"
        else:
            fault, name = ("", "") if text.rstrip(" \t\n\x0b\x0c\r")[-1] in ".!?" else ("t", "truncated")
        if name:
            self.numbers[name] += copies if name != "truncated" else 1
        if fault in ("", "t"):
            self.numbers["duplicate"] += copies - 1
        if turn is not None and turn != self.most:
            self.numbers["turns"] += 1
            self.least, self.most = turn if self.least is None else self.least, turn
        initial = role[:1]
        if self.rows:
            self.numbers["illegal"] += self.rows[-1][0] + initial not in LEGAL
        self.numbers["illegal"] += copies - 1
        self.rows.append((initial, fault, copies))
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(text)

    @property
    def full(self) -> bool:
        return len(self.rows) >= PIECE_ROWS or self.bytes >= PIECE_BYTES

    def row(self, seq: int, whole: bool) -> dict[str, object]:
        rows = tuple(self.rows)
        work = _short if len(rows) <= 64 else lightest
        spans = [
            {"from": start, "to": state, "cost": cost, "audit": audit}
            for start in ((START,) if self.opening else range(4))
            for state, (cost, audit) in sorted(work(rows, start, whole).items())
        ]
        return {
            "conv": self.conv, "seq": seq, "whole": whole, "least": self.least, "most": self.most,
            "opens": self.rows[0][0], "closes": self.rows[-1][0], **self.numbers, "roles": self.roles,
            "texts": self.texts, "copies": [r[2] for r in self.rows], "spans": spans,
        }


def _cut(kind: pa.DataType):
    """Mapper of a sorted range to its pieces."""
    schema = pa.schema([
        ("conv", kind), ("seq", pa.int64()), ("whole", pa.bool_()), ("least", pa.int64()), ("most", pa.int64()),
        ("opens", pa.string()), ("closes", pa.string()), *((n, pa.int64()) for n in _NUMBERS),
        ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("copies", pa.list_(pa.int64())),
        ("spans", pa.list_(_SPAN)),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = TaskContext.get().partitionId() << 33
        held: list[dict[str, object]] = []
        weight = 0
        piece: _Piece | None = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "copies", "repeats")]
            for conv, *rest in zip(*columns):
                goes_on = piece is not None and piece.conv == conv
                if piece is None:
                    piece = _Piece(conv, False)
                elif not goes_on or piece.full:
                    held.append(piece.row(seq, not goes_on and piece.opening))
                    weight += piece.bytes + 64 * len(piece.rows)
                    seq += 1
                    piece = _Piece(conv, not goes_on)
                piece.add(*rest)
                if weight > PIECE_BYTES:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)
                    held, weight = [], 0
        if piece is not None:
            held.append(piece.row(seq, False))
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    return run


def _chain(table: pa.Table) -> pa.Table:
    """Pieces of one conversation, chained: what each of them must do, and the sums."""
    table = table.sort_by("seq")
    pieces = table.to_pylist()
    spans = [{} for _ in pieces]
    for held, piece in zip(spans, pieces):
        for s in piece["spans"]:
            held.setdefault(s["from"], []).append((s["to"], s["cost"], s["audit"]))
    # A conversation may begin where its range begins, so the first piece has all four states.
    found: dict[tuple[int, int], tuple[int, str]] = {}
    back: dict[tuple[int, int], tuple[int, str]] = {}
    agenda = [(0, "", 0, START, -1, "")]
    goal = None
    while agenda:
        cost, audit, i, state, before, letters = heapq.heappop(agenda)
        if (i, state) in found:
            continue
        found[i, state], back[i, state] = (cost, audit), (before, letters)
        if i == len(pieces):
            if state in ACCEPTS:
                goal = state
                break
            continue
        for to, more, part in spans[i].get(state, ()):
            heapq.heappush(agenda, (cost + more, audit + part, i + 1, to, state, part))
    chosen, state = [], goal
    for i in range(len(pieces), 0, -1):
        before, letters = back[i, state]
        chosen.append((before, letters))
        state = before
    chosen.reverse()
    sums = {n: sum(p[n] for p in pieces) for n in _NUMBERS}
    for left, right in zip(pieces, pieces[1:]):
        sums["illegal"] += left["closes"] + right["opens"] not in LEGAL
    reached = None
    for p in pieces:  # a turn that two pieces share was counted in both
        sums["turns"] -= p["least"] is not None and p["least"] == reached
        reached = p["most"] if p["most"] is not None else reached
    least = min((p["least"] for p in pieces if p["least"] is not None), default=None)
    cost, audit = found[len(pieces), goal]
    head = pa.array([True] + [False] * (len(pieces) - 1))
    return pa.table({
        "conv": table.column("conv"), "seq": table.column("seq"), "head": head,
        "from": pa.array([c[0] for c in chosen], pa.int32()), "letters": pa.array([c[1] for c in chosen], pa.string()),
        "least": pa.array([least] * len(pieces), pa.int64()), "most": pa.array([reached] * len(pieces), pa.int64()),
        **{n: pa.array([sums[n]] * len(pieces), pa.int64()) for n in _NUMBERS},
        "cost": pa.array([cost] * len(pieces), pa.int64()),
        "audit": pa.array([audit] + [None] * (len(pieces) - 1), pa.string()),
    })


_REPAIRED = "seq bigint, place bigint, role string, text string"


def _replayed(kind: pa.DataType):
    schema = pa.schema([("conv", kind), ("seq", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in schema.names}
            for row in range(batch.num_rows):
                p = {n: batch.column(n)[row].as_py() for n in batch.schema.names}
                lines = zip(p["roles"], p["texts"], p["copies"])
                for place, (role, text) in enumerate(replay(p["letters"], p["from"], lines)):
                    for n, v in zip(schema.names, (p["conv"], p["seq"], place, role, text)):
                        out[n].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return run


def repair(turns: DataFrame, ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Report and repaired rows of conversations with columns conv_id, turn, role, text.

    The report has one row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit; ``ids`` may name conversations that have no rows. The repaired rows have conv_id,
    seq, place, role, text and stand in the order of (seq, place).
    """
    spark = turns.sparkSession
    scratch = Scratch(spark, "turn-repair")
    kind = turns.schema["conv_id"].dataType.simpleString()
    # Equal rows are counted where they lie, so only different ones are moved.
    cells = scratch.write("cells", turns.select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")),
    ).groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies")))
    # The first row of each role and text that comes at several turns.
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    text = ["conv", "role", "text"]
    firsts = scratch.write("firsts", cells.groupBy(*text).agg(
        F.min(at).alias("first"), F.count("*").alias("rows")
    ).where("rows > 1").drop("rows"))
    same = [cells["conv"].eqNullSafe(firsts["conv"]), cells["role"] == firsts["role"], cells["text"] == firsts["text"]]
    lines = cells.join(firsts, same, "left").select(
        *(cells[c] for c in ("conv", "turn", "role", "text", "copies")),
        F.coalesce(F.col("first") < F.struct(cells["turn"].isNotNull().alias("known"), cells["turn"]), F.lit(False)).alias("repeats"),
    )
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(input_bytes(turns) / RANGE_BYTES))
    lines = lines.withColumn("head", F.substring("text", 1, HEAD))
    lines = lines.repartitionByRange(ranges, "conv", "turn", "role", "head")
    lines = lines.sortWithinPartitions("conv", "turn", "role", "head", "text").drop("head")
    arrow = _arrow(kind)
    pieces = scratch.write("pieces", lines.mapInArrow(_cut(arrow), f"conv {kind}, {_PIECE}"))

    whole = pieces.where("whole").select(
        "conv", "seq", F.lit(True).alias("head"), F.col("spans")[0]["from"].alias("from"),
        F.col("spans")[0]["audit"].alias("letters"), "least", "most", *_NUMBERS,
        F.col("spans")[0]["cost"].alias("cost"), F.col("spans")[0]["audit"].alias("audit"),
    )
    numbers = ", ".join(f"{n} bigint" for n in _NUMBERS)
    decided = (f"conv {kind}, seq bigint, head boolean, `from` int, letters string, least bigint, most bigint, "
               f"{numbers}, cost bigint, audit string")
    chained = pieces.where("NOT whole").drop("roles", "texts", "copies", "whole").groupBy("conv").applyInArrow(_chain, decided)
    decisions = scratch.write("decisions", whole.unionByName(chained))

    span = F.when(F.col("most").isNull(), 0).otherwise(F.col("most") - F.col("least") + 1 - F.col("turns"))
    report = decisions.where("head").select(
        F.col("conv").alias("conv_id"), span.cast("bigint").alias("gaps"), "blank", "duplicate", "truncated",
        "illegal", "cost", "audit",
    )
    if ids is not None:
        known = ids.select(F.col("conv_id").alias("id")).distinct()
        numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
        report = known.join(report, F.col("id").eqNullSafe(report["conv_id"]), "left").select(
            F.col("id").alias("conv_id"), *(F.coalesce(F.col(n), F.lit(0).cast("bigint")).alias(n) for n in numbers),
            F.coalesce("audit", F.lit("")).alias("audit"),
        )
    told = pieces.select("seq", "conv", "roles", "texts", "copies").join(decisions.select("seq", "from", "letters"), "seq")
    rows = told.mapInArrow(_replayed(arrow), f"conv {kind}, {_REPAIRED}").withColumnRenamed("conv", "conv_id")
    return report, rows


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def digests(rows: DataFrame) -> DataFrame:
    """conv_id and SHA-256 of its repaired ``role:text`` lines, joined by newlines.

    The digest of a conversation is made in one pass over its sorted rows, as a stream.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = pa.schema([("conv_id", _arrow(kind)), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None
        for batch in batches:
            done: list[tuple[object, str]] = []
            for now, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if digest is None or now != conv:
                    if digest is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = now, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], schema.field(i).type) for i in (0, 1)], schema=schema)
        if digest is not None:
            yield pa.RecordBatch.from_pydict({"conv_id": [conv], "repaired_sha256": [digest.hexdigest()]}, schema=schema)

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "place")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """Rows damaged by crc32 of ``conversation:turn``: see the query op13."""
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    return rows.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
