"""Chat formatting from event logs, with DataFrame expressions only.

A log holds one row per event: conversation, sequence number, message, kind, role,
text. ``fold`` turns it into final messages and ``render`` into one string per
conversation with loss spans; ``parse`` reads the string back.

Kinds: ``delta`` appends its text, ``edit`` replaces the message by its text,
``regenerate`` empties the message so that later deltas start over. Any other kind
and a null kind count as ``delta``.

Defined results for unusual input: null text counts as empty; a null role is the
empty role; a null conversation or message id is a group of its own; an event
delivered more than once (all fields equal) is applied once; different events with
one sequence number are applied in the order of kind, role, text; null sequence
numbers come first. An empty log gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"
# Openings of the control strings of common chat templates.
CONTROL = r"<(?=\|)|<(?=/?s>)|\[(?=/?INST\])|<(?=</?SYS>>)"


def escaped(text: Column) -> Column:
    """Break every control string by a backslash after its first character; double backslashes."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), f"({CONTROL})", r"$1\\")


def unescaped(text: Column) -> Column:
    """Inverse of ``escaped``: each backslash stands for the character after it."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold(log: DataFrame, conv: str, seq: str, message: str, kind: str, role: str,
         text: str) -> DataFrame:
    """Final messages ``conv, message, role, text``: one row per conversation and message."""
    events = log.select(
        F.col(conv).alias("conv"), F.col(message).alias("message"),
        F.struct(
            F.col(seq).alias("seq"), F.coalesce(F.col(kind), F.lit("delta")).alias("kind"),
            F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("event"),
    )
    logs = events.groupBy("conv", "message").agg(
        F.array_distinct(F.sort_array(F.collect_list("event"))).alias("log")
    )
    resets = F.filter("log", lambda e: e["kind"].isin("edit", "regenerate"))
    # Position of the last reset: everything before it no longer shows.
    from_reset = F.when(
        F.size(resets) > 0, F.array_position("log", F.element_at(resets, -1))
    ).otherwise(F.lit(1)).cast("int")
    shown = F.expr("slice(log, from_reset, size(log))")
    named = F.filter("log", lambda e: e["role"].isNotNull())
    pieces = F.transform(
        "shown", lambda e: F.when(e["kind"] == "regenerate", F.lit("")).otherwise(e["text"])
    )
    return (
        logs.withColumn("from_reset", from_reset)
        .withColumn("shown", shown)
        .select(
            "conv", "message",
            F.when(F.size(named) > 0, F.element_at(named, -1)["role"])
            .otherwise(F.lit("")).alias("role"),
            F.array_join(pieces, "").alias("text"),
        )
    )


def render(messages: DataFrame) -> DataFrame:
    """``conv, formatted, loss_spans``; a span is the code-point offset and length of an
    assistant body inside ``formatted``, ends excluded."""
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(SEP))
    body = escaped(F.col("text"))
    cut = messages.select("conv", "message", "role", head.alias("head"), body.alias("body"))
    cut = cut.withColumn("piece", F.concat("head", "body", F.lit(END)))
    before = (
        Window.partitionBy("conv").orderBy("message")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = cut.select(
        "conv",
        F.struct(
            "message", "piece",
            (F.coalesce(F.sum(F.char_length("piece")).over(before), F.lit(0))
             + F.char_length("head")).alias("start"),
            F.char_length("body").cast("long").alias("length"),
            (F.col("role") == LOSS_ROLE).alias("learn"),
        ).alias("turn"),
    )
    rows = placed.groupBy("conv").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return rows.select(
        "conv",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(
            F.filter("turns", lambda t: t["learn"]),
            lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")),
        ).alias("loss_spans"),
    )


def format_log(log: DataFrame, conv: str = "conv_id", seq: str = "seq", message: str = "message",
               kind: str = "kind", role: str = "role", text: str = "text") -> DataFrame:
    """Fold a log and render its conversations: ``conv, formatted, loss_spans``."""
    return render(fold(log, conv, seq, message, kind, role, text))


def parse(formatted: Column) -> Column:
    """Turns of a rendered conversation as ``array<struct<role, text>>``, unescaped."""
    pieces = F.filter(F.split(formatted, r"\Q" + END + r"\E"), lambda p: p != "")

    def turn(piece: Column) -> Column:
        sides = F.split(F.substr(piece, F.lit(len(TURN) + 1)), r"\Q" + SEP + r"\E", 2)
        return F.struct(unescaped(sides[0]).alias("role"), unescaped(sides[1]).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """Unescaped text under the loss spans, in order."""
    parts = F.transform(
        spans,
        lambda s: unescaped(
            F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))
        ),
    )
    return F.array_join(parts, "")


def turns_as_log(turns: DataFrame) -> DataFrame:
    """An event log that ends in the given turns: a draft, its regeneration, the text in two
    deltas, and for user turns a final edit. Turns of one conversation are numbered by
    (turn, role, text), so repeated turn numbers and repeated rows stay separate messages."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    half = F.floor(F.char_length(text) / 2).cast("int")
    numbered = turns.select(
        "conv_id", F.row_number().over(order).cast("long").alias("message"), "role",
        text.alias("text"), F.substring(text, F.lit(1), half).alias("first"),
        F.substr(text, half + 1).alias("rest"),
    )

    def event(step: int, kind: str, body: Column) -> Column:
        return F.struct(
            (F.col("message") * 8 + step).alias("seq"), F.lit(kind).alias("kind"),
            body.alias("text"),
        )

    log = F.array(
        event(0, "delta", F.col("first")), event(1, "regenerate", F.lit(None).cast("string")),
        event(2, "delta", F.col("first")), event(3, "delta", F.col("rest")),
    )
    edit = F.when(F.col("role") == "user", F.array(event(4, "edit", F.col("text"))))
    edit = F.coalesce(edit, F.slice(log, 1, 0))
    return numbered.select(
        "conv_id", "message", "role", F.explode(F.concat(log, edit)).alias("e")
    ).select("conv_id", "e.seq", "message", "e.kind", "role", "e.text")
