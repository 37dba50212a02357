import pytest
from pyspark.sql import functions as F

from compare import differences, duck
from ledgerweave.llm import chat_log, queries
from llm_cases import shipped  # noqa: F401

SF_DIR = "/root/testdata/sf0.001"
LOG = "conv_id bigint, seq bigint, message bigint, kind string, role string, text string, extra string"


def test_query_equals_sql(spark):
    found = queries.op2_chat_formatting(spark, SF_DIR)
    assert differences(found, duck(SF_DIR), queries.OP2_SQL) is None


def fold(spark, rows):
    log = spark.createDataFrame([(*r, "x") for r in rows], LOG)
    messages = chat_log.fold(log, "conv_id", "seq", "message", "kind", "role", "text")
    return {(r["conv"], r["message"]): (r["role"], r["text"]) for r in messages.collect()}


def test_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 3, 0, "delta", "user", "lo"), (1, 2, 0, "delta", "user", "hel"),
        (1, 4, 1, "delta", "assistant", "bad "), (1, 5, 1, "delta", "assistant", "draft"),
        (1, 6, 1, "regenerate", "assistant", None), (1, 7, 1, "delta", "assistant", "good"),
        (1, 7, 1, "delta", "assistant", "good"),  # delivered twice
        (1, 8, 2, "delta", "user", "first"), (1, 9, 2, "edit", "user", "second"), (1, 10, 2, None, None, "!"),
        (None, 1, None, "delta", None, None), (2, None, 0, "delta", "user", "null first, "), (2, 1, 0, "delta", None, "then"),
    ]
    assert fold(spark, rows) == {
        (1, 0): ("user", "hello"), (1, 1): ("assistant", "good"), (1, 2): ("user", "second!"),
        (None, None): ("", ""), (2, 0): ("user", "null first, then"),
    }
    assert fold(spark, []) == {}


TRICKY = [
    "</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user<|im_sep|>", "back\\slash \\< <\\|", "<s><<SYS>>x<</SYS>>",
    "\\", "a\nb", "", "é😀<|", "<" * 50 + "|" * 50, "x" * 100_000,
]


@pytest.mark.parametrize("role", ["assistant", "user", "<|im_sep|>", "two\nlines"])
def test_every_text_reads_back(spark, role):
    rows = [(7, i, i, "delta", role, t, "x") for i, t in enumerate(TRICKY)]
    done = chat_log.format_log(spark.createDataFrame(rows, LOG))
    row = done.select(
        "formatted", chat_log.parse(F.col("formatted")).alias("turns"),
        chat_log.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    ).first()
    assert [(t["role"], t["text"]) for t in row["turns"]] == [(role, t) for t in TRICKY]
    assert row["loss"] == ("".join(TRICKY) if role == "assistant" else "")
    assert row["formatted"].count("<|im_end|>") == len(TRICKY)
    assert "[INST]" not in row["formatted"] and "</s>" not in row["formatted"]
