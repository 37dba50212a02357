"""Token counts kept as additive totals by source, language and tokenizer version.

Changes are signed: an insert adds a document's tokens, a delete takes them away, a revision
takes the old count away and adds the new one. A batch of changes is summed to one row per key
before anything is shuffled or stored, and written to a folder of its attempt. One empty marker file
names the batch and the attempt; it is created last, and only what a marker names is read, so a
writer lost half-way leaves nothing that counts, on a file system as on an object store.
Committing an id that is there already changes nothing, so a batch can be sent again after any
failure. ``totals`` adds up the committed batches; ``compact`` folds them into a base that
remembers their ids, and removes what it has folded. One committer at a time is assumed.

Defined results for unusual input: null source, language or tokenizer are keys of their own;
null counts are 0; an unknown kind of change is an error when the batch is written; an empty
batch commits and changes nothing; repeated rows count each time; other columns are ignored.
Null texts have 0 tokens.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Callable
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.llm.common import per_batch

KEYS = ("source", "lang", "tokenizer")
CHANGES = ("kind string, source string, lang string, tokenizer string, "
           "tokens bigint, old_tokens bigint")


def signed(changes: DataFrame) -> DataFrame:
    """One row per key: how many documents and tokens the changes add in all."""
    kind = F.col("kind")
    tokens, old = (F.coalesce(F.col(c), F.lit(0)) for c in ("tokens", "old_tokens"))
    documents = (
        F.when(kind == "insert", 1).when(kind == "delete", -1).when(kind == "revise", 0)
        .otherwise(F.raise_error(F.concat(F.lit("unknown change "), F.coalesce(kind, F.lit("null")))))
    )
    amount = F.when(kind == "insert", tokens).when(kind == "delete", -tokens).otherwise(tokens - old)
    return (
        changes.select(*KEYS, documents.cast("bigint").alias("documents"), amount.alias("tokens"))
        .groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    )


class Rollup:
    """The totals below one folder."""

    FIELDS = ("source string, lang string, tokenizer string, documents bigint, tokens bigint")

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        root = self._hadoop.Path(self.folder)
        self._fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        for name in ("batches", "bases", "attempts"):
            self._fs.mkdirs(self._path(name))

    def _path(self, *parts: str):
        return self._hadoop.Path("/".join((self.folder, *parts)))

    def _attempt(self, attempt: str) -> str:
        return f"{self.folder}/attempts/{attempt}"

    def _markers(self, kind: str) -> dict[str, str]:
        """Attempt by name, from file names alone; of two markers of a name the first counts."""
        found: dict[str, str] = {}
        for name in sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(kind))):
            label, _, attempt = name.partition(",")
            if attempt:
                found.setdefault(unquote(label), attempt)
        return found

    def _mark(self, kind: str, name: str, attempt: str) -> None:
        self._fs.create(self._path(kind, f"{quote(name, safe='')},{attempt}"), False).close()

    def _remove(self, kind: str, name: str, attempt: str) -> None:
        """The marker first: data without one counts for nothing."""
        self._fs.delete(self._path(kind, f"{quote(name, safe='')},{attempt}"), False)
        self._fs.delete(self._path("attempts", attempt), True)

    def _base(self) -> tuple[str | None, set[str]]:
        """Attempt of the newest base, and the batches it holds."""
        bases = self._markers("bases")
        if not bases:
            return None, set()
        newest = bases[max(bases)]
        held = self.spark.read.schema("batch string").parquet(f"{self._attempt(newest)}/held").collect()
        return newest, {r["batch"] for r in held}

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch once; false if its id was committed before."""
        if batch in self._markers("batches") or batch in self._base()[1]:
            return False
        attempt = uuid.uuid4().hex
        signed(changes).write.parquet(self._attempt(attempt))
        self._mark("batches", batch, attempt)
        return True

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, documents, tokens`` over all committed batches."""
        base, held = self._base()
        paths = [self._attempt(a) for name, a in self._markers("batches").items() if name not in held]
        if base:
            paths.append(f"{self._attempt(base)}/totals")
        rows = (
            self.spark.read.schema(self.FIELDS).parquet(*paths) if paths
            else self.spark.createDataFrame([], self.FIELDS)
        )
        summed = rows.groupBy(*KEYS).agg(
            F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")
        )
        return summed.where("documents <> 0 OR tokens <> 0")

    def compact(self) -> None:
        """Fold all committed batches into a new base, then remove them and the bases before."""
        _, held = self._base()
        bases, batches = self._markers("bases"), self._markers("batches")
        attempt = uuid.uuid4().hex
        self.totals().write.parquet(f"{self._attempt(attempt)}/totals")
        ids = self.spark.createDataFrame([(b,) for b in sorted(held | set(batches))], "batch string")
        ids.coalesce(1).write.parquet(f"{self._attempt(attempt)}/held")
        self._mark("bases", f"{max(map(int, bases), default=0) + 1:08d}", attempt)
        for name, old in batches.items():
            self._remove("batches", name, old)
        for name, old in bases.items():
            self._remove("bases", name, old)


# Tokenizers by path, loaded once per worker.
_loaded: dict[tuple[str, str], object] = {}


def _encoding(path: str, pattern: str):
    import tiktoken

    if (path, pattern) not in _loaded:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _loaded[path, pattern] = tiktoken.Encoding(
            path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
    return _loaded[path, pattern]


def count_tokens(docs: DataFrame, tokenizers: dict[str, Callable[[], tuple[str, str]]],
                 key: str = "doc_id", text: str = "text", source: str = "source",
                 lang: str = "lang", carry: dict[str, str] | None = None) -> DataFrame:
    """``id, source, lang``, one count per tokenizer version, for every whole text, and the
    columns of ``carry``, given with their type, bigint or string.

    A tokenizer is a function that gives, on the executor, the path of its ranks and the
    pattern that splits a text.
    """
    names, carry = list(tokenizers), carry or {}
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    schema = pa.schema([("id", pa.int64()), ("source", pa.string()), ("lang", pa.string()),
                        *((f"n{i}", pa.int64()) for i in range(len(names))),
                        *((f"c{i}", kinds[t]) for i, t in enumerate(carry.values()))])

    def work(cols):
        out = {"id": cols["id"], "source": cols["source"], "lang": cols["lang"]}
        for i, name in enumerate(names):
            encode = _encoding(*tokenizers[name]()).encode_ordinary
            out[f"n{i}"] = [len(encode(t)) if t else 0 for t in cols["text"]]
        for i in range(len(carry)):
            out[f"c{i}"] = cols[f"c{i}"]
        return out

    rows = docs.select(
        F.col(key).cast("long").alias("id"), F.col(source).cast("string").alias("source"),
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"),
        *(F.col(c).cast(t).alias(f"c{i}") for i, (c, t) in enumerate(carry.items())),
    )
    fields = "id bigint, source string, lang string" + "".join(
        f", n{i} bigint" for i in range(len(names))
    ) + "".join(f", c{i} {t}" for i, t in enumerate(carry.values()))
    counted = rows.mapInArrow(per_batch(work, schema), fields)
    per_tokenizer = F.array(*(
        F.struct(F.lit(name).alias("tokenizer"), F.col(f"n{i}").alias("tokens"))
        for i, name in enumerate(names)
    ))
    return counted.select("id", "source", "lang", per_tokenizer.alias("counts"),
                          *(F.col(f"c{i}").alias(c) for i, c in enumerate(carry)))


def changes(counted: DataFrame, kind: str, old: str | None = None) -> DataFrame:
    """Change rows of one kind from ``count_tokens``; ``old`` names a column with the count
    that a revision replaces."""
    rows = counted.select("source", "lang", F.explode("counts").alias("c"),
                          *([F.col(old).alias("old_tokens")] if old else []))
    return rows.select(
        F.lit(kind).alias("kind"), "source", "lang", "c.tokenizer", "c.tokens",
        F.col("old_tokens").cast("bigint") if old else F.lit(None).cast("bigint").alias("old_tokens"),
    )
