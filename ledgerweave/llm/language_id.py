"""Language identification by words first and shorter character n-grams after.

A known word adds its log frequency in every language. An unseen word falls back to its
5-grams; if none is known, to its 4-grams, and so on down to single letters. A text's
score is the posterior of the best language under equal priors.

The model is fitted on a bounded sample (``sample_docs`` per language, drawn by a hash of
the id and the text) and keeps every word and n-gram counted there; ``top_words`` and
``top_grams`` can bound its size further. Prediction reads every text whole. Words are letters
with their combining marks; number signs such as a half or a superscript two are none.

Defined results for unusual input: null or letterless text is ``und`` with score 0; a text
whose letters are all unknown gets the first language with an even score; ties go to the
first language in sorted order; with no training rows every text is ``und``. Rows are kept
one for one, repeated rows too. Columns other than id, text and (in training) language
are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from itertools import chain, count, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerweave.llm.common import Scratch

LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*+")
ORDERS = (5, 4, 3, 2, 1)
UNKNOWN = "und"
ROWS = 256  # texts taken at once
TEXT_BYTES = 4 << 20
WORDS = 1 << 17  # words counted before they are handed on


@dataclass(frozen=True)
class Model:
    """Log frequencies: row ``r`` of ``weights`` belongs to the key at ``r`` of ``marked``, which has
    its order (0 for a word) as its first character. Keys stand in the order of their ``hashes``,
    which are all different under this ``seed``. All are flat arrays, on the driver, on the way to
    the tasks and in them."""

    languages: list[str]
    marked: pa.Array
    weights: np.ndarray
    hashes: np.ndarray
    seed: int

    @property
    def keys(self) -> list[tuple[str, int]]:
        return [(k[1:], int(k[0])) for k in self.marked.to_pylist()]


def _grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word with its ends marked; a shorter word has none but n = 1."""
    marked = f"<{word}>" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _hashes(keys: list[str], seed: int) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys, repeat(seed)), np.uint64, len(keys))


def _model(languages: list[str], marked: pa.Array, weights: np.ndarray) -> Model:
    """Keys and weights in the order of hashes, under the first seed that tells all keys apart."""
    for seed in count():
        parts = (marked.slice(i, 1 << 16).to_pylist() for i in range(0, len(marked), 1 << 16))
        hashes = np.concatenate([np.zeros(0, np.uint64), *(_hashes(p, seed) for p in parts)])
        order = np.argsort(hashes)
        hashes = hashes[order]
        if (hashes[1:] != hashes[:-1]).all():
            return Model(languages, marked.take(pa.array(order)), weights[order], hashes, seed)


def _parts(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of at most ``ROWS`` rows and, a single longer text apart, ``TEXT_BYTES``."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
    ends = np.cumsum(np.asarray(sizes), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        most = TEXT_BYTES + (int(ends[start - 1]) if start else 0)
        stop = min(start + ROWS, max(start + 1, int(np.searchsorted(ends, most, "right"))))
        yield batch.slice(start, stop - start)
        start = stop


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts per language, per ``WORDS`` words: the map-side part of the count."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
    counts: dict[str, Counter[str]] = {}

    def counted() -> pa.RecordBatch:
        langs = list(chain.from_iterable(repeat(lang, len(c)) for lang, c in counts.items()))
        words, n = (list(chain.from_iterable(f(c) for c in counts.values())) for f in (Counter.keys, Counter.values))
        counts.clear()
        return pa.RecordBatch.from_pydict({"lang": langs, "word": words, "n": n}, schema=schema)

    for batch in batches:
        for part in _parts(batch, "text"):
            for lang, text in zip(*(part.column(n).to_pylist() for n in ("lang", "text"))):
                counts.setdefault(lang, Counter()).update(LETTERS.findall((text or "").lower()))
            if sum(map(len, counts.values())) > WORDS:
                yield counted()
    yield counted()


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("order", pa.int32()), ("key", pa.string()),
                        ("n", pa.int64())])
    for batch in batches:
        counts: dict[tuple[str, int, str], int] = {}
        for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n"))):
            for order in ORDERS:
                for gram in _grams(word, order):
                    key = (lang, order, gram)
                    counts[key] = counts.get(key, 0) + n
        yield pa.RecordBatch.from_pydict(
            {"lang": [k[0] for k in counts], "order": [k[1] for k in counts],
             "key": [k[2] for k in counts], "n": list(counts.values())}, schema=schema,
        )


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        sample_docs: int = 6_000, top_words: int | None = None,
        top_grams: Mapping[int, int] | None = None) -> Model:
    """Fit on at most about ``sample_docs`` documents of each language.

    ``top_words`` and ``top_grams`` (by order) keep the most frequent keys of each language only;
    without them every counted key is kept.
    """
    known = docs.select(
        F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy("lang").agg(F.count("*").alias("docs"))
    share = F.least(F.lit(1.0), F.lit(float(sample_docs)) / F.col("docs"))
    draw = F.pmod(F.xxhash64(F.col("id"), F.col("text"), F.lit("language sample")), F.lit(1 << 30))
    sample = known.join(F.broadcast(sizes), "lang").where(draw < share * (1 << 30))
    scratch = Scratch(docs.sparkSession, "language-id")
    words = scratch.write(
        "words",
        sample.select("lang", "text")
        .mapInArrow(_count_words, "lang string, word string, n bigint")
        .groupBy("lang", "word").agg(F.sum("n").alias("n")),
    )
    grams = (
        words.mapInArrow(_count_grams, "lang string, order int, key string, n bigint")
        .groupBy("lang", "order", "key").agg(F.sum("n").alias("n"))
    )
    whole = words.select("lang", F.lit(0).alias("order"), F.col("word").alias("key"), "n")
    both = scratch.write("counts", whole.unionByName(grams))
    # The totals come from an aggregation of their own, so that the rank can be cut map-side.
    totals = both.groupBy("lang", "order").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    limits = {0: top_words} | dict(top_grams or {})
    kept = both
    for order, limit in limits.items():
        if limit is not None:
            of_order = F.col("order") == order
            by_count = Window.partitionBy("lang", "order").orderBy(F.desc("n"), "key")
            first = kept.where(of_order).withColumn("place", F.row_number().over(by_count)).where(F.col("place") <= limit)
            kept = kept.where(~of_order).unionByName(first.drop("place"))
    rows = (
        kept.join(F.broadcast(totals), ["lang", "order"])
        .select("lang", "order", F.concat("order", "key").alias("key"), "n", "total", "kinds").toArrow()
    )
    scratch.drop("words", "counts")
    languages = sorted(rows.column("lang").unique().to_pylist())
    known_as = pa.array(languages, pa.string())
    number = np.asarray(pc.index_in(rows.column("lang"), known_as), np.int64)
    order, n, total, kinds = (np.asarray(rows.column(c)) for c in ("order", "n", "total", "kinds"))
    below = total + 0.5 * (kinds + 1)
    # What a language gives a key of an order that it does not have itself.
    floors = np.zeros((max(ORDERS) + 1, len(languages)), np.float64)
    floors[order, number] = np.log(0.5 / below)
    marked = rows.column("key").combine_chunks().dictionary_encode()
    place = np.asarray(marked.indices, np.int64)
    order_of = np.zeros(len(marked.dictionary), np.int64)
    order_of[place] = order
    weights = floors[order_of].astype(np.float32)
    weights[place, number] = np.log((n + 0.5) / below)
    return _model(languages, marked.dictionary, weights)


class _Scorer:
    """One task's view of the model, whose arrays it reads in place. Words met are remembered as
    rows of one growing table, which starts with an all-zero row for words that match nothing."""

    REMEMBERED = 100_000

    def __init__(self, model: Model):
        self.model = model
        self.languages = model.languages
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.table = np.zeros((1 << 12, max(1, len(self.languages))), np.float32)

    def rows_of(self, keys: list[str]) -> np.ndarray:
        """Row of each key in the model, -1 for a key that it does not have."""
        rows = np.full(len(keys), -1, np.int64)
        if len(self.model.hashes):
            own = _hashes(keys, self.model.seed)
            at = np.minimum(np.searchsorted(self.model.hashes, own), len(self.model.hashes) - 1)
            like = np.flatnonzero(self.model.hashes[at] == own)
            found = self.model.marked.take(pa.array(at[like]))
            same = np.asarray(pc.equal(found, pa.array([keys[i] for i in like], found.type)), bool)
            rows[like[same]] = at[like[same]]
        return rows

    def weights_of(self, words: list[str]) -> np.ndarray:
        """Each word's own log frequencies, or the mean over its longest known n-grams."""
        weights = self.model.weights
        found = np.zeros((len(words), self.table.shape[1]), np.float32)
        rows = self.rows_of([f"0{w}" for w in words])
        own = rows >= 0
        found[own] = weights[rows[own]]
        left = np.flatnonzero(~own).tolist()
        for order in ORDERS:
            grams = [[f"{order}{g}" for g in _grams(words[i], order)] for i in left]
            rows = self.rows_of(list(chain.from_iterable(grams)))
            unknown, end = [], 0
            for i, own in zip(left, map(len, grams)):
                known = rows[end : end + own]
                known = known[known >= 0]
                end += own
                if len(known):
                    found[i] = weights[known].mean(axis=0)
                else:
                    unknown.append(i)
            left = unknown
        return found

    def weight_of(self, word: str) -> np.ndarray:
        return self.weights_of([word])[0]

    def learn(self, words: set[str]) -> None:
        if len(self.known) > self.REMEMBERED:
            self.forget()
        fresh = [w for w in words if w not in self.known]
        first = len(self.known) + 1
        while first + len(fresh) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[first : first + len(fresh)] = self.weights_of(fresh)
        self.known.update(zip(fresh, range(first, first + len(fresh))))

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        words = [LETTERS.findall((t or "").lower()) for t in texts]
        self.learn(set().union(*words))
        return [self._best(w) if w else (UNKNOWN, 0.0) for w in words]

    def _best(self, words: list[str]) -> tuple[str, float]:
        rows = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        total = self.table[rows].sum(axis=0, dtype=np.float64)
        best = int(total.argmax())
        return self.languages[best], float(1.0 / np.exp(total - total[best]).sum())

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([(key, pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def work(batches):
        scorer = _Scorer(shared.value)
        for batch in batches:
            for part in _parts(batch, "text"):
                found = scorer.predict_all(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([f[0] for f in found], pa.string()),
                     pa.array([f[1] for f in found], pa.float64())], schema=schema,
                )

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        work, f"`{key}` bigint, lang_pred string, score double"
    )


def keep_known(docs: DataFrame, model: Model, least_score: float, text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text has no language or a score below ``least_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        scorer = _Scorer(shared.value)
        for batch in batches:
            for part in _parts(batch, text):
                found = scorer.predict_all(part.column(text).to_pylist())
                yield part.filter(pa.array([n != UNKNOWN and s >= least_score for n, s in found], pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
