"""Context-tree weighting over bytes, trained on a corpus and then frozen.

Each byte is eight binary decisions. For every decision the contexts of the last 0 .. ``DEPTH``
bytes form a tree; a node keeps how often a zero and a one followed. The Krichevsky-Trofimov
estimate of a node and the product over its children are mixed half and half from the leaves
up, which weighs all depths by how well they code the training text. The counts fix the whole
tree, so training is one aggregation, and coding a byte is a look-up of its (context, byte)
pair. A context that training never saw takes its longest seen ending.

``score`` cuts the documents into blocks. A block lists its distinct pairs and words; they are
counted over all training blocks, the trees are built per group of contexts, and each block
gets back the values of the pairs it listed, so no task and no executor holds the model.

A text is scored as its words (A-Z in lower case) with one blank between them and one line
break as its end, the same events that the word model of ``base_score`` predicts; it starts
in the context of line breaks. Defined results for unusual input: null and blank texts are an
end alone; repeated rows are scored, and counted, once each; with no training rows every
binary decision costs one bit and the word model is even; null ids are scored and kept, and
their block is drawn from the null's hash. Columns other than id, text and the training flag
are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import Scratch, input_bytes, words_of

DEPTH = 5
END = b"\n"
HALF = float(np.log(0.5))
PREFIX = 2  # context bytes that stay together when trees are built
_CHUNK = 1 << 20  # pairs sorted at once
_WAITING = 2 << 20  # distinct keys of sorted chunks that wait to be added up
_WORDS = 1 << 17  # distinct words of a block held as text
_ROWS = 1 << 16  # keys of a block handed to Spark at once


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series at x + 8, brought back by the recurrence; x > 0."""
    y = x + 8.0
    head = np.ones_like(y)
    for k in range(8):
        head = head * (x + k)
    series = 1.0 / (12.0 * y) - 1.0 / (360.0 * y**3) + 1.0 / (1260.0 * y**5) - 1.0 / (1680.0 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(head)


def kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability of a sequence with these counts under the KT estimator."""
    return (
        log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0)
        - np.log(np.pi)
    )


def mixed(own: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Weighted log probability of a node from its own estimate and its children's product."""
    return np.logaddexp(HALF + own, HALF + below)


def pairs_of(data: bytes) -> Iterator[np.ndarray]:
    """(context, byte) pairs of a text as numbers: nearest context byte first, byte last. A long
    text gives several arrays."""
    for start in range(0, len(data), _CHUNK):
        part = data[start : start + _CHUNK]
        # Eight bytes up to and with each byte, read in place as one little-endian number.
        before = data[max(0, start - 7) : start].rjust(7, END)
        last = np.ndarray((len(part),), "<u8", before + part, strides=(1,))
        window = last >> np.uint64(8 * (7 - DEPTH))
        context = window & np.uint64((1 << 8 * DEPTH) - 1)
        yield ((context << np.uint64(8)) | (window >> np.uint64(8 * DEPTH))).view(np.int64)


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Place of the first of each run of equal keys."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


class Trees:
    """Nodes of depth ``PREFIX`` .. ``DEPTH`` for whole groups of contexts.

    ``keys`` are all distinct pairs of the groups in ascending order, ``counts`` how often
    training saw them (zero for pairs that only other texts have).
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        # Per depth: pairs (context << 8 | byte), their counts, and each pair's place one depth up.
        self.pairs = {DEPTH: keys}
        self.counts = {DEPTH: counts.astype(np.float64)}
        self.up: dict[int, np.ndarray] = {}
        for depth in range(DEPTH - 1, PREFIX - 1, -1):
            deeper = self.pairs[depth + 1]
            shorter = ((deeper >> 16) << 8) | (deeper & 255)
            self.pairs[depth], place = np.unique(shorter, return_inverse=True)
            self.up[depth + 1] = place
            self.counts[depth] = np.bincount(place, self.counts[depth + 1], len(self.pairs[depth]))

    def nodes(self, bit: int) -> dict[int, tuple[np.ndarray, ...]]:
        """Per depth, for the ``bit``-th decision: node of each pair, first pair of each node,
        zeros, ones, log estimate, log weighted probability."""
        out: dict[int, tuple[np.ndarray, ...]] = {}
        for depth in range(DEPTH, PREFIX - 1, -1):
            pairs, counts = self.pairs[depth], self.counts[depth]
            names = pairs >> (8 - bit)
            first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
            node = np.zeros(len(pairs), np.int64)
            node[first[1:]] = 1
            node = np.cumsum(node)
            one = (pairs >> (7 - bit)) & 1
            ones = np.bincount(node, counts * one, len(first))
            zeros = np.bincount(node, counts * (1 - one), len(first))
            own = kt(zeros, ones)
            if depth == DEPTH:
                weighted = own
            else:
                _, deep_first, _, _, _, deep = out[depth + 1]
                parent = node[self.up[depth + 1][deep_first]]
                weighted = mixed(own, np.bincount(parent, deep, len(first)))
            out[depth] = (node, first, zeros, ones, own, weighted)
        return out

    def tops(self) -> dict[str, np.ndarray]:
        """Depth ``PREFIX`` nodes: nearest byte, decision, zeros, ones, log weighted probability."""
        rows = []
        for bit in range(8):
            _, first, zeros, ones, _, weighted = self.nodes(bit)[PREFIX]
            pairs = self.pairs[PREFIX][first]
            decision = (1 << bit) | ((pairs & 255) >> (8 - bit))
            rows.append((pairs >> 16, decision, zeros, ones, weighted))
        names = ("nearest", "decision", "zeros", "ones", "weighted")
        return {n: np.concatenate([r[i] for r in rows]) for i, n in enumerate(names)}

    def log10_of_pairs(self, shallow: Shallow) -> np.ndarray:
        """log10 probability of each pair's byte after its context."""
        total = np.zeros(len(self.pairs[DEPTH]))
        for bit in range(8):
            nodes = self.nodes(bit)
            byte = self.pairs[DEPTH] & 255
            one = ((byte >> (7 - bit)) & 1).astype(bool)
            place = np.arange(len(byte))
            places = {DEPTH: place}
            for depth in range(DEPTH, PREFIX, -1):
                place = self.up[depth][place]
                places[depth - 1] = place
            p = None
            for depth in range(DEPTH, PREFIX - 1, -1):
                node, _, zeros, ones, own, weighted = nodes[depth]
                at = node[places[depth]]
                seen = zeros[at] + ones[at]
                here = (np.where(one, ones[at], zeros[at]) + 0.5) / (seen + 1.0)
                if p is None:
                    p = here
                else:
                    weight = np.exp(HALF + own - weighted)[at]
                    p = np.where(deeper_seen > 0, weight * here + (1 - weight) * p, here)
                deeper_seen = seen
            decision = (1 << bit) | (byte >> (8 - bit))
            nearest = self.pairs[DEPTH] >> (8 * DEPTH)
            total += np.log10(shallow.mix(nearest, decision, one, p, deeper_seen))
        return total


class Shallow:
    """Depths 0 and 1 for all decisions: at most 256 x 255 nodes."""

    def __init__(self, nearest: np.ndarray, decision: np.ndarray, zeros: np.ndarray,
                 ones: np.ndarray, below: np.ndarray):
        self.zeros, self.ones, deep = (np.zeros((256, 256)) for _ in range(3))
        self.zeros[nearest, decision], self.ones[nearest, decision] = zeros, ones
        deep[nearest, decision] = below
        own = kt(self.zeros, self.ones)
        weighted = mixed(own, deep)
        self.weight = np.exp(HALF + own - weighted)
        self.root_zeros, self.root_ones = self.zeros.sum(axis=0), self.ones.sum(axis=0)
        root = kt(self.root_zeros, self.root_ones)
        self.root_weight = np.exp(HALF + root - mixed(root, weighted.sum(axis=0)))

    def mix(self, nearest, decision, one, p, seen) -> np.ndarray:
        """Mix depths 1 and 0 into the deeper prediction ``p``, known where ``seen`` > 0."""
        zeros, ones = self.zeros[nearest, decision], self.ones[nearest, decision]
        here = (np.where(one, ones, zeros) + 0.5) / (zeros + ones + 1.0)
        weight = self.weight[nearest, decision]
        p = np.where(seen > 0, weight * here + (1 - weight) * p, here)
        seen = zeros + ones
        zeros, ones = self.root_zeros[decision], self.root_ones[decision]
        here = (np.where(one, ones, zeros) + 0.5) / (zeros + ones + 1.0)
        weight = self.root_weight[decision]
        return np.where(seen > 0, weight * here + (1 - weight) * p, here)


def word_keys(words: list[bytes]) -> np.ndarray:
    """63-bit word hashes as negative numbers, so that they share a column with pairs."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return -1 - (hashes >> np.uint64(1)).astype(np.int64)


def tokens_of(text: str | None) -> list[bytes]:
    """Words and the end, the end being a line break, which no word contains."""
    return [*words_of(text), END]


def bytes_of(tokens: list[bytes]) -> bytes:
    """The scored bytes: blanks between words, the end last."""
    return b" ".join(tokens[:-1]) + tokens[-1]


def _added(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys with their counts, several runs of them, as one such run. A slice of
    the keys is added up at a time, so the runs are never copied whole."""
    longest = max((keys for keys, _ in runs), key=len)
    step = max(1, len(longest) * _CHUNK // (4 * max(1, sum(len(keys) for keys, _ in runs))))
    borders = longest[step::step]
    cuts = [[0, *np.searchsorted(keys, borders), len(keys)] for keys, _ in runs]
    parts = []
    for n in range(len(borders) + 1):
        keys, counts = (
            np.concatenate([run[side][cut[n] : cut[n + 1]] for run, cut in zip(runs, cuts)]) for side in (0, 1)
        )
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = _firsts(keys)
        parts.append((keys[first], np.add.reduceat(counts[order], first) if len(first) else counts))
    return tuple(np.concatenate([p[side] for p in parts]) for side in (0, 1))


def _block_counts(rows: Iterator[tuple[str | None, bool]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a block and their training counts, zero where only others have them."""
    words: tuple[Counter, Counter] = (Counter(), Counter())
    found: list[tuple[np.ndarray, np.ndarray]] = []
    waiting: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
    held = [0, 0]

    def sort_pairs(side: int) -> int:
        """Adds a run to ``found``; returns how many keys wait there beyond the first run."""
        if waiting[side]:
            pairs = np.concatenate(waiting[side])
            waiting[side].clear()
            held[side] = 0
            pairs.sort()
            first = _firsts(pairs)
            found.append((pairs[first], np.diff(first, append=len(pairs)) * side))
        return sum(len(keys) for keys, _ in found[1:])

    def sort_words(side: int) -> None:
        counts = np.fromiter(words[side].values(), np.int64, len(words[side])) * side
        keys = word_keys(list(words[side]))
        words[side].clear()
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = _firsts(keys)
        found.append((keys[first], np.add.reduceat(counts, first) if len(first) else counts))

    for text, learn in rows:
        side, tokens = int(learn), tokens_of(text)
        words[side].update(tokens)
        if len(words[side]) > _WORDS:
            sort_words(side)
        for pairs in pairs_of(bytes_of(tokens)):
            waiting[side].append(pairs)
            held[side] += len(pairs)
            if held[side] >= _CHUNK and sort_pairs(side) > _WAITING:
                found[:] = [_added(found)]
    for side in (0, 1):
        sort_pairs(side)
        sort_words(side)
    return _added(found)


def _sums(texts: list[list[bytes]], keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of the values of each text's pairs. Pairs of many texts are sorted together, each
    with the number of its text behind it, so a distinct pair is looked up once."""
    bits = 62 - 8 * (DEPTH + 1)
    total = np.zeros(len(texts))
    waiting: list[np.ndarray] = []
    held = 0

    def add() -> None:
        marked = np.concatenate(waiting)
        waiting.clear()
        marked.sort()
        pairs = marked >> bits
        first = _firsts(pairs)
        found = values[np.searchsorted(keys, pairs[first])]
        del pairs
        each = np.repeat(found, np.diff(first, append=len(marked)))
        marked &= (1 << bits) - 1
        total[:] += np.bincount(marked, each, len(texts))

    for number, tokens in enumerate(texts):
        for pairs in pairs_of(bytes_of(tokens)):
            waiting.append((pairs << bits) | number)
            held += len(pairs)
            if held >= _CHUNK:
                add()
                held = 0
    if waiting:
        add()
    return total


def score(docs: DataFrame, train: str, key: str = "doc_id", text: str = "text",
          block_bytes: int = 12 << 20) -> DataFrame:
    """Score every row; rows whose boolean column ``train`` is true are learned from.

    Returns ``key, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` and the flag;
    the last is the code length of the scored bytes over their number.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "context-tree")
    rows = docs.select(
        F.col(key).alias("id"), F.col(text).alias("text"),
        F.coalesce(F.col(train), F.lit(False)).alias("train"),
    )
    blocks = max(1, -(-input_bytes(rows) // block_bytes))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int"))

    def list_keys(block: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = _block_counts(
            (t.as_py(), learn) for batch in batches
            for t, learn in zip(batch.column("text"), batch.column("train").to_pylist())
        )
        for start in range(0, len(keys), _ROWS):
            part = slice(start, start + _ROWS)
            number = np.full(len(keys[part]), block[0].as_py(), np.int32)
            yield pa.RecordBatch.from_pydict({"block": number, "key": keys[part], "n": counts[part]})

    listed = scratch.write(
        "listed", rows.groupBy("block").applyInArrow(list_keys, "block int, key bigint, n bigint")
    )
    counts = scratch.write("counts", listed.groupBy("key").agg(F.sum("n").alias("n")))

    # Contexts that share their nearest bytes form whole trees; a shard holds many such groups.
    prefix = F.shiftright(F.col("key"), 8 * (DEPTH + 1 - PREFIX))
    shard = F.pmod(F.xxhash64(prefix), F.lit(8 * blocks + 16)).cast("int")
    pairs = counts.where("key >= 0").withColumn("shard", shard)

    def trees_of(rows: pa.Table) -> Trees:
        keys, counts = (rows.column(c).to_numpy() for c in ("key", "n"))
        order = np.argsort(keys)
        return Trees(keys[order], counts[order])

    def tops(rows: pa.Table) -> pa.Table:
        found = trees_of(rows).tops()
        return pa.table({
            "nearest": found["nearest"].astype(np.int32),
            "decision": found["decision"].astype(np.int32),
            **{c: found[c].astype(np.float64) for c in ("zeros", "ones", "weighted")},
        })

    # At most 256 x 255 rows, whatever the corpus.
    top = (
        pairs.groupBy("shard").applyInArrow(
            tops, "nearest int, decision int, zeros double, ones double, weighted double"
        )
        .groupBy("nearest", "decision")
        .agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "weighted")))
        .toArrow()
    )
    shallow = Shallow(*(top.column(c).to_numpy() for c in
                        ("nearest", "decision", "zeros", "ones", "weighted")))

    def log10s(rows: pa.Table) -> pa.Table:
        trees = trees_of(rows)
        return pa.table({"key": trees.pairs[DEPTH], "value": trees.log10_of_pairs(shallow)})

    words = counts.where("key < 0").select("key", F.col("n").cast("double").alias("value"))
    model = pairs.groupBy("shard").applyInArrow(log10s, "key bigint, value double")
    size = counts.where("key < 0").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count_if(F.col("n") > 0).alias("kinds")
    ).first()
    tokens, kinds = int(size["tokens"]), int(size["kinds"])
    lookups = listed.select("block", "key").join(model.unionByName(words), "key").select(
        "block", "key", "value"
    )

    def score_block(block: pa.Table, table: pa.Table) -> pa.Table:
        keys, values = (table.column(c).to_numpy() for c in ("key", "value"))
        order = np.argsort(keys)
        keys, values = keys[order], values[order]
        del order
        first_pair = np.searchsorted(keys, 0)
        pair_keys, pair_values = keys[first_pair:], values[first_pair:]
        places: dict[bytes, int] = {}
        seen, lengths = np.zeros(0), np.zeros(0, np.int64)
        parts = []
        for part in block.to_batches(max_chunksize=512):
            texts = [tokens_of(t) for t in part.column("text").to_pylist()]
            if len(places) > _WORDS:
                places.clear()
                seen, lengths = np.zeros(0), np.zeros(0, np.int64)
            fresh = [w for w in set().union(*texts) if w not in places]
            places.update(zip(fresh, range(len(places), len(places) + len(fresh))))
            seen = np.concatenate([seen, values[np.searchsorted(keys, word_keys(fresh))]])
            sizes = np.array([len(t) for t in texts])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            at = np.fromiter(map(places.__getitem__, chain.from_iterable(texts)), np.int64, sizes.sum())
            count = seen[at]
            base = np.log10((count + 0.5) / (tokens + 0.5 * (kinds + 1)))
            lengths = np.concatenate([lengths, np.fromiter(map(len, fresh), np.int64, len(fresh))])
            # Words, blanks between them and the end, which is one byte.
            coded = np.add.reduceat(lengths[at], starts) + np.maximum(sizes - 2, 0)
            parts.append((
                sizes, coded, np.add.reduceat((count > 0).astype(np.int64), starts),
                np.add.reduceat(base, starts), _sums(texts, pair_keys, pair_values),
            ))
        n_tokens, coded, n_known, base, total = (
            np.concatenate(c) if parts else np.zeros(0) for c in (zip(*parts) if parts else [()] * 5)
        )
        return pa.table({
            "id": block.column("id").cast(pa.int64()), "train": block.column("train"),
            "n_tokens": pa.array(n_tokens, pa.int64()), "n_known": pa.array(n_known, pa.int64()),
            "train_tokens": pa.array([tokens] * len(block), pa.int64()),
            "base_score": pa.array(base, pa.float64()), "score": pa.array(total, pa.float64()),
            "bits_per_byte": pa.array(-total * np.log2(10) / coded if len(coded) else coded, pa.float64()),
        })

    scored = rows.groupBy("block").cogroup(lookups.groupBy("block")).applyInArrow(
        score_block, "id bigint, train boolean, n_tokens bigint, n_known bigint, "
        "train_tokens bigint, base_score double, score double, bits_per_byte double",
    )
    return scored.withColumnsRenamed({"id": key, "train": train})
