"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a run of ``LEAST`` words (a seed) are tiled: the
longest common runs of still unmarked words are marked first, each word at most once on either
side, down to runs of ``LEAST`` words. Runs are found by running Karp-Rabin: window hashes of a
search length that is halved from round to round.
The share of an item's words under tiles is its coverage, whatever the order of its parts.

Words are lower-cased (A-Z) and stripped of ASCII punctuation at both ends, so decorated copies
match; words of punctuation alone do not count. The benchmark is the stated query set: it is
sent to all tasks in blocks of ``BLOCK_WORDS`` words (about 30 MB), and each block meets every
document, so neither side is ever joined on a frequent word.

Defined results for unusual input: null and empty texts match nothing; an item shorter than a
seed must appear whole; items without words match nothing; repeated documents and repeated
items each give their own rows; null ids are carried along; an empty table on either side
gives no pairs and removes nothing. Other columns are not read (``find``) or kept (``clean``).
"""

from __future__ import annotations

import heapq
import string

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import words_of

LEAST = 5
COVERAGE = 0.5
BLOCK_WORDS = 2_000_000
_EDGE = string.punctuation.encode()
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


class WordHashes:
    """64-bit hashes of stripped words; remembers the words it has met."""

    REMEMBERED = 400_000

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        known = self.known
        if len(known) > self.REMEMBERED:
            known.clear()
        for word in [w for w in set(words) if w not in known]:
            bare = word.strip(_EDGE)
            known[word] = xxhash.xxh3_64_intdigest(bare) | 1 if bare else 0
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        return hashes[hashes != 0]


_powers_known = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. n of the base and of its inverse, modulo 2 ** 64."""
    global _powers_known
    if len(_powers_known[0]) <= n:
        size = max(1024, 2 * n + 1)
        _powers_known = tuple(
            np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)]))
            for b in (_BASE, _INVERSE)
        )
    return _powers_known[0][: n + 1], _powers_known[1][: n + 1]


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows, independent of where a window stands."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(words))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)])])
    return (sums[length:] - sums[:n]) * down[:n]


def _scan(item, text, free_item, free_text, length: int) -> list[tuple[int, int, int]]:
    """Runs (words, place in item, place in text) of unmarked words, ``length`` or longer,
    that cannot be extended to the left."""
    open_text = np.flatnonzero(_whole(free_text, length))
    hashes = window_hashes(text, length)[open_text]
    order = np.argsort(hashes, kind="stable")
    hashes, open_text = hashes[order], open_text[order]
    found = []
    item_hashes = window_hashes(item, length)
    for at in np.flatnonzero(_whole(free_item, length)):
        low = np.searchsorted(hashes, item_hashes[at], side="left")
        high = np.searchsorted(hashes, item_hashes[at], side="right")
        for place in open_text[low:high]:
            if at and place and free_item[at - 1] and free_text[place - 1] and (
                item[at - 1] == text[place - 1]
            ):
                continue  # part of a run that starts further left
            most = min(len(item) - at, len(text) - place)
            same = (
                (item[at : at + most] == text[place : place + most])
                & free_item[at : at + most] & free_text[place : place + most]
            )
            run = int(most) if same.all() else int(same.argmin())
            if run >= length:
                found.append((run, int(at), int(place)))
    return found


def _whole(free: np.ndarray, length: int) -> np.ndarray:
    """Whether each window of this length is unmarked throughout."""
    if len(free) < length:
        return np.zeros(0, bool)
    sums = np.concatenate([[0], np.cumsum(free)])
    return sums[length:] - sums[:-length] == length


def tiles(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiling: runs (words, place in item, place in text), each word used once."""
    free_item, free_text = np.ones(len(item), bool), np.ones(len(text), bool)
    out: list[tuple[int, int, int]] = []
    length = max(least, min(len(item), 4 * least))
    while True:
        heap = [(-run, at, place) for run, at, place in _scan(item, text, free_item, free_text, length)]
        heapq.heapify(heap)
        while heap:
            run, at, place = heapq.heappop(heap)
            free = free_item[at : at - run] & free_text[place : place - run]
            if free.all():
                free_item[at : at - run] = False
                free_text[place : place - run] = False
                out.append((-run, at, place))
                continue
            # A longer tile took a part: what is left of the run waits for its turn.
            edges = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]])))
            for start, stop in edges.reshape(-1, 2).tolist():
                if stop - start >= length:
                    heapq.heappush(heap, (start - stop, at + start, place + start))
        if length == least:
            return out
        length = max(least, length // 2)


class Finder:
    """Seeds of one benchmark block, and the tiling of texts that meet them."""

    def __init__(self, items: list[np.ndarray], least: int, coverage: float):
        self.items, self.least, self.coverage = items, least, coverage
        self.words = WordHashes()
        self.sizes = np.array([len(i) for i in items], np.int64)
        # Seeds by their length: items shorter than a seed are one seed themselves.
        self.seeds: dict[int, tuple[np.ndarray, ...]] = {}
        for length in sorted({min(least, len(i)) for i in items if len(i)}):
            own = [n for n, i in enumerate(items) if len(i) and min(least, len(i)) == length]
            hashes = [window_hashes(items[n], length) for n in own]
            owner = np.concatenate([np.full(len(h), n) for h, n in zip(hashes, own)])
            place = np.concatenate([np.arange(len(h)) for h in hashes])
            joined = np.concatenate(hashes)
            order = np.argsort(joined, kind="stable")
            keys, first = np.unique(joined[order], return_index=True)
            self.seeds[length] = (keys, np.append(first, len(joined)), owner[order], place[order])

    def _met(self, text: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """Items whose seeds could cover enough of them, and the text places of all seeds."""
        owners, places, at = [], [], {}
        for length, (keys, first, owner, place) in self.seeds.items():
            hashes = window_hashes(text, length)
            if not len(hashes):
                continue
            slot = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            hit = np.flatnonzero(keys[slot] == hashes)
            if not len(hit):
                continue
            at[length] = hit
            for key in np.unique(slot[hit]):
                part = slice(first[key], first[key + 1])
                for step in range(length):
                    owners.append(owner[part])
                    places.append(place[part] + step)
        if not owners:
            return np.zeros(0, np.int64), at
        width = int(self.sizes.max()) + 1
        cells = np.unique(np.concatenate(owners) * width + np.concatenate(places))
        covered = np.bincount(cells // width, minlength=len(self.items))
        return np.flatnonzero((covered > 0) & (covered >= self.coverage * self.sizes)), at

    def matches(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item, tiles, covered words) of items whose coverage reaches the threshold."""
        words = self.words.of(text)
        candidates, at = self._met(words)
        if not len(candidates):
            return []
        out = []
        for number in candidates:
            item = self.items[number]
            length = min(self.least, len(item))
            # Words outside every seed cannot be in a tile: the tiling sees the rest, with a
            # word that equals no other (0) where something was left out.
            seen = np.zeros(len(words) + 1, bool)
            for step in range(length):
                seen[at[length] + step] = True
            kept = np.flatnonzero(seen[:-1])
            gaps = np.flatnonzero(np.diff(kept) > 1) + 1
            found = tiles(item, np.insert(words[kept], gaps, np.uint64(0)), length)
            covered = sum(run for run, _, _ in found)
            if covered >= self.coverage * len(item):
                out.append((int(number), len(found), covered))
        return out


def _blocks(benchmark: DataFrame, key: str, text: str):
    """The benchmark block by block: lists of ids and word hashes."""
    items = benchmark.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    chars = items.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    count = max(1, -(-int(chars) // (6 * BLOCK_WORDS)))
    number = F.pmod(F.xxhash64("id", "text"), F.lit(count))
    words = WordHashes()
    for block in range(count):
        rows = items.where(number == block).orderBy("id", "text").toArrow().to_pydict()
        if rows["id"]:
            yield rows["id"], [words.of(t) for t in rows["text"]]


def find(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
         item_key: str = "item_id", item_text: str = "text", least: int = LEAST,
         coverage: float = COVERAGE) -> DataFrame:
    """``doc_id, item_id, n_tiles, covered_words, item_words, coverage`` of contaminated pairs."""
    spark = docs.sparkSession
    fields = ("doc_id bigint, item_id bigint, n_tiles bigint, covered_words bigint, "
              "item_words bigint, coverage double")
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    out = spark.createDataFrame([], fields)
    for ids, items in _blocks(benchmark, item_key, item_text):
        sent = spark.sparkContext.broadcast((ids, items))
        out = out.unionByName(rows.mapInArrow(_pairs(sent, least, coverage), fields))
    return out


def _pairs(sent, least: int, coverage: float):
    def work(batches):
        ids, items = sent.value
        finder = Finder(items, least, coverage)
        for batch in batches:
            found = []
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                for number, count, covered in finder.matches(text):
                    size = len(items[number])
                    found.append((doc, ids[number], count, covered, size, covered / size))
            columns = list(zip(*found)) if found else [[]] * 6
            kinds = [pa.int64()] * 5 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "item_id", "n_tiles", "covered_words", "item_words", "coverage"],
            )

    return work


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id",
          item_text: str = "text", least: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns stay."""
    spark = docs.sparkSession
    for ids, items in _blocks(benchmark, item_key, item_text):
        sent = spark.sparkContext.broadcast(items)
        docs = docs.mapInArrow(_without(sent, text, least, coverage), docs.schema)
    return docs


def _without(sent, text: str, least: int, coverage: float):
    def work(batches):
        finder = Finder(sent.value, least, coverage)
        for batch in batches:
            keep = [not finder.matches(t) for t in batch.column(text).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return work
