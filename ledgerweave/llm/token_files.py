"""Token ids in binary shard files with Elias-Fano coded document boundaries.

``write`` sorts the documents by id over range partitions. A task encodes its range as a stream and
writes a file whenever ``shard_bytes`` of text have come together: header, document ids, Elias-Fano
boundaries with the samples of their select structure, and all ids end to end as 2- or 4-byte
little-endian numbers. ``read`` opens the files with Spark's binary reader and gets every
boundary by select, a block of documents at a time. A boundary costs about 2 + log2(ids per
document) bits and a quarter of a bit for its sample; no table of 64-bit offsets is stored.

A file name carries a fresh attempt mark and only the manifest says which files count, so
a task that ran twice leaves an unused file and nothing wrong. Files go through Arrow's
file systems (local or mounted folders, hdfs, s3, gs).

Defined results for unusual input: null text is empty and gives the end id alone; null ids
come first and are kept as nulls; rows with one id stay separate, in the order of a hash of
their text, so that any number of them spreads over ranges; an empty table gives an empty
manifest. Columns other than id and text are not read.
"""

from __future__ import annotations

import math
import os
import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerweave.llm.common import Scratch, input_bytes

MAGIC = b"LWEF0002"
HEADER = struct.Struct("<8sBxxxIQB7x")  # magic, id width, documents, ids, low bits
SAMPLE = 256


class EliasFano:
    """A non-decreasing list of numbers in near-minimal space, with select.

    Low bits are stored verbatim, high bits in unary. ``samples`` holds the position of every
    256th set bit, so ``select`` unpacks the stretch between two samples and nothing else.
    """

    HEAD = struct.Struct("<QBQQQ")

    def __init__(self, count: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.count, self.low_bits, self.low, self.high, self.samples = count, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        count, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, int(math.log2(max(1, top // max(1, count)))))
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(count)
        ones = np.zeros(int(places[-1]) + 1 if count else 0, np.uint8)
        ones[places] = 1
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        return cls(count, low_bits, np.packbits(low, bitorder="little").tobytes(),
                   np.packbits(ones, bitorder="little").tobytes(), places[::SAMPLE].astype("<u8"))

    def _low(self, first: int, count: int) -> np.ndarray:
        start, stop = first * self.low_bits, (first + count) * self.low_bits
        part = np.frombuffer(self.low, np.uint8)[start // 8 : -(-stop // 8)]
        bits = np.unpackbits(part, bitorder="little")[start % 8 : start % 8 + stop - start]
        weights = np.int64(1) << np.arange(self.low_bits, dtype=np.int64)
        return bits.reshape(count, self.low_bits).astype(np.int64) @ weights

    def block(self, number: int) -> np.ndarray:
        """The numbers from ``number * SAMPLE`` on, ``SAMPLE`` of them or what is left."""
        first = number * SAMPLE
        size = min(SAMPLE, self.count - first)
        start = int(self.samples[number])
        stop = int(self.samples[number + 1]) if number + 1 < len(self.samples) else 8 * len(self.high)
        part = np.frombuffer(self.high, np.uint8)[start // 8 : -(-stop // 8)]
        ones = np.unpackbits(part, bitorder="little")[start % 8 :]
        places = start + np.flatnonzero(ones)[:size]
        return ((places - first - np.arange(size)) << self.low_bits) | self._low(first, size)

    def select(self, index: int) -> int:
        """The number at ``index``."""
        return int(self.block(index // SAMPLE)[index % SAMPLE])

    def blocks(self) -> Iterator[np.ndarray]:
        return map(self.block, range(len(self.samples)))

    def to_bytes(self) -> bytes:
        head = self.HEAD.pack(self.count, self.low_bits, len(self.low), len(self.high), len(self.samples))
        return head + self.low + self.high + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[EliasFano, int]:
        """The list and how many bytes it took."""
        count, low_bits, n_low, n_high, n_samples = cls.HEAD.unpack_from(data)
        at = cls.HEAD.size
        low, high = bytes(data[at : at + n_low]), bytes(data[at + n_low : at + n_low + n_high])
        at += n_low + n_high
        return cls(count, low_bits, low, high, np.frombuffer(data[at : at + 8 * n_samples], "<u8")), at + 8 * n_samples


def pack_shard(doc_ids: list[int | None], token_ids: list[np.ndarray], width: int) -> bytes:
    """One file: the documents in the given order."""
    ends = np.cumsum([len(t) for t in token_ids]) if token_ids else np.zeros(0, np.int64)
    bounds = EliasFano.encode(np.concatenate([np.zeros(1, np.int64), ends]))
    total = int(ends[-1]) if len(ends) else 0
    missing = np.packbits([i is None for i in doc_ids]).tobytes()
    body = np.concatenate(token_ids).astype(f"<u{width}").tobytes() if token_ids else b""
    head = HEADER.pack(MAGIC, width, len(doc_ids), total, bounds.low_bits)
    ids = np.array([0 if i is None else i for i in doc_ids], "<i8").tobytes()
    return b"".join([head, ids, missing, bounds.to_bytes(), body])


class Shard:
    """Reader of one file; documents by position, without unpacking the others."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        magic, width, count, total, _ = HEADER.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = HEADER.size
        self.ids = np.frombuffer(view[at : at + 8 * count], "<i8")
        at += 8 * count
        self.missing = np.unpackbits(np.frombuffer(view[at : at + -(-count // 8)], np.uint8))[:count]
        at += -(-count // 8)
        self.bounds, used = EliasFano.from_bytes(view[at:])
        self.tokens = np.frombuffer(view[at + used :], f"<u{width}")
        if len(self.tokens) != total:
            raise ValueError("token file is cut off")

    def __len__(self) -> int:
        return len(self.ids)

    def doc_id(self, index: int) -> int | None:
        return None if self.missing[index] else int(self.ids[index])

    def document(self, index: int) -> np.ndarray:
        return self.tokens[self.bounds.select(index) : self.bounds.select(index + 1)]

    def documents(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Starts and ends of all documents, in blocks."""
        last = None
        for found in self.bounds.blocks():
            edges = found if last is None else np.concatenate([[last], found])
            last = found[-1]
            yield edges[:-1], edges[1:]


def _byte_letters() -> np.ndarray:
    """Byte-level alphabet in UTF-8: printable Latin-1 bytes stand for themselves, the others, in
    order, for the letters from U+0100 on. The blank stays, as it parts pieces here. Two columns:
    the first byte, and the second one or 0."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in own)} | {32: 32}
    table = np.zeros((256, 2), np.uint8)
    for b in range(256):
        letter = chr(rest.get(b, b)).encode()
        table[b, : len(letter)] = list(letter)
    return table


class _Words:
    """One generation of words: where the ids of each are in a growing array."""

    def __init__(self, dtype: np.dtype):
        self.code = {"": 0}
        self.starts, self.sizes = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.ids = np.zeros(0, dtype)

    def add(self, words: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        first = len(self.code)
        self.code.update(zip(words, range(first, first + len(words))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids])

    def ids_of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end, and how many each word has."""
        sizes = self.sizes[codes]
        before = np.cumsum(sizes) - sizes
        at = np.repeat(self.starts[codes] - before, sizes)
        at += np.arange(len(at))
        return self.ids[at], sizes


class WordEncoder:
    """Encodes texts with a lower-casing byte-level tokenizer that drops white space.

    No piece crosses white space, so each distinct word of a batch goes through the tokenizer once,
    and a text is the ids of its words end to end: words are cut and numbered in Arrow, and their
    ids gathered with one take. Words are cut at blanks that every definition of white space has,
    and before single full stops and commas, which are pieces of their own. A word of letters alone is
    one piece, which the tokenizer's model takes directly; all others go through the whole tokenizer.
    """

    REMEMBERED = 300_000  # words of one generation; the one before it is kept as well
    BATCH_CHARS = 4 << 20
    # Marks side by side are one piece, and 's and the like split earlier. The tokenizer takes
    # U+001C to U+001F for marks, which are white space to Python: the blanks are listed here.
    BLANKS = r" \t\n\r\x0b\x0c\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    JOINED = re.compile(rf"[^\w{BLANKS}][^\w{BLANKS}]|_|'")
    # Texts with no other signs than these beside letters and digits are looked at for pairs of them.
    USUAL = frozenset(" \t\n\r.,")

    def __init__(self, path: str, width: int = 2):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same model over pieces that are cut and folded already, side by side.
        self.pieces = Tokenizer(self.tokenizer.model)
        self.pieces.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends[number] = token.endswith("</w>")
        self.dtype = np.dtype(f"<u{width}")
        self.letters = _byte_letters()
        self.known, self.older = _Words(self.dtype), _Words(self.dtype)

    def _joined(self, text: str) -> bool:
        """Whether marks stand side by side or split otherwise than a single one."""
        signs = [c for c in set(text) if not c.isalnum() and c not in self.USUAL]
        if not signs:
            return ".." in text or ",," in text or ".," in text or ",." in text
        return bool(self.JOINED.search(text))

    def _folded(self, text: str) -> tuple[str, bool]:
        """The text with its words cut at single blanks, and whether it is folded and composed."""
        plain = text.isascii() or unicodedata.is_normalized("NFC", text)
        # Special tokens are found before the case is folded; the lower case of two letters depends
        # on their place, or takes two letters.
        plain = plain and "<|" not in text and "\u03a3" not in text and "\u0130" not in text
        if plain:
            text = text.lower()
            if not self._joined(text):
                text = text.replace(".", " . ").replace(",", " , ")
        return text.replace("\n", " ").replace("\t", " ").replace("\r", " "), plain

    def _learn_pieces(self, words: list[str]) -> None:
        """Ids of pieces by one call of the model; a piece ends where a token ends a word."""
        joined = " ".join(words)
        if not joined.isascii():
            letters = self.letters[np.frombuffer(joined.encode(), np.uint8)].reshape(-1)
            joined = letters[letters > 0].tobytes().decode()
        found = self.pieces.encode_batch_fast([joined], add_special_tokens=False)[0].ids
        ids = np.array(found, self.dtype)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words):
            raise ValueError("the tokenizer does not mark the ends of words")
        self.known.add(words, np.diff(stops, prepend=0), ids)

    def _learn(self, fresh: list[str], plain: bool) -> None:
        """Make words known that are not."""
        if len(self.older.code) > 1:
            places = list(map(self.older.code.get, fresh))
            again = [w for w, p in zip(fresh, places) if p is not None]
            ids, sizes = self.older.ids_of(np.array([p for p in places if p is not None], np.int64))
            self.known.add(again, sizes, ids)
            fresh = [w for w, p in zip(fresh, places) if p is None]
        letters, others = [], []
        for word in fresh:
            (letters if plain and word.isalpha() else others).append(word)
        if letters:
            self._learn_pieces(letters)
        if others:
            found = [f.ids for f in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
            ids = np.array([i for f in found for i in f], self.dtype)
            self.known.add(others, np.array([len(f) for f in found], np.int64), ids)

    def _encode(self, texts: list[str], plain: bool, end_id: int) -> list[np.ndarray]:
        """Ids of some texts, each with the end id; all of them folded, or none."""
        words = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        numbered = words.flatten().dictionary_encode()
        distinct = numbered.dictionary.to_pylist()
        codes = np.fromiter(map(self.known.code.get, distinct, repeat(-1)), np.int64, len(distinct))
        unknown = np.flatnonzero(codes < 0)
        if len(unknown):
            fresh = [distinct[i] for i in unknown.tolist()]
            self._learn(fresh, plain)
            codes[unknown] = np.fromiter(map(self.known.code.__getitem__, fresh), np.int64, len(fresh))
        ids, sizes = self.known.ids_of(codes[numbered.indices.to_numpy()])
        after = np.concatenate([[0], np.cumsum(sizes)])[words.offsets.to_numpy()]
        with_ends = np.insert(ids, after[1:], self.dtype.type(end_id))
        return np.split(with_ends, (after[1:] + np.arange(1, len(texts) + 1))[:-1])

    def encode(self, texts: list[str | None], end_id: int) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, self.dtype)] * len(texts)
        held: dict[bool, list[int]] = {True: [], False: []}
        folded: dict[int, str] = {}
        chars = 0

        def flush() -> None:
            if len(self.known.code) > self.REMEMBERED:
                self.older, self.known = self.known, _Words(self.dtype)
            for plain, places in held.items():
                if places:
                    for place, found in zip(places, self._encode([folded[p] for p in places], plain, end_id)):
                        out[place] = found
                places.clear()
            folded.clear()

        for place, text in enumerate(texts):
            folded[place], plain = self._folded(text or "")
            held[plain].append(place)
            chars += len(folded[place])
            if chars > self.BATCH_CHARS:
                flush()
                chars = 0
        flush()
        return out


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str, end_id: int) -> WordEncoder:
    """The worker's encoder; its memory of words lasts over the worker's tasks."""
    if path not in _encoders:
        encoder = WordEncoder(path)
        if encoder.tokenizer.get_vocab_size() > 1 << 16 or end_id >= 1 << 16:
            encoder = WordEncoder(path, width=4)
        _encoders[path] = encoder
    return _encoders[path]


def write(docs: DataFrame, scratch: Scratch, tokenizer: Callable[[], str] | str, key: str = "doc_id",
          text: str = "text", end_id: int = 1, shard_bytes: int = 32 << 20,
          range_bytes: int = 64 << 20) -> DataFrame:
    """Encode, write the files below ``scratch`` and return the manifest:
    ``part, shard, file, documents, tokens, start`` with the ids of all shards before it.

    ``tokenizer`` is a path or a function that finds it on the executor. A file holds about
    ``shard_bytes`` of text, or one longer document.
    """
    spark = scratch.spark
    source = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(source) // range_bytes))
    folder = scratch.path("files")
    made = spark._jvm.org.apache.hadoop.fs.Path(folder)
    made.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(made)
    schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("file", pa.string()),
                        ("documents", pa.int64()), ("tokens", pa.int64())])

    def encode(batches):
        from pyarrow import fs

        part, shard = TaskContext.get().partitionId(), 0
        encoder = word_encoder(tokenizer if isinstance(tokenizer, str) else tokenizer(), end_id)
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            name = f"shard-{part:06d}-{shard:06d}-{uuid.uuid4().hex}.ids"
            store, root = fs.FileSystem.from_uri(folder)
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(pack_shard(ids, tokens, encoder.dtype.itemsize))
            row = [[part], [shard], [name], [len(tokens)], [sum(map(len, tokens))]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                some = batch.slice(start, 2048)
                texts = some.column("text").to_pylist()
                ids += some.column("id").to_pylist()
                tokens += encoder.encode(texts, end_id)
                size += sum(len(t or "") for t in texts)
                if size >= shard_bytes:
                    yield close()
                    shard, size, ids, tokens = shard + 1, 0, [], []
        if ids:
            yield close()

    # Rows of one id, or of none, are spread by the hash of their text.
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    sorted_ = source.repartitionByRange(ranges, *order).sortWithinPartitions(*order, "text")
    manifest = scratch.write("manifest", sorted_.mapInArrow(
        encode, "part int, shard int, file string, documents bigint, tokens bigint"
    ))
    # Ids of the ranges before, one row per range, then of the shards before in the range.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("tokens").alias("all")).select(
        "part", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("base")
    )
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.join(parts, "part").withColumn(
        "start", F.col("base") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))
    ).drop("base")


def read(scratch: Scratch, manifest: DataFrame) -> DataFrame:
    """Every document back from the files: ``doc_id, start, n_tokens, ids_crc32``."""
    files = scratch.spark.read.format("binaryFile").load(scratch.path("files")).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "content"
    )
    # The manifest has one row per file, bounded by the number of shards.
    listed = files.join(F.broadcast(manifest.select("file", F.col("start"))), "file")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def documents(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard(batch.column("content")[row].as_buffer())
                base, done = batch.column("start")[row].as_py(), 0
                for starts, ends in shard.documents():
                    wide = shard.tokens[int(starts[0]) : int(ends[-1])].astype("<u4") if len(starts) else None
                    first = int(starts[0]) if len(starts) else 0
                    spans = zip((starts - first).tolist(), (ends - first).tolist())
                    yield pa.RecordBatch.from_arrays([
                        pa.array([shard.doc_id(done + i) for i in range(len(starts))], pa.int64()),
                        pa.array(base + starts, pa.int64()),
                        pa.array(ends - starts, pa.int64()),
                        pa.array([zlib.crc32(wide[a:b]) for a, b in spans], pa.int64()),
                    ], schema=schema)
                    done += len(starts)

    return listed.mapInArrow(documents, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
