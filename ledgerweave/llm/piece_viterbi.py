"""SentencePiece encoding by a batched Viterbi search, and exact decoding.

The piece table is read from a model file. Blanks become the word mark U+2581 and a text starts
with one; no piece has a mark after another character, so words (marks and what follows them)
are independent and each distinct word is searched once. Words form a matrix, the longest first,
and advance one character at a time, each as far as it goes: hashes of the last 1 .. 16 characters
probe a table of marks, those that it lets through the sorted piece hashes, the best sum of piece
scores over the pieces that end here is kept for each word, and a back-pointer says how long its
last piece is. Characters that no piece holds become the pieces of their UTF-8 bytes.

The best segmentation has the highest sum of the scores in the file; ties go to the longer last
piece. Decoding joins the pieces, turns marks into blanks and drops the first one.

Defined results for unusual input: null and empty texts have no pieces; U+2581 in a text counts
as a blank and reads back as one, any other text reads back unchanged; texts and words may be of
any length; rows are kept one for one; an empty table gives no rows. Columns other than id and
text are not read by ``encode``; ``with_pieces`` keeps them.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

MARK = "▁"
WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_BASE = np.uint64(0xD6E8FEB86659FD93)
UNKNOWN_PENALTY = 10.0
CELLS = 1 << 20  # characters of one matrix of words
_MARK_SHIFT = np.uint64(44)  # the highest 20 bits of a hash choose its mark


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _columns(words: list[str], lengths: np.ndarray) -> np.ndarray:
    """Characters of words, one column each; rows beyond a word's end are not read."""
    starts = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(starts, lengths)
    chars = np.zeros((lengths[0], len(words)), np.uint64)
    chars[place, np.repeat(np.arange(len(words)), lengths)] = _points("".join(words))
    return chars


def _marked_words(text: str) -> list[str]:
    """Words with their marks; texts with single blanks need no pattern."""
    if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
        return WORD.findall(MARK + text.replace(" ", MARK))
    return (MARK + text.replace(" ", " " + MARK)).split(" ")


class Pieces:
    """A model's pieces, and the words encoded so far."""

    REMEMBERED = 200_000  # words of one generation; the one before it is kept as well

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes_id = np.zeros(256, np.int32)
        self.raw: list[bytes] = []
        self.width: list[int] = []  # characters of each piece
        plain, scores = {}, []
        for i in range(size):
            piece = model.id_to_piece(i)
            self.width.append(len(piece))
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes_id[value] = i
                self.raw.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.raw.append(b"")
            else:
                self.raw.append(piece.replace(MARK, " ").encode())
                plain[piece] = i
                scores.append(model.get_score(i))
        self.joinable = pa.array(self.raw, pa.large_binary())
        self.longest = max(map(len, plain))
        self.unknown = min(scores) - UNKNOWN_PENALTY
        keys = np.array([self._hash(_points(p)) for p in plain], np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.marks = np.zeros(1 << (64 - int(_MARK_SHIFT)), bool)
        self.marks[keys >> _MARK_SHIFT] = True
        self.ids = np.fromiter(plain.values(), np.int32, len(plain))[order]
        self.scores = np.array(scores)[order]
        self.code = np.uint16 if size <= 1 << 16 else np.uint32
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _hash(self, points: np.ndarray) -> np.uint64:
        total = np.zeros(1, np.uint64)
        for p in points:
            total = total * _BASE + (p + np.uint64(1))
        return total[0]

    def _search(self, words: list[str]) -> list[bytes]:
        """Piece ids of words, the longest of which come first."""
        lengths = np.array([len(w) for w in words])
        count, length = len(words), int(lengths[0])
        chars = _columns(words, lengths)
        # How many words reach each position.
        reach = np.searchsorted(-lengths, -np.arange(length + 1), "right")
        best = np.zeros((length + 1, count))
        back = np.ones((length + 1, count), np.int32)
        piece = np.full((length + 1, count), -1, np.int32)
        hashes = np.zeros((self.longest + 1, count), np.uint64)  # of the last 1 .. longest characters
        for end in range(1, length + 1):
            live = reach[end]
            span = min(self.longest, end)
            # Windows grow by one character; the shortest is new.
            hashes[1 : span + 1, :live] = hashes[0:span, :live] * _BASE + (chars[end - 1, :live] + np.uint64(1))
            probes = hashes[1 : span + 1, :live]
            size, word = np.nonzero(self.marks[probes >> _MARK_SHIFT])
            wanted = probes[size, word]
            slot = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            hit = self.keys[slot] == wanted
            size, word, slot = size[hit], word[hit], slot[hit]
            total = np.full((span, live), -np.inf)
            total[size, word] = best[end - 1 - size, word] + self.scores[slot]
            ids = np.full((span, live), -1, np.int32)
            ids[size, word] = self.ids[slot]
            total[0] = np.where(ids[0] >= 0, total[0], best[end - 1, :live] + self.unknown)
            top, choice = total[0].copy(), np.zeros(live, np.int64)
            for longer in range(1, span):  # longer pieces last, so that ties go to them
                better = total[longer] >= top
                choice[better] = longer
                np.maximum(top, total[longer], out=top)
            best[end, :live] = top
            back[end, :live] = choice + 1
            piece[end, :live] = ids[choice, np.arange(live)]
        return self._walk(words, lengths, back, piece)

    def _walk(self, words: list[str], lengths: np.ndarray, back: np.ndarray, piece: np.ndarray) -> list[bytes]:
        """Follow the back-pointers of all words together, from their ends."""
        at, rows = lengths.copy(), np.arange(len(words))
        steps = []
        while at.any():
            live = at > 0
            steps.append(np.where(live, piece[at, rows], -2))
            at = np.where(live, at - back[at, rows], 0)
        ids = np.stack(steps[::-1], axis=1)
        taken = ids != -2
        ends = np.cumsum(taken.sum(axis=1)) * np.dtype(self.code).itemsize
        joined = ids[taken].astype(self.code).tobytes()
        out = [joined[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
        for i in np.flatnonzero((ids == -1).any(axis=1)):
            out[i] = self._with_bytes(words[i], ids[i][taken[i]]).astype(self.code).tobytes()
        return out

    def _with_bytes(self, word: str, row: np.ndarray) -> np.ndarray:
        """Put the byte pieces of unknown characters in their places."""
        out, at = [], 0
        for i in row.tolist():
            if i < 0:
                out.extend(self.bytes_id[b] for b in word[at].encode("utf-8", "surrogatepass"))
                at += 1
            else:
                out.append(i)
                at += self.width[i]
        return np.array(out, np.int32)

    def _learn(self, words: set[str]) -> None:
        new = []
        for word in words:
            found = self.older.get(word)
            if found is not None:
                self.known[word] = found
            else:
                new.append(word)
        new.sort(key=len, reverse=True)
        start = 0
        while start < len(new):
            length = len(new[start])
            rows = max(1, CELLS // (length + 1) // (self.longest if length < 64 else 1))
            part = new[start : start + rows]
            self.known.update(zip(part, self._search(part)))
            start += rows

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        out = []
        for start in range(0, len(texts), 256):
            split = [_marked_words(t) if t else [] for t in texts[start : start + 256]]
            if len(self.known) > self.REMEMBERED:
                self.older, self.known = self.known, {}
            known = self.known
            self._learn(set().union(*split).difference(known))
            for words in split:
                out.append(np.frombuffer(b"".join(map(known.__getitem__, words)), self.code))
        return out

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_all([ids])[0]

    def decode_all(self, found: list[np.ndarray]) -> list[str]:
        """The texts of many lists of ids; their pieces are put behind each other together."""
        out = []
        for start in range(0, len(found), 256):
            part = found[start : start + 256]
            taken = self.joinable.take(pa.array(np.concatenate(part)))
            places = np.frombuffer(taken.buffers()[1], np.int64)
            data = memoryview(taken.buffers()[2] or b"")
            ends = places[np.cumsum([0, *map(len, part)])].tolist()
            for a, b in zip(ends, ends[1:]):
                text = str(data[a:b], "utf-8", "surrogatepass")
                out.append(text[1:] if text.startswith(" ") else text)
        return out


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The worker's table; its memory of words lasts over the worker's tasks."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def with_pieces(docs: DataFrame, model: Callable[[], str] | str, text: str = "text",
                ids: str = "piece_ids", count: str = "n_pieces", decoded: str = "decoded",
                rows: int = 256) -> DataFrame:
    """``docs`` with its texts' piece ids, their number, and the text that they decode to.

    New columns replace columns of the same names.
    """
    kept = [f for f in docs.schema.fields if f.name not in (ids, count, decoded)]
    fields = StructType(list(kept)).add(ids, ArrayType(IntegerType())).add(count, LongType()).add(
        decoded, StringType()
    )
    names = [f.name for f in kept]

    def work(batches):
        table = pieces(model if isinstance(model, str) else model())
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows).select(names)
                found = table.encode(part.column(text).to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
                values = np.concatenate(found).astype(np.int32) if found else np.zeros(0, np.int32)
                arrays = [
                    *part.columns,
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array(table.decode_all(found), pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, ids, count, decoded])

    return docs.mapInArrow(work, fields)


def encode(docs: DataFrame, model: Callable[[], str] | str, key: str = "doc_id",
           text: str = "text", rows: int = 256) -> DataFrame:
    """``key, n_pieces, piece_ids, round_trip``; the last says that decoding gave the text."""
    source = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))

    def work(batches):
        table = pieces(model if isinstance(model, str) else model())
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                texts = part.column("text").to_pylist()
                found = table.encode(texts)
                offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
                same = [d == (t or "").replace(MARK, " ") for d, t in zip(table.decode_all(found), texts)]
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), pa.array([len(f) for f in found], pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(offsets), pa.array(np.concatenate(found).astype(np.int32))
                    ),
                    pa.array(same, pa.bool_()),
                ], names=[key, "n_pieces", "piece_ids", "round_trip"])

    return source.mapInArrow(
        work, f"`{key}` bigint, n_pieces bigint, piece_ids array<int>, round_trip boolean"
    )
