import random

import pytest
import sentencepiece

from ledgerweave.llm import piece_viterbi, queries
from llm_cases import ODD_TEXTS, docs_of, shipped  # noqa: F401

PATH = queries.piece_model()


@pytest.fixture(scope="module")
def table():
    return piece_viterbi.Pieces(PATH)


@pytest.fixture(scope="module")
def lattice():
    """The library's own search for the best sum of scores over the same pieces: the model
    file with its kind set to unigram."""
    raw = open(PATH, "rb").read()
    at = raw.rfind(b"\x18\x02")
    model = sentencepiece.SentencePieceProcessor()
    model.LoadFromSerializedProto(raw[:at] + b"\x18\x01" + raw[at + 2 :])
    return model


def test_best_segmentation(spark, table, lattice):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    words = sorted({w for t in texts for w in t.split()})[:1500]
    for word, got in zip(words, table.encode(words)):
        best = lattice.nbest_encode_as_ids(word, 2)
        score = lambda ids: sum(lattice.get_score(int(i)) for i in ids)
        assert got.tolist() == best[0] or score(got) == score(best[0]), word


def brute(word, plain, scores, unknown, longest):
    best = [(0.0, [])] + [None] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - longest), end):
            piece = word[start:end]
            if piece in plain:
                found = (best[start][0] + scores[piece], best[start][1] + [piece])
            elif end - start == 1:
                found = (best[start][0] + unknown, best[start][1] + [piece])
            else:
                continue
            if best[end] is None or found[0] > best[end][0]:
                best[end] = found
    return best[-1]


def test_equal_length_batches_equal_one_word_at_a_time(table):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    plain = {model.id_to_piece(i): i for i in range(model.get_piece_size())
             if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    scores = {p: model.get_score(i) for p, i in plain.items()}
    rng = random.Random(2)
    words = ["▁a" + "".join(rng.choice("abcdest é漢😀") for _ in range(rng.randrange(1, 25))).replace(" ", "")
             for _ in range(300)]
    for word, ids in zip(words, table.encode([w[1:] for w in words])):
        total, best = brute(word, plain, scores, table.unknown, table.longest)
        got, at = 0.0, 0
        while at < len(ids):
            if model.is_byte(int(ids[at])):
                size = len(bytes_of_char(table, ids, at))
                got, at = got + table.unknown, at + size
            else:
                got, at = got + model.get_score(int(ids[at])), at + 1
        assert got == total, (word, best)


def bytes_of_char(table, ids, at):
    first = table.raw[int(ids[at])][0]
    return ids[at : at + (1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4)]


@pytest.mark.parametrize("text", ["", " ", "  a  b ", "日本語 😀 x", "a\x00b\n\n\tc", "x" * 5_000, "á" * 3, " lead", "trail "])
def test_round_trip(table, text):
    assert table.decode(table.encode([text])[0]) == text


def test_operator_on_odd_rows(spark, docs_of):
    docs = docs_of([(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "a▁b")]).withColumnRenamed("lang", "n_pieces")
    got = piece_viterbi.encode(docs, queries.piece_model)
    assert got.columns == ["doc_id", "n_pieces", "piece_ids", "round_trip"]
    rows = got.collect()
    assert len(rows) == len(ODD_TEXTS) + 1 and all(r["round_trip"] for r in rows)
    assert {r["n_pieces"] for r in rows if r["doc_id"] in (0, 1)} == {0}
    kept = piece_viterbi.with_pieces(docs, queries.piece_model)
    assert kept.columns == ["doc_id", "text", "source", "n_chars", "piece_ids", "n_pieces", "decoded"]
    assert kept.limit(0).count() == 0 and piece_viterbi.encode(docs.limit(0), queries.piece_model).count() == 0


def test_words_of_all_lengths_are_searched_together(monkeypatch):
    """A search step costs the same for few words as for many, so lengths share one matrix."""
    calls = []
    search = piece_viterbi.Pieces._search
    monkeypatch.setattr(piece_viterbi.Pieces, "_search", lambda self, words: calls.append(len(words)) or search(self, words))
    table = piece_viterbi.Pieces(PATH)
    texts = [" ".join("abé日"[i % 4] * i for i in range(1, 41)), None, "", "end"]
    found = table.encode(texts)
    assert calls == [41]
    alone = piece_viterbi.Pieces(PATH)
    for text, ids in zip(texts, found):
        parts = [alone.encode([w])[0].tolist() for w in (text or "").split(" ") if w]
        assert ids.tolist() == sum(parts, [])
    assert table.decode_all(found) == [t or "" for t in texts]
    assert table.decode_all(table.encode(["", None])) == ["", ""] and table.decode_all([]) == []
