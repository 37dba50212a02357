import math
import random
import tracemalloc
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerweave.llm import context_tree as ctw
from llm_cases import ODD_TEXTS, docs_of, shipped  # noqa: F401


def test_log_gamma():
    x = np.concatenate([np.arange(0.5, 60, 0.5), [1e3, 1e7 + 0.5]])
    assert np.allclose(ctw.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-10)


class Brute:
    """Context-tree weighting straight from the definition, one node at a time."""

    def __init__(self, texts):
        self.counts = {}
        for data in texts:
            padded = ctw.END * ctw.DEPTH + data
            for i, byte in enumerate(data):
                context = padded[i : i + ctw.DEPTH][::-1]
                for bit in range(8):
                    decision, one = (1 << bit) | (byte >> (8 - bit)), (byte >> (7 - bit)) & 1
                    for depth in range(ctw.DEPTH + 1):
                        node = self.counts.setdefault((decision, context[:depth]), [0, 0])
                        node[one] += 1
        self.children = {}
        for decision, context in self.counts:
            if context:
                self.children.setdefault((decision, context[:-1]), []).append((decision, context))
        self.memo = {}

    def own(self, node):
        a, b = self.counts[node]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, node):
        if node not in self.memo:
            if len(node[1]) == ctw.DEPTH:
                self.memo[node] = self.own(node)
            else:
                below = sum(self.weighted(c) for c in self.children.get(node, ()))
                self.memo[node] = float(np.logaddexp(math.log(0.5) + self.own(node), math.log(0.5) + below))
        return self.memo[node]

    def predict(self, decision, context, one):
        node = (decision, context[:0])
        if node not in self.counts:
            return 0.5

        def mixed(depth):
            node = (decision, context[:depth])
            counts = self.counts[node]
            here = (counts[one] + 0.5) / (sum(counts) + 1)
            if depth == ctw.DEPTH or (decision, context[: depth + 1]) not in self.counts:
                return here
            weight = math.exp(math.log(0.5) + self.own(node) - self.weighted(node))
            return weight * here + (1 - weight) * mixed(depth + 1)

        return mixed(0)

    def log10(self, data):
        padded, total = ctw.END * ctw.DEPTH + data, 0.0
        for i, byte in enumerate(data):
            context = padded[i : i + ctw.DEPTH][::-1]
            for bit in range(8):
                decision, one = (1 << bit) | (byte >> (8 - bit)), (byte >> (7 - bit)) & 1
                total += math.log10(self.predict(decision, context, one))
        return total


def test_scores_equal_brute_force(spark, docs_of):
    rng = random.Random(5)
    words = ["the", "then", "Hen", "été", "a", "zebra", "in"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 25)))) for i in range(40)]
    rows += [(40, None), (41, "unseen qqq"), (None, "the\n hen"), (3, rows[3][1])]
    docs = docs_of(rows).withColumn("learn", F.col("doc_id") % 4 != 1).withColumn("score", F.lit("clash"))
    got = ctw.score(docs, "learn", block_bytes=300).collect()
    one_block = {(r["doc_id"], round(r["score"], 9)) for r in ctw.score(docs, "learn").collect()}
    assert one_block == {(r["doc_id"], round(r["score"], 9)) for r in got} and len(got) == len(rows)
    train = [t for i, t in rows if i is not None and i % 4 != 1]
    tokens = [w for t in train for w in ctw.tokens_of(t)]
    counts = {w: tokens.count(w) for w in tokens}
    brute = Brute([ctw.bytes_of(ctw.tokens_of(t)) for t in train])
    texts = dict(rows)
    for r in got:
        own = ctw.tokens_of(texts[r["doc_id"]])
        base = sum(math.log10((counts.get(w, 0) + 0.5) / (len(tokens) + 0.5 * (len(counts) + 1))) for w in own)
        assert (r["n_tokens"], r["train_tokens"]) == (len(own), len(tokens))
        assert r["n_known"] == sum(w in counts for w in own)
        assert abs(r["base_score"] - base) < 1e-9
        assert abs(r["score"] - brute.log10(ctw.bytes_of(own))) < 1e-6
        assert abs(r["bits_per_byte"] + r["score"] / math.log10(2) / len(ctw.bytes_of(own))) < 1e-9


def test_a_node_predicts_a_distribution():
    texts = [b"abracadabra\n", b"bread\n"]
    brute = Brute(texts)
    for context in (b"abr  "[::-1], b"zzzzz", b"\n" * 5):
        total = 0.0
        for byte in range(256):
            p = 1.0
            for bit in range(8):
                p *= brute.predict((1 << bit) | (byte >> (8 - bit)), context, (byte >> (7 - bit)) & 1)
            total += p
        assert abs(total - 1) < 1e-9


def test_odd_texts_and_no_training(spark, docs_of):
    docs = docs_of(list(enumerate(ODD_TEXTS))).withColumn("learn", F.lit(False))
    got = {r["doc_id"]: r for r in ctw.score(docs, "learn").collect()}
    assert got[0]["n_tokens"] == got[1]["n_tokens"] == 1 and got[0]["train_tokens"] == 0
    for i, text in enumerate(ODD_TEXTS):
        size = len(ctw.bytes_of(ctw.tokens_of(text)))
        assert abs(got[i]["score"] - size * 8 * math.log10(0.5)) < 1e-6 * max(1, size)
        assert abs(got[i]["bits_per_byte"] - 8) < 1e-6
    assert ctw.score(docs.limit(0), "learn").count() == 0


def pairs_by_definition(data):
    padded = ctw.END * ctw.DEPTH + data
    for i, byte in enumerate(data):
        yield int.from_bytes(padded[i : i + ctw.DEPTH][::-1] + bytes([byte]), "big")


def test_keys_of_a_block_are_whole_whatever_is_sorted_at_once(monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(90))) for _ in range(50)] + [None, ""]
    rows = [(t, i % 3 > 0) for i, t in enumerate(texts)]
    want = Counter()
    for text, learn in rows:
        tokens = ctw.tokens_of(text)
        for key in [*pairs_by_definition(ctw.bytes_of(tokens)), *ctw.word_keys(tokens).tolist()]:
            want[key] += learn
    for chunk, waiting, words in [(1 << 20, 1 << 20, 1 << 20), (64, 100, 7), (5, 1, 1)]:
        monkeypatch.setattr(ctw, "_CHUNK", chunk)
        monkeypatch.setattr(ctw, "_WAITING", waiting)
        monkeypatch.setattr(ctw, "_WORDS", words)
        keys, counts = ctw._block_counts(iter(rows))
        assert dict(zip(keys.tolist(), counts.tolist())) == want and (np.diff(keys) > 0).all()
        pairs = keys[keys >= 0]
        values = (pairs % 97).astype(float)
        own = [ctw.tokens_of(t) for t in texts]
        sums = [sum(p % 97 for p in pairs_by_definition(ctw.bytes_of(t))) for t in own]
        assert ctw._sums(own, pairs, values).tolist() == sums


def test_few_pairs_of_a_block_are_held_at_once():
    rng = np.random.default_rng(4)
    letters = rng.choice(np.frombuffer(b"abcd  ", np.uint8), 5_000_000).tobytes().decode()
    texts = [letters[i : i + 50_000] for i in range(0, len(letters), 50_000)]
    tracemalloc.start()
    keys, _ = ctw._block_counts((t, True) for t in texts)
    counted = tracemalloc.get_traced_memory()[1]
    pairs = keys[keys >= 0]
    tokens, values = [ctw.tokens_of(t) for t in texts], np.zeros(len(pairs))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.reset_peak()
    ctw._sums(tokens, pairs, values)
    summed = tracemalloc.get_traced_memory()[1] - held
    tracemalloc.stop()
    assert counted < 60e6 and summed < 60e6, (len(keys), counted, summed)
