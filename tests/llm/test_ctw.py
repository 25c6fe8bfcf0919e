import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from clickscope.llm import ctw as C
from tests.llm.edge import edge_docs, empty_docs


class Sequential:
    """Context-tree weighting by the book: one bit at a time, one tree per bit node."""

    def __init__(self, depth):
        self.depth, self.count, self.kt, self.weighted = depth, {}, {}, {}

    def _keys(self, past, node):
        return [(node, bytes(past[len(past) - d:])) for d in range(self.depth + 1)]

    def probability(self, past, node, bit):
        p = None
        for d, key in reversed(list(enumerate(self._keys(past, node)))):
            c = self.count.get(key, [0, 0])
            own = (c[bit] + 0.5) / (sum(c) + 1)
            if d == self.depth:
                p = own
            else:
                share = math.exp(math.log(0.5) + self.kt.get(key, 0.0) - self.weighted.get(key, 0.0))
                p = share * own + (1 - share) * p
        return p

    def update(self, past, node, bit):
        for key in self._keys(past, node):
            c = self.count.setdefault(key, [0, 0])
            self.kt[key] = self.kt.get(key, 0.0) + math.log((c[bit] + 0.5) / (sum(c) + 1))
            c[bit] += 1
        for key in reversed(self._keys(past, node)):
            if len(key[1]) == self.depth:
                self.weighted[key] = self.kt[key]
            else:
                below = sum(w for (n, ctx), w in self.weighted.items() if n == key[0] and len(ctx) == len(key[1]) + 1 and ctx.endswith(key[1]))
                self.weighted[key] = math.log(0.5) + np.logaddexp(self.kt[key], below)

    def run(self, text, learn):
        past, total = [C.MARK] * self.depth, 0.0
        for byte in [*text, C.MARK]:
            node = 1
            for k in range(7, -1, -1):
                bit = byte >> k & 1
                total += math.log10(self.probability(past, node, bit))
                if learn:
                    self.update(past, node, bit)
                node = 2 * node + bit
            past.append(byte)
        return total


def whole_tree(texts, depth):
    """One tree of all contexts in one place, and a function that scores a text with it."""
    codes, counts = np.unique(C.gram_codes(texts, depth), return_counts=True) if texts else (np.empty(0, np.int64),) * 2
    tree = C.Subtrees(codes, counts, depth, 0)
    return lambda text: float(tree.logs(C.gram_codes([text], depth), []).sum())


TRAIN = [b"abracadabra", b"", b"abba", "né".encode(), b"abracadabra, abracadabra!"]
ASKED = [b"abra", b"", b"zzz", b"cab", "né".encode(), bytes(range(1, 20)), b"abracadabrb, abracadabra"]


@pytest.mark.parametrize("depth", [0, 1, 2, 4, 6])
def test_model_like_sequential_weighting(depth):
    book = Sequential(depth)
    for t in TRAIN:
        book.run(t, True)
    score = whole_tree(TRAIN, depth)
    assert [score(t) for t in ASKED] == pytest.approx([book.run(t, False) for t in ASKED], rel=1e-9)


@pytest.mark.parametrize("depth", [0, 1, 2, 3, 4, 6])
def test_spread_over_buckets_like_one_tree(spark, depth):
    rows = [(i, t.decode("latin-1"), True) for i, t in enumerate(TRAIN)] + [(100 + i, t.decode("latin-1"), False) for i, t in enumerate(ASKED)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, learn boolean").repartition(4)
    score = whole_tree([t.encode() for _, t, ok in rows if ok], depth)
    got = {r.id: r.score for r in C.score(docs, docs["learn"], depth, bucket_bytes=100).collect()}
    assert [got[i] for i, _, _ in rows] == pytest.approx([score(t.encode()) for _, t, _ in rows], rel=1e-5)


def test_predictions_add_up_to_one():
    codes, counts = np.unique(C.gram_codes([b"hello world", b"held"], 4), return_counts=True)
    tree = C.Subtrees(codes, counts, 4, 0)
    for context in (b"hell", b"xxhe", b"\xff\xff\xff\xff", b"~~~~"):
        grams = (int.from_bytes(context, "big") << 8) + np.arange(256)
        assert (10.0 ** tree.logs(grams, [])).sum() == pytest.approx(1.0, abs=1e-9)
    empty = C.Subtrees(np.empty(0, np.int64), np.empty(0, np.int64), 4, 0)
    assert empty.logs(C.gram_codes([b""], 4), []) == pytest.approx([-8 * math.log10(2)], rel=1e-9)


def test_large_counts_and_packed_arrays():
    n = np.array([0, 5, 4095, 4096, 10 ** 9])
    assert C._lgamma(n, True) == pytest.approx([math.lgamma(x + 0.5) for x in n.tolist()], rel=1e-12)
    assert C._lgamma(n, False) == pytest.approx([math.lgamma(x + 1) for x in n.tolist()], rel=1e-12)
    arrays = np.array([5, 1 << 60, -3]), np.array([0.5, -2], dtype=np.float32), np.empty(0, np.int64)
    got = C._unpack(C._pack(arrays[0], b"text", arrays[1], arrays[2]), "<i8", None, "<f4", "<i8")
    assert got[1] == b"text" and all((x == y).all() and len(x) == len(y) for x, y in zip(arrays, (got[0], got[2], got[3])))


def test_documents_like_brute_force_and_held_out_gain(spark):
    rng = random.Random(7)
    words = ["".join(rng.choices("etaoin", k=rng.randint(2, 6))) for _ in range(60)]
    more = spark.createDataFrame([(1000 + i, " ".join(rng.choices(words, k=80))) for i in range(200)], "doc_id bigint, text string")
    docs = edge_docs(spark, clashing=True).unionByName(more, allowMissingColumns=True)
    rows = docs.select("doc_id", "text").collect()
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    tokens = [(r.text or "").encode().lower().split() + [C.END] for r in rows]
    counts = Counter(t for r, ts in zip(rows, tokens) if not out(r.doc_id) for t in ts)
    n, v = sum(counts.values()), len(counts)
    score = whole_tree([(r.text or "").encode() for r in rows if not out(r.doc_id)], C.DEPTH)
    want = sorted(((r.doc_id, out(r.doc_id), len(ts), sum(t in counts for t in ts), n,
                    round(sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts), 4),
                    round(score((r.text or "").encode()), 3)) for r, ts in zip(rows, tokens)), key=str)
    scored = C.score_corpus(docs).collect()
    got = sorted(((r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), round(r.score, 3)) for r in scored), key=str)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-5, abs=2e-3)
    assert len(got) == len(want)
    held = [r.bits_per_byte for r in scored if r.held_out and r.id >= 1000]
    assert held and max(held) < 3.2  # six letters and a space, unseen documents; eight bits a byte without a model


def test_empty_tables(spark):
    assert C.score_corpus(empty_docs(spark)).collect() == []
    one = spark.createDataFrame([(i, "a b") for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0], "doc_id bigint, text string")
    rows = C.score_corpus(one).collect()  # nothing to learn from
    assert rows and {(r.n_known, r.train_tokens, r.held_out) for r in rows} == {(0, 0, True)}
    with pytest.raises(ValueError):
        C.score_corpus(one, depth=7)


def test_deeper_contexts_tell_more(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(4, 9))) for _ in range(80)]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(words, k=60))) for i in range(300)], "doc_id bigint, text string")
    held = [np.mean([r.bits_per_byte for r in C.score_corpus(docs, depth).collect() if r.held_out]) for depth in (2, 4, 6)]
    assert held[0] > 1.3 * held[1] > 1.3 * held[2]
