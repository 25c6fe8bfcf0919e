import math
import random
import re

import pytest
from pyspark.sql import functions as F

from clickscope.llm import quality as Q
from tests.llm.edge import edge_docs, empty_docs


def brute_base(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    places = {}
    for i in range(len(ws) - 2):
        places.setdefault(tuple(ws[i:i + 3]), []).append(i)
    inside = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(ws) < 50 or 100 * len(inside) > 50 * len(ws)
    return len(ws), sum(map(len, ws)), sum(c in Q.SYMBOLS for c in text or ""), len(lines) - len(set(lines)), len(inside), failed


def test_base_counts_like_brute_force(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcd") for _ in range(n)) for n in (0, 1, 2, 3, 4, 7, 20, 60, 200)]
    texts += ["a b c a b c", "x x x x x x", "\n\n a\n a\nb\n b\n", "#$ %&\x0b|<> *", "ä b\u00a0c \x1c d", "a b c\n" * 40]
    docs = edge_docs(spark, clashing=True).select("doc_id", "text", "lang", "q_words", "quality")
    docs = docs.unionByName(spark.createDataFrame([(100 + i, t, "en", "", "") for i, t in enumerate(texts)],
                                                  "doc_id bigint, text string, lang string, q_words string, quality string"))
    judged = Q.apply_rules(docs)
    assert "quality" in judged.columns and "_quality" in judged.columns
    for r in judged.select("text", "_quality.*").collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute_base(r.text), (r.text or "")[:50]
        assert not (r.base_failed and r.kept)


def brute_distance(p, q):
    if not sum(p) or not sum(q):
        return None
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    entropy = lambda d: -sum(x * math.log2(x) for x in d if x)
    return math.sqrt(max(0.0, entropy(m) - (entropy(p) + entropy(q)) / 2))


def test_distance_like_definition(spark):
    pairs = [([1.0, 2.0, 3.0], [3.0, 2.0, 1.0]), ([1.0, 0.0], [0.0, 5.0]), ([4.0, 4.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])]
    df = spark.createDataFrame(pairs, "p array<double>, q array<double>")
    for (p, q), r in zip(pairs, df.select(Q.js_distance(F.col("p"), F.col("q")).alias("d")).collect()):
        want = brute_distance(p, q)
        assert r.d is None if want is None else r.d == pytest.approx(want, abs=1e-9)


def prose(rng, n):
    return " ".join(rng.choice(Q.COMMON_WORDS["en"]) if rng.random() < 0.4 else "".join(rng.choices("etaoinshrdlu", k=6)) for _ in range(n))


def test_divergent_documents_go_and_plain_ones_stay(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(60, 400)), "en") for i in range(200)]
    junk = {1000: prose(rng, 150).upper(), 1001: " | ".join("".join(rng.choices("etaoinshrdlu", k=9)) for _ in range(200)),
            1002: " ".join(w + "###" for w in prose(rng, 120).split())}
    rows += [(i, t, "en") for i, t in junk.items()]
    rows += [(2000, prose(rng, 120).upper(), None), (2001, prose(rng, 120).upper(), "tiny")]  # no reference
    got = {r.doc_id: r["quality"] for r in Q.apply_rules(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert not any(got[i].kept for i in junk)
    assert sum(got[i].kept for i in range(200)) >= 199
    assert got[2000].class_distance is None and got[2000].kept and got[2001].kept


def test_an_excess_of_symbols_counts_and_a_lack_does_not(spark):
    shares = [([50.0, 1.0, 9.0], [0.1, 0.0]), ([90.0, 0.0, 10.0], [0.0, 0.0])]
    at = len(Q.CLASSES)
    pad = lambda x: [x[0]] + [0.0] * (at - 1) + [x[1], x[2]]
    ref = pad([900.0, 5.0, 95.0])
    rows = [(pad(x), ref) for x, _ in shares] + [(pad([1.0, 0.0, 0.0]), None)]
    df = spark.createDataFrame(rows, "p array<double>, q array<double>")
    got = [r.d for r in df.select(Q._excess_of_symbols(F.col("p"), F.col("q")).alias("d")).collect()]
    assert got[0] == pytest.approx(brute_distance([1, 59], [5, 995]), abs=1e-9) and got[1:] == [0.0, None]


def test_references_cover_all_documents(spark):
    docs = spark.createDataFrame([("the cat.", "en"), ("THE 1 of", "en"), (None, "en"), ("der", None)], "text string, lang string")
    rules = Q.Rules(reference_min_words=1)
    r, = Q.references(Q.measure(docs), rules).collect()
    assert (r.lang, r.n_words) == ("en", 5)
    assert r.classes == [8.0, 3.0, 1.0, 3.0, 1.0, 0.0, 0.0]
    assert r.commons[0] == 1.0 and r.commons[1] == 1.0 and r.commons[-1] == 3.0 and sum(r.commons) == 5.0


def test_symbols_are_a_class_of_their_own(spark):
    docs = spark.createDataFrame([("a | b # c ~", "en")], "text string, lang string")
    r, = Q.measure(docs).select("features.*").collect()
    assert r.classes == [3.0, 0.0, 0.0, 5.0, 0.0, 2.0, 1.0] and r.n_symbols == 2 and r.n_chars == 11


def test_texts_are_read_once(spark):
    """The verdict comes from written numbers: no text function is left in its plan."""
    judged = Q.apply_rules(edge_docs(spark), keep=("doc_id",))
    assert judged.columns == ["doc_id", "quality"]
    assert "regexp_replace" not in judged._jdf.queryExecution().optimizedPlan().toString()


def test_keep_good_keeps_columns(spark):
    docs = edge_docs(spark, clashing=True)
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} <= {5, 6, 7}
    assert Q.keep_good(empty_docs(spark)).collect() == []
