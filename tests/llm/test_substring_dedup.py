"""Substring dedup against a plain look at every window of every document."""

import random
import re

import numpy as np
import pytest

from clickscope.llm import substring_dedup as sd
from tests.llm.edge import edge_docs, empty_docs, plain_rows

SCHEMA = "doc_id bigint, text string"


def brute(rows, window):
    """(id, n_words, n_removed, kept) per row, rows in (id, text) order of first appearance."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    seen, gone = set(), [set() for _ in rows]
    for i in order:
        for at in range(len(words[i]) - window + 1):
            w = tuple(words[i][at:at + window])
            if w in seen:
                gone[i].update(range(at, at + window))
            seen.add(w)
    return sorted(((rows[i][0], len(words[i]), len(gone[i]), " ".join(w for j, w in enumerate(words[i]) if j not in gone[i]))
                   for i in range(len(rows))), key=lambda r: tuple((x is None, str(x)) for x in r))


def texts(seed, n=60, vocabulary=12, passages=4):
    rng = random.Random(seed)
    shared = [" ".join(f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(5, 60))) for _ in range(passages)]
    out = []
    for i in range(n):
        parts = [" ".join(f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(0, 40)))]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(shared), " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(0, 12)))]
        out.append((i * 3, rng.choice([" ", "\n", "\t  "]).join(parts)))
    return out


@pytest.mark.parametrize("window,minimiser,seed", [(20, 4, 1), (6, 2, 2), (5, 5, 3), (2, 1, 4), (7, 1, 5)])
def test_matches_every_window(spark, window, minimiser, seed):
    rows = texts(seed) + [(1, "a " * 100), (2, "a " * 60), (400, None), (401, " \n ")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert plain_rows(sd.remove_repeated(docs, window, minimiser)) == brute(rows, window)


def test_a_passage_in_nearly_every_document_travels_as_single_windows(spark):
    rng = random.Random(7)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, " ".join(f"x{rng.randrange(10 ** 6)}" for _ in range(15)) + " " + passage
             + " " + " ".join(f"y{rng.randrange(10 ** 6)}" for _ in range(15))) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        found = plain_rows(sd.remove_repeated(docs))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert found == brute(rows, sd.WINDOW)
    assert sum(r[2] for r in found) == 299 * 30


def test_windows_of_a_frequent_minimiser_stand_alone():
    words = sd.Words([b"a b c d e f g h", b"b c d e f g h i"])
    text, begin, count, key = sd.super_kmers(words, 4, 2)
    assert count.sum() == 10 and len(set(zip(text.tolist(), key.tolist()))) == len(key)
    _, alone, ones, _ = sd.super_kmers(words, 4, 2, np.sort(np.unique(key)))
    assert len(alone) == 10 and set(ones.tolist()) == {1}


def test_equal_hashes_do_not_make_windows_equal(monkeypatch):
    monkeypatch.setattr(sd.Words, "run_hashes", lambda self, begin, count: np.zeros(len(begin), np.uint64))
    strings = [np.array([1, 2, 3]), np.array([0, 0, 0]), np.array([0, 5, 0]), np.array([1, 1, 1])]
    ids, _, a, b = sd._later_runs(strings, b"a b c d a b ", 2)
    assert (ids.tolist(), a.tolist(), b.tolist()) == ([3], [0], [2])


def test_repeated_rows_and_equal_ids(spark):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(1, text), (1, text), (1, "short one"), (1, "short one"), (2, text), (None, text)]
    found = plain_rows(sd.remove_repeated(spark.createDataFrame(rows, SCHEMA)))
    assert sorted((str(r[0]), r[1], r[2]) for r in found) == sorted(
        [("1", 25, 25), ("1", 25, 25), ("1", 2, 0), ("1", 2, 0), ("2", 25, 25), ("None", 25, 0)])


@pytest.mark.parametrize("clashing", [False, True])
def test_edge_rows(spark, clashing):
    docs = edge_docs(spark, clashing)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert plain_rows(sd.remove_repeated(docs)) == brute(rows, sd.WINDOW)


def test_empty_table(spark):
    assert sd.remove_repeated(empty_docs(spark)).collect() == []
