"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
import zlib
from collections import Counter

import pytest

from clickscope.llm import spelling
from tests.llm.edge import edge_docs, empty_docs, plain_rows


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + 1:] == b[i + 1:] or a[i + 1:] == b[i:] or a[i:] == b[i + 1:]


def brute_count(rows, every=97):
    counts = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % every == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute_groups(n):
    out, form = [], {}
    for w in n:
        near = [v for v in n if one_edit(w, v)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
        out.append([w, form[w], w, n[w], len(near), n[form[w]] if form[w] else None])
    for row in out:
        while form[row[2]] is not None:
            row[2] = form[row[2]]
    return sorted((tuple(r) for r in out), key=lambda r: tuple((x is None, str(x)) for x in r))


def vocabulary(seed, size, letters="abé", longest=9):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(5, longest + 1))) for _ in range(size)}
    return {w: rng.choice([3, 4, 6, 8, 12, 24, 50, 100]) for w in words}


def test_index_finds_exactly_the_words_one_edit_away():
    words = sorted(vocabulary(3, 300, "abc", 8))
    index = spelling.Vocabulary(words)
    pairs = {(words[q], words[w]) for first in (True, False) for q, w in index.near(words, first)}
    assert pairs == {(a, b) for a in words for b in words if one_edit(a, b)}
    strange = ["abcabzabc", "zzzzz", "ab"]
    found = {(strange[q], words[w]) for first in (True, False) for q, w in index.near(strange, first)}
    assert found == {(a, b) for a in strange for b in words if one_edit(a, b)}


@pytest.mark.parametrize("seed,letters,bin_words", [(1, "abé", 10_000), (2, "ab", 25), (3, "abcdefgh", 40)])
def test_groups_match_all_pairs(spark, seed, letters, bin_words):
    n = vocabulary(seed, 400, letters)
    df = spark.createDataFrame(list(n.items()), "word string, n bigint").repartition(3)
    assert plain_rows(spelling.spelling_groups(df, bin_words=bin_words)) == brute_groups(n)


def test_a_half_that_most_words_share_has_several_bins(spark):
    rng = random.Random(5)
    n = {"prefix" + "".join(rng.choice("xyz") for _ in range(5)): rng.randrange(3, 60) for _ in range(200)}
    df = spark.createDataFrame(list(n.items()), "word string, n bigint")
    assert plain_rows(spelling.spelling_groups(df, bin_words=20)) == brute_groups(n)


def test_long_chains_of_forms_end_at_their_root(spark):
    word, n = "abcdefghij", {}
    for k in range(12):  # one more letter is replaced at each step
        n["z" * k + word[k:] if k <= 10 else "z" * k] = 3 << k
    df = spark.createDataFrame(list(n.items()), "word string, n bigint")
    found = plain_rows(spelling.spelling_groups(df))
    assert found == brute_groups(n) and len({r[2] for r in found}) == 1


def test_counts_and_damage(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["Straße", "ÜBER", "house", "Hou-se", "x1yplane", "ábcde", "plane", "ßßßßßß"]) for _ in range(40)))
            for i in range(120)] + [(None, "house " * 4), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert dict(tuple(r) for r in spelling.count_words(df).collect()) == brute_count(rows)
    assert dict(tuple(r) for r in spelling.count_words(df, every=2).collect()) == brute_count(rows, 2)


@pytest.mark.parametrize("clashing", [False, True])
def test_edge_rows(spark, clashing):
    docs = edge_docs(spark, clashing)
    n = brute_count([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert plain_rows(spelling.spelling_groups(spelling.count_words(docs))) == brute_groups(n)


def test_empty_table(spark):
    assert spelling.spelling_groups(spelling.count_words(empty_docs(spark))).collect() == []
