import hashlib
import re

import pytest
from pyspark.sql import functions as F

from clickscope.llm import merkle as M
from tests.llm.edge import edge_docs, empty_docs


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute_fingerprint(text):
    sections, leaves = [], []
    for section in text.split("\n\n"):
        paragraphs = []
        for p in section.split("\n"):
            own = [sha(x) for x in re.findall(M.LEAF, p)]
            leaves += own
            paragraphs.append(sha(",".join(own)))
        sections.append(sha(",".join(paragraphs)))
    return sha(",".join(sections)) + ":" + ",".join(x[:M.BRANCH_DIGITS] for x in leaves)


def brute_likeness(a, b):
    if a == b:
        return 1.0
    x, y = ({v for v in f.split(":")[1].split(",") if v} for f in (a, b))
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 0.0


def brute_places(a, b):
    x, y = ([s.split("\n") for s in t.split("\n\n")] for t in (a, b))
    at = lambda t, i, j: t[i][j] if i < len(t) and j < len(t[i]) else None
    return ",".join(f"{i}:{j}" for i in range(max(len(x), len(y)))
                    for j in range(max(len(t[i]) for t in (x, y) if i < len(t))) if at(x, i, j) != at(y, i, j))


def test_edited_documents_like_brute_force(spark):
    docs = edge_docs(spark, clashing=True)
    # rows that repeat id and text count once in the order; null ids come last
    listed = {(r.doc_id, r.text or "") for r in docs.collect()}
    hashes = {(r.id, r.t): r.h for r in docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("t"))
              .select("id", "t", F.xxhash64("t").alias("h")).collect()}
    order = sorted(listed, key=lambda x: (x[0] is not None, x[0] or 0, hashes[x]), reverse=True)
    after = {x: order[(i + 1) % len(order)][1] for i, x in enumerate(order)}
    want = []
    for r in docs.collect():
        text = r.text or ""
        follow = after[(r.doc_id, text)]
        k = len(text) // 3
        edited = text[:len(text) - k] + follow[:k]
        a, b, c = map(brute_fingerprint, (text, edited, follow))
        want.append((r.doc_id, len(text), sha(edited), a, b, round(brute_likeness(a, b), 9), round(brute_likeness(a, c), 9),
                     brute_places(text, edited)))
    got = [(r.id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9), r.edited_places)
           for r in M.edited_fingerprints(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_whole_texts_are_shuffled_once(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "-1")
    spark.conf.set(keys[1], "false")
    try:
        plan = M.edited_fingerprints(edge_docs(spark).select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert plan.count("ReusedExchange") == 1


def test_lone_document_and_empty_table(spark):
    one = spark.createDataFrame([(3, "abcdef")], "doc_id bigint, text string")
    r, = M.edited_fingerprints(one).collect()
    assert r.edited_sha256 == sha("abcdab") and r.near_next == 1.0
    assert M.edited_fingerprints(empty_docs(spark)).collect() == []


def test_order_holds_across_partitions(spark):
    ids = [(i * 7919 % 1000, f"text {i}") for i in range(300)]
    keys = spark.createDataFrame(ids, "id bigint, t string").select("id", F.xxhash64("t").alias("text_hash"), F.lit(1).alias("n_chars"))
    got = {r.id: r.next_id for r in M.next_documents(keys).collect()}
    order = sorted((i for i, _ in ids), reverse=True)
    assert got == {a: b for a, b in zip(order, order[1:] + order[:1])}


@pytest.mark.parametrize("a,b,places", [
    ("x\ny\n\nz", "x\ny\n\nz", []), ("x\ny\n\nz", "x\nY\n\nz", [(0, 1)]), ("x\ny\n\nz\nw", "x\ny\n\nz\nW", [(1, 1)]),
    ("a", "a\n\nb", []), ("a\n\nb", "a", [(1, 0)]), ("", "q", [(0, 0)])])
def test_differing_branches_locate_edits(spark, a, b, places):
    df = spark.createDataFrame([(a, b)], "a string, b string").select(M.differing(M.tree(F.col("a")), M.tree(F.col("b"))).alias("d"))
    assert [tuple(x) for x in df.first()["d"]] == places


@pytest.mark.parametrize("a,b,places", [
    ("x\ny\n\nz", "x\ny\n\nz", []), ("a", "a\n\nb", [(1, 0)]), ("a\n\nb", "a", [(1, 0)]), ("a", "a\nb\nc", [(0, 1), (0, 2)]),
    ("a\nb", "a", [(0, 1)]), ("a\n\nb", "A\n\nb\n\nc\nd", [(0, 0), (2, 0), (2, 1)]), (None, "q", [(0, 0)])])
def test_edits_have_the_places_of_both_trees(spark, a, b, places):
    df = spark.createDataFrame([(a, b)], "a string, b string").select(M.edits(M.tree(F.col("a")), M.tree(F.col("b"))).alias("d"))
    assert [tuple(x) for x in df.first()["d"]] == places


def test_cuts_are_part_of_the_tree(spark):
    texts = ["ab", "a\nb", "a\n\nb", "a\n\n\nb", "", "\n", "a.b", "a. b", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(M.fingerprint(M.tree(F.col("t"))).alias("f"))
    found = [r.f for r in df.collect()]
    assert len(set(found)) == len(texts) - 1 and found[4] == found[-1]  # a null is an empty text
