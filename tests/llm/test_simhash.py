import random

import numpy as np
import pytest
import xxhash

from clickscope.llm import simhash as H
from clickscope.llm.components import connected_components
from tests.llm.edge import PARAGRAPH, edge_docs, empty_docs


def brute_fingerprint(text, n=4):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    shingles = [b" ".join(ws[i:i + n]) for i in range(max(1, len(ws) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, max_bits):
    root = {f: f for f in set(fps)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in root:
        for b in root:
            if bin(a ^ b).count("1") <= max_bits:
                root[find(a)] = find(b)
    low = {}
    for i, f in zip(ids, fps):
        if i is not None:
            low[find(f)] = min(i, low.get(find(f), i))
    return [low.get(find(f)) for f in fps]


def test_documents_like_brute_force(spark):
    rng = random.Random(4)
    base = [" ".join(rng.choices(PARAGRAPH.split(), k=80)) for _ in range(12)]
    texts = base + [t + " " + rng.choice("abc") for t in base for _ in range(3)] + base[:4]
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    docs = edge_docs(spark, clashing=True).select("doc_id", "text", "id", "fp", "component").unionByName(more, allowMissingColumns=True)
    rows = docs.select("doc_id", "text").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    want = sorted(zip([r.doc_id for r in rows], [f"{f:016x}" for f in fps], brute_components([r.doc_id for r in rows], fps, 4)), key=str)
    got = [(r.id, r.fingerprint, r.component) for r in H.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == want
    assert H.near_duplicates(empty_docs(spark)).collect() == []


@pytest.mark.parametrize("max_bits", [0, 1, 4, 6])
def test_every_ring_finds_exactly_the_links(spark, max_bits):
    rng = np.random.default_rng(max_bits)
    fps = list(rng.integers(0, 1 << 63, 60, dtype=np.uint64) * 2 + 1)
    for f in list(fps):
        for k in range(1, 9):
            x = int(f)
            for b in rng.choice(64, k, replace=False):
                x ^= 1 << int(b)
            fps.append(np.uint64(x))
    fps = np.unique(np.array(fps, dtype=np.uint64))
    signed = fps.view(np.int64).tolist()
    want = {tuple(sorted((signed[i], signed[j]))) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= max_bits) if j != i}
    nodes = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    plans = [H.ring(max_bits, c, b) for c, b in ((1, 1), (2, 3), (3, 2)) if c <= max_bits + 1] + [H.choose_ring(max_bits, 10**9)]
    for plan in plans:
        got = [tuple(sorted(r)) for r in H.fingerprint_links(nodes, max_bits, plan).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5000), (None, 3), (7001, 7000), (7000, 7001)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(50)}, 7000: 7000, 7001: 7000}


def test_one_row_of_each_group_stays(spark):
    docs = edge_docs(spark, clashing=True)
    kept = H.keep_representatives(docs)
    assert kept.columns == docs.columns
    groups = {r.component for r in H.near_duplicates(docs).collect()}
    rows = kept.collect()
    assert len(rows) == len(groups) and {r.doc_id for r in rows} == groups
    only_null = docs.where("doc_id is null")
    assert H.keep_representatives(only_null.unionByName(only_null)).count() == 1
    assert H.keep_representatives(empty_docs(spark)).count() == 0


def test_the_hash_is_xxh64_of_utf8_with_seed_42(spark):
    r = spark.sql("select xxhash64('the quick brown föx') h").first()
    assert r.h & (1 << 64) - 1 == xxhash.xxh64_intdigest("the quick brown föx".encode(), 42)


def test_a_large_class_is_no_single_tasks_load(spark, monkeypatch):
    """The minimum of a class comes back by broadcast where the class is large; the rows are the same."""
    rows = [(i, 1000 + i, 7 if i < 400 else i) for i in range(700)] + [(1000, None, 7), (1001, None, 1001)]
    grouped = spark.createDataFrame(rows, "fp bigint, low bigint, root bigint").repartition(4)
    want = sorted((fp, 1000 if root == 7 else low, root) for fp, low, root in rows)
    for size in (100, 10_000):
        monkeypatch.setattr(H, "LARGE_CLASS", size)
        assert sorted(map(tuple, H._class_minima(grouped).collect()), key=lambda r: r[0]) == want
