import math
import random
import re

import pytest
from pyspark.sql import functions as F

from clickscope.llm import licenses as L
from tests.llm.edge import edge_docs, empty_docs

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute_matches(text, prefixes, templates=L.TEMPLATES, threshold=L.THRESHOLD):
    """(paragraph, rank, label, covered, begin, end) by a look at every window around every prefix word."""
    found = []
    for p, paragraph in enumerate(re.split(L.BLANK_LINE, text or "")):
        ws = split(paragraph)
        for k, (label, notice) in enumerate(templates):
            t = set(split(notice))
            if not t:
                continue
            needed, width = max(1, math.ceil(len(t) * threshold - 1e-9)), math.ceil(len(split(notice)) / threshold)
            for i in (i for i, w in enumerate(ws) if w in prefixes[k]):
                shared, s = max((len(t & set(ws[s:s + width])), s) for s in range(max(0, i - width + 1), i + 1))
                if shared >= needed:
                    hits = [j for j in range(s, min(len(ws), s + width)) if ws[j] in t]
                    found.append((p, (shared / len(t), len(t), -k), label, frozenset(t & set(ws[s:s + width])), hits[0], hits[-1]))
    return set(found)


def brute_prefixes(texts, templates=L.TEMPLATES, threshold=L.THRESHOLD):
    held = [set(split(t)) for t in texts]
    out = []
    for _, notice in templates:
        t = sorted(set(split(notice)), key=lambda w: (sum(w in h for h in held), w))
        out.append(set(t[:len(t) - max(1, math.ceil(len(t) * threshold - 1e-9)) + 1]))
    return out


def brute(text, prefixes, templates=L.TEMPLATES, threshold=L.THRESHOLD):
    ws, starts, base = split(text), [], set()
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(ws)) if ws[i:i + len(p)] == p]
        starts += at
        base |= {label} if at else set()
    met = brute_matches(text, prefixes, templates, threshold)
    kept = [m for m in met if not any(o[0] == m[0] and o[1] > m[1] and o[4] <= m[5] and m[4] <= o[5] and m[3] <= o[3] for o in met)]
    return (len(ws), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {m[2] for m in kept})), round(max((m[1][0] for m in kept), default=0.0), 9))


TEXTS = ["MIT License", "the mit-license, Apache\nLicense", "x GENERAL public License general public license mit license", "licence",
         "Licensed under CC BY-NC 4.0.", "licensed under cc by 4 0", "Released Under\tthe mit license today", "MÎT license ümit license",
         "a K mité license", "Redistribution and use in source and binary forms, with or without change, are permitted",
         "license license license", "public license general", "gnu GENERAL\u0000PUBLIC/LICENSE version 3 this work is licensed under the"]


def test_documents_like_brute_force(spark):
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(TEXTS)], "doc_id bigint, text string")
    docs = edge_docs(spark, clashing=True).unionByName(more, allowMissingColumns=True)
    got = [(r.id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in L.scan(docs).collect()]
    prefixes = brute_prefixes([r.text for r in docs.collect()])
    assert sorted(got, key=str) == sorted(((r.doc_id, *brute(r.text, prefixes)) for r in docs.collect()), key=str)
    assert L.scan(empty_docs(spark)).collect() == []


@pytest.mark.parametrize("seed,threshold", [(1, 0.8), (2, 0.8), (3, 0.5), (4, 1.0)])
def test_windows_and_covers_like_brute_force(spark, seed, threshold):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(9)]
    # templates that share words, hold one another, repeat words
    templates = [(f"t{k % 7}", " ".join(rng.choices(vocabulary[:7], k=rng.randint(1, 8)))) for k in range(9)] + [("none", "...")]
    texts = [None, ""] + [" ".join(rng.choice(vocabulary) if rng.random() < 0.8 else rng.choice(["\n", "\n \n", "x", "y z", "w0 w0"])
                                   for _ in range(rng.randint(0, 70))) for _ in range(60)]
    texts += texts[5:9] + ["w0 " * 300, "w1 " + "x " * 2000 + "w2"]
    docs = spark.createDataFrame([(None if i == 7 else i % 60, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    prefixes = brute_prefixes(texts, templates, threshold)
    got = [(r.id, r.labels, round(r.score, 9)) for r in L.scan(docs, templates, threshold, {}).collect()]
    want = []
    for r in docs.collect():
        met = brute_matches(r.text, prefixes, templates, threshold)
        kept = [m for m in met if not any(o[0] == m[0] and o[1] > m[1] and o[4] <= m[5] and m[4] <= o[5] and m[3] <= o[3] for o in met)]
        want.append((r.doc_id, ",".join(sorted({m[2] for m in kept})), round(max((m[1][0] for m in kept), default=0.0), 9)))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(x[1] != "" for x in want) > 20


def test_words_far_apart_are_no_notice(spark):
    far = (" x" * 500 + " ").join(["released", "under", "the", "license"])
    long = next(t for label, t in L.TEMPLATES if label == "isc")
    assert labels_of(spark, [far, long, long.replace(" ", "\n * "), long.replace(" ", " x x ")]) == ["", "isc", "isc", ""]


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.8, 1.0])
def test_join_finds_every_pair_and_each_once(spark, threshold):
    rng = random.Random(int(threshold * 10))
    vocabulary = [f"w{i}" for i in range(25)]
    templates = [("t", " ".join(rng.sample(vocabulary, rng.randint(1, 9)))) for _ in range(15)]
    blocks = [(i, rng.sample(vocabulary, rng.randint(1, 14))) for i in range(150)]
    table = L.template_table(spark, templates)
    docs = spark.createDataFrame([(" ".join(w),) for _, w in blocks], "text string")
    index = L.prefix_index(table, L.word_frequencies(docs, vocabulary), threshold)
    got = [(r.block, r.template, round(r.containment, 9))
           for r in L.matching_blocks(spark.createDataFrame(blocks, "block bigint, words array<string>"), index).collect()]
    want = []
    for i, words in blocks:
        for k, (_, notice) in enumerate(templates):
            t = set(notice.split())
            if len(t & set(words)) >= max(1, math.ceil(len(t) * threshold - 1e-9)):
                want.append((i, k, round(len(t & set(words)) / len(t), 9)))
    assert sorted(got) == sorted(want)


def test_words_are_ordered_by_document_frequency(spark):
    docs = spark.createDataFrame([("a b",), ("a a c",), ("A",), (None,)], "text string")
    freq = L.word_frequencies(docs, ["a", "b", "zz"])
    assert {r.word: r.docs for r in freq.collect()} == {"a": 3, "b": 1}
    index = L.prefix_index(L.template_table(spark, [("x", "a b zz")]), freq, 0.5)
    assert [(r.word, r.place) for r in index.orderBy("place").collect()] == [("zz", 0), ("b", 1)]
    assert index.where(F.col("needed") != 2).count() == 0


def labels_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [r.labels for r in L.scan(docs).orderBy("id").collect()]


def test_wrapped_notices(spark):
    wrapped = [("Redistribution and use in source and binary forms, with or without\nmodification, are permitted", "bsd"),
               ("x\n\n * licensed under the GNU\n * Lesser General Public License\n\ny", "gpl,lgpl"),  # a phrase names gpl
               ("Licensed under\r\nCC BY-NC 4.0.", "cc-by-nc"),
               ("Permission is hereby\ngranted, free of charge,\nto any person obtaining\na copy of this software", "mit"),
               ("Licensed under\n\n" + "CC BY-NC 4.0.", ""),  # a blank line ends a paragraph
               ("licensed " + "a " * 20 + "under\ncc by nc 4 0", "cc-by-nc")]  # six of seven words
    assert labels_of(spark, [t for t, _ in wrapped]) == [x for _, x in wrapped]
    docs = spark.createDataFrame([(1, wrapped[0][0])], "doc_id bigint, text string")
    assert L.scan(docs).first().score == 1.0


def test_several_notices_in_one_line(spark):
    two = "Licensed under CC BY-NC 4.0. Redistribution and use in source and binary forms, with or without modification, are permitted"
    texts = [two, "Licensed under CC BY 4.0. " + "word " * 9 + "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC 4.0.",
             "Licensed under CC BY-NC 4.0. Licensed under CC BY-SA 4.0.", " - ".join(w + " x x x" for w in two.split())]
    assert labels_of(spark, texts) == ["bsd,cc-by-nc", "cc-by,cc-by-nc", "cc-by-nc", "cc-by-nc,cc-by-sa", ""]
