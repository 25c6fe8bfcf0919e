import json
import os
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clickscope.llm import token_files as T
from tests.llm.edge import LONG, PARAGRAPH, edge_docs, empty_docs

TEXTS = ["", " ", PARAGRAPH, "<|ENDOFTEXT|> A.. b,, c., it's. don't! s. 's, x;: ", "a<|endoftext|>b <|startoftext|>", "THE End, end. É, é. ÉTÉ. é, ",
         "  ́x Σίγμας ΣΑΣ ", "12 3.4 日本語テ 🎉\x1c\x1d\x85\xa0 x​y", "\n\t\v\f\r ", LONG[:5000]]


@pytest.fixture(scope="module")
def tokenizer():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def test_words_one_by_one_like_whole_texts(tokenizer):
    whole = Tokenizer.from_str(tokenizer)
    for cache in (4, 100_000):
        encoder = T.WordEncoder(tokenizer, "<u2", cache)
        for _ in range(2):
            for text, ids in zip(TEXTS, encoder.encode_many([t.encode() for t in TEXTS])):
                assert np.frombuffer(ids, "<u2").tolist() == whole.encode(text, add_special_tokens=False).ids, text[:30]


def test_assumptions_are_tried_out_and_other_tokenizers_get_whole_texts(tokenizer):
    assert T.word_wise(Tokenizer.from_str(tokenizer)) == (True, True, True)
    told = json.loads(tokenizer)

    def changed(**parts):
        return json.dumps({**told, **parts})

    cased = changed(normalizer={"type": "NFC"})
    byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    glued = changed(pre_tokenizer={"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, byte_level]})
    spaced = changed(pre_tokenizer=byte_level)
    for other, want in ((cased, (True, False, True)), (glued, (True, True, False)), (spaced, (False, None, None))):
        whole, encoder = Tokenizer.from_str(other), T.WordEncoder(other, "<u2")
        assert all(b is None or a == b for a, b in zip(T.word_wise(whole), want))
        for text, ids in zip(TEXTS, encoder.encode_many([t.encode() for t in TEXTS])):
            assert np.frombuffer(ids, "<u2").tolist() == whole.encode(text, add_special_tokens=False).ids, (want, text[:30])


class Counting:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **how):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **how)


def test_many_new_words_go_in_one_call(tokenizer):
    whole, encoder = Tokenizer.from_str(tokenizer), T.WordEncoder(tokenizer, "<u2")
    encoder._tokenizer = counting = Counting(encoder._tokenizer)
    text = " ".join(f"w{a}{b}\u00e9{'x' * (i % 5)}" for i, a in enumerate("abcdefghijklmnopqrst") for b in "abcdefghijklmnopqrst")
    ids, = encoder.encode_many([text.encode()])
    assert np.frombuffer(ids, "<u2").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert counting.texts == 4  # 400 words


def test_occurrences_of_known_words_are_no_python_objects(tokenizer):
    """Only the distinct words of a slice are: half a million of seven words need less than twice the text and ids."""
    encoder = T.WordEncoder(tokenizer, "<u2")
    text = "the of it's \u00e9t\u00e9 end. THE\x0b\f x; " * 75_000
    encoder.encode_many([text[:100].encode()])
    tracemalloc.start()
    try:
        ids, = encoder.encode_many([text.encode()])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    once, = encoder.encode_many([text[:len(text) // 75_000].encode()])
    assert ids == once * 75_000
    assert peak < 2 * (len(text.encode()) + len(ids))


def test_white_space_at_the_ends_and_empty_slices(tokenizer):
    whole, encoder = Tokenizer.from_str(tokenizer), T.WordEncoder(tokenizer, "<u2")
    texts = ["", "\t\n", " a", "a\r", "\x0b\x0ca  b\n", "\xa0a\x85b\x1c c", "", "<|ENDOFTEXT|> A", "A <|endoftext|>B C", "D"]
    for part in (texts, texts[:2], texts[:1], []):
        ids = encoder.encode_many([t.encode() for t in part])
        assert [np.frombuffer(i, "<u2").tolist() for i in ids] == [whole.encode(t, add_special_tokens=False).ids for t in part]


def test_groups_that_do_not_spell_their_words_are_encoded_one_by_one(tokenizer):
    told = json.loads(tokenizer)
    told["normalizer"]["normalizers"].append({"type": "Replace", "pattern": {"String": "qu"}, "content": "k"})
    other = json.dumps(told)
    whole, encoder = Tokenizer.from_str(other), T.WordEncoder(other, "<u2")
    assert encoder._apart
    texts = ["one quick two", "three four quqqu", "e\u0301 \u00c9 five \u0421 \u65e5\u672c a<|endoftext|>b " + " ".join(map(str, range(300)))]
    for text, ids in zip(texts, encoder.encode_many([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u2").tolist() == whole.encode(text, add_special_tokens=False).ids, text[:30]


def test_files_read_back_in_id_order(spark, tokenizer, tmp_path):
    docs = edge_docs(spark, clashing=True).repartition(5)
    manifest = T.write_token_files(docs, f"file://{tmp_path}/x", tokenizer, 2)
    rows = T.read_token_files(spark, manifest).collect()
    whole = Tokenizer.from_str(tokenizer)
    texts = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in docs.collect()))
    rows.sort(key=lambda r: r.start)
    assert [r.id for r in rows] == [i if known else None for known, i, _ in texts]
    start = 0
    for r, (_, _, text) in zip(rows, texts):
        ids = whole.encode(text, add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_flat_files_and_prefix_sums(spark, tokenizer, tmp_path):
    docs = edge_docs(spark).where("doc_id is not null")
    manifest = T.write_token_files(docs, str(tmp_path), tokenizer, 2)
    with open(manifest) as f:
        index = json.load(f)
    assert index["dtype"] == "<u2"
    at = 0
    for part in index["parts"]:
        stem = os.path.join(tmp_path, part["stem"])
        assert part["base"] == at and os.path.getsize(stem + ".bin") == 2 * part["n_ids"]
        offsets = np.fromfile(stem + ".off", "<i8")
        assert offsets[0] == 0 and offsets[-1] == part["n_ids"] and len(offsets) == part["n_docs"] + 1
        at += part["n_ids"]
    assert at == index["n_ids"]


def test_empty_table_and_unmounted_folder(spark, tokenizer, tmp_path):
    manifest = T.write_token_files(empty_docs(spark), str(tmp_path), tokenizer, 2)
    assert T.read_token_files(spark, manifest).collect() == []
    with pytest.raises(ValueError):
        T.local_folder("hdfs://x/y")


def test_wide_vocabularies_get_32_bits(spark, tokenizer, tmp_path):
    manifest = T.write_token_files(edge_docs(spark).where("doc_id = 4"), str(tmp_path), tokenizer, end_id=70_000)
    assert json.load(open(manifest))["dtype"] == "<u4"
    row, = T.read_token_files(spark, manifest).collect()
    assert row.n_tokens >= 2
