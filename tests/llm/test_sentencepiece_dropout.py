import public_tokenizers
import pytest
import sentencepiece

from clickscope.llm import sentencepiece_dropout as S
from tests.llm.edge import LONG, PARAGRAPH, edge_docs, empty_docs

TEXTS = ["", " ", "  a   b ", "\n\n x\n  y \n", " \t\r\n" + " " * 40 + "z", "日本語テキスト 🎉🎉 é", "x" * 3000,
         "<s></s><unk> <0x41>", "    " * 9 + "def f():\n\treturn 1", "\x00\x01a", "é ﬁ Å", "THE!! end... of|it #tag $5,000.00 a.b.c",
         PARAGRAPH * 3, LONG[:20_000]]


@pytest.fixture(scope="module")
def model():
    return S.read_model(public_tokenizers.path("piece_bpe_32k.model"))


def test_without_dropout_like_the_library(model):
    sp, codec = sentencepiece.SentencePieceProcessor(model_proto=model), S.MergeDropout(model, 0.0)
    for text in TEXTS:
        assert codec.encode(text).tolist() == sp.encode(text), text[:40]


def test_lossless_varied_and_repeatable(model):
    codec, again = S.MergeDropout(model, 0.3), S.MergeDropout(model, 0.3, cache_units=16)
    seen = set()
    for text in [*TEXTS, "a▁b ▁ ▁▁c"]:
        for key in ("1", "2", "3", ""):
            ids = codec.encode(text, key)
            assert codec.decode(ids) == text
            assert again.encode(text, key).tolist() == ids.tolist()  # whatever is cached
            if text is TEXTS[-2]:
                seen.add(ids.tobytes())
    assert len(seen) > 1
    assert S.MergeDropout(model, 0.3, seed=5).encode(PARAGRAPH).tolist() != codec.encode(PARAGRAPH).tolist()


def agenda_one_by_one(codec, unit, variant, dropout):
    """The agenda of one unit, a candidate at a time."""
    cost = dict(zip(codec._pair_keys.tolist(), zip(codec._pair_ranks.tolist(), codec._pair_ids.tolist())))
    base = S.xxhash.xxh64_intdigest(unit.encode(), (codec.seed * 1_000_003 + variant) & S._MASK)
    symbols = [(i, int(codec._of_char[ord(c)])) for i, c in enumerate(unit)]
    dropped = set()
    while True:
        candidates = []
        for k in range(len(symbols) - 1):
            found = cost.get(symbols[k][1] << 32 | symbols[k + 1][1])
            end = symbols[k + 2][0] if k + 2 < len(symbols) else len(unit)
            size = end - symbols[k][0]
            if found and (symbols[k][0], size) not in dropped:
                candidates.append((found[0], symbols[k][0], size, k, found[1]))
        if not candidates:
            return [s for _, s in symbols]
        _, left, size, k, made = min(candidates)
        x = (base + (left * 0x10001 + size) * 0x9E3779B97F4A7C15) & S._MASK
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & S._MASK
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & S._MASK
        if (x ^ (x >> 31)) < int(dropout * 2 ** 64):
            dropped.add((left, size))
        else:
            symbols[k:k + 2] = [(left, made)]


def merge_rows(codec, work):
    """Ids of units under numbered draws, all in one matrix."""
    base = S.np.array([S.xxhash.xxh64_intdigest(unit.encode("utf-8", "surrogatepass"), (codec.seed * 1_000_003 + v) & S._MASK)
                       for unit, v in work], dtype=S.np.uint64)
    return codec._merged([unit for unit, _ in work], base, codec._limit)[0]


def test_matrix_agenda_like_one_candidate_at_a_time(model):
    codec = S.MergeDropout(model, 0.25)
    units = sorted({u for u in codec._unit.findall(" " + PARAGRAPH + LONG[:3000] + " internationalisation") if u.isascii() and u != "\n"})
    work = [(u, v) for u in units for v in range(3)]
    for (unit, variant), ids in zip(work, merge_rows(codec, work)):
        assert S.np.frombuffer(ids, "<i4").tolist() == agenda_one_by_one(codec, unit, variant, 0.25), unit


def test_documents(spark, model):
    docs = edge_docs(spark, clashing=True)
    rows = S.encode_documents(docs, model, keep=("source", "lang")).collect()
    assert len(rows) == docs.count() and all(r["lossless"] for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert by_id[1][0]["token_ids"] == [] and by_id[2][0]["n_tokens"] == 0
    assert by_id[6][0] == by_id[6][1]
    assert by_id[5][0]["n_tokens"] == len(by_id[5][0]["token_ids"]) > 30_000
    assert S.encode_documents(empty_docs(spark), model).collect() == []


def test_parameters(model):
    with pytest.raises(ValueError):
        S.MergeDropout(model, 1.0)


def test_every_occurrence_draws_its_own(model):
    codec = S.MergeDropout(model, 0.1)
    assert len({codec.encode(PARAGRAPH, str(i)).tobytes() for i in range(50)}) > 40
    assert len({codec.encode(PARAGRAPH, "7", copy).tobytes() for copy in range(3)}) == 3
    words = [codec._merged([" internationalisation"], S.np.array([b], dtype=S.np.uint64), codec._limit)[0][0] for b in range(400)]
    parts = codec.encode(" internationalisation" * 400).tolist()
    assert len(set(words)) > 8 and len(parts) > 400 and codec.decode(S.np.array(parts)) == " internationalisation" * 400


def test_every_pair_is_found_in_its_slot_or_beside_it(model):
    codec = S.MergeDropout(model)
    keys = codec._pair_keys[:-1]
    rank, made = codec._ranks(keys >> 32, keys & 0xFFFFFFFF)
    assert rank.tolist() == codec._pair_ranks[:-1].tolist() and made.tolist() == codec._pair_ids[:-1].tolist()
    assert codec._crowded.any() and not codec._crowded.all()  # both ways are taken
    other = S.np.setdiff1d(S.np.concatenate([keys + 1, keys + (1 << 32)]), keys)
    assert (codec._ranks(other >> 32, other & 0xFFFFFFFF)[0] == S.NEVER).all()


def test_distinct_units_are_looked_up_once_and_still_draw_their_own(model, monkeypatch):
    codec, looked = S.MergeDropout(model, 0.25), []
    plain = codec._plain
    monkeypatch.setattr(codec, "_plain", lambda units: looked.append(list(units)) or plain(units))
    texts = [PARAGRAPH * 20, None, "", "internationalisation \U0001f389 " * 300, PARAGRAPH]
    many = codec.encode_many(texts, ["3", "4", "5", "6", "3"], [0, 0, 0, 2, 0])
    assert len(looked) == 1 and len(looked[0]) == len(set(looked[0]))  # not one look-up an occurrence
    alone = S.MergeDropout(model, 0.25, cache_units=8)
    for text, key, copy, ids in zip(texts, ["3", "4", "5", "6", "3"], [0, 0, 0, 2, 0], many):
        units = alone._unit.findall(" " + text) if text else []
        start = S.xxhash.xxh64_intdigest(f"{copy}:{key}".encode(), alone.seed & S._MASK)
        base = alone._mixed(S.np.uint64(start) + S.np.arange(1, len(units) + 1).astype(S.np.uint64) * S.np.uint64(0xD1342543DE82EF95))
        want = b"".join(alone._merged([u], base[i:i + 1], alone._limit)[0][0] for i, u in enumerate(units))
        assert ids.tobytes() == want and codec.decode(ids) == (text or "")
    assert [len(ids) for ids in many[1:3]] == [0, 0] and codec.encode_many([], []) == []


def test_draws_of_the_cached_merges_are_those_of_the_agenda(model):
    codec = S.MergeDropout(model, 0.25)
    units = [u for u in codec._unit.findall(" " + PARAGRAPH) if u != "\n"]
    start = S.xxhash.xxh64_intdigest(b"2:9", codec.seed & S._MASK)
    every = codec._unit.findall(" " + PARAGRAPH)
    place = S.np.arange(1, len(every) + 1).astype(S.np.uint64)
    base = codec._mixed(S.np.uint64(start) + place * S.np.uint64(0xD1342543DE82EF95))
    want = b"".join(codec._merged([u], base[i:i + 1], codec._limit)[0][0] for i, u in enumerate(every))
    assert units and codec.encode(PARAGRAPH, "9", 2).tobytes() == want
