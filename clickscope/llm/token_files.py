"""Token ids as flat binary files that training can memory-map.

One part per task of the ordered table, three flat little-endian files each:

- ``.bin``: the ids of all its documents on end, unsigned 16 bits wide where
  the vocabulary allows, else 32;
- ``.off``: 64-bit offsets, in ids, where each document begins, and the end;
- ``.doc``: the documents' 64-bit ids (``NO_ID`` for a null).

Offsets in a part count from the part's own start. Each task reports how many
ids it wrote; prefix sums over these few numbers give every part its base, and
base + offset is a document's place among all ids of the corpus. A retried or
speculative task writes under a name of its own, and only parts of successful
tasks are in the manifest, so a lost executor costs its tasks and no more. The
folder must be mounted on all executors, as ``spark.checkpoint.dir`` is.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickscope.llm.common import importable_by_workers, pick

NO_ID = np.iinfo(np.int64).min
CACHE_WORDS = 1_360_000  # per Python worker: some 260 MB
TEXT_BYTES = 1 << 22  # text that is encoded together
JOINED_WORDS = 100  # new words that one call of the tokenizer gets
READ_DOCS = 4096  # documents of a part that are read together
_MARKS, _LETTERS = b".,!?;:", b"abcdefghijklmnopqrstuvwxyz"


_PROBES = "aZz9_.,'!-<|\u00e9\u0301\u0421\u03c3\u65e5\U0001f389"


def word_wise(tokenizer: Tokenizer) -> tuple[bool, bool, bool]:
    """What may be used of a tokenizer, found by trying it out.

    Whether words between ASCII white space are encoded by themselves, whether
    A-Z count as a-z, and whether a mark behind a letter is cut off. Splits
    depend on the kinds of the two characters that meet, so all kinds are
    tried on either side of every white space, and all letters before every
    mark.
    """
    ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    alone = {c: ids(c) for c in _PROBES}
    apart = all(ids(a + space + b) == alone[a] + alone[b] for a in _PROBES for b in _PROBES for space in " \t\n\v\f\r")
    apart = apart and all(ids(space + c + space * 2) == alone[c] for c in _PROBES for space in " \t\n\v\f\r")
    letters = [chr(b) for b in _LETTERS]
    lowers = all(ids(a + b.upper() + c) == ids(a + b + c) for b in letters for a, c in (("", ""), ("q", "x"), ("9", "\u00e9"), ("'", "")))
    stems = [*letters, *(f"{x}{c}" for c in letters for x in ("q", "9", "it'", "\u00e9"))]
    cuts = all(ids(stem + chr(m)) == ids(stem) + ids(chr(m)) for stem in stems for m in _MARKS)
    return apart, lowers, cuts


def spellings(tokenizer: Tokenizer) -> list[bytes]:
    """The bytes each id stands for, its end-of-word suffix left out, by the usual alphabet of byte-level vocabularies."""
    suffix = json.loads(tokenizer.to_str())["model"].get("end_of_word_suffix") or ""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # these bytes are written as themselves
    byte_of = {chr(b): b for b in shown}
    byte_of.update((chr(256 + i), b) for i, b in enumerate(sorted(set(range(256)) - set(shown))))
    vocab = tokenizer.get_vocab(with_added_tokens=True)
    spelled = [b""] * (max(vocab.values(), default=-1) + 1)
    for token, i in vocab.items():
        part = token.removesuffix(suffix)
        known = [byte_of.get(c) for c in part]
        spelled[i] = part.encode() if None in known else bytes(known)
    return spelled


class WordEncoder:
    """Ids of texts, one word at a time where the tokenizer allows it.

    A tokenizer that drops white space sees every run between ASCII white
    space by itself, so a word's ids are worked out once and kept in a bounded
    cache. ``word_wise`` tries that out, as it does lower-casing and the cut
    before marks; any other tokenizer gets whole texts. A call of the tokenizer
    costs as much as a short word, so many new words go in one call.
    """

    def __init__(self, tokenizer: str, dtype: str, cache_words: int = CACHE_WORDS):
        self._tokenizer = Tokenizer.from_str(tokenizer)
        self._apart, self._lowers, self._cuts = word_wise(self._tokenizer)
        special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._apart = self._apart and not any(re.search(r"\s", name) for name in special)
        self._spelled = spellings(self._tokenizer)
        self._sizes = np.array([len(part) for part in self._spelled])
        self._names = [name.encode().lower() for name in special]
        self._dtype = np.dtype(dtype)
        self._code = {2: "H", 4: "I"}[self._dtype.itemsize]
        self._room = max(1, cache_words // 2)
        self._young: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}

    def encode_many(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each UTF-8 text, as bytes of ``dtype``."""
        if not self._apart:
            whole = self._tokenizer.encode_batch_fast([text.decode() for text in texts], add_special_tokens=False)
            return [array(self._code, e.ids).tobytes() for e in whole]
        # ASCII white space is 0x20 and 0x09-0x0D; large types, as a slice may hold one text of any size
        split = pc.ascii_split_whitespace(self._folded(pa.array(texts, pa.large_binary())).view(pa.large_string()))
        words = split.flatten().dictionary_encode()
        ids = pa.array(self._ids(words.dictionary), pa.large_binary()).take(words.indices)
        stops = np.frombuffer(ids.buffers()[1], "<i8")[split.offsets.to_numpy()].tolist() if len(ids) else [0] * (len(texts) + 1)
        flat = memoryview(ids.buffers()[2] or b"")
        return [bytes(flat[low:high]) for low, high in zip(stops, stops[1:])]

    def _ids(self, distinct: pa.Array) -> list[bytes]:
        """The ids of each of these words, which are distinct and not null; new ones go to the young half of the cache."""
        # no word has a space, so one split makes them all; a space at either end of a text leaves an empty word
        row = pa.ListArray.from_arrays([0, len(distinct)], distinct.view(pa.large_binary()))
        words = pc.binary_join(row, pa.scalar(b" ", pa.large_binary()))[0].as_py().split(b" ")
        ids = list(map(self._young.get, words))
        new: dict[bytes, bytes | None] = {w: None for w, known in zip(words, ids) if known is None}
        new.pop(b"", None)
        self._look_up(new)
        if len(self._young) + len(new) > self._room:
            self._old, self._young = self._young, {}
        self._young.update(new)
        return [(new[w] if w else b"") if known is None else known for w, known in zip(words, ids)]

    def _folded(self, texts: pa.Array) -> pa.Array:
        """Where the tokenizer lower-cases, A-Z may go first; not where that could make, or break, a special token's name."""
        if not self._lowers:
            return texts
        lowered = pc.ascii_lower(texts.view(pa.large_string())).view(pa.large_binary())
        for name in self._names:
            texts_with = pc.match_substring(lowered, name)
            if pc.any(texts_with).as_py():
                lowered = pc.if_else(texts_with, texts, lowered)
        return lowered

    def _look_up(self, new: dict[bytes, bytes | None]) -> None:
        """Fill in the ids of all words in ``new``, adding the stems that it meets.

        Where the tokenizer cuts between a letter and a mark, a word of a
        letter and one last mark is its stem's ids and the mark's.
        """
        young, old = self._young, self._old
        joined = []
        for w in list(new):
            ids = old.get(w)
            if ids is not None:
                new[w] = ids
            elif self._cuts and len(w) > 1 and w[-1] in _MARKS and w[-2] in _LETTERS:
                joined.append(w)
                for part in (w[:-1], w[-1:]):
                    if part not in new:
                        new[part] = young.get(part) or old.get(part)
        parted = set(joined)
        missing = [w for w, ids in new.items() if ids is None and w not in parted]
        new.update(self._encoded(missing))
        for w in joined:
            new[w] = new[w[:-1]] + new[w[-1:]]

    def _encoded(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The tokenizer's ids of words, many of which go in one call, with spaces between.

        Words are encoded by themselves, so the ids of a group are those of its
        words on end; they are told apart by the bytes that the ids spell.
        Where these are not the words' own bytes, with an id's end at every
        word's end, the group's words are encoded one by one, as are words that
        a tokenizer often normalises.
        """
        out: dict[bytes, bytes] = {}
        plain, single = [], []
        for w in words:
            (plain if w.isascii() or _normal(w.decode()) else single).append(w)
        groups = [plain[low:low + JOINED_WORDS] for low in range(0, len(plain), JOINED_WORDS)]
        texts = [b" ".join(group).decode() for group in groups]
        for group, e in zip(groups, self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, dtype=self._dtype)
            sizes, want = self._sizes[ids], np.cumsum([len(w) for w in group])
            ends = np.cumsum(sizes)
            if sizes.all() and b"".join(map(self._spelled.__getitem__, e.ids)) == b"".join(group):
                at = np.searchsorted(ends, want)
                if (ends[at] == want).all():
                    packed, stops = ids.tobytes(), ((at + 1) * ids.itemsize).tolist()
                    out.update((w, packed[low:high]) for w, low, high in zip(group, [0, *stops], stops))
                    continue
            single += group
        for w, e in zip(single, self._tokenizer.encode_batch_fast([w.decode() for w in single], add_special_tokens=False)):
            out[w] = array(self._code, e.ids).tobytes()
        return out


def _normal(word: str) -> bool:
    return unicodedata.is_normalized("NFC", word) and word.lower() == word


@lru_cache(maxsize=2)
def _encoder(tokenizer: str, dtype: str) -> WordEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
    return WordEncoder(tokenizer, dtype)


def local_folder(folder: str) -> str:
    """The mounted path of a plain or file: folder; other schemes cannot be memory-mapped."""
    parsed = urlparse(folder)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"token files need a mounted folder that can be memory-mapped, not {folder}")
    return parsed.path


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text") -> str:
    """Encode every row of ``docs`` into token files in ``folder``; returns the manifest's path.

    ``tokenizer`` is a tokenizer's JSON (see ``WordEncoder``). Rows are
    written in ascending id order, null ids first; rows that share an id in
    the order of their text hashes. Ids must be integers. A null text counts
    as empty: a document of the end id alone. An empty table has no parts.
    Extra columns are ignored.
    """
    importable_by_workers(docs.sparkSession)
    target = local_folder(folder)
    os.makedirs(target, exist_ok=True)
    top = max(Tokenizer.from_str(tokenizer).get_vocab_size(with_added_tokens=True) - 1, end_id)
    dtype = "<u2" if top < 1 << 16 else "<u4"
    end = np.array([end_id], dtype=dtype).tobytes()
    width = len(end)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, dtype)
        part = TaskContext.get().partitionId()
        stem = f"{part:07d}-{uuid.uuid4().hex}"
        at, n_docs = 0, 0
        with (open(f"{target}/{stem}.bin", "wb") as ids_file, open(f"{target}/{stem}.off", "wb") as off_file,
              open(f"{target}/{stem}.doc", "wb") as doc_file):
            off_file.write(np.zeros(1, "<i8").tobytes())
            for batch in batches:
                texts = batch.column(1).cast(pa.binary())
                doc_file.write(pc.fill_null(batch.column(0), int(NO_ID)).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                for low, high in _slices(texts):
                    encoded = encoder.encode_many([t or b"" for t in texts.slice(low, high - low).to_pylist()])
                    offsets = at + np.cumsum([len(e) // width + 1 for e in encoded])
                    ids_file.write(end.join(encoded) + end)
                    off_file.write(offsets.astype("<i8").tobytes())
                    at = int(offsets[-1])
                n_docs += len(texts)
        if n_docs:
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "stem": [stem],
                                              "n_docs": pa.array([n_docs], pa.int64()), "n_ids": pa.array([at], pa.int64())})

    rows = pick(docs, id_col, text_col).toDF("id", "text").withColumn("id", F.col("id").cast("bigint"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text").asc()]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = ordered.mapInArrow(write, "part bigint, stem string, n_docs bigint, n_ids bigint").collect()  # one row a task
    parts.sort(key=lambda p: p["part"])
    bases = [0, *accumulate(p["n_ids"] for p in parts)]
    manifest = {"dtype": dtype, "end_id": end_id, "n_ids": bases[-1], "parts": [
        {"stem": p["stem"], "base": base, "n_docs": p["n_docs"], "n_ids": p["n_ids"]} for p, base in zip(parts, bases)]}
    path = f"{target}/manifest.json"
    with open(f"{path}.tmp", "w") as f:
        json.dump(manifest, f)
    os.replace(f"{path}.tmp", path)
    return path


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``TEXT_BYTES`` of text each."""
    low, size = 0, 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        size += n or 0
        if size >= TEXT_BYTES:
            yield low, i + 1
            low, size = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


def read_token_files(spark: SparkSession, manifest: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) per document, read from memory-mapped parts.

    ``start`` counts the ids of all documents before it; ``n_tokens`` includes
    the end id; ``ids_crc32`` is over the ids as little-endian unsigned 32-bit
    integers.
    """
    importable_by_workers(spark)
    schema = "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    with open(manifest) as f:
        index = json.load(f)
    folder, dtype = os.path.dirname(manifest), index["dtype"]
    if not index["parts"]:
        return spark.createDataFrame([], schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                stem = f"{folder}/{part['stem']}"
                ids = np.memmap(f"{stem}.bin", dtype=dtype, mode="r")
                offsets = np.memmap(f"{stem}.off", dtype="<i8", mode="r")
                names = np.memmap(f"{stem}.doc", dtype="<i8", mode="r")
                if len(ids) != part["n_ids"] or len(offsets) != part["n_docs"] + 1 or len(names) != part["n_docs"]:
                    raise OSError(f"{stem} is not as long as the manifest says")
                for low in range(0, part["n_docs"], READ_DOCS):
                    ends = np.array(offsets[low:low + READ_DOCS + 1])
                    own = np.array(names[low:low + READ_DOCS])
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(ends[:-1], ends[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, pa.int64(), mask=own == NO_ID), pa.array(part["base"] + ends[:-1]),
                         pa.array(np.diff(ends)), pa.array(crc, pa.int64())], names=["id", "start", "n_tokens", "ids_crc32"])

    parts = spark.createDataFrame([(p["stem"], p["base"], p["n_docs"], p["n_ids"]) for p in index["parts"]],
                                  "stem string, base bigint, n_docs bigint, n_ids bigint")
    return parts.repartition(len(index["parts"])).mapInArrow(read, schema)
