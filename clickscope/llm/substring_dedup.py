"""Substring dedup by super-k-mer partitioning.

A window is ``window`` consecutive words of one document. Every word that is
covered by a window whose word sequence also starts earlier (smaller document
id, or the same document and an earlier start) is removed; windows are judged
on the input, not on what is left.

The minimiser of a window is the smallest hash among its runs of ``minimiser``
consecutive words. Neighbouring windows mostly share it, and all windows of
one word sequence have the same one, so consecutive windows that share a
minimiser travel as one packed string, a super-k-mer, to the bucket their
minimiser names. A bucket sorts its windows by a 64-bit hash and compares the
words of equal ones, so windows are counted exactly; hashes only sort.

Bounded work where copies are many:

* Each map batch looks at its documents in order and sends a super-k-mer's
  string once; a later copy in the batch starts later, so its words are
  removed on the spot. A group of copies, however large, reaches a bucket as
  one string per batch.
* A passage that many documents share has super-k-mers at its ends that hold
  words of both sides, different in each document. A first pass counts the
  minimisers; the windows of one that is too frequent travel singly and are
  dealt by their own hash. There are at most 16 such values per shuffle
  partition. A value is missed only if it has less than 1 / (8 partitions) of
  all super-k-mers, or at most one per map batch.
* The number of buckets grows with the number of super-k-mers.

Documents are told apart by id and a 64-bit hash of the text. Rows with equal
ids and different texts come in the order of that hash; of rows equal in both,
one is the earliest. A null id comes before all others. A null or blank text
has no words and stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickscope.llm.common import durable, importable_by_workers, pick

WINDOW = 20
MINIMISER = 3
BUCKET_STRINGS = 50_000     # super-k-mers that a bucket aims at
GROUP_BYTES = 4 << 20       # text looked at together
FLUSH_BYTES = 8 << 20       # text whose strings are packed together
HASH_BYTES = 1 << 20        # bytes hashed at a time
ZSTD_LEVEL = 6
RUNS_A_BLOB = 1 << 16
CUT_ROWS = 1 << 10          # documents cut together
LEAST_ID = -(1 << 63)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_WORD_BASE = 0xD1342543DE82EF95


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


@lru_cache(maxsize=4)
def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse, modulo 2^64."""
    return _powers(base, n), _powers(pow(base, -1, 1 << 64), n)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over 64 bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of several texts, end to end.

    ``buffer`` has every word followed by one space, ``first[d]`` is the number
    of words before text d (with the total at its end).
    """

    def __init__(self, texts: list[bytes]) -> None:
        data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
        space = _SPACE[data]
        after_word = np.empty(len(data), dtype=bool)
        after_word[:1] = False
        np.greater(space[1:], space[:-1], out=after_word[1:])
        begins = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
        offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.first = np.searchsorted(begins, offsets)
        keep = ~space | after_word
        kept = np.where(space[keep], np.uint8(0x20), data[keep])
        self.buffer = kept
        self.ends = np.flatnonzero(kept == 0x20)
        self.starts = np.concatenate([[0], self.ends[:-1] + 1]) if len(self.ends) else self.ends
        self.hashes = self._hashes()

    def _hashes(self) -> np.ndarray:
        out = np.empty(len(self.starts), dtype=np.uint64)
        at = 0
        while at < len(out):
            origin = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, origin + HASH_BYTES, side="right")))
            size = int(self.ends[to - 1] - origin)
            up, down = _power_tables(_BYTE_BASE, max(HASH_BYTES, size) + 1)
            terms = (self.buffer[origin:origin + size].astype(np.uint64) + np.uint64(1)) * up[:size]
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
            s, e = self.starts[at:to] - origin, self.ends[at:to] - origin
            out[at:to] = _mix((total[e] - total[s]) * down[s])
            at = to
        return out

    def run_hashes(self, begin: np.ndarray, count: np.ndarray | int) -> np.ndarray:
        """Hash of the ``count`` words from ``begin`` on."""
        n = len(self.hashes)
        up, down = _power_tables(_WORD_BASE, 1 << max(16, int(n + 1).bit_length()))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hashes * up[:n], dtype=np.uint64)])
        return _mix((total[begin + count] - total[begin]) * down[begin])


def _window_minima(hashes: np.ndarray, window: int, minimiser: int) -> np.ndarray:
    """Smallest hash of ``minimiser`` consecutive words in every window."""
    n = len(hashes) - minimiser + 1
    grams = np.zeros(n, dtype=np.uint64)
    for j, weight in enumerate(_powers(_BYTE_BASE, minimiser + 1)[1:]):
        grams += hashes[j:j + n] * weight
    low, width, wanted = _mix(grams), 1, window - minimiser + 1
    while 2 * width <= wanted:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = wanted - width
    return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low


def super_kmers(words: Words, window: int, minimiser: int, hot: np.ndarray | None = None):
    """(text, first word, windows, key) arrays of the super-k-mers of ``words``.

    ``key`` is the minimiser, or for one listed in ``hot`` the hash of the
    window, which then stands alone. ``first word`` counts from the first word
    of all texts.
    """
    n = len(words.hashes)
    if n < window:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none.astype(np.uint64)
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    valid = text[:n - window + 1] == text[window - 1:]
    minima = _window_minima(words.hashes, window, minimiser)
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (minima[1:] != minima[:-1]) | (text[1:len(valid)] != text[:len(valid) - 1])
    begin = np.flatnonzero(new)
    breaks = np.append(np.flatnonzero(new | ~valid), len(valid))
    count = breaks[np.searchsorted(breaks, begin, side="right")] - begin
    key = minima[begin]
    if hot is not None and len(hot):
        single = np.isin(key, hot)
        each = np.repeat(begin[single], count[single])
        inside = np.arange(len(each)) - np.repeat(np.cumsum(count[single]) - count[single], count[single])
        alone = each + inside
        begin = np.concatenate([begin[~single], alone])
        count = np.concatenate([count[~single], np.ones(len(alone), dtype=count.dtype)])
        key = np.concatenate([key[~single], words.run_hashes(alone, window)])
        order = np.argsort(begin, kind="stable")
        begin, count, key = begin[order], count[order], key[order]
    return text[begin], begin, count, key


def _document_groups(batch: pa.RecordBatch) -> Iterator[list[tuple[int, int, bytes]]]:
    """Different documents of a batch in key order, some megabytes at a time."""
    ids, hashes, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
    group, size, before = [], 0, None
    for i in np.lexsort((hashes, ids)):
        key = (int(ids[i]), int(hashes[i]))
        if key == before:
            continue
        before = key
        group.append((*key, texts[int(i)].as_py()))
        size += len(group[-1][2])
        if size >= GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def _merged(doc: np.ndarray, a: np.ndarray, b: np.ndarray):
    """Join runs of one document that touch; each document's runs come in order."""
    if not len(a):
        return doc, a, b
    cut = np.ones(len(a), dtype=bool)
    cut[1:] = (doc[1:] != doc[:-1]) | (a[1:] > b[:-1])
    first = np.flatnonzero(cut)
    return doc[first], a[first], b[np.append(first[1:], len(a)) - 1]


def _pack(arrays: list[np.ndarray], tail: bytes = b"") -> bytes:
    raw = b"".join([np.int64(len(arrays[0])).tobytes(), *[np.ascontiguousarray(x).tobytes() for x in arrays], tail])
    return np.int64(len(raw)).tobytes() + pa.Codec("zstd", compression_level=ZSTD_LEVEL).compress(raw, asbytes=True)


def _unpack(blob: bytes, kinds: list[str]) -> tuple[list[np.ndarray], bytes]:
    raw = pa.decompress(blob[8:], decompressed_size=int(np.frombuffer(blob[:8], "<i8")[0]), codec="zstd", asbytes=True)
    n, at, out = int(np.frombuffer(raw[:8], "<i8")[0]), 8, []
    for kind in kinds:
        size = n * np.dtype(kind).itemsize
        out.append(np.frombuffer(raw, kind, n, at))
        at += size
    return out, raw[at:]


_STRING_KINDS = ["<i8", "<i8", "<i4", "<i4"]  # id, text hash, first word in its document, windows
_RUN_KINDS = ["<i8", "<i8", "<i4", "<i4"]     # id, text hash, from word, to word


class _Flush:
    """Super-k-mers of some megabytes of text on their way to the buckets."""

    def __init__(self, window: int, minimiser: int, hot: np.ndarray, buckets: int) -> None:
        self.window, self.minimiser, self.hot, self.buckets = window, minimiser, hot, buckets
        self.seen: set[bytes] = set()
        self.strings: list[bytes] = []
        self.shipped: list[list[np.ndarray]] = []
        self.runs: list[list[np.ndarray]] = []
        self.size = 0

    def add(self, group: list[tuple[int, int, bytes]]) -> None:
        words = Words([t for _, _, t in group])
        self.size += sum(len(t) for _, _, t in group)
        text, begin, count, key = super_kmers(words, self.window, self.minimiser, self.hot)
        if not len(begin):
            return
        raw, last = words.buffer.tobytes(), begin + count + self.window - 2
        strings = [raw[s:e] for s, e in zip(words.starts[begin].tolist(), words.ends[last].tolist())]
        new = np.ones(len(strings), dtype=bool)
        seen = self.seen
        for i, s in enumerate(strings):
            if s in seen:
                new[i] = False
            else:
                seen.add(s)
        ids = np.array([g[0] for g in group], dtype=np.int64)
        hashes = np.array([g[1] for g in group], dtype=np.int64)
        place = (begin - words.first[text]).astype(np.int32)
        self.strings += [s for s, ok in zip(strings, new.tolist()) if ok]
        self.shipped.append([ids[text[new]], hashes[text[new]], place[new], count[new].astype(np.int32), key[new]])
        doc, a, b = _merged(text[~new], place[~new], (place + count + self.window - 1)[~new].astype(np.int32))
        self.runs.append([ids[doc], hashes[doc], a, b])

    def rows(self) -> pa.RecordBatch:
        bucket, kind, blobs = [], [], []
        if self.strings:
            ids, hashes, place, count, key = (np.concatenate(x) for x in zip(*self.shipped))
            # buckets take the upper bits: a minimiser is the smallest of several hashes, its low bits stay even
            dealt = (_mix(key) % np.uint64(self.buckets)).astype(np.int64)
            order = np.argsort(dealt, kind="stable")
            edges = np.append(np.flatnonzero(np.diff(dealt[order], prepend=-1)), len(order))
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
                at = order[lo:hi]
                bucket.append(int(dealt[at[0]]))
                kind.append(0)
                tail = b" ".join([self.strings[i] for i in at.tolist()]) + b" "
                blobs.append(_pack([ids[at], hashes[at], place[at], count[at]], tail))
        if self.runs:
            found = [np.concatenate(x) for x in zip(*self.runs)]
            for lo in range(0, len(found[0]), RUNS_A_BLOB):
                part = [x[lo:lo + RUNS_A_BLOB] for x in found]
                bucket.append(int(part[1][0]) % self.buckets)
                kind.append(1)
                blobs.append(_pack(part))
        return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(kind, pa.int32()), pa.array(blobs, pa.binary())],
                                          names=["bucket", "kind", "blob"])


def _later_runs(strings: list[np.ndarray], packed: bytes, window: int) -> list[np.ndarray]:
    """Runs of words under windows whose words also start earlier, within one bucket."""
    ids, hashes, place, count = strings
    words = Words([packed])
    base = np.cumsum(count + window - 1) - (count + window - 1)
    owner = np.repeat(np.arange(len(count)), count)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    at = base[owner] + inside
    order = np.lexsort((hashes, ids))
    fresh_doc = np.ones(len(order), dtype=np.int64)
    fresh_doc[1:] = (ids[order][1:] != ids[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.cumsum(fresh_doc)
    start = (rank[owner] << 32) + place[owner] + inside  # the order in which windows start
    key = words.run_hashes(at, window)
    by_key = np.argsort(key, kind="stable")
    same = np.zeros(len(by_key), dtype=bool)
    same[1:] = key[by_key][1:] == key[by_key][:-1]
    raw, lo, hi = packed, words.starts[at[by_key]], words.ends[at[by_key] + window - 1]
    pairs = np.flatnonzero(same)
    unlike = [i for i, a, b, c, d in zip(pairs.tolist(), lo[pairs - 1].tolist(), hi[pairs - 1].tolist(),
                                         lo[pairs].tolist(), hi[pairs].tolist()) if raw[a:b] != raw[c:d]]
    if unlike:  # two sequences with one hash: sort that group by its words
        group = np.cumsum(~same)
        for g in {int(group[i]) for i in unlike}:
            members = np.flatnonzero(group == g)
            sorted_ = sorted(members.tolist(), key=lambda i: raw[lo[i]:hi[i]])
            texts = [raw[lo[i]:hi[i]] for i in sorted_]
            by_key[members] = by_key[sorted_]
            same[members] = [False] + [x == y for x, y in zip(texts, texts[1:])]
    heads = np.flatnonzero(~same)
    least = np.minimum.reduceat(start[by_key], heads) if len(heads) else start[:0]
    later = np.empty(len(by_key), dtype=bool)
    later[by_key] = start[by_key] > np.repeat(least, np.diff(np.append(heads, len(by_key))))
    first = later & np.concatenate([[True], ~later[:-1] | (owner[1:] != owner[:-1])])
    last = later & np.concatenate([~later[1:] | (owner[1:] != owner[:-1]), [True]])
    f, e = np.flatnonzero(first), np.flatnonzero(last)
    return [ids[owner[f]], hashes[owner[f]], (place[owner[f]] + inside[f]).astype(np.int32),
            (place[owner[e]] + inside[e] + window).astype(np.int32)]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, text_hash, data, id): ``doc`` is the id with the least long for null."""
    source = pick(docs, id_col, text_col).toDF("id", "text")
    return source.select(F.coalesce(F.col("id").cast("bigint"), F.lit(LEAST_ID)).alias("doc"),
                         F.xxhash64(F.coalesce("text", F.lit("")), F.col("id").isNull()).alias("text_hash"),
                         F.coalesce("text", F.lit("")).cast("binary").alias("data"), "id")


def repeated_runs(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc, text_hash, from_word, to_word): runs of words to remove, ``to_word`` excluded.

    Runs of one document may overlap. Runs one job to count minimisers.
    """
    if not 1 <= minimiser <= window or window < 2:
        raise ValueError("a window has at least two words, and a minimiser fits into it")
    spark = docs.sparkSession
    importable_by_workers(spark)
    texts = _keyed(docs, id_col, text_col).select("doc", "text_hash", "data")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = 1.0 / (8 * partitions)

    def count_minimisers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, total = [], 0
            for group in _document_groups(batch):
                words = Words([t for _, _, t in group])
                _, begin, count, key = super_kmers(words, window, minimiser)
                if len(begin):
                    found.append(np.stack([key, words.run_hashes(begin, count + window - 1)]))
            if found:
                keys, content = np.concatenate(found, axis=1)
                order = np.lexsort((content, keys))
                new = np.ones(len(order), dtype=bool)  # each string once, as it will be sent
                new[1:] = (keys[order][1:] != keys[order][:-1]) | (content[order][1:] != content[order][:-1])
                values, n = np.unique(keys[order][new], return_counts=True)
                total = int(n.sum())
                often = n >= max(2, share / 2 * total)
                values, n = values[often].view(np.int64), n[often]
            else:
                values, n = np.empty(0, np.int64), np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *values.tolist()], pa.int64()), pa.array([total, *n.tolist()], pa.int64())], names=["value", "n"])

    counted = durable(texts.mapInArrow(count_minimisers, "value bigint, n bigint").groupBy("value").agg(F.sum("n").alias("n"))
                      .where(F.col("n") > 0))
    total = counted.where("value is null").agg(F.sum("n")).first()[0] or 0
    # those above the share, at most 2 / share of them
    told = counted.where(F.col("value").isNotNull() & (F.col("n") >= total * share / 2)).select("value").collect()
    hot = np.sort(np.array([r["value"] for r in told], dtype=np.int64).view(np.uint64))
    buckets = max(8 * partitions, -(-total // BUCKET_STRINGS))
    listed = spark.sparkContext.broadcast(hot)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flush = _Flush(window, minimiser, listed.value, buckets)
            for group in _document_groups(batch):
                flush.add(group)
                if flush.size >= FLUSH_BYTES:
                    yield flush.rows()
                    flush = _Flush(window, minimiser, listed.value, buckets)
            yield flush.rows()

    def count_windows(table: pa.Table) -> pa.Table:
        kinds, blobs = table.column("kind").to_pylist(), table.column("blob")
        found, strings, tails = [], [], []
        for kind, blob in zip(kinds, blobs):
            arrays, tail = _unpack(blob.as_py(), _STRING_KINDS if kind == 0 else _RUN_KINDS)
            if kind == 0:
                strings.append(arrays)
                tails.append(tail)
            else:
                found.append(arrays)
        if strings:
            found.append(_later_runs([np.concatenate(x) for x in zip(*strings)], b"".join(tails), window))
        arrays = [np.concatenate(x) for x in zip(*found)]
        return pa.table([pa.array(x) for x in arrays], names=["doc", "text_hash", "from_word", "to_word"])

    dealt = texts.mapInArrow(deal, "bucket bigint, kind int, blob binary")
    return dealt.groupBy("bucket").applyInArrow(count_windows, "doc bigint, text_hash bigint, from_word int, to_word int")


def remove_repeated(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_text), one row per row of ``docs``.

    ``kept_text`` has the words that stay, joined by one space. Extra columns
    of ``docs`` are not read. An empty table gives an empty result.
    """
    runs = (repeated_runs(docs, window, minimiser, id_col, text_col).groupBy("doc", "text_hash")
            .agg(F.collect_list(F.struct("from_word", "to_word")).alias("runs")))
    id_type = docs.schema[id_col].dataType.simpleString()
    keyed = _keyed(docs, id_col, text_col)
    copy = F.row_number().over(Window.partitionBy("doc", "text_hash").orderBy("doc"))
    joined = (keyed.join(runs, ["doc", "text_hash"], "left").withColumn("copy", copy)
              .select("id", "data", "copy", F.col("runs.from_word").alias("a"), F.col("runs.to_word").alias("b")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CUT_ROWS):
                yield cut_rows(batch.slice(at, CUT_ROWS))

    def cut_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, n_removed, texts = [], [], []
        for data, copy_, a, b in zip(*[batch.column(i).to_pylist() for i in range(1, 5)]):
            words = data.split()  # bytes.split cuts at 0x20 and 0x09-0x0D only
            spans = sorted(zip(a, b)) if a else []
            if copy_ > 1 and len(words) >= window:
                spans = [(0, len(words))]
            kept, at = [], 0
            for lo, hi in spans:
                if lo > at:
                    kept += words[at:lo]
                at = max(at, hi)
            kept += words[at:]
            n_words.append(len(words))
            n_removed.append(len(words) - len(kept))
            texts.append(b" ".join(kept).decode("utf-8", "surrogatepass"))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.string())],
            names=["id", "n_words", "n_removed", "kept_text"])

    return joined.mapInArrow(cut, f"id {id_type}, n_words bigint, n_removed bigint, kept_text string")
