"""Language-model scoring by context-tree weighting over bytes.

Model. Each byte is eight binary decisions; a decision's node is the bits of
the byte so far. For every node and every context of 0 to ``depth`` preceding
bytes the training documents give counts of zeros and ones and with them a
Krichevsky-Trofimov estimate. Context-tree weighting mixes the estimates of
all depths: a context's weighted probability is half its own estimate and half
the product of its children's, and the posterior of the two halves weighs a
prediction along the path from the longest context to the empty one. A
context never seen predicts one half. A text is scored with start marks before
it and one end mark after it (0xFF, a byte UTF-8 never has); the score is the
log10 probability of its bytes and the end mark.

How it is spread. The tree grows with the corpus, so nobody holds it.

1. One pass over the texts packs them into chunks of some megabytes, and with
   every chunk its distinct byte grams (``depth`` bytes and the next one) and
   its distinct words, each with the number of times it was trained on. Grams
   go to buckets by the last ``KEY_BYTES`` bytes of their context, words by
   their hash, so a gram or word, however frequent, is sent once per chunk.
2. A bucket merges the counts of its grams. It holds whole subtrees, all
   contexts that end in the same bytes, and weights them from the deepest
   contexts up. What the contexts above need, sums per (context, node), leaves
   it as plain rows.
3. Those are combined depth by depth with ``groupBy``, up to the empty context.
   These shortest contexts, of fewer than ``KEY_BYTES`` bytes, are at most
   65,793 with 255 nodes each, whatever the corpus; as 12 bytes a node they
   are at most 201 MB, and they are broadcast.
4. The buckets answer: the log10 probability of each gram that a chunk asked
   for, by the way of its contexts from the longest to the empty one.
5. Answers come back to their chunk by a shuffle on the chunk's number, and
   its texts are scored from them. Word counts travel the same way.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import durable, importable_by_workers, pick
from clickscope.session import checkpoint_dir

MARK = 0xFF
DEPTH = 6
MOST_DEPTH = 6  # a gram is one 64-bit integer
KEY_BYTES = 3
END = b" "  # the end token; no word has a space
CHUNK_BYTES = 16 << 20
BLOCK_BYTES = 1 << 20    # text whose grams are worked out in one array
BUCKET_BYTES = 8 << 20   # text per bucket of grams and words
EVALUATED = 1 << 18      # grams that are evaluated in one array
ZSTD_LEVEL = 3
_HALF = math.log(0.5)


def held_out(ident: Column) -> Column:
    """crc32 of the id as text is divisible by ten; a null id is not held out."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def gram_codes(texts: list[bytes], depth: int) -> np.ndarray:
    """For every scored byte: the ``depth`` bytes before it and itself, as one integer."""
    start = bytes([MARK]) * depth
    flat = np.frombuffer(b"".join([start + t + b"\xff" for t in texts]), dtype=np.uint8)
    lengths = np.array([len(t) + depth + 1 for t in texts], dtype=np.int64)
    begins = np.cumsum(lengths) - lengths
    codes = np.zeros(len(flat), dtype=np.int64)
    for back in range(depth, 0, -1):
        codes[back:] |= flat[:-back].astype(np.int64) << (8 * back)
    codes |= flat
    scored = np.ones(len(flat), dtype=bool)
    for k in range(depth):
        scored[begins + k] = False
    return codes[scored]


def _blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
    block, size = [], 0
    for t in texts:
        block.append(t)
        size += len(t) + 8
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def _summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the counts added up for each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return (keys[first], *[np.add.reduceat(c[order], first) if len(first) else c[:0] for c in counts])


def gram_counts(texts: list[bytes], learn: list[bool], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of all texts in order, and how often those to learn from have them."""
    merged, parts, waiting = (np.empty(0, np.int64),) * 2, [], 0
    for wanted in (True, False):
        for block in _blocks([t for t, ok in zip(texts, learn) if ok is wanted]):
            codes, n = np.unique(gram_codes(block, depth), return_counts=True)
            parts.append((codes, n if wanted else np.zeros_like(n)))
            waiting += len(codes)
            if waiting > max(1 << 20, len(merged[0])):
                merged, parts, waiting = _summed(*[np.concatenate(x) for x in zip(merged, *parts)]), [], 0
    return _summed(*[np.concatenate(x) for x in zip(merged, *parts)]) if parts else merged


def turned(codes: np.ndarray, depth: int) -> np.ndarray:
    """Codes with the context's bytes the other way round: its last byte first, as subtrees are ordered. Its own inverse."""
    out = codes & 255
    for k in range(depth):
        out |= (codes >> 8 * (k + 1) & 255) << 8 * (depth - k)
    return out


@lru_cache(maxsize=1)
def _log_gammas() -> tuple[np.ndarray, np.ndarray]:
    """log gamma(n + 1/2) and log gamma(n + 1) for small whole n."""
    return (np.array([math.lgamma(n + 0.5) for n in range(4096)]), np.array([math.lgamma(n + 1) for n in range(4096)]))


def _lgamma(n: np.ndarray, half: bool) -> np.ndarray:
    """log gamma(n + 1/2) or log gamma(n + 1) of whole n, by table or by Stirling's series."""
    table = _log_gammas()[0 if half else 1]
    out = table[np.minimum(n, len(table) - 1)]
    large = np.flatnonzero(n >= len(table))
    if len(large):
        y = n[large].astype(np.float64) + (0.5 if half else 1.0)
        out[large] = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3)
    return out


def _kt(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log block probability and probability of a next one, per node."""
    block = _lgamma(zeros, True) + _lgamma(ones, True) - _lgamma(zeros + ones, False) - math.log(math.pi)
    return block, (ones + 0.5) / (zeros + ones + 1.0)


def _mixed(block: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted log probability of nodes with children, and their own estimate's share of it."""
    weighted = _HALF + np.logaddexp(block, below)
    return weighted, np.exp(_HALF + block - weighted)


def _splits(codes: np.ndarray, counts: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of one bit level of (context, byte) ``codes`` in order: keys context * 256 + node, zeros, ones."""
    byte = codes & 255
    keys = (codes >> 8 << 8) | (1 << level) | (byte >> (8 - level))
    one = (byte >> (7 - level) & 1).astype(bool)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(np.where(one, 0, counts), first), np.add.reduceat(np.where(one, counts, 0), first)


class Subtrees:
    """All contexts of ``top`` to ``depth`` bytes of some grams with their weights.

    ``codes`` are distinct grams in order that have every trained gram with
    the same last ``top`` context bytes. ``tables[d][level]`` has keys, the
    own estimate's share, and P(one); ``roots`` the (keys, zeros, ones,
    weighted) of the contexts of ``top`` bytes.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray, depth: int, top: int) -> None:
        self.depth, self.top = depth, top
        self.tables: dict[int, list] = {}
        self.roots: list[tuple] = []
        below: list = [None] * 8
        codes, counts = codes[counts > 0], counts[counts > 0]
        for d in range(depth, top - 1, -1):
            if d < depth:
                codes, counts = _summed(codes & ((1 << 8 * (d + 1)) - 1), counts)
            self.tables[d] = []
            for level in range(8 if len(codes) else 0):
                keys, zeros, ones = _splits(codes, counts, level)
                block, one = _kt(zeros, ones)
                if d == depth:
                    weighted, share = block, np.ones_like(block)
                else:
                    sums = np.bincount(np.searchsorted(keys, below[level][0] & ((1 << 8 * (d + 1)) - 1)), below[level][1], len(keys))
                    weighted, share = _mixed(block, sums)
                below[level] = (keys, weighted)
                self.tables[d].append((keys, share, one))
                if d == top:
                    self.roots.append((keys, zeros, ones, weighted))

    def logs(self, asked: np.ndarray, above: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """log10 probability of the last byte of each asked gram.

        ``above[d]`` has keys, share and P(one) of the contexts of d bytes,
        for d below ``top``.
        """
        out = np.zeros(len(asked))
        for at in range(0, len(asked), EVALUATED):
            part = asked[at:at + EVALUATED]
            byte = part & 255
            for level in range(8):
                node = (1 << level) | (byte >> (8 - level))
                p = np.full(len(part), 0.5)
                for d in range(self.depth, -1, -1):
                    if d >= self.top:
                        tables = self.tables.get(d)
                        if not tables:
                            continue
                        keys, share, one = tables[level]
                    else:
                        keys, share, one = above[d]
                    if not len(keys):
                        continue
                    key = (((part >> 8) & ((1 << 8 * d) - 1)) << 8) | node
                    place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    known = keys[place] == key
                    p = np.where(known, share[place] * one[place] + (1 - share[place]) * p, p)
                out[at:at + EVALUATED] += np.log10(np.where(byte >> (7 - level) & 1, p, 1 - p))
        return out


def _pack(*parts: np.ndarray | bytes) -> bytes:
    """Arrays and byte strings as one compressed blob; whole numbers in order pack best as differences."""
    raw = [np.int64(len(parts)).tobytes()]
    for p in parts:
        data = p if isinstance(p, bytes) else np.ascontiguousarray(p.view(np.uint8).reshape(len(p), p.itemsize).T).tobytes()
        raw += [np.int64(len(data)).tobytes(), data]
    whole = b"".join(raw)
    return np.int64(len(whole)).tobytes() + pa.Codec("zstd", compression_level=ZSTD_LEVEL).compress(whole, asbytes=True)


def _unpack(blob: bytes, *kinds: str | None) -> list:
    """Back from ``_pack``; a kind is a number type, or None for a byte string."""
    raw = pa.decompress(blob[8:], decompressed_size=int(np.frombuffer(blob[:8], "<i8")[0]), codec="zstd", asbytes=True)
    at, out = 8, []
    for kind in kinds:
        size = int(np.frombuffer(raw, "<i8", 1, at)[0])
        data = raw[at + 8:at + 8 + size]
        if kind is None:
            out.append(data)
        else:
            width = np.dtype(kind).itemsize
            out.append(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel())
        at += 8 + size
    return out


def _differences(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=np.int64(0))


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its items, in order)."""
    order = np.argsort(bucket, kind="stable")
    edges = np.append(np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order))
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield int(bucket[order[lo]]), order[lo:hi]


def _gram_bucket(codes: np.ndarray, top: int, buckets: int) -> np.ndarray:
    """Bucket of the last ``top`` bytes of the context, spread by a multiplication."""
    context = ((codes >> 8) & ((1 << 8 * top) - 1)).astype(np.uint64)
    return ((context * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def _chunk_rows(ids: list, texts: list[bytes], learn: list[bool], depth: int, buckets: int) -> list[tuple]:
    """(kind, chunk, bucket, blob) of one chunk: its texts, its grams per bucket, its words per bucket."""
    chunk = uuid.uuid4().int >> 65
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([ids], names=["id"])
    with pa.ipc.new_stream(sink, batch.schema) as writer:  # ids keep their type
        writer.write_batch(batch)
    rows = [("text", chunk, 0, _pack(sink.getvalue().to_pybytes(), lengths, b"".join(texts)))]
    codes, n = gram_counts(texts, learn, depth)
    codes = turned(codes, depth)  # neighbours in this order share a subtree and differ little
    order = np.argsort(codes)
    codes, n = codes[order], n[order]
    for bucket, at in _by_bucket(_gram_bucket(turned(codes, depth), min(KEY_BYTES, depth), buckets)):
        rows.append(("gram", chunk, bucket, _pack(_differences(codes[at]), n[at])))
    counts: Counter = Counter()
    for t, ok in zip(texts, learn):
        if ok:
            counts.update(_tokens(t))
        else:
            for w in _tokens(t):
                counts.setdefault(w, 0)
    words = sorted(counts)
    for bucket, at in _by_bucket(np.array([xxhash.xxh64_intdigest(w) % buckets for w in words], dtype=np.int64)):
        own = [words[i] for i in at.tolist()]
        rows.append(("word", chunk, bucket, _pack(b"\n".join(own), np.array([counts[w] for w in own], dtype=np.int64))))
    return rows


def _write_chunks(rows: DataFrame, depth: int, buckets: int) -> DataFrame:
    """Pack (id, text, learn) into chunks; a table in the shared folder, one folder per kind of row."""
    spark = rows.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, learn, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            found = _chunk_rows(pa.concat_arrays(ids), texts, learn, depth, buckets)
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in found], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.binary()))],
                names=["kind", "chunk", "bucket", "blob"])

        for batch in batches:
            column, ok, at = batch.column(1), batch.column(2).to_pylist(), 0
            for i in range(batch.num_rows):
                text = column[i].as_py()
                texts.append(text)
                learn.append(ok[i])
                size += len(text) + 64
                if size >= CHUNK_BYTES:
                    ids.append(batch.column(0).slice(at, i + 1 - at))
                    yield flush()
                    ids, texts, learn, size, at = [], [], [], 0, i + 1
            if at < batch.num_rows:
                ids.append(batch.column(0).slice(at))
        if texts:
            yield flush()

    path = f"{checkpoint_dir(spark).rstrip('/')}/lm-chunks-{uuid.uuid4().hex}"
    table = rows.mapInArrow(run, "kind string, chunk bigint, bucket bigint, blob binary")
    table.write.partitionBy("kind").parquet(path)
    return spark.read.schema("chunk bigint, bucket bigint, blob binary, kind string").parquet(path)


def _merged_grams(blobs: list[bytes], depth: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The grams of each blob, and all distinct ones with their summed counts."""
    asked, counts = [], []
    for blob in blobs:
        steps, n = _unpack(blob, "<i8", "<i8")
        asked.append(turned(np.cumsum(steps), depth))
        counts.append(n)
    return asked, *_summed(np.concatenate(asked), np.concatenate(counts))


def _shortest_contexts(chunks: DataFrame, depth: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, share and P(one) of all contexts of fewer than ``KEY_BYTES`` bytes, by their length.

    The subtrees' roots are combined depth by depth: counts and weighted logs
    are added up per (context, node) by ``groupBy``, then each row is weighted.
    """
    top = min(KEY_BYTES, depth)
    kind = "key bigint, zeros bigint, ones bigint, weighted double"
    if top == 0:
        return []

    def roots(table: pa.Table) -> pa.Table:
        _, codes, counts = _merged_grams(table.column("blob").to_pylist(), depth)
        found = Subtrees(codes, counts, depth, top).roots or [(np.empty(0, np.int64),) * 3 + (np.empty(0),)]
        keys, zeros, ones, weighted = (np.concatenate(x) for x in zip(*found))
        keys = keys & ((1 << 8 * top) - 1)  # drop the context's first byte: the parent's key
        order = np.argsort(keys, kind="stable")
        keys, zeros, ones, weighted = _summed(keys[order], zeros[order], ones[order], weighted[order])
        return pa.table([pa.array(keys), pa.array(zeros), pa.array(ones), pa.array(weighted)], names=["key", "zeros", "ones", "weighted"])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, zeros, ones, below = (b.column(i).to_numpy() for i in range(4))
            block, one = _kt(zeros, ones)
            weighted, share = _mixed(block, below)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, zeros, ones, weighted, share, one)],
                                             names=["key", "zeros", "ones", "weighted", "share", "one"])

    rows = chunks.where("kind = 'gram'").groupBy("bucket").applyInArrow(roots, kind)
    above: list = []
    for d in range(top - 1, -1, -1):
        sums = rows.groupBy("key").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("weighted"))
        level = durable(sums.mapInArrow(weigh, f"{kind}, share double, one double"))
        told = level.select(F.col("key").cast("int"), F.col("share").cast("float"), F.col("one").cast("float")).toArrow()
        key, share, one = (told.column(i).to_numpy() for i in range(3))
        order = np.argsort(key)
        above.insert(0, (key[order].astype(np.int32), share[order], one[order]))
        rows = level.select(F.col("key").bitwiseAND((1 << 8 * d) - 1).alias("key"), "zeros", "ones", "weighted")
    return above


def _gram_answers(chunks: DataFrame, depth: int) -> DataFrame:
    """(chunk, kind, blob): the grams that each chunk asked a bucket for, with their log10 probabilities."""
    top = min(KEY_BYTES, depth)
    above = chunks.sparkSession.sparkContext.broadcast(_shortest_contexts(chunks, depth))

    def grams(table: pa.Table) -> pa.Table:
        asked, codes, counts = _merged_grams(table.column("blob").to_pylist(), depth)
        logs = Subtrees(codes, counts, depth, top).logs(codes, above.value).astype(np.float32)
        blobs = [_pack(_differences(turned(a, depth)), logs[np.searchsorted(codes, a)]) for a in asked]
        return pa.table({"chunk": table.column("chunk"), "kind": pa.array(["gram"] * len(blobs)), "blob": pa.array(blobs, pa.binary())})

    return chunks.where("kind = 'gram'").groupBy("bucket").applyInArrow(grams, "chunk bigint, kind string, blob binary")


def _word_answers(chunks: DataFrame) -> DataFrame:
    """(chunk, blob, kind): the words that each chunk asked a bucket for, with their counts; kind 'total' has the buckets' sums."""
    def words(table: pa.Table) -> pa.Table:
        asked, counts = [], Counter()
        for blob in table.column("blob").to_pylist():
            text, n = _unpack(blob, None, "<i8")
            asked.append(text.split(b"\n"))
            for w, k in zip(asked[-1], n.tolist()):
                counts[w] += k
        blobs = [_pack(b"\n".join(ws), np.array([counts[w] for w in ws], dtype=np.int64)) for ws in asked]
        known = [n for n in counts.values() if n]
        totals = _pack(np.array([sum(known), len(known)], dtype=np.int64))
        return pa.table({"chunk": pa.array([*table.column("chunk").to_pylist(), None], pa.int64()),
                         "kind": pa.array(["word"] * len(blobs) + ["total"]), "blob": pa.array([*blobs, totals], pa.binary())})

    spark = chunks.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/lm-words-{uuid.uuid4().hex}"
    (chunks.where("kind = 'word'").groupBy("bucket").applyInArrow(words, "chunk bigint, kind string, blob binary")
     .write.partitionBy("kind").parquet(path))
    return spark.read.schema("chunk bigint, blob binary, kind string").parquet(path)


def score(docs: DataFrame, learn: Column, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text",
          bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Learn from the rows of ``docs`` where ``learn`` holds, score all of them.

    Returns (id, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte) per row. ``base_score`` is the unigram word model's log10
    probability. A null text counts as empty. Repeated rows count, and are
    scored, each; a null id stays null. Without training documents every word
    is unknown and every bit has probability one half. An empty table gives an
    empty result. Extra columns are ignored. Runs jobs: the packed chunks, the
    shortest contexts and the word counts are written to the shared folder.
    """
    if not 0 <= depth <= MOST_DEPTH:
        raise ValueError(f"the depth is 0 to {MOST_DEPTH}")
    importable_by_workers(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"),
                       F.coalesce(learn, F.lit(False)).alias("learn"))
    size = rows.agg(F.coalesce(F.sum(F.length("text").cast("bigint") + 64), F.lit(0))).first()[0]
    buckets = max(1, math.ceil(size / bucket_bytes))
    chunks = _write_chunks(rows, depth, buckets)
    words_told = _word_answers(chunks)
    total = distinct = 0
    # one row per bucket of words
    for row in words_told.where("kind = 'total'").select("blob").toLocalIterator():
        part, = _unpack(bytes(row["blob"]), "<i8")
        total, distinct = total + int(part[0]), distinct + int(part[1])
    per_token = math.log10(total + 0.1 * (distinct + 1))

    def scored(key: tuple, texts_: pa.Table, told: pa.Table) -> pa.Table:
        codes, logs, words = [], [], {}
        for kind, value in zip(told.column("kind").to_pylist(), told.column("blob")):
            blob = value.as_py()
            if kind == "gram":
                steps, values = _unpack(blob, "<i8", "<f4")
                codes.append(turned(np.cumsum(steps), depth))
                logs.append(values)
            else:
                text, n = _unpack(blob, None, "<i8")
                words.update((w, x) for w, x, k in zip(text.split(b"\n"), np.log10(n + 0.1).tolist(), n.tolist()) if k)
        place, logs = pd.Index(np.concatenate(codes)), np.concatenate(logs).astype(np.float64)  # hashed: faster than a search
        ids, lengths, data = _unpack(texts_.column("blob")[0].as_py(), None, "<i8", None)
        ends = np.cumsum(lengths).tolist()
        texts = [data[e - n:e] for e, n in zip(ends, lengths.tolist())]
        n_tokens, n_known, base, scores = [], [], [], []
        for t in texts:
            tokens = _tokens(t)
            values = np.fromiter(map(words.get, tokens, repeat(np.nan)), np.float64, len(tokens))
            hit = ~np.isnan(values)
            n_tokens.append(len(tokens))
            n_known.append(int(hit.sum()))
            base.append(float(values[hit].sum()) + (len(tokens) - n_known[-1]) * math.log10(0.1) - len(tokens) * per_token)
        for block in _blocks(texts):
            sizes = np.array([len(t) + 1 for t in block])
            values = logs[place.get_indexer(gram_codes(block, depth))]
            scores += np.add.reduceat(values, np.cumsum(sizes) - sizes).tolist()
        bits = [-s * math.log2(10) / (len(t) + 1) for s, t in zip(scores, texts)]
        return pa.table({"id": pa.ipc.open_stream(ids).read_all().column("id"), "n_tokens": pa.array(n_tokens, pa.int64()),
                         "n_known": pa.array(n_known, pa.int64()), "base_score": pa.array(base, pa.float64()),
                         "score": pa.array(scores, pa.float64()), "bits_per_byte": pa.array(bits, pa.float64())})

    told = words_told.where("kind = 'word'").select("chunk", "kind", "blob").unionByName(_gram_answers(chunks, depth))
    out = chunks.where("kind = 'text'").select("chunk", "blob").groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        scored, f"id {id_type}, n_tokens bigint, n_known bigint, base_score double, score double, bits_per_byte double")
    return out.withColumn("train_tokens", F.lit(total).cast("bigint"))


def score_corpus(docs: DataFrame, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the rows of ``docs`` that are not held out, score all, and say which were held out."""
    rows = pick(docs, id_col, text_col)
    return score(rows, ~held_out(F.col(f"`{id_col}`")), depth, id_col, text_col).withColumn("held_out", held_out(F.col("id")))
