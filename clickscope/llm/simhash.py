"""SimHash near-duplicates with pigeonring candidate pruning.

Fingerprint. Every word shingle is hashed with XXH64; a fingerprint bit is
set when more than half of the hashes have it. The fingerprint of a document
with fewer words than a shingle comes from its whole word sequence; a
document without words (null, empty or blank text) has fingerprint zero and
is linked like any other.

Links. Equal fingerprints collapse to one node first, so copies, however
many, are never paired. Two fingerprints link when they differ in at most
``max_bits`` bits. The 64 bits are cut into ``max_bits + 1`` segments in a
ring. By the pigeonring principle a linked pair has a segment from which
every chain of l consecutive segments differs in at most
floor(l * max_bits / (max_bits + 1)) bits: the first segment is equal, the
first two differ in at most one bit, and so on round the ring. Candidates are
generated from that chain by equi-joins: the first segment equal, and in each
of the next ``chain - 1`` segments all but the allowed number of sub-blocks
equal. The cumulative budgets of the whole chain are then checked before the
full Hamming distance. The number of segments joined on follows the number of
fingerprints, so that candidates per fingerprint stay bounded; every setting
finds exactly the same links.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickscope.llm.common import durable, fresh, importable_by_workers, pick
from clickscope.llm.components import connected_components

BITS = 64
SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
LARGE_CLASS, LARGE_CLASSES = 100, 10_000
HASH_BLOCK = 1 << 15  # hashes of one document that are unpacked to bits at a time


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of one text."""
    # bytes.lower and bytes.split know ASCII only: A-Z, and 0x20 and 0x09-0x0D
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    last = max(1, len(tokens) - shingle + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, last, HASH_BLOCK):
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(b" ".join(tokens[i:i + shingle]), seed)
             for i in range(start, min(start + HASH_BLOCK, last))), dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > last, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, text_hash, fp) per row of ``docs``; ``fp`` is the fingerprint's 64
    bits as a signed long, ``text_hash`` Spark's xxhash64 of the text."""
    importable_by_workers(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))],
                                             names=["id", "text_hash", "fp"])

    source = pick(docs, id_col, text_col).toDF("id", "text").select("id", F.xxhash64("text").alias("text_hash"), "text")
    return source.mapInArrow(run, f"id {id_type}, text_hash bigint, fp bigint")


@dataclass(frozen=True)
class Ring:
    """Segments of the 64 bits and the tables joined on.

    ``tables`` holds (start segment, mask of the bits that must be equal).
    """
    segments: tuple[int, ...]
    budgets: tuple[int, ...]
    tables: tuple[tuple[int, int], ...]

    def chain(self, start: int, length: int) -> int:
        mask = 0
        for j in range(length):
            mask |= self.segments[(start + j) % len(self.segments)]
        return mask


def _cut(mask: int, parts: int) -> list[int]:
    """Split the set bits of ``mask`` into ``parts`` masks of nearly equal size."""
    bits = [b for b in range(BITS) if mask >> b & 1]
    edges = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [sum(1 << b for b in bits[lo:hi]) for lo, hi in zip(edges, edges[1:]) if hi > lo]


def ring(max_bits: int, chain: int, blocks: int) -> Ring:
    """Join tables for chains of ``chain`` segments, each cut into ``blocks``.

    Along a qualifying chain, segments 2..j differ in at most budget(j) bits
    and so in at most budget(j) sub-blocks; every choice of budget(chain)
    sub-blocks that keeps to this for all j, when left out, is one table.
    """
    count = max_bits + 1
    segments = tuple(_cut((1 << BITS) - 1, count))
    budgets = tuple((j + 1) * max_bits // count for j in range(count))
    tables = []
    for start in range(count):
        tail = [(j, part) for j in range(1, chain) for part in _cut(segments[(start + j) % count], blocks)]
        free = min(budgets[chain - 1], len(tail))
        for dropped in combinations(range(len(tail)), free):
            if all(sum(tail[d][0] <= j for d in dropped) <= budgets[j] for j in range(1, chain)):
                mask = segments[start]
                for k, (_, part) in enumerate(tail):
                    if k not in dropped:
                        mask |= part
                tables.append((start, mask))
    return Ring(segments, budgets, tuple(tables))


def choose_ring(max_bits: int, n: int) -> Ring:
    """The ring with the least expected work for ``n`` fingerprints: key rows
    to shuffle, weighed against candidate pairs to compare."""
    if max_bits == 0:
        return ring(0, 1, 1)
    plans = [ring(max_bits, chain, blocks)
             for chain in range(1, min(max_bits + 1, 3) + 1) for blocks in ((1,) if chain == 1 else (2, 3, 4))]

    def work(plan: Ring) -> float:
        return sum(40 + n / 2 ** bin(mask).count("1") for _, mask in plan.tables)

    return min(plans, key=work)


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask).cast("bigint")


def fingerprint_links(nodes: DataFrame, max_bits: int = MAX_BITS, plan: Ring | None = None) -> DataFrame:
    """All pairs (a, b), a < b, of distinct ``fp`` in ``nodes`` within ``max_bits``; each once."""
    plan = plan or choose_ring(max_bits, nodes.count())
    masks = F.array(*[F.struct(F.lit(t).alias("t"), _signed(mask).alias("m")) for t, (_, mask) in enumerate(plan.tables)])
    keyed = (nodes.select("fp", F.explode(masks).alias("x"))
             .select("fp", F.col("x.t").alias("t"), F.col("fp").bitwiseAND(F.col("x.m")).alias("key")))
    left = keyed.select("t", "key", F.col("fp").alias("a"))
    right = keyed.select(F.col("t").alias("t2"), F.col("key").alias("key2"), F.col("fp").alias("b"))
    diff = F.col("a").bitwiseXOR(F.col("b"))

    def differ(mask: int) -> Column:
        return F.bit_count(diff.bitwiseAND(_signed(mask)))

    count = len(plan.segments)
    starts = [t for t, _ in enumerate(plan.tables)]
    # pigeonring: cumulative differences along the ring from the table's start
    chain_ok = F.lit(False)
    for start in range(count):
        own = [t for t in starts if plan.tables[t][0] == start]
        within = F.lit(True)
        for length in range(2, count):
            within = within & (differ(plan.chain(start, length)) <= plan.budgets[length - 1])
        chain_ok = chain_ok | (F.col("t").between(own[0], own[-1]) & within)
    # a pair may qualify in several tables; only the first one emits it
    first = F.lit(True)
    for t, (start, mask) in enumerate(plan.tables[:-1]):
        earlier = differ(mask) == 0
        for length in range(2, count):
            earlier = earlier & (differ(plan.chain(start, length)) <= plan.budgets[length - 1])
        first = first & ((F.col("t") <= t) | ~earlier)
    close = F.bit_count(diff) <= max_bits
    return (left.join(right, (F.col("t") == F.col("t2")) & (F.col("key") == F.col("key2"))
                      & (F.col("a") < F.col("b")) & close & chain_ok & first)
            .select("a", "b"))


def _class_minima(grouped: DataFrame) -> DataFrame:
    """(fp, component, group_key) of (fp, low, root): the least ``low`` of each root's fingerprints, for every one.

    Minima are taken with map-side combine. They go back to the fingerprints
    of the largest classes by a broadcast, to all others by a join on the root;
    so the fingerprints of one class never meet in one task. A class is among
    the largest if it has more than 1 / ``LARGE_CLASSES`` of all fingerprints
    and more than ``LARGE_CLASS``: there are fewer than ``LARGE_CLASSES``.
    """
    minima = durable(grouped.groupBy(F.col("root").alias("group_key")).agg(F.min("low").alias("component"), F.count(F.lit(1)).alias("n")))
    limit = max(LARGE_CLASS, (minima.agg(F.sum("n")).first()[0] or 0) // LARGE_CLASSES)
    large = F.broadcast(minima.where(F.col("n") > limit))
    on = F.col("root") == F.col("group_key")
    few = grouped.join(large, on)
    rest = grouped.join(large, on, "left_anti").join(minima.where(F.col("n") <= limit), on)
    return few.unionByName(rest).select("fp", "component", "group_key")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, fingerprint, component, group_key) per row of ``docs``.

    ``fingerprint`` is 16 lower-case hex digits; ``component`` the smallest id
    reachable over links, the row's own id included; ``group_key`` names the
    group whether or not it has an id. Rows with a null id take part in the
    links and get a component from the others' ids (null if the group has no
    id). Repeated rows each come back. An empty table gives an empty result.
    Extra columns are ignored.
    """
    rows = durable(fingerprints(docs, shingle, id_col, text_col))
    nodes = durable(rows.groupBy("fp").agg(F.min("id").alias("low")))
    joined = connected_components(fingerprint_links(nodes.select("fp"), max_bits))
    grouped = durable(nodes.join(joined, nodes["fp"] == joined["node"], "left")
                      .select("fp", "low", F.coalesce("component", "fp").alias("root")))
    classes = _class_minima(grouped).select(F.col("fp").alias("f"), "component", "group_key")
    return (rows.join(classes, F.col("fp") == F.col("f"))
            .select("id", "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component", "group_key"))


def keep_representatives(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` per near-duplicate group, all its columns unchanged.

    The row with the group's smallest id stays (a null id only where the group
    has no other); among rows that repeat this id, the one with the smallest
    text hash, then the smallest hash of all columns.
    """
    groups = near_duplicates(docs, shingle, max_bits, id_col, text_col)
    taken = docs.columns
    key, text_key, rank = (fresh(taken, n) for n in ("kept_id", "kept_text", "copy_rank"))
    # the representative is a plain minimum, taken in two steps so that both stay hash aggregates
    lowest = groups.groupBy("group_key", "component").agg(
        F.min(F.when(F.col("id").eqNullSafe(F.col("component")), F.col("text_hash"))).alias(text_key))
    kept = lowest.select(F.col("component").alias(key), text_key)
    hashed = F.xxhash64(F.col(f"`{text_col}`"))
    row_hash = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in taken])
    order = Window.partitionBy(F.col(f"`{id_col}`"), hashed).orderBy(row_hash)
    return (docs.join(kept, F.col(f"`{id_col}`").eqNullSafe(F.col(key)) & (hashed == F.col(text_key)), "left_semi")
            .withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).drop(rank))
