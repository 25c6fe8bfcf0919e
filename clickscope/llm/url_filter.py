"""URL filters: path rules, and exact membership in a list by a Bloom filter cascade.

Cascade. Level 0 is a Bloom filter of the listed keys. Level 1 encodes the
keys of the corpus that level 0 passes wrongly, level 2 the listed keys that
level 1 passes wrongly, and so on until a level passes none wrongly. Because
the levels are built over the complete universe of keys that the corpus has,
the first level that refuses a key of the universe settles its membership
exactly, without a join. The universe is collected by a distributed distinct;
each level's bits are combined by a distributed bit-or per word.

Size. A cascade takes about 1.44 log2(universe / listed) + 5 bits per listed
key. Where this passes ``max_broadcast`` bytes, keys are split into groups by
hash and each group has its own cascade, broadcast and probed in a pass of its
own, so that no broadcast passes the bound.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import ascii_lower, durable, fresh, importable_by_workers

MAX_BROADCAST = 64 << 20
MAX_LEVELS = 64
# levels of few keys are made sharp: that costs next to nothing and ends the cascade sooner
SMALL_LEVEL, SMALL_RATE = 4096, 2.0 ** -12

# Fixed values: (verdict, host, start of the path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Words of a host label that list the domain they stand in.
LISTED_WORDS = ("ads", "adult", "bets", "casino", "pills", "porn", "spam", "warez")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct<rule, verdict> of the longest rule that fits, null without one.

    A rule fits its host and all subdomains where the path starts with the
    rule's. Among equally long rules a block wins, then the smaller string.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    order = sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[0] == "block", [-ord(c) for c in r[1] + r[2]]))
    for verdict, name, start in order:  # the last one that fits stays
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def url_keys(host: Column, path: Column) -> Column:
    """What a list may name of a url: its host, every parent domain, and host with path. No host: none."""
    labels = F.split(host, r"\.")
    domains = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_union(domains, F.array(F.concat(host, path))))


def listed_domains(host: Column, listed=LISTED_WORDS) -> Column:
    """The domain that starts at the first label with a listed word (labels are cut at hyphens); null without one."""
    start = r"(?:^|\.)((?:[^.]*-)?(?:" + "|".join(listed) + r")(?:-[^.]*)?(?:\..*)?)$"
    found = F.regexp_extract(host, start, 1)
    return F.when(found != "", found)


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """64 well-mixed bits of each value under a salt."""
    x = x + np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(h1: np.ndarray, h2: np.ndarray, level: int, n_hashes: int, n_bits: int) -> np.ndarray:
    """Bit places (keys x hashes) of keys, given two independent hashes of each."""
    a, b = _mixed(h1, 2 * level + 1), _mixed(h2, 2 * level + 2) | np.uint64(1)
    return (a[:, None] + np.arange(n_hashes, dtype=np.uint64) * b[:, None]) % np.uint64(n_bits)


@dataclass
class Level:
    n_hashes: int
    n_bits: int
    words: np.ndarray  # 64 bits each

    def passes(self, h1: np.ndarray, h2: np.ndarray, number: int) -> np.ndarray:
        at = _places(h1, h2, number, self.n_hashes, self.n_bits)
        return ((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


class Cascade:
    """Levels of one group of keys."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Exact for every key of the universe: a key is listed when the first level that refuses it is an odd one."""
        answer = np.full(len(h1), len(self.levels) % 2 == 1)
        open_ = np.arange(len(h1))
        for number, level in enumerate(self.levels):
            passed = level.passes(h1[open_], h2[open_], number)
            answer[open_[~passed]] = number % 2 == 1
            open_ = open_[passed]
        return answer

    @property
    def n_bytes(self) -> int:
        return sum(level.words.nbytes for level in self.levels)


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit("second"), key)


def _level(keys: DataFrame, number: int, n: int, rate: float) -> Level:
    """A Bloom filter of ``n`` keys with the given false-positive rate, built on the executors."""
    n_hashes = max(1, round(math.log2(1 / rate)))
    n_bits = max(64, math.ceil(n * n_hashes / math.log(2)))

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = (np.asarray(batch.column(i)).astype(np.int64).view(np.uint64) for i in range(2))
            at = np.unique(_places(h1, h2, number, n_hashes, n_bits))
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            if len(word):
                mask = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(mask.view(np.int64))], names=["word", "mask"])

    rows = keys.select("h1", "h2").mapInArrow(bits, "word bigint, mask bigint").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    found = rows.toArrow()  # at most n_bits / 64 rows, bounded by max_broadcast
    words = np.zeros((n_bits + 63) // 64, dtype=np.uint64)
    words[np.asarray(found["word"])] = np.asarray(found["mask"]).astype(np.int64).view(np.uint64)
    return Level(n_hashes, n_bits, words)


def _passing(keys: DataFrame, level: Level, number: int) -> DataFrame:
    """The keys that a level lets through."""
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = (np.asarray(batch.column(i)).astype(np.int64).view(np.uint64) for i in range(2))
            yield batch.filter(pa.array(shared.value.passes(h1, h2, number)))

    return keys.select("h1", "h2").mapInArrow(run, "h1 bigint, h2 bigint")


def build_cascades(listed: DataFrame, universe: DataFrame, max_broadcast: int = MAX_BROADCAST) -> list[Cascade]:
    """Cascades of the keys in ``listed`` over those of ``universe`` (one string column each).

    Keys may repeat; null keys are ignored. Listed keys outside the universe
    are added to it. One cascade unless its size would pass ``max_broadcast``;
    else as many as groups of keys, in the order of the groups.
    """
    importable_by_workers(universe.sparkSession)
    both = (listed.toDF("key").select("key", F.lit(1).alias("in_list"))
            .unionByName(universe.toDF("key").select("key", F.lit(0).alias("in_list"))).where("key is not null"))
    h1, h2 = _hashes(F.col("key"))
    keys = durable(both.groupBy(h1.alias("h1"), h2.alias("h2")).agg(F.max("in_list").alias("in_list")))
    n, n_listed = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("in_list"), F.lit(0))).first()
    estimate = n_listed * (1.44 * max(1.0, math.log2(max(1, n) / max(1, n_listed))) + 5) / 8
    groups = max(1, math.ceil(estimate / max_broadcast))
    cascades = []
    for g in range(groups):
        own = keys.where(F.pmod("h1", F.lit(groups)) == g)
        encoded, against = own.where("in_list = 1"), own.where("in_list = 0")
        size, other = encoded.count(), against.count()
        levels: list[Level] = []
        while size:
            if len(levels) == MAX_LEVELS:
                raise RuntimeError("two keys share both hashes")
            rate = min(0.5, math.sqrt(0.5) * size / max(1, other)) if not levels else 0.5
            if size <= SMALL_LEVEL:
                rate = min(rate, SMALL_RATE)
            level = _level(encoded, len(levels), size, rate)
            wrong = durable(_passing(against, level, len(levels)))
            levels.append(level)
            encoded, against = wrong, encoded
            other, size = size, wrong.count()
        cascades.append(Cascade(levels))
    return cascades


def flag_listed(df: DataFrame, keys: Column, cascades: list[Cascade], name: str) -> DataFrame:
    """``df`` with a boolean ``name``: whether any of the row's ``keys`` (array of strings) is listed."""
    importable_by_workers(df.sparkSession)
    taken = [*df.columns, name]
    a, b = fresh(taken, "key_h1"), fresh(taken, "key_h2")
    out = (df.withColumn(a, F.transform(keys, lambda k: _hashes(k)[0]))
           .withColumn(b, F.transform(keys, lambda k: _hashes(k)[1])).withColumn(name, F.lit(False)))
    groups = len(cascades)
    schema = out.schema
    for g, cascade in enumerate(cascades):
        shared = df.sparkSession.sparkContext.broadcast(cascade)
        at = [out.columns.index(c) for c in (a, b, name)]

        def probe(batches: Iterator[pa.RecordBatch], g=g, shared=shared, at=at) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = batch.column(at[0])
                lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                h1, h2 = (np.asarray(pc.list_flatten(batch.column(i))).astype(np.int64) for i in at[:2])
                row = np.repeat(np.arange(len(lists)), lengths)
                own = np.mod(h1, groups) == g
                hit = row[own][shared.value.listed(h1[own].view(np.uint64), h2[own].view(np.uint64))]
                found = batch.column(at[2]).to_numpy(zero_copy_only=False).astype(bool)
                found[hit] = True
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found) if i == at[2] else c for i, c in enumerate(batch.columns)], names=batch.schema.names)

        out = out.mapInArrow(probe, schema)
        if groups > 1:  # a pass of its own, so that only one cascade is held at a time
            out = durable(out)
            shared.unpersist()
    return out.drop(a, b)


def judge_urls(pages: DataFrame, rules=RULES, listed_words=LISTED_WORDS, id_col: str = "page_id", url_col: str = "url",
               max_broadcast: int = MAX_BROADCAST, listed: DataFrame | None = None) -> DataFrame:
    """(id, host, path, rule, verdict, listed) per row of ``pages``.

    ``verdict`` is the longest fitting rule's; else ``block`` where the host, a
    parent domain, or host with path is listed, and ``allow`` otherwise. The
    list is the one column of ``listed``: domains, or hosts with a path, of
    which A-Z in the host count as a-z; keys that the corpus does not have are
    left out, nulls and repeats are fine. Without it, the list holds the
    domains of the corpus that one of ``listed_words`` names. Null urls and urls without ``://`` have an empty host and path, fit no rule and are
    allowed. Repeated rows are judged alike; an empty table gives an empty
    result; extra columns are ignored.
    """
    split = (pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"))
             .select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")))
    keys = url_keys(F.col("host"), F.col("path"))
    universe = split.select("host", "path").distinct().select(F.explode(keys).alias("key")).distinct()
    if listed is None:
        named = split.select("host").distinct().select(listed_domains(F.col("host"), listed_words).alias("key")).where("key is not null")
    else:
        entry = F.col("entry")
        host = F.substring_index(entry, "/", 1)
        named = (listed.toDF("entry").select(F.concat(ascii_lower(host), F.substring(entry, F.length(host) + 1, F.length(entry))).alias("key"))
                 .distinct().join(universe, "key", "left_semi"))
    cascades = build_cascades(named, universe, max_broadcast)
    flagged = flag_listed(split, keys, cascades, "listed")
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    return (flagged.withColumn("fit", rule)
            .select("id", "host", "path", F.col("fit.rule").alias("rule"),
                    F.coalesce(F.col("fit.verdict"), F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed"))
