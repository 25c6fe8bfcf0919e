"""Spelling variant grouping with bidirectional FM-index search schemes.

Two words are near if one inserted, deleted or replaced code point turns one
into the other. A query word is cut in the middle. A near word keeps one of
the two halves as it is, so there are two schemes: match the first half
exactly from the word's beginning and extend to the right across the second,
allowing one error; or match the second half exactly up to the word's end and
extend to the left across the first. Both run on suffix-rank intervals of an
FM-index over the delimited vocabulary (``$word$word$``) and of one over its
reverse, whose intervals are kept in step while the exact half is matched, so
that the search can turn round.

The vocabulary grows with the corpus, so no index holds all of it. A word that
a query finds by the first scheme begins with the query's first half; its own
length is within one of the query's, so the possible halves of a word are two
at most. Every word is dealt, as a candidate, by its possible first halves and
last halves, and as a query by its own two. Halves are hashed to bins of some
``BIN_WORDS`` words and every bin builds its own two indexes. A half that very
many words share has several bins, each with some of its candidates and all of
its queries; so no bin grows with the vocabulary, and none of the links is lost.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import LOWER, UPPER, durable, importable_by_workers, pick

MIN_CHARS, MIN_COUNT = 5, 3
DAMAGE_EVERY = 97
ROOT_FACTOR = 2
BIN_WORDS = 10_000
FLUSH_WORDS = 400_000
QUERY_BLOCK = 8_192
MAX_ROUNDS = 70  # counts at least double along a chain of forms

# Latin-1: A-Z become a-z, a-z and 0xC0-0xFF stay, everything else is a space
_LETTERS = bytes(ord(chr(b).lower()) if chr(b) in UPPER else b if chr(b) in LOWER or b >= 0xC0 else 0x20 for b in range(256))
_END, _STOP = 0, 1  # the end of the text and the delimiter; letters follow


def count_words(docs: DataFrame, every: int = DAMAGE_EVERY, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words of all texts with at least ``min_chars`` code points and ``min_count`` places.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased. Where
    ``every`` divides h, the unsigned crc32 of ``id:run``, the run loses its
    code point h % length; a null id reads as empty. A null text has no words.
    Counted in each map task first, so that a frequent word is sent once per
    some ``FLUSH_WORDS`` different ones.
    """
    importable_by_workers(docs.sparkSession)

    def rows(counts: Counter) -> pa.RecordBatch:
        kept = [(w.decode("latin-1"), n) for w, n in counts.items() if len(w) >= min_chars]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())],
                                          names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seed = zlib.crc32(f"{key}:".encode())
                # every other code point is a question mark in Latin-1, which is no letter
                for run_, n in Counter(text.encode("latin-1", "replace").translate(_LETTERS).split()).items():
                    h = zlib.crc32(run_ if run_.isascii() else run_.decode("latin-1").encode(), seed)
                    if h % every == 0:
                        at = h % len(run_)
                        run_ = run_[:at] + run_[at + 1:]
                    counts[run_] += n
                if len(counts) >= FLUSH_WORDS:
                    yield rows(counts)
                    counts = Counter()
        yield rows(counts)

    source = pick(docs, id_col, text_col).toDF("id", "text").select(
        F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("text")).where("text is not null")
    return source.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class FmIndex:
    """FM-index of one text of symbols whose last and smallest is ``_END``.

    ``ranks[i, c]`` is the number of c among the first i symbols of the
    Burrows-Wheeler transform.
    """

    def __init__(self, text: np.ndarray, symbols: int) -> None:
        self.suffixes = _suffix_array(text)
        last = text[self.suffixes - 1]
        self.ranks = np.zeros((len(text) + 1, symbols), dtype=np.int32)
        self.ranks[np.arange(len(text)) + 1, last] = 1
        np.cumsum(self.ranks, axis=0, out=self.ranks)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))[:-1]])

    def counts(self, low: np.ndarray, size: np.ndarray) -> np.ndarray:
        """How often each symbol stands before the suffixes of each interval."""
        return self.ranks[low + size] - self.ranks[low]

    def step(self, low: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Where the intervals begin once ``symbol`` is put in front."""
        return self.less[symbol] + self.ranks[low, symbol]


def _suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling; words differ, so a few rounds tell all suffixes apart."""
    rank, width, n = text.astype(np.int64), 1, len(text)
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[:n - width] = rank[width:] + 1
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], (np.diff(key[order]) != 0).astype(np.int64)]))
        if rank[order[-1]] == n - 1:
            return order
        width *= 2


class Vocabulary:
    """Bidirectional index of distinct words, and the two search schemes."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        points = [np.frombuffer(w.encode("utf-32-le"), dtype="<u4") for w in words]
        self.alphabet = np.unique(np.concatenate(points))
        stop = np.array([_STOP])
        text = np.concatenate([x for p in points for x in (stop, np.searchsorted(self.alphabet, p) + 2)] + [stop])
        self.stops = np.flatnonzero(text == _STOP)
        self.length = len(text)
        symbols = len(self.alphabet) + 2
        end = np.array([_END])
        self.forward = FmIndex(np.concatenate([text, end]), symbols)
        self.reverse = FmIndex(np.concatenate([text[::-1], end]), symbols)

    def _symbols(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the parts as a matrix, and their lengths; a letter that no word has is -1."""
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        flat = np.frombuffer("".join(parts).encode("utf-32-le"), dtype="<u4")
        place = np.searchsorted(self.alphabet, flat)
        known = self.alphabet[np.minimum(place, len(self.alphabet) - 1)] == flat
        out = np.full((len(parts), int(sizes.max(initial=0)) + 1), -1, dtype=np.int64)
        out[np.repeat(np.arange(len(parts)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = \
            np.where(known, place + 2, -1)
        return out, sizes

    def near(self, queries: list[str], first: bool) -> list[tuple[int, int]]:
        """(query, word) pairs whose single error is outside the exact half.

        ``first``: the first half is exact and the search extends to the
        right, else the last half is exact and it extends to the left.
        """
        halves = [q[:len(q) // 2] if first else q[len(q) // 2:][::-1] for q in queries]
        others = [q[len(q) // 2:] if first else q[:len(q) // 2][::-1] for q in queries]
        exact, turned = (self.forward, self.reverse) if first else (self.reverse, self.forward)
        query, low = self._match_exactly(halves, exact, turned)
        found = self._extend_with_one_error(others, query, *low, turned)
        # an interval that holds a whole delimited word has one suffix
        at = turned.suffixes[found[1]]
        if first:  # the place in the reversed text of the delimiter behind the word
            word = np.searchsorted(self.stops, self.length - 1 - at) - 1
        else:
            word = np.searchsorted(self.stops, at)
        return list(zip(found[0].tolist(), word.tolist()))

    def _match_exactly(self, halves: list[str], exact: FmIndex, turned: FmIndex):
        """Delimiter + half, from the half's last letter to the delimiter, with both intervals in step."""
        symbols, sizes = self._symbols(halves)
        symbols = np.concatenate([np.full((len(halves), 1), _STOP), symbols], axis=1)
        n = len(exact.suffixes)
        query = np.arange(len(halves))
        low, twin, size = np.zeros(len(halves), np.int64), np.zeros(len(halves), np.int64), np.full(len(halves), n)
        for step in range(int(sizes.max(initial=0)) + 1):
            live = sizes[query] >= step
            at = np.maximum(sizes[query] - step, 0)
            symbol = symbols[query, at]
            fits = ~live | (symbol >= 0)
            query, low, twin, size, live, symbol = (x[fits] for x in (query, low, twin, size, live, symbol))
            counts = exact.counts(low, size)
            before = np.cumsum(counts, axis=1) - counts
            rows = np.arange(len(query))
            symbol = np.where(live, symbol, _STOP)
            twin = np.where(live, twin + before[rows, symbol], twin)
            low = np.where(live, exact.step(low, symbol), low)
            size = np.where(live, counts[rows, symbol], size)
            keep = size > 0
            query, low, twin, size = query[keep], low[keep], twin[keep], size[keep]
        return query, (twin, size)

    def _extend_with_one_error(self, others: list[str], query: np.ndarray, low: np.ndarray, size: np.ndarray, index: FmIndex):
        """Extend across the other half with exactly one error, up to the delimiter."""
        symbols, sizes = self._symbols(others)
        place = np.zeros(len(query), dtype=np.int64)
        done_q, done_low = [], []
        clean = (query, low, size, place)       # no error yet
        spent = tuple(x[:0] for x in clean)     # the one error is made
        while len(clean[0]) or len(spent[0]):
            query, low, size, place = spent
            ended = place == sizes[query]
            symbol = np.where(ended, _STOP, symbols[query, place])
            counts = np.where(symbol >= 0, index.ranks[low + size, symbol] - index.ranks[low, symbol], 0)
            low = index.step(low, np.maximum(symbol, 0))
            whole = ended & (counts > 0)
            done_q.append(query[whole])
            done_low.append(low[whole])
            on = ~ended & (counts > 0)
            spent = [(query[on], low[on], counts[on], place[on] + 1)]

            query, low, size, place = clean
            counts = index.counts(low, size)
            counts[:, [_END, _STOP]] = 0
            row, symbol = np.nonzero(counts)
            more = place[row] < sizes[query[row]]
            hit = more & (symbol == symbols[query[row], place[row]])
            begin, width = index.step(low[row], symbol), counts[row, symbol].astype(np.int64)
            clean = (query[row][hit], begin[hit], width[hit], place[row][hit] + 1)
            changed, added, left_out = more & ~hit, ~hit, place < sizes[query]
            spent.append((query[row][changed], begin[changed], width[changed], place[row][changed] + 1))
            spent.append((query[row][added], begin[added], width[added], place[row][added]))
            spent.append((query[left_out], low[left_out], size[left_out], place[left_out] + 1))
            spent = tuple(np.concatenate(x) for x in zip(*spent))
        return np.concatenate(done_q or [place]), np.concatenate(done_low or [place])


def _half(word: Column, first: bool, length: Column) -> Column:
    """The half that a query of ``length`` code points would share with ``word``."""
    size = (length / 2).cast("int") if first else length - (length / 2).cast("int")
    return F.left(word, size) if first else F.right(word, size)


def near_words(vocabulary: DataFrame, bin_words: int = BIN_WORDS) -> DataFrame:
    """(word, near, near_n): pairs of near words, each way; a pair may come twice.

    ``vocabulary`` has distinct words of two code points or more and their n.
    """
    importable_by_workers(vocabulary.sparkSession)
    word, length = F.col("word"), F.length("word")
    sides = []
    for side, first in ((0, True), (1, False)):
        shared = F.array_distinct(F.array(*[_half(word, first, length + d) for d in (-1, 0, 1)]))
        sides.append(vocabulary.select("word", "n", F.lit(side).alias("side"), F.explode(shared).alias("half"),
                                       _half(word, first, length).alias("own")))
    dealt = sides[0].unionByName(sides[1])
    halves = durable(dealt.groupBy("side", "half").agg(F.count(F.lit(1)).alias("held")))
    total = halves.agg(F.sum("held")).first()[0] or 0
    bins = max(1, -(-total // bin_words))
    # at most one in ``bin_words`` halves' words: fewer rows than there are bins
    wide = halves.where(F.col("held") > bin_words).select("side", "half", F.ceil(F.col("held") / bin_words).cast("int").alias("parts"))
    placed = dealt.join(F.broadcast(wide), ["side", "half"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    asks, own_part = F.col("half") == F.col("own"), F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    placed = (placed.withColumn("own_part", own_part)
              .withColumn("part", F.explode(F.when(asks & (F.col("parts") > 1), F.sequence(F.lit(0), F.col("parts") - 1))
                                            .otherwise(F.array("own_part"))))
              .select((F.pmod(F.xxhash64("side", "half", "part"), F.lit(bins)) * 2 + F.col("side")).alias("bin"),
                      "word", "n", (F.col("part") == F.col("own_part")).alias("held"), asks.alias("asks")))

    def search(key: tuple, table: pa.Table) -> pa.Table:
        first = key[0].as_py() % 2 == 0
        words, n, held, asks_ = (table.column(c).to_pylist() for c in ("word", "n", "held", "asks"))
        known = sorted({(w, k) for w, k, h in zip(words, n, held) if h})
        queries = sorted({w for w, a in zip(words, asks_) if a})
        pairs = set()
        if known and queries:
            index = Vocabulary([w for w, _ in known])
            for at in range(0, len(queries), QUERY_BLOCK):
                pairs |= {(at + q, w) for q, w in index.near(queries[at:at + QUERY_BLOCK], first)}
        return pa.table([pa.array([queries[q] for q, _ in pairs], pa.string()), pa.array([known[w][0] for _, w in pairs], pa.string()),
                         pa.array([known[w][1] for _, w in pairs], pa.int64())], names=["word", "near", "near_n"])

    return placed.groupBy("bin").applyInArrow(search, "word string, near string, near_n bigint")


def spelling_groups(vocabulary: DataFrame, factor: int = ROOT_FACTOR, bin_words: int = BIN_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word of ``vocabulary`` (word, n).

    A word's form is its near word of largest n (ties: the smallest in
    code-point order) if that n is at least ``factor`` times its own, else
    null; its root is where following the forms ends, the word itself if it
    has none. n_near is 0 and form_n null where there is none.
    """
    vocabulary = durable(vocabulary.select("word", "n"))
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w")))
    around = near_words(vocabulary, bin_words).groupBy("word").agg(F.size(F.collect_set("near")).cast("bigint").alias("n_near"), best.alias("best"))
    formed = (-F.col("best.m")) >= F.col("n") * factor
    judged = durable(vocabulary.join(around, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(formed, F.col("best.w")).alias("form"), F.when(formed, -F.col("best.m")).alias("form_n")))
    roots = judged.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(MAX_ROUNDS):  # every round doubles the length of the steps
        onward = roots.select(F.col("word").alias("w"), F.col("root").alias("further"))
        roots = durable(roots.join(onward, F.col("root") == F.col("w"), "left")
                        .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if roots.where("moved").isEmpty():
            break
        roots = roots.select("word", "root")
    return (judged.join(roots.select("word", "root"), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
