"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding.

The encoder processes a text's agenda of candidate merges best score first,
like the model's own encoder, but skips each candidate with probability
``dropout``, decided by a keyed hash of (seed, id, copy, unit's place, place, length)
instead of a random generator. The same seed gives the same ids on any
cluster and after any task retry; with ``dropout`` 0 the ids are the model's.

No piece crosses the start of a run of spaces or a line break, nor a letter and
the punctuation mark after it, so the agenda of a text falls apart into one
agenda per unit (a word with the spaces before it). Every occurrence draws its
own: its number comes from the document's id, the copy and the unit's place.
Only what no draw changes is kept in a bounded cache: a unit's merges without
dropout. The draws of those merges are made for many occurrences at once; an
occurrence that skips none has the ids without dropout, the others' agendas
are rows of one matrix, and each step takes the best candidate of every row.
The bound only costs repeated work, never another result.

Decoding joins the pieces' bytes. A literal U+2581, which the model would
read as a space, is written as its three byte pieces, so that every text
comes back unchanged.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame

from clickscope.llm.common import importable_by_workers, pick

SPACE = "▁"
SEED = 20240111
DROPOUT = 0.1
CACHE_UNITS = 1_360_000  # per Python worker
MATRIX_CELLS = 1 << 15  # so that a matrix stays in a core's own cache
PAIR_SLOTS_BITS = 18
TEXT_CHARS = 1 << 20  # characters of a batch that are encoded together
NEVER = np.iinfo(np.int32).max
_MARKS = r".,;:!?|#$%&*"
_MASK = (1 << 64) - 1


class MergeDropout:
    """Encoder and decoder of one BPE model with byte fallback and no text normalisation."""

    def __init__(self, model: bytes, dropout: float = DROPOUT, seed: int = SEED, cache_units: int = CACHE_UNITS):
        if not 0 <= dropout < 1:
            raise ValueError("dropout must be in [0, 1)")
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        # plain pieces take part in merges; equal scores are settled by place alone
        plain = [i for i in range(sp.vocab_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self._size = sp.vocab_size()
        names = {sp.id_to_piece(i): i for i in plain}

        def symbol(part: str) -> int | None:
            """A piece's id; a lone character without a piece stands behind all ids."""
            return names.get(part, self._size + ord(part) if len(part) == 1 else None)

        pairs = {}
        for piece, i in names.items():
            for cut in range(1, len(piece)):
                left, right = symbol(piece[:cut]), symbol(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = (i, -sp.get_score(i))
        if any(re.search(f"[^{SPACE}]{SPACE}", name) for name in names):
            raise ValueError("a piece has a space behind a character, so words cannot be encoded one by one")
        keys = sorted(pairs)
        self._pair_keys = np.array(keys + [np.iinfo(np.int64).max], dtype=np.int64)
        self._pair_ids = np.array([pairs[k][0] for k in keys] + [0], dtype=np.int64)
        by_cost = {c: rank for rank, c in enumerate(sorted({c for _, c in pairs.values()}))}
        self._pair_ranks = np.array([by_cost[pairs[k][1]] for k in keys] + [NEVER], dtype=np.int32)
        slots = self._slots(self._pair_keys)
        self._in_slot = np.full(1 << PAIR_SLOTS_BITS, len(keys), dtype=np.int32)  # the last stands for no pair
        self._in_slot[slots] = np.arange(len(slots))
        self._crowded = np.bincount(slots, minlength=1 << PAIR_SLOTS_BITS) > 1
        self._of_char = np.arange(0x110000, dtype=np.int64) + self._size
        for piece, i in names.items():
            if len(piece) == 1 and piece != SPACE:
                self._of_char[ord(piece)] = i
        if SPACE in names:
            self._of_char[ord(" ")] = names[SPACE]
        self._byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(map(sp.is_byte, self._byte_ids)):
            raise ValueError("the model has no byte fallback, so decoding could lose text")
        pieces = [b""] * sp.vocab_size()
        for i in plain:
            pieces[i] = sp.id_to_piece(i).replace(SPACE, " ").encode()
        for b, i in enumerate(self._byte_ids):
            pieces[i] = bytes([b])
        self._blob = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self._length = np.array([len(p) for p in pieces])
        self._start = np.cumsum(self._length) - self._length
        # a letter before a punctuation mark ends a unit too, unless some piece holds the two together
        joined = any(re.search(f"[^\\W\\d_][{_MARKS}]", piece) for piece in names)
        self._unit = re.compile((rf" *[^\W\d_]+(?=[{_MARKS}])|" if not joined else "") + r"\n| *[^ \n]+| +")
        self._limit = int(dropout * 2 ** 64)
        self.seed = seed
        self._room = max(1, cache_units // 2)
        self._young: dict[str, tuple[bytes, bytes]] = {}  # unit: its candidates and its ids without dropout
        self._old: dict[str, tuple[bytes, bytes]] = {}

    def encode(self, text: str | None, key: str = "", copy: int = 0) -> np.ndarray:
        """Ids of one text; ``key`` (the document's id) and ``copy`` pick the draws. Null and empty texts have none."""
        return self.encode_many([text], [key], [copy])[0]

    def encode_many(self, texts: list[str | None], keys: list[str], copies: list[int] | None = None) -> list[np.ndarray]:
        """Ids of several texts at once."""
        units: list[str] = []
        ends, starts = [], []
        for text, key, copy in zip(texts, keys, copies or [0] * len(texts)):
            units += self._unit.findall(" " + text) if text else []
            ends.append(len(units))
            named = f"{copy}:{key}".encode("utf-8", "surrogatepass")
            starts.append(xxhash.xxh64_intdigest(named, self.seed & _MASK))
        counts = np.diff([0, *ends])
        place = np.arange(len(units)) - np.repeat(np.array(ends) - counts, counts)
        base = self._mixed(np.repeat(np.array(starts, dtype=np.uint64), counts)
                           + (place + 1).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        known = dict.fromkeys(units)
        plain = self._plain(list(known))
        known.update(zip(known, range(len(known))))
        which = np.fromiter(map(known.__getitem__, units), np.int64, len(units))  # each unit's place in plain
        ids = [unit_ids for _, unit_ids in plain]
        if self._limit and units:
            chains = [chain for chain, _ in plain]
            merges, sizes = self._gathered(np.frombuffer(b"".join(chains), dtype="<u8"), self._counts(chains, 8), which)
            owner = np.repeat(np.arange(len(units)), sizes)
            drawn = self._mixed(base[owner] + merges * np.uint64(0x9E3779B97F4A7C15))
            skips = np.zeros(len(units), dtype=bool)
            skips[owner[drawn < np.uint64(self._limit)]] = True
            hit = np.flatnonzero(skips)
            hit_lengths = np.fromiter(map(len, known), np.int64, len(known))[which[hit]]
            order = np.argsort(hit_lengths, kind="stable")
            hit, hit_lengths = hit[order], hit_lengths[order]
            which[hit] = len(ids) + np.arange(len(hit))
            for low, high in self._like_lengths(hit_lengths):
                at = hit[low:high]
                ids += self._merged([units[i] for i in at.tolist()], base[at], self._limit)[0]
        flat, sizes = self._gathered(np.frombuffer(b"".join(ids), dtype="<i4"), self._counts(ids, 4), which)
        stops = np.concatenate([[0], np.cumsum(sizes)])[[0, *ends]].tolist()
        return [flat[low:high] for low, high in zip(stops, stops[1:])]

    @staticmethod
    def _counts(rows: list[bytes], width: int) -> np.ndarray:
        return np.fromiter(map(len, rows), np.int64, len(rows)) // width

    @staticmethod
    def _gathered(flat: np.ndarray, counts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows ``which`` on end and their sizes; row i is the next ``counts[i]`` values of ``flat``."""
        starts, sizes = (np.cumsum(counts) - counts)[which], counts[which]
        ends = np.cumsum(sizes)
        return flat[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)], sizes

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``: the pieces' bytes, without the space that encoding puts in front."""
        if not len(ids):
            return ""
        lengths = self._length[ids]
        ends = np.cumsum(lengths)
        places = np.repeat(self._start[ids] - ends + lengths, lengths) + np.arange(ends[-1])
        return self._blob[places].tobytes()[1:].decode("utf-8", "surrogatepass")

    @staticmethod
    def _like_lengths(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of units, of these ascending lengths, of like lengths, each for one bounded matrix."""
        low = 0
        while low < len(lengths):
            width = int(lengths[low])
            high = min(int(np.searchsorted(lengths, width + 3, side="right")), low + -(-MATRIX_CELLS // width))
            yield low, high
            low = high

    def _plain(self, units: list[str]) -> list[tuple[bytes, bytes]]:
        """Candidates and ids without dropout of distinct ``units``; new ones go to the young half of the cache."""
        found = list(map(self._young.get, units))
        missing = [unit for unit, known in zip(units, found) if known is None]
        new = dict(zip(missing, map(self._old.get, missing)))
        work = sorted((unit for unit, known in new.items() if known is None), key=len)
        for low, high in self._like_lengths(np.fromiter(map(len, work), np.int64, len(work))):
            part = work[low:high]
            ids, chains = self._merged(part, np.zeros(len(part), dtype=np.uint64), 0)
            new.update(zip(part, zip(chains, ids)))
        if len(self._young) + len(new) > self._room:
            self._old, self._young = self._young, {}
        self._young.update(new)
        return [new[unit] if known is None else known for unit, known in zip(units, found)]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of merging symbol pairs (``NEVER`` where there is no such piece) and the piece made."""
        keys = left << 32 | right
        slots = self._slots(keys)
        at = self._in_slot[slots]
        odd = np.flatnonzero(self._crowded[slots])
        at[odd] = np.searchsorted(self._pair_keys, keys[odd])
        return np.where(self._pair_keys[at] == keys, self._pair_ranks[at], NEVER), self._pair_ids[at]

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        """The slot of each pair in a table that most pairs have to themselves."""
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - PAIR_SLOTS_BITS)).view(np.int64)

    def _merged(self, units: list[str], base: np.ndarray, limit: int) -> tuple[list[bytes], list[bytes]]:
        """Run the agendas of several units side by side: the ids and, without a limit, the candidates in order.

        A symbol stays where its first character is: per place, ``sym`` is the
        symbol (-1: none starts here), ``after`` and ``before`` its
        neighbours, ``rank`` and ``made`` the candidate with the next symbol.
        Each step takes the best candidate of every row that has one.
        """
        count = len(units)
        lengths = np.array([len(unit) for unit in units])
        width = int(lengths.max()) + 1  # one place more, where no symbol starts
        chars = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        inside = np.arange(width) < lengths[:, None]
        grid = np.full((count, width), -1, dtype=np.int64)
        grid[inside] = self._of_char[chars]
        sym = grid.ravel()
        after = np.tile(np.arange(1, width + 1), count)
        before = np.tile(np.arange(-1, width - 1), count)
        rank, made = np.full(count * width, NEVER, dtype=np.int32), np.zeros(count * width, dtype=np.int64)
        pairs = np.flatnonzero(sym[1:] >= 0)
        pairs = pairs[sym[pairs] >= 0]
        rank[pairs], made[pairs] = self._ranks(sym[pairs], sym[pairs + 1])
        ranks = rank.reshape(count, width)
        active = np.arange(count)
        taken: list[tuple[np.ndarray, np.ndarray]] = []
        while len(active):
            best = ranks[active].argmin(axis=1)
            row = active * width
            here = row + best
            live = rank[here] != NEVER
            active, best, row, here = active[live], best[live], row[live], here[live]
            right = after[here]
            end = after[row + right]
            if not limit:
                taken.append((active, best * 0x10001 + end - best))
            else:
                skip = self._drawn(base[active], best, end - best) < np.uint64(limit)
                rank[here[skip]] = NEVER
                take = ~skip
                best, row, here, right, end = best[take], row[take], here[take], right[take], end[take]
            new = made[here]
            sym[here], sym[row + right] = new, -1
            rank[row + right] = NEVER
            after[here], before[row + end] = end, best
            rank[here], made[here] = self._ranks(new, sym[row + end])
            prior = before[here]
            has = prior >= 0
            there = (row + prior)[has]
            rank[there], made[there] = self._ranks(sym[there], new[has])
        starts = grid >= 0
        flat, ends = sym[sym >= 0], np.cumsum(starts.sum(axis=1)).tolist()
        packed = flat.astype("<i4").tobytes()
        plain = (grid < self._size).all(axis=1).tolist()
        ids = [packed[4 * low:4 * high] if ok else self._with_bytes(flat[low:high])
               for low, high, ok in zip([0, *ends], ends, plain)]
        if not taken:
            return ids, [b""] * count
        rows, candidates = (np.concatenate(x) for x in zip(*taken))
        chain = candidates[np.argsort(rows, kind="stable")].astype("<u8").tobytes()
        stops = (8 * np.cumsum(np.bincount(rows, minlength=count))).tolist()
        return ids, [chain[low:high] for low, high in zip([0, *stops], stops)]

    def _with_bytes(self, symbols: np.ndarray) -> bytes:
        """Ids of a row in which some characters have no piece: those become byte pieces."""
        ids: list[int] = []
        for s in symbols.tolist():
            if s < self._size:
                ids.append(s)
            else:
                ids.extend(self._byte_ids[b] for b in chr(s - self._size).encode("utf-8", "surrogatepass"))
        return np.array(ids, dtype="<i4").tobytes()

    @staticmethod
    def _drawn(base: np.ndarray, left: np.ndarray, size: np.ndarray) -> np.ndarray:
        """64 mixed bits for each row's candidate that makes ``size`` characters at ``left``."""
        return MergeDropout._mixed(base + (left * 0x10001 + size).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    @staticmethod
    def _mixed(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _codec(model: bytes, dropout: float, seed: int, cache_units: int = CACHE_UNITS) -> MergeDropout:
    """One codec, with its cache, per Python worker and setting."""
    return MergeDropout(model, dropout, seed, cache_units)


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``TEXT_CHARS`` bytes of text each."""
    low, size = 0, 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        size += n or 0
        if size >= TEXT_CHARS:
            yield low, i + 1
            low, size = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


def read_model(path: str) -> bytes:
    """The model file, read on the driver; its bytes travel with the task."""
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, model: bytes, dropout: float = DROPOUT, seed: int = SEED,
                     id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
                     copy_col: str | None = None, cache_units: int = CACHE_UNITS) -> DataFrame:
    """(id, kept columns, token_ids, n_tokens, decoded_sha256, lossless) per row of ``docs``.

    ``token_ids`` is an array of ints; ``decoded_sha256`` the digest of the
    text decoded from them; ``lossless`` whether it equals the text. A null
    text is encoded like an empty one: no ids. A null id draws like an
    empty id. Rows of the same id and text get equal ids, unless ``copy_col``
    (integers) numbers them: then each copy draws its own. Names in ``keep`` must not clash
    with the four new columns; other columns are ignored. A worker outlives its
    task and keeps its cache, some 250 bytes for each of ``cache_units``, while
    other stages run; fewer cost repeated work, never another result.
    """
    importable_by_workers(docs.sparkSession)
    columns = [id_col, *[c for c in keep if c != id_col]]
    source = pick(docs, *dict.fromkeys([*columns, text_col, *([copy_col] if copy_col else [])]))
    at = source.columns.index(text_col)
    copy_at = source.columns.index(copy_col) if copy_col else None
    types = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in columns], "token_ids array<int>", "n_tokens bigint",
                        "decoded_sha256 string", "lossless boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model, dropout, seed, cache_units)
        for batch in batches:
            parts, lengths, digests, same = [], [0], [], []
            keys = ["" if key is None else str(key) for key in batch.column(0).to_pylist()]
            copies = [0] * len(keys) if copy_at is None else [c or 0 for c in batch.column(copy_at).to_pylist()]
            for low, high in _slices(batch.column(at)):
                texts = batch.column(at).slice(low, high - low).to_pylist()
                for text, ids in zip(texts, codec.encode_many(texts, keys[low:high], copies[low:high])):
                    back = codec.decode(ids)
                    parts.append(ids)
                    lengths.append(lengths[-1] + len(ids))
                    digests.append(hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest())
                    same.append(back == (text or ""))
            flat = np.concatenate(parts) if parts else np.empty(0, dtype="<i4")
            ids = pa.ListArray.from_arrays(pa.array(np.array(lengths, dtype=np.int32)), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(columns))], ids, pa.array(np.diff(lengths).astype(np.int64)),
                 pa.array(digests, pa.string()), pa.array(same, pa.bool_())],
                names=[*columns, "token_ids", "n_tokens", "decoded_sha256", "lossless"])

    return source.mapInArrow(run, schema)
