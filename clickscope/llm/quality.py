"""Quality rules: base counts, and divergence from language references.

Everything is DataFrame functions on one row per document; texts are never
shuffled. Texts are read once: one pass takes each document's counts and its
character-class and common-word histograms, some fifty numbers, and writes
them beside the columns that the caller wants back. The histograms added up
per language are its reference, and each document is compared with that by
Jensen-Shannon distance, all from the written numbers.

Rules. A document is rejected when it fails the base rule (too few words, or
over half of its words inside repeated three-word windows), or when a
histogram lies farther from the language reference than its limit allows. Three
are compared: the character classes, the common words, and the character
classes once more with all but the symbols put together, since a few symbols
among many letters move the first one little. The last one is zero for a text
with no larger share of symbols than its language: fewer are no fault.
Short histograms scatter about as 1 / sqrt(words), so each limit widens by a
margin of that form, and a histogram counts only from a minimum length on. A
language whose own total is below the guard, or a null language, has no
reference and only the base rule applies.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import durable, fresh, words, written

# Frequent function words of four languages.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "en": "the of and to in a is that it for was on with as be by at this from or".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
    "fr": "de la le et les des en un une du que est dans pour qui par sur au plus pas".split(),
}
# Character classes; SYMBOLS are one more, and whatever none has is the last.
CLASSES = (
    ("lower", r"[^\p{Ll}]+"),
    ("upper", r"[^\p{Lu}]+"),
    ("digit", r"[^0-9]+"),
    ("space", r"[^\x09-\x0D\x20]+"),
    ("stop", r"[^.,;:!?'\"()-]+"),
)
SYMBOLS = "#*$%&|<>"
WINDOW = 3
INDEX_BITS = 28  # a word's place in its text; the other 36 bits of a key are hash


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; distances are Jensen-Shannon distances in [0, 1]."""
    min_words: int = 50
    max_repeat_percent: int = 50
    class_limit: float = 0.15
    class_scatter: float = 0.9
    word_limit: float = 0.23
    word_scatter: float = 0.7
    symbol_limit: float = 0.05
    symbol_scatter: float = 0.2
    class_min_chars: int = 200
    word_min_words: int = 50
    reference_min_words: int = 2_000
    max_reference_rows: int = 10_000  # size bound of the broadcast references


def _lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^\x09-\x0D\x20]"))


def _with_repeats(df: DataFrame, w: str, out: str) -> DataFrame:
    """Add ``out``: words inside three-word windows that occur twice or more.

    Windows are compared by sorting 36 bits of hash packed with the place in
    one long; neighbours that agree are then compared word by word, so the
    count is exact. Long arrays of longs sort as primitives.
    """
    place = F.lit((1 << INDEX_BITS) - 1).cast("bigint")
    high = F.lit(-1 << INDEX_BITS).cast("bigint")
    count = F.size(w)
    heads = F.slice(F.col(w), F.lit(1), F.greatest(count - (WINDOW - 1), F.lit(0)))

    def pack(word, i):
        return F.xxhash64(word, *[F.get(F.col(w), i + k) for k in range(1, WINDOW)]).bitwiseAND(high).bitwiseOR(i.cast("bigint"))

    names = [fresh(df.columns, n) for n in ("keys_", "suspects_", "windows_", "places_")]
    keys, suspects, windows, places = names
    df = df.withColumn(keys, F.sort_array(F.transform(heads, pack)))

    def near(x, j):
        same = lambda k: F.coalesce(x.bitwiseXOR(F.get(F.col(keys), j + k)).bitwiseAND(high) == 0, F.lit(False))
        return same(1) | same(-1)

    df = df.withColumn(suspects, F.transform(F.filter(F.col(keys), near), lambda x: x.bitwiseAND(place).cast("int")))
    window = lambda p: F.concat_ws(" ", *[F.get(F.col(w), p + k) for k in range(WINDOW)])
    df = df.withColumn(windows, F.sort_array(F.transform(F.col(suspects), lambda p: F.struct(window(p).alias("g"), p.alias("p")))))

    def twice(s, j):
        same = lambda k: F.coalesce(s["g"] == F.get(F.col(windows), j + k)["g"], F.lit(False))
        return same(1) | same(-1)

    df = df.withColumn(places, F.sort_array(F.transform(F.filter(F.col(windows), twice), lambda s: s["p"])))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("total"))
    covered = F.aggregate(places, start,
                          lambda acc, p: F.struct(p.alias("last"), (acc["total"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("total")),
                          lambda acc: acc["total"])
    return df.withColumn(out, covered).drop(*names)


def _class_counts(text: Column, symbols: Column) -> Column:
    known = [F.length(F.regexp_replace(text, pattern, "")) for _, pattern in CLASSES] + [symbols]
    rest = F.length(text)
    for c in known:
        rest = rest - c
    return F.array(*[c.cast("double") for c in known], rest.cast("double"))


def _word_list(lang: Column) -> Column:
    chosen = F.lit(None).cast("array<string>")
    for name, listed in COMMON_WORDS.items():
        chosen = F.when(lang == name, F.array(*[F.lit(w) for w in listed])).otherwise(chosen)
    return chosen


def _word_counts(common: Column, lang: Column, total: Column) -> Column:
    """Counts of the language's common words, then of all other words; null without a list."""
    size = F.size(common)
    counts = F.transform(_word_list(lang), lambda w: (size - F.size(F.array_remove(common, w))).cast("double"))
    rest = total.cast("double") - F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.concat(counts, F.array(rest))


def measure(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", name: str = "features") -> DataFrame:
    """``docs`` with the struct column ``name`` of all that the rules look at.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_chars, classes, commons (null without a word list for the language). A
    null text has no words.
    """
    taken = docs.columns
    n = {f: fresh([*taken, name], f"q_{f}") for f in ("words", "common", "repeats", "symbols")}
    text, lang = F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.col(f"`{lang_col}`")
    listed = sorted({w for ws in COMMON_WORDS.values() for w in ws})
    df = docs.withColumn(n["words"], words(text))
    df = df.withColumns({n["common"]: F.filter(F.col(n["words"]), lambda w: w.isin(listed)),
                         n["symbols"]: F.length(text) - F.length(F.translate(text, SYMBOLS, ""))})
    df = _with_repeats(df, n["words"], n["repeats"])
    lines = _lines_with_words(text)
    count = F.size(n["words"])
    return df.select(*[F.col(f"`{c}`") for c in taken], F.struct(
        count.cast("bigint").alias("n_words"),
        F.length(F.array_join(F.col(n["words"]), "")).cast("bigint").alias("word_chars"),
        F.col(n["symbols"]).cast("bigint").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        F.col(n["repeats"]).alias("n_repeat_words"),
        F.length(text).alias("n_chars"),
        _class_counts(text, F.col(n["symbols"])).alias("classes"),
        _word_counts(F.col(n["common"]), lang, count).alias("commons")).alias(name))


def references(measured: DataFrame, rules: Rules = Rules(), lang_col: str = "lang", name: str = "features") -> DataFrame:
    """(lang, n_words, classes, commons): summed histograms over all documents of each language.

    ``measured`` is a result of ``measure``. One row per language with a
    reference; null languages have none.
    """
    own = measured.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{name}`").alias("f")).where("lang is not null")
    width, n_classes = max(len(ws) for ws in COMMON_WORDS.values()) + 1, len(CLASSES) + 2
    sums = (own.groupBy("lang").agg(
        F.sum("f.n_words").alias("n_words"),
        *[F.sum(F.get("f.classes", F.lit(i))).alias(f"k{i}") for i in range(n_classes)],
        *[F.sum(F.get("f.commons", F.lit(i))).alias(f"c{i}") for i in range(width)])
        .where(F.col("n_words") >= rules.reference_min_words))
    classes = F.array(*[F.col(f"k{i}") for i in range(n_classes)])
    commons = F.when(F.col("c0").isNotNull(), F.filter(F.array(*[F.col(f"c{i}") for i in range(width)]), lambda x: x.isNotNull()))
    return sums.select("lang", "n_words", classes.alias("classes"), commons.alias("commons"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, in [0, 1]) of two count arrays; null if either is null or empty of counts."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    plogp = lambda x: F.when(x > 0, x * F.log2(x)).otherwise(0.0)

    def part(x, y):
        return plogp(x) / 2 + plogp(y) / 2 - plogp((x + y) / 2)

    tp, tq = total(p), total(q)
    divergence = F.aggregate(F.zip_with(p, q, lambda x, y: part(x / tp, y / tq)), F.lit(0.0), lambda s, x: s + x)
    return F.when((tp > 0) & (tq > 0), F.sqrt(F.greatest(F.lit(0.0), divergence)))


def _excess_of_symbols(classes: Column, ref: Column) -> Column:
    """Distance of the shares of symbols, zero where the first share is not the larger one."""
    symbols, total = (lambda a: F.get(a, F.lit(len(CLASSES)))), (lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x))
    two = lambda a: F.array(symbols(a), total(a) - symbols(a))
    larger = symbols(classes) * total(ref) > symbols(ref) * total(classes)
    return F.when(larger, js_distance(two(classes), two(ref))).when(ref.isNotNull(), F.lit(0.0))


def judge(measured: DataFrame, refs: DataFrame, rules: Rules = Rules(), lang_col: str = "lang",
          name: str = "features", verdict: str = "quality") -> DataFrame:
    """``measured`` with the struct column ``verdict`` in place of its features.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    class_distance, word_distance, symbol_distance (null where a guard keeps
    the histogram out or there is no reference), base_failed, kept. A text
    without words fails the base rule.
    """
    n = {f: fresh(measured.columns, f"q_{f}") for f in ("ref_lang", "ref_classes", "ref_commons", "class_far", "word_far", "symbol_far")}
    small = refs.select(F.col("lang").alias(n["ref_lang"]), F.col("classes").alias(n["ref_classes"]),
                        F.col("commons").alias(n["ref_commons"]))
    df = measured.join(F.broadcast(small) if refs.count() <= rules.max_reference_rows else small,
                       F.col(f"`{lang_col}`") == F.col(n["ref_lang"]), "left")
    f = F.col(f"`{name}`")
    count = f["n_words"]
    enough = f["n_chars"] >= rules.class_min_chars
    df = (df.withColumn(n["class_far"], F.when(enough, js_distance(f["classes"], F.col(n["ref_classes"]))))
          .withColumn(n["symbol_far"], F.when(enough, _excess_of_symbols(f["classes"], F.col(n["ref_classes"]))))
          .withColumn(n["word_far"], F.when(count >= rules.word_min_words, js_distance(f["commons"], F.col(n["ref_commons"])))))
    failed = (count < rules.min_words) | (f["n_repeat_words"] * 100 > count * rules.max_repeat_percent)
    root = F.sqrt(F.greatest(count, F.lit(1)))
    far = (F.coalesce(F.col(n["class_far"]) > rules.class_limit + rules.class_scatter / root, F.lit(False))
           | F.coalesce(F.col(n["word_far"]) > rules.word_limit + rules.word_scatter / root, F.lit(False))
           | F.coalesce(F.col(n["symbol_far"]) > rules.symbol_limit + rules.symbol_scatter / root, F.lit(False)))
    told = F.struct(*[f[x].alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                    F.col(n["class_far"]).alias("class_distance"), F.col(n["word_far"]).alias("word_distance"),
                    F.col(n["symbol_far"]).alias("symbol_distance"), failed.alias("base_failed"), (~failed & ~far).alias("kept"))
    return df.select(*[F.col(f"`{c}`") for c in measured.columns if c != name], told.alias(verdict))


def apply_rules(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text", lang_col: str = "lang",
                keep: tuple[str, ...] | None = None) -> DataFrame:
    """References over all of ``docs``, then every row judged against them.

    ``keep`` names the columns that come back beside the verdict, ``quality``
    (see ``fresh``); all by default. They are written once, with the features,
    into the shared checkpoint folder. Repeated rows are judged alike; an empty
    table gives an empty result; the verdict's name gives way to columns of
    ``docs``.
    """
    kept = list(docs.columns if keep is None else keep)
    verdict = fresh(kept, "quality")
    name, lang = fresh([*docs.columns, verdict], "q_features"), fresh([*docs.columns, verdict], "q_lang")
    measured = measure(docs, text_col, lang_col, name).select(
        *[F.col(f"`{c}`") for c in kept], F.col(f"`{lang_col}`").alias(lang), name)
    measured = written(measured, "quality-features")
    refs = durable(references(measured, rules, lang, name))
    return judge(measured, refs, rules, lang, name, verdict).drop(lang)


def keep_good(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass every rule, columns unchanged."""
    name = fresh(docs.columns, "quality")
    return apply_rules(docs, rules, text_col, lang_col).where(F.col(name)["kept"]).select(*[F.col(f"`{c}`") for c in docs.columns])
