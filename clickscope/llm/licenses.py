"""License scans: phrases, and an exact set-similarity join with templates.

Templates are license notices, each a set of words with a label. A text block
is a window of consecutive words of a paragraph (text between blank lines), as
wide as the template's words divided by ``threshold``, so that a notice that
wraps or has a word more is found and words far apart are not put together. A
block meets a template when it holds at least ``threshold`` of the template's
distinct words.

The join is exact and driven by the templates' rarest words. Words are ordered
by their document frequency over the whole corpus. Paragraphs are cut into
runs, each with a core and the surroundings of its words, and runs are joined
with the templates as sets (``matching_blocks``):

- prefix filter: what meets a template shares a word with the template's
  prefix, its |T| - needed + 1 rarest words, so runs join with the inverted
  index of the prefixes by equality of words;
- positional filter: a match at place p of the template leaves at most
  |T| - p words to share, which must reach the needed number together with the
  earlier places; only the first shared prefix word of a pair is followed;
- length filter: a run with fewer distinct words than needed is out.

In the pairs that remain, the windows around every prefix word of the core are
counted (``closest_windows``). Templates are a documented, small parameter;
index and word list are bounded by it.

Everything is DataFrame functions. Texts are read twice (frequencies, then
matching) and never shuffled; runs leave their row only when a cheap test on
the prefix words lets them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import durable, pick

# Phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Notices and paragraphs of licenses as projects print them.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
            " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
            " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
            " to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
               " compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is"
               " distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
               " See the License for the specific language governing permissions and limitations under the License."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
            " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
            " option) any later version."),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the"
            " following disclaimer."),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
            " products derived from this software without specific prior written permission."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
            " granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
            " not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source"
                  " code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc0", "dedicated to the public domain under CC0"),
)
THRESHOLD = 0.8
BLANK_LINE = r"\n[ \t\r]*\n"
MAX_TEMPLATE_WORDS = 100_000  # bound of everything that is broadcast


def words(text: Column) -> Column:
    """Runs of ASCII letters, digits and characters from 0x80 on, A-Z lower-cased. Null or none: empty.

    ``lower`` is faster than a translation of A-Z and gives the same ASCII
    words: the Kelvin sign, the one other character it makes a plain ASCII
    letter of, is replaced first. (Other letters from 0x80 on may change case;
    templates and phrases are ASCII, so no comparison sees it.)
    """
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\ufffd")))
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def template_table(spark, templates=TEMPLATES) -> DataFrame:
    """(template, label, words): the distinct words of each template."""
    raw = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)], "template int, label string, text string")
    return raw.select("template", "label", F.array_distinct(words(F.col("text"))).alias("words")).where(F.size("words") > 0)


def template_widths(spark, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(template, width): the widest window that a template is looked for in, in words."""
    raw = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(templates)], "template int, text string")
    span = F.size(words(F.col("text")))
    return raw.where(span > 0).select("template", F.ceil(span / F.lit(threshold)).cast("int").alias("width"))


def word_frequencies(docs: DataFrame, listed: list[str], text_col: str = "text") -> DataFrame:
    """(word, docs): in how many rows of ``docs`` each listed word stands; absent words are missing."""
    own = docs.select(words(F.col(f"`{text_col}`")).alias("w"))
    held = F.array_distinct(F.filter("w", lambda w: w.isin(listed)))
    return own.select(F.explode(held).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("docs"))


def prefix_index(templates: DataFrame, frequencies: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(word, place, template, label, size, needed, words): inverted index of the templates' prefixes.

    ``words`` are the template's in global order, rarest first, ties by the
    word; ``place`` counts from 0.
    """
    word_order = (templates.select("template", "label", F.explode("words").alias("word"))
                  .join(frequencies, "word", "left")
                  .groupBy("template", "label")
                  .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("docs", F.lit(0)).alias("docs"), "word"))).alias("o")))
    size = F.size("o")
    needed = F.greatest(F.lit(1), F.ceil(size * F.lit(threshold) - 1e-9).cast("int"))
    sized = word_order.select("template", "label", F.transform("o", lambda x: x["word"]).alias("words"),
                              size.alias("size"), needed.alias("needed"))
    return (sized.select("*", F.posexplode("words").alias("place", "word"))
            .where(F.col("place") <= F.col("size") - F.col("needed")))


def matching_blocks(blocks: DataFrame, index: DataFrame) -> DataFrame:
    """All pairs of a block and a template that meet the threshold as sets, once each.

    ``blocks`` has (block, words) with distinct words and any ``block`` key;
    returns (block, template, label, size, needed, own, containment), ``own``
    the template's words in global order.
    """
    small = F.broadcast(index) if index.count() <= MAX_TEMPLATE_WORDS else index
    known = sorted(r["word"] for r in index.select("word").distinct().collect())  # bounded by the templates
    asked = F.filter("words", lambda w: w.isin(known)) if known else F.array().cast("array<string>")
    tokens = blocks.select("block", F.col("words").alias("block_words"), F.explode(asked).alias("word"))
    pairs = tokens.join(small, "word").where(F.size("block_words") >= F.col("needed"))
    # positional: a pair is followed from its first shared place only, and the places left must suffice
    earlier = F.array_intersect(F.slice("words", F.lit(1), F.col("place")), F.col("block_words"))
    pairs = pairs.where((F.size(earlier) == 0) & (F.col("size") - F.col("place") >= F.col("needed")))
    shared = F.size(F.array_intersect("words", "block_words"))
    return (pairs.where(shared >= F.col("needed"))
            .select("block", "template", "label", "size", "needed", F.col("words").alias("own"), (shared / F.col("size")).alias("containment")))


def paragraph_runs(paragraphs: DataFrame, prefix_words: list[str], longest: int) -> DataFrame:
    """(block, low, core, run): runs of words around cores of ``longest`` words that hold a prefix word.

    ``paragraphs`` has (block, words), all words in order. A run reaches
    ``longest`` words beyond its core to either side, so that it has every
    window around a word of the core; ``low`` is the place in the paragraph of
    the run's first word, ``core`` the place in the run of the core's.
    """
    n = F.size("words")
    cut = paragraphs.where(n > 0).select("block", "words", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / longest).cast("int"))).alias("i"))
    first = F.col("i") * longest
    cut = cut.where(F.exists(F.slice("words", first + 1, F.lit(longest)), lambda w: w.isin(prefix_words)))
    low = F.greatest(F.lit(0), first - longest)
    return cut.select("block", low.alias("low"), (first - low).alias("core"), F.slice("words", low + 1, first - low + 2 * longest).alias("run"))


def closest_windows(pairs: DataFrame, longest: int) -> DataFrame:
    """Windows that meet a template, the closest one around each prefix word of a core.

    ``pairs`` has (block, low, core, run) with (template, label, size, needed,
    own, width). Returns (block, template, label, size, containment, begin,
    end, covered): the window's first and last word that the template has, by
    their place in the paragraph, and the distinct words they share. Of equally
    close windows around a word the last one stands.
    """
    prefix = F.slice("own", F.lit(1), F.col("size") - F.col("needed") + 1)
    spots = F.filter(F.transform(F.slice("run", F.col("core") + 1, F.lit(longest)),
                                 lambda x, i: F.when(F.array_contains(prefix, x), i + F.col("core"))), lambda i: i.isNotNull())
    spotted = pairs.select("*", F.explode(spots).alias("at"))
    starts = F.sequence(F.greatest(F.lit(0), F.col("at") - F.col("width") + 1), F.col("at"))
    windows = F.transform(starts, lambda s: F.struct(
        F.size(F.array_intersect(F.col("own"), F.slice("run", s + 1, F.col("width")))).alias("shared"), s.alias("start")))
    best = spotted.withColumn("window", F.array_max(windows)).where(F.col("window.shared") >= F.col("needed"))
    inside = F.slice("run", F.col("window.start") + 1, F.col("width"))
    hits = F.filter(F.transform(inside, lambda x, i: F.when(F.array_contains("own", x), i)), lambda i: i.isNotNull())
    first = F.col("low") + F.col("window.start")
    return best.withColumn("hits", hits).select(
        "block", "template", "label", "size", (F.col("window.shared") / F.col("size")).alias("containment"),
        (first + F.array_min("hits")).alias("begin"), (first + F.array_max("hits")).alias("end"),
        F.array_intersect("own", inside).alias("covered")).distinct()


def uncovered(matched: DataFrame) -> DataFrame:
    """(block, label, containment) of the matches that no better one of their block covers.

    A match covers another that overlaps it and shares no word beyond its own;
    better is the one the block holds most of, then the larger, then the first
    template.
    """
    rank = F.struct("containment", "size", (-F.col("template")).alias("first"))
    match = F.struct(rank.alias("rank"), "label", "covered", "begin", "end")
    met = matched.groupBy("block").agg(F.collect_set(match).alias("met"))
    kept = F.filter("met", lambda m: ~F.exists("met", lambda o: (
        (o["rank"] > m["rank"]) & (o["begin"] <= m["end"]) & (m["begin"] <= o["end"])
        & (F.size(F.array_except(m["covered"], o["covered"])) == 0))))
    return met.select("block", F.explode(kept).alias("m")).select("block", "m.label", F.col("m.rank.containment").alias("containment"))


def _places(w: Column, phrase: str) -> Column:
    """Where the phrase's words stand consecutively, as starts from 0, ascending."""
    first, *rest = phrase.split(" ")
    starts = F.transform(w, lambda x, i: F.when(x == first, i))

    def fits(i: Column) -> Column:
        ok = i.isNotNull()
        for k, word in enumerate(rest, 1):
            ok = ok & F.coalesce(F.get(w, i + k) == word, F.lit(False))
        return ok

    return F.filter(starts, fits)


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, phrases: dict[str, str] = PHRASES,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row of ``docs``.

    ``labels`` adds to the phrases' labels those of all templates that a window
    of words within a paragraph meets, but for matches that a better one at the
    same place covers (``uncovered``). ``score`` is the best containment of a
    template that a window meets (0 to 1; 0 without any). A null text has no
    words. Rows that repeat an id and text get equal results; a null id stays
    null; an empty table gives an empty result. Extra columns are ignored.
    """
    spark = docs.sparkSession
    rows = (pick(docs, id_col, text_col).toDF("id", "text")
            .select("id", F.coalesce("text", F.lit("")).alias("text")))
    table = template_table(spark, templates)
    listed = sorted({w for r in table.select("words").collect() for w in r["words"]})  # bounded by the parameter
    if len(listed) > MAX_TEMPLATE_WORDS:
        raise ValueError("the templates are a small parameter; these have too many words")
    index = durable(prefix_index(table, word_frequencies(rows, listed), threshold))
    prefix_words = sorted(r["word"] for r in index.select("word").distinct().collect())

    keyed = rows.withColumn("text_hash", F.xxhash64("text"))
    widths = template_widths(spark, templates, threshold)
    longest = widths.agg(F.max("width")).first()[0] or 1
    # only rows that hold a prefix word are cut into paragraphs
    held = F.exists(words(F.col("text")), lambda w: w.isin(prefix_words)) if prefix_words else F.lit(False)
    paragraphs = (keyed.where(held).select("id", "text_hash", F.explode(F.split("text", BLANK_LINE)).alias("paragraph")).distinct()
                  .select(F.struct("id", "text_hash", F.xxhash64("paragraph").alias("paragraph_hash")).alias("block"),
                          words(F.col("paragraph")).alias("words")))
    runs = paragraph_runs(paragraphs, prefix_words, longest)
    whole = runs.select(F.struct("block", "low", "core", "run").alias("block"), F.array_distinct("run").alias("words"))
    pairs = (matching_blocks(whole, index).join(F.broadcast(widths) if widths.count() <= MAX_TEMPLATE_WORDS else widths, "template")
             .select("block.*", "template", "label", "size", "needed", "own", "width"))
    found = (uncovered(closest_windows(pairs, longest))
             .groupBy(F.col("block.id").alias("found_id"), F.col("block.text_hash").alias("found_hash"))
             .agg(F.collect_set("label").alias("found_labels"), F.max("containment").alias("best")))

    base = keyed.select("id", "text_hash", words(F.col("text")).alias("w"))
    base = base.withColumn("n_words", F.size("w").cast("bigint"))
    none = F.array().cast("array<int>")
    for k, phrase in enumerate(phrases):
        rare = phrase.split(" ")[0]  # a row without the phrase's first word needs no closer look
        base = base.withColumn(f"p{k}", F.when(F.array_contains("w", rare), _places(F.col("w"), phrase)).otherwise(none))
    names = [f"p{k}" for k in range(len(phrases))]
    every = F.concat(none, *names)
    labels = F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(F.size(n) > 0, F.lit(label)) for n, label in zip(names, phrases.values())]))
    base = base.select("id", "text_hash", "n_words",
                       F.size(every).cast("bigint").alias("n_base"),
                       F.array_min(every).cast("bigint").alias("first_word"), F.array_max(every).cast("bigint").alias("last_word"),
                       F.array_sort(F.array_distinct(labels)).alias("own"))
    return (base.join(found, base["id"].eqNullSafe(F.col("found_id")) & (base["text_hash"] == F.col("found_hash")), "left")
            .select("id", "n_words", "n_base", "first_word", "last_word", F.array_join("own", ",").alias("base_labels"),
                    F.array_join(F.array_sort(F.array_union("own", F.coalesce("found_labels", F.array().cast("array<string>")))), ",").alias("labels"),
                    F.coalesce("best", F.lit(0.0)).alias("score")))
