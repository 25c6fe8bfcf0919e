"""Document fingerprints: a Merkle tree over sections, paragraphs and sentences.

A text is cut at blank lines into sections, a section at line breaks into
paragraphs, a paragraph behind sentence marks (and after ``LEAF_CHARS``
characters without one) into leaves. Every cut can be undone, so equal trees
mean equal texts. A node's digest is SHA-256 over its children's digests; equal
roots mean equal texts, and where roots differ the differing sections, then
paragraphs, locate the edit (``edits``).

The fingerprint is a string: the root's digest, a colon, and the first
``BRANCH_DIGITS`` hex digits of every leaf digest. Two fingerprints alone tell
equality (the root) and likeness (the share of leaves in common). Forty bits
of a leaf are kept, so two different leaves of a pair of texts with n leaves
each count as one with a chance below n * n / 10^12.

Everything is DataFrame functions on one row per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickscope.llm.common import durable, pick

LEAF_CHARS = 40
BRANCH_DIGITS = 10
PARAGRAPH_BITS = 32  # of a place that is packed into one long
LEAF = rf"(?s).{{0,{LEAF_CHARS - 1}}}?[.!?]|.{{1,{LEAF_CHARS}}}"


def _digest(parts: Column) -> Column:
    return F.sha2(F.concat_ws(",", parts), 256)


def tree(text: Column) -> Column:
    """array<struct<digest, paragraphs: array<struct<digest, leaves: array<string>>>>>, one entry per section.

    A null text has the tree of an empty one: one section with one paragraph
    without leaves.
    """
    def paragraph(p: Column) -> Column:
        leaves = F.transform(F.regexp_extract_all(p, F.lit(LEAF), F.lit(0)), lambda leaf: F.sha2(leaf, 256))
        return leaves

    def section(s: Column) -> Column:
        leaves = F.transform(F.split(s, "\n"), paragraph)
        return F.transform(leaves, lambda x: F.struct(_digest(x).alias("digest"), x.alias("leaves")))

    sections = F.transform(F.split(F.coalesce(text, F.lit("")), "\n\n"), section)
    return F.transform(sections, lambda ps: F.struct(_digest(F.transform(ps, lambda p: p["digest"])).alias("digest"),
                                                     ps.alias("paragraphs")))


def fingerprint(nodes: Column) -> Column:
    """Fingerprint string of a ``tree``."""
    root = _digest(F.transform(nodes, lambda s: s["digest"]))
    leaves = F.flatten(F.transform(nodes, lambda s: F.flatten(F.transform(s["paragraphs"], lambda p: p["leaves"]))))
    return F.concat(root, F.lit(":"), F.concat_ws(",", F.transform(leaves, lambda x: F.left(x, F.lit(BRANCH_DIGITS)))))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, else twice the common leaves over all leaves (each distinct leaf once)."""
    def leaves(f: Column) -> Column:
        listed = F.substring_index(f, ":", -1)
        return F.when(listed == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.split(listed, ",")))

    x, y = leaves(a), leaves(b)
    total = F.size(x) + F.size(y)
    common = F.size(F.array_intersect(x, y))
    return F.when(a == b, F.lit(1.0)).when(total > 0, 2.0 * common / total).otherwise(F.lit(0.0))


def _changed(a: Column, b: Column) -> Column:
    """Places of ``a`` that differ from tree ``b``, as longs: the section's number above the paragraph's."""
    def paragraphs(s: Column, i: Column) -> Column:
        other = F.get(b, i)
        changed = F.filter(F.sequence(F.lit(0), F.size(s["paragraphs"]) - 1), lambda j: ~F.get(s["paragraphs"], j)["digest"]
                           .eqNullSafe(F.get(other["paragraphs"], j)["digest"]))
        places = F.transform(changed, lambda j: F.shiftleft(i.cast("bigint"), PARAGRAPH_BITS) + j)
        return F.when(s["digest"].eqNullSafe(other["digest"]), F.slice(places, 1, 0)).otherwise(places)

    return F.flatten(F.transform(a, paragraphs))


def _unpacked(places: Column) -> Column:
    low = F.lit((1 << PARAGRAPH_BITS) - 1).cast("bigint")
    return F.transform(places, lambda x: F.struct(F.shiftright(x, PARAGRAPH_BITS).cast("int").alias("section"),
                                                  x.bitwiseAND(low).cast("int").alias("paragraph")))


def differing(a: Column, b: Column) -> Column:
    """Places (section, paragraph, from 0) where tree ``a`` differs from tree ``b``, branch by branch.

    A section whose digests agree is not looked into. Only places of ``a``;
    ``edits`` has those of both trees.
    """
    return _unpacked(_changed(a, b))


def edits(a: Column, b: Column) -> Column:
    """Places (section, paragraph, from 0) that differ or that only one of the two trees has, in order."""
    return _unpacked(F.array_sort(F.array_union(_changed(a, b), _changed(b, a))))


def places_text(places: Column) -> Column:
    """Places as text, ``section:paragraph``, joined by commas."""
    return F.array_join(F.transform(places, lambda p: F.concat(p["section"].cast("string"), F.lit(":"), p["paragraph"].cast("string"))), ",")


def next_documents(keys: DataFrame) -> DataFrame:
    """(id, text_hash, n_chars, next_id, next_hash) for distinct (id, text_hash, n_chars).

    Next in descending order of (id, text hash), null ids last; after the last
    comes the first. Keys are range-partitioned, paired inside each partition,
    and stitched with one row per partition.
    """
    order = [F.col("id").desc_nulls_last(), F.col("text_hash").desc()]
    placed = durable(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part").orderBy(*order)
    paired = (placed.withColumn("next_id", F.lead("id").over(inside)).withColumn("next_hash", F.lead("text_hash").over(inside))
              .withColumn("place", F.row_number().over(inside)))
    heads = paired.where("place = 1").select("part", F.col("id").alias("head_id"), F.col("text_hash").alias("head_hash"))
    along = Window.orderBy("part")  # one row per partition
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follow = F.struct("head_id", "head_hash")
    heads = heads.select("part", F.coalesce(F.lead(follow).over(along), F.first(follow).over(whole)).alias("follow"))
    last = F.col("next_hash").isNull()  # a text hash is never null
    return (paired.join(heads, "part")
            .select("id", "text_hash", "n_chars",
                    F.when(last, F.col("follow.head_id")).otherwise(F.col("next_id")).alias("next_id"),
                    F.when(last, F.col("follow.head_hash")).otherwise(F.col("next_hash")).alias("next_hash")))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every row's text, its edited text, and compare.

    Edited text: the last floor(n / 3) code points are replaced by the first as
    many (or all) of the next document's text. Returns (id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    edited_places) per row; ``edited_places`` are the sections and paragraphs
    where the two trees differ (``places_text`` of ``edits``). Rows that repeat
    an id and text count as one document in the order and each come back; a
    null text is empty; a null id is last in the order; a lone document is its
    own next one; an empty table gives an empty result. Extra columns are
    ignored.

    Whole texts are shuffled once, by id: both joins read the same exchange,
    and the next document travels as its needed beginning and its fingerprint.
    """
    rows = (pick(docs, id_col, text_col).toDF("id", "text")
            .select("id", F.coalesce("text", F.lit("")).alias("text"))
            .withColumn("text_hash", F.xxhash64("text")))
    keys = rows.select("id", "text_hash", F.length("text").alias("n_chars")).distinct()
    # (id or zero, id is null, text hash): plain equality, and both joins' sides
    # have the same columns, so that the joins and the window share one exchange
    zero = F.lit("0").cast(rows.schema["id"].dataType)
    keyed = rows.select(F.coalesce("id", zero).alias("k_id"), F.col("id").isNull().alias("k_null"), "text_hash", "text")
    pairs = durable(next_documents(keys)).select(
        "n_chars", F.coalesce("id", zero).alias("own_id"), F.col("id").isNull().alias("own_null"), F.col("text_hash").alias("own_hash"),
        F.coalesce("next_id", zero).alias("next_id"), F.col("next_id").isNull().alias("next_null"), "next_hash")
    donors = (keyed.join(pairs, (F.col("k_id") == F.col("next_id")) & (F.col("k_null") == F.col("next_null"))
                         & (F.col("text_hash") == F.col("next_hash")))
              .select("own_id", "own_null", "own_hash", F.left("text", F.floor(F.col("n_chars") / 3).cast("int")).alias("beginning"),
                      fingerprint(tree(F.col("text"))).alias("next_fingerprint")))
    copy = Window.partitionBy("own_id", "own_null", "own_hash").orderBy(F.lit(0))  # copies of a donor are equal
    donors = donors.withColumn("copy", F.row_number().over(copy)).where("copy = 1").drop("copy")
    n = F.length("text")
    kept = (n - F.floor(n / 3)).cast("int")
    edited = F.concat(F.left("text", kept), F.col("beginning"))
    return (keyed.join(donors, (F.col("k_id") == F.col("own_id")) & (F.col("k_null") == F.col("own_null"))
                       & (F.col("text_hash") == F.col("own_hash")))
            .select(F.when(~F.col("k_null"), F.col("k_id")).alias("id"), "text", n.cast("bigint").alias("n_chars"),
                    edited.alias("edited"), "next_fingerprint")
            .select("id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), tree(F.col("text")).alias("own"),
                    tree(F.col("edited")).alias("other"), "next_fingerprint")
            .select("id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
                    fingerprint(F.col("other")).alias("edited_fingerprint"), "next_fingerprint",
                    places_text(edits(F.col("own"), F.col("other"))).alias("edited_places"))
            .select("id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"), "edited_places"))
