"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets. Every source has a weight; together the targets share the whole
amount (the sum of all sizes). A target stops at ``max_epochs`` times its
source's size and what is above is shared again by weight until no target is
above. In closed form: sort the sources by cap per weight; all before some
point are at their cap and the rest get weight times one common level.

Selection. A target of e + f times the source's size takes every document e
times (complete epochs) and then documents worth f times the size: each
document draws the exponential key -ln(u) / quality with u a seeded hash of
its id and text, keys are sorted within the source and sizes are prefix-summed
in that order. A document is in while the sum with it stays inside the budget.
The documents outside whose size fits what is left are prefix-summed again in
the same order, until none fits or what is left is within ``NEAR`` of the
target; then one closing document, the one whose size is nearest to what is
left, is added where this brings the source nearer to its target.

The prefix sum is a tree: the key range of a source is cut into cells of about
``cell_rows`` rows each, cell totals are summed first, and only the rows of one
cell are ever sorted in one task. A source with a third of all rows is many
cells. Cells are even because quality weights are kept in tenths: a source's
key distribution is then a mixture of ten exponentials with known shares, and
its distribution function maps the keys to even cells.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickscope.llm.common import durable, fresh, pick, words

SEED = 20240111
CYCLE = (1.0, 2.0, 3.0)
MAX_EPOCHS = 3
QUALITY_LEVELS = 10
CELL_ROWS = 128
CELLS_A_GROUP = 1024
NEAR = 0.001  # share of the target that a source may miss before its budget is filled further


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def text_quality(text: Column) -> Column:
    """Documented heuristic weight in [0, 1]: the share of characters that are
    letters or spaces, squared, so that symbol junk is drawn last. Null: 0."""
    whole = F.length(text)
    plain = whole - F.length(F.regexp_replace(text, r"[\p{L} ]+", ""))
    share = F.when(whole > 0, plain / whole).otherwise(F.lit(0.0))
    return F.coalesce(share * share, F.lit(0.0))


def quality_level(quality: Column) -> Column:
    """Weights are used in tenths, rounded up, from 0.1 to 1; null counts as 0.1."""
    level = F.ceil(F.coalesce(quality, F.lit(0.0)) * QUALITY_LEVELS)
    return F.least(F.lit(QUALITY_LEVELS), F.greatest(F.lit(1), level)).cast("int")


def _key_share(key: Column, level_rows: Column, rows: Column) -> Column:
    """Expected share of a source's keys below ``key``."""
    below = F.lit(0.0)
    for level in range(1, QUALITY_LEVELS + 1):
        below = below + F.get(level_rows, F.lit(level - 1)) * (1 - F.exp(-key * (level / QUALITY_LEVELS)))
    return below / rows


def cycle_weights(sources: DataFrame, cycle: tuple[float, ...] = CYCLE) -> DataFrame:
    """Weigh sources 1, 2, 3, 1, ... by the code-point order of their names, null last.

    One row per source goes through this window, no document does.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(w) for w in cycle])
    return sources.withColumn("weight", F.get(weights, place % len(cycle)))


def targets(sources: DataFrame, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to (source, source_size, weight).

    Needs one row per source. A source of size zero has target zero.
    """
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_first())
    done = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = (sources.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
              .withColumn("whole", F.sum("source_size").over(everything))
              .withColumn("level", (F.col("whole") - F.coalesce(F.sum("cap").over(done), F.lit(0.0)))
                          / F.sum("weight").over(rest))
              .withColumn("open", F.col("level") * F.col("weight") <= F.col("cap")))
    # the level at the first source that stays below its cap holds for all after it
    levels = levels.withColumn("place", F.row_number().over(by_ratio))
    level = F.min(F.when(F.col("open"), F.struct("place", "level"))).over(everything)
    return (levels.withColumn("common", level["level"])
            .withColumn("target", F.when(F.col("common").isNull(), F.col("cap"))
                        .otherwise(F.least(F.col("cap"), F.col("common") * F.col("weight"))))
            .drop("cap", "whole", "level", "open", "place", "common"))


def _summed(rows: DataFrame) -> DataFrame:
    """Add ``through``: the sum of sizes up to and with the row in key order of its source."""
    strictly_before = (Window.unboundedPreceding, -1)
    in_source = Window.partitionBy("source").orderBy("cell_group").rowsBetween(*strictly_before)
    in_group = Window.partitionBy("source", "cell_group").orderBy("cell").rowsBetween(*strictly_before)
    in_cell = (Window.partitionBy("source", "cell").orderBy("es_key", "id", "text_hash", "copy_no")
               .rowsBetween(*strictly_before))
    zero = F.lit(0)
    cell_sums = rows.groupBy("source", "cell_group", "cell").agg(F.sum("size").alias("cell_size"))
    group_sums = cell_sums.groupBy("source", "cell_group").agg(F.sum("cell_size").alias("group_size"))
    group_base = group_sums.select(F.col("source").alias("s2"), F.col("cell_group").alias("g2"),
                                   F.coalesce(F.sum("group_size").over(in_source), zero).alias("group_base"))
    cell_base = (cell_sums.withColumn("base", F.coalesce(F.sum("cell_size").over(in_group), zero))
                 .join(group_base, F.col("source").eqNullSafe(F.col("s2")) & (F.col("cell_group") == F.col("g2")))
                 .select(F.col("source").alias("s1"), F.col("cell").alias("c1"),
                         (F.col("base") + F.col("group_base")).alias("cell_base")))
    through = F.col("cell_base") + F.coalesce(F.sum("size").over(in_cell), zero) + F.col("size")
    return (rows.join(cell_base, F.col("source").eqNullSafe(F.col("s1")) & (F.col("cell") == F.col("c1")))
            .withColumn("through", through).drop("s1", "c1", "cell_base"))


def _same_row(*columns: str) -> Column:
    """Equality of (id, text_hash, source, copy_no) with the columns of the given names."""
    own = ("id", "text_hash", "source", "copy_no")
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(own, columns)])


def _filled(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``placed`` with more rows inside, and (s3, gap): what is left of each source's budget.

    A round goes through the open rows of a source that are at most half as
    large as its gap, in key order, as far as they fit. So it halves the gap or
    takes all of those rows; where none is that small, the first row that fits
    is the last. A source is done in about log2(1 / ``NEAR``) rounds. Open rows
    too large for the gap stay so, as gaps only shrink: each round reads the
    rows that the last one left, and rows taken are a small table that marks
    ``placed`` once, at the end.
    """
    left = durable(placed.groupBy(F.col("source").alias("s3"))
                   .agg((F.first("budget") - F.coalesce(F.sum(F.when(F.col("inside"), F.col("size"))), F.lit(0))).alias("gap"),
                        F.first("target").alias("aim")))
    still_open, taken = placed.where("not inside and size > 0"), []
    of_source = F.col("source").eqNullSafe(F.col("s3"))
    while True:
        wide = left.where(F.col("gap") > F.col("aim") * F.lit(NEAR)).select("s3", "gap")
        fitting = durable(still_open.join(wide, of_source).where(F.col("size") <= F.col("gap")))
        if fitting.isEmpty():
            break
        small = fitting.groupBy(F.col("s3").alias("s4")).agg(F.bool_or(F.col("size") * 2 <= F.col("gap")).alias("halves"))
        offered = (fitting.join(small, F.col("s3").eqNullSafe(F.col("s4")))
                   .where(~F.col("halves") | (F.col("size") * 2 <= F.col("gap"))).drop("s3", "s4", "halves"))
        more = durable(_summed(offered).where(F.col("through") <= F.col("gap")).select(
            F.col("id").alias("i5"), F.col("text_hash").alias("h5"), F.col("source").alias("s5"), F.col("copy_no").alias("n5"),
            F.col("size").alias("z5")))
        taken.append(more)
        spent = more.groupBy("s5").agg(F.sum("z5").alias("spent"))
        left = durable(left.join(spent, F.col("s3").eqNullSafe(F.col("s5")), "left")
                       .select("s3", (F.col("gap") - F.coalesce("spent", F.lit(0))).alias("gap"), "aim"))
        still_open = fitting.drop("s3", "gap").join(more, _same_row("i5", "h5", "s5", "n5"), "left_anti")
    if taken:
        added = reduce(DataFrame.unionByName, taken)
        placed = durable(placed.join(added, _same_row("i5", "h5", "s5", "n5"), "left")
                         .withColumn("inside", F.col("inside") | F.col("n5").isNotNull()).drop("i5", "h5", "s5", "n5", "z5"))
    return placed, left.drop("aim")


def sample(docs: DataFrame, size: Column | None = None, quality: Column | None = None,
           id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           seed: int = SEED, max_epochs: int = MAX_EPOCHS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(id, text_hash, size, source_size, target, copies) per row of ``docs``.

    ``copies`` is how often the mix takes the row; taken words are
    ``copies * size``. A null source is a source of its own. Null and empty
    texts have size zero: their copies are those of the complete epochs.
    Repeated rows draw different keys (their number among equal rows enters
    the hash), so each is taken on its own. An empty table gives an empty
    result. Extra columns are ignored.
    """
    text, ident, source = (F.col(f"`{c}`") for c in (text_col, id_col, source_col))
    rows = docs.select(ident.alias("id"), source.alias("source"), F.xxhash64(text).alias("text_hash"),
                       (word_count(text) if size is None else size).alias("size"),
                       quality_level(text_quality(text) if quality is None else quality).alias("level"))
    rows = durable(rows)  # small rows without texts; read three times below
    levels = [F.count(F.when(F.col("level") == level, 1)) for level in range(1, QUALITY_LEVELS + 1)]
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"),
                                            F.array(*levels).alias("level_rows"))
    wanted = durable(targets(cycle_weights(per_source), max_epochs).withColumnRenamed("source", "source_key"))
    equal_rows = Window.partitionBy("id", "text_hash", "source").orderBy(F.lit(0))
    # 53 random bits -> u in (0, 1)
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id", "text_hash", "source", "copy_no"), 11)
    u = (bits + 0.5) / F.lit(float(1 << 53))
    keyed = (rows.withColumn("copy_no", F.row_number().over(equal_rows))
             .withColumn("es_key", -F.log(u) * QUALITY_LEVELS / F.col("level"))
             .join(F.broadcast(wanted) if wanted.count() <= 10_000 else wanted,
                   F.col("source").eqNullSafe(F.col("source_key")))
             .withColumn("share", _key_share(F.col("es_key"), F.col("level_rows"), F.col("source_rows")))
             .withColumn("cells", F.ceil(F.col("source_rows") / F.lit(cell_rows)))
             .withColumn("cell", F.least(F.col("cells") - 1, F.floor(F.col("share") * F.col("cells"))))
             .withColumn("cell_group", F.floor(F.col("cell") / F.lit(CELLS_A_GROUP))))
    epochs = F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0))
    budget = F.col("target") - F.col("epochs") * F.col("source_size")
    placed = durable(_summed(keyed)
                     .withColumn("epochs", epochs)
                     .withColumn("budget", budget)
                     .withColumn("inside", (F.col("size") > 0) & (F.col("through") <= F.col("budget")))
                     .select("id", "text_hash", "source", "size", "source_size", "target", "copy_no", "epochs",
                             "es_key", "cell", "cell_group", "budget", "inside"))
    placed, left = _filled(placed)
    identity = F.struct("id", "text_hash", "copy_no")
    nearest = F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), "es_key", identity.alias("row"))
    closing = (placed.where("not inside and size > 0").join(left, F.col("source").eqNullSafe(F.col("s3")))
               .where(F.abs(F.col("size") - F.col("gap")) < F.col("gap"))
               .groupBy(F.col("source").alias("s4")).agg(F.min(nearest)["row"].alias("closing")))
    return (placed.join(closing, F.col("source").eqNullSafe(F.col("s4")), "left")
            .withColumn("extra", F.col("inside") | F.coalesce(identity.eqNullSafe(F.col("closing")), F.lit(False)))
            .select("id", "text_hash", "source", "size", "source_size", "target", "copy_no",
                    (F.col("epochs") + F.col("extra").cast("bigint")).alias("copies")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        **options) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the mix takes it, columns unchanged.

    Only ids, hashes and copy numbers are shuffled to decide; the texts move
    once, to meet their number of copies.
    """
    taken = docs.columns
    names = {n: fresh(taken, n) for n in ("mix_id", "mix_hash", "mix_source", "mix_no", "mix_copies", "mix_copy", "mix_row")}
    chosen = (sample(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
              .where("copies > 0")
              .select(F.col("id").alias(names["mix_id"]), F.col("text_hash").alias(names["mix_hash"]),
                      F.col("source").alias(names["mix_source"]), F.col("copy_no").alias(names["mix_no"]),
                      F.col("copies").alias(names["mix_copies"])))
    ident, source = F.col(f"`{id_col}`"), F.col(f"`{source_col}`")
    hashed = F.xxhash64(F.col(f"`{text_col}`"))
    row_hash = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in taken])
    numbered = docs.withColumn(names["mix_row"], F.row_number().over(
        Window.partitionBy(ident, hashed, source).orderBy(row_hash)))
    return (numbered.join(chosen, ident.eqNullSafe(F.col(names["mix_id"])) & (hashed == F.col(names["mix_hash"]))
                          & source.eqNullSafe(F.col(names["mix_source"]))
                          & (F.col(names["mix_row"]) == F.col(names["mix_no"])))
            .withColumn(names["mix_copy"], F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(names["mix_copies"]))))
            .select(*[F.col(f"`{c}`") for c in taken]))
