"""Chat formatting of reply trees.

Messages name their parent. Root-to-leaf paths are found by iterative
self-joins on ids alone: table k holds every message's ancestor 2^k steps up,
each table is the last one joined with itself, and a leaf reaches each of its
ancestors exactly once by adding the powers of two of its distance, largest
first. A path of n messages takes about 2 log2(n) joins, all keyed by single
messages, so long threads are no single task's load. The same tables carry the
scores' sums, so a leaf's mean score is known from as many joins with one row a
leaf. Branches are ranked by it, and only the messages of chosen branches are
written out, each branch as one conversation.

Template, one piece per message::

    ### {role}: {text}</turn>\\n

Inside roles and texts a backslash, ``###`` and ``</turn>`` are escaped with
backslashes (in roles a colon too), so that no text can fake a turn and every
text comes back unchanged. The loss mask is a list of spans over the formatted
string that cover the texts of the trained role.

Everything is DataFrame functions. The formatted conversation itself is one
string and so one row, which is the feature; its turns are gathered in one
task, bounded by the 2 GB that a row can hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickscope.llm.common import durable, written

END = "</turn>"
LEARNED_ROLE = "assistant"
MAX_ROUNDS = 40  # threads of up to 2^40 messages
_HEADER = r"(?s)^### ((?:[^:\\]++|\\.)*+): "


def escape(text: Column) -> Column:
    """Reversible; the result holds neither ``###`` nor ``</turn>``. Null: empty."""
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("###"), F.lit("\\#\\#\\#"))
    return F.replace(out, F.lit(END), F.lit("<\\/turn>"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def linear_messages(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text") -> DataFrame:
    """Turn-ordered rows as a tree without branches: each message answers the one before it.

    Rows that repeat a turn keep their place by role, then text; a null turn
    comes first; a null conversation id is a conversation of its own.
    """
    rows = turns.select(*[F.col(f"`{c}`").alias(n) for c, n in ((conv, "conv"), (turn, "turn"), (role, "role"), (text, "text"))])
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(),
                                               F.col("text").asc_nulls_first())
    return (rows.withColumn("msg", F.row_number().over(order).cast("bigint"))
            .select("conv", "msg", F.when(F.col("msg") > 1, F.col("msg") - 1).alias("parent"), "role", "text",
                    F.lit(0.0).alias("score")))


def _same(a: str, b: str, c: str, d: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b)) & (F.col(c) == F.col(d))


def ancestors(messages: DataFrame) -> list[DataFrame]:
    """Tables k = 0, 1, ...: (conv, msg, above, total) for every message with an ancestor 2^k steps up.

    ``above`` is that ancestor, ``total`` the sum of the scores from the
    message on, up to but without it. ``messages`` has (conv, msg, parent,
    score) with ``msg`` unique in its conversation; a parent that is missing
    makes its child a root. A reply cycle raises.
    """
    known = messages.select(F.col("conv").alias("c"), F.col("msg").alias("m"))
    up = durable(messages.where("parent is not null").join(known, _same("conv", "c", "parent", "m"), "left_semi")
                 .select("conv", "msg", F.col("parent").alias("above"), F.coalesce("score", F.lit(0.0)).alias("total")))
    tables = []
    while not up.isEmpty():
        if len(tables) == MAX_ROUNDS:
            raise ValueError("the replies contain a cycle")
        tables.append(up)
        higher = up.select(F.col("conv").alias("c"), F.col("msg").alias("m"), F.col("above").alias("a"), F.col("total").alias("t"))
        up = durable(up.join(higher, _same("conv", "c", "above", "m"))
                     .select("conv", "msg", F.col("a").alias("above"), (F.col("total") + F.col("t")).alias("total")))
        if len(tables) >= 2 and tables[-1].count() == up.count() > 0:
            raise ValueError("the replies contain a cycle")  # on a tree every table is smaller than the last
    return tables


def _leaves(messages: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """(conv, leaf) of the messages that nobody answered."""
    every = messages.select("conv", F.col("msg").alias("leaf"))
    if not tables:
        return every
    answered = tables[0].select(F.col("conv").alias("c"), F.col("above").alias("m")).distinct()
    return every.join(answered, _same("conv", "c", "leaf", "m"), "left_anti")


def branch_scores(messages: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """(conv, leaf, score) for every branch: the mean of its messages' scores, one row a leaf on the way."""
    at = _leaves(messages, tables).select("conv", "leaf", F.col("leaf").alias("msg"), F.lit(0.0).alias("total"), F.lit(1).cast("bigint").alias("n"))
    for k in range(len(tables) - 1, -1, -1):
        step = tables[k].select(F.col("conv").alias("c"), F.col("msg").alias("m"), "above", F.col("total").alias("t"))
        jumped = F.col("m").isNotNull()
        at = (at.join(step, _same("conv", "c", "msg", "m"), "left")
              .select("conv", "leaf", F.coalesce("above", "msg").alias("msg"), (F.col("total") + F.coalesce("t", F.lit(0.0))).alias("total"),
                      (F.col("n") + F.when(jumped, 1 << k).otherwise(0)).alias("n")))
    own = messages.select(F.col("conv").alias("c"), F.col("msg").alias("m"), F.coalesce("score", F.lit(0.0)).alias("t"))
    return at.join(own, _same("conv", "c", "msg", "m")).select("conv", "leaf", ((F.col("total") + F.col("t")) / F.col("n")).alias("score"))


def paths(leaves: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """(conv, leaf, msg, up) for every message from the root to each of ``leaves`` (conv, leaf); ``up`` counts from the leaf."""
    reached = leaves.select("conv", "leaf", F.col("leaf").alias("msg"), F.lit(0).cast("bigint").alias("up"))
    for k in range(len(tables) - 1, -1, -1):
        step = tables[k].select(F.col("conv").alias("c"), F.col("msg").alias("m"), "above")
        further = (reached.join(step, _same("conv", "c", "msg", "m"))
                   .select("conv", "leaf", F.col("above").alias("msg"), (F.col("up") + (1 << k)).alias("up")))
        reached = durable(reached.unionByName(further))
    return reached


def format_conversations(messages: DataFrame, branches: int | None = None, learned: str = LEARNED_ROLE) -> DataFrame:
    """(conv, leaf, branch, score, n_turns, formatted, loss_spans), one row per chosen path.

    ``messages`` has (conv, msg, parent, role, text, score). A branch's score
    is the mean of its messages' scores (null: 0); the ``branches`` best per
    conversation are kept (None: all), ties by the smaller leaf.
    ``loss_spans`` are (start, length) in code points of ``formatted``, from 0.
    Null roles and texts count as empty. An empty table gives an empty result.
    """
    messages = written(messages.select("conv", "msg", "parent", "role", "text", "score"), "chat-messages")
    tables = ancestors(messages)
    order = Window.partitionBy("conv").orderBy(F.col("score").desc(), "leaf")
    ranked = branch_scores(messages, tables).withColumn("branch", F.row_number().over(order))
    if branches is not None:
        ranked = ranked.where(F.col("branch") <= F.lit(branches))
    ranked = durable(ranked)
    named = ranked.select(F.col("conv").alias("rc"), F.col("leaf").alias("rl"), "branch", F.col("score").alias("path_score"))
    chosen = paths(ranked, tables).join(named, _same("conv", "rc", "leaf", "rl")).drop("rc", "rl")
    texts = messages.select(F.col("conv").alias("c"), F.col("msg").alias("m"), "role", "text")
    role = F.replace(escape(F.col("role")), F.lit(":"), F.lit("\\:"))
    turns = (chosen.join(texts, _same("conv", "c", "msg", "m"))
             .withColumn("header", F.concat(F.lit("### "), role, F.lit(": ")))
             .withColumn("body", escape(F.col("text")))
             .withColumn("piece", F.concat("header", "body", F.lit(END + "\n"))))
    before = (Window.partitionBy("conv", "leaf").orderBy(F.col("up").desc())
              .rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(F.sum(F.length("piece").cast("bigint")).over(before), F.lit(0)) + F.length("header")
    turns = turns.withColumn("span", F.when(F.col("role") == learned, F.struct(
        start.alias("start"), F.length("body").cast("bigint").alias("length"))))
    whole = turns.groupBy("conv", "leaf").agg(
        F.first("branch").alias("branch"), F.first("path_score").alias("score"), F.count(F.lit(1)).alias("n_turns"),
        F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "piece"))).alias("pieces"),
        F.sort_array(F.collect_list("span")).alias("loss_spans"))
    return whole.select("conv", "leaf", "branch", "score", "n_turns",
                        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"), "loss_spans")


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    pieces = F.split(formatted, END + "\n")
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)  # behind the last mark stands nothing

    def turn(piece: Column) -> Column:
        header = F.regexp_extract(piece, _HEADER, 0)
        return F.struct(unescape(F.regexp_extract(piece, _HEADER, 1)).alias("role"),
                        unescape(F.substring(piece, F.length(header) + 1, F.length(piece))).alias("text"))

    return F.transform(turns, turn)


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    part = lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    return F.array_join(F.transform(spans, part), "")
