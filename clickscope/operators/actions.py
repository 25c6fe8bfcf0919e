"""Base action set: enrichment joins plus the optional-conjunct condition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.conditions import Condition, conjunction
from clickscope.sources.tables import ModelTables

# Output order of the enriched action rows (the model's column order).
ACTION_COLUMNS = [
    "date", "user_id", "user_name", "professional", "session_id", "page_id", "action_time",
    "search_keyword", "click_category_id", "click_product_id", "product_name",
    "order_category_ids", "order_product_ids", "pay_category_ids", "pay_product_ids", "city_id",
]
PLACEHOLDERS = ("user_name", "professional", "product_name")
ENRICHMENT = ("professional", "user_name", "product_name")
TIE = "action_id"
HOT_USERS = 1_000          # most users whose rows are broadcast
HOT_USER_ROWS = 1_000_000  # actions that make a user worth it


def tie_columns(df: DataFrame) -> list[str]:
    """Ordering tie-break after ``action_time``: the unique action id if present."""
    return [TIE] if TIE in df.columns else []


def attach_product_name(actions: DataFrame, products: DataFrame) -> DataFrame:
    """Left-join the clicked product's name; non-click rows get NULL.

    Non-click rows carry the sentinel -1 and are usually the largest group of
    all, so a plain equi-join would send all of them to a single reducer. Here
    each gets a negative key of its own row hash, which no product id equals,
    so a shuffled join deals them over every partition.
    """
    spread_cols = [c for c in ("session_id", "action_time", "page_id", TIE) if c in actions.columns]
    own = F.lit(-1) - F.pmod(F.xxhash64(*spread_cols), F.lit(1 << 31))
    left = actions.withColumn("_pk", F.when(F.col("click_product_id") > 0, F.col("click_product_id")).otherwise(own))
    right = products.select(F.col("product_id").alias("_pk"), "product_name").filter(F.col("_pk") > 0)
    return left.join(right, "_pk", "left").drop("_pk")


def hot_users(actions: DataFrame, min_rows: int = HOT_USER_ROWS, most: int = HOT_USERS) -> DataFrame:
    """(user_id) of the users with the most actions, at most ``most`` of them and each with over ``min_rows``.

    Counted with map-side combine. A user who is not among them has less than
    1 / ``most`` of the log's rows.
    """
    return (actions.where("user_id is not null").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > min_rows).orderBy(F.desc("n"), "user_id").limit(most).select("user_id"))


def join_users(actions: DataFrame, users: DataFrame, columns: dict[str, str], hot: DataFrame | None = None) -> DataFrame:
    """Actions of known users, with the user ``columns`` (name in ``users`` -> new name).

    Without ``hot``, one plain join (a semi-join if no column is wanted), which
    Spark broadcasts where the measured size of ``users`` allows. With ``hot``
    (see ``hot_users``), for user tables too large to broadcast: the few hot
    users' own rows are broadcast and answer for their actions, and in the
    shuffled join for all others those actions get a key of their own row
    hash, which no user has. So one user's actions, however many, are spread
    over all tasks, whatever adaptive execution does, and the log is read once.
    """
    wanted = [F.col(c).alias(name) for c, name in columns.items()]
    if hot is None:
        if not columns:
            return actions.join(users.select("user_id"), "user_id", "left_semi")
        return actions.join(users.select("user_id", *wanted), "user_id", "inner")
    few = hot.select("user_id").join(users.select("user_id", F.lit(True).alias("_known"), *wanted), "user_id", "left")
    few = few.select(F.col("user_id").alias("_hot_user"), F.col("_known").alias("_hot_known"),
                     *[F.col(name).alias(f"_hot_{name}") for name in columns.values()])
    marked = actions.join(F.broadcast(few), F.col("user_id") == F.col("_hot_user"), "left")
    is_hot = F.col("_hot_user").isNotNull()
    # one key of two parts: as two keys, the optimizer would fold the users' constant part away
    part = F.when(is_hot, 1 + F.pmod(F.xxhash64(*actions.columns), F.lit(1 << 31))).otherwise(F.lit(0))
    marked = marked.withColumn("_key", F.struct(F.col("user_id").alias("user"), part.alias("part")))
    rest = users.select(F.struct(F.col("user_id").alias("user"), F.lit(0).cast("bigint").alias("part")).alias("_user_key"),
                        F.lit(True).alias("_is_known"), *[F.col(c).alias(f"_own_{name}") for c, name in columns.items()])
    joined = marked.join(rest, F.col("_key") == F.col("_user_key"), "left")
    told = [F.when(is_hot, F.col(f"_hot_{name}")).otherwise(F.col(f"_own_{name}")).alias(name) for name in columns.values()]
    return joined.where(F.coalesce("_hot_known", "_is_known", F.lit(False))).select(*actions.columns, *told)


def base_actions(tables: ModelTables, condition: Condition | None = None,
                 enrich: tuple[str, ...] = ENRICHMENT, keep_tie: bool = True, hot: DataFrame | None = None) -> DataFrame:
    """Actions of known users, enriched with profession, user name, product name.

    Unknown users are dropped; condition fields on users (age, profession,
    gender) filter the user side before the join, fields on actions (date,
    city, keyword, category) filter the scan. ``enrich`` names the enrichment
    columns the caller needs: without user columns the user join is a
    semi-join (keys only, no fan-out), without ``product_name`` the product
    join is skipped. Catalyst cannot drop an unused outer join by itself
    because it does not know the dimension keys are unique. ``hot`` names hot
    users for a join that one of them cannot skew (see ``join_users``).
    """
    cond = condition or Condition()
    acts = tables.actions.drop(*PLACEHOLDERS)
    action_preds = cond.action_predicates(acts.columns)
    if action_preds:
        acts = acts.filter(conjunction(action_preds))
    users = tables.users
    user_preds = cond.user_predicates()
    if user_preds:
        users = users.filter(conjunction(user_preds))
    user_cols = {"professional": "professional"} if "professional" in enrich else {}
    if "user_name" in enrich:
        user_cols["username"] = "user_name"
    joined = join_users(acts, users, user_cols, hot)
    if "product_name" in enrich:
        joined = attach_product_name(joined, tables.products)
    columns = [c for c in ACTION_COLUMNS if c not in PLACEHOLDERS or c in enrich]
    extra = tie_columns(joined) if keep_tie else []
    return joined.select(*columns, *extra)
