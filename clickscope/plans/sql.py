"""SQL surface for users who prefer ``spark.sql``: the model tables as temp
views, and the report functions as SQL functions over built-ins.

The functions are ``CREATE TEMPORARY FUNCTION ... RETURN`` expressions, which
Spark inlines into the calling query: no Python, and whatever they render is
still a plan that the optimizer sees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickscope.sources.tables import ModelTables

VIEW_NAMES = {
    "actions": "user_visit_action",
    "users": "user_info",
    "products": "product_info",
    "cities": "city_info",
}

_HUNDREDTHS = "(({n} * 20000 + {total}) div ({total} * 2))"


def _percent(n: str, total: str) -> str:
    """SQL text of n / total * 100, rounded HALF_UP to two decimals, as text."""
    h = _HUNDREDTHS.format(n=n, total=total)
    return f"concat({h} div 100, '.', lpad(pmod({h}, 100), 2, '0'))"


# One group, held as g: o its cities in order (most clicks first, then name), t all its clicks.
_GROUP = """named_struct(
    'o', array_sort(transform(cities, c -> named_struct('m', -c.n, 'city', c.city, 'n', c.n))),
    't', aggregate(cities, 0L, (a, c) -> a + c.n))"""
_SHOWN = "array_join(transform({items}, x -> concat(x.city, '=', " + _percent("x.n", "g.t") + ", '%')), ',')"
_REST = ("if(shown IS NULL OR size(g.o) <= shown, '', concat(',other=', "
         + _percent("aggregate(slice(g.o, shown + 1, size(g.o)), 0L, (a, x) -> a + x.n)", "g.t") + ", '%'))")

FUNCTIONS = {
    "percent_text": f"""(n BIGINT, total BIGINT) RETURNS STRING
  COMMENT 'n / total in percent, HALF_UP, two decimals; null for a total of 0'
  RETURN if(total > 0, {_percent("n", "total")}, NULL)""",
    "city_remark": f"""(cities ARRAY<STRUCT<city: STRING, n: BIGINT>>, shown INT DEFAULT NULL) RETURNS STRING
  COMMENT 'city=share% of every city of a group, or of the first so many and other=share%'
  RETURN transform(array({_GROUP}), g -> concat({_SHOWN.format(items="if(shown IS NULL, g.o, slice(g.o, 1, shown))")}, {_REST}))[0]""",
}

# The area report as SQL; {actions}, {cities} and {products} are names of tables or views.
AREA_TOP3_SQL = """
WITH clicks AS (
  SELECT click_product_id, city_id, count(*) AS n FROM {actions} WHERE click_product_id > 0 GROUP BY click_product_id, city_id
), per_city AS (
  SELECT click_product_id, area, city_name, sum(n) AS n FROM clicks JOIN {cities} USING (city_id) GROUP BY click_product_id, area, city_name
), ranked AS (
  SELECT area, click_product_id, sum(n) AS count, collect_list(struct(city_name AS city, n)) AS cities,
         row_number() OVER (PARTITION BY area ORDER BY sum(n) DESC, click_product_id) AS rank
  FROM per_city GROUP BY area, click_product_id
)
SELECT area, product_name, count, rank, city_remark(cities) AS city_remark
FROM ranked JOIN {products} ON click_product_id = product_id
WHERE rank <= 3"""


def register_model_views(tables: ModelTables, prefix: str = "") -> dict[str, str]:
    """Register the four model tables as temp views; returns role -> view name."""
    names = {}
    for role, view in VIEW_NAMES.items():
        name = f"{prefix}{view}"
        getattr(tables, role).createOrReplaceTempView(name)
        names[role] = name
    return names


def register_functions(spark: SparkSession) -> list[str]:
    """Register ``percent_text`` and ``city_remark`` for SQL; returns their names."""
    for name, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(FUNCTIONS)


def area_top3_by_sql(spark: SparkSession, names: dict[str, str]) -> DataFrame:
    """The area report from SQL text, over views (or tables) of the given names."""
    register_functions(spark)
    return spark.sql(AREA_TOP3_SQL.format(**names))
