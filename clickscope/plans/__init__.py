"""Named, parameterised query plans over the fixture tables, plus their SQL oracles."""

from clickscope.plans.catalog import QUERIES, RUN_ID, flagship
from clickscope.plans.oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES", "RUN_ID", "flagship"]
