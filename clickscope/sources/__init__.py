"""Where the four model tables come from and where results go."""

from clickscope.sources.fixtures import (
    city_info_from_nations,
    load_fixture_tables,
    product_info_from_parts,
    user_info_from_customers,
    user_visit_action_from_events,
)
from clickscope.sources.sinks import append_jdbc, overwrite_table, replace_run
from clickscope.sources.tables import (
    ModelTables,
    default_city_info,
    duplicate_keys,
    read_catalog_tables,
    write_catalog_tables,
)

__all__ = [
    "ModelTables", "append_jdbc", "city_info_from_nations", "default_city_info", "duplicate_keys",
    "load_fixture_tables", "overwrite_table", "product_info_from_parts", "read_catalog_tables", "replace_run",
    "user_info_from_customers", "user_visit_action_from_events", "write_catalog_tables",
]
