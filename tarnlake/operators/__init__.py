from tarnlake.operators.audit import audit_database, audit_lake, audit_tables
from tarnlake.operators.collections import replace_collections
from tarnlake.operators.gold import (
    customer_line_totals,
    customer_line_totals_by_key,
    monthly_product_count,
    monthly_product_count_by_key,
    purchase_value,
    purchase_value_as_loaded,
    quarter_quantities_by_product,
    quarter_quantities_by_product_key,
)
from tarnlake.operators.preview import preview, top
from tarnlake.operators.roles import Role, enrich, require_unique
from tarnlake.operators.skew import HotKeys, find_hot_keys, join_counted, salted_join
from tarnlake.operators.tables import create_gold, stage_dim, write_dim
from tarnlake.operators.versions import at_least, keeps_columns, not_shrunk, publish_all, roll_back, unique_key

__all__ = [
    "at_least",
    "keeps_columns",
    "not_shrunk",
    "publish_all",
    "roll_back",
    "stage_dim",
    "unique_key",
    "HotKeys",
    "Role",
    "audit_database",
    "audit_lake",
    "audit_tables",
    "create_gold",
    "customer_line_totals",
    "customer_line_totals_by_key",
    "enrich",
    "find_hot_keys",
    "join_counted",
    "monthly_product_count",
    "monthly_product_count_by_key",
    "preview",
    "purchase_value",
    "purchase_value_as_loaded",
    "quarter_quantities_by_product",
    "quarter_quantities_by_product_key",
    "replace_collections",
    "require_unique",
    "salted_join",
    "top",
    "write_dim",
]
