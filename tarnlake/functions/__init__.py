from tarnlake.functions.dates import (
    date_dimension,
    date_dimension_for,
    date_key,
    day_bounds,
    key_to_date,
)
from tarnlake.functions.lineage import LINEAGE_COLUMNS, with_lineage

__all__ = [
    "LINEAGE_COLUMNS",
    "date_dimension",
    "date_dimension_for",
    "date_key",
    "day_bounds",
    "key_to_date",
    "with_lineage",
]
