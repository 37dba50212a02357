from ledgerweave.functions.calendar import date_key, date_spine, quarter_columns
from ledgerweave.functions.compare import differs, join_null_safe, same
from ledgerweave.functions.normalize import (
    case_key,
    full_name,
    has_outer_space,
    id_number,
    map_value,
    norm_phone,
    norm_text,
)

__all__ = [
    "case_key",
    "date_key",
    "date_spine",
    "differs",
    "full_name",
    "has_outer_space",
    "id_number",
    "join_null_safe",
    "map_value",
    "norm_phone",
    "norm_text",
    "quarter_columns",
    "same",
]
