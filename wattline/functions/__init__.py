"""Column-level building blocks: names, numbers, timestamps."""

from wattline.functions.names import (
    clean_colname, cleaned_headers, positional_headers, simple_rename,
)
from wattline.functions.numeric import (
    int32_overflow, int64_reject, nan_to_null, to_int64, to_number,
)
from wattline.functions.timefmt import (
    calendar_columns, floor_hour, parse_timestamp, reading_timestamp,
)

__all__ = [
    "clean_colname", "cleaned_headers", "positional_headers", "simple_rename",
    "int32_overflow", "int64_reject", "nan_to_null", "to_int64", "to_number",
    "calendar_columns", "floor_hour", "parse_timestamp", "reading_timestamp",
]
