from barlake.functions.bars import to_bars
from barlake.functions.calendar import (
    month_bounds,
    month_of,
    month_start,
    next_month,
    utc_literal,
    zero_pad,
)
from barlake.functions.paths import archive_name, landed_path, task_id, trim_whitespace

__all__ = [
    "archive_name", "landed_path", "month_bounds", "month_of", "month_start",
    "next_month", "task_id", "to_bars", "trim_whitespace", "utc_literal", "zero_pad",
]
