from barlake.operators.compaction import compact_months
from barlake.operators.landing import create_landing_table, land_archives, land_raw, scan_landed
from barlake.operators.upsert import MergeResult, merge, merge_actions, merge_into
from barlake.operators.months import loaded_months, month_exists, month_range, month_status
from barlake.operators.table import append_bars, create_bar_table, sorted_by_month, with_month

__all__ = [
    "MergeResult", "append_bars", "compact_months", "create_bar_table", "create_landing_table", "land_archives",
    "land_raw", "loaded_months", "merge", "merge_actions", "merge_into", "month_exists",
    "month_range", "month_status", "scan_landed", "sorted_by_month", "with_month",
]
