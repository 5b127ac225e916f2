from barlake.plans.backfill import BackfillResult, backfill_plan, backfill_run, missing_months, not_landed
from barlake.plans.load import MissingRawFile, append_if_missing, load_month, load_raw, load_units

__all__ = [
    "BackfillResult", "MissingRawFile", "append_if_missing", "backfill_plan", "backfill_run",
    "load_month", "load_raw", "load_units", "missing_months", "not_landed",
]
