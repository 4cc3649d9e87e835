"""Column-level helpers (built-in Spark expressions only, no UDFs)."""

from kpiloom.functions.calendar import (iso_day_of_week, iso_week, month_start, weekend_flag,
                                        weekend_int, year_start)
from kpiloom.functions.metrics import (aac_status, awv_status, loss_status, non_negative, running,
                                       safe_rate, shortfall, target_gap)

__all__ = ["iso_day_of_week", "iso_week", "month_start", "weekend_flag", "weekend_int",
           "year_start", "aac_status", "awv_status", "loss_status", "non_negative", "running",
           "safe_rate", "shortfall", "target_gap"]
