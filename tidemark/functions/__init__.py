from tidemark.functions.dates import (
    as_day,
    days_between,
    earlier_of,
    is_open,
    later_of,
    previous_month,
)
from tidemark.functions.values import full_name, rounded_ratio, row_count

__all__ = [
    "as_day",
    "days_between",
    "earlier_of",
    "full_name",
    "is_open",
    "later_of",
    "previous_month",
    "rounded_ratio",
    "row_count",
]
