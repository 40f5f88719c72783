from tidemark.operators.history import (
    closed_rows,
    current_rows,
    last_values,
    latest_by_key,
    value_changes,
)
from tidemark.operators.intervals import close_open_intervals, overlap_join, point_in_interval_join
from tidemark.operators.quality import (
    cast_failures,
    cast_to,
    clean,
    dedup,
    duplicate_keys,
    inverted_intervals,
    null_counts,
    profile,
    type_diff,
)
from tidemark.operators.skew import heavy_keys, heavy_slots

__all__ = [
    "cast_failures",
    "cast_to",
    "clean",
    "close_open_intervals",
    "closed_rows",
    "current_rows",
    "dedup",
    "duplicate_keys",
    "heavy_keys",
    "heavy_slots",
    "inverted_intervals",
    "last_values",
    "latest_by_key",
    "null_counts",
    "overlap_join",
    "point_in_interval_join",
    "profile",
    "type_diff",
    "value_changes",
]
