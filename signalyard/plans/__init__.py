"""Plan shapes shared by the operators: hot keys, ordered scans, as-of joins."""

from signalyard.plans.asof import asof_backward, asof_forward
from signalyard.plans.ordered import (
    Ordered,
    next_row,
    next_seen,
    last_seen,
    prev_row,
    running_max,
    running_min,
    running_sum,
    suffix_max,
    suffix_min,
    suffix_sum,
)
from signalyard.plans.skew import hot_keys, lookup

__all__ = [
    "Ordered",
    "asof_backward",
    "asof_forward",
    "hot_keys",
    "last_seen",
    "lookup",
    "next_row",
    "next_seen",
    "prev_row",
    "running_max",
    "running_min",
    "running_sum",
    "suffix_max",
    "suffix_min",
    "suffix_sum",
]
