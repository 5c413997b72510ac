"""Column expressions.  Nothing here starts a Spark job."""

from .money import (
    amount,
    cents_parts,
    cents_total,
    exact_ratio,
    from_cents,
    is_finite,
    rounded,
)
from .names import free_names
from .timestamps import event_time, parsed_type, time_literal, time_text, time_type

__all__ = [
    "amount",
    "cents_parts",
    "cents_total",
    "event_time",
    "exact_ratio",
    "free_names",
    "from_cents",
    "is_finite",
    "parsed_type",
    "rounded",
    "time_literal",
    "time_text",
    "time_type",
]
