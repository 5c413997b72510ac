"""DataFrame-to-DataFrame operators.  All of them are lazy unless they say otherwise."""

from .aggregate import (
    DAILY_CATEGORY_MART,
    CountDistinct,
    Lookup,
    MartSpec,
    Money,
    Ratio,
    Sum,
    build_mart,
    with_derived,
)
from .checks import (
    CheckPlan,
    CheckResult,
    BatchRejected,
    Reference,
    audit,
    collect_results,
    column_checks,
    gate,
    reference_check,
    running_baseline,
    scan_counts,
    volume_check,
    volume_verdict,
)
from .cursor import batch_high, high_mark, not_known, rows_after
from .days import affected_days, current_rows, days_of_some_keys, rows_on_days, touched_days
from .dimension import days_of_keys, dimension_changes
from .latest import latest_per_key
from .lookup import lookup, one_row_per_key, orphan_keys
from .validate import FAILED_RULES, is_rejected, parse_time, rejected_rows, valid_rows

__all__ = [
    "CheckPlan",
    "CheckResult",
    "CountDistinct",
    "DAILY_CATEGORY_MART",
    "BatchRejected",
    "FAILED_RULES",
    "Lookup",
    "MartSpec",
    "Money",
    "Ratio",
    "Reference",
    "Sum",
    "affected_days",
    "audit",
    "batch_high",
    "build_mart",
    "collect_results",
    "column_checks",
    "current_rows",
    "days_of_keys",
    "days_of_some_keys",
    "dimension_changes",
    "gate",
    "high_mark",
    "is_rejected",
    "latest_per_key",
    "lookup",
    "not_known",
    "one_row_per_key",
    "orphan_keys",
    "parse_time",
    "reference_check",
    "rejected_rows",
    "rows_after",
    "rows_on_days",
    "running_baseline",
    "scan_counts",
    "touched_days",
    "valid_rows",
    "volume_check",
    "volume_verdict",
    "with_derived",
]
