"""Writing plans: ledger, partitioned publishing and the incremental flow."""

from .flow import RETAIL_CHECKS, Flow, FlowSpec, retail_spec
from .ledger import RunRecord, last_run, read_ledger, stored_cursor, volume_history
from .scratch import scratch_folder, written

__all__ = [
    "Flow",
    "FlowSpec",
    "RETAIL_CHECKS",
    "RunRecord",
    "last_run",
    "read_ledger",
    "retail_spec",
    "scratch_folder",
    "stored_cursor",
    "volume_history",
    "written",
]
