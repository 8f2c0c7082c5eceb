"""Contract-driven data quality on Spark: validate, quarantine, curate, publish incrementally."""

from .operators.conflicts import find_exact_duplicates
from .operators.curate import conversion_failures, curate
from .operators.metrics import batch_summary, issue_metrics, reconciliation
from .operators.quarantine import quarantine
from .operators.row_numbers import number_rows
from .operators.validate import accepted, issues, validate
from .plans.contract import Roles
from .plans.incremental import multi_batch_summary, pending_batches, skipped_batches
from .plans.inspections import INSPECTIONS
from .plans.run import BatchError, Settings, run_all, run_one, run_totals
from .sources.batches import discover_batches, inspect_batches
from .sources.csv_batches import read_batches
from .sources.publish import publish

__all__ = [
    "INSPECTIONS",
    "BatchError",
    "Roles",
    "Settings",
    "accepted",
    "batch_summary",
    "conversion_failures",
    "curate",
    "discover_batches",
    "find_exact_duplicates",
    "inspect_batches",
    "issue_metrics",
    "issues",
    "multi_batch_summary",
    "number_rows",
    "pending_batches",
    "publish",
    "quarantine",
    "read_batches",
    "reconciliation",
    "run_all",
    "run_one",
    "run_totals",
    "skipped_batches",
    "validate",
]
