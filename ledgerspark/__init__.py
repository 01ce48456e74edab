"""ledgerspark: auditable ledger processing expressed as Spark DataFrame and SQL plans.

Layers: ``sources`` (reads, fixtures, sinks), ``functions`` (column expressions: masking,
rules, rounding), ``operators`` (DataFrame in, DataFrame out: dedup, routing, SCD2, temporal,
snapshot, checks), ``plans`` (models, audit queries, durable jobs, the query catalog) and
``streaming`` (incremental file ingestion). The names below are the main entry points.
"""

from .functions.masking import mask
from .functions.rules import Rule, transaction_rules
from .operators.checks import enforce, failing_rows, run_suite, transaction_contract, transaction_expectations
from .operators.dedup import dedup_latest, dedup_stats
from .operators.routing import batch_metrics, metrics, route, tag
from .operators.scd2 import check_timeline, initial_history, merge, merge_timeline
from .operators.snapshot import snapshot_check
from .operators.temporal import append_changes, as_of_join, as_of_version, start_log, state_on, version_log
from .sources.ingest import read_batch, read_keys

__version__ = "0.1.0"

__all__ = [
    "Rule", "append_changes", "as_of_join", "as_of_version", "batch_metrics", "check_timeline", "dedup_latest",
    "dedup_stats", "enforce", "failing_rows", "initial_history", "mask", "merge", "merge_timeline", "metrics",
    "read_batch", "read_keys", "route", "run_suite", "snapshot_check", "start_log", "state_on", "tag",
    "transaction_contract", "transaction_expectations", "transaction_rules", "version_log",
]
