"""Audit queries: ingestion lag, version comparison, batch quality comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_up_ratio, seconds_between
from ..operators.routing import metrics
from ..operators.temporal import as_of_version
from ..sources.schemas import BATCH_COL, LATE_INGESTION_SECONDS


def ingestion_lag(silver: DataFrame, min_seconds: int = LATE_INGESTION_SECONDS) -> DataFrame:
    """Rows ingested more than ``min_seconds`` after the event, lag in hours (2 places), by
    lag descending then id (a deterministic order)."""
    lag = seconds_between("event_timestamp", "ingestion_timestamp")
    return (silver.select("transaction_id", "account_id", "event_timestamp", "ingestion_timestamp",
                          lag.alias("_lag"))
            .filter(F.col("_lag") > min_seconds)
            .withColumn("lag_hours", half_up_ratio(F.col("_lag"), F.lit(3600), 2))
            .drop("_lag")
            .orderBy(F.col("lag_hours").desc(), "transaction_id"))


def compare_states(old: DataFrame, now: DataFrame) -> DataFrame:
    """Accounts whose recorded state in ``old`` differs from their current row in ``now``."""
    old = old.select("account_id", F.col("credit_limit").alias("credit_limit_at_v0"), F.col("account_status").alias("status_at_v0"))
    now = now.filter(F.col("is_current")).select(
        "account_id", F.col("credit_limit").alias("credit_limit_now"), F.col("account_status").alias("status_now"))
    j = old.join(now, "account_id")
    return (j.filter((F.col("credit_limit_at_v0") != F.col("credit_limit_now"))
                     | (F.col("status_at_v0") != F.col("status_now")))
            .select("account_id", "credit_limit_at_v0", "credit_limit_now", "status_at_v0", "status_now"))


def v0_vs_now(log: DataFrame, version: int = 0) -> DataFrame:
    """The same from a change log alone, which is replayed twice."""
    return compare_states(as_of_version(log, version), as_of_version(log))


def top_accounts(changed: DataFrame, n: int = 10) -> DataFrame:
    return changed.orderBy("account_id").limit(n)


def batch_compare(tagged: DataFrame, by: str = BATCH_COL) -> DataFrame:
    """Rejection metrics of every delivery side by side, one pass."""
    return metrics(tagged, by=by)
