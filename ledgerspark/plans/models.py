"""Staging models and the daily mart.

Staging is a thin projection (renames and casts, no logic) and stays lazy: a temp view or a
DataFrame the next plan inlines. The mart is one grouped aggregate with partial
aggregation per date, so its shuffle carries one row per (task, date).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import half_up_ratio
from ..operators.scd2 import CUR
from ..sources.schemas import HIGH_VALUE_THRESHOLD

MONEY = "decimal(18,2)"


def stg_transactions(silver: DataFrame) -> DataFrame:
    return silver.select(
        "transaction_id", "account_id", "customer_name", "ssn_last4",
        F.col("amount").cast(MONEY).alias("amount"), "currency", "transaction_type",
        F.col("event_timestamp").alias("transacted_at"), F.col("ingestion_timestamp").alias("ingested_at"))


def stg_accounts(history: DataFrame) -> DataFrame:
    return history.select(
        "account_id", "account_status", F.col("credit_limit").cast(MONEY).alias("credit_limit"),
        F.col("valid_from").cast("date").alias("valid_from"), F.col("valid_to").cast("date").alias("valid_to"),
        CUR)


def stg_accounts_current(stg_acc: DataFrame) -> DataFrame:
    return stg_acc.filter(F.col(CUR)).select("account_id", "account_status", "credit_limit", "valid_from", "valid_to")


def daily_parts(stg: DataFrame, threshold: float = HIGH_VALUE_THRESHOLD) -> DataFrame:
    """Counts and sums per calendar date; those of two sets of rows add up."""
    high = F.col("amount") > F.lit(threshold)
    return (stg.groupBy(F.to_date("transacted_at").alias("transaction_date"))
            .agg(F.count(F.lit(1)).alias("transaction_count"),
                 F.sum("amount").alias("_sum"),
                 F.count("amount").alias("_n"),
                 F.count_if(high).alias("high_value_count")))


def daily_measures(parts: DataFrame, *extra: str) -> DataFrame:
    """The mart's columns from ``daily_parts``."""
    return parts.select(
        "transaction_date", "transaction_count",
        F.round("_sum", 2).alias("total_amount"),
        half_up_ratio(F.col("_sum"), F.nullif("_n", F.lit(0)), 2).alias("avg_amount"),
        "high_value_count",
        half_up_ratio(F.col("high_value_count"), F.nullif("transaction_count", F.lit(0)), 2, factor=100).alias("high_value_pct"), *extra)


def daily_mart(stg: DataFrame, threshold: float = HIGH_VALUE_THRESHOLD) -> DataFrame:
    """One row per calendar date: count, total, average, rows strictly above ``threshold`` and
    their share in percent. Money stays decimal; averages and shares are rounded half-up
    exactly (integer arithmetic), not through a double."""
    return daily_measures(daily_parts(stg, threshold))


def mart_totals(mart: DataFrame) -> DataFrame:
    """Dashboard measures over the mart: totals and the date range it covers."""
    return mart.agg(
        F.count(F.lit(1)).alias("n_days"),
        F.sum("transaction_count").alias("transaction_count"),
        F.sum("total_amount").alias("total_amount"),
        F.sum("high_value_count").alias("high_value_count"),
        F.max("transaction_count").alias("busiest_day_count"),
        F.min("transaction_date").alias("first_date"),
        F.max("transaction_date").alias("last_date"))


def register_models(spark: SparkSession, silver: DataFrame, history: DataFrame, prefix: str = "") -> dict[str, DataFrame]:
    """Staging as temp views (lazy), the mart as a DataFrame ready to be written as a table."""
    stg = stg_transactions(silver)
    acc = stg_accounts(history)
    cur = stg_accounts_current(acc)
    views = {"stg_transactions": stg, "stg_accounts": acc, "stg_accounts_current": cur}
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    views["fct_transactions_daily"] = daily_mart(stg)
    return views
