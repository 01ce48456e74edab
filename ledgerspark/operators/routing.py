"""Rule tagging, valid/dead-letter routing and rejection metrics.

Every metric is a conditional aggregate over the tagged rows, so a batch comparison is one
pass with a partial (map-side) aggregate per batch, whatever the skew across batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import Rule, reasons
from ..sources.schemas import REASON_COL


def tag(df: DataFrame, rules: Sequence[Rule], sep: str = "; ", out: str = REASON_COL) -> DataFrame:
    """Add the names of every rule a row breaks (declared order, ``sep``-joined; '' if none)."""
    return df.withColumn(out, reasons(rules, sep))


def failing(df: DataFrame, rule: Rule) -> DataFrame:
    """Rows that break one rule (a NULL condition does not fire)."""
    return df.filter(F.coalesce(rule.condition(), F.lit(False)))


def route(tagged: DataFrame, out: str = REASON_COL) -> tuple[DataFrame, DataFrame]:
    """(valid without the reason column, dead letter with it). Together they hold every row."""
    valid = tagged.filter(F.col(out) == "").drop(out)
    dead = tagged.filter(F.col(out) != "")
    return valid, dead


def rejection_rate(dead: Column, total: Column) -> Column:
    """dead / total * 100, 0.0 for an empty batch."""
    return F.when(total == 0, F.lit(0.0)).otherwise(dead.cast("double") / total.cast("double") * F.lit(100.0))


def metrics(tagged: DataFrame, by: str | Sequence[str] | None = None, out: str = REASON_COL) -> DataFrame:
    """total, valid, dead and rejection_rate, overall or per ``by`` group, in one pass."""
    aggs = [F.count(F.lit(1)).alias("total"),
            F.count_if(F.col(out) == "").alias("valid"),
            F.count_if(F.col(out) != "").alias("dead")]
    if by is None:
        res = tagged.agg(*aggs)
    else:
        res = tagged.groupBy(*([by] if isinstance(by, str) else by)).agg(*aggs)
    return res.withColumn("rejection_rate", rejection_rate(F.col("dead"), F.col("total")))


def of_delivery(tagged: DataFrame, ids: DataFrame, key: str = "transaction_id") -> DataFrame:
    """The tagged rows whose key a delivery holds: one semi join over both routes. A NULL key never
    matches, so NULL-key rejects are not attributed to a delivery."""
    return tagged.join(ids.select(key), key, "left_semi")


def batch_metrics(tagged: DataFrame, ids: DataFrame, key: str = "transaction_id", out: str = REASON_COL) -> DataFrame:
    """Metrics of one delivery by its ids."""
    return metrics(of_delivery(tagged.select(key, out), ids, key), out=out)


def compare_deliveries(tagged: DataFrame, ids: DataFrame, label: str, key: str = "transaction_id",
                       out: str = REASON_COL) -> DataFrame:
    """Metrics of several deliveries by their landing ids (``ids``: key and ``label``). A record
    sent in two deliveries counts in both, whichever copy was kept; within one it counts once."""
    sent = ids.select(key, label).filter(F.col(key).isNotNull()).distinct()
    return metrics(tagged.select(key, out).join(sent, key), label, out)


def failed_rules(df: DataFrame, rules: Sequence[Rule], out: str = "failed_rules") -> DataFrame:
    """Add the number of rules a row breaks."""
    hits = [F.coalesce(r.condition(), F.lit(False)).cast("int") for r in rules]
    return df.withColumn(out, sum(hits, F.lit(0)))


def reason_breakdown(dead: DataFrame, out: str = REASON_COL) -> DataFrame:
    return dead.groupBy(out).agg(F.count(F.lit(1)).alias("row_count"))
