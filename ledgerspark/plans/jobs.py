"""Durable jobs: each reads stored tables, runs the operators and writes its result.

Lineage is cut at every write (the next job reads files), so a failed job reruns alone and
a retried task never recomputes earlier jobs. The caller names the lake's root: tables of record
do not belong into a checkpoint folder that may be cleaned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.masking import TRANSACTION_MASK, mask
from ..functions.rules import transaction_rules
from ..operators import checks as C
from ..operators import scd2, temporal
from ..operators.dedup import dedup_latest
from ..operators.routing import batch_metrics, tag
from ..sources import sinks
from ..sources.ingest import read_batch, read_keys, split_unparsed
from ..sources.schemas import ACCOUNT_STATE_SCHEMA, BATCH_COL, REASON_COL, TRANSACTION_SCHEMA
from . import models


#: Reason of a record that could not be read as declared.
UNPARSED = "record_unparsed"


@dataclass
class Layout:
    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/transactions"

    @property
    def unparsed(self) -> str:
        return f"{self.root}/bronze/transactions_unparsed"

    @property
    def routes(self) -> str:
        return f"{self.root}/silver/transactions_routed"

    @property
    def history(self) -> str:
        return f"{self.root}/gold/account_history"

    @property
    def change_log(self) -> str:
        return f"{self.root}/gold/account_history_log"

    @property
    def outcomes(self) -> str:
        return f"{self.root}/gold/account_outcomes"

    @property
    def mart(self) -> str:
        return f"{self.root}/marts/fct_transactions_daily"


def ingest_batch(spark: SparkSession, layout: Layout, path: str, batch_id: int, fmt: str = "csv", header: bool = True) -> None:
    """Read one delivery with the declared schema, mask PII, append to bronze (by batch). Records
    that do not parse go to a table of their own, with their text as it came. That text is not
    masked, so the table is apart from bronze and its readers can be chosen apart."""
    raw = read_batch(spark, path, TRANSACTION_SCHEMA, fmt, batch_id=batch_id, header=header, keep_text=True)
    parsed, unparsed = split_unparsed(mask(raw, TRANSACTION_MASK))
    sinks.replace_partition(parsed, layout.bronze, BATCH_COL, batch_id)
    sinks.replace_partition(unparsed, layout.unparsed, BATCH_COL, batch_id)


def refresh_silver(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """Full recompute of silver from bronze: keep-latest, tag, one routed write."""
    bronze = spark.read.parquet(layout.bronze)
    deduped = dedup_latest(bronze, "transaction_id", "ingestion_timestamp")
    return sinks.write_routes(tag(deduped, transaction_rules()), layout.routes)


def silver(spark: SparkSession, layout: Layout) -> DataFrame:
    return sinks.read_route(spark, layout.routes, "valid")


def dead_letter(spark: SparkSession, layout: Layout) -> DataFrame:
    return sinks.read_route(spark, layout.routes, "dead_letter")


def dead_letter_with_text(spark: SparkSession, layout: Layout) -> DataFrame:
    """The dead letter and, with the reason ``UNPARSED`` and their text, the records that did not
    parse. These were never deduplicated: a broken record has no sure key."""
    unparsed = spark.read.parquet(layout.unparsed).withColumn(REASON_COL, F.lit(UNPARSED))
    return dead_letter(spark, layout).unionByName(unparsed, allowMissingColumns=True)


def delivery_metrics(spark: SparkSession, layout: Layout, landing_path: str, fmt: str = "csv") -> DataFrame:
    """Rejection metrics of one delivery: its ids (key-only scan of the landing file) against
    the stored routes, one semi join over both routes."""
    routed = spark.read.parquet(layout.routes)
    return batch_metrics(routed, read_keys(spark, landing_path, "transaction_id", fmt))


def load_initial_history(spark: SparkSession, layout: Layout, path: str, fmt: str = "csv") -> None:
    states = read_batch(spark, path, ACCOUNT_STATE_SCHEMA, fmt)
    hist = scd2.initial_history(states)
    sinks.write_version(hist, layout.history, 0)
    sinks.replace_partition(temporal.start_log(spark.read.parquet(sinks.version_path(layout.history, 0))),
                            layout.change_log, temporal.VERSION, 0)


def history(spark: SparkSession, layout: Layout, version: int) -> DataFrame:
    df = spark.read.parquet(sinks.version_path(layout.history, version))
    return df.drop(*scd2.FLAGS)


def apply_account_batch(spark: SparkSession, layout: Layout, batch: DataFrame, version: int,
                        mode: str = "strict", on_ambiguous: str = "skip", order_col: str | None = None) -> DataFrame:
    """Merge a batch into history version ``version - 1``; write version ``version``, its outcomes
    and its part of the change log. Returns the outcomes, read back from storage."""
    res = scd2.merge(history(spark, layout, version - 1), batch, mode=mode, on_ambiguous=on_ambiguous, order_col=order_col)
    # one merge job writes the version with a written-row flag; the change log is read back
    # from it (no second merge, no diff of two versions)
    new_path = sinks.write_version(res.flagged, layout.history, version)
    changes = spark.read.parquet(new_path).filter(scd2.WRITTEN).drop(*scd2.FLAGS)
    sinks.replace_partition(changes.withColumn(temporal.OPERATION, F.lit("MERGE")), layout.change_log, temporal.VERSION, version)
    return spark.read.parquet(sinks.write_version(res.outcomes, layout.outcomes, version))


def build_mart(spark: SparkSession, layout: Layout, threshold: float = 10000) -> None:
    stg = models.stg_transactions(silver(spark, layout))
    sinks.overwrite(models.daily_mart(stg, threshold), layout.mart)


def validate_silver(spark: SparkSession, layout: Layout, raise_on_failure: bool = True) -> DataFrame:
    result = C.run_suite(silver(spark, layout), C.transaction_expectations())
    if raise_on_failure:
        C.enforce(result)
    return result
