"""Silver and the daily mart, kept up to date delivery by delivery.

* ``rows`` holds the latest copy of every record with its reasons, partitioned by a hash bucket of the
  key. A delivery reads the buckets of its keys only, keeps the latest of old and new copies, and
  replaces these buckets alone. Records with a NULL key are never compared: a delivery's go to a
  partition of their own, so they neither meet in one bucket nor double when it is run again.
* ``deltas`` holds, per delivery and date, how much it added to the mart's counts and sums or took
  away (a date loses a row when a later copy moves it, or breaks a rule). Amounts are decimals, so
  adding deltas is exact. The mart's rows of a date are the sums of its deltas: neither silver nor
  bronze is read for it.
* ``mart`` is partitioned by month, and only months with a delta are replaced.

Everything that depends on the state before a delivery is written aside first (``staged``,
``deltas``), then marked as done; what follows only replaces partitions, with the same result however
often it runs. So a job that dies anywhere can be run again. A delivery whose content changes after
it was marked needs a rebuild into a new root.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import Rule, transaction_rules
from ..operators.dedup import dedup_latest
from ..operators.routing import tag
from ..sources import sinks
from ..sources.schemas import BATCH_COL, HIGH_VALUE_THRESHOLD, REASON_COL, TRANSACTION_KEY
from . import models
from .store import BUCKET, bucket_of, buckets_in

MONTH = "_month"
_PARTS = ("transaction_count", "_sum", "_n", "high_value_count")
_MARK_SCHEMA = f"marked boolean, {BATCH_COL} int"


@dataclass
class SilverStore:
    root: str
    buckets: int = 64
    threshold: float = HIGH_VALUE_THRESHOLD
    key: str = TRANSACTION_KEY
    order_col: str = "ingestion_timestamp"
    rules: Sequence[Rule] | None = None

    def _path(self, part: str) -> str:
        return f"{self.root.rstrip('/')}/{part}"

    @property
    def rows(self) -> str:
        return self._path("rows")

    @property
    def mart(self) -> str:
        return self._path("mart")

    def create(self, like: DataFrame) -> None:
        """Empty tables for deliveries with the columns of ``like`` (``BATCH_COL`` among them)."""
        spark = like.sparkSession
        none = tag(like.limit(0), self._rules()).withColumn(BUCKET, F.lit(0))
        sinks.overwrite(none, self._path("empty"))
        sinks.overwrite(none, self.rows, [BUCKET])
        sinks.overwrite(spark.createDataFrame([(True, -1)], _MARK_SCHEMA).coalesce(1), self._path("marks"), [BATCH_COL])

    def _rules(self) -> Sequence[Rule]:
        return transaction_rules() if self.rules is None else self.rules

    def add(self, delivery: DataFrame, batch: int) -> None:
        """Bring silver and the mart forward by one delivery (masked rows, ``BATCH_COL`` = ``batch``)."""
        spark = delivery.sparkSession
        if not self._marked(spark, batch):
            known = delivery.filter(F.col(self.key).isNotNull())
            touched = buckets_in(known, [self.key], self.buckets)
            old = self._buckets(spark, touched)
            latest = dedup_latest(old.select(*delivery.columns).unionByName(known), self.key, self.order_col, null_keys="collapse")
            new = latest.withColumn(BUCKET, bucket_of([self.key], self.buckets)).unionByName(
                delivery.filter(F.col(self.key).isNull()).withColumn(BUCKET, F.lit(-1 - batch)))
            staged = tag(new, self._rules())
            sinks.overwrite(staged, self._path(f"staged/v={batch}"))
            staged = spark.read.parquet(self._path(f"staged/v={batch}"))
            # NULL keys of this delivery that an earlier run has published are no change.
            nulls = self._buckets(spark, [-1 - batch])
            sinks.replace_partition(self._delta(staged, old.unionByName(nulls)), self._path("deltas"), BATCH_COL, batch)
            sinks.replace_partition(spark.createDataFrame([(True,)], "marked boolean").coalesce(1), self._path("marks"), BATCH_COL, batch)
        sinks.replace_partitions(spark.read.parquet(self._path(f"staged/v={batch}")), self.rows, BUCKET)
        self._refresh_mart(spark, batch)

    def _marked(self, spark: SparkSession, batch: int) -> bool:
        return not spark.read.schema(_MARK_SCHEMA).parquet(self._path("marks")).filter(F.col(BATCH_COL) == batch).isEmpty()

    def _buckets(self, spark: SparkSession, buckets: Sequence[int]) -> DataFrame:
        return self._rows(spark).filter(F.col(BUCKET).isin([int(b) for b in buckets]))

    def _rows(self, spark: SparkSession) -> DataFrame:
        schema = spark.read.parquet(self._path("empty")).schema
        return spark.read.schema(schema).parquet(self.rows)

    def _parts(self, tagged: DataFrame) -> DataFrame:
        return models.daily_parts(models.stg_transactions(tagged.filter(F.col(REASON_COL) == "")), self.threshold)

    def _delta(self, new: DataFrame, old: DataFrame) -> DataFrame:
        less = self._parts(old).select("transaction_date", *[(-F.col(c)).alias(c) for c in _PARTS])
        both = self._parts(new).unionByName(less).groupBy("transaction_date").agg(*[self._sum(c).alias(c) for c in _PARTS])
        moved = F.greatest(*[F.abs(F.coalesce(F.col(c), F.lit(0)).cast("decimal(38,2)")) for c in _PARTS])
        return both.filter(moved > 0)

    @staticmethod
    def _sum(column: str):
        return F.sum(column).cast("decimal(38,2)" if column == "_sum" else "bigint")

    def _refresh_mart(self, spark: SparkSession, batch: int) -> None:
        deltas = spark.read.parquet(self._path("deltas")).withColumn(MONTH, F.date_format("transaction_date", "yyyy-MM"))
        months = deltas.filter(F.col(BATCH_COL) == batch).select(MONTH).distinct()
        whole = deltas.join(months, MONTH, "left_semi").groupBy(MONTH, "transaction_date").agg(*[self._sum(c).alias(c) for c in _PARTS])
        # A date without rows stays as a zero, so that a month that loses its last row is replaced too.
        sinks.replace_partitions(models.daily_measures(whole, MONTH), self.mart, MONTH)

    # ---- reads -------------------------------------------------------------------------------
    def tagged(self, spark: SparkSession) -> DataFrame:
        return self._rows(spark).drop(BUCKET)

    def silver(self, spark: SparkSession) -> DataFrame:
        return self.tagged(spark).filter(F.col(REASON_COL) == "").drop(REASON_COL)

    def dead_letter(self, spark: SparkSession) -> DataFrame:
        return self.tagged(spark).filter(F.col(REASON_COL) != "")

    def daily_mart(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.mart).filter("transaction_count > 0").drop(MONTH)
