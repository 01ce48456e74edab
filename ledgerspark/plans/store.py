"""A stored history: key buckets, a change log with checkpoints, and an audit of every write.

* ``table`` holds the latest state, partitioned by a hash bucket of the key. A merge reads the
  buckets of its batch only and replaces these alone; all others keep their files.
* ``log`` holds what every merge wrote, one partition per version.
* ``states`` holds a full state every ``every`` versions. Any version is the last state at or before
  it and the log's partitions behind that, never the whole log.
* ``audit`` holds what was observed while a version was written: rows, new and closed rows, and a sum
  of row hashes. Comparing it with the log as read shows a lost, repeated or altered write.

A merge first writes its buckets aside (``staged``) and then the audit of that write. From there on
a rerun finds the audit, takes the staged rows as they are, and repeats the replacing steps, each of
which gives the same result however often it runs. So a job that dies anywhere can be run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import scd2, temporal
from ..sources import sinks
from ..sources.schemas import ACCOUNT_KEYS, ACCOUNT_TRACKED

BUCKET = "_bucket"
AUDIT_SCHEMA = "_version int, operation string, rows_written long, inserted long, closed long, checksum decimal(38,0)"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def buckets_in(df: DataFrame, keys: Sequence[str], buckets: int) -> list[int]:
    """The buckets that hold keys of ``df``: at most ``buckets`` numbers."""
    return sorted(r[0] for r in df.select(bucket_of(keys, buckets)).distinct().collect())


@dataclass
class HistoryStore:
    root: str
    buckets: int = 64
    every: int = 8
    keys: Sequence[str] = ACCOUNT_KEYS
    tracked: Sequence[str] = ACCOUNT_TRACKED

    def _path(self, part: str) -> str:
        return f"{self.root.rstrip('/')}/{part}"

    @property
    def table(self) -> str:
        return self._path("table")

    @property
    def log(self) -> str:
        return self._path("log")

    @property
    def audit(self) -> str:
        return self._path("audit")

    def _columns(self) -> list[str]:
        return [*self.keys, *self.tracked, scd2.VF, scd2.VT, scd2.CUR]

    # ---- writes ------------------------------------------------------------------------------
    def create(self, history: DataFrame) -> None:
        """Version 0: the initial load."""
        spark = history.sparkSession
        flagged = history.withColumns({scd2.WRITTEN: F.lit(True), scd2.INSERTED: F.lit(True)})
        self._stage(flagged, 0, "WRITE")
        self._publish(spark, 0, "WRITE")

    def merge(self, batch: DataFrame, version: int, mode: str = "strict", on_ambiguous: str = "skip",
              null_safe: bool = False, order_col: str | None = None) -> DataFrame:
        """Bring the table from ``version - 1`` to ``version``; returns the outcomes of the batch
        rows, read back from storage. The latest version may be run again."""
        spark = batch.sparkSession
        if not self._audited(spark, version):
            touched = buckets_in(batch, self.keys, self.buckets)
            result = scd2.merge(self.current(spark, touched), batch, self.keys, self.tracked, mode=mode,
                                null_safe=null_safe, on_ambiguous=on_ambiguous, order_col=order_col)
            sinks.replace_partition(result.outcomes, self._path("outcomes"), temporal.VERSION, version)
            self._stage(result.flagged, version, "MERGE")
        self._publish(spark, version, "MERGE")
        return spark.read.parquet(self._path("outcomes")).filter(F.col(temporal.VERSION) == version).drop(temporal.VERSION)

    def _stage(self, flagged: DataFrame, version: int, operation: str) -> None:
        written, inserted = F.col(scd2.WRITTEN), F.col(scd2.INSERTED)
        columns = self._columns()
        seen = Observation(f"version {version}")
        rows = flagged.select(*columns, *scd2.FLAGS)
        row = F.xxhash64(*[x for c in sorted(columns) for x in (F.col(c), F.col(c).isNull())]).cast("decimal(38,0)")
        watched = rows.observe(seen, F.count_if(written).alias("rows_written"), F.count_if(written & inserted).alias("inserted"),
                               F.count_if(written & ~inserted).alias("closed"),
                               F.coalesce(F.sum(F.when(written, row)), F.lit(0).cast("decimal(38,0)")).alias("checksum"))
        sinks.overwrite(watched.withColumn(BUCKET, bucket_of(self.keys, self.buckets)), self._path(f"staged/v={version}"))
        found = seen.get
        audit = flagged.sparkSession.createDataFrame([(version, operation, *(found[c] for c in ("rows_written", "inserted", "closed", "checksum")))], AUDIT_SCHEMA)
        sinks.replace_partition(audit.coalesce(1), self.audit, temporal.VERSION, version)

    def _publish(self, spark: SparkSession, version: int, operation: str) -> None:
        staged = spark.read.parquet(self._path(f"staged/v={version}"))
        changes = staged.filter(scd2.WRITTEN).select(*self._columns(), F.lit(operation).alias(temporal.OPERATION))
        sinks.replace_partition(changes, self.log, temporal.VERSION, version)
        sinks.replace_partitions(staged.drop(*scd2.FLAGS), self.table, BUCKET)
        if version % self.every == 0:
            sinks.overwrite(self.current(spark), self._path(f"states/v={version}"))

    # ---- reads -------------------------------------------------------------------------------
    def _audited(self, spark: SparkSession, version: int) -> bool:
        return not spark.read.schema(AUDIT_SCHEMA).parquet(self.audit).filter(F.col(temporal.VERSION) == version).isEmpty()

    def current(self, spark: SparkSession, buckets: Sequence[int] | None = None) -> DataFrame:
        """The latest state, or that of some buckets: only their files are read."""
        rows = spark.read.parquet(self.table)
        if buckets is not None:
            rows = rows.filter(F.col(BUCKET).isin([int(b) for b in buckets]))
        return rows.select(*self._columns())

    def changes(self, spark: SparkSession, after: int, upto: int) -> DataFrame:
        """The logged changes of the versions behind ``after`` up to ``upto``, with their version."""
        rows = spark.read.parquet(self.log)
        return rows.filter((F.col(temporal.VERSION) > after) & (F.col(temporal.VERSION) <= upto))

    def as_of(self, spark: SparkSession, version: int) -> DataFrame:
        """The history as recorded at ``version``."""
        base = version - version % self.every
        state = spark.read.parquet(self._path(f"states/v={base}"))
        if base == version:
            return state
        return temporal.as_of_checkpoint(state, self.changes(spark, base, version), self.keys)

    def version_log(self, spark: SparkSession) -> DataFrame:
        """version, operation, rows written, as observed at the writes: no data is read."""
        return spark.read.schema(AUDIT_SCHEMA).parquet(self.audit).select(
            F.col(temporal.VERSION).alias("version"), "operation", F.col("rows_written").alias("num_output_rows"))

    def check_writes(self, spark: SparkSession) -> DataFrame:
        """What was observed at the write of every version against its partition of the log as read
        now: version, operation, rows_written, inserted, closed, rows_read, status. Status: ``ok``,
        ``lost`` or ``repeated`` (fewer or more rows than written), ``altered`` (other rows), or
        ``unknown`` (rows of a version that no write accounts for)."""
        audit = spark.read.schema(AUDIT_SCHEMA).parquet(self.audit)
        read = spark.read.parquet(self.log).groupBy(F.col(temporal.VERSION).alias("_v")).agg(
            F.count(F.lit(1)).alias("rows_read"), sinks.checksum(self._columns()).alias("_sum"))
        both = audit.join(read, F.col(temporal.VERSION) == F.col("_v"), "full")
        rows = F.coalesce("rows_read", F.lit(0))
        status = (F.when(F.col(temporal.VERSION).isNull(), "unknown").when(rows < F.col("rows_written"), "lost")
                  .when(rows > F.col("rows_written"), "repeated")
                  .when((rows > 0) & (F.col("_sum") != F.col("checksum")), "altered").otherwise("ok"))
        return both.select(F.coalesce(temporal.VERSION, "_v").alias("version"), "operation", "rows_written", "inserted", "closed",
                           rows.alias("rows_read"), status.alias("status"))

    def check_table(self, spark: SparkSession) -> DataFrame:
        """One row: rows and open windows that the audit accounts for (a merge never deletes), and
        those of the table as read."""
        audit = spark.read.schema(AUDIT_SCHEMA).parquet(self.audit).agg(F.sum("inserted").alias("rows_expected"))
        table = self.current(spark).agg(F.count(F.lit(1)).alias("rows_read"), F.count_if(scd2.CUR).alias("current_read"))
        both = audit.unionByName(table, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in ("rows_expected", "rows_read", "current_read")])
        return both.withColumn("ok", F.col("rows_expected") == F.col("rows_read"))
