"""Durable writes.

* bronze is appended (cumulative), silver and dead letter are recomputed in full;
* the tagged rows are written ONCE, partitioned by route, with the route counts observed on
  that same write (no second pass to count);
* history versions go to a new path per version and the path being read is never
  overwritten, so a merge always reads one pinned version;
* writes are whole-file and task-retry safe (Spark's commit protocol), so a lost executor
  only reruns its tasks; appends keyed by batch or version replace their own partition by name,
  so a rerun job replaces its own output instead of duplicating it, also when it is empty;
* recomputed tables are always replaced as a whole, whatever the session's overwrite mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.schemas import REASON_COL

ROUTE_COL = "_route"


def replace_partition(df: DataFrame, path: str, column: str, value: int | str) -> None:
    """Idempotent append: write ``df`` as the partition ``column=value`` of a table, in place of
    what that partition held. An empty frame leaves an empty partition, so a rerun that finds
    nothing also removes what an earlier run wrote. Other partitions are untouched."""
    _static(df.drop(column)).parquet(f"{path.rstrip('/')}/{column}={value}")


def _static(df: DataFrame):
    """A writer that replaces the whole target, whatever the session's overwrite mode is."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "static")


def replace_partitions(df: DataFrame, path: str, column: str) -> None:
    """Replace the partitions of a table that ``df`` has rows for; all others keep their files.
    AQE cuts or unites the rows of a partition into files of the advisory size."""
    (df.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).parquet(path))


def checksum(columns: list[str]) -> Column:
    """An aggregate that depends on the rows only, not on their order or partitions: the sum of the
    rows' hashes (of every value and of which values are NULL, since the hash skips NULLs)."""
    row = F.xxhash64(*[x for c in sorted(columns) for x in (F.col(c), F.col(c).isNull())])
    return F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = _static(df)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_table(df: DataFrame, name: str) -> None:
    """Replace a table of the session's catalog."""
    df.write.mode("overwrite").saveAsTable(name)


def write_routes(tagged: DataFrame, path: str, out: str = REASON_COL) -> dict[str, int]:
    """Write valid and dead-letter rows in one job, partitioned by ``_route``; return the
    counts observed during that write."""
    obs = Observation("routes")
    routed = tagged.withColumn(ROUTE_COL, F.when(F.col(out) == "", F.lit("valid")).otherwise(F.lit("dead_letter")))
    routed = routed.observe(obs, F.count(F.lit(1)).alias("total"),
                            F.count_if(F.col(out) == "").alias("valid"),
                            F.count_if(F.col(out) != "").alias("dead"))
    _static(routed).partitionBy(ROUTE_COL).parquet(path)
    return dict(obs.get)


def read_route(spark: SparkSession, path: str, route: str, out: str = REASON_COL) -> DataFrame:
    """One route of a routed table; the partition filter prunes the other route's files."""
    df = spark.read.parquet(path).filter(F.col(ROUTE_COL) == route).drop(ROUTE_COL)
    return df.drop(out) if route == "valid" else df


def version_path(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/v={version}"


def write_version(df: DataFrame, base: str, version: int) -> str:
    """Write one history version to its own path. Only this job writes it and no merge reads it
    (a merge reads version - 1), so a rerun simply rewrites it."""
    path = version_path(base, version)
    _static(df).parquet(path)
    return path
