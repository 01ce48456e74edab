"""Incremental ingestion of landing files with Structured Streaming.

``readStream`` with the declared schema tracks processed files in the checkpoint, so a rerun
reads only new files. Each file is a delivery of its own: its batch id is a hash of its path,
below zero, so it never meets the ids that batch jobs count from zero, nor those of another
stream. Rows are masked and written with dynamic partition overwrite by that id:
``foreachBatch`` is at-least-once, and a replayed micro-batch, or a new checkpoint over the same
files, rewrites the same partitions. Silver stays a batch recompute over bronze.

``stream_ingest`` keeps a folder per landing file, which suits few and large files. For many small
ones, ``stream_deliveries`` writes a folder per micro-batch (named by the hour), with the file's id as
a column, and a row in a small table of finished writes. Only rows of finished writes count, and a
file that a finished write names is never taken again, so neither a replay nor a new checkpoint adds
anything. ``compact_deliveries`` unites finished writes into one.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.masking import TRANSACTION_MASK, mask
from ..sources.schemas import BATCH_COL, TRANSACTION_SCHEMA


def stream_source(spark: SparkSession, source_dir: str, schema: T.StructType = TRANSACTION_SCHEMA,
                  fmt: str = "csv") -> DataFrame:
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        return reader.option("header", True).csv(source_dir)
    if fmt == "json":
        return reader.option("multiLine", True).json(source_dir)
    raise ValueError(f"unsupported format {fmt!r}")


def _masked_source(spark: SparkSession, source_dir: str, schema: T.StructType, fmt: str, mask_spec: Mapping[str, str]) -> DataFrame:
    # 63 bits of the path's hash, as a negative long: two of 100,000 files meet with a chance of 5e-10
    delivery = F.xxhash64("_metadata.file_path").bitwiseOR(F.lit(-(1 << 63)))
    source = stream_source(spark, source_dir, schema, fmt)
    return mask(source.select(*source.columns, delivery.alias(BATCH_COL)), mask_spec)


def stream_ingest(spark: SparkSession, source_dir: str, bronze_path: str, checkpoint_location: str,
                  schema: T.StructType = TRANSACTION_SCHEMA, fmt: str = "csv",
                  mask_spec: Mapping[str, str] = TRANSACTION_MASK, wait: bool = True) -> StreamingQuery:
    masked = _masked_source(spark, source_dir, schema, fmt, mask_spec)

    def write_batch(df: DataFrame, batch_id: int) -> None:
        (df.write
         .mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH_COL).parquet(bronze_path))

    q = (masked.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q


WRITE = "_write"
_FINISHED = f"{WRITE} string, {BATCH_COL} long, replaces array<string>"


def _finished(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_FINISHED).parquet(f"{path.rstrip('/')}/finished")


def _live(spark: SparkSession, path: str) -> DataFrame:
    """(write) of the finished writes that no other one replaces."""
    done = _finished(spark, path)
    gone = done.select(F.explode("replaces").alias(WRITE)).distinct()
    return done.select(WRITE).distinct().join(gone, WRITE, "left_anti")


def _commit(spark: SparkSession, path: str, write: str, replaces: list[str]) -> None:
    """One row for each delivery that a write holds; the write counts from here on. Its rows are read
    back, so that what is finished is what is stored."""
    rows = spark.read.parquet(f"{path.rstrip('/')}/rows/{WRITE}={write}")
    old = F.array(*[F.lit(r) for r in replaces]).cast("array<string>")
    (rows.select(BATCH_COL).distinct().select(F.lit(write).alias(WRITE), BATCH_COL, old.alias("replaces"))
     .coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/finished"))


def _new_write() -> str:
    return f"{datetime.now(timezone.utc):%Y-%m-%d-%H}-{uuid.uuid4().hex}"


def stream_deliveries(spark: SparkSession, source_dir: str, bronze_path: str, checkpoint_location: str,
                      schema: T.StructType = TRANSACTION_SCHEMA, fmt: str = "csv", mask_spec: Mapping[str, str] = TRANSACTION_MASK,
                      files_per_write: int = 1_000, wait: bool = True) -> StreamingQuery:
    """Ingest new landing files, ``files_per_write`` of them into one folder."""
    path = bronze_path.rstrip("/")
    spark.createDataFrame([], _FINISHED).coalesce(1).write.mode("append").parquet(f"{path}/finished")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_write)
    if fmt != "csv":
        raise ValueError(f"unsupported format {fmt!r}")
    delivery = F.xxhash64("_metadata.file_path").bitwiseOR(F.lit(-(1 << 63)))
    source = reader.option("header", True).csv(source_dir)
    masked = mask(source.select(*source.columns, delivery.alias(BATCH_COL)), mask_spec)

    def write_batch(df: DataFrame, batch_id: int) -> None:
        known = _finished(df.sparkSession, path).select(BATCH_COL).distinct()
        write = _new_write()
        target = f"{path}/rows/{WRITE}={write}"
        df.join(known, BATCH_COL, "left_anti").write.parquet(target)
        _commit(df.sparkSession, path, write, [])

    q = (masked.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q


def read_deliveries(spark: SparkSession, bronze_path: str) -> DataFrame:
    """Rows of the finished writes; what a job left behind when it died does not count. The writes
    prune the folders that are read."""
    path = bronze_path.rstrip("/")
    rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows/{WRITE}=*")
    return rows.join(_live(spark, path), WRITE, "left_semi").drop(WRITE)


def compact_deliveries(spark: SparkSession, bronze_path: str) -> int:
    """Unite the finished writes into one with files of the advisory size; returns how many there
    were. Readers see either the old writes or the new one. Old folders stay until they are removed
    by hand: a reader that started before may still need them."""
    path = bronze_path.rstrip("/")
    live = sorted(r[0] for r in _live(spark, path).collect())
    if len(live) < 2:
        return len(live)
    write = _new_write()
    read_deliveries(spark, path).hint("rebalance").write.parquet(f"{path}/rows/{WRITE}={write}")
    _commit(spark, path, write, live)
    return len(live)
