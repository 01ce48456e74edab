"""Check-strategy snapshot of a current-state table.

Each run diffs the tracked columns of the current state against the open snapshot record of
every key and stamps changes with the *run time* (blind to business effective dates):
changed keys get their open record closed at ``run_ts`` and a new open record; new keys get
an open record; unchanged keys and keys missing from the current state are left untouched.
Open records end at the sentinel, never NULL. One full outer join per run, which reads the
previous snapshot once (closed records ride through the join unmatched).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.schemas import OPEN_END_TS

SNAP_FROM, SNAP_TO = "dbt_valid_from", "dbt_valid_to"


def _ts(value: datetime | str):
    """A timestamp_ntz literal parsed from text: no driver or session time zone involved."""
    ts = value if isinstance(value, datetime) else datetime.fromisoformat(value)
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def snapshot_check(prev: DataFrame | None, current: DataFrame, keys: Sequence[str], check_cols: Sequence[str],
                   run_ts: datetime | str) -> DataFrame:
    keys, check_cols = list(keys), list(check_cols)
    cols = current.columns
    run = _ts(run_ts)
    end = _ts(OPEN_END_TS)
    if prev is None:
        return current.select(*cols, run.alias(SNAP_FROM), end.alias(SNAP_TO))
    non_key = [x for x in cols if x not in keys]
    o = prev.select(*[F.col(k).alias(f"_ok_{k}") for k in keys], *[F.col(x).alias(f"_o_{x}") for x in non_key],
                    F.col(SNAP_FROM).alias("_o_from"), F.col(SNAP_TO).alias("_o_to"), F.lit(True).alias("_o"))
    c = current.select(*keys, *[F.col(x).alias(f"_c_{x}") for x in non_key], F.lit(True).alias("_c"))
    # only the open record of a key can match the current row; closed records pass through
    cond = reduce(lambda a, b: a & b, [o[f"_ok_{k}"] == c[k] for k in keys]) & (o["_o_to"] == end)
    j = o.join(c, cond, "full")
    has_o, has_c = F.col("_o").isNotNull(), F.col("_c").isNotNull()
    matched = has_o & has_c
    changed = matched & reduce(lambda a, b: a | b,
                               [~F.col(f"_o_{x}").eqNullSafe(F.col(f"_c_{x}")) for x in check_cols])
    old = F.struct(has_o.alias("_keep"), *[F.col(f"_ok_{k}").alias(k) for k in keys],
                   *[F.col(f"_o_{x}").alias(x) for x in non_key], F.col("_o_from").alias(SNAP_FROM),
                   F.when(changed, run).otherwise(F.col("_o_to")).alias(SNAP_TO))
    new = F.struct((has_c & (changed | ~matched)).alias("_keep"), *[F.col(k).alias(k) for k in keys],
                   *[F.col(f"_c_{x}").alias(x) for x in non_key], run.alias(SNAP_FROM), end.alias(SNAP_TO))
    out = j.select(F.inline(F.array(old, new))).filter(F.col("_keep"))
    return out.select(*cols, SNAP_FROM, SNAP_TO)


STATE, RUN = "_state", "_run"


class SnapshotStore:
    """A stored snapshot, one partition per run and state. A run joins the current table with the
    open records of the run before, writes the records it closes and all that are open now, and
    touches nothing else: closed records are written once and never read by a later run. The
    snapshot at run n is the open part of run n and the closed parts of all runs up to it. A run
    that is repeated replaces its own partitions."""

    def __init__(self, path: str, keys: Sequence[str], check_cols: Sequence[str]) -> None:
        self.path, self.keys, self.check_cols = path.rstrip("/"), list(keys), list(check_cols)

    def run(self, current: DataFrame, number: int, run_ts: datetime | str) -> None:
        """Run ``number`` (0, 1, 2, ...) at ``run_ts``."""
        prev = self._read(current.sparkSession).filter((F.col(RUN) == number - 1) & (F.col(STATE) == "open")).drop(RUN, STATE) if number else None
        state = F.when(F.col(SNAP_TO) == _ts(OPEN_END_TS), "open").otherwise("closed")
        (snapshot_check(prev, current, self.keys, self.check_cols, run_ts).withColumn(STATE, state)
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(STATE).parquet(f"{self.path}/{RUN}={number}"))

    def _read(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("basePath", self.path).parquet(f"{self.path}/{RUN}=*")

    def records(self, spark: SparkSession, number: int) -> DataFrame:
        """All records as of run ``number``."""
        run, state = F.col(RUN), F.col(STATE)
        return self._read(spark).filter(((state == "open") & (run == number)) | ((state == "closed") & (run <= number))).drop(RUN, STATE)
