"""Two time axes over a history.

* Business time (``valid_from <= d < valid_to``): ``state_on`` a date and ``as_of_join`` of
  dated facts to the window they fall in.
* System time (what had been recorded at version n): an append-only change log of
  ``(row, _version, _operation)``. A merge only inserts windows and updates end stamps, it
  never deletes one (in either mode), so the state at version n is the latest logged copy of every
  ``(keys, valid_from)`` with ``_version <= n``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.schemas import ACCOUNT_KEYS, ACCOUNT_TRACKED
from .scd2 import VF, VT, lookup_windows

VERSION, OPERATION = "_version", "_operation"


def _as_date(d: date | str | Column) -> Column:
    if isinstance(d, Column):
        return d
    return F.lit(d if isinstance(d, date) else date.fromisoformat(d))


def state_on(history: DataFrame, d: date | str | Column) -> DataFrame:
    """The window of every key that holds on date ``d`` (half-open)."""
    day = _as_date(d)
    return history.filter((F.col(VF) <= day) & (day < F.col(VT)))


def as_of_join(facts: DataFrame, history: DataFrame, keys: Sequence[str] = ACCOUNT_KEYS,
               date_col: str = "event_timestamp", tracked: Sequence[str] = ACCOUNT_TRACKED,
               how: str = "left") -> DataFrame:
    """Attach to every fact the history window its date falls in.

    The facts are reduced to distinct (key, day) points (a partial aggregate), each point finds its
    window with a running ``last`` over history + points per key (bounded per key by the number of
    distinct days), and the facts are equi-joined back on (key, day): exactly one candidate per
    fact, so a key holding a third of the facts is spread over its days and AQE can split a hot
    (key, day) further. No fact is compared with every window of its key.
    """
    keys, tracked = list(keys), list(tracked)
    day = F.to_date(facts[date_col])
    out_cols = [*facts.columns, *tracked, VF, VT]
    f = facts.withColumn("_asof_d", day)
    known = reduce(lambda p, q: p & q, [F.col(k).isNotNull() for k in keys])
    points = f.select(*keys, F.col("_asof_d").alias("_d")).filter(known & F.col("_d").isNotNull()).distinct()
    w = F.col("_l")
    look = (lookup_windows(history.filter(known), points, keys, tracked)
            .filter(w.isNotNull() & (F.col("_d") < w["vt"]))
            .select(*keys, F.col("_d").alias("_asof_d"), *[w[t].alias(t) for t in tracked],
                    w["vf"].alias(VF), w["vt"].alias(VT)))
    return f.join(look, [*keys, "_asof_d"], how).select(*out_cols)


def as_of_join_spans(facts: DataFrame, history: DataFrame, keys: Sequence[str] = ACCOUNT_KEYS, date_col: str = "event_timestamp",
                     tracked: Sequence[str] = ACCOUNT_TRACKED, how: str = "left", span_days: int = 32) -> DataFrame:
    """The same as ``as_of_join`` by the windows themselves: a window is listed under those spans of
    ``span_days`` days that it touches and in which its key has facts, and a fact is compared with
    the windows of its key and span. No sort of points per key, so it suits facts on many distinct
    days against windows that are long. The spans of a key's facts travel as one array (as many
    entries as the facts' dates have spans), so windows that no fact can meet cost no row."""
    keys, tracked = list(keys), list(tracked)
    out_cols = [*facts.columns, *tracked, VF, VT]
    f = facts.withColumn("_d", F.to_date(facts[date_col])).withColumn("_span", F.floor(F.unix_date("_d") / span_days))
    held = f.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.collect_set("_span").alias("_spans"))
    first, last = F.floor(F.unix_date(VF) / span_days), F.floor((F.unix_date(VT) - 1) / span_days)
    met = F.filter("_spans", lambda s: (s >= first) & (s <= last))
    same_key = reduce(lambda p, q: p & q, [F.col(k) == F.col(f"_k_{k}") for k in keys])
    # Sort-merge by hint: files of a history are small beside its rows, too many for a broadcast.
    windows = history.join(held.hint("merge"), same_key).select(
        *[F.col(k).alias(f"_w_{k}") for k in keys], *[F.col(t).alias(f"_w_{t}") for t in tracked],
        F.col(VF).alias("_w_from"), F.col(VT).alias("_w_to"), F.explode(met).alias("_w_span"))
    on = reduce(lambda p, q: p & q, [F.col(k) == F.col(f"_w_{k}") for k in keys])
    on = on & (F.col("_span") == F.col("_w_span")) & (F.col("_w_from") <= F.col("_d")) & (F.col("_d") < F.col("_w_to"))
    return f.join(windows, on, how).select(
        *facts.columns, *[F.col(f"_w_{t}").alias(t) for t in tracked], F.col("_w_from").alias(VF), F.col("_w_to").alias(VT)).select(*out_cols)


def start_log(history: DataFrame, operation: str = "WRITE") -> DataFrame:
    """Version 0 of a change log: the initial load."""
    return history.withColumn(VERSION, F.lit(0)).withColumn(OPERATION, F.lit(operation))


def append_changes(log: DataFrame, changes: DataFrame, version: int, operation: str = "MERGE") -> DataFrame:
    """Append the rows one merge wrote (``MergeResult.changes``) as ``version``."""
    return log.unionByName(changes.withColumn(VERSION, F.lit(version)).withColumn(OPERATION, F.lit(operation)))


def as_of_version(log: DataFrame, version: int | None = None, keys: Sequence[str] = ACCOUNT_KEYS) -> DataFrame:
    """The history as recorded at ``version`` (latest if None)."""
    keys = list(keys)
    rows = log if version is None else log.filter(F.col(VERSION) <= version)
    w = Window.partitionBy(*keys, VF).orderBy(F.col(VERSION).desc())
    return (rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
            .drop("_rn", VERSION, OPERATION))


def as_of_checkpoint(state: DataFrame, changes: DataFrame, keys: Sequence[str] = ACCOUNT_KEYS) -> DataFrame:
    """A recorded full state brought forward by the changes logged behind it. Only the changes are
    ranked; the state gives up the rows that they replace and is not shuffled where they are few."""
    latest = as_of_version(changes, keys=keys)
    on = [*keys, VF]
    hit = latest.select(*[F.col(c).alias(f"_n_{c}") for c in on])
    same = reduce(lambda p, q: p & q, [F.col(c).eqNullSafe(F.col(f"_n_{c}")) for c in on])
    return state.join(hit, same, "left_anti").unionByName(latest)


def version_log(log: DataFrame) -> DataFrame:
    """version, operation, rows written (the data-loss check of a table history)."""
    return (log.groupBy(F.col(VERSION).alias("version"), F.col(OPERATION).alias("operation"))
            .agg(F.count(F.lit(1)).alias("num_output_rows")))
