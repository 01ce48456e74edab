"""Keep-latest deduplication.

``row_number() == 1`` over (key, order desc) is planned by Catalyst as a WindowGroupLimit:
a partial top-1 per key inside every map task before the shuffle, then a final one after
it. A key that holds a third of all rows therefore ships at most one row per map task, not
its whole group. Rows with a NULL key never enter the window (they would form one giant
group and collapse to a single survivor); by default they pass through untouched so the
key rule can route every one of them to the dead letter.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def dedup_latest(df: DataFrame, keys: Sequence[str] | str, order_col: str, ties: Sequence[str] = (),
                 null_keys: str = "keep") -> DataFrame:
    """One row per key: the one with the greatest ``order_col``, then greatest ``ties``, then a
    deterministic hash of the row.

    null_keys: ``"keep"`` (all NULL-key rows survive) or ``"collapse"`` (they form one group,
    as a plain window would do).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    # a total order: remaining ties are broken by a hash of the whole row (values and which of
    # them are NULL, since the hash skips NULLs), so the survivor depends only on the data and a
    # retried task picks the same row as the first attempt
    order = ([F.col(order_col).desc_nulls_last()] + [F.col(t).desc_nulls_last() for t in ties]
             + [F.xxhash64(*[x for c in df.columns for x in (F.col(c), F.col(c).isNull())]).desc()])
    if null_keys == "collapse":
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    if null_keys != "keep":
        raise ValueError("null_keys must be 'keep' or 'collapse'")
    nulls = _any_null(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    latest = df.filter(~nulls).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    return latest.unionByName(df.filter(nulls))


def dedup_stats(df: DataFrame, keys: Sequence[str] | str, null_keys: str = "keep") -> DataFrame:
    """One row: rows before, rows after keep-latest dedup, rows removed (one aggregate pass)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    nulls = _any_null(keys)
    null_rows = F.count_if(nulls)
    if null_keys == "keep":
        after = F.count_distinct(*[F.col(k) for k in keys]) + null_rows
    else:
        after = F.count_distinct(*[F.col(k) for k in keys]) + F.when(null_rows > 0, 1).otherwise(0)
    return (df.agg(F.count(F.lit(1)).alias("before"), after.alias("after"))
            .withColumn("removed", F.col("before") - F.col("after")))
