"""Type 2 history of keyed records with half-open validity windows.

History columns: ``keys + tracked + [valid_from, valid_to, is_current]``. A window is
``valid_from <= d < valid_to``; the open end is the sentinel 9999-12-31, never NULL.

Two merge modes, both pure DataFrame transforms (history in, new history out):

* ``strict`` reproduces a MERGE on ``(keys, valid_from)`` of a staged set of window shrinks
  and inserts: on-time changes close the current window, late changes split the window
  they fall into. Every batch row gets an outcome; rows whose staged rows would hit one
  target twice (a MERGE cardinality violation) are detected before applying and left out
  (``ambiguous_match``), or raise with ``on_ambiguous="raise"``.
* ``timeline`` unions history and batch change points per key, drops no-op changes and
  recomputes every ``valid_to`` with ``lead``: several changes per key are allowed.

Rows with a NULL key match nothing (as in an equi join): batch rows get ``unknown_key``, history
rows pass through. They never enter a window.

Partition sizes: a sound history has at most one window start per key and day, so per-key
work over history is bounded by the number of distinct dates. Batch rows are not bounded per
key, so they are first reduced to distinct (key, date) points by a partial aggregate; the rows
themselves only meet equi joins and partial counts, which a hot key cannot overload.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.schemas import ACCOUNT_KEYS, ACCOUNT_TRACKED, OPEN_END

VF, VT, CUR = "valid_from", "valid_to", "is_current"
#: Flags of a merge's output: rows that this merge wrote, and those of them that are new.
WRITTEN, INSERTED = "_written", "_inserted"
FLAGS = (WRITTEN, INSERTED)

# outcome labels of a batch row
FORWARD, NO_OP = "forward_change", "no_op"
LATE_SPLIT, LATE_NO_OP = "late_split", "late_no_op"
UNKNOWN_KEY, BEFORE_FIRST = "unknown_key", "before_first_window"
NULL_DATE, AMBIGUOUS = "null_effective_date", "ambiguous_match"


class MergeCardinalityError(RuntimeError):
    """Several staged rows would update the same history row."""


@dataclass
class MergeResult:
    history: DataFrame   # the new history
    outcomes: DataFrame  # one row per batch row with its outcome
    staged: DataFrame    # shrinks and inserts that were applied
    changes: DataFrame   # rows of the new history written by this merge (for the change log)
    flagged: DataFrame | None = None  # new history plus ``FLAGS`` (one write gives all)


def open_end() -> Column:
    return F.lit(OPEN_END)


def _differs(a: Sequence[Column], b: Sequence[Column], null_safe: bool) -> Column:
    if null_safe:
        parts = [~x.eqNullSafe(y) for x, y in zip(a, b)]
    else:
        parts = [x != y for x, y in zip(a, b)]
    return reduce(lambda p, q: p | q, parts)


def _known(keys: Sequence[str]) -> Column:
    return reduce(lambda p, q: p & q, [F.col(k).isNotNull() for k in keys])


def initial_history(df: DataFrame, keys: Sequence[str] = ACCOUNT_KEYS, tracked: Sequence[str] = ACCOUNT_TRACKED,
                    eff: str = "effective_date") -> DataFrame:
    """Every row opens a current window from its effective date."""
    return df.select(*keys, *tracked, F.col(eff).alias(VF), open_end().alias(VT), F.lit(True).alias(CUR))


def current(history: DataFrame) -> DataFrame:
    return history.filter(F.col(CUR))


def _window_struct(tracked: Sequence[str]) -> Column:
    return F.struct(F.col(VF).alias("vf"), F.col(VT).alias("vt"), *[F.col(t).alias(t) for t in tracked])


def _with_outcome(b: DataFrame, keys: list[str], tracked: list[str], eff: str, null_safe: bool) -> DataFrame:
    """Outcome and compared window (``_w``) of every batch row, from ``_c`` (current window of the
    key) and ``_l`` (last history window starting on or before the row's date)."""
    e, c, lw = F.col(eff), F.col("_c"), F.col("_l")
    vs_c = _differs([F.col(t) for t in tracked], [c[t] for t in tracked], null_safe)
    vs_l = _differs([F.col(t) for t in tracked], [lw[t] for t in tracked], null_safe)
    outcome = (
        F.when(e.isNull(), F.lit(NULL_DATE))
        .when(c.isNull(), F.lit(UNKNOWN_KEY))
        .when(e >= c["vf"], F.when(vs_c, F.lit(FORWARD)).otherwise(F.lit(NO_OP)))
        .when(lw.isNull() | (e >= lw["vt"]), F.lit(BEFORE_FIRST))
        .when(vs_l, F.lit(LATE_SPLIT)).otherwise(F.lit(LATE_NO_OP)))
    window = F.when(outcome.isin(FORWARD, NO_OP), c).when(outcome.isin(LATE_SPLIT, LATE_NO_OP), lw)
    return b.select(*keys, *tracked, eff, outcome.alias("outcome"), window.alias("_w"))


def lookup_windows(history: DataFrame, points: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    """For distinct (keys, ``_d``) points: the key's current window ``_c`` and the last history
    window starting on or before ``_d`` (``_l``).

    One window partition per key over history + points. Both sides are bounded per key by the
    number of distinct dates (a sound history has one window start per key and day; points
    are distinct), so no key can grow a partition with the data volume.
    """
    is_h = F.col("_is_b") == 0
    h = history.select(*keys, *tracked, F.col(VF).alias("_d"), F.lit(0).alias("_is_b"), VF, VT, CUR)
    u = h.unionByName(points.withColumn("_is_b", F.lit(1)), allowMissingColumns=True)
    by_key = Window.partitionBy(*keys)
    upto = by_key.orderBy("_d", "_is_b", VT, *tracked).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return u.select(
        *keys, "_d", "_is_b",
        F.max(F.when(is_h & F.col(CUR), _window_struct(tracked))).over(by_key).alias("_c"),
        F.last(F.when(is_h, _window_struct(tracked)), ignorenulls=True).over(upto).alias("_l")
    ).filter(~is_h).drop("_is_b")


def _labelled(history: DataFrame, batch: DataFrame, keys: list[str], tracked: list[str], eff: str,
              null_safe: bool) -> DataFrame:
    """Every batch row with its outcome and the window it is compared with (``_w``: the current
    window for on-time rows, the window holding ``eff`` for late ones).

    The batch is reduced to distinct (key, date) points, the points are labelled against history,
    and the rows get their labels by an equi join on (key, date), which AQE can split when one
    (key, date) is hot. No range join, and no key-wide partition over batch rows."""
    points = batch.filter(_known(keys) & F.col(eff).isNotNull()).select(*keys, F.col(eff).alias("_d")).distinct()
    look = lookup_windows(history.filter(_known(keys)), points, keys, tracked).withColumnRenamed("_d", eff)
    labelled = batch.select(*keys, *tracked, eff).join(look, [*keys, eff], "left")
    return _with_outcome(labelled, keys, tracked, eff, null_safe)


def classify(history: DataFrame, batch: DataFrame, keys: Sequence[str] = ACCOUNT_KEYS,
             tracked: Sequence[str] = ACCOUNT_TRACKED, eff: str = "effective_date",
             null_safe: bool = False) -> DataFrame:
    """Every batch row with its outcome and compared window (``_w_from``, ``_w_to``,
    ``_w_<col>``), against one version of the history."""
    keys, tracked = list(keys), list(tracked)
    x = _labelled(history, batch, keys, tracked, eff, null_safe)
    return x.select(*keys, *tracked, eff, "outcome", F.col("_w.vf").alias("_w_from"), F.col("_w.vt").alias("_w_to"),
                    *[F.col(f"_w.{t}").alias(f"_w_{t}") for t in tracked])


def merge(history: DataFrame, batch: DataFrame, keys: Sequence[str] = ACCOUNT_KEYS,
          tracked: Sequence[str] = ACCOUNT_TRACKED, eff: str = "effective_date", mode: str = "strict",
          null_safe: bool = False, on_ambiguous: str = "skip", order_col: str | None = None) -> MergeResult:
    """Apply one batch of dated states to a history. See the module docstring.

    Strict mode: label the batch rows, expand each change into a shrink (match key: the compared
    window's start) and an insert (match key: ``eff``), and count staged rows per match key with a
    partial aggregate. A change whose match key is staged twice is ambiguous and left out; after
    that a ``(keys, valid_from)`` holds at most one staged row, and the MERGE is a full outer join
    of history with the staged rows on it. History is read twice (labels, MERGE); only staged rows
    take part in the counts. ``order_col`` belongs to the timeline mode.
    """
    if mode == "timeline":
        return merge_timeline(history, batch, keys, tracked, eff, null_safe, order_col)
    if mode != "strict":
        raise ValueError("mode must be 'strict' or 'timeline'")
    if on_ambiguous not in ("skip", "raise"):
        raise ValueError("on_ambiguous must be 'skip' or 'raise'")
    keys, tracked = list(keys), list(tracked)
    x = _labelled(history, batch, keys, tracked, eff, null_safe)
    e, w, o = F.col(eff), F.col("_w"), F.col("outcome")
    change = x.filter(o.isin(FORWARD, LATE_SPLIT))
    # the two match keys of a change: the window it shrinks and its own date
    match = change.select(*keys, F.explode(F.array(w["vf"], e)).alias(VF))
    twice = (match.groupBy(*keys, VF).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n"))

    def flagged(df: DataFrame, on: Column, flag: str) -> DataFrame:
        side = twice.select(*[F.col(k).alias(f"_t_{k}") for k in keys], F.col(VF).alias("_t_vf"), F.lit(True).alias(flag))
        same = reduce(lambda p, q: p & q, [F.col(k) == F.col(f"_t_{k}") for k in keys])
        return df.join(side, same & (on == F.col("_t_vf")), "left").drop(*[f"_t_{k}" for k in keys], "_t_vf")

    applied = o.isin(FORWARD, LATE_SPLIT)
    y = x.withColumns({"_m1": F.when(applied, w["vf"]), "_m2": F.when(applied, e)})
    y = flagged(flagged(y, F.col("_m1"), "_b1"), F.col("_m2"), "_b2")
    y = y.withColumn("_bad", F.coalesce("_b1", "_b2", F.lit(False)))
    if on_ambiguous == "raise":
        n = y.filter("_bad").count()
        if n:
            raise MergeCardinalityError(f"{n} batch rows match a history row more than once")

    def item(kind: str, vf: Column, vt: Column, cur: Column, values: bool) -> Column:
        vals = [(F.col(t) if values else F.when(F.lit(False), F.col(t))).alias(t) for t in tracked]
        return F.struct(vf.alias(VF), *vals, vt.alias(VT), cur.alias(CUR), F.lit(kind).alias("_kind"))

    late = o == LATE_SPLIT
    items = F.array(item("shrink", w["vf"], e, F.lit(False), False),
                    item("insert", e, F.when(late, w["vt"]).otherwise(open_end()), ~late, True))
    staged = y.filter(applied & ~F.col("_bad")).select(*keys, F.inline(items))
    right = staged.select(*[F.col(c).alias(f"_s_{c}") for c in [*keys, VF, *tracked, VT, CUR]], F.lit(True).alias("_hit"))
    left = history.select(*keys, *tracked, VF, VT, CUR, F.lit(True).alias("_old"))
    on = reduce(lambda p, q: p & q, [F.col(c) == F.col(f"_s_{c}") for c in [*keys, VF]])
    old, hit = F.col("_old").isNotNull(), F.col("_hit").isNotNull()
    out = left.join(right, on, "full").select(
        *[F.when(old, F.col(c)).otherwise(F.col(f"_s_{c}")).alias(c) for c in [*keys, *tracked, VF]],
        *[F.when(hit, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) for c in (VT, CUR)], hit.alias(WRITTEN), (hit & ~old).alias(INSERTED))
    outcomes = y.select(*keys, *tracked, eff, F.when(F.col("_bad"), F.lit(AMBIGUOUS)).otherwise(o).alias("outcome"))
    return MergeResult(out.drop(*FLAGS), outcomes, staged, out.filter(WRITTEN).drop(*FLAGS), out)


SUPERSEDED, SAME_DAY = "superseded_same_day", "same_day_replace"


def merge_timeline(history: DataFrame, batch: DataFrame, keys: Sequence[str] = ACCOUNT_KEYS,
                   tracked: Sequence[str] = ACCOUNT_TRACKED, eff: str = "effective_date",
                   null_safe: bool = False, order_col: str | None = None) -> MergeResult:
    """Timeline merge: history and batch change points ordered per key, one key-wide window.

    A batch row is dropped when its key has no history, when it predates the key's first window or
    has no date, and when its values equal the state just before it. A batch row replaces the
    history row of its date; that window stays, with the new values, even when they equal the state
    before it: a merge never deletes a window, so the change log always tells the same story.
    ``valid_to`` is the next start.

    Several statements of one key and date: with ``order_col`` (a column of the batch) the one with
    the greatest value wins, the others are ``superseded_same_day``. Statements that differ and
    share that greatest value, or have no ``order_col`` to tell them apart, are all
    ``ambiguous_match`` and none is applied. Copies of the winner count as superseded.
    """
    keys, tracked = list(keys), list(tracked)
    src, vf = F.col("_src"), F.col(VF)
    known = _known(keys)
    dated = batch.filter(known & F.col(eff).isNotNull()).select(
        *keys, *tracked, F.col(eff), (F.col(order_col) if order_col else F.lit(0)).alias("_seq"))
    # one row per (key, date) by partial aggregates, so a hot key or date is never one group: the
    # latest sequence, then the least and the greatest statement that carry it
    values = F.struct(*[F.col(t) for t in tracked])
    latest = dated.groupBy(*keys, eff).agg(F.max("_seq").alias("_top"))
    right = latest.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(eff).alias("_k_eff"), "_top")
    same = reduce(lambda p, q: p & q, [F.col(k) == F.col(f"_k_{k}") for k in keys]) & (F.col(eff) == F.col("_k_eff"))
    tops = dated.join(right, same).filter(F.col("_seq").eqNullSafe(F.col("_top")))
    point = tops.groupBy(*keys, eff).agg(F.min(values).alias("_lo"), F.max(values).alias("_hi"))
    clear = F.col("_lo").eqNullSafe(F.col("_hi"))
    top = point.filter(clear).select(*keys, *[F.col("_lo")[t].alias(t) for t in tracked], eff)
    unclear = point.filter(~clear).select(*keys, eff)

    h = history.filter(known).select(*keys, *tracked, VF, F.col(VT).alias("_old_to"), F.col(CUR).alias("_old_cur"),
                                     F.lit(0).alias("_src"))
    b = top.select(*keys, *tracked, F.col(eff).alias(VF), F.lit(None).cast("date").alias("_old_to"),
                   F.lit(None).cast("boolean").alias("_old_cur"), F.lit(1).alias("_src"))
    u = h.unionByName(b)
    by_key = Window.partitionBy(*keys)
    ordered = by_key.orderBy(vf, src, *[F.col(t) for t in tracked], "_old_to")
    u = u.withColumns({"_first": F.min(F.when(src == 0, vf)).over(by_key),
                       "_last_h": F.max(F.when(src == 0, vf)).over(by_key)})
    kept = (src == 0) | (F.col("_first").isNotNull() & (vf >= F.col("_first")))
    early = u.filter(~kept)
    u = u.filter(kept)
    # a batch row takes the place of the history row of its date
    same_values = ~_differs([F.col(t) for t in tracked], [F.lag(t).over(ordered) for t in tracked], True)
    u = u.withColumns({
        "_replaced": F.coalesce((src == 0) & (F.lead(VF).over(ordered) == vf) & (F.lead("_src").over(ordered) == 1), F.lit(False)),
        "_hit": F.coalesce((src == 1) & (F.lag(VF).over(ordered) == vf) & (F.lag("_src").over(ordered) == 0), F.lit(False)),
        "_restated": F.coalesce(same_values, F.lit(False)),
        "_hit_to": F.lag("_old_to").over(ordered), "_hit_cur": F.lag("_old_cur").over(ordered)})
    u = u.filter(~F.col("_replaced"))
    prev = [F.lag(t).over(ordered) for t in tracked]
    first_row = F.lag(F.lit(1)).over(ordered).isNull()
    u = u.withColumn("_chg", first_row | F.coalesce(_differs([F.col(t) for t in tracked], prev, null_safe), F.lit(False)))
    labelled = u
    hit, restated = F.col("_hit"), F.col("_hit") & F.col("_restated")
    u = u.filter((src == 0) | hit | F.col("_chg"))
    nxt = F.lead(VF).over(ordered)
    u = u.withColumn(VT, F.coalesce(nxt, open_end())).withColumn(CUR, nxt.isNull())
    moved = lambda to, cur: (F.col(VT) != F.col(to)) | (F.col(CUR) != F.col(cur))
    written = F.when(src == 0, moved("_old_to", "_old_cur")).when(restated, moved("_hit_to", "_hit_cur")).otherwise(F.lit(True))
    out = u.select(*keys, *tracked, VF, VT, CUR, written.alias(WRITTEN), ((src == 1) & ~hit).alias(INSERTED))
    untouched = history.filter(~known).select(*keys, *tracked, VF, VT, CUR, F.lit(False).alias(WRITTEN), F.lit(False).alias(INSERTED))
    out = out.unionByName(untouched)
    staged = out.filter(WRITTEN).select(*keys, VF, *tracked, VT, CUR, F.when(F.col(INSERTED), "insert").otherwise("shrink").alias("_kind"))

    on_time = vf >= F.col("_last_h")
    cols = [*keys, *tracked, F.col(VF).alias(eff)]
    won = (early.filter(src == 1).select(*cols, F.when(F.col("_first").isNull(), F.lit(UNKNOWN_KEY))
                                         .otherwise(F.lit(BEFORE_FIRST)).alias("outcome"))
           .unionByName(labelled.filter(src == 1).select(
               *cols, F.when(hit & ~restated, F.lit(SAME_DAY))
               .when(restated | ~F.col("_chg"), F.when(on_time, F.lit(NO_OP)).otherwise(F.lit(LATE_NO_OP)))
               .when(on_time, F.lit(FORWARD)).otherwise(F.lit(LATE_SPLIT)).alias("outcome"))))
    # the rest of the statements of a decided (key, date), as a multiset difference
    rows = dated.drop("_seq")
    ambiguous = rows.join(unclear, [*keys, eff], "left_semi").select(*rows.columns)
    superseded = rows.exceptAll(top.select(*rows.columns)).join(unclear, [*keys, eff], "left_anti").select(*rows.columns)
    outcomes = (
        won.unionByName(batch.filter(F.col(eff).isNull()).select(*keys, *tracked, eff, F.lit(NULL_DATE).alias("outcome")))
        .unionByName(batch.filter(~known & F.col(eff).isNotNull()).select(*keys, *tracked, eff, F.lit(UNKNOWN_KEY).alias("outcome")))
        .unionByName(ambiguous.withColumn("outcome", F.lit(AMBIGUOUS)))
        .unionByName(superseded.withColumn("outcome", F.lit(SUPERSEDED))))
    return MergeResult(out.drop(*FLAGS), outcomes, staged, out.filter(WRITTEN).drop(*FLAGS), out)


def check_timeline(history: DataFrame, keys: Sequence[str] = ACCOUNT_KEYS, split_days: int | None = None) -> DataFrame:
    """One row of counts: gaps, overlaps, non-positive windows, keys without exactly one current
    row, current flags disagreeing with the open end. All zero for a sound history.

    ``split_days``: None uses one window per key; a number of days splits keys into date
    ranges (``lead`` inside a range, the next range's first start carried by a window over a
    per-(key, range) summary) and counts current rows per key with a partial aggregate.
    """
    keys = list(keys)
    if split_days is None:
        by_key = Window.partitionBy(*keys)
        x = (history.withColumn("_next", F.lead(VF).over(by_key.orderBy(VF, VT)))
             .withColumn("_ncur", F.sum(F.col(CUR).cast("int")).over(by_key)))
        last = F.col("_next").isNull()
        bad_current = F.count_if(last & (F.col("_ncur") != 1))
    else:
        h = history.withColumn("_bk", F.floor(F.unix_date(F.col(VF)) / F.lit(split_days)))
        firsts = h.groupBy(*keys, "_bk").agg(F.min(VF).alias("_first"))
        nxt = firsts.select(*keys, "_bk", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_bk"))
                            .alias("_next_bk"))
        x = h.join(nxt, [*keys, "_bk"], "left").withColumn(
            "_next", F.coalesce(F.lead(VF).over(Window.partitionBy(*keys, "_bk").orderBy(VF, VT)),
                                F.col("_next_bk")))
        last = F.col("_next").isNull()
        per_key = history.groupBy(*keys).agg(F.count_if(F.col(CUR)).alias("_ncur"))
        bad_current = None
    res = x.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(last).alias("n_keys"),
        F.count_if(~last & (F.col(VT) < F.col("_next"))).alias("gaps"),
        F.count_if(~last & (F.col(VT) > F.col("_next"))).alias("overlapping"),
        F.count_if(F.col(VT) <= F.col(VF)).alias("non_positive"),
        (bad_current if bad_current is not None else F.lit(0).cast("bigint")).alias("bad_current"),
        F.count_if(F.col(CUR) != (F.col(VT) == open_end())).alias("flag_mismatch"),
        F.count_if(last & (F.col(VT) != open_end())).alias("open_end_missing"),
    )
    if split_days is None:
        return res
    # add the per-key current count as a second one-row aggregate (union + sum, no cross join)
    cur = per_key.agg(F.count_if(F.col("_ncur") != 1).alias("bad_current"))
    cols = res.columns
    both = res.unionByName(cur, allowMissingColumns=True)
    return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in cols])


def trace(history: DataFrame, keys: Sequence[str] = ACCOUNT_KEYS, tracked: Sequence[str] = ACCOUNT_TRACKED) -> DataFrame:
    """Every key's windows in order, with a sequence number and the previous values."""
    keys, tracked = list(keys), list(tracked)
    w = Window.partitionBy(*keys).orderBy(VF, VT, *tracked)
    return history.select(
        *keys, VF, VT, CUR, *tracked,
        F.row_number().over(w).alias("seq"),
        *[F.lag(t).over(w).alias(f"prev_{t}") for t in tracked])
