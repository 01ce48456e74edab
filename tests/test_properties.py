"""Property checks of the SCD2 merges on seeded random histories and batches.

Each case has a few hundred keys with sound histories and a batch that mixes every situation:
forward and late changes, no-ops, same-day changes, several changes per key and window,
unknown keys, dates before the first window, NULL dates and NULL values, exact duplicates.
"""

import datetime as dt
import random
from collections import Counter

import pytest

from ledgerspark.operators import scd2, temporal

HIST = "account_id string, account_status string, credit_limit int, valid_from date, valid_to date, is_current boolean"
BATCH = "account_id string, account_status string, credit_limit int, effective_date date"
END = dt.date(9999, 12, 31)
BASE = dt.date(2000, 1, 1)
STATUSES = ["active", "frozen", "closed", None]


def random_case(seed: int, n_keys: int = 300):
    rnd = random.Random(seed)
    hist, batch = [], []
    for k in range(n_keys):
        key = f"K{k}"
        days = sorted(rnd.sample(range(0, 3000), rnd.randint(1, 5)))
        for i, d in enumerate(days):
            end = BASE + dt.timedelta(days=days[i + 1]) if i + 1 < len(days) else END
            hist.append((key, rnd.choice(STATUSES[:3]), rnd.choice([100, 200, 300]), BASE + dt.timedelta(days=d),
                         end, i + 1 == len(days)))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
            kind = rnd.random()
            if kind < 0.15:
                day = BASE + dt.timedelta(days=rnd.choice(days))              # same day as a window start
            elif kind < 0.2:
                day = None
            elif kind < 0.25:
                day = BASE - dt.timedelta(days=rnd.randint(1, 100))           # before the first window
            else:
                day = BASE + dt.timedelta(days=rnd.randint(0, 3500))
            row = (key, rnd.choice(STATUSES), rnd.choice([100, 200, 300, None]), day)
            batch.append(row)
            if rnd.random() < 0.05:
                batch.append(row)                                            # exact duplicate
    for k in range(5):
        batch.append((f"NEW{k}", "active", 100, BASE))                       # unknown keys
    return hist, batch


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def sound(history):
    r = scd2.check_timeline(history).first()
    return (r.gaps, r.overlapping, r.non_positive, r.bad_current, r.flag_mismatch, r.open_end_missing) == (0,) * 6


@pytest.mark.parametrize("seed", [1, 2])
def test_merge_properties(spark, seed):
    hist_rows, batch_rows = random_case(seed)
    history = spark.createDataFrame(hist_rows, HIST)
    batch = spark.createDataFrame(batch_rows, BATCH)
    assert sound(history)
    w = scd2.merge(history, batch)
    assert w.outcomes.count() == len(batch_rows)
    labels = {r.outcome for r in w.outcomes.select("outcome").distinct().collect()}
    assert {"forward_change", "late_split", "ambiguous_match", "unknown_key", "null_effective_date",
            "before_first_window"} <= labels
    assert sound(w.history)
    # idempotence holds per key with one statement per batch: every row is compared with the
    # state before the batch, so with two statements the no-op one can become a change later
    n = Counter(r[0] for r in batch_rows)
    single = spark.createDataFrame([r for r in batch_rows if n[r[0]] == 1], BATCH)
    once = scd2.merge(history, single).history
    assert same(scd2.merge(once, single).history, once)
    t = scd2.merge_timeline(history, batch)
    assert sound(t.history)
    assert t.outcomes.count() == len(batch_rows)
    # the change set is exactly the rows of the new history that the old one lacks, and the change
    # log reproduces every version, also after a rerun of the last one
    for res in (w, t):
        assert same(res.changes, res.history.exceptAll(history))
        assert same(res.staged.drop("_kind").dropDuplicates().select("account_id", "valid_from"), res.changes.select("account_id", "valid_from"))
        log = temporal.append_changes(temporal.start_log(history), res.changes, 1)
        assert same(temporal.as_of_version(log, 0), history) and same(temporal.as_of_version(log, 1), res.history)
