"""SCD2 merge corner cases, invariants and the properties of SURVEY §5."""

import datetime as dt

import pytest

from ledgerspark.operators import scd2, temporal
from ledgerspark.operators.snapshot import snapshot_check
from ledgerspark.plans.catalog import Ledger
from ledgerspark.sources import fixtures

D = dt.date
HIST = "account_id string, account_status string, credit_limit int, valid_from date, valid_to date, is_current boolean"
BATCH = "account_id string, account_status string, credit_limit int, effective_date date"
END = D(9999, 12, 31)


@pytest.fixture
def history(spark):
    # A: two windows; B: one window
    return spark.createDataFrame([
        ("A", "active", 1000, D(2020, 1, 1), D(2021, 1, 1), False),
        ("A", "frozen", 1000, D(2021, 1, 1), END, True),
        ("B", "active", 500, D(2020, 6, 1), END, True),
    ], HIST)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def outcomes(res):
    return {(r.account_id, r.effective_date): r.outcome for r in res.outcomes.collect()}


def test_forward_late_noop_unknown_before(spark, history):
    batch = spark.createDataFrame([
        ("A", "closed", 1000, D(2022, 1, 1)),   # forward change
        ("B", "active", 500, D(2022, 1, 1)),    # on-time no-op
        ("A", "active", 2000, D(2020, 6, 1)),   # late split of the first window
        ("B", "active", 500, D(2019, 1, 1)),    # before the first window
        ("Z", "active", 1, D(2022, 1, 1)),      # unknown key
        ("A", "active", 1, None),               # no date
    ], BATCH)
    res = scd2.merge(history, batch)
    assert outcomes(res) == {("A", D(2022, 1, 1)): "forward_change", ("B", D(2022, 1, 1)): "no_op",
                             ("A", D(2020, 6, 1)): "late_split", ("B", D(2019, 1, 1)): "before_first_window",
                             ("Z", D(2022, 1, 1)): "unknown_key", ("A", None): "null_effective_date"}
    assert rows(res.history) == sorted([
        ("A", "active", 1000, D(2020, 1, 1), D(2020, 6, 1), False),
        ("A", "active", 2000, D(2020, 6, 1), D(2021, 1, 1), False),
        ("A", "frozen", 1000, D(2021, 1, 1), D(2022, 1, 1), False),
        ("A", "closed", 1000, D(2022, 1, 1), END, True),
        ("B", "active", 500, D(2020, 6, 1), END, True),
    ])
    assert res.changes.count() == 4
    inv = scd2.check_timeline(res.history).first()
    assert (inv.gaps, inv.overlapping, inv.non_positive, inv.bad_current, inv.flag_mismatch) == (0, 0, 0, 0, 0)


def test_late_equal_to_next_window_keeps_adjacent_windows(spark, history):
    batch = spark.createDataFrame([("A", "frozen", 1000, D(2020, 6, 1))], BATCH)
    res = scd2.merge(history, batch)
    assert outcomes(res) == {("A", D(2020, 6, 1)): "late_split"}
    assert res.history.filter("account_id = 'A'").count() == 3


def test_same_day_change_is_ambiguous_and_strict_raises(spark, history):
    batch = spark.createDataFrame([("A", "closed", 1000, D(2021, 1, 1))], BATCH)
    res = scd2.merge(history, batch)
    assert outcomes(res) == {("A", D(2021, 1, 1)): "ambiguous_match"}
    assert rows(res.history) == rows(history)
    with pytest.raises(scd2.MergeCardinalityError):
        scd2.merge(history, batch, on_ambiguous="raise")


def test_two_changes_in_one_window(spark, history):
    batch = spark.createDataFrame([("A", "closed", 1, D(2020, 3, 1)), ("A", "closed", 2, D(2020, 9, 1))], BATCH)
    strict = scd2.merge(history, batch)
    assert set(outcomes(strict).values()) == {"ambiguous_match"}
    assert rows(strict.history) == rows(history)
    timeline = scd2.merge(history, batch, mode="timeline").history
    a = [tuple(r) for r in timeline.filter("account_id = 'A'").orderBy("valid_from").collect()]
    assert [(r[2], r[3], r[4]) for r in a] == [(1000, D(2020, 1, 1), D(2020, 3, 1)), (1, D(2020, 3, 1), D(2020, 9, 1)),
                                              (2, D(2020, 9, 1), D(2021, 1, 1)), (1000, D(2021, 1, 1), END)]


def test_null_attribute_is_unchanged_unless_null_safe(spark, history):
    batch = spark.createDataFrame([("B", None, 500, D(2022, 1, 1))], BATCH)
    assert outcomes(scd2.merge(history, batch)) == {("B", D(2022, 1, 1)): "no_op"}
    assert outcomes(scd2.merge(history, batch, null_safe=True)) == {("B", D(2022, 1, 1)): "forward_change"}


def test_merge_is_idempotent_and_strict_equals_timeline(spark, sf_small):
    L = Ledger(spark, sf_small)
    once = L.h2
    again = scd2.merge(once, L.mixed).history
    assert rows(once) == rows(again)
    h1t = scd2.merge_timeline(L.h0, fixtures.acct_update(spark, sf_small)).history
    h2t = scd2.merge_timeline(h1t, L.mixed).history
    assert once.exceptAll(h2t).count() == 0 and h2t.exceptAll(once).count() == 0


def test_change_log_reproduces_every_version(spark, sf_small):
    L = Ledger(spark, sf_small)
    for version, hist in ((0, L.h0), (1, L.m1.history), (2, L.h2)):
        state = temporal.as_of_version(L.log, version)
        assert state.exceptAll(hist).count() == 0 and hist.exceptAll(state).count() == 0
    log = {r.version: r.num_output_rows for r in temporal.version_log(L.log).collect()}
    assert log == {0: 150, 1: 30, 2: 46}


def test_as_of_join_by_spans_says_the_same(spark, history):
    """Every day around the windows, unknown and NULL keys, NULL dates; spans of every length."""
    rows = [(i, a, dt.datetime(2019, 6, 1) + dt.timedelta(days=i * 9) if i % 11 else None) for i, a in enumerate(["A", "B", "C", "Z", None] * 40)]
    facts = spark.createDataFrame(rows, "id int, account_id string, ts timestamp")
    want = sorted((tuple(r) for r in temporal.as_of_join(facts, history, date_col="ts").collect()), key=str)
    for days in (1, 30, 10_000):
        got = temporal.as_of_join_spans(facts, history, date_col="ts", span_days=days)
        assert sorted((tuple(r) for r in got.collect()), key=str) == want
    inner = temporal.as_of_join_spans(facts, history, date_col="ts", how="inner")
    assert inner.count() == sum(r[-1] is not None for r in want)
    assert temporal.as_of_join_spans(facts.limit(0), history, date_col="ts").count() == 0


def test_state_on_and_as_of_join(spark, history):
    s = temporal.state_on(history, "2020-12-31").select("account_id", "account_status").collect()
    assert sorted(tuple(r) for r in s) == [("A", "active"), ("B", "active")]
    facts = spark.createDataFrame([("t1", "A", dt.datetime(2021, 1, 1, 0, 0)), ("t2", "A", dt.datetime(2019, 1, 1)),
                                   ("t3", "C", dt.datetime(2021, 1, 1)), ("t4", None, dt.datetime(2021, 1, 1))], "transaction_id string, account_id string, ts timestamp")
    out = {r.transaction_id: r.account_status for r in temporal.as_of_join(facts, history, date_col="ts").collect()}
    assert out == {"t1": "frozen", "t2": None, "t3": None, "t4": None}


def test_snapshot_vs_merge(spark, history):
    cur0 = scd2.current(history).drop("is_current")
    snap = snapshot_check(None, cur0, ["account_id"], ["account_status", "credit_limit"], "2024-01-01 00:00:00")
    assert snap.count() == 2
    late = spark.createDataFrame([("A", "active", 2000, D(2020, 6, 1))], BATCH)
    merged = scd2.merge(history, late).history
    snap2 = snapshot_check(snap, scd2.current(merged).drop("is_current"), ["account_id"],
                           ["account_status", "credit_limit"], "2024-01-02 00:00:00")
    # the late record splits a past window in the merge but leaves the snapshot untouched
    assert merged.count() == 4 and snap2.count() == 2
    fwd = spark.createDataFrame([("B", "closed", 500, D(2022, 1, 1))], BATCH)
    merged2 = scd2.merge(merged, fwd).history
    snap3 = snapshot_check(snap2, scd2.current(merged2).drop("is_current"), ["account_id"],
                           ["account_status", "credit_limit"], "2024-01-03 00:00:00")
    b = snap3.filter("account_id = 'B'").orderBy("dbt_valid_from").collect()
    assert [r.dbt_valid_to for r in b][0] == dt.datetime(2024, 1, 3)
    assert b[1].account_status == "closed" and b[1].dbt_valid_from == dt.datetime(2024, 1, 3)


def test_row_conservation(spark, sf_small):
    L = Ledger(spark, sf_small)
    assert L.silver.count() + L.dead.count() == L.deduped.count()


@pytest.mark.parametrize("split_days", [None, 30, 1])
def test_check_timeline_finds_defects(spark, split_days):
    bad = spark.createDataFrame([
        ("A", "x", 1, D(2020, 1, 1), D(2020, 3, 1), False),
        ("A", "y", 1, D(2020, 4, 1), D(2021, 1, 1), False),    # gap before it
        ("A", "z", 1, D(2020, 12, 1), END, True),              # overlaps the previous window
        ("B", "x", 1, D(2020, 1, 1), D(2020, 1, 1), True),     # non-positive, open end missing, flag mismatch
        ("C", "x", 1, D(2020, 1, 1), END, True),
        ("C", "y", 1, D(2023, 1, 1), END, True),               # two current rows, overlap
    ], HIST)
    r = scd2.check_timeline(bad, split_days=split_days).first()
    assert (r.total_rows, r.n_keys, r.gaps, r.overlapping, r.non_positive, r.bad_current, r.flag_mismatch,
            r.open_end_missing) == (6, 3, 1, 2, 1, 1, 1, 1)


def test_hot_key_in_a_job(spark, tmp_path):
    from ledgerspark.plans import jobs
    layout = jobs.Layout(str(tmp_path / "lake"))
    acc = tmp_path / "acc0.csv"
    acc.write_text("account_id,account_status,credit_limit,effective_date\nH,active,1,2020-01-01\n"
                   "Q,active,1,2020-01-01\n")
    jobs.load_initial_history(spark, layout, str(acc))
    rows = [("H", "active", i + 2, D(2020, 1, 1) + dt.timedelta(days=i)) for i in range(1, 40)]
    out = jobs.apply_account_batch(spark, layout, spark.createDataFrame(rows, BATCH), 1)
    # every change of the hot key shrinks the same current window: all ambiguous under strict rules
    assert {r.outcome for r in out.collect()} == {"ambiguous_match"}
    assert jobs.history(spark, layout, 1).count() == 2


@pytest.mark.parametrize("mode", ["strict", "timeline"])
def test_null_keys_match_nothing(spark, history, mode):
    with_null = history.unionByName(spark.createDataFrame([(None, "active", 9, D(2020, 1, 1), END, True)], HIST))
    batch = spark.createDataFrame([(None, "closed", 9, D(2021, 5, 1)), (None, "closed", 9, None), ("B", "closed", 500, D(2022, 1, 1))], BATCH)
    res = scd2.merge(with_null, batch, mode=mode)
    assert outcomes(res) == {(None, D(2021, 5, 1)): "unknown_key", (None, None): "null_effective_date", ("B", D(2022, 1, 1)): "forward_change"}
    kept = [tuple(r) for r in res.history.filter("account_id is null").collect()]
    assert kept == [(None, "active", 9, D(2020, 1, 1), END, True)]


def test_timeline_same_date_statements(spark, history):
    """The greatest order_col wins; without one, different statements of a date are ambiguous."""
    seq = spark.createDataFrame([("A", "closed", 5, D(2020, 3, 1), 1), ("A", "closed", 7, D(2020, 3, 1), 2),
                                 ("A", "closed", 6, D(2020, 3, 1), 3)], BATCH + ", seq int")
    res = scd2.merge(history, seq, mode="timeline", order_col="seq")
    a = [(r.credit_limit, r.valid_from, r.valid_to) for r in res.history.filter("account_id = 'A'").orderBy("valid_from").collect()]
    assert a == [(1000, D(2020, 1, 1), D(2020, 3, 1)), (6, D(2020, 3, 1), D(2021, 1, 1)), (1000, D(2021, 1, 1), END)]
    assert sorted((r.credit_limit, r.outcome) for r in res.outcomes.collect()) == [
        (5, "superseded_same_day"), (6, "late_split"), (7, "superseded_same_day")]
    res = scd2.merge(history, seq.drop("seq"), mode="timeline")
    assert {r.outcome for r in res.outcomes.collect()} == {"ambiguous_match"} and rows(res.history) == rows(history)


def test_timeline_replacing_a_window_keeps_it_and_the_log(spark, history):
    """A statement of a window's own date that equals the state before it: the window stays, with
    the new values, and the change log agrees with the history."""
    batch = spark.createDataFrame([("A", "active", 1000, D(2021, 1, 1))], BATCH)
    res = scd2.merge_timeline(history, batch)
    assert rows(res.history.filter("account_id = 'A'")) == [("A", "active", 1000, D(2020, 1, 1), D(2021, 1, 1), False),
                                                            ("A", "active", 1000, D(2021, 1, 1), END, True)]
    assert outcomes(res) == {("A", D(2021, 1, 1)): "same_day_replace"}
    log = temporal.append_changes(temporal.start_log(history), res.changes, 1)
    assert rows(temporal.as_of_version(log, 1)) == rows(res.history)
    # saying again what the window says changes nothing
    again = scd2.merge_timeline(res.history, batch)
    assert again.changes.count() == 0 and set(outcomes(again).values()) == {"no_op"}


def test_timeline_outcomes_match_strict_on_fixtures(spark, sf_small):
    L = Ledger(spark, sf_small)
    h1 = scd2.merge_timeline(L.h0, fixtures.acct_update(spark, sf_small)).history
    t = scd2.merge_timeline(h1, L.mixed).outcomes
    s = L.m2.outcomes
    assert t.exceptAll(s).count() == 0 and s.exceptAll(t).count() == 0


def test_timeline_outcome_labels(spark, history):
    batch = spark.createDataFrame([
        ("A", "closed", 7, D(2020, 3, 1)), ("A", "closed", 7, D(2020, 3, 1)),   # late split, and its copy
        ("A", "frozen", 1000, D(2022, 1, 1)),                                  # no-op
        ("B", "closed", 500, D(2020, 6, 1)),                                   # same-day replace
        ("Z", "x", 1, D(2022, 1, 1)), ("B", "x", 1, D(2019, 1, 1)), ("B", "x", 1, None),
    ], BATCH)
    found = [((r.account_id, r.credit_limit, r.effective_date), r.outcome)
             for r in scd2.merge_timeline(history, batch).outcomes.collect()]
    assert sorted(o for k, o in found if k == ("A", 7, D(2020, 3, 1))) == ["late_split", "superseded_same_day"]
    got = {k: o for k, o in found if k != ("A", 7, D(2020, 3, 1))}
    assert got == {("A", 1000, D(2022, 1, 1)): "no_op", ("B", 500, D(2020, 6, 1)): "same_day_replace",
                   ("Z", 1, D(2022, 1, 1)): "unknown_key", ("B", 1, D(2019, 1, 1)): "before_first_window",
                   ("B", 1, None): "null_effective_date"}


def test_timeline_same_day_replace_of_first_window_keeps_the_key(spark, history):
    batch = spark.createDataFrame([("B", "closed", 500, D(2020, 6, 1))], BATCH)
    res = scd2.merge_timeline(history, batch).history
    assert [tuple(r) for r in res.filter("account_id = 'B'").collect()] == [("B", "closed", 500, D(2020, 6, 1), END, True)]
