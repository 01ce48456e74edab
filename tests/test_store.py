"""The stored history: copy-on-write merges, version checkpoints and the write audit."""

import datetime as dt
import glob
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import scd2, temporal
from ledgerspark.plans.store import BUCKET, HistoryStore, bucket_of, buckets_in

STATE = "account_id string, account_status string, credit_limit int, effective_date date"


def states(spark, rows):
    return spark.createDataFrame(rows, STATE)


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def initial(spark, n):
    return scd2.initial_history(states(spark, [(f"A{k}", "active", 100 + k, day(0)) for k in range(n)] + [(None, "active", 1, day(0))]))


def random_batch(rnd, n, size):
    """On-time and late changes, restatements, unknown and NULL keys, several changes of a key."""
    return [(rnd.choice([None, "A999", *[f"A{k}" for k in range(n)]]), rnd.choice(["active", "frozen"]), rnd.choice([100, 101, 200]),
             rnd.choice([None, *[day(k) for k in range(-2, 40)]])) for _ in range(size)]


def files(store):
    return {os.path.relpath(f, store.table): os.stat(f).st_mtime_ns for f in glob.glob(f"{store.table}/{BUCKET}=*/*.parquet")}


def scan_metrics(df, part):
    """(files, rows) read by the scans of paths that hold ``part``."""
    df.collect()
    found = [0, 0]

    def visit(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return visit(node.executedPlan())
        if "QueryStage" in node.getClass().getSimpleName():
            return visit(node.plan())
        if name.startswith("Scan parquet") and part in node.relation().location().rootPaths().mkString(","):
            for k, metric in enumerate(("numFiles", "numOutputRows")):
                found[k] += node.metrics().get(metric).get().value()
        children = node.children()
        for k in range(children.size()):
            visit(children.apply(k))

    visit(df._jdf.queryExecution().executedPlan())
    return tuple(found)


@pytest.mark.parametrize("mode, seed", [("strict", 1), ("timeline", 2)])
def test_equals_the_merge_of_the_whole_history(spark, tmp_path, mode, seed):
    rnd, store, n = random.Random(seed), HistoryStore(str(tmp_path / "h"), buckets=5, every=2), 12
    history = initial(spark, n)
    store.create(history)
    versions = [sorted(history.collect(), key=str)]
    for version in range(1, 5):
        batch = states(spark, random_batch(rnd, n, 12))
        want = scd2.merge(spark.createDataFrame(versions[-1], history.schema), batch, mode=mode)
        got = store.merge(batch, version, mode=mode)
        columns = ["account_id", "account_status", "credit_limit", "effective_date", "outcome"]
        assert sorted(got.select(columns).collect(), key=str) == sorted(want.outcomes.select(columns).collect(), key=str)
        versions.append(sorted(want.history.select(history.columns).collect(), key=str))
        assert sorted(store.current(spark).collect(), key=str) == versions[-1]
    # Any version, from the last state before it and the changes behind that; the replay says the same.
    log = spark.read.parquet(store.log)
    for version, want in enumerate(versions):
        assert sorted(store.as_of(spark, version).collect(), key=str) == want
        assert sorted(temporal.as_of_version(log, version).filter("account_id is not null").select(history.columns).collect(), key=str) == [
            r for r in want if r.account_id is not None]
    assert {r.status for r in store.check_writes(spark).collect()} == {"ok"}
    assert store.check_table(spark).first().ok


def test_a_small_batch_touches_its_buckets_only(spark, tmp_path):
    store = HistoryStore(str(tmp_path / "h"), buckets=64, every=100)
    store.create(initial(spark, 2_000))
    before = files(store)
    assert len({f.split("/")[0] for f in before}) == 64
    batch = states(spark, [(f"A{k * 37}", "frozen", 5, day(9)) for k in range(10)])
    touched = buckets_in(batch, store.keys, store.buckets)
    assert 1 < len(touched) <= 10
    read, rows = scan_metrics(store.current(spark, touched), "/table")
    assert read <= 10 and rows == store.current(spark).filter(bucket_of(store.keys, 64).isin(touched)).count() < 500
    store.merge(batch, 1)
    after = files(store)
    kept = {f for f in before if before[f] == after.get(f)}
    assert {f.split("/")[0] for f in after if f not in kept} == {f"{BUCKET}={b}" for b in touched}
    assert len(kept) == sum(int(f.split("/")[0].split("=")[1]) not in touched for f in before)
    assert store.current(spark).count() == 2_011 and len(glob.glob(f"{store.root}/staged/v=1/*.parquet")) <= 10


def test_a_version_reads_one_state_and_the_changes_behind_it(spark, tmp_path):
    store = HistoryStore(str(tmp_path / "h"), buckets=4, every=3)
    store.create(initial(spark, 50))
    for version in range(1, 8):
        store.merge(states(spark, [(f"A{k}", "frozen", 1_000 * version, day(version)) for k in range(version)]), version)
    for version, changes in ((0, 0), (2, 2 + 4), (3, 0), (5, 8 + 10), (7, 14)):
        got = store.as_of(spark, version)
        assert scan_metrics(got, "/states")[1] == store.as_of(spark, version - version % 3).count()
        # (the log's changes are read twice: to leave rows out of the state, and to add them)
        assert scan_metrics(got, "/log")[1] in (changes, 2 * changes)
        assert got.count() == 51 + version * (version + 1) // 2


def test_a_rerun_changes_nothing(spark, tmp_path):
    store = HistoryStore(str(tmp_path / "h"), buckets=4, every=2)
    store.create(initial(spark, 20))
    batch = states(spark, [("A1", "frozen", 7, day(5)), ("A2", "active", 8, day(-1)), ("A3", "frozen", 9, day(6))])
    store.merge(batch, 1)
    want = sorted(store.current(spark).collect(), key=str)
    # As if the job had died after replacing a part of the buckets.
    shutil.rmtree(glob.glob(f"{store.table}/{BUCKET}=*")[0])
    assert [r.outcome for r in store.merge(batch, 1).orderBy("account_id").collect()] == ["forward_change", "before_first_window", "forward_change"]
    assert sorted(store.current(spark).collect(), key=str) != []
    rows = {tuple(r) for r in store.current(spark).collect()}
    assert rows <= {tuple(r) for r in want}
    assert [tuple(r) for r in store.version_log(spark).orderBy("version").collect()] == [(0, "WRITE", 21), (1, "MERGE", 4)]
    store.merge(states(spark, []), 2)
    assert [(r.version, r.rows_written, r.rows_read, r.status) for r in store.check_writes(spark).orderBy("version").collect()] == [
        (0, 21, 21, "ok"), (1, 4, 4, "ok"), (2, 0, 0, "ok")]


def test_the_audit_names_what_happened_to_a_write(spark, tmp_path):
    def built(name):
        store = HistoryStore(str(tmp_path / name), buckets=2, every=10)
        store.create(initial(spark, 30))
        for version in (1, 2):
            store.merge(states(spark, [(f"A{k}", "frozen", 50 * version + k, day(version)) for k in range(6)]), version)
        return store, sorted(glob.glob(f"{store.log}/_version=1/*.parquet"))

    def status(store):
        return {r.version: r.status for r in store.check_writes(spark).collect()}

    store, parts = built("lost")
    os.remove(parts[0])
    assert status(store) == {0: "ok", 1: "lost", 2: "ok"}
    store, parts = built("repeated")
    shutil.copy(parts[0], parts[0].replace("part-", "part-9"))
    assert status(store) == {0: "ok", 1: "repeated", 2: "ok"}
    store, parts = built("altered")
    rows = [tuple(r) for r in spark.read.parquet(f"{store.log}/_version=1").collect()]
    schema = spark.read.parquet(f"{store.log}/_version=1").schema
    spark.createDataFrame([(r[0], "closed", *r[2:]) if k == 0 else r for k, r in enumerate(rows)], schema).write.mode("overwrite").parquet(f"{store.log}/_version=1")
    assert status(store) == {0: "ok", 1: "altered", 2: "ok"}
    # The same rows in other files and another order are the same write.
    store, parts = built("moved")
    again = spark.createDataFrame([tuple(r) for r in reversed(spark.read.parquet(f"{store.log}/_version=1").collect())], schema).repartition(5)
    again.write.mode("overwrite").parquet(f"{store.log}/_version=1")
    assert status(store) == {0: "ok", 1: "ok", 2: "ok"}
    again.write.parquet(f"{store.log}/_version=7")
    assert status(store)[7] == "unknown"
    shutil.rmtree(glob.glob(f"{store.table}/{BUCKET}=*")[0])
    check = store.check_table(spark).first()
    assert not check.ok and check.rows_read < check.rows_expected
