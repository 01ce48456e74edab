"""Physical-plan properties the scale design relies on (checked on the initial plan)."""

import re

from ledgerspark.functions.masking import TRANSACTION_MASK, mask
from ledgerspark.operators import checks as C
from ledgerspark.operators import scd2, temporal
from ledgerspark.operators.dedup import dedup_latest
from ledgerspark.sources import fixtures


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges_on(text: str, col: str) -> int:
    return len(re.findall(rf"Exchange hashpartitioning\({col}#\d+(?:L)?, ", text))


def test_dedup_limits_each_key_before_the_shuffle(spark, sf_small):
    bronze = mask(fixtures.tx_raw(spark, sf_small), TRANSACTION_MASK)
    p = plan(dedup_latest(bronze, "transaction_id", "ingestion_timestamp"))
    assert re.search(r"WindowGroupLimit \[transaction_id#\d+\].*Partial", p)
    assert re.search(r"WindowGroupLimit \[transaction_id#\d+\].*Final", p)
    assert exchanges_on(p, "transaction_id") == 1


def test_merge_reads_history_twice_and_only_joins_on_keys(spark, sf_small, tmp_path):
    """Stored inputs, no broadcasts: two reads of history and three of the batch, equi joins, bounded
    windows, and twelve keyed exchanges (points, labels 3, counts 2, flags 2 x 2, MERGE 2)."""
    scd2.initial_history(fixtures.acct_initial(spark, sf_small)).write.parquet(str(tmp_path / "history"))
    fixtures.acct_update(spark, sf_small).write.parquet(str(tmp_path / "batch"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        res = scd2.merge(spark.read.parquet(str(tmp_path / "history")), spark.read.parquet(str(tmp_path / "batch")))
        df = res.history
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    reads = sum("valid_from" in x for x in re.findall(r"FileScan parquet .*", final))
    shared = len(re.findall(r"ReusedExchange", final))
    assert "NestedLoop" not in final and "Cartesian" not in final
    batches = sum("effective_date" in x for x in re.findall(r"FileScan parquet .*", final))
    exchanges = len(re.findall(r"(?<!Reused)Exchange hashpartitioning", final))
    assert (reads, batches, exchanges) == (2, 3, 12)


def test_check_suite_shuffles_keys_only(spark, sf_small):
    raw = fixtures.tx_raw(spark, sf_small)
    p = plan(C.run_suite(raw, C.transaction_expectations()))
    assert exchanges_on(p, "transaction_id") == 1
    assert "SortMergeJoin" not in p and "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_scans_are_pruned_and_filters_pushed(spark, sf_small, tmp_path):
    p = plan(fixtures.acct_initial(spark, sf_small))
    assert "ReadSchema: struct<c_custkey:bigint>" in p
    h0 = scd2.initial_history(fixtures.acct_initial(spark, sf_small))
    h0.write.parquet(str(tmp_path / "h"))
    stored = spark.read.parquet(str(tmp_path / "h"))
    p = plan(temporal.state_on(stored, "1997-01-01").select("account_id", "account_status"))
    assert re.search(r"PushedFilters: \[.*LessThanOrEqual\(valid_from", p)
    assert "ReadSchema: struct<account_id:string,account_status:string,valid_from:date,valid_to:date>" in p


def test_as_of_lookup_has_no_range_join(spark, sf_small):
    h0 = scd2.initial_history(fixtures.acct_initial(spark, sf_small))
    facts = fixtures.tx_raw(spark, sf_small).select("transaction_id", "account_id", "event_timestamp")
    p = plan(temporal.as_of_join(facts, h0))
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
    # the only joins are equi joins on (account_id, day) or the fixture's own key joins
    for line in p.splitlines():
        if "Join" in line and "account_id" in line:
            assert "_asof_d" in line


def test_windows_are_listed_where_their_key_has_facts(spark, sf_small):
    """The windows of the span join are never broadcast (their number is not that of the history's
    rows), and a long window costs one row per span with facts of its key."""
    h0 = scd2.initial_history(fixtures.acct_initial(spark, sf_small))
    facts = fixtures.tx_raw(spark, sf_small).select("transaction_id", "account_id", "event_timestamp")
    p = plan(temporal.as_of_join_spans(facts, h0))
    assert not [line for line in p.splitlines() if "BroadcastHashJoin" in line and "_w_span" in line]
    few = spark.sql("select 'A' account_id, timestamp'2000-01-01' ts union all select 'A', timestamp'2020-01-01' union all select 'Z', timestamp'2010-01-01'")
    long = spark.sql("select 'A' account_id, 'x' account_status, 1 credit_limit, date'1999-01-01' valid_from, date'9999-12-31' valid_to")
    got = temporal.as_of_join_spans(few, long, date_col="ts", span_days=1)
    # (the spans of the key's facts, not a sequence of all spans)
    assert re.findall(r"Generate explode\(([a-z]+)", plan(got)) == ["filter"]
    assert sorted((r.account_id, r.ts.year, r.account_status) for r in got.collect()) == [("A", 2000, "x"), ("A", 2020, "x"), ("Z", 2010, None)]
