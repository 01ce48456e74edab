"""Hand-written edge rows of FIXTURES.md (pytest only)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.functions.masking import TRANSACTION_MASK, keep_last, mask
from ledgerspark.functions.numeric import half_up_ratio
from ledgerspark.functions.rules import transaction_rules
from ledgerspark.operators import checks as C
from ledgerspark.operators.dedup import dedup_latest, dedup_stats
from ledgerspark.operators.routing import batch_metrics, metrics, route, tag
from ledgerspark.plans import audit, models
from ledgerspark.sources.schemas import ACCEPTED_CURRENCIES, TRANSACTION_SCHEMA

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)
# file sources make every field nullable whatever the declaration says; so do these fixtures
NULLABLE = T.StructType([T.StructField(f.name, f.dataType, True) for f in TRANSACTION_SCHEMA])


def tx(spark, rows):
    """rows: dicts with any of the transaction fields; the rest get valid defaults."""
    base = dict(transaction_id="T1", account_id="A1", customer_name="Ann", ssn_last4="1234", amount=10.0,
                currency="USD", transaction_type="purchase", event_timestamp=T0,
                ingestion_timestamp=T0 + dt.timedelta(seconds=60))
    data = [tuple({**base, **r}[f.name] for f in TRANSACTION_SCHEMA) for r in rows]
    return spark.createDataFrame(data, NULLABLE)


def reasons_of(spark, rows):
    tagged = tag(tx(spark, rows), transaction_rules())
    return [r.rejection_reason for r in tagged.orderBy("transaction_id").collect()]


def test_null_keys_keep_and_collapse(spark):
    df = tx(spark, [dict(transaction_id=None, amount=1.0), dict(transaction_id=None, amount=2.0),
                    dict(transaction_id="T1"), dict(transaction_id="T1", ingestion_timestamp=T0)])
    kept = dedup_latest(df, "transaction_id", "ingestion_timestamp")
    assert kept.count() == 3
    valid, dead = route(tag(kept, transaction_rules()))
    assert dead.filter(F.col("transaction_id").isNull()).count() == 2
    assert dedup_latest(df, "transaction_id", "ingestion_timestamp", null_keys="collapse").count() == 2
    s = dedup_stats(df, "transaction_id").first()
    assert (s.before, s.after, s.removed) == (4, 3, 1)


def test_dedup_keeps_latest_and_breaks_ties(spark):
    df = tx(spark, [dict(amount=1.0, ingestion_timestamp=T0), dict(amount=2.0, ingestion_timestamp=T0),
                    dict(amount=3.0, ingestion_timestamp=T0 - dt.timedelta(hours=1))])
    out = dedup_latest(df, "transaction_id", "ingestion_timestamp", ties=["amount"]).collect()
    assert [r.amount for r in out] == [2.0]


def test_rules_amount_and_currency(spark):
    rows = [dict(transaction_id="a", amount=None), dict(transaction_id="b", amount=0.0),
            dict(transaction_id="c", amount=float("nan")), dict(transaction_id="d", amount=-1.0, currency="usd"),
            dict(transaction_id="e", currency=None), dict(transaction_id="f", currency="JPY"),
            dict(transaction_id="g", currency="USD\n")]
    assert reasons_of(spark, rows) == ["amount_invalid", "amount_invalid", "", "amount_invalid; currency_invalid",
                                       "", "", ""]


def test_unparsable_amount_from_csv_is_null(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("transaction_id,account_id,customer_name,ssn_last4,amount,currency,transaction_type,"
                 "event_timestamp,ingestion_timestamp\n"
                 "T1,A1,Ann,1234,abc,USD,purchase,2024-01-01T10:00:00Z,2024-01-01T10:05:00Z\n"
                 "T2,A1,Ann,1234,NaN,USD,purchase,2024-01-01T10:00:00Z,2024-01-01T10:05:00Z\n")
    from ledgerspark.sources.ingest import read_batch
    df = read_batch(spark, str(p), TRANSACTION_SCHEMA, batch_id=7)
    rows = {r.transaction_id: r for r in tag(df, transaction_rules()).collect()}
    assert rows["T1"].amount is None and rows["T1"].rejection_reason == "amount_invalid"
    assert math.isnan(rows["T2"].amount) and rows["T2"].rejection_reason == ""
    assert rows["T1"]._batch == 7


def test_boundary_amounts_across_layers(spark):
    rows = [dict(transaction_id=str(i), amount=a) for i, a in enumerate([0.005, 0.01, 1000000.0, 1000000.01])]
    df = tx(spark, rows)
    valid, dead = route(tag(df, transaction_rules()))
    assert valid.count() == 4 and dead.count() == 0
    res = {r.check_name: r.unexpected_count for r in C.run_suite(df, C.transaction_expectations()).collect()}
    assert res["expect_column_values_to_be_between"] == 2


def test_accepted_values_and_no_negative(spark):
    stg = models.stg_transactions(tx(spark, [dict(transaction_id="a", currency="JPY"),
                                             dict(transaction_id="b", amount=0.0)]))
    acc = C.test_accepted_values(stg, "stg_transactions", "currency", ACCEPTED_CURRENCIES).first()
    assert acc.failures == 1
    neg = C.test_zero_rows(stg, "stg_transactions", "amount", F.col("amount") < 0, "no_negative").first()
    assert neg.failures == 0


def test_masking(spark):
    df = tx(spark, [dict(transaction_id="a", ssn_last4="12"), dict(transaction_id="b", ssn_last4=None),
                    dict(transaction_id="c", ssn_last4="9876", customer_name="Bob")])
    out = {r.transaction_id: r for r in mask(df, TRANSACTION_MASK).collect()}
    assert out["a"].ssn_last4 == "XX" and out["b"].ssn_last4 is None and out["c"].ssn_last4 == "XX76"
    import hashlib
    assert out["c"].customer_name == hashlib.sha256(b"Bob").hexdigest()
    salted = mask(df, TRANSACTION_MASK, salt="pepper").filter("transaction_id = 'c'").first()
    assert salted.customer_name == hashlib.sha256(b"pepperBob").hexdigest()
    assert spark.range(1).select(keep_last(F.lit("123456"), visible=3, width=6)).first()[0] == "XXX456"


def test_high_value_boundary_and_rounding(spark):
    df = tx(spark, [dict(transaction_id="a", amount=10000.00), dict(transaction_id="b", amount=10000.01),
                    dict(transaction_id="c", amount=0.01)])
    mart = models.daily_mart(models.stg_transactions(df)).first()
    assert mart.high_value_count == 1
    assert mart.high_value_pct == 33.33
    assert mart.avg_amount == 6666.67  # 20000.02 / 3 = 6666.6733..
    vals = spark.range(1).select(half_up_ratio(F.lit(5), F.lit(2), 0).alias("a"),
                                 half_up_ratio(F.lit(-5), F.lit(2), 0).alias("b"),
                                 half_up_ratio(F.lit(7218), F.lit(3600), 2).alias("c")).first()
    assert (vals.a, vals.b, vals.c) == (3.0, -3.0, 2.01)


def test_lag_boundary(spark):
    df = tx(spark, [dict(transaction_id="a", ingestion_timestamp=T0 + dt.timedelta(seconds=7200)),
                    dict(transaction_id="b", ingestion_timestamp=T0 + dt.timedelta(seconds=7201))])
    out = audit.ingestion_lag(df).collect()
    assert [(r.transaction_id, r.lag_hours) for r in out] == [("b", 2.0)]


def test_empty_batch_rate_is_zero(spark):
    df = tx(spark, [dict(transaction_id="a")])
    ids = spark.createDataFrame([], "transaction_id string")
    r = batch_metrics(tag(df, transaction_rules()), ids).first()
    assert (r.total, r.rejection_rate) == (0, 0.0)
    m = metrics(tag(df, transaction_rules()).limit(0)).first()
    assert m.total == 0 and m.rejection_rate == 0.0


def test_contract_failures_on_raw(spark):
    df = tx(spark, [dict(transaction_id="a", ssn_last4="12a4"), dict(transaction_id="b")])
    res = {(r.check_name, r.column_name): r.unexpected_count
           for r in C.run_suite(df, C.transaction_contract(with_uuid=False)).collect()}
    assert res[("pattern", "ssn_last4")] == 1
    assert sum(res.values()) == 1


def test_contract_types_and_presence(spark):
    strings = spark.createDataFrame([("a", "12.5", "2024-01-01T10:00:00Z"), ("b", "x", "not a time")],
                                    "transaction_id string, amount string, event_timestamp string")
    out = {r.column_name: r for r in C.check_types(strings).collect()}
    assert out["amount"].type_failures == 1 and out["event_timestamp"].type_failures == 1
    assert out["currency"].present is False and out["currency"].type_failures is None


def test_offset_timestamps_and_uuid(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00Z",), ("2024-01-01T10:00:00+02:00",), ("2024-01-01T10:00:00",)],
                               "event_timestamp string")
    r = C.run_suite(df, [C.has_offset("event_timestamp")]).first()
    assert r.unexpected_count == 1
    ids = spark.createDataFrame([("123e4567-e89b-12d3-a456-426614174000",), ("TXN0000000001",)], "transaction_id string")
    from ledgerspark.sources.schemas import UUID_PATTERN
    assert C.run_suite(ids, [C.matches("transaction_id", UUID_PATTERN, "format:uuid")]).first().unexpected_count == 1


def test_enforce_raises_on_broken_copy(spark, sf_small):
    from ledgerspark.plans.catalog import QUERIES
    ok = QUERIES["expectations"](spark, sf_small)
    C.enforce(ok)
    broken = QUERIES["expectations_broken"](spark, sf_small)
    failed = {r.check_name for r in broken.filter("not success").collect()}
    assert failed == {"expect_column_values_to_be_between", "expect_column_values_to_match_regex"}
    with pytest.raises(C.DataQualityError):
        C.enforce(broken)


def test_unique_counts_every_copy(spark):
    df = tx(spark, [dict(transaction_id="a"), dict(transaction_id="a"), dict(transaction_id="b"),
                    dict(transaction_id=None), dict(transaction_id=None)])
    res = {r.check_name: r.unexpected_count for r in
           C.run_suite(df, [C.unique("transaction_id"), C.Check("primaryKey", "transaction_id", "primary_key")]).collect()}
    assert res == {"expect_column_values_to_be_unique": 2, "primaryKey": 4}
    assert C.failing_rows(df, C.unique("transaction_id")).count() == 2


def test_dedup_tells_nulls_apart(spark):
    """Rows that differ only in which column is NULL: the survivor does not depend on their order."""
    rows = [("k", T0, None, "x"), ("k", T0, "x", None)]
    schema = "id string, ts timestamp, a string, b string"
    got = {tuple(dedup_latest(spark.createDataFrame(r, schema), "id", "ts").first()) for r in (rows, rows[::-1])}
    assert len(got) == 1


def test_long_keys_stay_distinct(spark, tmp_path):
    """Eleven-digit order keys and ten-digit customer keys keep all their digits."""
    from ledgerspark.sources import fixtures
    spark.createDataFrame([(k, 1, 10.0, dt.date(2020, 1, 1), "5-LOW") for k in (12345678901, 12345678902, 1234567890)],
                          "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate date, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1, "n"), (1234567891, "n"), (1234567892, "n")], "c_custkey long, c_name string").write.parquet(str(tmp_path / "customer.parquet"))
    assert fixtures.tx_raw(spark, str(tmp_path)).select("transaction_id").distinct().count() == 3
    assert fixtures.acct_initial(spark, str(tmp_path)).select("account_id").distinct().count() == 3


def test_deliveries_by_landing_ids(spark):
    """A record sent in two deliveries counts in both, whichever copy was kept."""
    from ledgerspark.operators.routing import compare_deliveries, failed_rules
    df = tx(spark, [dict(transaction_id="a"), dict(transaction_id="b", amount=None, currency="usd"), dict(transaction_id=None)])
    tagged = tag(df, transaction_rules())
    ids = spark.createDataFrame([("a", 1), ("b", 1), ("b", 1), ("b", 2), (None, 2)], "transaction_id string, _batch int")
    got = {r._batch: (r.total, r.valid, r.dead) for r in compare_deliveries(tagged, ids, "_batch").collect()}
    assert got == {1: (2, 1, 1), 2: (1, 0, 1)}
    assert {r.transaction_id: r.failed_rules for r in failed_rules(df, transaction_rules()).collect()} == {"a": 0, "b": 2, None: 1}
