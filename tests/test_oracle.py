"""Every registered query against its DuckDB oracle (multiset equality) at sf0.001,
plus the counts measured on the fixtures."""

import pytest

import __spark_entry__ as E
from compare import compare, duck

from ledgerspark.plans import catalog

QUERIES = {n: q for n, q in E.queries().items() if n in catalog.QUERIES}
ORACLE = {n: q for n, q in E.oracle_sql().items() if n in catalog.QUERIES}


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_small, name):
    problems, _ = compare(spark, con, sf_small, name, QUERIES[name], ORACLE[name])
    assert not problems, problems


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["transaction_date", "transaction_count", "total_amount", "avg_amount",
                          "high_value_count", "high_value_pct"]


def test_measured_counts(spark, sf_small):
    def one(name):
        return QUERIES[name](spark, sf_small)
    assert one("raw_transactions").count() == 1575
    assert one("dedup_latest").count() == 1500
    assert one("silver_valid").count() == 1410
    reasons = {r.rejection_reason: r.row_count for r in
               one("dead_letter").groupBy("rejection_reason").count().withColumnRenamed("count", "row_count").collect()}
    assert reasons == {"amount_invalid": 75, "currency_invalid": 15}
    assert one("ingestion_lag").count() == 74
    t = one("scd2_totals").first()
    assert (t.total_rows, t.current_rows) == (188, 150)
    inv = one("scd2_invariants").first()
    assert (inv.gaps, inv.overlapping, inv.non_positive, inv.bad_current, inv.flag_mismatch) == (0, 0, 0, 0, 0)
    assert one("history_as_of_version").count() == 165
    assert one("v0_vs_now").count() == 30
    aj = one("as_of_join")
    assert aj.count() == 1575 and aj.filter("valid_from is null").count() == 243
