"""Representative ledger inputs derived from the driver's tables by deterministic SQL.

Each statement is written once with ``{orders}``/``{customer}`` placeholders: Spark binds
them to DataFrames (``spark.sql(text, orders=df, ...)``), the DuckDB oracle to view names.
The shapes follow the source system's landing files: one transaction per order in three
batches with injected faults and resends (in a later batch), and account-state batches (initial load, a full
restatement, a mixed late/forward batch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import tables

# Ids are padded to a fixed width but never cut: a longer number keeps all its digits.
_TXN = "concat('TXN', lpad(cast(o_orderkey as string), cast(greatest(10, length(cast(o_orderkey as string))) as int), '0'))"


def _account(column: str) -> str:
    return f"concat('ACC', lpad(cast({column} as string), cast(greatest(9, length(cast({column} as string))) as int), '0'))"


# One scan: an order that is sent again becomes two rows. ``@SENDINGS`` is the dialect's generator.
SENDINGS = {"spark": "explode(case when o_orderkey % 20 = 7 then array(0, 1) else array(0) end)",
            "duckdb": "unnest(case when o_orderkey % 20 = 7 then [0, 1] else [0] end)"}

TX_RAW_SQL = f"""
with sent as (
  select o_orderkey k, o_totalprice p, o_orderdate + interval '1' second * (o_orderkey % 86400) ev,
    {_TXN} transaction_id,
    {_account('o_custkey')} account_id,
    c_name customer_name,
    lpad(cast((o_custkey * 7919) % 10000 as string), 4, '0') ssn_last4,
    case when o_orderkey % 101 = 0 then null when o_orderkey % 97 = 0 then 'usd'
         when o_orderkey % 5 = 0 then 'USD' when o_orderkey % 5 = 1 then 'EUR' when o_orderkey % 5 = 2 then 'GBP'
         when o_orderkey % 5 = 3 then 'CAD' else 'AUD' end currency,
    case o_orderpriority when '1-URGENT' then 'purchase' when '2-HIGH' then 'refund' when '3-MEDIUM' then 'transfer'
         when '5-LOW' then 'deposit' else 'withdrawal' end transaction_type,
    @SENDINGS d
  from {{orders}} join {{customer}} on o_custkey = c_custkey
)
select transaction_id, account_id, customer_name, ssn_last4,
  case when k % 40 = 0 then cast(null as double) when k % 40 = 20 then -p else p + d end amount,
  currency, transaction_type, ev event_timestamp,
  ev + interval '1' second * (case when d = 0 then 1 + (k * 37) % 7200 else 7201 + k % 7200 end) ingestion_timestamp,
  cast(least(k % 3 + 1 + d, 3) as int) _batch
from sent
"""

ACCT_INITIAL_SQL = f"""
select {_account('c_custkey')} account_id,
  case when c_custkey % 50 = 0 then 'closed' when c_custkey % 50 = 1 then 'frozen'
       when c_custkey % 20 = 3 then 'suspended' else 'active' end account_status,
  cast(1000 * (1 + c_custkey % 7) as int) credit_limit,
  date '1996-01-01' effective_date
from {{customer}}
"""

ACCT_UPDATE_SQL = f"""
select {_account('c_custkey')} account_id,
  case when c_custkey % 50 = 0 then 'closed' when c_custkey % 50 = 1 then 'frozen'
       when c_custkey % 20 = 3 then 'suspended' else 'active' end account_status,
  cast(1000 * (1 + c_custkey % 7) + case when c_custkey % 10 = 1 then 500 else 0 end as int) credit_limit,
  date '1998-06-01' effective_date
from {{customer}}
"""

ACCT_MIXED_SQL = f"""
with a as (
  select c_custkey k, {_account('c_custkey')} account_id,
    case when c_custkey % 50 = 0 then 'closed' when c_custkey % 50 = 1 then 'frozen'
         when c_custkey % 20 = 3 then 'suspended' else 'active' end account_status,
    cast(1000 * (1 + c_custkey % 7) as int) lim
  from {{customer}})
select account_id, case when account_status = 'frozen' then 'suspended' else 'frozen' end account_status,
  cast(lim + 250 as int) credit_limit, date '1997-03-01' effective_date from a where k % 20 = 1
union all select account_id, account_status, lim, date '1997-02-01' from a where k % 20 = 11
union all select account_id, account_status, cast(lim + 750 as int), date '1999-07-01' from a where k % 10 = 4
union all select concat('NEW', account_id), account_status, lim, date '1999-07-01' from a where k % 500 = 5
union all select account_id, account_status, cast(lim + 9 as int), date '1995-01-01' from a where k % 100 = 6
"""

# Deliveries with the faults a source can have: no id, and another copy with the same ingestion time.
TX_FAULTS_SQL = f"""
select case when number % 41 = 3 then cast(null as string) else transaction_id end transaction_id, account_id, customer_name, ssn_last4,
  amount, currency, transaction_type, event_timestamp, ingestion_timestamp, _batch
from (select *, cast(substring(transaction_id, 4) as bigint) number from ({TX_RAW_SQL}) raw) numbered
union all
select transaction_id, account_id, customer_name, ssn_last4, amount + 1, currency, transaction_type, event_timestamp, ingestion_timestamp, _batch
from ({TX_RAW_SQL}) again where cast(substring(transaction_id, 4) as bigint) % 13 = 5
"""

# Two changes in one window, a change on the day its window starts, no date, no account.
ACCT_FAULTS_SQL = f"""
with a as (
  select c_custkey k, {_account('c_custkey')} account_id, cast(1000 * (1 + c_custkey % 7) as int) lim from {{customer}})
select account_id, 'active' account_status, cast(lim + 31 as int) credit_limit, date '1999-09-01' effective_date from a where k % 20 = 8
union all select account_id, 'active', cast(lim + 32 as int), date '1999-10-01' from a where k % 20 = 8
union all select account_id, 'active', cast(lim + 33 as int), date '1996-01-01' from a where k % 20 = 9
union all select account_id, 'active', cast(lim + 34 as int), cast(null as date) from a where k % 20 = 2
union all select cast(null as string), 'active', cast(lim + 35 as int), date '1999-09-01' from a where k % 20 = 3
union all select account_id, 'closed', cast(lim + 36 as int), date '1999-11-01' from a where k % 20 = 12
"""

FIXTURE_SQL = {
    "tx_faults": (TX_FAULTS_SQL, ("orders", "customer")),
    "acct_faults": (ACCT_FAULTS_SQL, ("customer",)),
    "tx_raw": (TX_RAW_SQL, ("orders", "customer")),
    "acct_initial": (ACCT_INITIAL_SQL, ("customer",)),
    "acct_update": (ACCT_UPDATE_SQL, ("customer",)),
    "acct_mixed": (ACCT_MIXED_SQL, ("customer",)),
}

# High-value threshold of the daily mart on these fixtures (amounts run to 500,000).
FIXTURE_HIGH_VALUE = 450000


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text, deps = FIXTURE_SQL[name]
    return spark.sql(text.replace("@SENDINGS", SENDINGS["spark"]), **tables(spark, sf_dir, *deps))


def fixture_sql_for_views(name: str) -> str:
    """The same statement bound to plain view names (for the DuckDB oracle)."""
    text, deps = FIXTURE_SQL[name]
    return text.replace("@SENDINGS", SENDINGS["duckdb"]).format(**{d: d for d in deps})


def tx_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "tx_raw")


def acct_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "acct_initial")


def acct_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "acct_update")


def acct_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "acct_mixed")
