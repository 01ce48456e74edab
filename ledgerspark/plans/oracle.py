"""DuckDB oracle: for every registered query, the same result written as plain SQL.

The statements run on the driver's views (``orders``, ``customer``, ...). They restate the
algebra independently of the Spark operators: fixtures, masking, keep-latest, tagging,
routing, the strict SCD2 merge as CTEs (chained for versions 1 and 2), the change log,
checks, models and the snapshot. Averages, shares and lag hours are rounded half-up with
integer arithmetic; decimal outputs are cast to double, as on the Spark side.
"""

from __future__ import annotations

from ..sources.fixtures import FIXTURE_HIGH_VALUE, fixture_sql_for_views

SENTINEL = "date '9999-12-31'"
SNAP_END = "timestamp '9999-12-31 00:00:00'"
RUNS = ("timestamp '2024-01-01 06:00:00'", "timestamp '2024-01-02 06:00:00'", "timestamp '2024-01-03 06:00:00'")
TXC = ("transaction_id, account_id, customer_name, ssn_last4, amount, currency, transaction_type, "
       "event_timestamp, ingestion_timestamp")


def _half_up(num: str, den: str, factor_p: int) -> str:
    """round(num * factor_p / den) half away from zero, over 10**2, as double."""
    n = f"cast(({num}) * {factor_p} as hugeint)"
    q = f"((2 * abs({n}) + ({den})) // (2 * ({den})))"
    return f"(cast(case when {n} < 0 then -{q} else {q} end as double) / 100.0)"


def _merge(out: str, hist: str, batch: str) -> str:
    """The strict merge of ``batch`` into ``hist`` as CTEs; ``{out}_m`` carries ``written``."""
    diff = "(account_status <> w_status or credit_limit <> w_limit)"
    src = "account_id s_a, account_status s_s, credit_limit s_l, effective_date s_e"
    return f""",
{out}_cur as (select account_id, valid_from w_from, valid_to w_to, account_status w_status, credit_limit w_limit
  from {hist} where is_current),
{out}_j as (select b.account_id, b.account_status, b.credit_limit, b.effective_date, c.w_from, c.w_to, c.w_status, c.w_limit
  from {batch} b left join {out}_cur c on b.account_id = c.account_id),
{out}_on as (select *, case when effective_date is null then 'null_effective_date' when w_from is null then 'unknown_key'
    when effective_date >= w_from then case when {diff} then 'forward_change' else 'no_op' end else 'late' end outcome
  from {out}_j),
{out}_lt as (select o.account_id, o.account_status, o.credit_limit, o.effective_date,
    h.valid_from w_from, h.valid_to w_to, h.account_status w_status, h.credit_limit w_limit
  from {out}_on o left join {hist} h on o.account_id = h.account_id and h.valid_from <= o.effective_date
    and o.effective_date < h.valid_to
  where o.outcome = 'late'),
{out}_late as (select *, case when w_from is null then 'before_first_window' when {diff} then 'late_split'
    else 'late_no_op' end outcome from {out}_lt),
{out}_st as (
  select account_id, w_from valid_from, cast(null as varchar) account_status, cast(null as integer) credit_limit,
    effective_date valid_to, false is_current, 'shrink' kind, {src} from {out}_on where outcome = 'forward_change'
  union all select account_id, effective_date, account_status, credit_limit, {SENTINEL}, true, 'insert', {src}
    from {out}_on where outcome = 'forward_change'
  union all select account_id, w_from, cast(null as varchar), cast(null as integer), effective_date, false, 'shrink', {src}
    from {out}_late where outcome = 'late_split'
  union all select account_id, effective_date, account_status, credit_limit, w_to, false, 'insert', {src}
    from {out}_late where outcome = 'late_split'),
{out}_bad as (select distinct s_a, s_s, s_l, s_e from
  (select *, count(*) over (partition by account_id, valid_from) n from {out}_st) where n > 1),
{out}_ok as (select * from {out}_st s where not exists (select 1 from {out}_bad b where b.s_a is not distinct from s.s_a
  and b.s_s is not distinct from s.s_s and b.s_l is not distinct from s.s_l and b.s_e is not distinct from s.s_e)),
{out}_out as (
  select x.account_id, x.account_status, x.credit_limit, x.effective_date,
    case when b.s_a is not null or b.s_e is not null then 'ambiguous_match' else x.outcome end outcome
  from (select account_id, account_status, credit_limit, effective_date, outcome from {out}_on where outcome <> 'late'
        union all select account_id, account_status, credit_limit, effective_date, outcome from {out}_late) x
  left join {out}_bad b on b.s_a is not distinct from x.account_id and b.s_s is not distinct from x.account_status
    and b.s_l is not distinct from x.credit_limit and b.s_e is not distinct from x.effective_date),
{out}_m as (
  select coalesce(t.account_id, s.account_id) account_id,
    case when t.t_m then t.account_status else s.account_status end account_status,
    case when t.t_m then t.credit_limit else s.credit_limit end credit_limit,
    coalesce(t.valid_from, s.valid_from) valid_from,
    case when s.kind is not null then s.valid_to else t.valid_to end valid_to,
    case when s.kind is not null then s.is_current else t.is_current end is_current,
    s.kind is not null written
  from (select *, true t_m from {hist}) t full outer join {out}_ok s
    on t.account_id = s.account_id and t.valid_from = s.valid_from),
{out} as (select account_id, account_status, credit_limit, valid_from, valid_to, is_current from {out}_m)"""


def _snapshot(out: str, prev: str | None, hist: str, run: str) -> str:
    cur = (f"{out}_c as (select account_id, account_status, cast(credit_limit as decimal(18,2)) credit_limit, "
           f"valid_from, valid_to from {hist} where is_current)")
    if prev is None:
        return f""",
{cur},
{out} as (select *, {run} dbt_valid_from, {SNAP_END} dbt_valid_to from {out}_c)"""
    return f""",
{cur},
{out}_j as (select o.*, c.account_id c_id, c.account_status c_status, c.credit_limit c_limit, c.valid_from c_vf,
    c.valid_to c_vt, o.account_id is not null has_o,
    coalesce(o.account_id is not null and c.account_id is not null and (o.account_status is distinct from c.account_status
      or o.credit_limit is distinct from c.credit_limit), false) changed
  from (select * from {prev} where dbt_valid_to = {SNAP_END}) o full outer join {out}_c c on o.account_id = c.account_id),
{out} as (
  select * from {prev} where dbt_valid_to <> {SNAP_END}
  union all select account_id, account_status, credit_limit, valid_from, valid_to, dbt_valid_from,
    case when changed then {run} else dbt_valid_to end from {out}_j where has_o
  union all select c_id, c_status, c_limit, c_vf, c_vt, {run}, {SNAP_END} from {out}_j where changed or not has_o)"""


def _prelude() -> str:
    mask = (f"select transaction_id, account_id, sha256(customer_name) customer_name, "
            f"'XX' || substring(ssn_last4, 3, 2) ssn_last4, amount, currency, transaction_type, event_timestamp, "
            f"ingestion_timestamp, _batch from tx_raw")
    reasons = ("concat_ws('; ', case when amount is null or amount <= 0 then 'amount_invalid' end, "
               "case when not regexp_matches(currency, '^[A-Z]{3}$') then 'currency_invalid' end, "
               "case when transaction_id is null then 'transaction_id_invalid' end)")
    ctes = f"""with
tx_raw as ({fixture_sql_for_views('tx_raw')}),
acct_initial as ({fixture_sql_for_views('acct_initial')}),
acct_update as ({fixture_sql_for_views('acct_update')}),
acct_mixed as ({fixture_sql_for_views('acct_mixed')}),
acct_faults as ({fixture_sql_for_views('acct_faults')}),
tx_faults as ({fixture_sql_for_views('tx_faults')}),
bronze as ({mask}),
deduped as (select * exclude (rn) from (select *, row_number() over (partition by transaction_id
    order by ingestion_timestamp desc nulls last) rn from bronze where transaction_id is not null) where rn = 1
  union all select * from bronze where transaction_id is null),
tagged as (select *, {reasons} rejection_reason from deduped),
silver as (select * exclude (rejection_reason) from tagged where rejection_reason = ''),
dead as (select * from tagged where rejection_reason <> ''),
batch_ids as (select transaction_id from tx_raw where _batch = 2),
stg as (select transaction_id, account_id, customer_name, ssn_last4, cast(amount as decimal(18,2)) amount, currency,
  transaction_type, event_timestamp transacted_at, ingestion_timestamp ingested_at from silver),
mart0 as (select cast(transacted_at as date) transaction_date, count(*) transaction_count, sum(amount) s,
  count(amount) n, count(*) filter (where amount > {FIXTURE_HIGH_VALUE}) high_value_count from stg group by 1),
mart as (select transaction_date, transaction_count, round(s, 2) total_amount, {_half_up('s', 'n', 100)} avg_amount,
  high_value_count, {_half_up('high_value_count', 'transaction_count', 100 * 100)} high_value_pct from mart0),
h0 as (select account_id, account_status, credit_limit, effective_date valid_from, {SENTINEL} valid_to,
  true is_current from acct_initial)"""
    ctes += _merge("h1", "h0", "acct_update")
    ctes += _merge("h2", "h1", "acct_mixed")
    ctes += _merge("h3", "h2", "acct_faults")
    ctes += """,
log as (select *, 0 _version, 'WRITE' _operation from h0
  union all select * exclude (written), 1, 'MERGE' from h1_m where written
  union all select * exclude (written), 2, 'MERGE' from h2_m where written),
stg_acc as (select account_id, account_status, cast(credit_limit as decimal(18,2)) credit_limit,
  cast(valid_from as date) valid_from, cast(valid_to as date) valid_to, is_current from h2),
stg_cur as (select account_id, account_status, credit_limit, valid_from, valid_to from stg_acc where is_current)"""
    ctes += _snapshot("s1", None, "h0", RUNS[0])
    ctes += _snapshot("s2", "s1", "h1", RUNS[1])
    ctes += _snapshot("s3", "s2", "h2", RUNS[2])
    return ctes + "\n"


_EXPECT = [
    ("expect_column_values_to_not_be_null", "transaction_id", "transaction_id is null"),
    ("expect_column_values_to_not_be_null", "account_id", "account_id is null"),
    ("expect_column_values_to_not_be_null", "amount", "amount is null"),
    ("expect_column_values_to_be_between", "amount", "not (amount between 0.01 and 1000000)"),
    ("expect_column_values_to_match_regex", "currency", "not regexp_matches(currency, '^[A-Z]{3}$')"),
]


def _suite(src: str, row_checks, unique_cols=(), pk_cols=()) -> str:
    parts = [f"select '{n}' check_name, '{c}' column_name, count(*) filter (where {cond}) unexpected_count from {src}"
             for n, c, cond in row_checks]
    for n, c in unique_cols:
        parts.append(f"select '{n}', '{c}', coalesce(sum(k), 0) from (select {c}, count(*) k from {src} "
                     f"where {c} is not null group by {c} having count(*) > 1)")
    for n, c in pk_cols:
        parts.append(f"select '{n}', '{c}', coalesce((select sum(k) from (select {c}, count(*) k from {src} "
                     f"where {c} is not null group by {c} having count(*) > 1)), 0) "
                     f"+ (select count(*) from {src} where {c} is null)")
    body = "\nunion all ".join(parts)
    return (f"select check_name, column_name, cast(unexpected_count as bigint) unexpected_count, "
            f"unexpected_count = 0 success from (\n{body})")


def _broken() -> str:
    return ("select * exclude (amount, currency), case when transaction_id = lo then -50.0 else amount end amount, "
            "case when transaction_id = hi then 'usd' else currency end currency from silver, "
            "(select min(transaction_id) lo, max(transaction_id) hi from silver) ends")


_UUID = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
_CONTRACT = (
    [("required", c, f"{c} is null") for c in TXC.split(", ")]
    + [("format:uuid", "transaction_id", f"not regexp_matches(transaction_id, '{_UUID}')"),
       ("minLength", "ssn_last4", "length(ssn_last4) < 4"), ("maxLength", "ssn_last4", "length(ssn_last4) > 4"),
       ("pattern", "ssn_last4", "not regexp_matches(ssn_last4, '^[0-9]{4}$')"),
       ("exclusiveMinimum", "amount", "not (amount > 0)"), ("maximum", "amount", "not (amount <= 1000000)"),
       ("minLength", "currency", "length(currency) < 3"), ("maxLength", "currency", "length(currency) > 3"),
       ("pattern", "currency", "not regexp_matches(currency, '^[A-Z]{3}$')")]
)
_TYPES = {"amount": "double", "event_timestamp": "timestamp", "ingestion_timestamp": "timestamp"}


def _contract_types() -> str:
    parts = []
    for c in TXC.split(", "):
        logical = {"amount": "number"}.get(c, "timestamp" if c.endswith("timestamp") else "string")
        if c in _TYPES:
            bad = f"count(*) filter (where {c} is not null and try_cast(cast({c} as varchar) as {_TYPES[c]}) is null)"
        else:
            bad = "count(*) filter (where false)"
        parts.append(f"select '{c}' column_name, '{logical}' logical_type, true present, cast({bad} as bigint) "
                     f"type_failures from (select * replace ("
                     f"case when ends_with(transaction_id, '7') then 'n/a' else cast(amount as varchar) end as amount, "
                     f"case when ends_with(transaction_id, '31') then 'yesterday' else cast(event_timestamp as varchar) end "
                     f"as event_timestamp) from tx_raw) strings")
    return "\nunion all ".join(parts)


def _tests(rows) -> str:
    body = "\nunion all ".join(f"select '{t}' test_name, '{m}' model, '{c}' column_name, cast(({q}) as bigint) failures"
                               for t, m, c, q in rows)
    return f"select *, failures = 0 success from (\n{body})"


def _dup(src: str, col: str) -> str:
    return f"select count(*) from (select {col} from {src} where {col} is not null group by {col} having count(*) > 1)"


_BODIES = {
    "raw_transactions": "select * from tx_raw",
    "dedup_latest": "select * from deduped",
    "dedup_stats": ("select count(*) before, count(distinct transaction_id) + count(*) filter (where transaction_id is null) "
                    "after, count(*) - (count(distinct transaction_id) + count(*) filter (where transaction_id is null)) "
                    "removed from bronze"),
    "rule_amount": "select transaction_id, amount from deduped where amount is null or amount <= 0",
    "rule_currency": "select transaction_id, currency from deduped where not regexp_matches(currency, '^[A-Z]{3}$')",
    "tagged": "select * from tagged",
    "silver_valid": "select * from silver",
    "stg_transactions": "select * replace (cast(amount as double) as amount) from stg",
    "fct_daily": "select * replace (cast(total_amount as double) as total_amount) from mart",
    "mart_totals": ("select count(*) n_days, cast(sum(transaction_count) as bigint) transaction_count, "
                    "cast(sum(total_amount) as double) total_amount, cast(sum(high_value_count) as bigint) high_value_count, "
                    "max(transaction_count) busiest_day_count, min(transaction_date) first_date, "
                    "max(transaction_date) last_date from mart"),
    "mask_pii": f"select * exclude (_batch) from bronze",
    "bronze_append": "select * from bronze",
    "dead_letter": "select * from dead",
    "route_totals": ("select count(*) total, count(*) filter (where rejection_reason = '') valid, "
                     "count(*) filter (where rejection_reason <> '') dead, case when count(*) = 0 then 0.0 else "
                     "cast(count(*) filter (where rejection_reason <> '') as double) / cast(count(*) as double) * 100.0 "
                     "end rejection_rate from tagged"),
    "batch_metrics": ("select valid + dead total, valid, dead, case when valid + dead = 0 then 0.0 else "
                      "cast(dead as double) / cast(valid + dead as double) * 100.0 end rejection_rate from ("
                      "select count(*) filter (where not d) valid, count(*) filter (where d) dead from ("
                      "select transaction_id, false d from silver union all select transaction_id, true from dead) x "
                      "where transaction_id in (select transaction_id from batch_ids))"),
    "batch_compare": ("select _batch, count(*) total, count(*) filter (where rejection_reason = '') valid, "
                      "count(*) filter (where rejection_reason <> '') dead, "
                      "cast(count(*) filter (where rejection_reason <> '') as double) / cast(count(*) as double) * 100.0 "
                      "rejection_rate from tagged group by _batch"),
    "delivery_compare": ("select _batch, count(*) total, count(*) filter (where rejection_reason = '') valid, "
                         "count(*) filter (where rejection_reason <> '') dead, "
                         "cast(count(*) filter (where rejection_reason <> '') as double) / cast(count(*) as double) * 100.0 "
                         "rejection_rate from (select distinct t.transaction_id, t.rejection_reason, r._batch from tagged t "
                         "join tx_raw r on t.transaction_id = r.transaction_id) x group by _batch"),
    "failed_rules": ("select case when amount is null or amount <= 0 then 1 else 0 end "
                     "+ case when not regexp_matches(currency, '^[A-Z]{3}$') then 1 else 0 end "
                     "+ case when transaction_id is null then 1 else 0 end failed_rules, count(*) row_count from deduped group by 1"),
    "reason_breakdown": ("select rejection_reason, count(*) row_count from dead where transaction_id in "
                         "(select transaction_id from batch_ids) group by 1"),
    "ingestion_lag": (f"select transaction_id, account_id, event_timestamp, ingestion_timestamp, "
                      f"{_half_up('lag_s', '3600', 100)} lag_hours from (select *, "
                      f"cast(epoch(ingestion_timestamp) - epoch(event_timestamp) as bigint) lag_s from silver) "
                      f"where lag_s > 7200"),
    "raw_account_states": "select * from acct_mixed",
    "scd2_initial": "select * from h0",
    "accounts_current": "select * replace (cast(credit_limit as double) as credit_limit) from stg_cur",
    "scd2_normal": ("select account_id, effective_date, account_status, credit_limit, w_from current_valid_from, "
                    "w_to current_valid_to, w_status current_status, w_limit current_credit_limit from h2_on "
                    "where outcome = 'forward_change'"),
    "scd2_late_window": ("select account_id, effective_date, account_status, credit_limit, w_from h_valid_from, "
                         "w_to h_valid_to, w_status h_status, w_limit h_credit_limit from h2_late where outcome = 'late_split'"),
    "scd2_late_noop": ("select account_id, effective_date, account_status, credit_limit, w_from h_valid_from, "
                       "w_to h_valid_to, w_status h_status, w_limit h_credit_limit from h2_late where outcome = 'late_no_op'"),
    "scd2_staged": "select account_id, valid_from, account_status, credit_limit, valid_to, is_current, kind from h2_ok",
    "scd2_merge": "select * from h2",
    "scd2_merge_timeline": "select * from h2",
    "scd2_outcomes": "select * from h2_out",
    "scd2_totals": ("select count(*) total_rows, count(*) filter (where is_current) current_rows, "
                    "count(*) filter (where not is_current) historical_rows from h2"),
    "scd2_invariants": (f"select count(*) total_rows, count(*) filter (where nxt is null) n_keys, "
                        f"count(*) filter (where nxt is not null and valid_to < nxt) gaps, "
                        f"count(*) filter (where nxt is not null and valid_to > nxt) overlapping, "
                        f"count(*) filter (where valid_to <= valid_from) non_positive, "
                        f"count(*) filter (where nxt is null and ncur <> 1) bad_current, "
                        f"count(*) filter (where is_current <> (valid_to = {SENTINEL})) flag_mismatch, "
                        f"count(*) filter (where nxt is null and valid_to <> {SENTINEL}) open_end_missing "
                        f"from (select *, lead(valid_from) over (partition by account_id order by valid_from) nxt, "
                        f"sum(cast(is_current as integer)) over (partition by account_id) ncur from h2)"),
    "account_trace": ("select account_id, valid_from, valid_to, is_current, account_status, credit_limit, "
                      "cast(row_number() over w as integer) seq, lag(account_status) over w prev_account_status, "
                      "lag(credit_limit) over w prev_credit_limit from h2 "
                      "window w as (partition by account_id order by valid_from)"),
    "stg_accounts": "select * replace (cast(credit_limit as double) as credit_limit) from stg_acc",
    "write_audit": ("select _version version, _operation operation, count(*) rows_written, "
                    "count(*) filter (where _version = 0 or not known) inserted, count(*) filter (where _version > 0 and known) closed, "
                    "count(*) rows_read, 'ok' status from (select l.*, exists (select 1 from log p where p._version < l._version "
                    "and p.account_id = l.account_id and p.valid_from = l.valid_from) known from log l) group by all"),
    "history_checkpoint": "select * from h1",
    "history_as_of_version": "select * from h1",
    "version_log": "select _version version, _operation operation, count(*) num_output_rows from log group by all",
    "v0_vs_now": ("select n.account_id, o.credit_limit credit_limit_at_v0, n.credit_limit credit_limit_now, "
                  "o.account_status status_at_v0, n.account_status status_now from h0 o join "
                  "(select * from h2 where is_current) n on o.account_id = n.account_id "
                  "where o.credit_limit <> n.credit_limit or o.account_status <> n.account_status"),
    "v0_vs_now_top10": ("select n.account_id, o.credit_limit credit_limit_at_v0, n.credit_limit credit_limit_now, "
                        "o.account_status status_at_v0, n.account_status status_now from h0 o join "
                        "(select * from h2 where is_current) n on o.account_id = n.account_id "
                        "where o.credit_limit <> n.credit_limit or o.account_status <> n.account_status "
                        "order by n.account_id limit 10"),
    "state_on_date": "select * from h2 where valid_from <= date '1998-01-01' and date '1998-01-01' < valid_to",
    "as_of_join": ("select t.transaction_id, t.account_id, t.event_timestamp, t.amount, h.account_status, "
                   "h.credit_limit, h.valid_from, h.valid_to from tx_raw t left join h2 h on t.account_id = h.account_id "
                   "and h.valid_from <= cast(t.event_timestamp as date) and cast(t.event_timestamp as date) < h.valid_to"),
    "expectations": _suite("silver", _EXPECT, [("expect_column_values_to_be_unique", "transaction_id")]),
    "expectations_broken": ("with broken as (" + _broken() + ")\n" +
                            _suite("broken", _EXPECT, [("expect_column_values_to_be_unique", "transaction_id")])),
    "expectation_failures": "\nunion all ".join(
        [f"select '{n}' check_name, '{c}' column_name, transaction_id, account_id, amount, currency from deduped "
         f"where coalesce({cond}, false)" for n, c, cond in _EXPECT]
        + ["select 'expect_column_values_to_be_unique', 'transaction_id', transaction_id, account_id, amount, currency "
           "from deduped where transaction_id in (select transaction_id from deduped where transaction_id is not null "
           "group by 1 having count(*) > 1)"]),
    "contract": _suite("tx_raw", _CONTRACT, [("unique", "transaction_id")], [("primaryKey", "transaction_id")]),
    "contract_types": _contract_types(),
    "test_unique": _tests([("unique", "stg_transactions", "transaction_id", _dup("stg", "transaction_id")),
                           ("unique", "stg_accounts_current", "account_id", _dup("stg_cur", "account_id")),
                           ("unique", "fct_transactions_daily", "transaction_date", _dup("mart", "transaction_date"))]),
    "test_not_null": _tests(
        [("not_null", "stg_transactions", c, f"select count(*) from stg where {c} is null")
         for c in ("transaction_id", "account_id", "amount")]
        + [("not_null", "stg_accounts", "account_id", "select count(*) from stg_acc where account_id is null"),
           ("not_null", "stg_accounts_current", "account_id", "select count(*) from stg_cur where account_id is null"),
           ("not_null", "fct_transactions_daily", "transaction_date",
            "select count(*) from mart where transaction_date is null")]),
    "test_accepted_values": _tests([
        ("accepted_values", "stg_transactions", "currency",
         "select count(distinct currency) from stg where currency not in ('USD', 'EUR', 'GBP', 'CAD', 'AUD')"),
        ("accepted_values", "stg_accounts", "account_status",
         "select count(distinct account_status) from stg_acc where account_status not in "
         "('active', 'suspended', 'frozen', 'closed')")]),
    "test_relationships": _tests([
        ("relationships", "stg_transactions", "account_id",
         "select count(*) from stg t where t.account_id is not null and not exists "
         "(select 1 from stg_cur c where c.account_id = t.account_id)")]),
    "test_no_negative": _tests([("assert_no_negative_amounts", "stg_transactions", "amount",
                                 "select count(*) from stg where amount < 0")]),
    "snapshot_check": "select * replace (cast(credit_limit as double) as credit_limit) from s3",
    "scd2_vs_snapshot": ("select coalesce(m.account_id, s.account_id) account_id, m.merge_windows, m.merge_first_from, "
                         "s.snapshot_records, s.snapshot_first_from, m.merge_windows is distinct from s.snapshot_records "
                         "differs from (select account_id, count(*) merge_windows, min(valid_from) merge_first_from "
                         "from h2 group by 1) m full outer join (select account_id, count(*) snapshot_records, "
                         "min(dbt_valid_from) snapshot_first_from from s3 group by 1) s on m.account_id = s.account_id"),
}


# the alternative physical forms must give the same rows as their default forms
_BODIES["scd2_faults"] = "select * from h3"
_BODIES["scd2_outcomes_faults"] = "select * from h3_out"
_BODIES["dedup_faults"] = (
    "select *, concat_ws('; ', case when amount is null or amount <= 0 then 'amount_invalid' end, "
    "case when not regexp_matches(currency, '^[A-Z]{3}$') then 'currency_invalid' end, "
    "case when transaction_id is null then 'transaction_id_invalid' end) rejection_reason from ("
    "select * exclude (rn) from (select *, row_number() over (partition by transaction_id order by ingestion_timestamp desc nulls last, "
    "amount desc nulls last) rn from tx_faults where transaction_id is not null) where rn = 1 "
    "union all select * from tx_faults where transaction_id is null)")
_BODIES["silver_incremental"] = _BODIES["silver_valid"]
_BODIES["mart_incremental"] = _BODIES["fct_daily"]
_BODIES["snapshot_append"] = _BODIES["snapshot_check"]
_LINE = [f"coalesce(cast({c} as varchar), '')" for c in TXC.split(", ")]
_BODIES["unparsed_records"] = (
    "select _batch, unnest(list_filter([case when k % 50 = 1 then concat_ws(',', " + ", ".join(_LINE[:-1]) + ") "
    "when k % 50 = 2 then concat_ws(',', " + ", ".join(_LINE) + ", 'more') "
    "when k % 50 = 3 then concat_ws(',', " + ", ".join([*_LINE[:4], "'many'", *_LINE[5:]]) + ") end], lambda x: x is not null)) record "
    "from (select *, cast(substring(transaction_id, 4) as bigint) k from tx_raw)")
_JSON_COUNTS = {("required", "amount"): "amount is null and not ends_with(transaction_id, '7')",
                ("type", "amount"): "ends_with(transaction_id, '7')",
                ("exclusiveMinimum", "amount"): "not ends_with(transaction_id, '7') and not (amount > 0)",
                ("maximum", "amount"): "not ends_with(transaction_id, '7') and not (amount <= 1000000)",
                ("format", "record"): "ends_with(transaction_id, '31') or ends_with(transaction_id, '77')"}
_BODIES["contract_json"] = _suite(
    "tx_raw", [(n, c, _JSON_COUNTS.get((n, c), cond)) for n, c, cond in
               [("type", c, "false") for c in TXC.split(", ")] + [x for x in _CONTRACT if x[0] != "format:uuid"] + [("format", "record", "false")]],
    [("unique", "transaction_id")], [("primaryKey", "transaction_id")])
_BODIES["scd2_merge_lookup"] = _BODIES["scd2_merge"]
_BODIES["scd2_invariants_split"] = _BODIES["scd2_invariants"]
_BODIES["as_of_join_range"] = _BODIES["as_of_join"]
_BODIES["scd2_outcomes_timeline"] = _BODIES["scd2_outcomes"]


def oracle_sql() -> dict[str, str]:
    pre = _prelude()
    out = {}
    for name, body in _BODIES.items():
        if body.startswith("with "):
            # a body with its own CTEs: splice them after the shared ones
            body = "," + body[len("with "):]
            head, rest = body.split(")\n", 1)
            out[name] = pre.rstrip("\n") + head + ")\n" + rest
        else:
            out[name] = pre + body
    return out
