"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables through the fixtures (whole tables, no id subsets)
and runs the library operators on them; outputs alias every computed column so they line up
with the DuckDB oracle in ``plans.oracle``. Decimal outputs are cast to double at the edge.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.masking import TRANSACTION_MASK, mask
from ..functions.rules import amount_invalid, currency_invalid, transaction_rules
from ..operators import checks as C
from ..operators import scd2, temporal
from ..operators.dedup import dedup_latest, dedup_stats
from ..operators.routing import (
    batch_metrics, compare_deliveries, failed_rules, failing, metrics, of_delivery, reason_breakdown, route, tag,
)
from ..operators.snapshot import SnapshotStore, snapshot_check
from ..session import ensure_utc, scratch_path
from ..sources import fixtures
from ..sources.ingest import CORRUPT_COL
from ..sources.schemas import (
    ACCEPTED_CURRENCIES, ACCEPTED_STATUSES, ACCOUNT_KEYS, ACCOUNT_TRACKED, BATCH_COL, TRANSACTION_SCHEMA,
)
from . import audit, jobs, models
from .silver import SilverStore
from .store import HistoryStore

Query = Callable[[SparkSession, str], DataFrame]

# fixed parameters of the registered queries
METRICS_BATCH = 2                      # the delivery the single-batch metrics isolate
STATE_DATE = date(1998, 1, 1)          # business date of state_on_date
SNAPSHOT_RUNS = ("2024-01-01 06:00:00", "2024-01-02 06:00:00", "2024-01-03 06:00:00")
TX_COLUMNS = [f.name for f in TRANSACTION_SCHEMA]


def _decimals_to_double(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal"
                       else F.col(f.name) for f in df.schema])


class Ledger:
    """Lazily built plans of one run over one scale factor (nothing is executed here)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        ensure_utc(spark)
        self.spark, self.sf = spark, sf_dir
        self._cache: dict[str, object] = {}

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    # transactions
    @property
    def raw(self) -> DataFrame:
        return self._get("raw", lambda: fixtures.tx_raw(self.spark, self.sf))

    @property
    def bronze(self) -> DataFrame:
        return self._get("bronze", lambda: mask(self.raw, TRANSACTION_MASK))

    @property
    def deduped(self) -> DataFrame:
        return self._get("deduped", lambda: dedup_latest(self.bronze, "transaction_id", "ingestion_timestamp"))

    @property
    def tagged(self) -> DataFrame:
        return self._get("tagged", lambda: tag(self.deduped, transaction_rules()))

    @property
    def routes(self) -> tuple[DataFrame, DataFrame]:
        return self._get("routes", lambda: route(self.tagged))

    @property
    def silver(self) -> DataFrame:
        return self.routes[0]

    @property
    def dead(self) -> DataFrame:
        return self.routes[1]

    @property
    def stg(self) -> DataFrame:
        return self._get("stg", lambda: models.stg_transactions(self.silver))

    @property
    def mart(self) -> DataFrame:
        return self._get("mart", lambda: models.daily_mart(self.stg, fixtures.FIXTURE_HIGH_VALUE))

    def batch_ids(self, batch: int = METRICS_BATCH) -> DataFrame:
        return self.raw.filter(F.col(BATCH_COL) == batch).select("transaction_id")

    # accounts
    @property
    def h0(self) -> DataFrame:
        return self._get("h0", lambda: scd2.initial_history(fixtures.acct_initial(self.spark, self.sf)))

    @property
    def mixed(self) -> DataFrame:
        return self._get("mixed", lambda: fixtures.acct_mixed(self.spark, self.sf))

    @property
    def update(self) -> DataFrame:
        return self._get("update", lambda: fixtures.acct_update(self.spark, self.sf))

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table that is written once per session and scale factor and read from then on."""
        key = (self.spark.sparkContext.applicationId, self.sf.rstrip("/"), name)
        if key not in _STORED:
            path = scratch_path(self.spark, name)
            build().write.parquet(path)
            _STORED[key] = path
        return self._get(f"stored {name}", lambda: self.spark.read.parquet(_STORED[key]))

    @property
    def store(self) -> HistoryStore:
        """The stored history of both account batches, in buckets, with a state every other version."""
        key = (self.spark.sparkContext.applicationId, self.sf.rstrip("/"), "history store")
        if key not in _STORED:
            store = HistoryStore(scratch_path(self.spark, "history"), buckets=16, every=2)
            store.create(self.h0)
            store.merge(self.update, 1)
            store.merge(self.mixed, 2)
            _STORED[key] = store
        return _STORED[key]

    @property
    def m1(self) -> scd2.MergeResult:
        return self._get("m1", lambda: scd2.merge(self.h0, self.update))

    @property
    def f1(self) -> DataFrame:
        """Version 1 with its flags, as a merge job writes it."""
        return self.stored("version-1", lambda: self.m1.flagged)

    @property
    def h1(self) -> DataFrame:
        return self.f1.drop(*scd2.FLAGS)

    @property
    def f2(self) -> DataFrame:
        return self.stored("version-2", lambda: self.m2.flagged)

    @property
    def t2(self) -> scd2.MergeResult:
        """The same two batches through the timeline merge."""
        first = lambda: self.stored("timeline-1", lambda: scd2.merge_timeline(self.h0, self.update).history)
        return self._get("t2", lambda: scd2.merge_timeline(first(), self.mixed))

    @property
    def m2(self) -> scd2.MergeResult:
        return self._get("m2", lambda: scd2.merge(self.h1, self.mixed))

    @property
    def h2(self) -> DataFrame:
        return self.f2.drop(*scd2.FLAGS)

    @property
    def log(self) -> DataFrame:
        def build():
            log = temporal.start_log(self.h0)
            for version, flagged in ((1, self.f1), (2, self.f2)):
                log = temporal.append_changes(log, flagged.filter(scd2.WRITTEN).drop(*scd2.FLAGS), version)
            return log
        return self._get("log", build)

    @property
    def lake(self) -> jobs.Layout:
        """Bronze of the three deliveries, from landing files with a header. Some records are broken:
        one field short, one too long, or a word for an amount."""
        key = (self.spark.sparkContext.applicationId, self.sf.rstrip("/"), "lake")
        if key not in _STORED:
            layout = jobs.Layout(scratch_path(self.spark, "lake"))
            for batch in (1, 2, 3):
                landing = f"{layout.root}/landing/{batch}"
                self.landing(batch).write.text(landing)
                jobs.ingest_batch(self.spark, layout, landing, batch, header=False)
            _STORED[key] = layout
        return _STORED[key]

    def landing(self, batch: int) -> DataFrame:
        """The lines of one delivery: every sending of the fixture, and a broken copy of some."""
        fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in TX_COLUMNS]
        line = F.concat_ws(",", *fields)
        number = F.regexp_extract("transaction_id", "[0-9]+", 0).cast("long")
        broken = (F.when(number % 50 == 1, F.concat_ws(",", *fields[:-1])).when(number % 50 == 2, F.concat(line, F.lit(",more")))
                  .when(number % 50 == 3, F.concat_ws(",", *fields[:4], F.lit("many"), *fields[5:])))
        sent = self.raw.filter(F.col(BATCH_COL) == batch)
        return sent.select(F.explode(F.array_compact(F.array(line, broken))).alias("value"))

    @property
    def silver_store(self) -> SilverStore:
        key = (self.spark.sparkContext.applicationId, self.sf.rstrip("/"), "silver store")
        if key not in _STORED:
            store = SilverStore(scratch_path(self.spark, "silver"), buckets=16, threshold=fixtures.FIXTURE_HIGH_VALUE)
            store.create(self.bronze)
            for batch in (1, 2, 3):
                store.add(self.bronze.filter(F.col(BATCH_COL) == batch), batch)
            _STORED[key] = store
        return _STORED[key]

    @property
    def snapshot_store(self) -> SnapshotStore:
        key = (self.spark.sparkContext.applicationId, self.sf.rstrip("/"), "snapshot store")
        if key not in _STORED:
            store = SnapshotStore(scratch_path(self.spark, "snapshot"), ACCOUNT_KEYS, ACCOUNT_TRACKED)
            for n, (hist, ts) in enumerate(zip((self.h0, self.h1, self.h2), SNAPSHOT_RUNS)):
                store.run(models.stg_accounts_current(models.stg_accounts(hist)), n, ts)
            _STORED[key] = store
        return _STORED[key]

    @property
    def stg_acc(self) -> DataFrame:
        return self._get("stg_acc", lambda: models.stg_accounts(self.h2))

    @property
    def stg_cur(self) -> DataFrame:
        return self._get("stg_cur", lambda: models.stg_accounts_current(self.stg_acc))

    @property
    def snapshot(self) -> DataFrame:
        def build():
            snap = None
            for hist, ts in zip((self.h0, self.h1, self.h2), SNAPSHOT_RUNS):
                cur = models.stg_accounts_current(models.stg_accounts(hist))
                snap = snapshot_check(snap, cur, ACCOUNT_KEYS, ACCOUNT_TRACKED, ts)
            return snap
        return self._get("snapshot", build)


# ---- step 1: minimum slice ---------------------------------------------------------------
def q_raw_transactions(L: Ledger) -> DataFrame:
    return L.raw


def q_dedup_latest(L: Ledger) -> DataFrame:
    return L.deduped


def q_dedup_faults(L: Ledger) -> DataFrame:
    """Keep-latest where ids are missing and copies share their ingestion time, and the reasons."""
    rows = dedup_latest(fixtures.fixture(L.spark, L.sf, "tx_faults"), "transaction_id", "ingestion_timestamp", ties=("amount",))
    return tag(rows, transaction_rules())


def q_dedup_stats(L: Ledger) -> DataFrame:
    return dedup_stats(L.bronze, "transaction_id")


def q_rule_amount(L: Ledger) -> DataFrame:
    return failing(L.deduped, amount_invalid()).select("transaction_id", "amount")


def q_rule_currency(L: Ledger) -> DataFrame:
    return failing(L.deduped, currency_invalid()).select("transaction_id", "currency")


def q_tagged(L: Ledger) -> DataFrame:
    return L.tagged


def q_silver_valid(L: Ledger) -> DataFrame:
    return L.silver


def q_stg_transactions(L: Ledger) -> DataFrame:
    return _decimals_to_double(L.stg)


def q_fct_daily(L: Ledger) -> DataFrame:
    return _decimals_to_double(L.mart)


def q_mart_totals(L: Ledger) -> DataFrame:
    return _decimals_to_double(models.mart_totals(L.mart))


# ---- step 2: routing metrics -------------------------------------------------------------
def q_mask_pii(L: Ledger) -> DataFrame:
    return mask(L.raw.select(*TX_COLUMNS), TRANSACTION_MASK)


def q_bronze_append(L: Ledger) -> DataFrame:
    """The three deliveries as landing files, read with the declared schema, masked and appended."""
    return L.spark.read.parquet(L.lake.bronze)


def q_unparsed_records(L: Ledger) -> DataFrame:
    """Records of the landing files that do not parse, with their text."""
    return L.spark.read.parquet(L.lake.unparsed).select(BATCH_COL, F.col(CORRUPT_COL).alias("record"))


def q_silver_incremental(L: Ledger) -> DataFrame:
    """Silver after three deliveries, each merged into the buckets of its keys."""
    return L.silver_store.silver(L.spark)


def q_mart_incremental(L: Ledger) -> DataFrame:
    """The daily mart after three deliveries, from what each added or took away."""
    return _decimals_to_double(L.silver_store.daily_mart(L.spark))


def q_dead_letter(L: Ledger) -> DataFrame:
    return L.dead


def q_route_totals(L: Ledger) -> DataFrame:
    return metrics(L.tagged)


def q_batch_metrics(L: Ledger) -> DataFrame:
    return batch_metrics(L.tagged, L.batch_ids())


def q_batch_compare(L: Ledger) -> DataFrame:
    return audit.batch_compare(L.tagged)


def q_reason_breakdown(L: Ledger) -> DataFrame:
    return reason_breakdown(of_delivery(L.dead, L.batch_ids()))


def q_delivery_compare(L: Ledger) -> DataFrame:
    """Every delivery by its landing ids: a record that is sent again counts in both deliveries."""
    return compare_deliveries(L.tagged, L.raw, BATCH_COL)


def q_failed_rules(L: Ledger) -> DataFrame:
    return failed_rules(L.deduped, transaction_rules()).groupBy("failed_rules").agg(F.count(F.lit(1)).alias("row_count"))


def q_ingestion_lag(L: Ledger) -> DataFrame:
    return audit.ingestion_lag(L.silver)


# ---- step 3: SCD2 ------------------------------------------------------------------------
def _classified(L: Ledger):
    return L._get("classified", lambda: scd2.classify(L.h1, L.mixed))


def _window_cols(prefix: str) -> list:
    return ["account_id", "effective_date", "account_status", "credit_limit",
            F.col("_w_from").alias(f"{prefix}_valid_from"), F.col("_w_to").alias(f"{prefix}_valid_to"),
            F.col("_w_account_status").alias(f"{prefix}_status"),
            F.col("_w_credit_limit").alias(f"{prefix}_credit_limit")]


def q_raw_account_states(L: Ledger) -> DataFrame:
    return L.mixed


def q_scd2_initial(L: Ledger) -> DataFrame:
    return L.h0


def q_accounts_current(L: Ledger) -> DataFrame:
    return _decimals_to_double(L.stg_cur)


def q_scd2_normal(L: Ledger) -> DataFrame:
    return _classified(L).filter(F.col("outcome") == scd2.FORWARD).select(*_window_cols("current"))


def q_scd2_late_window(L: Ledger) -> DataFrame:
    return _classified(L).filter(F.col("outcome") == scd2.LATE_SPLIT).select(*_window_cols("h"))


def q_scd2_late_noop(L: Ledger) -> DataFrame:
    return _classified(L).filter(F.col("outcome") == scd2.LATE_NO_OP).select(*_window_cols("h"))


def q_scd2_staged(L: Ledger) -> DataFrame:
    return L.m2.staged.select("account_id", "valid_from", "account_status", "credit_limit", "valid_to",
                              "is_current", F.col("_kind").alias("kind"))


def q_scd2_merge(L: Ledger) -> DataFrame:
    return L.m2.history


def q_scd2_merge_timeline(L: Ledger) -> DataFrame:
    return L.t2.history


def q_scd2_merge_lookup(L: Ledger) -> DataFrame:
    """Both batches merged copy-on-write into the stored, bucketed history, and the table as read:
    each merge looks up and replaces the buckets of its batch only."""
    return L.store.current(L.spark)


def q_write_audit(L: Ledger) -> DataFrame:
    """Observed writes of the stored history against its change log as read."""
    return L.store.check_writes(L.spark)


def q_history_checkpoint(L: Ledger) -> DataFrame:
    """Version 1 of the stored history: the state of version 0 and one version's changes."""
    return L.store.as_of(L.spark, 1)


def q_scd2_outcomes_timeline(L: Ledger) -> DataFrame:
    return L.t2.outcomes


def q_scd2_outcomes(L: Ledger) -> DataFrame:
    return L.m2.outcomes


def _faults(L: Ledger) -> scd2.MergeResult:
    return L._get("faults", lambda: scd2.merge(L.h2, fixtures.fixture(L.spark, L.sf, "acct_faults")))


def q_scd2_faults(L: Ledger) -> DataFrame:
    """The history after a batch with ambiguous and incomplete statements."""
    return _faults(L).history


def q_scd2_outcomes_faults(L: Ledger) -> DataFrame:
    return _faults(L).outcomes


def q_scd2_totals(L: Ledger) -> DataFrame:
    return L.h2.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col("is_current")).alias("current_rows"),
                    F.count_if(~F.col("is_current")).alias("historical_rows"))


def q_scd2_invariants(L: Ledger) -> DataFrame:
    return scd2.check_timeline(L.h2)


def q_scd2_invariants_split(L: Ledger) -> DataFrame:
    return scd2.check_timeline(L.h2, split_days=30)


def q_account_trace(L: Ledger) -> DataFrame:
    return scd2.trace(L.h2)


def q_stg_accounts(L: Ledger) -> DataFrame:
    return _decimals_to_double(L.stg_acc)


# ---- step 4: temporal ----------------------------------------------------------------------
def q_history_as_of_version(L: Ledger) -> DataFrame:
    return temporal.as_of_version(L.log, 1)


def q_version_log(L: Ledger) -> DataFrame:
    return L.store.version_log(L.spark)


def q_v0_vs_now(L: Ledger) -> DataFrame:
    return audit.compare_states(L.store.as_of(L.spark, 0), L.store.current(L.spark))


def q_v0_vs_now_top10(L: Ledger) -> DataFrame:
    return audit.top_accounts(q_v0_vs_now(L), 10)


def q_state_on_date(L: Ledger) -> DataFrame:
    return temporal.state_on(L.h2, STATE_DATE)


def q_as_of_join(L: Ledger) -> DataFrame:
    facts = L.raw.select("transaction_id", "account_id", "event_timestamp", "amount")
    return temporal.as_of_join(facts, L.h2, date_col="event_timestamp")


def q_as_of_join_range(L: Ledger) -> DataFrame:
    """The half-open range semantics on windows listed by span: a fact meets those of its key and span."""
    facts = L.raw.select("transaction_id", "account_id", "event_timestamp", "amount")
    return temporal.as_of_join_spans(facts, L.h2, date_col="event_timestamp")


# ---- step 5: checks ------------------------------------------------------------------------
def _broken_copy(silver: DataFrame) -> DataFrame:
    """All of silver; the smallest id gets a negative amount, the greatest a lowercase currency."""
    ends = silver.agg(F.min("transaction_id").alias("lo"), F.max("transaction_id").alias("hi"))
    faults = (ends.select(F.explode(F.array("lo", "hi")).alias("_id"), "lo", "hi")
              .select("_id", (F.col("_id") == F.col("lo")).alias("_low"), (F.col("_id") == F.col("hi")).alias("_high")).distinct())
    s = silver.join(faults, F.col("transaction_id") == F.col("_id"), "left")
    return (s.withColumn("amount", F.when(F.col("_low"), F.lit(-50.0)).otherwise(F.col("amount")))
            .withColumn("currency", F.when(F.col("_high"), F.lit("usd")).otherwise(F.col("currency")))
            .drop("_id", "_low", "_high"))


def q_expectations(L: Ledger) -> DataFrame:
    return C.run_suite(L.silver, C.transaction_expectations())


def q_expectations_broken(L: Ledger) -> DataFrame:
    return C.run_suite(_broken_copy(L.silver), C.transaction_expectations())


def q_expectation_failures(L: Ledger) -> DataFrame:
    return C.suite_failures(L.deduped, C.transaction_expectations(),
                            ("transaction_id", "account_id", "amount", "currency"))


def q_contract(L: Ledger) -> DataFrame:
    return C.run_suite(L.raw.select(*TX_COLUMNS), C.transaction_contract())


def q_contract_types(L: Ledger) -> DataFrame:
    """Types of an all-string read; some amounts and event times are words."""
    key = F.col("transaction_id")
    strings = L.raw.select(*[F.col(c).cast("string").alias(c) for c in TX_COLUMNS])
    strings = (strings.withColumn("amount", F.when(key.endswith("7"), "n/a").otherwise(F.col("amount")))
               .withColumn("event_timestamp", F.when(key.endswith("31"), "yesterday").otherwise(F.col("event_timestamp"))))
    return C.check_types(strings)


def _model_tests(L: Ledger, which: str) -> DataFrame:
    # Tests run on the stored layers, as after a build.
    stg = models.stg_transactions(L.stored("silver", lambda: L.silver))
    acc, cur, mart = L.stg_acc, L.stg_cur, L.stored("mart", lambda: L.mart)
    if which == "unique":
        parts = [C.test_unique(stg, "stg_transactions", "transaction_id"),
                 C.test_unique(cur, "stg_accounts_current", "account_id"),
                 C.test_unique(mart, "fct_transactions_daily", "transaction_date")]
    elif which == "not_null":
        parts = [C.test_not_null(stg, "stg_transactions", "transaction_id", "account_id", "amount"),
                 C.test_not_null(acc, "stg_accounts", "account_id"),
                 C.test_not_null(cur, "stg_accounts_current", "account_id"),
                 C.test_not_null(mart, "fct_transactions_daily", "transaction_date")]
    elif which == "accepted_values":
        parts = [C.test_accepted_values(stg, "stg_transactions", "currency", ACCEPTED_CURRENCIES),
                 C.test_accepted_values(acc, "stg_accounts", "account_status", ACCEPTED_STATUSES)]
    elif which == "relationships":
        parts = [C.test_relationships(stg, "stg_transactions", "account_id", cur, "account_id")]
    else:
        parts = [C.test_zero_rows(stg, "stg_transactions", "amount", F.col("amount") < 0, "assert_no_negative_amounts")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return C.with_success(out)


def q_contract_json(L: Ledger) -> DataFrame:
    """The contract on JSON records as they came: some stamps lack their zone, some amounts are words."""
    key = F.col("transaction_id")
    stamp = lambda c: F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.when(key.endswith("31"), "").otherwise("Z"))
    fields = {c: F.col(c) for c in TX_COLUMNS} | {c: stamp(c) for c in TX_COLUMNS if c.endswith("timestamp")}
    uuid = F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(F.regexp_extract("transaction_id", "[0-9]+", 0), 12, "0"))
    fields["transaction_id"] = F.when(key.endswith("77"), key).otherwise(uuid)
    fields["amount"] = F.when(key.endswith("7"), F.lit('"n/a"')).otherwise(F.col("amount").cast("string"))
    # (to_json would quote the amounts: a number stands as it is)
    text = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items() if n != "amount"]))
    record = F.concat(F.lit('{"amount":'), F.coalesce(fields["amount"], F.lit("null")), F.lit(","), F.substr(text, F.lit(2)))
    records = L.raw.select(record.alias("record"))
    schema = ", ".join(f"{c} string" for c in TX_COLUMNS)
    return C.run_suite(records.select(F.from_json("record", schema).alias("r")).select("r.*"), C.text_contract(json=True))


# ---- step 6: snapshot ----------------------------------------------------------------------
def q_snapshot_check(L: Ledger) -> DataFrame:
    return _decimals_to_double(L.snapshot)


def q_snapshot_append(L: Ledger) -> DataFrame:
    """The same three runs on stored partitions, closed records written once."""
    store = L.snapshot_store
    return _decimals_to_double(store.records(L.spark, len(SNAPSHOT_RUNS) - 1))


def q_scd2_vs_snapshot(L: Ledger) -> DataFrame:
    m = L.h2.groupBy("account_id").agg(F.count(F.lit(1)).alias("merge_windows"),
                                       F.min("valid_from").alias("merge_first_from"))
    s = L.snapshot.groupBy("account_id").agg(F.count(F.lit(1)).alias("snapshot_records"),
                                             F.min("dbt_valid_from").alias("snapshot_first_from"))
    j = m.join(s, "account_id", "full")
    return j.withColumn("differs", ~F.col("merge_windows").eqNullSafe(F.col("snapshot_records")))


_STEPS: dict[str, Callable[[Ledger], DataFrame]] = {
    "raw_transactions": q_raw_transactions, "dedup_latest": q_dedup_latest, "dedup_stats": q_dedup_stats,
    "rule_amount": q_rule_amount, "rule_currency": q_rule_currency, "tagged": q_tagged,
    "silver_valid": q_silver_valid, "stg_transactions": q_stg_transactions, "fct_daily": q_fct_daily,
    "mart_totals": q_mart_totals,
    "mask_pii": q_mask_pii, "dead_letter": q_dead_letter, "route_totals": q_route_totals,
    "batch_metrics": q_batch_metrics, "batch_compare": q_batch_compare, "delivery_compare": q_delivery_compare,
    "failed_rules": q_failed_rules, "reason_breakdown": q_reason_breakdown,
    "ingestion_lag": q_ingestion_lag, "bronze_append": q_bronze_append,
    "raw_account_states": q_raw_account_states, "scd2_initial": q_scd2_initial,
    "accounts_current": q_accounts_current, "scd2_normal": q_scd2_normal, "scd2_late_window": q_scd2_late_window,
    "scd2_late_noop": q_scd2_late_noop, "scd2_staged": q_scd2_staged, "scd2_merge": q_scd2_merge,
    "scd2_merge_timeline": q_scd2_merge_timeline, "scd2_merge_lookup": q_scd2_merge_lookup, "write_audit": q_write_audit, "history_checkpoint": q_history_checkpoint, "scd2_outcomes": q_scd2_outcomes,
    "dedup_faults": q_dedup_faults, "scd2_faults": q_scd2_faults, "scd2_outcomes_faults": q_scd2_outcomes_faults,
    "scd2_outcomes_timeline": q_scd2_outcomes_timeline, "scd2_totals": q_scd2_totals,
    "scd2_invariants": q_scd2_invariants, "scd2_invariants_split": q_scd2_invariants_split, "account_trace": q_account_trace, "stg_accounts": q_stg_accounts,
    "history_as_of_version": q_history_as_of_version, "version_log": q_version_log, "v0_vs_now": q_v0_vs_now,
    "v0_vs_now_top10": q_v0_vs_now_top10, "state_on_date": q_state_on_date, "as_of_join": q_as_of_join,
    "as_of_join_range": q_as_of_join_range,
    "expectations": q_expectations, "expectations_broken": q_expectations_broken,
    "expectation_failures": q_expectation_failures, "contract": q_contract, "contract_types": q_contract_types,
    "test_unique": lambda L: _model_tests(L, "unique"), "test_not_null": lambda L: _model_tests(L, "not_null"),
    "test_accepted_values": lambda L: _model_tests(L, "accepted_values"),
    "test_relationships": lambda L: _model_tests(L, "relationships"),
    "test_no_negative": lambda L: _model_tests(L, "no_negative"),
    "unparsed_records": q_unparsed_records, "silver_incremental": q_silver_incremental, "mart_incremental": q_mart_incremental,
    "contract_json": q_contract_json, "snapshot_check": q_snapshot_check, "snapshot_append": q_snapshot_append, "scd2_vs_snapshot": q_scd2_vs_snapshot,
}


_LEDGERS: dict[tuple[str, str], Ledger] = {}
#: What a session has written: paths and stores by (application, data, name).
_STORED: dict[tuple[str, str, str], object] = {}


def ledger(spark: SparkSession, sf_dir: str) -> Ledger:
    """The lazily built plans of one session and scale factor, defined once and shared by the
    queries (plans only; nothing is cached in memory and every query re-reads its files)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _LEDGERS or _LEDGERS[key].spark is not spark:
        _LEDGERS[key] = Ledger(spark, sf_dir)
    ensure_utc(spark)
    return _LEDGERS[key]


def fresh_ledgers() -> None:
    """Forget all plans, so that the next query lists its files and builds its plan anew. Stored
    versions stay: a query on the history reads it and does not rebuild it."""
    _LEDGERS.clear()


def fresh_stores() -> None:
    """Forget what was written as well."""
    _LEDGERS.clear()
    _STORED.clear()


def _bind(step: Callable[[Ledger], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return step(ledger(spark, sf_dir))
    run.__doc__ = step.__doc__
    return run


QUERIES: dict[str, Query] = {name: _bind(step) for name, step in _STEPS.items()}

FLAGSHIP = "fct_daily"
