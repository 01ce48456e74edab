"""Set-level quality checks as Spark aggregates.

A suite is one global aggregate for all row checks (``count_if`` per check) and one key-only pass
per column with a uniqueness check: partial counts per key, summed once; map-side combine means
a hot key costs one partial row per task, never a collected group. Results are small DataFrames:
``check_name, column_name, unexpected_count, success``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import (
    CURRENCY_PATTERN, OFFSET_TIMESTAMP_PATTERN, SSN_PATTERN, TRANSACTION_SCHEMA, UUID_PATTERN,
)


class DataQualityError(RuntimeError):
    def __init__(self, failed: list[str]):
        super().__init__(f"Data quality check failed: {failed}")
        self.failed = failed


@dataclass(frozen=True)
class Check:
    name: str
    column: str
    kind: str = "row"  # "row", "unique" (every copy counts) or "primary_key" (copies + NULLs)
    failed: Callable[[], Column] | None = None  # row kind: true when a row fails; NULL does not count

    def condition(self) -> Column:
        return F.coalesce(self.failed(), F.lit(False))


# ---- constructors ------------------------------------------------------------------------
def not_null(col: str, name: str = "expect_column_values_to_not_be_null") -> Check:
    return Check(name, col, "row", lambda: F.col(col).isNull())


def between(col: str, lo, hi, name: str = "expect_column_values_to_be_between") -> Check:
    return Check(name, col, "row", lambda: ~F.col(col).between(F.lit(lo), F.lit(hi)))


def matches(col: str, pattern: str, name: str = "expect_column_values_to_match_regex") -> Check:
    return Check(name, col, "row", lambda: ~F.col(col).rlike(pattern))


def unique(col: str, name: str = "expect_column_values_to_be_unique") -> Check:
    return Check(name, col, "unique")


def length_at_least(col: str, n: int, name: str = "minLength") -> Check:
    return Check(name, col, "row", lambda: F.length(F.col(col)) < n)


def length_at_most(col: str, n: int, name: str = "maxLength") -> Check:
    return Check(name, col, "row", lambda: F.length(F.col(col)) > n)


def greater_than(col: str, v, name: str = "exclusiveMinimum") -> Check:
    return Check(name, col, "row", lambda: ~(F.col(col) > F.lit(v)))


def at_most(col: str, v, name: str = "maximum") -> Check:
    return Check(name, col, "row", lambda: ~(F.col(col) <= F.lit(v)))


def has_offset(col: str, name: str = "format:date-time") -> Check:
    """A timestamp string must carry a zone: ``Z`` or ``+hh:mm``."""
    return Check(name, col, "row", lambda: ~F.col(col).rlike(OFFSET_TIMESTAMP_PATTERN))


# ---- suites ------------------------------------------------------------------------------
def transaction_expectations() -> list[Check]:
    """The expectation suite of the silver transactions (fixed thresholds)."""
    return [not_null("transaction_id"), not_null("account_id"), not_null("amount"),
            between("amount", 0.01, 1_000_000), matches("currency", CURRENCY_PATTERN),
            unique("transaction_id")]


def transaction_contract(with_uuid: bool = True) -> list[Check]:
    """Field constraints of the raw transaction feed (checked before masking)."""
    checks = [Check("required", f.name, "row", (lambda c=f.name: F.col(c).isNull())) for f in TRANSACTION_SCHEMA]
    checks += [unique("transaction_id", "unique"), Check("primaryKey", "transaction_id", "primary_key")]
    if with_uuid:
        checks.append(matches("transaction_id", UUID_PATTERN, "format:uuid"))
    checks += [length_at_least("ssn_last4", 4), length_at_most("ssn_last4", 4), matches("ssn_last4", SSN_PATTERN, "pattern"),
               greater_than("amount", 0), at_most("amount", 1_000_000),
               length_at_least("currency", 3), length_at_most("currency", 3),
               matches("currency", CURRENCY_PATTERN, "pattern")]
    return checks


def text_contract(json: bool = False) -> list[Check]:
    """The whole contract of the feed on undecoded text (every field a string, see
    ``sources.ingest.read_strings``): a type check per field, the field constraints, and for a JSON
    delivery one check of the record's formats, which a decoded value no longer shows: identifiers
    are uuids and timestamps carry their zone. 28 checks, or 29."""
    number = lambda: F.col("amount").try_cast("double")
    checks = []
    for c, logical in TRANSACTION_LOGICAL_TYPES.items():
        cast_to = _CASTS.get(logical)
        wrong = (lambda c=c, t=cast_to: F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()) if cast_to else (lambda: F.lit(False))
        checks.append(Check("type", c, "row", wrong))
    for check in transaction_contract(with_uuid=False):
        if check.column == "amount" and check.name == "exclusiveMinimum":
            check = Check(check.name, "amount", "row", lambda: ~(number() > 0))
        elif check.column == "amount" and check.name == "maximum":
            check = Check(check.name, "amount", "row", lambda: ~(number() <= 1_000_000))
        checks.append(check)
    if json:
        zones = [~F.col(c).rlike(OFFSET_TIMESTAMP_PATTERN) for c, t in TRANSACTION_LOGICAL_TYPES.items() if t == "timestamp"]
        wrong = reduce(lambda p, q: p | q, [F.coalesce(z, F.lit(False)) for z in [~F.col("transaction_id").rlike(UUID_PATTERN), *zones]])
        checks.append(Check("format", "record", "row", lambda: wrong))
    return checks


TRANSACTION_LOGICAL_TYPES = {
    "transaction_id": "string", "account_id": "string", "customer_name": "string", "ssn_last4": "string",
    "amount": "number", "currency": "string", "transaction_type": "string",
    "event_timestamp": "timestamp", "ingestion_timestamp": "timestamp",
}

_CASTS = {"number": "double", "integer": "bigint", "timestamp": "timestamp", "date": "date", "boolean": "boolean"}


# ---- runners -----------------------------------------------------------------------------
def _dup_rows(df: DataFrame, col: str) -> DataFrame:
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > 1))


def _result(name: str, column: str, unexpected: Column) -> list[Column]:
    return [F.lit(name).alias("check_name"), F.lit(column).alias("column_name"),
            unexpected.cast("bigint").alias("unexpected_count")]


def run_suite(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: check_name, column_name, unexpected_count, success.

    All row checks and NULL counts are one global aggregate, which shuffles one row per task.
    Each column with a uniqueness check adds one pass that reads and shuffles that column alone.
    """
    if any(c.kind not in ("row", "unique", "primary_key") for c in checks):
        raise ValueError("unknown check kind")
    row_checks = [c for c in checks if c.kind == "row"]
    parts = []
    if row_checks:
        wide = df.agg(*[F.count_if(c.condition()).alias(f"_f{i}") for i, c in enumerate(row_checks)])
        parts.append(wide.select(F.inline(F.array(*[F.struct(*_result(c.name, c.column, F.col(f"_f{i}")))
                                                    for i, c in enumerate(row_checks)]))))
    for column in dict.fromkeys(c.column for c in checks if c.kind != "row"):
        # copies of repeated values, and NULLs (the group of the NULL key), counted apart
        n, null = F.col("_n"), F.col(column).isNull()
        counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).agg(
            F.coalesce(F.sum(F.when(~null & (n > 1), n)), F.lit(0)).alias("_dup"),
            F.coalesce(F.sum(F.when(null, n)), F.lit(0)).alias("_nulls"))
        parts.append(counts.select(F.inline(F.array(*[
            F.struct(*_result(c.name, c.column, F.col("_dup") + (F.col("_nulls") if c.kind == "primary_key" else F.lit(0))))
            for c in checks if c.kind != "row" and c.column == column]))))
    res = reduce(DataFrame.unionByName, parts)
    return res.withColumn("success", F.col("unexpected_count") == 0)


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The offending rows of one check (the complete result)."""
    if check.kind == "row":
        return df.filter(check.condition())
    dups = _dup_rows(df, check.column).select(check.column)
    hit = df.join(dups, check.column, "left_semi")
    if check.kind == "primary_key":
        hit = hit.unionByName(df.filter(F.col(check.column).isNull()))
    return hit


def suite_failures(df: DataFrame, checks: Sequence[Check], columns: Sequence[str] = ("transaction_id",)) -> DataFrame:
    """All offending rows of a suite: check_name, column_name and the given row columns.

    Row checks are one scan: every row is exploded into the checks it fails. Each uniqueness
    check adds one keyed semi join."""
    columns = list(columns)
    row_checks = [c for c in checks if c.kind == "row"]
    parts = []
    if row_checks:
        hits = F.array_compact(F.array(*[
            F.when(c.condition(), F.struct(F.lit(c.name).alias("check_name"), F.lit(c.column).alias("column_name")))
            for c in row_checks]))
        parts.append(df.select(*columns, F.explode(hits).alias("_hit"))
                     .select("_hit.check_name", "_hit.column_name", *columns))
    for c in checks:
        if c.kind != "row":
            parts.append(failing_rows(df, c).select(F.lit(c.name).alias("check_name"),
                                                    F.lit(c.column).alias("column_name"), *columns))
    return reduce(DataFrame.unionByName, parts)


def enforce(result: DataFrame) -> None:
    """Raise with the failed check names (the result has one row per check: tiny)."""
    failed = [f"{r.check_name}({r.column_name})" for r in
              result.filter(~F.col("success")).select("check_name", "column_name").collect()]
    if failed:
        raise DataQualityError(failed)


def check_types(strings: DataFrame, logical_types: Mapping[str, str] = TRANSACTION_LOGICAL_TYPES) -> DataFrame:
    """Presence and logical type of every declared field of an all-string read.

    One row per field: column_name, logical_type, present, type_failures (non-NULL values that
    do not convert; NULL when the field is missing). One aggregate pass.
    """
    present = [c for c in logical_types if c in strings.columns]
    aggs = []
    for c in present:
        cast_to = _CASTS.get(logical_types[c])
        bad = F.col(c).isNotNull() & F.col(c).cast("string").try_cast(cast_to).isNull() if cast_to else F.lit(False)
        aggs.append(F.count_if(bad).alias(c))
    wide = strings.agg(*aggs) if aggs else strings.agg(F.count(F.lit(1)).alias("_n"))
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("logical_type"),
                     F.lit(c in present).alias("present"),
                     (F.col(c) if c in present else F.lit(None)).cast("bigint").alias("type_failures"))
            for c, t in logical_types.items()]
    return wide.select(F.inline(F.array(*rows)))


# ---- model tests (zero offending rows = pass) ---------------------------------------------
def _test_row(test: str, model: str, column: str, failures: DataFrame) -> DataFrame:
    return failures.select(F.lit(test).alias("test_name"), F.lit(model).alias("model"),
                           F.lit(column).alias("column_name"), F.col("_x").cast("bigint").alias("failures"))


def test_unique(df: DataFrame, model: str, col: str) -> DataFrame:
    """Number of values that occur more than once."""
    return _test_row("unique", model, col, _dup_rows(df, col).agg(F.count(F.lit(1)).alias("_x")))


def test_not_null(df: DataFrame, model: str, *cols: str) -> DataFrame:
    """NULLs of each column; one pass over the model for all of them."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit("not_null").alias("test_name"), F.lit(model).alias("model"), F.lit(c).alias("column_name"),
                 F.col(c).cast("bigint").alias("failures")) for c in cols])))


def test_accepted_values(df: DataFrame, model: str, col: str, values: Sequence) -> DataFrame:
    """Number of distinct non-NULL values outside the accepted set."""
    bad = df.filter(~F.col(col).isin(list(values))).select(col).distinct()
    return _test_row("accepted_values", model, col, bad.agg(F.count(F.lit(1)).alias("_x")))


def test_relationships(child: DataFrame, model: str, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row.

    Child keys are counted first (partial aggregation), so a key holding a third of the child
    rows reaches the anti join as one row with its count; the result is still a row count."""
    keys = child.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    orphans = keys.join(parent.select(F.col(field).alias(col)), col, "left_anti")
    return _test_row("relationships", model, col, orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_x")))


def test_zero_rows(df: DataFrame, model: str, col: str, offending: Column, test: str) -> DataFrame:
    return _test_row(test, model, col, df.agg(F.count_if(F.coalesce(offending, F.lit(False))).alias("_x")))


def with_success(tests: DataFrame) -> DataFrame:
    return tests.withColumn("success", F.col("failures") == 0)
