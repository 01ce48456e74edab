"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed in full through the ``noop`` sink (no collect to the driver); the
reported time is the median of $BENCH_REPS runs after one warm-up run of the whole set. Queries on
the history read versions that an earlier job has stored; ``builds`` is what storing them takes, and
``planning`` the part of a query's time that goes into building and planning it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ledgerspark.functions.rules import transaction_rules  # noqa: E402
from ledgerspark.operators import checks as C  # noqa: E402
from ledgerspark.plans.catalog import QUERIES, fresh_ledgers, fresh_stores, ledger  # noqa: E402
from ledgerspark.session import build_session  # noqa: E402

HEADLINE = ["dedup_latest", "tagged", "batch_metrics", "batch_compare", "fct_daily", "ingestion_lag",
            "scd2_merge", "scd2_merge_timeline", "scd2_invariants", "as_of_join", "v0_vs_now",
            "expectations", "contract", "snapshot_check", "delivery_compare", "test_not_null", "test_unique"]


def run(spark, name, sf_dir) -> float:
    fresh_ledgers()  # every timed run lists files and plans anew
    t = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def timed(action) -> float:
    t = time.perf_counter()
    action()
    return time.perf_counter() - t


PLANNED = ["scd2_merge", "v0_vs_now", "snapshot_check", "test_not_null"]


def planning(spark, name, sf_dir) -> float:
    fresh_ledgers()
    return timed(lambda: QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan())


def builds(spark, sf_dir) -> dict:
    """Seconds to write what later queries read: both versions, the bucketed history with its log
    and audit, three deliveries into silver and mart, three snapshot runs."""
    fresh_stores()
    L = ledger(spark, sf_dir)
    return {name: round(timed(lambda: getattr(L, name)), 3) for name in ("h1", "h2", "store", "silver_store", "snapshot_store")}


def variants(spark, sf_dir, reps) -> dict:
    """Design comparisons: rule tagging as array + lambda (the original form) against
    ``concat_ws`` of ``when``s, and a check suite as one job per check against one pass."""
    deduped = ledger(spark, sf_dir).deduped
    rules = transaction_rules()
    arr = F.array(*[F.when(r.condition(), F.lit(r.name)) for r in rules])
    array_form = deduped.withColumn("rejection_reason", F.array_join(F.filter(arr, lambda x: x.isNotNull()), "; "))
    concat_form = deduped.withColumn("rejection_reason", F.concat_ws("; ", *[F.when(r.condition(), F.lit(r.name))
                                                                           for r in rules]))
    silver = ledger(spark, sf_dir).silver
    suite = C.transaction_expectations()

    def job_per_check():
        for c in suite:
            if c.kind == "row":
                silver.filter(c.condition()).count()
            else:
                C.failing_rows(silver, c).count()

    def noop(df):
        return lambda: df.write.format("noop").mode("overwrite").save()

    out = {}
    for name, action in (("tagging_array_lambda", noop(array_form)), ("tagging_concat_ws", noop(concat_form)),
                         ("suite_job_per_check", job_per_check),
                         ("suite_one_pass", noop(C.run_suite(silver, suite)))):
        action()
        out[name] = round(statistics.median(timed(action) for _ in range(reps)), 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    scratch = tempfile.mkdtemp(prefix="ledgerspark-bench-")
    spark = build_session(f"local[{cpus}]", app="ledgerspark-bench", shuffle_partitions=int(cpus) * 2,
                          checkpoint_dir=os.path.join(scratch, "checkpoints"))
    for n in names:  # warm-up: JIT, file listing, broadcast of small tables
        run(spark, n, sf_dir)
    results = {n: statistics.median(run(spark, n, sf_dir) for _ in range(reps)) for n in names}
    planned = {n: round(statistics.median(planning(spark, n, sf_dir) for _ in range(reps)), 3) for n in PLANNED if n in names}
    built = builds(spark, sf_dir) if os.environ.get("BENCH_VARIANTS", "1") == "1" else {}
    L = ledger(spark, sf_dir)
    rows = {"tx_raw": L.raw.count(), "deduped": L.deduped.count(), "acct_initial": L.h0.count(),
            "acct_mixed": L.mixed.count(), "history_v2": L.h2.count()}
    extra = variants(spark, sf_dir, reps) if os.environ.get("BENCH_VARIANTS", "1") == "1" else {}
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(results.values()), 3), "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in results.items()}, "sf": sf,
                      "cpus": int(cpus), "reps": reps, "input_rows": rows, "planning": planned, "builds": built, "variants": extra}))
    spark.stop()


if __name__ == "__main__":
    main()
