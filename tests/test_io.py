"""Sources, sinks, durable jobs and streaming ingest on temporary folders."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerspark.plans import jobs
from ledgerspark.plans.catalog import Ledger
from ledgerspark.sources import sinks
from ledgerspark.sources.ingest import read_batch, read_keys, read_strings
from ledgerspark.sources.schemas import TRANSACTION_SCHEMA
from ledgerspark.streaming.ingest import stream_ingest

HEADER = ("transaction_id,account_id,customer_name,ssn_last4,amount,currency,transaction_type,"
          "event_timestamp,ingestion_timestamp\n")


def line(i, amount="10.5", currency="USD", lag_min=5):
    return (f"T{i},A{i % 3},Name {i},{1000 + i},{amount},{currency},purchase,"
            f"2024-01-01T10:00:00Z,2024-01-01T10:{lag_min:02d}:00Z\n")


def write_csv(path, lines):
    path.write_text(HEADER + "".join(lines))
    return str(path)


def test_csv_json_and_key_reads(spark, tmp_path):
    p = write_csv(tmp_path / "b1.csv", [line(1), line(2, amount="-3")])
    df = read_batch(spark, p, TRANSACTION_SCHEMA, batch_id=1)
    assert df.count() == 2 and df.schema["event_timestamp"].dataType.typeName() == "timestamp"
    assert read_keys(spark, p).columns == ["transaction_id"]
    recs = [dict(transaction_id="T9", account_id="A1", customer_name="N", ssn_last4="1234", amount=1.5,
                 currency="EUR", transaction_type="deposit", event_timestamp="2024-01-01T10:00:00Z",
                 ingestion_timestamp="2024-01-01T10:01:00+00:00")]
    j = tmp_path / "t.json"
    j.write_text(json.dumps(recs))
    jd = read_batch(spark, str(j), TRANSACTION_SCHEMA, fmt="json")
    assert jd.first().amount == 1.5
    assert [tuple(r) for r in read_keys(spark, str(j), fmt="json").collect()] == [("T9",)]
    with pytest.raises(ValueError):
        read_keys(spark, str(j), fmt="xml")
    assert read_strings(spark, str(j), fmt="json").schema["amount"].dataType.typeName() == "string"


def test_routes_written_once_with_observed_counts(spark, sf_small, tmp_path):
    L = Ledger(spark, sf_small)
    counts = sinks.write_routes(L.tagged, str(tmp_path / "routes"))
    assert counts == {"total": 1500, "valid": 1410, "dead": 90}
    assert sinks.read_route(spark, str(tmp_path / "routes"), "valid").count() == 1410
    dead = sinks.read_route(spark, str(tmp_path / "routes"), "dead_letter")
    assert dead.count() == 90 and "rejection_reason" in dead.columns


def test_jobs_end_to_end(spark, tmp_path):
    layout = jobs.Layout(str(tmp_path / "lake"))
    b1 = write_csv(tmp_path / "b1.csv", [line(i) for i in range(10)])
    b2 = write_csv(tmp_path / "b2.csv", [line(i, amount="", currency="usd") for i in range(10, 13)]
                   + [line(3, amount="11.5", lag_min=50)])
    jobs.ingest_batch(spark, layout, b1, 1)
    jobs.ingest_batch(spark, layout, b2, 2)
    jobs.ingest_batch(spark, layout, b2, 2)  # a rerun replaces batch 2, it does not duplicate it
    assert spark.read.parquet(layout.bronze).count() == 14
    counts = jobs.refresh_silver(spark, layout)
    assert counts == {"total": 13, "valid": 10, "dead": 3}
    assert jobs.silver(spark, layout).filter("transaction_id = 'T3'").first().amount == 11.5
    m = jobs.delivery_metrics(spark, layout, b2).first()
    assert (m.total, m.valid, m.dead, m.rejection_rate) == (4, 1, 3, 75.0)
    jobs.build_mart(spark, layout)
    assert spark.read.parquet(layout.mart).first().transaction_count == 10
    jobs.validate_silver(spark, layout)

    acc = tmp_path / "acc0.csv"
    acc.write_text("account_id,account_status,credit_limit,effective_date\nA0,active,100,2020-01-01\n"
                   "A1,active,200,2020-01-01\n")
    jobs.load_initial_history(spark, layout, str(acc))
    batch = spark.createDataFrame([("A0", "frozen", 100, "2021-01-01"), ("A1", "active", 300, "2020-06-01")],
                                  "account_id string, account_status string, credit_limit int, effective_date string") \
        .withColumn("effective_date", F.to_date("effective_date"))
    jobs.apply_account_batch(spark, layout, batch, 1)
    out = jobs.apply_account_batch(spark, layout, batch, 1)  # rerun of the same version
    assert sorted(r.outcome for r in out.collect()) == ["forward_change", "forward_change"]
    h1 = jobs.history(spark, layout, 1)
    assert h1.count() == 4 and "_written" not in h1.columns
    log = spark.read.parquet(layout.change_log)
    assert log.groupBy("_version").count().orderBy("_version").collect()[1]["count"] == 4
    from ledgerspark.operators.temporal import as_of_version
    assert as_of_version(log, 1).exceptAll(h1).count() == 0


def test_sinks_under_the_cluster_configuration(spark, sf_small, tmp_path):
    """Dynamic overwrite mode: recomputes still replace everything, and empty reruns remove rows."""
    from ledgerspark.session import CLUSTER_CONF
    key = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(key)
    spark.conf.set(key, CLUSTER_CONF[key])
    try:
        layout = jobs.Layout(str(tmp_path / "lake"))
        bad = write_csv(tmp_path / "bad.csv", [line(1), line(2, amount="-3")])
        good = write_csv(tmp_path / "good.csv", [line(1), line(2)])
        none = write_csv(tmp_path / "none.csv", [])
        jobs.ingest_batch(spark, layout, bad, 1)
        assert jobs.refresh_silver(spark, layout)["dead"] == 1 and jobs.dead_letter(spark, layout).count() == 1
        jobs.ingest_batch(spark, layout, good, 1)
        assert jobs.refresh_silver(spark, layout)["dead"] == 0 and jobs.silver(spark, layout).count() == 2
        assert spark.read.parquet(layout.routes).filter("_route = 'dead_letter'").count() == 0
        jobs.ingest_batch(spark, layout, bad, 2)
        jobs.ingest_batch(spark, layout, none, 2)  # corrected: the delivery was empty
        assert spark.read.parquet(layout.bronze).count() == 2

        acc = tmp_path / "acc0.csv"
        acc.write_text("account_id,account_status,credit_limit,effective_date\nA0,active,100,2020-01-01\n")
        jobs.load_initial_history(spark, layout, str(acc))
        schema = "account_id string, account_status string, credit_limit int, effective_date date"
        import datetime as dt
        change = spark.createDataFrame([("A0", "frozen", 100, dt.date(2021, 1, 1))], schema)
        same = spark.createDataFrame([("A0", "active", 100, dt.date(2021, 1, 1))], schema)
        jobs.apply_account_batch(spark, layout, change, 1)
        out = jobs.apply_account_batch(spark, layout, same, 1)  # corrected: nothing changes
        assert [r.outcome for r in out.collect()] == ["no_op"]
        from ledgerspark.operators.temporal import as_of_version
        log = spark.read.parquet(layout.change_log)
        assert as_of_version(log, 1).count() == jobs.history(spark, layout, 1).count() == 1

        # a stream into the same bronze leaves the batch deliveries alone
        src = tmp_path / "landing"
        src.mkdir()
        write_csv(src / "s1.csv", [line(i) for i in range(20, 23)])
        write_csv(src / "s2.csv", [line(i) for i in range(23, 25)])
        for checkpoint in ("c1", "c2"):  # a fresh checkpoint reads the files again, into the same partitions
            stream_ingest(spark, str(src), layout.bronze, str(tmp_path / checkpoint))
            bronze = spark.read.parquet(layout.bronze)
            assert bronze.count() == 7 and bronze.select("_batch").distinct().count() == 3
    finally:
        spark.conf.set(key, old)


def test_stream_ingest_reads_each_file_once(spark, tmp_path):
    src = tmp_path / "landing"
    src.mkdir()
    write_csv(src / "b1.csv", [line(i) for i in range(5)])
    bronze, ckpt = str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    stream_ingest(spark, str(src), bronze, ckpt)
    assert spark.read.parquet(bronze).count() == 5
    stream_ingest(spark, str(src), bronze, ckpt)           # nothing new
    assert spark.read.parquet(bronze).count() == 5
    write_csv(src / "b2.csv", [line(i) for i in range(5, 8)])
    stream_ingest(spark, str(src), bronze, ckpt)
    df = spark.read.parquet(bronze)
    assert df.count() == 8 and df.select("_batch").distinct().count() == 2
    assert df.filter("ssn_last4 like 'XX%'").count() == 8


def test_stream_files_never_share_a_partition(spark, tmp_path):
    """Two names whose paths agree in 31 bits of their hash, delivered one after the other."""
    src = tmp_path / "landing"
    src.mkdir()
    write_csv(src / "b.csv", [])
    prefix = spark.read.text(str(src)).select("_metadata.file_path").first()[0].removesuffix("b.csv")
    names = spark.range(400_000).select(F.concat(F.lit("b"), F.col("id").cast("string"), F.lit(".csv")).alias("name"))
    cut = F.shiftrightunsigned(F.xxhash64(F.concat(F.lit(prefix), "name")), 33)
    pair = names.groupBy(cut.alias("cut")).agg(F.collect_list("name").alias("names")).filter(F.size("names") > 1).first().names
    bronze, ckpt = str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    for k, name in enumerate(pair):
        write_csv(src / name, [line(i) for i in range(3 * k, 3 * k + 3)])
        stream_ingest(spark, str(src), bronze, ckpt)
    df = spark.read.parquet(bronze)
    assert df.count() == 3 * len(pair) and df.select("_batch").distinct().count() == len(pair)
    assert df.filter("_batch >= 0").count() == 0


def test_models_materialize_as_views_and_tables(spark, sf_small, tmp_path):
    from ledgerspark.plans import models
    L = Ledger(spark, sf_small)
    views = models.register_models(spark, L.silver, L.h2, prefix="t_")
    assert spark.table("t_stg_transactions").count() == 1410
    assert spark.table("t_stg_accounts_current").count() == 150
    assert spark.sql("select count(*) from t_stg_accounts where not is_current").first()[0] == 38
    sinks.overwrite(views["fct_transactions_daily"], str(tmp_path / "mart"))
    assert spark.read.parquet(str(tmp_path / "mart")).count() == 1041
