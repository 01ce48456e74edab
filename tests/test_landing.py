"""Landing files: JSON arrays in splits, records that do not parse, the contract on undecoded text."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import checks as C
from ledgerspark.plans import jobs
from ledgerspark.sources.ingest import CORRUPT_COL, json_records, read_batch, read_keys, read_strings, split_unparsed
from ledgerspark.sources.schemas import TRANSACTION_SCHEMA
from test_io import HEADER, line

NASTY = ["plain", "a \"quoted\" }, { brace", "},{", "}, {\"transaction_id\": 1}", "line\nend\r\n  },\n  {", "\\", "\\\"", "[x]", "}]", "ünï 漢", ""]


def record(k, **changes):
    rnd = random.Random(k)
    return {"transaction_id": f"{k:08x}-0000-4000-8000-{k:012x}", "account_id": f"A{k % 7}", "customer_name": NASTY[k % len(NASTY)] + "x" * rnd.randrange(40),
            "ssn_last4": f"{k % 10_000:04d}", "amount": k + 0.5, "currency": "EUR", "transaction_type": rnd.choice(NASTY),
            "event_timestamp": "2024-01-01T10:00:00Z", "ingestion_timestamp": "2024-01-01T10:05:00+00:00"} | changes


LAYOUTS = {"indented": dict(indent=2), "compact": dict(separators=(",", ":")), "spaced": {}, "wide": dict(indent=4, ensure_ascii=False)}


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("n", [0, 1, 2, 3_000])
def test_array_equals_the_whole_file_reader(spark, tmp_path, layout, n):
    path = tmp_path / "t.json"
    path.write_text(json.dumps([record(k) for k in range(n)], **LAYOUTS[layout]))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        got = read_batch(spark, str(path), TRANSACTION_SCHEMA, "json")
        if n > 100:
            assert got.rdd.getNumPartitions() > 8  # one file, many tasks
        want = spark.read.schema(TRANSACTION_SCHEMA).option("multiLine", True).json(str(path))
        assert got.count() == n and sorted(got.collect()) == sorted(want.collect())
        assert read_keys(spark, str(path), fmt="json").distinct().count() == n
        # every piece is a record on its own
        assert sorted(json.loads(r.record)["amount"] for r in json_records(spark, str(path)).collect()) == [k + 0.5 for k in range(n)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_records_that_do_not_parse_keep_their_text(spark, tmp_path):
    broken = ['{"transaction_id": "x", "amount": "many"', "true", '{"transaction_id": "y" "amount": 3']
    good = [json.dumps(record(k)) for k in range(20)]
    texts = good[:7] + broken[:1] + good[7:12] + [json.dumps(record(90, amount="lots"))] + broken[2:] + good[12:]
    path = tmp_path / "t.json"
    path.write_text("[" + ",\n".join(t if t.endswith("}") else t + "}" for t in texts) + "\n]")
    df = read_batch(spark, str(path), TRANSACTION_SCHEMA, "json", keep_text=True)
    parsed, unparsed = split_unparsed(df)
    texts_of = {r[CORRUPT_COL] for r in unparsed.collect()}
    assert parsed.count() == 20 and CORRUPT_COL not in parsed.columns
    assert texts_of == {json.dumps(record(90, amount="lots")), broken[2] + "}"} | ({broken[0] + "}"} if True else set())
    assert df.count() == len(texts)


def test_csv_rows_that_do_not_parse_reach_the_dead_letter(spark, tmp_path):
    layout = jobs.Layout(str(tmp_path / "lake"))
    bad = ["T50,A1,Name,1234\n", line(51).rstrip("\n") + ",one,two\n", line(52, amount="many"), line(53).replace("2024-01-01T10:00:00Z", "yesterday")]
    path = tmp_path / "b.csv"
    path.write_text(HEADER + "".join([line(k) for k in range(6)] + bad + [line(7, amount="-1"), line(8, amount="")]))
    jobs.ingest_batch(spark, layout, str(path), 1)
    jobs.ingest_batch(spark, layout, str(path), 1)  # a rerun replaces both parts
    assert spark.read.parquet(layout.bronze).count() == 8
    counts = jobs.refresh_silver(spark, layout)
    dead = jobs.dead_letter_with_text(spark, layout)
    rows = {r[CORRUPT_COL]: r for r in dead.collect() if r[CORRUPT_COL] is not None}
    assert set(rows) == {b.rstrip("\n") for b in bad} and {r.rejection_reason for r in rows.values()} == {jobs.UNPARSED}
    assert counts["valid"] + dead.count() == 12 and dead.count() == 6
    # what did parse of such a row is masked as in bronze
    assert rows[bad[2].rstrip("\n")].customer_name == spark.range(1).select(F.sha2(F.lit("Name 52"), 256)).first()[0]


def run(spark, path, fmt):
    result = C.run_suite(read_strings(spark, path, fmt), C.text_contract(fmt == "json"))
    return [(r.check_name, r.column_name, r.unexpected_count) for r in result.collect()]


def test_contract_on_a_json_delivery(spark, tmp_path):
    def delivery(name, *changes):
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps([record(k) for k in range(30)] + [record(100 + k, **c) for k, c in enumerate(changes)], indent=2))
        return str(path)

    def failed(path):
        return [r for r in run(spark, path, "json") if r[2]]

    clean = run(spark, delivery("clean"), "json")
    assert len(clean) == 29 and all(r[2] == 0 for r in clean)
    assert failed(delivery("zone", {"event_timestamp": "2024-01-01T10:00:00"})) == [("format", "record", 1)]
    assert failed(delivery("currency", {"currency": "usd"})) == [("pattern", "currency", 1)]
    assert failed(delivery("id", {"transaction_id": "T1"})) == [("format", "record", 1)]
    assert failed(delivery("amount", {"amount": "n/a"}, {"amount": -3}, {"amount": 2_000_000})) == [
        ("type", "amount", 1), ("exclusiveMinimum", "amount", 1), ("maximum", "amount", 1)]
    assert failed(delivery("stamp", {"event_timestamp": "soonZ"}, {"ingestion_timestamp": None})) == [
        ("type", "event_timestamp", 1), ("required", "ingestion_timestamp", 1)]
    again = delivery("again", record(3), record(3))
    assert failed(again) == [("unique", "transaction_id", 3), ("primaryKey", "transaction_id", 3)]


def test_contract_on_a_csv_delivery(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(HEADER + "".join(line(k) for k in range(5)))
    result = run(spark, str(path), "csv")
    assert len(result) == 28 and all(r[2] == 0 for r in result)
