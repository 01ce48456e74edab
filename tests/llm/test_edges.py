"""Every query of the subpackage on empty tables, awkward rows and repeated rows."""

import pytest

import __spark_entry__ as E
import corpus_pipeline
from compare import compare, duck_rows
from ledgerspark.llm import catalog

ALL = {**catalog.QUERIES, "pipeline": corpus_pipeline.run}
#: One result row per row of documents.
PER_ROW = [n for n in catalog.QUERIES if n not in ("op2_decontamination", "op4_packing", "op11_conversation_repair", "op13_embedding_whitening")]


def con(path):
    import duckdb
    c = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "conversations"):
        c.execute(f"create view {t} as select * from read_parquet('{path}/{t}.parquet')")
    return c


def test_all_are_registered():
    assert set(ALL) <= set(E.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))
    assert set(catalog.ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ALL))
def test_empty_tables(spark, empty_dir, name):
    df = ALL[name](spark, empty_dir)
    assert df.collect() == [] and len(df.columns) > 1


@pytest.mark.parametrize("name", sorted(ALL))
def test_awkward_rows(spark, edge_dir, name):
    rows = ALL[name](spark, edge_dir).collect()
    n = spark.read.parquet(f"{edge_dir}/documents.parquet").count()
    if name in PER_ROW:
        assert len(rows) == n
    else:
        assert rows


@pytest.mark.parametrize("name", sorted(ALL))
def test_repeated_rows(spark, repeated_dir, name):
    rows = ALL[name](spark, repeated_dir).collect()
    if name == "op13_embedding_whitening":
        assert rows == []  # one distinct vector has no variance
    if name in PER_ROW:
        assert len(rows) == spark.read.parquet(f"{repeated_dir}/documents.parquet").count()


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_sql_on_awkward_rows(spark, edge_dir, name):
    problems, _ = compare(spark, con(edge_dir), edge_dir, name, catalog.QUERIES[name], catalog.ORACLE[name])
    assert not problems, problems


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_sql_on_the_given_tables(spark, sf_small, name):
    problems, n = compare(spark, con(sf_small), sf_small, name, catalog.QUERIES[name], catalog.ORACLE[name])
    assert not problems and n, problems


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_the_columns(spark, edge_dir, stage):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    out = corpus_pipeline.STAGES[stage][1](spark, docs, edge_dir)
    assert out.schema.simpleString() == docs.schema.simpleString()
    assert out.count() <= docs.count()


def test_duck_rows_helper(edge_dir):
    assert duck_rows(con(edge_dir), "select count(*) as n from documents")[0] == ["n"]
