"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and calls one operator of ``ledgerspark.llm`` on all that
the stage before it kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.llm import decontamination, lines, packing, simhash, toxicity
from ledgerspark.llm.common import documents, durable, passing


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores below one half stay."""
    return toxicity.drop_toxic(spark, docs, sf_dir)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line repeats within one word, or a tenth of a long line's, go; a text left without a line goes too."""
    return lines.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts with linked fingerprints stays."""
    return simhash.keep_first(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go."""
    return decontamination.drop_contaminated(docs, decontamination.benchmark_of(spark, sf_dir))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text that is left, in padded batches."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark),
    ("packing", pack),
]

#: No SQL: learned weights, graph components and latent retrieval decide which rows stay.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        with passing(spark):  # a stage's own tables go once its result is written
            docs = durable(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
    return docs
