"""Batches with least padding: dynamic programming over the histogram of all lengths chooses the
bucket boundaries, and batches within a token budget form inside each bucket.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, durable, numbered

#: Tokens of a sequence at most; longer texts become several sequences, none is cut off.
MAX_LENGTH = 2_048
BUCKETS = 16
#: Tokens of a batch at most, padding included.
BUDGET = 32_768
#: A token: a run of letters and digits, or any other character that is no white space.
TOKEN = r"[\p{L}\p{N}]++|[^\s\p{L}\p{N}]"


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding in sum. ``lengths`` are
    distinct and ascending; a bucket's bound is one of them."""
    n = len(lengths)
    if not n:
        return []
    rows = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(np.float64)
    # least[j]: least padding of the first j lengths in the buckets so far; the last ends at j.
    least = np.concatenate([[0.0], lengths * rows[1:] - tokens[1:]])
    back = [np.zeros(n + 1, dtype=np.int64)]
    for _ in range(1, min(buckets, n)):
        now, at = np.zeros(n + 1), np.zeros(n + 1, dtype=np.int64)
        for j in range(1, n + 1):
            cost = least[:j] + lengths[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            at[j] = cost.argmin()
            now[j] = cost[at[j]]
        least = now
        back.append(at)
    ends, j = [], n
    for at in reversed(back):
        if j:
            ends.append(int(lengths[j - 1]))
            j = at[j]
    return ends[::-1]


def token_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(TOKEN)).cast("long")


def pack(docs: DataFrame, id_column: str = "doc_id", text: str = "text", max_length: int = MAX_LENGTH,
         buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """One row per sequence: (id, seq, start, length, bucket, batch, slot, padding). A text is the
    sequences 0, 1, ... of at most ``max_length`` tokens from ``start`` on; ``bucket`` is the length
    that its batch is padded to, ``slot`` the place in the batch, and no batch of ``batch`` within
    its ``bucket`` holds more than ``budget`` tokens.

    Null and empty texts, and those of white space, are one sequence of length 0. Null ids and
    repeated rows are packed like any others. The histogram has ``max_length`` + 1 entries at most.
    """
    if budget < max_length:
        raise ValueError("a batch must hold a sequence of the largest length")
    sized = docs.select(F.col(f"`{id_column}`").alias("id"), token_count(F.col(f"`{text}`")).alias("tokens"))
    last = F.greatest(F.lit(0), F.ceil(F.col("tokens") / max_length) - 1)
    sequences = sized.select("id", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("seq"))
    start = F.col("seq") * max_length
    sequences = durable(sequences.select("id", "seq", start.alias("start"),
                                         F.least(F.lit(max_length).cast("long"), F.col("tokens") - start).alias("length")), "packing-sequences")
    histogram = sequences.groupBy("length").agg(F.count(F.lit(1)).alias("n")).orderBy("length").collect()
    ends = boundaries(np.array([h["length"] for h in histogram], dtype=np.int64), np.array([h["n"] for h in histogram], dtype=np.int64), buckets)
    bounds = F.array(*[F.lit(e).cast("long") for e in ends]) if ends else F.array().cast("array<long>")
    bucketed = sequences.withColumn("bucket", F.get(F.filter(bounds, lambda e: e >= F.col("length")), F.lit(0)))
    placed = numbered(bucketed, ["bucket"], ["id", "seq", "length"], "at", rows=sum(h["n"] for h in histogram))
    per_batch = F.floor(F.lit(budget) / F.greatest(F.col("bucket"), F.lit(1)))
    return placed.select(F.col("id").alias(id_column), "seq", "start", "length", "bucket", F.floor(F.col("at") / per_batch).alias("batch"),
                         (F.col("at") % per_batch).alias("slot"), (F.col("bucket") - F.col("length")).alias("padding"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: every whole text of ``documents`` in batches."""
    return pack(documents(spark, sf_dir))
