"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Learning rates per coordinate and the L1 term leave few weights, which go to every task as one
array of fixed size. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import bounded_batches, documents, durable, fresh, slices
from .tokens import mix, words

#: Lengths in bytes of the word beginnings that count as features beside the whole word.
STEMS = (5, 7)
#: Bytes of text that a task turns into arrays at once.
_CHUNK = 1 << 18


@dataclass(frozen=True)
class Settings:
    """``bits``: size of the weight array, 2^bits entries. ``sample``: labelled rows to learn from
    at most, those with the smallest hash of their id. The rest are FTRL's parameters."""
    bits: int = 20
    sample: int = 8_192
    epochs: int = 6
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 1.0


def features(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, coordinate) of every word, its beginnings (inflected forms share them), pair of
    neighbours and pair with one word between."""
    w = words(texts, STEMS)
    docs, coords = [w.doc] * (1 + len(STEMS)), [mix(w.hashes, 1), *(mix(h, 11 + k) for k, h in enumerate(w.stems))]
    for gap in (1, 2):
        same = w.doc[gap:] == w.doc[:-gap] if len(w.doc) > gap else np.zeros(0, dtype=bool)
        first, second = w.hashes[:len(same)][same], w.hashes[gap:gap + len(same)][same]
        docs.append(w.doc[:len(same)][same])
        coords.append(mix(first * np.uint64(3) + second, 1 + gap))
    return np.concatenate(docs), (np.concatenate(coords) >> np.uint64(64 - bits)).astype(np.int64)


def _distinct(doc: np.ndarray, coord: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique((doc << bits) | coord)
    return both >> bits, both & ((1 << bits) - 1)


def learn(rows: Iterable[tuple[int, np.ndarray]], s: Settings) -> tuple[np.ndarray, float]:
    """Weights and bias from (label, distinct coordinates) rows, in the order given."""
    rows = list(rows)
    z, n = np.zeros((1 << s.bits) + 1), np.zeros((1 << s.bits) + 1)

    def weight(at):
        big = np.maximum(np.abs(z[at]) - np.where(at < len(z) - 1, s.l1, 0), 0)  # the last is the bias
        return -np.sign(z[at]) * big / ((s.beta + np.sqrt(n[at])) / s.alpha + s.l2)

    for _ in range(s.epochs):
        for label, coords in rows:
            at = np.append(coords, len(z) - 1)
            w = weight(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / s.alpha * w
            n[at] += g * g
    weights, kept = np.zeros(1 << s.bits), np.flatnonzero(np.abs(z[:-1]) > s.l1)
    weights[kept] = weight(kept)
    return weights, float(weight(np.array([len(z) - 1]))[0])


def fit(docs: DataFrame, labels: DataFrame, trains: Column, s: Settings = Settings()) -> tuple[np.ndarray, float]:
    """Learn from the rows of ``labels`` (doc_id, toxic) for which ``trains`` holds. One label per
    id: the largest of repeated ones; rows with a null id or label, and ids without a document,
    teach nothing. At most ``s.sample`` ids: those with the smallest hash.

    The features are made in parallel; one task then runs FTRL, which is sequential, over the
    bounded sample. Without any label every weight is zero and the score one half.
    """
    bounded_batches(docs.sparkSession)
    marked = (labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("__y"))
              .filter(F.col("__id").isNotNull() & F.col("__y").isNotNull()).groupBy("__id").agg(F.max("__y").alias("__y")))
    chosen = (marked.withColumnRenamed("__id", "doc_id").filter(trains).withColumnRenamed("doc_id", "__id")
              .orderBy(F.xxhash64("__id"), "__id").limit(s.sample))
    sample = (docs.select(F.col("doc_id").alias("__d"), F.col("text").cast("string").alias("text"))
              .join(F.broadcast(chosen), F.col("__d") == F.col("__id"))
              .groupBy("__id").agg(F.max("__y").alias("y"), F.min("text").alias("text")))
    bits = s.bits

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _CHUNK):
                doc, coord = _distinct(*features(part.column("text").fill_null(""), bits), bits)
                cuts = np.searchsorted(doc, np.arange(part.num_rows + 1))
                yield pa.record_batch({"id": part.column("__id"), "y": part.column("y"),
                                       "coords": [coord[a:b].astype(np.int32).tobytes() for a, b in zip(cuts, cuts[1:])]})

    found = durable(sample.mapInArrow(extract, "id long, y int, coords binary"), "toxicity-sample")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(y, np.frombuffer(c, dtype=np.int32)) for b in batches
                for y, c in zip(b.column("y").to_pylist(), b.column("coords").to_pylist())]
        weights, bias = learn(rows, s)
        at = np.flatnonzero(weights)
        yield pa.record_batch({"at": np.append(at, -1), "w": np.append(weights[at], bias)})

    ordered = found.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id")
    model = ordered.mapInArrow(train, "at long, w double").toArrow()
    weights, bias = np.zeros(1 << s.bits, dtype=np.float64), 0.0
    at, w = model.column("at").to_numpy(), model.column("w").to_numpy()
    weights[at[at >= 0]] = w[at >= 0]
    return weights, float(w[at < 0].sum())


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_column: str = "doc_id", text: str = "text",
          carry: bool = False) -> DataFrame:
    """(id, score) of every row, or with ``carry`` all columns and ``score``. A feature counts once
    in a text, however often it occurs, and texts are scored whole; null and empty texts get the
    bias alone."""
    bounded_batches(docs.sparkSession)
    weights, bias = model
    bits = int(np.log2(len(weights)))
    kept = np.flatnonzero(weights)
    values = weights[kept]
    name = fresh(docs, "score") if carry else "score"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits)
        table[kept] = values
        for batch in batches:
            for part in slices(batch, text, _CHUNK):
                doc, coord = features(part.column(text).fill_null(""), bits)
                hit = table[coord] != 0
                doc, coord = _distinct(doc[hit], coord[hit], bits)
                total = np.bincount(doc, weights=table[coord], minlength=part.num_rows) + bias
                found = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
                columns = dict(zip(part.schema.names, part.columns)) if carry else {id_column: part.column(id_column)}
                yield pa.record_batch(columns | {name: pa.array(found)})

    used = docs.withColumn(text, F.col(f"`{text}`").cast("string")) if carry else docs.select(
        F.col(f"`{id_column}`"), F.col(f"`{text}`").cast("string").alias(text))
    shape = used.schema if carry else used.select(F.col(f"`{id_column}`")).schema
    return used.mapInArrow(run, StructType([*shape.fields, StructField(name, DoubleType())]))


def held_out(column: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(F.encode(F.col(column).cast("string"), "UTF-8")) % 5 == 0


def toxic_scores(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return score(docs, fit(docs, labels, ~held_out()))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of ``docs`` that score below one half, with all their columns; the texts stay where
    they are, no join brings the scores back."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    scored = score(docs, fit(docs, labels, ~held_out()), carry=True)
    return scored.filter(F.col(scored.columns[-1]) < 0.5).select(*[f"`{c}`" for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: score of every whole text of ``documents``. A row with a null doc_id is not held out."""
    docs = documents(spark, sf_dir)
    return toxic_scores(spark, docs, sf_dir).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
