"""Language by prediction by partial matching: one byte-context model per language gives each
text an exact code length, and the shortest one wins.

The models are frozen counts of byte contexts up to ``ORDER`` bytes, learned from a bounded sample
of labelled rows. In every context, a symbol seen c of t times among d kinds costs -log2(c/(t+d))
bits, and an unseen one costs the escape -log2(d/(t+d)) plus its cost in the next shorter context;
below order 0 each byte costs 8 bits. No exclusion, no updates while scoring.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import bounded_batches, documents, slices
from .tokens import Table, find, make_table

ORDER = 3
#: Rows of each language to learn from at most: those with the smallest hash of their id.
SAMPLE_ROWS = 400
_CHUNK = 1 << 18
_PAD = b"\n" * ORDER


class Model(NamedTuple):
    """By order: symbols in context (key: context bytes, then the symbol) with a cost for every
    language, and contexts with the cost of an escape."""
    languages: list[str]
    symbols: list[Table]
    costs: list[np.ndarray]
    contexts: list[Table]
    escapes: list[np.ndarray]


def _plain(model: Model) -> tuple:
    """The model as built-in types and arrays, which every worker can unpickle."""
    return (model.languages, [tuple(t) for t in model.symbols], model.costs, [tuple(t) for t in model.contexts], model.escapes)


def _model(plain: tuple) -> Model:
    languages, symbols, costs, contexts, escapes = plain
    return Model(languages, [Table(*t) for t in symbols], costs, [Table(*t) for t in contexts], escapes)


def _keys(data: np.ndarray, order: int) -> np.ndarray:
    """For each position, the ``order`` bytes before it and itself as one number."""
    key = data.astype(np.uint64)
    for back in range(1, order + 1):
        key[back:] |= data[:-back].astype(np.uint64) << np.uint64(8 * back)
    return key


def bits_of(model: Model, keys: np.ndarray, order: int) -> np.ndarray:
    """Cost in bits of each key's last byte after the ``order`` bytes before it: (key, language)."""
    if order < 0:
        return np.full((len(keys), len(model.languages)), 8, dtype=np.float32)
    keys = keys & np.uint64((1 << 8 * (order + 1)) - 1)
    row = find(model.symbols[order], keys)
    out = model.costs[order][np.maximum(row, 0)]
    miss = np.flatnonzero(row < 0)
    if len(miss):
        context = find(model.contexts[order], keys[miss] >> np.uint64(8))
        escape = model.escapes[order][np.maximum(context, 0)]
        escape[context < 0] = 0
        out[miss] = escape + bits_of(model, keys[miss], order - 1)
    return out


def build(languages: list[str], lang: np.ndarray, order: np.ndarray, key: np.ndarray, count: np.ndarray) -> Model:
    """The models from counts by (language, order, key)."""
    model = Model(languages, [], [], [], [])
    for o in range(ORDER + 1):
        here = order == o
        l, k, c = lang[here], key[here].astype(np.uint64), count[here].astype(np.float64)
        symbols, where = np.unique(k, return_inverse=True)
        contexts, above = np.unique(symbols >> np.uint64(8), return_inverse=True)
        seen = np.zeros((len(symbols), len(languages)))
        seen[where, l] = c
        total, kinds = (np.zeros((len(contexts), len(languages))) for _ in range(2))
        np.add.at(total, above, seen)
        np.add.at(kinds, above, seen > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(kinds > 0, -np.log2(kinds / (total + kinds)), 0)
            cost = -np.log2(seen / (total + kinds)[above])
        lower = escape[above] + bits_of(model, symbols, o - 1)
        model.symbols.append(make_table(symbols))
        model.costs.append(np.where(seen > 0, cost, lower).astype(np.float32))
        model.contexts.append(make_table(contexts))
        model.escapes.append(escape.astype(np.float32))
    return model


def _padded(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in lower case with a fixed context before each; where each text starts."""
    raw = [(t or "").lower().encode() for t in texts]
    data = np.frombuffer(_PAD + _PAD.join(raw), dtype=np.uint8)
    return data, np.cumsum([ORDER, *[len(r) + ORDER for r in raw]])


def _text_positions(starts: np.ndarray) -> np.ndarray:
    keep = np.ones(starts[-1] - ORDER, dtype=bool)
    for back in range(1, ORDER + 1):
        keep[starts[:-1] - back] = False
    return np.flatnonzero(keep)


def fit(docs: DataFrame, trains: Column, rows: int = SAMPLE_ROWS) -> Model | None:
    """Learn from rows with a language and a text for which ``trains`` holds: at most ``rows`` ids
    of each language, those with the smallest hash. Counting runs in Spark; the driver receives
    the counts of that bounded sample. None if no row has a language."""
    bounded_batches(docs.sparkSession)
    base = docs.select("doc_id", "lang", F.col("text").cast("string").alias("text"))
    usable = base.filter(trains & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    rank = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (usable.select("doc_id", "lang").distinct().withColumn("__r", F.row_number().over(rank))
              .filter(F.col("__r") <= rows).select(F.col("doc_id").alias("__id"), F.col("lang").alias("__lang")))
    sample = (usable.join(F.broadcast(chosen), (F.col("doc_id") == F.col("__id")) & (F.col("lang") == F.col("__lang")))
              .groupBy("doc_id", F.col("lang").cast("string").alias("lang")).agg(F.min("text").alias("text")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _CHUNK):
                langs = np.array(part.column("lang").to_pylist())
                for lang in np.unique(langs):
                    texts = part.column("text").filter(pa.array(langs == lang)).to_pylist()
                    data, starts = _padded(texts)
                    at = _text_positions(starts)
                    for o in range(ORDER + 1):
                        key, n = np.unique(_keys(data, o)[at], return_counts=True)
                        yield pa.record_batch({"lang": pa.array([lang] * len(key), pa.string()), "o": np.full(len(key), o, dtype=np.int32),
                                               "k": key.astype(np.int64), "n": n.astype(np.int64)})

    found = sample.mapInArrow(count, "lang string, o int, k long, n long").groupBy("lang", "o", "k").agg(F.sum("n").alias("n"))
    got = found.orderBy("lang", "o", "k").toArrow()
    if not got.num_rows:
        return None
    names = got.column("lang").to_numpy(zero_copy_only=False)
    languages, lang = np.unique(names.astype(str), return_inverse=True)
    return build([str(x) for x in languages], lang, *(got.column(c).to_numpy() for c in ("o", "k", "n")))


def predict(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row. The score is the share of the winner when each
    language weighs 2^-bits; ties go to the first language by name. ``und`` with score 0 for null
    texts, texts without a letter, or an empty model."""
    base = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return base.select(F.col("id").alias(id_column), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(_plain(model))
    ids = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared.value)
        names = np.array(model.languages + ["und"])
        for batch in batches:
            for part in slices(batch, "text", _CHUNK):
                data, starts = _padded(part.column("text").to_pylist())
                costs = bits_of(model, _keys(data, ORDER), ORDER)
                sums = np.zeros((len(data) + 1, costs.shape[1]))
                np.cumsum(costs, axis=0, dtype=np.float64, out=sums[1:])
                total = sums[starts[1:] - ORDER] - sums[starts[:-1]]
                best = total.argmin(axis=1)
                share = 1 / np.exp2(-np.minimum(total - total.min(axis=1, keepdims=True), 1000)).sum(axis=1)
                known = np.array(part.column("known").to_pylist(), dtype=bool)
                yield pa.record_batch({"id": part.column("id"), "lang_pred": pa.array(names[np.where(known, best, -1)].tolist(), pa.string()),
                                       "score": np.where(known, share, 0.0)})

    return base.withColumn("known", letter).mapInArrow(run, f"id {ids}, lang_pred string, score double").withColumnRenamed("id", id_column)


def held_out(column: str = "doc_id") -> Column:
    """Rows whose text and language are never learned from."""
    return F.coalesce(F.crc32(F.encode(F.col(column).cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: language of every whole text of ``documents``."""
    docs = documents(spark, sf_dir)
    return predict(docs, fit(docs, ~held_out())).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
