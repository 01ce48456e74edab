"""Benchmark decontamination by latent semantic retrieval.

Items and the passages of all documents become TF-IDF vectors over the benchmark's words, with
document frequencies of the whole corpus. A distributed randomised SVD gives the latent space,
from exact counts, made in one pass, of the words that stand together in a passage;
passages whose cosine to an item passes a threshold are candidates; their words are then compared
by longest common subsequence, and looser matches also need the item's answer.

The benchmark is the stated query set: its passages are taken in blocks of bounded size, and each
block meets every passage of every document in one map-only pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, documents, durable, fresh, slices
from .tokens import Table, find, make_table, mix, words

#: Words of a block. Passages are runs of blocks, about as long as the item they are compared with.
STEP = 16
#: Words of an item's passage at most: longer items are cut into several, and each is looked for.
PASSAGE = 64
#: Passages of the benchmark that are looked for in one pass.
QUERIES = 1_024
_CHUNK = 1 << 18
#: Pairs of words in a part of the counts, and how many a task sums up at once.
_CELLS = 1 << 16
_DENSE = 1 << 24


@dataclass(frozen=True)
class Settings:
    """``rank``: dimensions of the latent space, which all passages and the items shape.
    ``damping``: share of the largest spread that is added to every dimension's.
    ``cosine``: from here on a passage is a candidate. ``copy``: share of an item's words in common
    order that makes a match; ``close`` is enough where ``answer`` of its last sentence is there.
    Items of under ``least`` words have too few for a place in the space: they match where their
    words stand in a row, as they are."""
    rank: int = 128
    extra: int = 10
    power: int = 2
    damping: float = 0.03
    cosine: float = 0.5
    copy: float = 0.7
    close: float = 0.6
    answer: float = 0.8
    least: int = 8


class Queries(NamedTuple):
    """Passages of the benchmark: item of each, its words as vocabulary numbers, and how many of
    them, from the end, are the answer (the last sentence with a word)."""
    items: list
    words: list[list[int]]
    answers: list[int]
    vocabulary: np.ndarray


def _answer_words(text: str) -> int:
    """Words of the last sentence, by which an item's answer is recognised."""
    last = [s for s in re.split(r"[.!?\n]+", text) if len(words(pa.array([s])).hashes)]
    return len(words(pa.array([last[-1]])).hashes) if last else 0


def queries(rows: list[tuple], least: int) -> Queries:
    items, texts, answers = [], [], []
    for item, text in rows:
        hashes = words(pa.array([text or ""])).hashes
        if len(hashes) < least:
            continue  # (see ``exact``)
        parts = -(-len(hashes) // PASSAGE)
        cuts = [len(hashes) * k // parts for k in range(parts + 1)]
        for k in range(parts):
            items.append(item)
            texts.append(hashes[cuts[k]:cuts[k + 1]])
            answers.append(min(_answer_words(text), len(texts[-1])) if k == parts - 1 else 0)
    vocabulary = np.unique(np.concatenate(texts)) if texts else np.zeros(0, dtype=np.uint64)
    return Queries(items, [np.searchsorted(vocabulary, t).tolist() for t in texts], answers, vocabulary)


def _blocks(hashes: np.ndarray, doc: np.ndarray, table: Table, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word numbers or -1, block of each word, first block of each document and the end)."""
    counts = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(-(-counts // STEP))])
    place = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    return find(table, hashes), first[doc] + place // STEP, first


def _pairs(at: np.ndarray, passage: np.ndarray, size: int) -> np.ndarray:
    """The places (``_CELLS``) of all pairs of words that stand in one passage."""
    both = np.sort(passage * size + at)
    at, passage = both % size, both // size
    row, out = at * (at + 1) // 2, []
    for d in range(1, 4 * STEP):
        near = np.flatnonzero(passage[d:] == passage[:-d])
        if not len(near):
            break
        out.append(row[near + d] + at[near])
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def _packed(cells: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Sorted cells and their counts as rows (part, cells within the part, counts)."""
    cuts = np.flatnonzero(np.diff(cells // _CELLS)) + 1
    wide = next((t for t in (np.uint8, np.uint16, np.uint32) if counts.max(initial=0) <= np.iinfo(t).max), np.int64)
    pieces = [(c, n) for c, n in zip(np.split(cells, cuts), np.split(counts.astype(wide), cuts)) if len(c)]
    return pa.record_batch({"part": pa.array([int(c[0]) // _CELLS for c, _ in pieces], pa.int64()),
                            "cells": pa.array([(c % _CELLS).astype(np.uint16).tobytes() for c, _ in pieces], pa.binary()),
                            "counts": pa.array([n.tobytes() for _, n in pieces], pa.binary())})


def _counts(docs: DataFrame, table: tuple, size: int) -> DataFrame:
    """What the space is made of, counted over every passage (four blocks) of all documents: how
    often each two words of the vocabulary stand in one passage. The pairs are a triangle, row after
    row, in parts of ``_CELLS`` cells: (part, cells, counts). Part -1 has in how many documents each
    word occurs, part -2 how often it occurs. The rows are as many as the vocabulary has pairs, however
    many documents there are."""
    triangle = size * (size + 1) // 2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, held, times = Table(*table), np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        # A small vocabulary's pairs are summed up in the task, those of a large one batch by batch.
        dense = np.zeros(triangle if triangle <= _DENSE else 0, dtype=np.uint32)
        waiting, room, seen = [], 0, 0
        for batch in batches:
            for part in slices(batch, "text", _CHUNK):
                w = words(part.column("text").fill_null(""))
                at, block, first = _blocks(w.hashes, w.doc, t, part.num_rows)
                passage, keep = (block - first[w.doc]) // 4 + first[w.doc], at >= 0
                at, passage = at[keep].astype(np.int64), passage[keep]
                held += np.bincount(np.unique(w.doc[keep] * size + at) % size, minlength=size)
                times += np.bincount(at, minlength=size)
                met = _pairs(at, passage, size)
                seen += len(met)
                if len(dense):
                    np.add.at(dense, met, dense.dtype.type(1))  # (of one type: the fast way)
                    if seen > 1 << 31:
                        cells, seen = np.flatnonzero(dense), 0
                        yield _packed(cells, dense[cells])
                        dense[:] = 0
                else:
                    waiting, room = [*waiting, met], room + len(met)
                    if room > _DENSE // 4:
                        yield _packed(*np.unique(np.concatenate(waiting), return_counts=True))
                        waiting, room = [], 0
        if len(dense):
            cells = np.flatnonzero(dense)
            yield _packed(cells, dense[cells])
        elif waiting:
            yield _packed(*np.unique(np.concatenate(waiting), return_counts=True))
        yield pa.record_batch({"part": pa.array([-1, -2], pa.int64()), "cells": pa.array([b"", b""], pa.binary()),
                               "counts": pa.array([held.tobytes(), times.tobytes()], pa.binary())})

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, np.zeros(0, dtype=np.int64)

        def ready() -> pa.RecordBatch:
            cells = np.flatnonzero(sums).astype(np.uint16) if now >= 0 else np.zeros(0, dtype=np.uint16)
            kept = sums[cells] if now >= 0 else sums
            return pa.record_batch({"part": pa.array([now], pa.int64()), "cells": pa.array([cells.tobytes()], pa.binary()),
                                    "counts": pa.array([kept.tobytes()], pa.binary())})

        for batch in batches:
            for part, cells, counts in zip(*[batch.column(c).to_pylist() for c in ("part", "cells", "counts")]):
                if part != now:
                    if now is not None:
                        yield ready()
                    now, sums = part, np.zeros(_CELLS if part >= 0 else size, dtype=np.int64)
                if part < 0:
                    sums += np.frombuffer(counts, dtype=np.int64)
                    continue
                at = np.frombuffer(cells, dtype=np.uint16)
                kind = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.int64}[len(counts) // len(at)]
                sums[at] += np.frombuffer(counts, dtype=kind)
        if now is not None:
            yield ready()

    schema = "part long, cells binary, counts binary"
    found = docs.select("text").mapInArrow(count, schema).repartition("part").sortWithinPartitions("part")
    return durable(found.mapInArrow(total, schema), "decontamination-counts")


def _gram(counts: DataFrame, weight: np.ndarray, times: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, float]:
    """A'A times ``basis`` and the squared norm of A, the TF-IDF matrix of all passages, from the
    counts of their pairs; summed up task by task. Both factors are of bounded size."""
    size, width = basis.shape
    scaled = weight[:, None].astype(np.float64) * basis
    shared = counts.sparkSession.sparkContext.broadcast(scaled)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = shared.value
        starts = np.arange(size + 1) * (np.arange(size + 1) + 1) // 2  # (of the triangle's rows)
        total = np.zeros((size, width))
        for batch in batches:
            for part, cells, n in zip(*[batch.column(c).to_pylist() for c in ("part", "cells", "counts")]):
                at = np.frombuffer(cells, dtype=np.uint16).astype(np.int64) + part * _CELLS
                row = np.searchsorted(starts, at, side="right") - 1
                low, high = int(row[0]), int(row[-1]) + 1
                here = np.zeros((high - low, high))
                here[row - low, at - starts[row]] = np.frombuffer(n, dtype=np.int64)
                total[low:high] += here @ x[:high]
                total[:high] += here.T @ x[low:high]
        yield pa.record_batch({"y": [total.tobytes()]})

    total = times[:, None] * scaled  # (a word with itself)
    for row in counts.filter("part >= 0").coalesce(8).mapInArrow(multiply, "y binary").toLocalIterator():
        total += np.frombuffer(row["y"]).reshape(size, width)
    shared.unpersist()
    return weight[:, None] * total, float((times * weight.astype(np.float64) ** 2).sum())


def latent_space(docs: DataFrame, q: Queries, table: tuple, s: Settings) -> np.ndarray:
    """Vocabulary words in the latent space (word, dimension), weighted by their inverse document
    frequency; randomised SVD of all passages and the items, either with norm 1 as a whole,
    dimensions scaled to about equal spread."""
    size = len(q.vocabulary)
    counts = _counts(docs, table, size)
    of_words = {r["part"]: np.frombuffer(r["counts"], dtype=np.int64) for r in counts.filter("part < 0").toLocalIterator()}
    seen, times = (of_words.get(k, np.zeros(size)) for k in (-1, -2))  # (no row: no documents)
    weight = np.log((docs.count() + 1) / (seen + 1)).astype(np.float32) + np.float32(1e-3)
    width = min(size, s.rank + s.extra)
    item = [np.array(x) for x in q.words]
    basis = np.linalg.qr(np.random.default_rng(5).standard_normal((size, width)))[0].astype(np.float32)
    for _ in range(s.power + 1):
        y, norm = _gram(counts, weight, times, basis)
        mine, own = np.zeros((size, width)), 0.0
        for at in item:
            w = weight[at][:, None]
            np.add.at(mine, at, w * (w * basis[at]).sum(axis=0))
            own += float((w ** 2).sum())
        y = y / max(norm, 1e-9) + mine / max(own, 1e-9)
        small = basis.T.astype(np.float64) @ y
        before, basis = basis, np.linalg.qr(y)[0].astype(np.float32)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    # Damped, so that dimensions with hardly any spread are not blown up to full size.
    order = np.argsort(values)[::-1][:s.rank]
    spread = np.sqrt(np.maximum(values[order], 0) + s.damping * max(values.max(), 1e-12))
    return ((before @ turn[:, order]) / spread * weight[:, None]).astype(np.float32)


def _common(masks: dict[int, int], length: int, text: list[int]) -> int:
    """Length of the longest common subsequence, bit by bit in one integer."""
    full = state = (1 << length) - 1
    for w in text:
        mask = masks.get(w)
        if mask:
            hit = state & mask
            state = ((state + hit) | (state - hit)) & full
    return length - state.bit_count()


def _masks(sequence: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(sequence):
        out[w] = out.get(w, 0) | 1 << i
    return out


def search(docs: DataFrame, q: Queries, space: np.ndarray, table: tuple, s: Settings, check: bool = True) -> DataFrame:
    """(id, th, query, cosine, common, answer): for each document and query the best passage that
    passes; th is a hash of the text. ``check=False``: every candidate, unverified."""
    vectors = np.array([space[x].sum(axis=0) for x in q.words])
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    shared = docs.sparkSession.sparkContext.broadcast((table, space, vectors.astype(np.float32), q.words, q.answers))
    ids = docs.schema["id"].dataType.simpleString()
    fields = f"id {ids}, th long, query int, cosine double, common double, answer double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, space, vectors, sequences, answers = shared.value
        space = np.vstack([space, np.zeros((1, space.shape[1]), dtype=np.float32)])
        t = Table(*plain)
        masks = [_masks(x) for x in sequences]
        tails = [_masks(x[len(x) - n:]) for x, n in zip(sequences, answers)]
        lengths = np.array([-(-len(x) // STEP) for x in sequences])
        for batch in batches:
            for part in slices(batch, "text", _CHUNK):
                w = words(part.column("text").fill_null(""))
                at, block, first = _blocks(w.hashes, w.doc, t, part.num_rows)
                n = first[-1]
                # A block's vector: its words one place after the other, a zero row for others.
                slots = np.full((STEP, n + 1), len(space) - 1, dtype=np.int32)
                opens = np.searchsorted(block, np.arange(n + 1))
                slots[np.arange(len(block)) - opens[block], block] = np.where(at >= 0, at, len(space) - 1)
                sums = space[slots[0]]
                for place in slots[1:]:
                    sums += space[place]
                owner = np.repeat(np.arange(part.num_rows), np.diff(first))
                last = first[owner + 1] if n else np.zeros(0, dtype=np.int64)
                best: dict[tuple[int, int], tuple[float, float, float]] = {}
                run_sum, width = sums[:n].copy(), 1
                for size in range(1, int(lengths.max(initial=0)) + 2):
                    while width < size:  # passages of one block more, within their document
                        run_sum[:n - width] += sums[width:n]
                        over = np.flatnonzero(owner[width:] != owner[:n - width])
                        run_sum[over] -= sums[over + width]
                        width += 1
                    mine = np.flatnonzero((lengths == size) | (lengths == size - 1))
                    norm = np.maximum(np.sqrt(np.einsum("ij,ij->i", run_sum, run_sum)), 1e-9)
                    product = run_sum @ vectors[mine].T
                    for b, k in zip(*np.nonzero(product >= s.cosine * norm[:, None])):
                        query, doc, value = int(mine[k]), int(owner[b]), float(product[b, k] / norm[b])
                        share = tail = 0.0
                        if check:
                            # A copy may run over into the blocks beside; a paraphrase must be here.
                            length, around = len(sequences[query]), (max(b - 1, first[doc]), min(b + size + 1, last[b]))
                            share = _common(masks[query], length, at[opens[around[0]]:opens[around[1]]].tolist()) / length
                            if share < s.close:
                                continue
                            text = at[opens[b]:opens[min(b + size, last[b])]].tolist()
                            tail = _common(tails[query], answers[query], text) / answers[query] if answers[query] else 1.0
                            if share < s.copy and (tail < s.answer or _common(masks[query], length, text) < s.close * length):
                                continue
                        old = best.get((doc, query))
                        if old is None or (share, value) > (old[1], old[0]):
                            best[doc, query] = (value, share, tail)
                found = sorted(best)
                rows = pa.array([d for d, _ in found], pa.int64())
                yield pa.record_batch({"id": part.column("id").take(rows), "th": part.column("th").take(rows),
                                       "query": pa.array([k for _, k in found], pa.int32()),
                                       **{c: pa.array([best[f][j] for f in found], pa.float64()) for j, c in enumerate(("cosine", "common", "answer"))}})

    return docs.select("id", "th", "text").mapInArrow(run, fields)


def short_items(rows: list[tuple], least: int) -> list[tuple[int, np.ndarray]]:
    """(place in ``rows``, word hashes) of the items that have a word, but fewer than ``least``."""
    known = ((k, words(pa.array([text or ""])).hashes) for k, (_, text) in enumerate(rows))
    return [(k, h) for k, h in known if 0 < len(h) < least]


def _sequence(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` words in a row, by the place of the first."""
    out = np.full(max(0, len(hashes) - n + 1), n, dtype=np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k:len(hashes) - n + 1 + k])
    return out


def exact(docs: DataFrame, items: list[tuple[int, np.ndarray]]) -> DataFrame:
    """(id, th, query) of the documents that hold the words of an item in a row."""
    ids = docs.schema["id"].dataType.simpleString()
    by_length: dict[int, list[tuple[int, int]]] = {}
    for k, h in items:
        by_length.setdefault(len(h), []).append((int(_sequence(h, len(h))[0]), k))
    tables = {n: (np.array([h for h, _ in sorted(x)], dtype=np.uint64), np.array([k for _, k in sorted(x)])) for n, x in by_length.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _CHUNK):
                w = words(part.column("text").fill_null(""))
                found = set()
                for n, (names, queries_) in tables.items():
                    if len(w.hashes) < n:
                        continue
                    h = _sequence(w.hashes, n)
                    inside = w.doc[:len(h)] == w.doc[n - 1:]
                    low, high = np.searchsorted(names, h, side="left"), np.searchsorted(names, h, side="right")
                    for at in np.flatnonzero(inside & (high > low)):
                        found |= {(int(w.doc[at]), int(k)) for k in queries_[low[at]:high[at]]}
                hits = sorted(found)
                rows = pa.array([d for d, _ in hits], pa.int64())
                yield pa.record_batch({"id": part.column("id").take(rows), "th": part.column("th").take(rows), "query": pa.array([k for _, k in hits], pa.int32())})

    return docs.select("id", "th", "text").mapInArrow(run, f"id {ids}, th long, query int")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", s: Settings = Settings(),
                 check: bool = True) -> DataFrame:
    """(id, th, item_id, cosine, common, answer) of every document that holds an item, or a passage
    of a long one. Null and empty texts hold nothing; equal items are each reported; rows with
    equal ids are judged on their own texts. Items without a word match nothing; items of under
    ``least`` words match where their words stand in a row. Texts of any length are searched whole, in
    one piece; other columns are not read."""
    spark = docs.sparkSession
    bounded_batches(spark)
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    base = docs.select(F.col(f"`{id_column}`").alias("id"), F.xxhash64(whole).alias("th"), whole.alias("text"))
    kind = benchmark.schema["item_id"].dataType.simpleString()
    found, block = [], []

    def flush() -> None:
        rows, q, short = list(block), queries(block, s.least), short_items(block, s.least)
        block.clear()
        if short:
            names = spark.createDataFrame([(k, rows[k][0]) for k, _ in short], f"__q int, item_id {kind}")
            hits = exact(base, short).join(names, F.col("query") == F.col("__q")).select("id", "th", "item_id").distinct()
            found.append(durable(hits.select("*", *[F.lit(1.0).alias(c) for c in ("cosine", "common", "answer")]), "decontamination-exact"))
        if not q.items:
            return
        table = tuple(make_table(q.vocabulary))
        hits = search(base, q, latent_space(base, q, table, s), table, s, check)
        names = spark.createDataFrame(list(enumerate(q.items)), f"__q int, item_id {kind}")
        hits = hits.join(names, F.col("query") == F.col("__q")).groupBy("id", "th", "item_id")
        found.append(durable(hits.agg(*[F.max(c).alias(c) for c in ("cosine", "common", "answer")]), "decontamination-hits"))

    # The query set arrives block by block, never as a whole.
    room = 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        block.append((row["item_id"], row["text"]))
        room += 1 + len(row["text"] or "") // (5 * PASSAGE)
        if room >= QUERIES:
            flush()
            room = 0
    if block:
        flush()
    if not found:
        ids = base.schema["id"].dataType.simpleString()
        return spark.createDataFrame([], f"id {ids}, th long, item_id {kind}, cosine double, common double, answer double")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    hashed, id_, th = (fresh(docs, x) for x in ("hashed", "id", "th"))
    bad = contaminated(docs, benchmark, id_column, text).select(F.col("id").alias(id_), F.col("th").alias(th)).distinct()
    same_row = F.col(f"`{id_column}`").eqNullSafe(F.col(id_)) & (F.col(hashed) == F.col(th))
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.withColumn(hashed, F.xxhash64(whole)).join(bad, same_row, "left_anti").drop(hashed)


def benchmark_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: documents that hold benchmark items, and which."""
    found = contaminated(documents(spark, sf_dir), benchmark_of(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), "item_id", *[F.round(c, 6).alias(c) for c in ("cosine", "common", "answer")])
