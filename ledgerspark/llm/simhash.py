"""SimHash near-duplicates: 64-bit fingerprints of word shingles, compared exactly in tiles.

Texts with one fingerprint are linked by it alone, so only distinct fingerprints are compared.
They are dealt into cells by the population counts of their four 16-bit quarters. Two fingerprints
within the radius differ by at most the radius in these counts, summed; all other pairs of cells
are skipped. Cells are cut into tiles of bounded size, and numpy compares two tiles at a time by
exclusive-or and bit counts. No pair within the radius is lost, and none is guessed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, components, documents, durable, fresh

#: The contract's shingle length in words, hash seed and largest number of differing bits.
WORDS, SEED, RADIUS = 3, 42, 2
#: Fingerprints in a tile, about; a pair of tiles takes 8 * TILE^2 bytes.
TILE = 2_048
_QUARTERS, _WIDTH, _BASE = 4, 16, 64
_BLOCK = 1 << 16


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes, repeats included. Fewer words
    than a shingle: the whole sequence is the one shingle; no word: zero."""
    # bytes.lower() and bytes.split() know A-Z and the six ASCII separators only.
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    hashed = xxhash.xxh64_intdigest
    count, n = np.zeros(64, dtype=np.int64), max(1, len(parts) - words + 1)
    spans = list(zip(starts, ends[min(words, len(parts)) - 1:].tolist()))
    for at in range(0, n, _BLOCK):
        h = np.array([hashed(line[a:b], seed) for a, b in spans[at:at + _BLOCK]], dtype=">u8")
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = WORDS, seed: int = SEED) -> DataFrame:
    """(id, th, fp) of every row; th: hash of the text, fp: fingerprint, both as signed longs. Null
    texts have no words."""
    bounded_batches(docs.sparkSession)
    ids = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), words, seed) for t in batch.column("text")]
            yield pa.record_batch({"id": batch.column("id"), "th": batch.column("th"), "fp": pa.array(found, pa.int64())})

    return (docs.select(F.col(f"`{id_column}`").alias("id"), _text_hash(text).alias("th"), F.col(f"`{text}`").cast("string").alias("text"))
            .mapInArrow(run, f"id {ids}, th long, fp long"))


def _text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))


def _tiles(fps: DataFrame, tile: int) -> DataFrame:
    """(cell, part, fps): distinct fingerprints by the counts of their quarters, at most about
    ``tile`` in a row. The cells number at most 17^4, so their counts are a small table."""
    cell = F.lit(0).cast("long")
    for q in range(_QUARTERS):
        quarter = F.shiftrightunsigned("fp", q * _WIDTH).bitwiseAND(F.lit((1 << _WIDTH) - 1))
        cell = cell * _BASE + F.bit_count(quarter) + RADIUS
    known = fps.select("fp", cell.alias("cell"))
    parts = known.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile).alias("parts"))
    return (known.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")))
            .groupBy("cell", "part").agg(F.collect_list("fp").alias("fps")))


def _offsets(radius: int) -> list[int]:
    """Differences of cell numbers to the cells whose counts differ by ``radius`` at most in sum;
    each unordered pair of cells once."""
    steps = (d for d in product(range(-radius, radius + 1), repeat=_QUARTERS) if sum(map(abs, d)) <= radius)
    numbers = (sum(x * _BASE ** (_QUARTERS - 1 - q) for q, x in enumerate(d)) for d in steps)
    return sorted(n for n in numbers if n >= 0)


def _forest(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the radius between two tiles, as each fingerprint and the first one that it
    reaches: connects the same, and never more rows than fingerprints."""
    near = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
    i, j = np.nonzero(near)
    nodes, index = np.unique(np.concatenate([a[i], b[j]]), return_inverse=True)
    u, v = index[:len(i)], index[len(i):]
    root = np.arange(len(nodes))
    while len(u):
        low = np.minimum(root[u], root[v])
        before = root.copy()
        np.minimum.at(root, u, low)
        np.minimum.at(root, v, low)
        root = root[root]
        if (root == before).all():
            break
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): links that connect exactly the distinct fingerprints ``fp`` within ``radius`` bits
    of each other, directly or over others."""
    if radius > RADIUS:
        raise ValueError(f"cells are numbered for a radius of {RADIUS} at most")
    tiles = durable(_tiles(fps, tile), "simhash-tiles")
    left = tiles.select(F.explode(F.array(*[F.col("cell") + n for n in _offsets(radius)])).alias("other"),
                        F.col("cell").alias("c"), F.col("part").alias("p"), F.col("fps").alias("one"))
    pairs = left.join(tiles, (F.col("other") == F.col("cell")) & ((F.col("c") != F.col("cell")) | (F.col("p") <= F.col("part"))))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_forest(*(np.asarray(x.values).view(np.uint64) for x in pair), radius)
                     for pair in zip(batch.column("one"), batch.column("fps"))]
            a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.uint64) for k in (0, 1))
            yield pa.record_batch({"a": a.view(np.int64), "b": b.view(np.int64)})

    return pairs.select("one", "fps").mapInArrow(compare, "a long, b long").distinct()


def _grouped(marked: DataFrame, radius: int) -> DataFrame:
    """Add ``root``, the same for all rows of a component, to rows with an ``fp``."""
    known = marked.select("fp").distinct()
    reach = durable(components(links(known, radius)), "simhash-components")
    rooted = marked.join(reach, marked["fp"] == reach["node"], "left")
    return rooted.withColumn("root", F.coalesce("root", "fp")).drop("node")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = WORDS,
                    seed: int = SEED, radius: int = RADIUS) -> DataFrame:
    """(id, fp, component_id) of every row: the smallest id reachable over links of ``radius`` bits
    at most. Repeated rows and texts share a component; texts without a word are linked by the
    fingerprint zero like any others. Null ids never name a component unless it has no other."""
    marked = durable(fingerprints(docs, id_column, text, words, seed), "simhash-fingerprints")
    rooted = _grouped(marked, radius)
    named = rooted.groupBy("root").agg(F.min("id").alias("component_id")).withColumnRenamed("root", "__root")
    return (rooted.join(named, F.col("root") == F.col("__root"))
            .select(F.col("id").alias(id_column), "fp", "component_id"))


def keep_first(docs: DataFrame, id_column: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of every group of near-duplicates stays: the one with the smallest id (null ids come
    last; then the smallest hash of the text; one of identical rows). All columns are kept."""
    marked = durable(fingerprints(docs, id_column, text), "simhash-fingerprints")
    hashed, rank, id_, th = (fresh(docs, x) for x in ("hashed", "rank", "id", "th"))
    first = (_grouped(marked, radius).groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("n"), "id", "th")).alias("f"))
             .select(F.col("f.id").alias(id_), F.col("f.th").alias(th)))
    same_row = F.col(f"`{id_column}`").eqNullSafe(F.col(id_)) & (F.col(hashed) == F.col(th))
    kept = docs.withColumn(hashed, _text_hash(text)).join(first, same_row, "left_semi")
    copies = Window.partitionBy(f"`{id_column}`", hashed).orderBy(hashed)
    return kept.withColumn(rank, F.row_number().over(copies)).filter(F.col(rank) == 1).drop(rank, hashed)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: fingerprint and component of every whole text of ``documents``."""
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
