"""Helpers the operators share: durable tables in the cluster's shared folder, null-safe text
and keys, distributed numbering, connected components and Arrow batch slicing."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Characters that separate words in every operator's contract: space, tab to carriage return.
SPACE = r" \t\n\x0B\f\r"


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Where neither the session nor the context
    has any, a local master (tests) gets a temporary folder; a cluster, whose executors would each
    write to their own disk, is refused."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder for intermediate tables")
        path = tempfile.mkdtemp(prefix="ledgerspark-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


_scopes: list[list[str]] = []


def durable(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends here, so a lost
    executor never reruns what lies above. Inside ``passing``, the table goes when the block ends;
    with ``keep`` it outlives the block."""
    path = f"{work_dir(df.sparkSession)}/ledgerspark-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if len(_scopes) > keep:
        _scopes[-1 - keep].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that ``durable`` writes in this block are removed at its end. Nothing that is used later
    may read them: what the block hands on is written with ``keep``. Spark's cleaner is woken as well:
    it drops the shuffle files of plans that nobody holds any more."""
    _scopes.append([])
    try:
        yield
    finally:
        jvm = spark.sparkContext._jvm
        for path in _scopes.pop():
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        gc.collect()
        jvm.System.gc()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def bounded_batches(spark: SparkSession, limit: int = 4 << 20) -> None:
    """Let Arrow batches of this session hold ``limit`` bytes at most (one row at least), so that
    a task's memory does not grow with the texts that happen to share a batch."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(str(spark.conf.get(key)).rstrip("b")) > limit:
        spark.conf.set(key, str(limit))


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (callers' extra columns may clash with ours)."""
    taken, name = {c.lower() for c in df.columns}, f"__{stem}"
    while name.lower() in taken:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with at most ``limit`` bytes of text each (one row at least),
    so the working arrays of a task stay bounded however long the texts are."""
    at, size = 0, 0
    lengths = pc.binary_length(batch.column(column)).to_pylist()
    for i, n in enumerate(lengths):
        if i > at and size + (n or 0) > limit:
            yield batch.slice(at, i - at)
            at, size = i, 0
        size += n or 0
    if at < batch.num_rows:
        yield batch.slice(at)


def numbered(df: DataFrame, group: list[str], order: list[str], name: str, spread: Column | None = None,
             rows: int | None = None, per_part: int = 20_000) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... within each ``group``, without bringing a group into one task.

    Rows are dealt by ``spread`` (default: a hash of ``order``) into about one part per ``per_part``
    rows, numbered inside the part by ``order``, and shifted by the counts of the parts before it,
    a table of one row per part. ``order`` must identify a row up to copies; rows equal in it get
    different numbers in either order. ``rows``: the number of rows, if known.
    """
    total = df.count() if rows is None else rows
    part, first, here = "__part", "__first", "__here"
    dealt = F.xxhash64(*order) if spread is None else spread
    split = df.withColumn(part, F.pmod(dealt, F.lit(max(1, -(-total // per_part)))))
    counts = split.groupBy(*group, part).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(c).alias(f"__g_{c}") for c in group], F.col(part).alias("__p"),
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(first))
    inside = Window.partitionBy(*group, part).orderBy(*order)
    ranked = split.withColumn(here, F.row_number().over(inside) - 1)
    on = F.col(part) == F.col("__p")
    for c in group:
        on = on & F.col(c).eqNullSafe(F.col(f"__g_{c}"))
    return (ranked.join(starts, on).withColumn(name, (F.col(first) + F.col(here)).cast("long"))
            .drop(part, first, here, "__p", *[f"__g_{c}" for c in group]))


def ranked(df: DataFrame, order: list[str], name: str, per_part: int = 200_000) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... in the ``order`` of the whole table, which must tell all rows
    apart. Rows are dealt by ranges of the order, so no task holds more than a range. Written once:
    the numbers never change when a task runs again."""
    df = durable(df, "ranked-rows")
    rows, part = df.count(), fresh(df, "range")
    dealt = df.repartitionByRange(max(1, -(-rows // per_part)), *order).withColumn(part, F.spark_partition_id())
    dealt = durable(dealt, "ranked-ranges")
    parts = (dealt.agg(F.max(part)).first()[0] or 0) + 1
    return durable(numbered(dealt, [], order, name, spread=F.col(part), rows=parts, per_part=1).drop(part), "ranked")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (columns a, b; any order): rows (node, root), where root
    is the smallest node reachable. Alternating large-star and small-star steps on Spark; each
    step is a grouped minimum and an equi join, and lineage is cut after every round. The number
    of edges never grows, and a hub is pre-aggregated before it is shuffled."""
    edge = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edge = durable(edge, "edges")
    last = None
    for _ in range(rounds):
        both = edge.select("u", "v").union(edge.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(low, F.col("u") == F.col("k")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small_low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = (large.join(small_low, F.col("u") == F.col("k"))
                 .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        edge = durable(small, "edges")
        state = edge.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == last:
            break
        last = tuple(state)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edge.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.union(edge.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
