"""MinHash near-duplicates: SuperMinHash signatures, banding, verification on full sets, grouping.

A document is the set of its ``WORDS``-word shingles. SuperMinHash draws for every element one random
permutation of the signature's places, and rank by rank an element offers rank + fraction to the
place its permutation names; a place keeps its least offer. Ranks are correlated within an element,
which lowers the variance of the estimate, and once every place holds less than the next rank no
later offer can win, so long texts stop after one or two ranks.

1. Documents with equal sets are one class, which needs no comparison. Sets so small that a single
   different shingle breaks the threshold can only be equal, and need no signature.
2. Signatures are cut into ``BANDS`` bands of ``ROWS`` places. Two sets at the threshold of 0.85 share
   no band with a chance of 2e-9. Classes that share a band are compared with the band's leader:
   first by size and by the share of equal places (``ESTIMATE``: six deviations below the threshold),
   then exactly, on both full sets. Connected components follow on Spark.
3. Members of a band that are linked with one and the same class need nothing more. Where a band
   holds others, members of bands of up to ``HOT`` classes are compared with the other members that
   are not in their own group. Members of larger bands are dealt into tiles, and any two tiles that
   meet in a band are compared exactly, set by set, in one task; it hands back links that connect the
   same groups, never more than there are. So a group of copies costs a comparison for each member and
   not for each pair, a crowd of copies that are all too different costs tasks but no rows, and no
   link between groups is lost.

Cases with a defined result: null, empty and blank texts have the empty set, are linked with nothing
and are their own component. Fewer than ``WORDS`` words: the whole sequence is the one shingle. Null
ids name a component only if it has no other; a row with a null id is kept if its component has none.
Repeated rows share a component and are judged alike. An empty table gives no rows. Long texts are
hashed in pieces of ``PIECE`` bytes that overlap by ``WORDS`` - 1 words; a task holds eight bytes per
distinct shingle of one text, and one word at a time. Other columns are not read. Shingles are equal
if their 64-bit hashes are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, components, documents, durable, numbered, slices
from .tokens import buffer_of, mix

#: Words of a shingle, and the least similarity of a link in hundredths.
WORDS, PERCENT = 5, 85
#: Places of a signature, bands, and places of a band.
PLACES, BANDS, ROWS = 256, 42, 6
#: Least share of equal places that is worth an exact comparison.
ESTIMATE = 0.716
#: Rounds of comparisons with leaders, classes of a band that is not large, classes in a tile.
STARS, HOT, TILE = 1, 32, 512
#: Elements in a tile.
TILE_ELEMENTS = 1 << 20
#: Bytes of text, and elements, that a task works on at once.
PIECE, ELEMENTS = 1 << 19, 1 << 16
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)


# --- sets ---------------------------------------------------------------------------------------
def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every word of texts that lie end to end."""
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:n]
    closes[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    power = np.full(n + 1, _STEP, dtype=np.uint64)
    power[0] = 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.multiply.accumulate(power, out=power)
    np.cumsum(_LOWER[data] * power[:n], out=sums[1:])
    power[1:] = _BACK
    np.multiply.accumulate(power, out=power)
    return mix((sums[end] - sums[start]) * power[start]), np.searchsorted(offsets, start, side="right") - 1


def _shingles(words: np.ndarray, doc: np.ndarray, n: int, size: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every shingle; with ``whole``, texts of fewer words have one of all of them."""
    counts = np.bincount(doc, minlength=n)
    first = np.cumsum(counts) - counts
    at = np.arange(len(words))
    full = at - first[doc] + size <= counts[doc]
    start = at[full]
    h = np.full(len(start), size, dtype=np.uint64)
    for k in range(size):
        h = mix(h * _STEP + words[start + k])
    owner = doc[start]
    if whole:
        short = np.flatnonzero((counts > 0) & (counts < size))
        extra = counts[short].astype(np.uint64)
        for k in range(size - 1):
            has = counts[short] > k
            extra[has] = mix(extra[has] * _STEP + words[first[short[has]] + k])
        h, owner = np.concatenate([h, extra]), np.concatenate([owner, short])
    return h, owner


def _long_set(data: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles of one long text, piece by piece."""
    found, carried, at, n = [], np.zeros(0, dtype=np.uint64), 0, len(data)
    while at < n:
        end = min(n, at + PIECE)
        while end < n and not _SPACE[data[end]]:  # (a word longer than a piece stays whole)
            more = np.flatnonzero(_SPACE[data[end:end + PIECE]])
            end = end + int(more[0]) if len(more) else min(n, end + PIECE)
        words = np.concatenate([carried, _word_hashes(data[at:end], np.array([0, end - at]))[0]])
        if len(words) >= size or end == n:
            found.append(np.unique(_shingles(words, np.zeros(len(words), dtype=np.int64), 1, size, end == n and not found)[0]))
        carried, at = words[-(size - 1):] if size > 1 else words[:0], end
    return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.uint64)


def sets(texts: pa.Array, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of the distinct shingles of every text, in order of text and hash."""
    data, offsets = buffer_of(texts)
    if len(texts) == 1 and len(data) > PIECE:
        h = _long_set(data, size)
        return h, np.zeros(len(h), dtype=np.int64)
    h, owner = _shingles(*_word_hashes(data, offsets), len(texts), size, True)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], owner[new]


# --- signatures ---------------------------------------------------------------------------------
def super_minhash(elements: np.ndarray, owner: np.ndarray, n: int, places: int = PLACES) -> np.ndarray:
    """Signatures (n x places) of n sets, from their elements' hashes."""
    held = np.full((n, places), np.inf)
    flat, settled = held.reshape(-1), np.zeros(n, dtype=bool)
    for at in range(0, len(elements), ELEMENTS):
        h, doc = elements[at:at + ELEMENTS], owner[at:at + ELEMENTS]
        order = np.empty((len(h), places), dtype=np.uint16)
        order[:] = np.arange(places, dtype=np.uint16)
        live = np.arange(len(h))
        for rank in range(places):
            draw = mix(h[live] + np.uint64((rank + 1) * int(_STEP) % (1 << 64)))
            fraction = (mix(draw, 0x2545F491) >> np.uint64(11)) * 2.0 ** -53
            pick = rank + (((draw >> np.uint64(32)) * np.uint64(places - rank)) >> np.uint64(32)).astype(np.int64)
            place = order[live, pick]
            order[live, pick] = order[live, rank]
            np.minimum.at(flat, doc[live] * places + place, rank + fraction)
            if rank < 4 or rank % 4 == 3:
                # No later offer can win where every place holds less than the next rank.
                docs = np.unique(doc[live])
                settled[docs] = held[docs].max(axis=1) < rank + 1
                live = live[~settled[doc[live]]]
                if not len(live):
                    break
        settled[:] = False
    return held


def _bands(signatures: np.ndarray) -> np.ndarray:
    bits = np.ascontiguousarray(signatures).view(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(bits), BANDS))
    for k in range(ROWS):
        keys = mix(keys * _STEP + bits[:, k:BANDS * ROWS:ROWS])
    return keys


def _can_differ(n: int | np.ndarray) -> bool | np.ndarray:
    """Whether a set of this size can be linked with one that is not equal to it."""
    return 100 * n >= PERCENT * (n + 1)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for record in batches:
        for part in slices(record, "text", PIECE):
            n = part.num_rows
            h, owner = sets(part.column("text"))
            counts = np.bincount(owner, minlength=n)
            # Sums of two hashes of the elements name the set, whatever their order.
            names = np.zeros((n, 2), dtype=np.uint64)
            for k in range(2):
                np.add.at(names[:, k], owner, mix(h, 0x51ED27 + k))
                names[:, k] = mix(names[:, k] + counts.astype(np.uint64) * _STEP)
            raw = names.tobytes()
            signed = np.flatnonzero((counts > 0) & _can_differ(counts))
            bands, marks = [None] * n, [None] * n
            if len(signed):
                number = np.full(n, -1)
                number[signed] = np.arange(len(signed))
                mine = number[owner] >= 0
                signatures = super_minhash(h[mine], number[owner[mine]], len(signed))
                keys = _bands(signatures).view(np.int64)
                small = (mix(signatures.view(np.uint64)) >> np.uint64(56)).astype(np.uint8)
                for i, k in enumerate(signed.tolist()):
                    bands[k], marks[k] = keys[i], small[i].tobytes()
            yield pa.record_batch({"id": part.column("id"), "th": part.column("th"), "n": pa.array(counts, pa.int64()),
                                   "key": pa.array([raw[16 * k:16 * k + 16] if counts[k] else None for k in range(n)], pa.binary()),
                                   "bands": pa.array(bands, pa.list_(pa.int64())), "marks": pa.array(marks, pa.binary())})


# --- comparisons --------------------------------------------------------------------------------
def _close(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sizes and equal places allow a link."""
    for batch in batches:
        if not batch.num_rows:
            continue
        n, m = (batch.column(c).to_numpy() for c in ("n", "m"))
        one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1) for c in ("marks", "others"))
        stay = _close(n, m) & ((one == two).mean(axis=1) >= ESTIMATE)
        yield batch.select(["a", "b"]).filter(pa.array(stay))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets are similar enough."""
    for batch in batches:
        stay = []
        for one, two in zip(batch.column("one"), batch.column("two")):
            x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (one, two))
            both = len(np.intersect1d(x, y, assume_unique=True))
            stay.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(stay, pa.bool_()))


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of links that connect the same as all of them."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    stay = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = find(x), find(y)
        if x != y:
            root[x] = y
            stay.append(k)
    return np.array(stay, dtype=np.int64)


def _tile_links(one: list[dict], two: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Links between classes of two tiles whose labels differ, as a forest over the labels."""
    rows = [np.frombuffer(r["shingles"], dtype=np.uint64) for r in two]
    sizes = np.array([len(r) for r in rows])
    labels, numbers = np.array([r["label"] for r in two]), np.array([r["c"] for r in two])
    elements, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), sizes)
    order = np.argsort(elements, kind="stable")
    elements, owner = elements[order], owner[order]
    a, b, la, lb = [], [], [], []
    for r in one:
        mine = np.frombuffer(r["shingles"], dtype=np.uint64)
        if (labels == r["label"]).all():
            continue
        # How many elements this set has in common with each of the other tile.
        low, high = np.searchsorted(elements, mine, side="left"), np.searchsorted(elements, mine, side="right")
        count = high - low
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        both = np.bincount(owner[at], minlength=len(rows))
        hit = np.flatnonzero((100 * both >= PERCENT * (len(mine) + sizes - both)) & (labels != r["label"]))
        a.append(np.full(len(hit), r["c"])), la.append(np.full(len(hit), r["label"]))
        b.append(numbers[hit]), lb.append(labels[hit])
    if not a:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    a, b, la, lb = (np.concatenate(x) for x in (a, b, la, lb))
    stay = _forest(la, lb)
    return a[stay], b[stay]


def _compare_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for one, two in zip(batch.column("one").to_pylist(), batch.column("two").to_pylist()):
            a, b = _tile_links(one, two)
            yield pa.record_batch({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})


class _Classes:
    """Classes of equal sets and what is needed to compare them."""

    def __init__(self, docs: DataFrame, known: DataFrame) -> None:
        self.docs, self.known = docs, known
        self.signed = known.filter("marks is not null").select("c", "n", "marks")

    def likely(self, pairs: DataFrame) -> DataFrame:
        one, two = (self.signed.select(F.col("c").alias(c), F.col("n").alias(n), F.col("marks").alias(m)) for c, n, m in (("a", "n", "marks"), ("b", "m", "others")))
        return pairs.join(one, "a").join(two, "b").select("a", "b", "n", "m", "marks", "others").mapInArrow(_likely, "a long, b long")

    def sets(self, wanted: DataFrame, name: str) -> DataFrame:
        """(c, shingles) of the classes in ``wanted``, from the text of their first row."""
        places = self.known.join(wanted, "c", "left_semi").select("c", F.col("place.id").alias("__id"), F.col("place.th").alias("__th"))
        found = self.docs.join(places, F.col("id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th"))).select("c", "text")

        def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for record in batches:
                for part in slices(record, "text", PIECE):
                    h, owner = sets(part.column("text"))
                    cuts = np.searchsorted(owner, np.arange(part.num_rows + 1)).tolist()
                    yield pa.record_batch({"c": part.column("c"), "shingles": pa.array([h[x:y].tobytes() for x, y in zip(cuts, cuts[1:])], pa.binary())})

        return durable(found.mapInArrow(hashed, "c long, shingles binary").dropDuplicates(["c"]), f"minhash-{name}-sets")

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """Of the likely pairs (a, b), those that are linked."""
        pairs = durable(pairs.distinct(), f"minhash-{name}")
        full = self.sets(pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct(), name)
        one, two = (full.select(F.col("c").alias(c), F.col("shingles").alias(s)) for c, s in (("a", "one"), ("b", "two")))
        return durable(pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two").mapInArrow(_verify, "a long, b long"), f"minhash-{name}-links")


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """(band, c, label) of the members of bands with several labels. Classes of one label are linked
    with one class, or are it; that they may be connected otherwise costs a comparison only."""
    ends = links.union(links.select("b", "a")).toDF("c", "d")
    least = ends.groupBy("c").agg(F.least(F.min("d"), F.col("c")).alias("label"))
    all_ = members.join(least, "c", "left").select("band", "c", F.coalesce("label", "c").alias("label"))
    mixed = all_.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y").select("band")
    return durable(all_.join(mixed, "band", "left_semi"), "minhash-mixed")


def _star(members: DataFrame, seed: int) -> DataFrame:
    """(a, b): each member and the leader of its band, if their labels differ."""
    lead = members.groupBy("band").agg(F.min(F.struct(F.xxhash64(F.lit(seed), "c").alias("h"), "c", "label")).alias("f"))
    return (members.join(lead, "band").filter(F.col("label") != F.col("f.label"))
            .select(F.least("c", "f.c").alias("a"), F.greatest("c", "f.c").alias("b")).distinct())


def _cold(left: DataFrame, sizes: DataFrame, hot: DataFrame) -> DataFrame:
    """(a, b): pairs of classes in one band, of different labels, of which one is in no large band."""
    rows = left.join(sizes.filter(F.col("k") <= F.lit(HOT)).select("band"), "band", "left_semi")
    marked = rows.join(hot.select("c", F.lit(True).alias("hot")), "c", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    other = marked.select("band", F.col("c").alias("d"), F.col("label").alias("l"), F.col("hot").alias("h"))
    pairs = marked.filter(~F.col("hot")).join(other, "band").filter((F.col("label") != F.col("l")) & (F.col("h") | (F.col("c") < F.col("d"))))
    return pairs.select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).distinct()


def _hot(left: DataFrame, hot: DataFrame, known: _Classes, tile: int) -> DataFrame:
    """Links (a, b) between members of large bands. A member's tile belongs to the largest of its
    bands, so copies of one text share few tiles; the table of tiles that meet is small."""
    full = known.sets(hot.select("c"), "hot")
    labels = left.groupBy("c").agg(F.min("label").alias("label"))
    members = hot.join(labels, "c").join(known.signed.select("c", "n"), "c")
    parts = members.groupBy("anchor").agg(F.greatest(F.ceil(F.count(F.lit(1)) / tile), F.ceil(F.sum("n") / TILE_ELEMENTS)).alias("parts"))
    members = members.join(parts, "anchor").select("c", "label", F.col("anchor").alias("t"), F.pmod(F.xxhash64("c"), F.col("parts")).alias("p"))
    members = durable(members, "minhash-hot")
    tiles = durable(members.join(full, "c").groupBy("t", "p").agg(F.collect_list(F.struct("c", "label", "shingles")).alias("rows")), "minhash-tiles")
    # (numbered so that each unordered pair of tiles comes once)
    meets = left.select("band", "c").join(members, "c").select("band", "t", "p").distinct()
    other = meets.select("band", F.col("t").alias("u"), F.col("p").alias("q"))
    pairs = meets.join(other, "band").filter((F.col("t") < F.col("u")) | ((F.col("t") == F.col("u")) & (F.col("p") <= F.col("q"))))
    pairs = durable(pairs.select("t", "p", "u", "q").distinct(), "minhash-tile-pairs").repartition("t", "p", "u", "q")
    one, two = tiles.withColumnRenamed("rows", "one"), tiles.toDF("u", "q", "two")
    return durable(pairs.join(one, ["t", "p"]).join(two, ["u", "q"]).select("one", "two").mapInArrow(_compare_tiles, "a long, b long"), "minhash-hot-links")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", stars: int = STARS, tile: int = TILE) -> DataFrame:
    """(id, n_shingles, component_id) of every row: the number of its distinct shingles and the
    smallest id reachable over links; see the module for nulls, short texts and repeats."""
    bounded_batches(docs.sparkSession)
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    kind = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), F.xxhash64(whole).alias("th"), whole.alias("text"))
    marked = durable(texts.mapInArrow(_describe, f"id {kind}, th long, n long, key binary, bands array<long>, marks binary"), "minhash-marked")
    # All rows of a class have the same set, and so the same signature.
    place = F.struct(F.col("id").isNull().alias("none"), "id", "th")
    classes = marked.filter("n > 0").groupBy("key").agg(F.min(place).alias("place"), *[F.first(c).alias(c) for c in ("n", "bands", "marks")])
    classes = durable(numbered(durable(classes, "minhash-classes"), [], ["key"], "c"), "minhash-numbered")
    known = _Classes(texts, classes)
    rows = classes.filter("marks is not null").select("c", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.min("c").alias("x"), F.max("c").alias("y")).filter("x < y").select("band")
    members = durable(rows.join(shared, "band", "left_semi"), "minhash-members")
    links, left = [], members.withColumn("label", F.col("c"))
    for k in range(stars):
        links.append(known.verified(known.likely(_star(left, k)), f"star-{k}"))
        left = _labelled(members, reduce(DataFrame.union, links))
    sizes = durable(left.groupBy("band").agg(F.count(F.lit(1)).alias("k")), "minhash-sizes")
    large = left.join(sizes.filter(F.col("k") > F.lit(HOT)), "band")
    hot = durable(large.groupBy("c").agg(F.max(F.struct("k", "band")).alias("m")).select("c", F.col("m.band").alias("anchor")), "minhash-anchors")
    links.append(known.verified(known.likely(_cold(left, sizes, hot)), "cold"))
    links.append(_hot(left, hot, known, tile))
    links = reduce(DataFrame.union, links)
    roots = durable(components(links), "minhash-components").select(F.col("node").alias("c"), "root")
    rooted = classes.select("key", "c", F.col("place.id").alias("id")).join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
    named = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    by_key = durable(rooted.join(named, "root").select(F.col("key").alias("__key"), "component_id"), "minhash-named")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return (marked.select("id", "n", "key").join(by_key, F.col("key") == F.col("__key"), "left")
            .select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), own.alias("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: component of every whole text of ``documents``, and whether it is the one to keep."""
    found = near_duplicates(documents(spark, sf_dir))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def oracle_sql() -> str:
    """The same in DuckDB, on whole sets of words without signatures (ids must be distinct)."""
    space = r"[ \t\n\x0B\f\r]+"
    return rf"""with recursive w as (select doc_id, list_filter(string_split_regex(regexp_replace(translate(coalesce(text, ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{space}', ' ', 'g'), ' '), lambda x: x <> '') as words from documents),
      s as (select doc_id, list_distinct(if(length(words) < {WORDS}, list_filter([array_to_string(words, ' ')], lambda x: x <> ''),
          list_transform(range(1, length(words) - {WORDS - 2}), lambda i: array_to_string(words[i:i + {WORDS - 1}], ' ')))) as sh from w),
      sized as (select doc_id, length(sh) as n, sh from s),
      same as (select list_sort(sh) as sh, n, min(doc_id) as c from sized where n > 0 group by all),
      e as (select c, n, unnest(sh) as x from same),
      t as (select x, count(*) as k from e group by x having k > 1),
      r as (select c, n, x, row_number() over (partition by c order by k, x) + n - count(*) over (partition by c) as i from e join t using (x)),
      p as (select distinct a.c as a, b.c as b from r a join r b using (x) where a.c < b.c and 100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n)
        and 100 * (a.n - a.i + 1) >= {PERCENT} * a.n and 100 * (b.n - b.i + 1) >= {PERCENT} * b.n),
      l as (select a, b from p join same x on x.c = a join same y on y.c = b
        where 100 * length(list_intersect(x.sh, y.sh)) >= {PERCENT} * (x.n + y.n - length(list_intersect(x.sh, y.sh)))),
      g as (select a, b from l union all select b, a from l),
      reach as (select c as a, c as b from same union select reach.a, g.b from reach join g on g.a = reach.b),
      root as (select a as c, min(b) as component_id from reach group by a),
      named as (select sh, n, component_id from same join root using (c))
      select d.doc_id, d.n as n_shingles, coalesce(component_id, d.doc_id) as component_id, d.doc_id is not distinct from coalesce(component_id, d.doc_id) as kept
      from sized d left join named on named.n = d.n and named.sh = list_sort(d.sh)"""
