"""Repeated passages by a distributed difference-cover suffix algorithm.

Every byte covered by a string of ``MATCH`` bytes that also starts earlier in the corpus goes.
Only the order of suffixes by their first ``MATCH`` bytes matters for that, so the recursion of a
difference-cover suffix sort ends after two levels, and names may be hashes instead of ranks:

1. Sample the positions whose offset modulo ``PERIOD`` lies in a difference cover. For any two
   positions, one shift below ``PERIOD`` leads both to a sampled position. Name each sample by its
   next ``MATCH - PERIOD + 1`` bytes, sort the names bucket by bucket, compare adjacent ones, and
   forget every sample whose name is unique: no repeated string can lead to it.
2. Recurse on the samples that remain: name each by everything that the strings leading to it can
   cover, sort, and compare adjacent names. A sample equal to an earlier one in that repeats it as
   a whole.
3. Merge the remaining suffixes: where samples agree on a part only, the strings between are named
   themselves and sorted, and each is compared with the first one of its name.

Sorting works on packed arrays: a task sends the sorted names of a batch to each bucket as one
row, and keeps back those that repeat within the batch, so a passage that every text holds sends
one name per task. Names are 64 bits beside the bucket's. The texts travel once: all joins with
them are by (id, hash of the text) on one reused exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, documents, durable, ranked, slices
from .tokens import buffer_of

#: Bytes of a string that counts as repeated.
MATCH = 100
# A perfect difference set modulo 57; its differences are all residues.
PERIOD, COVER = 57, (0, 1, 3, 13, 32, 36, 43, 52)
#: Bytes that name a sample at first, and half of the way that strings may start before it.
NAME, HALF = MATCH - PERIOD + 1, (PERIOD - 1) // 2
#: Names that a task packs, and that a bucket sorts, at once (about).
BATCH, BUCKET = 1_000_000, 1_000_000
#: Bits of a first name beside the bucket's; equal ones only cost a second look.
_LOW = 28
_CHUNK = 1 << 19
_COVER = np.array(COVER, dtype=np.int64)
_BEFORE = np.searchsorted(_COVER, np.arange(PERIOD), side="right")
# Two independent polynomial hashes modulo 2^64: an odd factor, its inverse, a number per byte.
_FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_BYTES = np.random.default_rng(20).integers(0, 1 << 64, size=(2, 256), dtype=np.uint64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get(which)
    if have is None or len(have[0]) < n:
        made = []
        for base in (_FACTORS[which], pow(_FACTORS[which], -1, 1 << 64)):
            p = np.full(max(n, 1), base, dtype=np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        have = _powers[which] = (made[0], made[1])
    return have


class _Sums:
    """Running sums of a byte string, which give the hash of any part of it at once."""

    def __init__(self, data: np.ndarray, which: int) -> None:
        self.power, self.back = _power(which, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[which][data] * self.power[:len(data)], out=self.sums[1:])

    def part(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xFF51AFD7ED558CCD)
        return h ^ (h >> np.uint64(33))


def _samples(lengths: np.ndarray) -> np.ndarray:
    """Samples of texts of these lengths: positions of the cover with a whole name behind them."""
    room = lengths - NAME
    return np.where(lengths >= MATCH, len(COVER) * (room // PERIOD) + _BEFORE[np.maximum(room, 0) % PERIOD], 0)


def _position(sample: np.ndarray) -> np.ndarray:
    return PERIOD * (sample // len(COVER)) + _COVER[sample % len(COVER)]


def _bucket(names: np.ndarray, buckets: int) -> np.ndarray:
    return ((names >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _pack(numbers: np.ndarray, kind: str = "<u4") -> bytes:
    """Numbers with their bytes turned plane by plane; the shuffle's compression then finds the
    planes that hardly change."""
    whole = np.ascontiguousarray(numbers.astype(kind))
    return np.ascontiguousarray(whole.view(np.uint8).reshape(-1, whole.itemsize).T).tobytes()


def _unpack(raw: bytes, kind: str = "<u4") -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(size, -1).T).view(kind).ravel()


def _pack_sorted(numbers: np.ndarray, kind: str = "<u4") -> bytes:
    return _pack(np.diff(numbers, prepend=numbers.dtype.type(0)), kind)


def _unpack_sorted(raw: bytes, kind: str = "<u4") -> np.ndarray:
    return np.cumsum(_unpack(raw, kind), dtype=np.uint64)


def _cuts(sorted_keys: np.ndarray) -> list[tuple[int, int]]:
    """Runs of equal numbers as (start, end)."""
    if not len(sorted_keys):
        return []
    edges = np.concatenate([[0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1, [len(sorted_keys)]])
    return list(zip(edges[:-1].tolist(), edges[1:].tolist()))


# --- first level -------------------------------------------------------------------------------
_ROWS = "kind int, bucket int, batch long, n int, a binary, b binary"
_NAMES, _TABLE, _REPEATED = 0, 1, 2


def _rows(kind: int, bucket: list[int], batch: int, n: list[int], a: list[bytes], b: list[bytes]) -> pa.RecordBatch:
    k = len(bucket)
    return pa.record_batch({"kind": pa.array([kind] * k, pa.int32()), "bucket": pa.array(bucket, pa.int32()), "batch": pa.array([batch] * k, pa.int64()),
                            "n": pa.array(n, pa.int32()), "a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def _name_samples(buckets: int, size: int) -> Callable:
    """Per batch of texts: the distinct names of its samples by bucket, the table of its texts, and
    the samples that already repeat within the batch."""
    def flush(batch: int, names: list, table: list) -> Iterator[pa.RecordBatch]:
        h = np.concatenate(names)
        key = (_bucket(h, buckets) << np.uint64(32)) | (h & np.uint64((1 << _LOW) - 1))
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.concatenate([[True], key[1:] != key[:-1]])
        alone = first & np.concatenate([first[1:], [True]])
        repeated = np.sort(order[~alone])
        key, order = key[first], order[first]
        bucket, low = key >> np.uint64(32), key & np.uint64(0xFFFFFFFF)
        spans = _cuts(bucket)
        yield _rows(_NAMES, [int(bucket[x]) for x, _ in spans], batch, [y - x for x, y in spans],
                    [_pack_sorted(low[x:y]) for x, y in spans], [_pack(order[x:y]) for x, y in spans])
        texts = [np.concatenate(x) for x in zip(*table)]
        yield _rows(_TABLE, [batch % buckets], batch, [len(texts[0])], [b"".join(x.astype(np.int64).tobytes() for x in texts)], [b""])
        if len(repeated):
            yield _rows(_REPEATED, [batch % buckets], batch, [len(repeated)], [_pack_sorted(repeated)], [b""])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch, names, table, held = TaskContext.get().partitionId() << 24, [], [], 0
        for record in batches:
            for part in slices(record, "text", _CHUNK):
                data, offsets = buffer_of(part.column("text"))
                counts = _samples(np.diff(offsets))
                sample = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                at = _position(sample) + np.repeat(offsets[:-1], counts)
                names.append(_Sums(data, 0).part(at, at + NAME))
                ids = part.column("id")
                table.append((ids.fill_null(0).to_numpy(zero_copy_only=False), np.asarray(ids.is_null().to_numpy(zero_copy_only=False)),
                              part.column("th").to_numpy(), counts))
                held += len(at)
                if held >= size:
                    yield from flush(batch, names, table)
                    batch, names, table, held = batch + 1, [], [], 0
        if held:
            yield from flush(batch, names, table)

    return run


def _compare_names(group: pa.Table) -> pa.Table:
    """One bucket: sort the names of all batches, and report those that occur in several."""
    is_name = pa.array(group.column("kind").to_numpy() == _NAMES)
    out, names = group.filter(pc.invert(is_name)), group.filter(is_name)
    if names.num_rows:
        batches = names.column("batch").to_pylist()
        low = np.concatenate([_unpack_sorted(a) for a in names.column("a").to_pylist()]).astype(np.uint32)
        sample = np.concatenate([_unpack(b) for b in names.column("b").to_pylist()])
        source = np.repeat(np.arange(names.num_rows), names.column("n").to_numpy())
        order = np.argsort(low, kind="stable")
        same = low[order][1:] == low[order][:-1]
        twice = np.zeros(len(low), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = np.flatnonzero(twice)
        cuts = np.searchsorted(source[hit], np.arange(names.num_rows + 1))
        here = group.column("bucket")[0].as_py()
        found = [_rows(_REPEATED, [here], batches[k], [int(y - x)], [_pack_sorted(np.sort(sample[hit[x:y]]))], [b""])
                 for k, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
        out = pa.concat_tables([out, pa.Table.from_batches(found, out.schema)])
    return out


def _by_text(repeated: pa.Table, table: pa.Table) -> pa.Table:
    """Samples of a batch back to the texts that hold them."""
    ids, ths, counts, packed = [], np.zeros(0, dtype=np.int64), [], []
    if repeated.num_rows and table.num_rows:
        n = table.column("n")[0].as_py()
        all_ids, nulls, all_ths, held = np.frombuffer(table.column("a")[0].as_py(), dtype=np.int64).reshape(4, n)
        sample = np.unique(np.concatenate([_unpack_sorted(a) for a in repeated.column("a").to_pylist()])).astype(np.int64)
        first = np.cumsum(held) - held
        text = np.searchsorted(first + held, sample, side="right")
        at = _position(sample - first[text]).astype(np.uint64)
        spans = _cuts(text)
        owner = text[[x for x, _ in spans]]
        ids, ths = [None if nulls[k] else int(all_ids[k]) for k in owner], all_ths[owner]
        counts, packed = [y - x for x, y in spans], [_pack_sorted(at[x:y]) for x, y in spans]
    return pa.table({"id": pa.array(ids, pa.int64()), "th": pa.array(ths, pa.int64()), "n": pa.array(counts, pa.int64()), "at": pa.array(packed, pa.binary())})


# --- second and third level ---------------------------------------------------------------------
_PLACED = "kind int, bucket int, r long, n int, a binary, b binary, c binary, d binary, e binary"
_LATER, _LEFT, _RIGHT = 1, 2, 3
_LISTS = ["laters", "lefts", "rights"]


def _placed(kind: int, bucket: list[int], r: list[int], n: list[int], *packed: list[bytes]) -> dict:
    columns = [*packed, *[[None] * len(bucket)] * (5 - len(packed))]
    return {"kind": pa.array([kind] * len(bucket), pa.int32()), "bucket": pa.array(bucket, pa.int32()), "r": pa.array(r, pa.int64()),
            "n": pa.array(n, pa.int32()), **{c: pa.array(v, pa.binary()) for c, v in zip("abcde", columns)}}


def _by_group(kind: int, bucket: int | None, buckets: int, groups: int, r: np.ndarray, p: np.ndarray) -> dict:
    """Places in rows of one group of texts each: their ranks and positions, in order. Texts are dealt
    into ``groups`` by rank, so the rows number buckets times groups and not buckets times texts."""
    g = r % np.uint64(groups)
    order = np.lexsort((p, r, g))
    g, r, p = g[order], r[order], p[order]
    spans = _cuts(g)
    numbers = [int(g[x]) for x, _ in spans]
    return _placed(kind, [k % buckets if bucket is None else bucket for k in numbers], numbers, [y - x for x, y in spans],
                   [_pack_sorted(r[x:y], "<u8") for x, y in spans], [_pack(p[x:y]) for x, y in spans])


def _by_text_rank(group: pa.Table) -> pa.Table:
    """One group of texts: the positions of each text and kind, from all buckets."""
    found: dict[int, list] = {}
    for kind, column in ((_LATER, 0), (_LEFT, 1), (_RIGHT, 2)):
        mine = group.filter(pa.array(group.column("kind").to_numpy() == kind))
        if not mine.num_rows:
            continue
        r = np.concatenate([_unpack_sorted(x, "<u8") for x in mine.column("a").to_pylist()])
        p = np.concatenate([_unpack(x) for x in mine.column("b").to_pylist()])
        order = np.lexsort((p, r))
        r, p = r[order], p[order]
        for x, y in _cuts(r):
            found.setdefault(int(r[x]), [None] * 3)[column] = _pack_sorted(p[x:y])
    ranks = sorted(found)
    return pa.table({"r": pa.array(ranks, pa.int64()), **{c: pa.array([found[k][j] for k in ranks], pa.binary()) for j, c in enumerate(_LISTS)}})


def _judge(bucket: np.ndarray, name: np.ndarray, r: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by name and place: (order, first of each name, places behind the first one)."""
    order = np.lexsort((p, r, name, bucket))
    b, h, r, p = bucket[order], name[order], r[order], p[order]
    first = np.concatenate([[True], (h[1:] != h[:-1]) | (b[1:] != b[:-1])]) if len(h) else np.zeros(0, dtype=bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))
    return order, first, (r != r[start]) | (p != p[start])


class _Names:
    """Names of one task with their places, packed by bucket whenever a batch is full. A place that
    repeats an earlier one of the same batch is known to be later and goes no further."""

    def __init__(self, buckets: int, groups: int, size: int) -> None:
        self.buckets, self.groups, self.size, self.held, self.parts = buckets, groups, size, 0, []

    def add(self, bucket, name, r, p, left=None, right=None) -> Iterator[pa.RecordBatch]:
        none = np.zeros(len(name), dtype=np.uint32)
        self.parts.append((bucket, name, r, p, none if left is None else left, none if right is None else right))
        self.held += len(name)
        if self.held >= self.size:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            bucket, name, r, p, left, right = (np.concatenate(x) for x in zip(*self.parts))
            order, first, later = _judge(bucket, name, r, p)
            gone, stay = order[later], order[first]
            if len(gone):
                yield pa.record_batch(_by_group(_LATER, None, self.buckets, self.groups, r[gone], p[gone]))
            bucket, name, r, p, left, right = (x[stay] for x in (bucket, name, r, p, left, right))
            spans = _cuts(bucket)
            cut = lambda x, kind: [_pack(x[a:b], kind) for a, b in spans]
            yield pa.record_batch(_placed(_NAMES, [int(bucket[a]) for a, _ in spans], [0] * len(spans), [b - a for a, b in spans],
                                          [_pack_sorted(name[a:b], "<u8") for a, b in spans], cut(r, "<u8"), cut(p, "<u4"),
                                          cut(left, "<u4"), cut(right, "<u4")))
        self.parts, self.held = [], 0


def _compare_places(buckets: int, groups: int, sides: bool) -> Callable:
    """One bucket: sort the names of all batches; places behind the first one of their name are
    later. With ``sides``, first places that agree with another first one on a part as well."""
    def run(group: pa.Table) -> pa.Table:
        is_name = pa.array(group.column("kind").to_numpy() == _NAMES)
        out, names = group.filter(pc.invert(is_name)), group.filter(is_name)
        found = []
        if names.num_rows:
            name = np.concatenate([_unpack_sorted(a, "<u8") for a in names.column("a").to_pylist()])
            r, p, left, right = (np.concatenate([_unpack(x, kind) for x in names.column(c).to_pylist()])
                                 for c, kind in zip("bcde", ("<u8", "<u4", "<u4", "<u4")))
            order, first, later = _judge(np.zeros(len(name), dtype=np.uint8), name, r, p)
            here = group.column("bucket")[0].as_py()
            gone, stay = order[later], order[first]
            found = [(_LATER, gone)]
            if sides:
                for kind, side in ((_LEFT, left[stay]), (_RIGHT, right[stay])):
                    _, where, count = np.unique(side, return_inverse=True, return_counts=True)
                    found.append((kind, stay[(count[where] > 1) & (side > 0)]))
        return pa.concat_tables([out, *[pa.table(_by_group(kind, here, buckets, groups, r[at], p[at]), schema=out.schema) for kind, at in found if len(at)]])

    return run


def _side(hashes: np.ndarray, has: np.ndarray) -> np.ndarray:
    """32 bits of a part's name, 0 for none."""
    return np.where(has, np.maximum(hashes.astype(np.uint32), 1), 0).astype(np.uint32)


def _lists(column) -> list[np.ndarray]:
    """For each row, the distinct numbers in its packed list or lists, as positions."""
    rows = ([row] if isinstance(row, bytes) else row for row in column.to_pylist())
    return [np.unique(np.concatenate([_unpack_sorted(x) for x in row])).astype(np.int64) if row else np.zeros(0, dtype=np.int64) for row in rows]


def _wide_names(buckets: int, groups: int, size: int) -> Callable:
    """Second level: each remaining sample by all that strings leading to it cover, and by the two
    parts one of which any such string covers. Samples of one first name meet in one bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Names(buckets, groups, size)
        for record in batches:
            for part in slices(record, "text", _CHUNK):
                data, offsets = buffer_of(part.column("text"))
                found = _lists(part.column("at"))
                owner = np.repeat(np.arange(len(found)), [len(x) for x in found])
                if not len(owner):
                    continue
                at = np.concatenate(found)
                n, base = np.diff(offsets)[owner], offsets[:-1][owner]
                low, high = np.maximum(at - PERIOD + 1, 0), np.minimum(at, n - MATCH) + MATCH
                one, two = _Sums(data, 0), _Sums(data, 1)
                salt = (at - low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                has_left, has_right = at >= HALF, at + MATCH - HALF <= n
                left = two.part(base + np.where(has_left, at - HALF, at), base + at + NAME)
                right = two.part(base + at, base + np.where(has_right, at + MATCH - HALF, at))
                yield from out.add(_bucket(one.part(base + at, base + at + NAME), buckets), two.part(base + low, base + high) + salt,
                                   part.column("r").to_numpy()[owner].astype(np.uint64), at.astype(np.uint32),
                                   _side(left, has_left), _side(right, has_right))
        yield from out.flush()

    return run


def _strings(buckets: int, groups: int, size: int) -> Callable:
    """Third level: the strings themselves that lead to a sample which agrees with another one on
    the part before it (``lefts``) or behind it (``rights``). Strings inside a passage that repeats
    an earlier one as a whole are settled, and the first place of any string lies in none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Names(buckets, groups, size)
        for record in batches:
            for part in slices(record, "text", _CHUNK):
                data, offsets = buffer_of(part.column("text"))
                one, two, starts = _Sums(data, 1), _Sums(data, 0), []
                for k, (laters, lefts, rights) in enumerate(zip(*(_lists(part.column(c)) for c in ("laters", "lefts", "rights")))):
                    n = offsets[k + 1] - offsets[k]
                    at = np.unique(np.concatenate([(lefts[:, None] - np.arange(HALF, PERIOD)).ravel(), (rights[:, None] - np.arange(HALF + 1)).ravel()]))
                    at = at[(at >= 0) & (at + MATCH <= n)]
                    if len(laters):
                        low, high = _passages(laters, n)
                        k_low = np.searchsorted(low, at, side="right") - 1
                        at = at[(k_low < 0) | (at + MATCH > high[k_low])]
                    starts.append(at)
                owner, at = np.repeat(np.arange(len(starts)), [len(x) for x in starts]), np.concatenate(starts)
                base = offsets[:-1][owner] + at
                name = one.part(base, base + MATCH)
                # (the bucket comes from another hash, so it tells names apart beside their 64 bits)
                yield from out.add(_bucket(two.part(base, base + MATCH), buckets), name, part.column("r").to_numpy()[owner].astype(np.uint64), at.astype(np.uint32))
        yield from out.flush()

    return run


def _passages(samples: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """What samples equal to earlier ones repeat: (starts, ends) in order, each end the largest so far."""
    samples = np.sort(samples)
    return np.maximum(samples - PERIOD + 1, 0), np.maximum.accumulate(np.minimum(samples, n - MATCH) + MATCH)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unite the repeated passages of each text and take them out."""
    for record in batches:
        sizes, removed, digests, spans = [], [], [], []
        for text, copy, laters, starts in zip(record.column("text"), record.column("copy").to_pylist(), *(_lists(record.column(c)) for c in ("laters", "starts"))):
            data = text.as_py().encode()
            low, high = _passages(laters, len(data))
            low, high = np.concatenate([low, starts]), np.concatenate([high, starts + MATCH])
            if copy:
                low, high = np.array([0]), np.array([len(data)])
            order = np.argsort(low, kind="stable")
            low, high = low[order], np.maximum.accumulate(high[order]) if len(high) else high
            opens = np.concatenate([[True], low[1:] > high[:-1]]) if len(low) else np.zeros(0, dtype=bool)
            begin, end = low[opens].tolist(), high[np.roll(opens, -1)].tolist()
            kept = b"".join(data[x:y] for x, y in zip([0, *end], [*begin, len(data)]))
            sizes.append(len(data))
            removed.append(len(data) - len(kept))
            digests.append(hashlib.sha256(kept).hexdigest())
            spans.append([int(x) for pair in zip(begin, end) for x in pair])
        yield pa.record_batch({"id": record.column("id"), "th": record.column("th"), "n_bytes": pa.array(sizes, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                               "n_spans": pa.array([len(s) // 2 for s in spans], pa.int64()), "kept_sha256": pa.array(digests, pa.string()),
                               "spans": pa.array(spans, pa.list_(pa.int64()))})


# --- plan ---------------------------------------------------------------------------------------
def _joined(texts: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
    """Texts with what ``other`` has for them by (id, th)."""
    right = other.withColumnsRenamed({"id": "__id", "th": "__th"})
    return texts.join(right, F.col("id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th")), how).drop("__id", "__th")


def _ranks(texts: DataFrame) -> DataFrame:
    """(id, th, r, copy) of the distinct (id, th): r numbers them in the order of the corpus; copy
    marks texts of ``MATCH`` bytes or more that an earlier one equals as a whole."""
    keys = texts.groupBy("id", "th").agg(F.min(F.xxhash64(F.lit(1), "text")).alias("th2"), F.min(F.octet_length("text")).alias("n"))
    numbers = ranked(keys.withColumn("last", F.col("id").isNull()), ["last", "id", "th"], "r")
    first = numbers.groupBy("th", "th2", "n").agg(F.min("r").alias("first"), F.max("r").alias("final")).filter("first < final")
    first = first.select(F.col("th").alias("__t"), F.col("th2").alias("__u"), F.col("n").alias("__n"), "first")
    same = (F.col("th") == F.col("__t")) & (F.col("th2") == F.col("__u")) & (F.col("n") == F.col("__n"))
    copy = F.coalesce((F.col("r") > F.col("first")) & (F.col("n") >= MATCH), F.lit(False))
    return durable(numbers.join(first, same, "left").select("id", "th", "r", copy.alias("copy")), "suffixes-ranks")


def _remaining(texts: DataFrame, ranks: DataFrame) -> DataFrame:
    """First level: (id, th, r, n, at) of the samples whose name occurs again; at: packed positions."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, int(size * len(COVER) / PERIOD) // BUCKET + 1)
    named = texts.mapInArrow(_name_samples(buckets, BATCH), _ROWS)
    compared = durable(named.groupBy("bucket").applyInArrow(_compare_names, _ROWS), "suffixes-names")
    repeated, table = (compared.filter(F.col("kind") == k).select("batch", "n", "a") for k in (_REPEATED, _TABLE))
    found = (repeated.groupBy("batch").cogroup(table.groupBy("batch")).applyInArrow(_by_text, "id long, th long, n long, at binary")
             .groupBy("id", "th").agg(F.sum("n").alias("n"), F.collect_list("at").alias("at")))
    return durable(_joined(found, ranks.filter(~F.col("copy")).drop("copy")), "suffixes-samples")


def repeated_passages(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, th, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row; th is a hash of the
    whole text, spans are start and end bytes in turn. A string starts earlier in a text with a
    smaller id (null ids come last, and equal ids are told apart by th) or nearer to the start of
    the same text. Ids are whole numbers. Null texts are empty; texts under ``MATCH`` bytes keep
    everything. Rows with equal id and text are one text listed several times, so neither copy
    precedes the other.
    """
    bounded_batches(docs.sparkSession)
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    texts = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.xxhash64(whole).alias("th"), whole.alias("text"))
    ranks = _ranks(texts)
    remaining = _remaining(texts, ranks)
    left = remaining.agg(F.sum("n")).first()[0] or 0
    few, many = left // BUCKET + 1, 16 * left // BUCKET + 1
    lists = ", ".join(["r long", *[f"{c} binary" for c in _LISTS]])
    wide = _joined(texts, remaining.select("id", "th", "r", "at")).mapInArrow(_wide_names(few, few, BATCH), _PLACED)
    places = wide.groupBy("bucket").applyInArrow(_compare_places(few, few, True), _PLACED).groupBy("r").applyInArrow(_by_text_rank, lists)
    places = durable(places, "suffixes-places")
    wanted = places.filter("lefts is not null or rights is not null").join(ranks.drop("copy"), "r")
    strings = _joined(texts, wanted).mapInArrow(_strings(many, many, BATCH), _PLACED)
    singles = strings.groupBy("bucket").applyInArrow(_compare_places(many, many, False), _PLACED).groupBy("r").applyInArrow(_by_text_rank, lists)
    none = F.lit(None).cast("binary")
    found = (places.filter("laters is not null").select("r", "laters", none.alias("starts"))
             .union(singles.select("r", none, F.col("laters").alias("starts")))
             .union(ranks.filter("copy").select("r", none, none))
             .groupBy("r").agg(F.collect_list("laters").alias("laters"), F.collect_list("starts").alias("starts"))
             .join(ranks, "r").drop("r"))
    return _joined(texts, found, "left").mapInArrow(
        _cut, "id long, th long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: what is left of every whole text of ``documents``."""
    found = repeated_passages(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
