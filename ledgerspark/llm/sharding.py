"""Shards of equal row counts that keep linked documents together: balanced label propagation.

Linked are documents with equal texts. A class of copies is never expanded into pairs: what its
members say to each other is the number of members that each shard holds. In every round, the
members of a class move to the shard that holds most of them, among those with room for all of
them; a class that finds none draws a shard by its room. Classes that are still apart after the
last round, what a shard holds beyond its quota and rows without links fill what is left, class by
class, and this last step makes the counts exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, durable, numbered

SHARDS = 40
#: Rounds of moves at most; a round without a move ends the propagation.
ROUNDS = 4
#: Groups of at least 1/LARGE of a quota are seeded before the first round: LARGE per shard at most.
LARGE = 64
_GROUP = ["th", "crc", "part"]


def quotas(rows: int, shards: int) -> list[int]:
    """Row counts that differ by one at most and sum up to ``rows``."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _of_shard(values: list, shard: str = "shard") -> Column:
    """The entry of ``values`` for the row's shard."""
    return F.element_at(F.array(*map(F.lit, values)), F.col(shard) + 1)


def _drawn(room: list[int], seed: Column) -> Column:
    """A shard, drawn in proportion to its room."""
    until = [sum(room[:k + 1]) for k in range(len(room))]
    at = F.pmod(seed, F.lit(max(1, until[-1])))
    return F.least(F.size(F.filter(F.array(*map(F.lit, until)), lambda u: u <= at)), F.lit(len(room) - 1)).cast("int")


def _apart() -> Column:
    """What deals rows out for numbering: small groups stay together, large ones do not."""
    return F.when(F.col("n") > 10_000, F.xxhash64("salt", *_GROUP)).otherwise(F.xxhash64(*_GROUP))


def _groups(marked: DataFrame, quota: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """(linked, single): rows whose text occurs again, with the ``part`` of their class that is to
    stay together and its size, and the others. A class beyond a quota is cut into parts of it."""
    sizes = marked.groupBy("th", "crc").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = durable(sizes.select(F.col("th").alias("__t"), F.col("crc").alias("__c"), "n"), "sharding-classes")
    same = (F.col("th") == F.col("__t")) & (F.col("crc") == F.col("__c"))
    single = marked.join(sizes, same, "left_anti")
    linked = marked.join(sizes, same).drop("__t", "__c")
    small = linked.filter(F.col("n") <= quota).withColumn("part", F.lit(0).cast("long"))
    hot = linked.filter(F.col("n") > quota)
    hot = numbered(hot, ["th", "crc"], ["doc_id", "salt"], "rank", spread=F.xxhash64("salt"), rows=rows)
    hot = (hot.withColumn("part", F.floor(F.col("rank") / quota))
           .withColumn("n", F.least(F.lit(quota).cast("long"), F.col("n") - F.col("part") * quota)).drop("rank"))
    return small.unionByName(hot), single


def _seeds(linked: DataFrame, quota: list[int]) -> tuple[DataFrame | None, list[int]]:
    """A shard for each large group, largest first into the emptiest shard with room for it, and the
    room that is left. The large groups number at most LARGE per shard, whatever the input."""
    least = max(2, max(quota) // LARGE)
    large = linked.filter(F.col("n") >= least).select(*_GROUP, "n").distinct().orderBy(F.desc("n"), *_GROUP).collect()
    free, chosen = list(quota), []
    for g in large:
        shard = max(range(len(free)), key=lambda s: (free[s], -s))
        if free[shard] >= g["n"]:
            free[shard] -= g["n"]
            chosen.append((g["th"], g["crc"], g["part"], shard))
    if not chosen:
        return None, free
    return linked.sparkSession.createDataFrame(chosen, "__t long, __c long, __p long, seed int"), free


def _propagate(linked: DataFrame, quota: list[int], rounds: int) -> DataFrame:
    """Labels after ``rounds`` rounds at most: column ``shard`` of the linked rows, null for the
    groups that are still apart."""
    on = (F.col("th") == F.col("__t")) & (F.col("crc") == F.col("__c")) & (F.col("part") == F.col("__p"))
    keys = [F.col(c).alias(k) for c, k in zip(_GROUP, ("__t", "__c", "__p"))]
    seeds, free = _seeds(linked, quota)
    start = _drawn(free, F.xxhash64("salt", "th"))
    state = linked.withColumn("shard", start) if seeds is None else (
        linked.join(seeds, on, "left").withColumn("shard", F.coalesce("seed", start)).drop("__t", "__c", "__p", "seed"))
    for turn in range(rounds):
        state = durable(state, "sharding-round")
        held = state.groupBy(*_GROUP, "shard").agg(F.count(F.lit(1)).alias("here"))
        held = held.groupBy(*_GROUP).agg(F.sum("here").alias("all"), F.collect_list(F.struct("here", "shard")).alias("at"))
        held = durable(held, "sharding-held")
        whole = {r["shard"]: r["n"] for r in held.groupBy(F.when(F.size("at") == 1, F.col("at")[0]["shard"]).alias("shard")).agg(
            F.sum("all").alias("n")).collect()}
        if None not in whole:
            break
        room = [max(0, q - whole.get(s, 0)) for s, q in enumerate(quota)]
        fits = F.filter("at", lambda x: F.element_at(F.array(*map(F.lit, room)), x["shard"] + 1) >= F.col("all"))
        best = F.array_max(F.transform(fits, lambda x: F.struct(x["here"], F.xxhash64(*_GROUP, x["shard"], F.lit(turn)), x["shard"].alias("shard"))))
        goal = held.filter(F.size("at") > 1).select(*_GROUP, "all", F.coalesce(
            best["shard"], _drawn(room, F.xxhash64(F.lit(turn), *_GROUP))).alias("goal"))
        goal = durable(goal.filter(F.col("all") <= _of_shard(room, "goal")), "sharding-goals")
        asked = {r["goal"]: r["n"] for r in goal.groupBy("goal").agg(F.sum("all").alias("n")).collect()}
        # The share of the movers that the room admits; whole groups are drawn by their hash.
        share = [min(1.0, r / asked[s]) if s in asked else 0.0 for s, r in enumerate(room)]
        draw = F.pmod(F.xxhash64(*_GROUP, F.lit(turn)), F.lit(1 << 20)) / float(1 << 20)
        moves = goal.filter(draw < _of_shard(share, "goal")).select(*keys, "goal")
        if turn == rounds - 1:
            moves = held.filter(F.size("at") > 1).join(moves, on, "left").select(*keys, F.coalesce("goal", F.lit(-1)).alias("goal"))
        elif not asked:
            continue
        state = state.join(moves, on, "left").withColumn("shard", F.coalesce("goal", "shard")).drop("__t", "__c", "__p", "goal")
    return durable(state.withColumn("shard", F.when(F.col("shard") >= 0, F.col("shard"))), "sharding-labels")


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row; the shards' row counts differ by one at
    most and slots run from 0 without gaps in each.

    Null texts count as empty: size 16, checksum 0, linked with other empty ones. Null ids and
    repeated rows are rows like any others. An empty table gives an empty result.
    """
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    marked = durable(docs.select(F.col(f"`{id_column}`").alias("doc_id"), (F.octet_length(whole) + 16).cast("long").alias("size"),
                                 F.crc32(F.encode(whole, "UTF-8")).cast("long").alias("crc"), F.xxhash64(whole).alias("th"),
                                 F.monotonically_increasing_id().alias("salt")), "sharding-rows")
    rows = marked.count()
    quota = quotas(rows, shards)
    linked, single = _groups(marked, max(1, quota[-1]), rows)
    state = _propagate(durable(linked, "sharding-linked"), quota, rounds)
    # Exact counts: a shard keeps the first quota of its linked rows, group by group.
    ranked = durable(numbered(state.filter("shard is not null"), ["shard"], [*_GROUP, "doc_id", "salt"], "slot", spread=_apart(), rows=rows), "sharding-ranked")
    held = {r["shard"]: r["n"] for r in ranked.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    stay = [min(q, held.get(s, 0)) for s, q in enumerate(quota)]
    keeps = F.col("slot") < _of_shard(quota)
    columns = ["doc_id", "size", "crc"]
    dealt = [*columns, "th", "part", "n", "salt"]
    alone = single.select(*columns, "th", F.lit(0).cast("long").alias("part"), F.lit(1).cast("long").alias("n"), "salt")
    rest = alone.union(state.filter("shard is null").select(*dealt)).union(ranked.filter(~keeps).select(*dealt)).withColumn("all", F.lit(0))
    rest = numbered(rest, ["all"], [*_GROUP, "doc_id", "salt"], "at", spread=_apart(), rows=rows)
    # The i-th free place: the first shard whose free places, summed up to it, exceed i.
    free = [q - s for q, s in zip(quota, stay)]
    until = [sum(free[:k + 1]) for k in range(shards)]
    place = F.size(F.filter(F.array(*map(F.lit, until)), lambda u: u <= F.col("at")))
    rest = rest.withColumn("shard", place.cast("int")).withColumn(
        "slot", F.col("at") - _of_shard([u - f for u, f in zip(until, free)]) + _of_shard(stay))
    out = ranked.filter(keeps).select(*columns, "shard", "slot").union(rest.select(*columns, "shard", "slot"))
    return out.select(F.col("doc_id").alias(id_column), "size", F.col("crc").alias("text_crc32"), "shard", F.col("slot").cast("long").alias("slot"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: all ``documents`` in shards 0 to 39 under the law ``rows``."""
    return shard(documents(spark, sf_dir)).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                                  F.lit(None).cast("int").alias("grown_shard"))
