"""Conversation structure repair by alignment to every feasible length of the grammar string.

A sound conversation reads ``(s?(ua)+)?`` in the first letters of its roles. Its turns are aligned
(Wagner-Fischer) with the grammar string of each length: keep 0, rerole 3, delete 4, insert 3, and 3
more for a truncated turn that stays. The cheapest cost so far bounds the diagonals that can still
matter (Ukkonen) and the lengths worth a try. Where costs tie, the backtraced audits are compared:
the string of edit letters that is least in ASCII wins. The length of what is left fixes its roles,
so an audit says all.

Any conversation may be long. Turns are dealt by ranges of (conversation, turn), so a task holds a
range and no conversation has to fit in one. Stretches of ``BLOCK`` turns are aligned from each state
of the grammar to each other one, without inserts behind the last turn; then no audit of a stretch
is a prefix of another one, and the least (cost, audit) of stretches joins to the least of the whole,
in any grouping. Tasks finish the conversations inside their range; only those at its edges (two a
range) meet again, as one row for each range. Their repaired texts are hashed as a stream, as a
digest of one string must be.

Cases with a defined result: null roles and texts are one space; null conversation ids are one
conversation. Rows of one turn come by role, then by SHA-256 of the text. Equal rows are counted,
not carried. An empty role has no place in the grammar. A conversation without rows after damage has
zeros, an empty audit and the hash of the empty string; an empty table gives no rows. Texts of any
length are hashed whole. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, durable

#: Costs of the edits, and of a truncated turn that stays.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: Turns aligned at once.
BLOCK = 16
#: Bytes and rows of a range, about.
RANGE_BYTES, RANGE_ROWS = 32 << 20, 200_000
_BLANKS = " \t\n\x0b\f\r"
_FAR = 1 << 60
# States of the grammar: nothing yet, behind the system turn, behind a user turn, behind a pair.
_START, _SYSTEM, _USER, _PAIR = range(4)
_LEGAL = ("su", "ua", "au")
_ROLES = {"u": "user", "a": "assistant"}
Best = tuple[int, str]


# --- alignment ----------------------------------------------------------------------------------
def _alternating(first: str, n: int) -> str:
    return ((first + ("a" if first == "u" else "u")) * (n // 2 + 1))[:n]


def _end(start: int, target: str) -> int:
    if target.endswith("s"):
        return _SYSTEM
    return {"": start, "u": _USER, "a": _PAIR}[target[-1:]]


def _bound(diagonal: int) -> int:
    """The least cost of moving to a diagonal: inserts above, deletions below."""
    return INSERT * diagonal if diagonal > 0 else -DELETE * diagonal


def align(turns: str, target: str, limit: int, tail: bool) -> Best | None:
    """The least (cost, audit) of turning ``turns`` into ``target``, or None beyond ``limit``.

    A turn is the first letter of its role (``o`` for all others), in upper case if it is truncated,
    ``x`` if it must go. ``tail``: inserts may follow the last turn.
    """
    n, m = len(turns), len(target)
    last = m - n
    if _bound(last) > limit:
        return None
    low, high = min(0, last), max(0, last)
    while low > -n and _bound(low - 1) + _bound(last - low + 1) <= limit:
        low -= 1
    while high < m and _bound(high + 1) + _bound(last - high - 1) <= limit:
        high += 1
    cost = [[_FAR] * (m + 2) for _ in range(n + 2)]
    for i in range(n, -1, -1):
        here, below = cost[i], cost[i + 1]
        turn = turns[i].lower() if i < n else ""
        stays = TRUNCATED if i < n and turns[i].isupper() else 0
        for j in range(min(m, i + high), max(0, i + low) - 1, -1):
            best = 0 if i == n and j == m else _FAR
            if i < n:
                best = DELETE + below[j]
                if j < m and turn != "x":
                    if turn == target[j]:
                        best = min(best, stays + below[j + 1])
                    elif target[j] != "s":
                        best = min(best, REROLE + stays + below[j + 1])
            if j < m and target[j] != "s" and (tail or i < n):
                best = min(best, INSERT + here[j + 1])
            here[j] = best
    if cost[0][0] > limit:
        return None
    # Backtrace: of the edits that keep the cost, the one whose letter is least.
    i, j, audit = 0, 0, []
    while i < n or j < m:
        left = cost[i][j]
        if i < n and left == DELETE + cost[i + 1][j]:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and (tail or i < n) and left == INSERT + cost[i][j + 1]:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turns[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return cost[0][0], "".join(audit)


def _targets(turns: str, start: int) -> Iterator[tuple[int, str]]:
    """(least cost, target) of every feasible length, without end, by falling promise."""
    forced = turns.count("x")
    room, n = len(turns) - forced, 0
    families = [("", "u"), ("s", "u")] if start == _START else [("", "a" if start == _USER else "u")]
    while True:
        for length in ({room} if n == 0 else {room - n, room + n}):
            for head, first in families:
                if length >= len(head) and (not head or "s" in turns.lower()):
                    yield DELETE * forced + _bound(length - room), head + _alternating(first, length - len(head))
        n += 1


def stretch(turns: str, start: int) -> dict[int, Best]:
    """From ``start``, the least (cost, audit) to every state that these turns can reach, without
    inserts behind the last one."""
    best: dict[int, Best] = {}
    can = {_USER, _PAIR} | ({start} if start != _USER else set()) | ({_SYSTEM} if start == _START and "s" in turns.lower() else set())
    for least, target in _targets(turns, start):
        # The lengths nearest to the turns come first: deletions cost more than inserts, so behind
        # this one every length costs at least INSERT for each step away.
        away = abs(len(target) - (len(turns) - turns.count("x")))
        if can <= set(best) and INSERT * away + DELETE * turns.count("x") > max(c for c, _ in best.values()):
            return best
        end = _end(start, target)
        limit = best[end][0] if end in best else (DELETE + INSERT + TRUNCATED) * (len(turns) + len(target) + 1)
        if least <= limit:
            found = align(turns, target, limit, False)
            if found and (end not in best or found < best[end]):
                best[end] = found


def whole(turns: str) -> Best:
    """The least (cost, audit) that makes sound what these turns are."""
    best = (DELETE * len(turns), "D" * len(turns))
    for least, target in _targets(turns, _START):
        away = abs(len(target) - (len(turns) - turns.count("x")))
        if INSERT * away + DELETE * turns.count("x") > best[0]:
            return best
        if _end(_START, target) in (_START, _PAIR) and least <= best[0]:
            found = align(turns, target, best[0], True)
            if found and found < best:
                best = found


Table = list[dict[int, Best]]
_UNIT: Table = [{s: (0, "")} for s in range(4)]


def joined(tables: list[Table]) -> Table:
    """Stretches one behind the other, pairwise, so that no audit is copied too often."""
    if not tables:
        return _UNIT
    while len(tables) > 1:
        tables = [_join(tables[k], tables[k + 1]) if k + 1 < len(tables) else tables[k] for k in range(0, len(tables), 2)]
    return tables[0]


def _join(one: Table, two: Table) -> Table:
    out: Table = []
    for start in range(4):
        best: dict[int, Best] = {}
        costs: dict[int, int] = {}
        for middle, (cost, _) in one[start].items():
            for end, (more, _) in two[middle].items():
                costs[end] = min(costs.get(end, _FAR), cost + more)
        for middle, (cost, audit) in one[start].items():
            for end, (more, rest) in two[middle].items():
                if cost + more == costs[end] and (end not in best or audit + rest < best[end][1]):
                    best[end] = (cost + more, audit + rest)
        out.append(best)
    return out


def closed(table: Table) -> Best:
    """The least (cost, audit) of a whole conversation from the table of all its turns."""
    rest = {_START: "", _SYSTEM: "II", _USER: "I", _PAIR: ""}
    return min((cost + INSERT * len(rest[end]), audit + rest[end]) for end, (cost, audit) in table[_START].items())


class Aligner:
    """Alignments of one task; conversations of the same letters are aligned once."""

    def __init__(self, block: int) -> None:
        self.block, self.known = block, {}

    def _once(self, key: tuple, make) -> object:
        if key not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[key] = make()
        return self.known[key]

    def table(self, turns: str) -> Table:
        parts = (turns[k:k + self.block] for k in range(0, len(turns), self.block))
        return joined([self._once((p,), lambda p=p: [stretch(p, s) for s in range(4)]) for p in parts])

    def best(self, turns: str) -> Best:
        if len(turns) > self.block:
            return closed(self.table(turns))
        return self._once((turns, True), lambda: whole(turns))


class _Digest:
    """SHA-256 of the repaired conversation, turn by turn."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.out, self.hash = audit, 0, 0, hashlib.sha256()
        # The number of turns fixes their roles: with an odd one the first is the system's.
        self.shift = (len(audit) - audit.count("D")) % 2

    def _put(self, role: str, text: str) -> None:
        self.hash.update(("\n" if self.out else "").encode() + role.encode() + b":" + text.encode())
        self.out += 1

    def _role(self) -> str:
        return _ROLES["ua"[(self.out - self.shift) % 2]]

    def turn(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._put(role if edit == "K" else self._role(), text)

    def skip(self, n: int) -> None:
        """Turns that must go."""
        for _ in range(n):
            self.inserts()
            self.at += 1

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self._put(self._role(), "")

    def result(self) -> str:
        self.inserts()
        return self.hash.hexdigest()


# --- rows ---------------------------------------------------------------------------------------
class _Segment:
    """What a task has of one conversation."""

    def __init__(self, keep: bool) -> None:
        self.turns, self.rows = [], [] if keep else None
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.low = self.high = self.first_turn = self.last_turn = None
        self.first = self.last = ""
        self.any = False

    def add(self, turn, role: str, text: str, copies: int, blank: bool, truncated: bool, later: bool) -> None:
        letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
        if not self.any:
            self.first, self.first_turn, self.any = letter, turn, True
        elif self.last + letter not in _LEGAL:
            self.illegal += 1
        self.illegal += copies - 1
        if turn is not None and (self.last_turn is None or turn != self.last_turn):
            self.distinct += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        self.last, self.last_turn = letter, turn
        gone = copies if blank or later else copies - 1
        self.blank += copies if blank else 0
        self.duplicate += 0 if blank else gone
        if gone < copies:
            self.truncated += truncated
            self.turns.append(letter.upper() if truncated else letter)
        self.turns.append("x" * gone)
        if self.rows is not None:
            self.rows.append((role, text, gone < copies, gone))


_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_HEAD = ["gaps", *_COUNTS, "cost"]
_EDGE = ["distinct", "low", "high", "first_turn", "last_turn", "first", "last", "any", "part", "costs", "audits"]
_TYPES = {"audit": "string", "repaired_sha256": "string", "first": "string", "last": "string", "any": "boolean", "edge": "boolean",
          "part": "int", "costs": "array<long>", "audits": "array<string>"}
_ARROW = {"string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "array<long>": pa.list_(pa.int64()),
          "array<string>": pa.list_(pa.string())}
_DONE = [*_HEAD, "audit", "repaired_sha256"]


def _ddl(conv: str, columns: list[str]) -> str:
    return ", ".join([f"conv {conv}", *[f"{c} {_TYPES.get(c, 'long')}" for c in columns]])


def _schema(conv: pa.DataType, columns: list[str]) -> pa.Schema:
    return pa.schema([("conv", conv), *[(c, _ARROW[_TYPES.get(c, "long")]) for c in columns]])


def _gaps(low: int | None, high: int | None, distinct: int) -> int:
    return 0 if low is None else high - low + 1 - distinct


def _faults(text: Column) -> list[Column]:
    """(is_blank, is_cut)."""
    bare = F.rtrim(text, F.lit(_BLANKS))
    return [(bare == "").alias("is_blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("is_cut")]


def damaged(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, kind, turn, role, text, copies) after the contract's damage. A dropped row leaves a
    mark of its conversation (kind 0) behind."""
    none = F.lit(" ")
    conv, at = F.col(f"`{conversation}`"), F.col(f"`{turn}`").cast("long")
    name = F.concat(F.coalesce(conv.cast("string"), none), F.lit(":"), F.coalesce(at.cast("string"), none))
    known = rows.select(conv.alias("conv"), at.alias("turn"), (F.crc32(name) % 20).alias("d"),
                        *[F.coalesce(F.col(f"`{c}`").cast("string"), none).alias(n) for c, n in ((role, "role"), (text, "text"))])
    stays = F.col("d") != 0
    text_ = F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return known.select("conv", stays.cast("int").alias("kind"), F.when(stays, F.col("turn")).alias("turn"),
                        F.when(~stays, "").when(F.col("d") == 4, "user").otherwise(F.col("role")).alias("role"),
                        F.when(~stays, "").otherwise(text_).alias("text"),
                        F.when(~stays, 0).when(F.col("d") == 3, 2).otherwise(1).cast("long").alias("copies"))


_ORDER = ["conv", "kind", "turn", "role", "digest"]


def _stream(block: int):
    """Per range: a finished row for each conversation inside it, a table for the first and last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, part = Aligner(block), TaskContext.get().partitionId()
        out, held, first, conv, segment, marked = [], 0, True, None, None, None

        def finished(segment: _Segment, edge: bool) -> dict:
            row = {c: int(getattr(segment, c)) for c in _COUNTS} | {"conv": conv, "edge": edge}
            turns = "".join(segment.turns)
            if edge:
                table = aligner.table(turns)
                cells = [table[k // 4].get(k % 4) for k in range(16)]
                return row | {c: getattr(segment, c) for c in _EDGE[:8]} | {
                    "part": part, "costs": [c[0] if c else None for c in cells], "audits": [c[1] if c else None for c in cells]}
            cost, audit = aligner.best(turns)
            digest = _Digest(audit)
            for role, text, one, gone in segment.rows:
                if one:
                    digest.turn(role, text)
                digest.skip(gone)
            return row | {"gaps": _gaps(segment.low, segment.high, segment.distinct), "cost": cost, "audit": audit, "repaired_sha256": digest.result()}

        for batch in batches:
            schema = _schema(batch.schema.field("conv").type, ["edge", *_DONE, *_EDGE])
            columns = [batch.column(c).to_pylist() for c in ("conv", "kind", "turn", "role", "text", "copies", "is_blank", "is_cut", "digest")]
            for at, is_row, turn, role, text, copies, blank, truncated, digest in zip(*columns):
                if segment is None or at != conv:
                    if segment is not None:
                        out.append(finished(segment, first))
                        held += 1 + len(out[-1].get("audit") or "") // 100
                        first = False
                        if held >= 1_000:
                            yield pa.RecordBatch.from_pylist(out, schema)
                            out, held = [], 0
                    conv, segment, marked = at, _Segment(not first), None
                if not is_row:
                    continue
                if copies == 0:  # a mark: the row behind it repeats an earlier turn
                    marked = (turn, role, digest)
                    continue
                segment.add(turn, role, text, copies, blank, truncated, marked == (turn, role, digest))
        if segment is not None:
            out.append(finished(segment, True))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _meet(group: pa.Table) -> pa.Table:
    """The ranges of one conversation, in order."""
    rows = sorted(group.to_pylist(), key=lambda r: r["part"])
    out = {"conv": rows[0]["conv"]} | {c: sum(r[c] for r in rows) for c in _COUNTS}
    held = [r for r in rows if r["any"]]
    distinct = sum(r["distinct"] for r in held)
    for a, b in zip(held, held[1:]):
        out["illegal"] += a["last"] + b["first"] not in _LEGAL
        distinct -= b["first_turn"] is not None and a["last_turn"] == b["first_turn"]
    tables = [[{e: (r["costs"][4 * s + e], r["audits"][4 * s + e]) for e in range(4) if r["costs"][4 * s + e] is not None} for s in range(4)] for r in held]
    low, high = (pick((r[c] for r in held if r[c] is not None), default=None) for pick, c in ((min, "low"), (max, "high")))
    cost, audit = closed(joined(tables))
    out |= {"gaps": _gaps(low, high, distinct), "cost": cost, "audit": audit}
    return pa.Table.from_pylist([out], _schema(group.schema.field("conv").type, [*_HEAD, "audit"]))


def _hash_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations one behind the other: a head with the audit, then the turns in order."""
    head, digest, marked = None, None, None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["kind"] < 0:
                if head:
                    out.append(head | {"repaired_sha256": digest.result()})
                head, digest, marked = {c: row[c] for c in ("conv", *_HEAD)} | {"audit": row["text"]}, _Digest(row["text"]), None
            elif row["kind"] == 0:
                continue
            elif row["copies"] == 0:
                marked = (row["turn"], row["role"], row["digest"])
            else:
                gone = row["copies"] if row["is_blank"] or marked == (row["turn"], row["role"], row["digest"]) else row["copies"] - 1
                if gone < row["copies"]:
                    digest.turn(row["role"], row["text"])
                digest.skip(gone)
        if out:
            yield pa.RecordBatch.from_pylist(out, _schema(batch.schema.field("conv").type, _DONE))
    if head:
        yield pa.RecordBatch.from_pylist([head | {"repaired_sha256": digest.result()}], _schema(batch.schema.field("conv").type, _DONE))


def repair(turns: DataFrame, block: int = BLOCK, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every
    conversation in ``turns`` (conv, kind, turn, role, text, copies; see ``damaged``)."""
    spark = turns.sparkSession
    bounded_batches(spark)
    kind = turns.schema["conv"].dataType.simpleString()
    digest = F.unhex(F.sha2("text", 256))
    rows = turns.groupBy("conv", "kind", "turn", "role", digest.alias("digest"), "text").agg(F.sum("copies").alias("copies"))
    rows = durable(rows.select("*", *_faults(F.col("text")), F.octet_length("text").alias("size")), "conversations-turns")
    total = rows.agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).first()
    ranges = max(1, -(-(total.b or 0) // RANGE_BYTES), -(-total.n // range_rows))
    # Turns that say again what the conversation has: a mark goes before them, without the text.
    light = rows.filter("kind = 1 and not is_blank").select("conv", "turn", "role", "digest")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = light.groupBy("conv", "role", "digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    again = again.select(F.col("conv").alias("__conv"), F.col("role").alias("__role"), F.col("digest").alias("__digest"), "first")
    same = F.col("conv").eqNullSafe(F.col("__conv")) & (F.col("role") == F.col("__role")) & (F.col("digest") == F.col("__digest"))
    marks = light.join(again, same).filter(place > F.col("first")).select(
        "conv", F.lit(1).alias("kind"), "turn", "role", "digest", F.lit("").alias("text"), F.lit(0).cast("long").alias("copies"),
        F.lit(False).alias("is_blank"), F.lit(False).alias("is_cut"))
    rows = durable(rows.drop("size").unionByName(marks), "conversations-marked")
    dealt = rows.repartitionByRange(ranges, *_ORDER).sortWithinPartitions(*_ORDER, "copies")
    found = durable(dealt.mapInArrow(_stream(block), _ddl(kind, ["edge", *_DONE, *_EDGE])), "conversations-ranges")
    met = durable(found.filter("edge").select("conv", *_COUNTS, *_EDGE).groupBy("conv").applyInArrow(_meet, _ddl(kind, [*_HEAD, "audit"])), "conversations-met")
    # The edges of ranges are few; their turns come again for the digest.
    heads = met.select("conv", F.lit(-1).alias("kind"), F.col("audit").alias("text"), *_HEAD)
    behind = rows.join(met.select(F.col("conv").alias("__conv")), F.col("conv").eqNullSafe(F.col("__conv")), "left_semi")
    ordered = (heads.unionByName(behind, allowMissingColumns=True).repartition("conv")
               .sortWithinPartitions(*_ORDER, "copies"))
    hashed = ordered.mapInArrow(_hash_stream, _ddl(kind, _DONE))
    return found.filter("not edge").select("conv", *_DONE).unionByName(hashed)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: damage and repair of every conversation of ``conversations``."""
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    return repair(damaged(rows)).withColumnRenamed("conv", "conv_id")


def oracle_sql() -> str:
    """The same in DuckDB: states of the grammar turn by turn instead of alignments (rows of one
    turn, role and text apart must be equal)."""
    step = "list_reduce(range(8), lambda x, i: if(x % 2 = 1, xor(x // 2, 3988292384), x // 2), xor(c, b))"
    moves = [(s, ins, e) for s, more in ((_START, ((0, ""), (2, "I"), (3, "II"))), (_SYSTEM, ((1, ""), (2, "I"), (3, "II"))),
                                         (_USER, ((2, ""), (3, "I"), (2, "II"))), (_PAIR, ((3, ""), (2, "I"), (3, "II")))) for e, ins in more]
    values = ", ".join(f"({s}, '{ins}', {e})" for s, ins, e in moves)
    reach = f"(values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) as e(via, letter, after)"
    blank = r"[ \t\n\x0B\f\r]"
    return rf"""with recursive named as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name from conversations),
      hit as (select *, xor(list_reduce(list_transform(string_split(name, ''), lambda ch: unicode(ch)::bigint), lambda c, b: {step}, 4294967295::bigint),
        4294967295) % 20 as d from named),
      hurt as (select conv_id, turn, if(d = 4, 'user', role) as role, case d when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
        unnest(range(if(d = 3, 2, 1))) as copy from hit where d <> 0),
      ordered as (select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as i from hurt),
      faults as (select *, left(role, 1) as letter, regexp_replace(text, '{blank}+$', '') as bare,
        row_number() over (partition by conv_id, role, text order by i) > 1 as later,
        lag(left(role, 1)) over (partition by conv_id order by i) as before from ordered),
      turns as (select *, bare = '' as blank, bare <> '' and later as duplicate, bare <> '' and not later and right(bare, 1) not in ('.', '!', '?') as truncated from faults),
      counts as (select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank, count(*) filter (duplicate) as duplicate,
        count(*) filter (truncated) as truncated, count(*) filter (i > 1 and before || letter not in ('su', 'ua', 'au')) as illegal from turns group by conv_id),
      inserts as (from (values {values}) as m(state, ins, via)),
      edits as (select state, via, ins, ins || 'D' as edits, 3 * length(ins) + 4 as cost, via as after, null as keep from inserts
        union all select state, via, ins, ins || 'K', 3 * length(ins), after, letter from inserts join {reach} using (via)
        union all select state, via, ins, ins || 'R', 3 * length(ins) + 3, after, '' from inserts join {reach} using (via) where letter <> 's'),
      walk as (select conv_id, 0 as i, 0 as state, {{'c': 0::bigint, 'a': ''}} as best from counts
        union all select w.conv_id, (w.i + 1)::int, e.after, min({{'c': w.best.c + e.cost + if(e.keep is not null and t.truncated, 3, 0), 'a': w.best.a || e.edits}})
        from walk w join turns t on t.conv_id is not distinct from w.conv_id and t.i = w.i + 1 join edits e on e.state = w.state
          and (e.keep is null or (not t.blank and not t.duplicate and (e.keep = '' or e.keep = t.letter))) group by 1, 2, 3),
      ends as (select c.conv_id, min({{'c': w.best.c + [0, 6, 3, 0][w.state + 1], 'a': w.best.a || ['', 'II', 'I', ''][w.state + 1]}}) as best
        from counts c join walk w on w.conv_id is not distinct from c.conv_id and w.i = c.n group by c.conv_id),
      letters as (select conv_id, best.a as audit, unnest(range(1, length(best.a) + 1)) as k from ends),
      marks as (select conv_id, k, audit[k] as e, length(regexp_replace(audit[1:k], 'I', '', 'g')) as i, length(regexp_replace(audit[1:k], 'D', '', 'g')) as o,
        length(regexp_replace(audit, 'D', '', 'g')) % 2 as odd from letters),
      built as (select m.conv_id, sha256(string_agg(case when e = 'K' then t.role when (o - odd) % 2 = 1 then 'user' else 'assistant' end || ':' || if(e = 'I', '', t.text), chr(10) order by k)) as h
        from marks m left join turns t on t.conv_id is not distinct from m.conv_id and t.i = m.i where e <> 'D' group by m.conv_id)
      select a.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
        coalesce(illegal, 0) as illegal, coalesce(best.c, 0) as cost, coalesce(best.a, '') as audit, coalesce(h, sha256('')) as repaired_sha256
      from (select distinct conv_id from conversations) a left join counts c on c.conv_id is not distinct from a.conv_id
        left join ends e on e.conv_id is not distinct from a.conv_id left join built b on b.conv_id is not distinct from a.conv_id"""
