"""op11 against plain enumeration, and against itself with ranges and stretches of every size."""

import hashlib
import random
import zlib

import pytest

from conftest import turns
from ledgerspark.llm import conversations as C


def plain(letters):
    """Least (cost, audit) by trying all edits turn by turn, at most two inserts at a place."""
    states = {0: (0, "")}
    reach = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def put(out, state, found):
        if state not in out or found < out[state]:
            out[state] = found

    def inserted(states):
        out = dict(states)
        for _ in range(2):
            for state, (cost, audit) in list(out.items()):
                for letter in "ua":
                    if (state, letter) in reach:
                        put(out, reach[state, letter], (cost + 3, audit + "I"))
        return out

    for letter in letters:
        after = {}
        for state, (cost, audit) in inserted(states).items():
            put(after, state, (cost + 4, audit + "D"))
            if letter != "x":
                more = 3 if letter.isupper() else 0
                for to in "sua":
                    if (state, to) in reach and (to == letter.lower() or to != "s"):
                        same = to == letter.lower()
                        put(after, reach[state, to], (cost + more + (0 if same else 3), audit + ("K" if same else "R")))
        states = after
    return min(found for state, found in inserted(states).items() if state in (0, 3))


def random_letters(rnd, n):
    return "".join(rnd.choice("uauauasoxUASO") for _ in range(n))


def test_alignment_finds_the_least_audit():
    rnd = random.Random(1)
    for k in range(1_500):
        letters = random_letters(rnd, k % 12)
        assert C.whole(letters) == plain(letters), letters


@pytest.mark.parametrize("block", [1, 2, 3, 7])
def test_stretches_join_to_the_whole(block):
    rnd = random.Random(block)
    for k in range(300):
        letters = random_letters(rnd, k % 17)
        assert C.closed(C.Aligner(block).table(letters)) == plain(letters), letters


def expected(rows):
    """The contract, row by row."""
    per = {}
    for conv, turn, role, text in rows:
        mine = per.setdefault(conv, [])
        role, text = role if role is not None else " ", text if text is not None else " "
        damage = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if damage == 1 else text.translate({ord(c): None for c in ".!?"}) if damage == 2 else text
        mine.extend([] if damage == 0 else [(turn, "user" if damage == 4 else role, text)] * (2 if damage == 3 else 1))
    for conv, mine in per.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        known = [t for t, _, _ in mine if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        counts, letters, seen = {"blank": 0, "duplicate": 0, "truncated": 0}, "", set()
        for _, role, text in mine:
            bare = text.rstrip(" \t\n\x0b\f\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            letters += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit = plain(letters)
        left, out, odd = iter(mine), [], (len(audit) - audit.count("D")) % 2
        for edit in audit:
            row = next(left) if edit != "I" else None
            role = "ua"[(len(out) - odd) % 2]
            if edit != "D":
                out.append((row[1] if edit == "K" else {"u": "user", "a": "assistant"}[role]) + ":" + (row[2] if row else ""))
        yield (conv, gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def got(spark, rows, **options):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    found = C.repair(C.damaged(df), **options)
    return sorted((tuple(r) for r in found.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"block": 2, "range_rows": 9}])
def test_repair_row_by_row(spark, options):
    rows = turns(8, 300, [None, *range(30)]) + turns(9, 150, [77])  # one conversation with a third of all rows
    assert got(spark, rows, **options) == sorted(expected(rows), key=str)


def test_equal_rows_of_one_turn_do_not_travel(spark):
    rows = [(5, 3, "user", "Same.")] * 500 + [(5, 4, "assistant", "Fine.")] + turns(10, 60, [1, 2])
    assert got(spark, rows) == sorted(expected(rows), key=str)
