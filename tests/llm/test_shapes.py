"""Short benchmark items, results that do not depend on partitions, intermediate
tables that go, and lines whose runs repeat."""

import glob
import random

import numpy as np
import pyarrow as pa
import pytest

from conftest import prose
from ledgerspark.llm import common, decontamination, lines
from ledgerspark.llm.tokens import words


def test_short_items_match_as_they_stand(spark):
    items = [(1, "Which metal melts first?"), (2, "blue"), (3, "to be, or not"), (4, "..."), (5, None), (6, "melts first")]
    texts = [(1, "They asked: which METAL melts first, and why."), (2, "which metal first melts"), (3, "bluebell and greenblue"), (4, "a blue one"),
             (5, "to be or"), (6, "not to be or not"), (7, None), (8, "which metal melts"), (8, "first")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    found = decontamination.contaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.id, r.item_id) for r in found.collect()) == [(1, 1), (1, 6), (4, 2), (6, 3)]
    assert {(r.cosine, r.common, r.answer) for r in found.collect()} == {(1.0, 1.0, 1.0)}
    kept = decontamination.drop_contaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 5, 7, 8, 8]


def test_matches_do_not_depend_on_partitions(spark, sf_small):
    docs, bench = common.documents(spark, sf_small), decontamination.benchmark_of(spark, sf_small)
    got = [sorted((r.id, r.item_id, round(r.cosine, 4), r.common, r.answer) for r in decontamination.contaminated(docs.repartition(n), bench).collect()) for n in (2, 7)]
    assert got[0] == got[1] and got[0]


def test_a_full_block_of_passages_is_found(spark):
    """1,024 passages in one block: an item's words with every eighth one replaced, in other prose."""
    rnd = random.Random(4)
    items = [(k, prose(20_000 + k, 40)) for k in range(decontamination.QUERIES)]
    rows = []
    for k, text in items[::8]:
        w = [f"zz{rnd.randrange(999)}" if j % 8 == 5 and j < 30 else x for j, x in enumerate(text.split())]
        rows.append((k, prose(k, 60) + " " + " ".join(w) + " " + prose(k + 5_000, 60)))
    found = decontamination.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    hits = {(r.id, r.item_id) for r in found.collect()}
    assert sum((k, k) in hits for k, _ in rows) >= 0.9 * len(rows)


def test_tables_of_a_block_go_when_it_ends(spark):
    root = common.work_dir(spark) + "/ledgerspark-llm"
    with common.passing(spark):
        inner = common.durable(spark.range(5), "passing-inner")
        with common.passing(spark):
            handed = common.durable(inner.filter("id > 2"), "passing-handed", keep=True)
            common.durable(spark.range(3), "passing-lost")
        assert glob.glob(f"{root}/passing-handed-*") and not glob.glob(f"{root}/passing-lost-*")
        kept = common.durable(handed, "passing-kept", keep=True)
    assert [glob.glob(f"{root}/passing-{n}-*") != [] for n in ("inner", "handed", "kept")] == [False, False, True]
    assert [r.id for r in kept.orderBy("id").collect()] == [3, 4]
    with pytest.raises(ZeroDivisionError), common.passing(spark):
        common.durable(spark.range(1), "passing-failed")
        1 / 0
    assert not glob.glob(f"{root}/passing-failed-*")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_no_near_line_is_filtered_out(spark):
    """Edits spread evenly, so that every run of the line has one near it; lines that repeat a few
    words; a passage that a third of all lines hold."""
    rnd, rows, passage = random.Random(12), [], prose(500, 9)
    for k in range(30):
        n = rnd.choice([20, 30, 31, 45, 60, 100])
        base = prose(600 + k, n).split() if k % 3 else (passage + " " + prose(600 + k, n)).split()[:n]
        if k % 7 == 0:
            base = (["la", "li", "lo"] * n)[:n]
        for edits in (0, len(base) // 10, len(base) // 10, len(base) // 10 + 1):
            w = list(base)
            for e in range(edits):
                at = (e * len(w) // max(edits, 1) + rnd.randrange(3)) % len(w)
                w[at:at + 1] = rnd.choice([[], [f"q{rnd.randrange(99)}"], [w[at], f"z{rnd.randrange(99)}"]])
            rows.append((len(rows), " ".join(w)))
    lists = [t.split() for _, t in rows]
    want = {i for i, w in enumerate(lists) if any(w == v or distance(w, v) <= max(max(len(w), len(v)) // 10, 1) for v in lists[:i])}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r.doc_id for r in lines.dedup_lines(df).collect()} == set(range(len(rows))) - want
    assert 30 < len(want) < len(rows) - 30


def test_sequence_hashes_tell_order():
    h = words(pa.array(["one two three two one"])).hashes
    two = decontamination._sequence(h, 2)
    assert len(set(two.tolist())) == 4 and len(decontamination._sequence(h, 6)) == 0


@pytest.mark.parametrize("dense", [decontamination._DENSE, 1_000])
def test_all_passages_shape_the_space(spark, monkeypatch, dense):
    """The space of 3,000 documents against the same steps in numpy over every passage of every one;
    pairs of a vocabulary that a task sums up, and of one that leaves it batch by batch."""
    monkeypatch.setattr(decontamination, "_DENSE", dense)
    rnd = random.Random(8)
    pool = [f"w{k}" for k in range(400)]
    pick = lambda n: " ".join(pool[int(400 * rnd.random() ** 2)] for _ in range(n))
    texts, items = [pick(rnd.choice([0, 3, 30, 64, 65, 150])) for _ in range(3_000)] + [None], [(k, pick(40)) for k in range(20)]
    q, s = decontamination.queries(items, 8), decontamination.Settings(rank=16, extra=4)
    table = tuple(decontamination.make_table(q.vocabulary))
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    got = decontamination.latent_space(docs, q, table, s)

    size, known = len(q.vocabulary), {int(h): k for k, h in enumerate(q.vocabulary)}
    rows, seen = [], np.zeros(size)
    for t in texts:
        at = [known.get(int(h), -1) for h in words(pa.array([t or ""])).hashes]
        for w in {a for a in at if a >= 0}:
            seen[w] += 1
        rows += [np.bincount([a for a in at[k:k + 64] if a >= 0], minlength=size) for k in range(0, len(at), 64)]
    weight = np.log((len(texts) + 1) / (seen + 1)).astype(np.float32) + np.float32(1e-3)
    every, own = np.array(rows, dtype=float), np.array([np.bincount(x, minlength=size) for x in q.words], dtype=float)
    square = lambda x: np.outer(weight, weight) * (x.T @ x) / (x.sum(axis=0) * weight.astype(float) ** 2).sum()
    whole, width = square(every) + square(own), s.rank + s.extra
    basis = np.linalg.qr(np.random.default_rng(5).standard_normal((size, width)))[0]
    for _ in range(s.power + 1):
        y = whole @ basis
        small, before, basis = basis.T @ y, basis, np.linalg.qr(y)[0]
    values, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(values)[::-1][:s.rank]
    want = before @ turn[:, order] / np.sqrt(np.maximum(values[order], 0) + s.damping * values.max()) * weight[:, None]
    want, got = want @ want.T, got.astype(float) @ got.T.astype(float)
    assert np.abs(want - got).max() < 1e-3 * np.abs(want).max()


def test_a_crowd_with_one_passage_meets_in_short_runs(spark):
    """More lines than ``CROWD`` hold one passage. Lines near each other are found by brute force's
    measure; lines that differ elsewhere leave no short run by which they could meet."""
    rnd, passage, rows = random.Random(3), [f"p{k}" for k in range(40)], []
    own = lambda n: [f"o{rnd.randrange(10 ** 6)}" for _ in range(n)]
    for k in range(70):
        rows.append(own(rnd.choice([3, 4, 20])) + passage)
        if k % 5 == 0:
            w = list(rows[-1])
            for at in rnd.sample(range(len(w)), len(w) // 10 + (k % 2)):
                w[at] = f"x{k}"
            rows.append(w)
    want = {i for i, w in enumerate(rows) if any(distance(w, v) <= max(len(w), len(v)) // 10 for v in rows[:i])}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string").repartition(4)
    assert {r.doc_id for r in lines.dedup_lines(df).collect()} == set(range(len(rows))) - want and len(want) > 30
    apart = spark.createDataFrame([(k, 60, own(20) + passage) for k in range(200)], "k long, n int, words array<string>")
    with common.passing(spark):
        keys = lines._rare_runs(apart, lines.SHORT)
    assert keys.count() == 0


def test_few_words_of_its_own_set_a_line_apart_from_its_crowd(spark):
    """Lines of 46 common words and 14 of their own, more than the edits allowed but not twice as many,
    hand out nothing by which the crowd could meet. Edits of every sort, up to the bound and one
    more, are judged as by brute force, lines that repeat their words included."""
    rnd, passage, rows = random.Random(5), [f"p{k}" for k in range(46)], []
    own = lambda n: [rnd.choice(["the", "of", f"o{rnd.randrange(10 ** 6)}", f"o{rnd.randrange(10 ** 6)}"]) for _ in range(n)]
    for k in range(80):
        rows.append(own(rnd.choice([4, 9, 14])) + passage + ["on", "he"] * rnd.choice([0, 0, 15]))
        if k % 4 == 0:
            w = list(rows[-1])
            for at in sorted(rnd.sample(range(len(w)), len(w) // 10 + (k // 4) % 2), reverse=True):
                w[at:at + 1] = rnd.choice([[], [f"x{k}"], [w[at], f"x{k}"], ["p3"]])
            rows.append(w)
    want = {i for i, w in enumerate(rows) if any(distance(w, v) <= max(len(w), len(v)) // 10 for v in rows[:i])}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string").repartition(4)
    assert {r.doc_id for r in lines.dedup_lines(df).collect()} == set(range(len(rows))) - want
    assert 10 < len(want) < len(rows) - 10
    apart = spark.createDataFrame([(k, 60, [f"o{k}-{i}" for i in range(14)] + passage) for k in range(100)], "k long, n int, words array<string>")
    with common.passing(spark):
        keys = lines._rare_runs(apart, lines.SHORT)
    assert keys.count() == 0
