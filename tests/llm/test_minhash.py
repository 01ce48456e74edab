"""op12 against sets of words, and its parts against their definitions."""

import random

import numpy as np
import pyarrow as pa
import pytest

from conftest import EDGE_TEXTS, prose
from ledgerspark.llm import minhash as M

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = [w.decode() for w in (text or "").translate(LOWER).encode().split()]
    if len(words) < 5:
        return {" ".join(words)} if words else set()
    return {" ".join(words[k:k + 5]) for k in range(len(words) - 4)}


def expected(rows):
    sets_, roots = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(a):
        while roots[a] != a:
            a = roots[a]
        return a
    for i, x in enumerate(sets_):
        for j in range(i):
            y = sets_[j]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                roots[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(sets_[k]), least.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def changed(text, seed, share):
    rnd, words = random.Random(seed), text.split()
    return " ".join(w if rnd.random() > share else f"w{rnd.randrange(10 ** 6)}" for w in words)


def got(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return sorted((tuple(r) for r in M.near_duplicates(df, **options).collect()), key=str)


def test_components_against_sets_of_words(spark, monkeypatch):
    base = [prose(s, 200) for s in range(6)]
    # Chains and groups around the threshold: a third of all rows near one text, others just beside it.
    rows = [(k, changed(base[0], k, 0.01)) for k in range(60)] + [(100 + k, changed(base[0], k, 0.025)) for k in range(60)]
    rows += [(300 + k, changed(base[k % 6], k, 0.015)) for k in range(40)] + [(500 + k, t) for k, t in enumerate(EDGE_TEXTS)]
    rows += [(None, base[1]), (7, base[2]), (7, base[2]), (None, None), (600, prose(9, 40)), (601, prose(9, 40) + " end")]
    random.Random(1).shuffle(rows)
    want = expected(rows)
    assert got(spark, rows) == want
    # Without leaders the last comparisons alone find the same, in tiles of any size, or without any.
    for large in (2, 10, 1_000):
        monkeypatch.setattr(M, "HOT", large)
        assert got(spark, rows, stars=0, tile=7) == want
    assert got(spark, rows, stars=2, tile=50) == want
    assert len({c for _, n, c in want if n}) > 20


def test_small_sets_link_only_as_equal(spark):
    words = "a b c d e f g h i j k l".split()
    rows = [(k, " ".join(words[:k])) for k in range(1, 13)] + [(k + 20, " ".join(words[:k]).upper()) for k in range(1, 13)]
    assert got(spark, rows) == expected(rows)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    texts = ["  " + prose(3, 3_000) + "\n", "x" * 5_000 + " " + prose(4, 50), "one two", " " * 3_000, prose(5, 4) + " " * 2_000, "y" * 4_000]
    whole = [M.sets(pa.array([t]))[0].tolist() for t in texts]
    together = M.sets(pa.array(texts))
    assert [together[0][together[1] == k].tolist() for k in range(len(texts))] == whole
    assert [len(w) for w in whole] == [len(shingles(t)) for t in texts]
    monkeypatch.setattr(M, "PIECE", 700)
    assert [M.sets(pa.array([t]))[0].tolist() for t in texts] == whole


def test_signatures_follow_the_definition(monkeypatch):
    """Rank by rank, one element at a time, without early stops."""
    rng = np.random.default_rng(2)
    elements, owner = rng.integers(0, 1 << 63, 90).astype(np.uint64), np.repeat([0, 1, 2], [1, 9, 80])
    want, m = np.full((3, 16), np.inf), 16
    for h, doc in zip(elements.tolist(), owner):
        order = list(range(m))
        for rank in range(m):
            draw = M.mix(np.array([h], dtype=np.uint64) + np.uint64((rank + 1) * int(M._STEP) % (1 << 64)))
            fraction = float((M.mix(draw, 0x2545F491)[0] >> np.uint64(11)) * 2.0 ** -53)
            pick = rank + (int(draw[0] >> np.uint64(32)) * (m - rank) >> 32)
            order[rank], order[pick] = order[pick], order[rank]
            want[doc, order[rank]] = min(want[doc, order[rank]], rank + fraction)
    monkeypatch.setattr(M, "ELEMENTS", 17)
    assert np.array_equal(M.super_minhash(elements, owner, 3, m), want)


@pytest.mark.parametrize("similarity", [0.5, 0.85])
def test_estimate_is_unbiased(similarity):
    rng = np.random.default_rng(3)
    n, both = 400, int(400 * similarity)
    errors = []
    for _ in range(40):
        h = rng.integers(0, 1 << 63, 2 * n - both).astype(np.uint64)
        one, two = M.super_minhash(h[:n], np.zeros(n, dtype=int), 1), M.super_minhash(h[n - both:], np.zeros(n, dtype=int), 1)
        errors.append((one == two).mean() - both / (2 * n - both))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.04
