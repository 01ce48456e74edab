"""Operators over pairs of texts against brute force: 2, 3, 6 and 7."""

import hashlib
import random

import numpy as np
import xxhash

from conftest import prose
from ledgerspark.llm import common, decontamination, lines, simhash, suffixes


def test_components_against_union(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)] + [(7, k) for k in range(500, 600)]
    root = {n: n for e in edges for n in e}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = dict(tuple(r) for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect())
    for n in root:
        assert got.get(n, n) == find(n)


def test_numbering_has_no_gaps(spark):
    df = spark.createDataFrame([(k % 3 if k % 7 else None, k // 2) for k in range(500)], "g int, v long")
    rows = common.numbered(df, ["g"], ["v"], "n", per_part=20).collect()
    for g in {r.g for r in rows}:
        mine = sorted(r.n for r in rows if r.g == g)
        assert mine == list(range(len(mine)))


def test_cover_leads_any_two_positions_to_samples():
    cover = set(suffixes.COVER)
    for a in range(suffixes.PERIOD):
        for b in range(suffixes.PERIOD):
            assert any((a + s) % suffixes.PERIOD in cover and (b + s) % suffixes.PERIOD in cover for s in range(suffixes.PERIOD))


def repeated(rows):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 99):
            if b[k:k + 100] in seen:
                gone[k:k + 100] = b"\1" * 100
            else:
                seen.add(b[k:k + 100])
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def test_repeated_passages(spark, sf_small, monkeypatch):
    monkeypatch.setattr(suffixes, "BATCH", 3_000)
    monkeypatch.setattr(suffixes, "BUCKET", 2_000)
    rnd = random.Random(1)
    for alphabet in ("abcdefgh ", "abé"):
        seeds = ["".join(rnd.choice(alphabet) for _ in range(rnd.choice((60, 99, 100, 101, 130, 156, 157, 200, 400)))) for _ in range(12)]
        noise = lambda: "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(80)))
        rows = [(i, "".join(rnd.choice([rnd.choice(seeds), rnd.choice(seeds)[rnd.randrange(40):], noise()]) for _ in range(rnd.randrange(6))))
                for i in range(120)] + [(200, None), (201, ""), (None, seeds[-1])]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = [(r.id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.repeated_passages(df).collect()]
        assert sorted(got, key=str) == repeated(rows)
    rows = [(r.doc_id, r.text) for r in common.documents(spark, sf_small).collect()]
    got = [tuple(r) for r in suffixes.query(spark, sf_small).collect()]
    assert sorted(got, key=str) == repeated(rows)


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_fingerprint():
    for text in (None, "", " \n", "One", "a B", "a b c", "x y z x y z x y z", "É é Z z", prose(4, 90), "\x1c a\x85b c d"):
        assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_linked_fingerprints(spark, monkeypatch):
    """All pairs of a set with many near ones, in tiles so small that cells are cut."""
    rnd = random.Random(9)
    base = [rnd.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1]
    fps = {b ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randrange(4))) for b in base for _ in range(8)}
    fps = sorted(fps)
    a = np.array(fps, dtype=np.uint64)
    root = list(range(len(fps)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for k in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[k]) <= 2):
            x, y = find(k), find(int(j))
            root[max(x, y)] = min(x, y)
    signed = a.view(np.int64).tolist()
    links = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), tile=3)
    got = dict(tuple(r) for r in common.components(links).collect())
    classes = {}
    for k, f in enumerate(signed):
        classes.setdefault(find(k), set()).add(got.get(f, f))
    assert all(len(c) == 1 for c in classes.values()) and len({c for v in classes.values() for c in v}) == len(classes)


def test_near_duplicates_on_the_given_tables(spark, sf_small):
    rows = simhash.query(spark, sf_small).collect()
    texts = {r.doc_id: r.text for r in common.documents(spark, sf_small).collect()}
    assert all(int(r.fingerprint, 16) == plain_fingerprint(texts[r.doc_id]) and len(r.fingerprint) == 16 for r in rows)
    first = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        assert r.component_id <= first.setdefault(r.fingerprint, r.doc_id)


def test_one_row_of_each_group_stays(spark):
    same, other = prose(1, 60), prose(2, 60)
    rows = [(3, same), (2, same), (2, same), (None, same), (None, other), (None, other), (None, "lone words here"), (9, None), (8, "")]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [(2, same), (None, other), (None, "lone words here"), (8, "")]))


def test_lines_of_the_example(spark):
    rows = [(1, "alpha beta gamma delta epsilon\nshort line\n\nunique words of the first text here"),
            (2, "alpha beta GAMMA delta epsilon\nshort line"),           # one word replaced; equal
            (3, "alpha beta gamma delta epsilon zeta\nshort lines"),     # one word more; too short for an edit
            (4, "beta gamma delta epsilon"),                             # one word less: four of five words
            (5, "alpha beta gamma epsilon delta"),                       # two words changed
            (6, " alpha  beta\tgamma delta epsilon "), (7, None), (8, ""), (9, " \n ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    gone = {(r.id, r.line) for r in lines.judged_lines(df).filter("removed").collect()}
    assert gone == {(2, 0), (2, 1), (3, 0), (4, 0), (6, 0)}
    out = {r.doc_id: r.text for r in lines.dedup_lines(df).collect()}
    assert out == {1: rows[0][1], 3: "short lines", 5: rows[4][1], 7: None, 8: "", 9: " \n "}


def word_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_lines_within_a_tenth_of_their_words(spark):
    """All pairs by brute force: edits around the bound, long repeats, one passage in many lines."""
    rnd, rows = random.Random(9), [(0, "9 " * 60), (1, "9 " * 57)]
    passage = prose(77, 12)
    for k in range(16):
        base = (passage + " " + prose(100 + k, rnd.choice([10, 18, 40]))).split() if k % 3 == 0 else prose(100 + k, rnd.choice([18, 20, 29, 50, 90])).split()
        for edits in (0, 1, 2, len(base) // 10, len(base) // 10 + 1):
            words = list(base)
            for _ in range(edits):
                at = rnd.randrange(len(words))
                words[at:at + 1] = rnd.choice([[], ["qqq"], [words[at], "zz"]])
            rows.append((len(rows), " ".join(words)))
    lists = [t.split() for _, t in rows]
    want = {i for i, w in enumerate(lists) if any(
        w == v or word_distance(w, v) <= max(max(len(w), len(v)) // 10, 1) for v in lists[:i])}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in lines.dedup_lines(df).collect()} == set(range(len(rows))) - want


def test_benchmark_passages(spark, sf_small):
    """Whole items in long texts, and items with every sixth word replaced, are found; texts
    without any are not."""
    items = [(r.item_id, r.text) for r in decontamination.benchmark_of(spark, sf_small).collect()]
    clean = [r.text for r in common.documents(spark, sf_small).orderBy("doc_id").limit(150).collect()]
    rnd, rows, truth = random.Random(2), [], set()
    held = {(r.doc_id) for r in decontamination.query(spark, sf_small).collect()}
    for k, (item, text) in enumerate(items):
        words = text.split()
        if len(words) < 16:
            continue
        altered = [f"qx{rnd.randrange(9999)}" if j % 6 == 3 and j < len(words) - 8 else w for j, w in enumerate(words)]
        for n, part in enumerate((words, altered)):
            host = clean[(2 * k + n) % 100].split()
            at = rnd.randrange(len(host) + 1)
            rows.append((10_000 + 2 * k + n, " ".join(host[:at] + part + host[at:])))
            truth.add((10_000 + 2 * k + n, item))
    rows += list(enumerate(clean))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.id, r.item_id) for r in decontamination.contaminated(df, decontamination.benchmark_of(spark, sf_small)).collect()}
    assert len(found & truth) >= 0.95 * len(truth), sorted(truth - found)
    assert {d for d, _ in found if d < 10_000} <= held and len(held) < 0.1 * len(clean)


def test_candidates_reach_brute_force_recall(spark, sf_small):
    """The latent index against the exact check on every passage: 0.9 of its matches at least."""
    docs, bench = common.documents(spark, sf_small), decontamination.benchmark_of(spark, sf_small)
    every = decontamination.contaminated(docs, bench, s=decontamination.Settings(cosine=-2.0))
    some = decontamination.contaminated(docs, bench)
    want = {(r.id, r.item_id) for r in every.collect()}
    assert len(want & {(r.id, r.item_id) for r in some.collect()}) >= 0.9 * len(want)
