"""Operators over single rows, packing and sharding: 1, 4, 5, 8, 9 and 10."""

import zlib
from itertools import combinations

import numpy as np
import pytest

from conftest import prose, write
from ledgerspark.llm import common, language, packing, pii, quality, sharding, toxicity


def test_spans_of_each_kind(spark):
    text = "\U0001f600 mail a@b.co, ip 1.2.3.4 999.1.1.1 card 4111 1111 1111 1111 tel +1 (415) 555-0100 iban GB82 WEST 1234 5698 7654 32 konto 12345678 and 87654321."
    row = pii.find_pii(spark.createDataFrame([(text,)], "text string")).first()
    assert [(s.kind, s.value) for s in row.pii] == [
        ("email", "a@b.co"), ("ip", "1.2.3.4"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (415) 555-0100"),
        ("iban", "GB82 WEST 1234 5698 7654 32"), ("account", "12345678")]  # no context word beside the last number
    assert all(text[s.start:s.end] == s.value for s in row.pii)


def test_many_spans_in_one_text(spark):
    row = pii.find_pii(spark.createDataFrame([("a@b.c " * 3_000,)], "text string")).first()
    assert [(s.start, s.end) for s in row.pii] == [(6 * k, 6 * k + 5) for k in range(3_000)]


def test_boundaries_have_least_padding():
    rng = np.random.default_rng(1)
    for n, buckets in ((1, 3), (6, 2), (9, 3), (9, 4), (5, 9)):
        lengths, counts = np.sort(rng.choice(50, n, replace=False)), rng.integers(1, 20, n)
        cost = lambda ends: sum(c * (min(e for e in ends if e >= x) - x) for x, c in zip(lengths, counts))
        best = min(cost((*inner, lengths[-1])) for k in range(buckets) for inner in combinations(lengths[:-1], min(k, n - 1)))
        got = packing.boundaries(lengths, counts, buckets)
        assert cost(got) == best and len(got) <= buckets and got == sorted(set(got))


def test_batches(spark):
    rows = [(i, prose(i, i % 37)) for i in range(400)] + [(1000, prose(3, 1_000)), (1001, None), (1002, "")]
    packed = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), max_length=64, buckets=4, budget=256).collect()
    tokens = {i: len([w for w in (t or "").replace(",", " ,").replace(".", " .").split()]) for i, t in rows}
    for i, n in tokens.items():
        mine = sorted((r.seq, r.start, r.length) for r in packed if r.doc_id == i)
        assert sum(m[2] for m in mine) == n and [m[0] for m in mine] == list(range(len(mine))) and all(m[1] == 64 * m[0] for m in mine)
    batches = {}
    for r in packed:
        assert r.length <= r.bucket <= 64 and r.padding == r.bucket - r.length
        batches.setdefault((r.bucket, r.batch), []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) and b[0] * len(s) <= 256 for b, s in batches.items())
    for bucket in {b for b, _ in batches}:
        sizes = [len(batches[b, k]) for b, k in sorted(batches) if b == bucket]
        assert len(set(sizes[:-1])) <= 1 and sizes[-1] <= sizes[0]


@pytest.mark.parametrize("n", [1, 39, 40, 700])
def test_shards(spark, n):
    """A third of the rows are one text, a third are pairs; shards stay even and pairs together."""
    texts = ["hot"] * (n // 3) + [f"pair {k // 2}" for k in range(n // 3)] + [f"lone {k}" for k in range(n - 2 * (n // 3))]
    rows = list(enumerate(texts))
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in got) == list(range(n))
    sizes = [sorted(r.slot for r in got if r.shard == s) for s in range(40)]
    assert all(s == list(range(len(s))) for s in sizes) and max(map(len, sizes)) - min(map(len, sizes)) <= 1
    for r in got:
        assert r.size == len(texts[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
    if n == 700:
        where = {}
        for r in got:
            where.setdefault(texts[r.doc_id], set()).add(r.shard)
        cut = sum(len(s) > 1 for t, s in where.items() if t.startswith("pair"))
        assert cut <= 0.1 * 117 and len(where["hot"]) <= 18


def test_shards_beside_a_class_beyond_quotas(spark):
    """Pairs too small to be seeded (a quota is 300 rows), a third of all rows in one class: shards
    that the class fills take no pairs, and the others keep them whole."""
    n = 12_000
    texts = ["hot"] * (n // 3) + [f"pair {k // 2}" for k in range(n // 3)] + [f"lone {k}" for k in range(n // 3)]
    got = sharding.shard(spark.createDataFrame([(None if k % 5 == 0 else k, t) for k, t in enumerate(texts)], "doc_id long, text string")).collect()
    sizes = [sorted(r.slot for r in got if r.shard == s) for s in range(40)]
    assert all(s == list(range(300)) for s in sizes)
    shards = {}
    for r in got:
        shards.setdefault(r.text_crc32, set()).add(r.shard)
    pairs = [shards[zlib.crc32(f"pair {k}".encode())] for k in range(n // 6)]
    assert sum(len(s) > 1 for s in pairs) <= 0.02 * len(pairs)
    assert len(shards[zlib.crc32(b"hot")]) <= 15


def test_languages_of_unseen_rows(spark, sf_small):
    truth = {r.doc_id: r.lang for r in common.documents(spark, sf_small).collect()}
    rows = language.query(spark, sf_small).collect()
    unseen = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert len(unseen) > 20 and sum(r.lang_pred == truth[r.doc_id] for r in unseen) >= 0.97 * len(unseen)


def test_code_lengths():
    """The table of costs against the recursion written out."""
    text = b"abracadabra"
    padded = b"\n" * language.ORDER + text
    counts = {}
    for i in range(language.ORDER, len(padded)):
        for o in range(language.ORDER + 1):
            counts[o, padded[i - o:i + 1]] = counts.get((o, padded[i - o:i + 1]), 0) + 1
    keys = sorted(counts)
    model = language.build(["x"], np.zeros(len(keys), dtype=int), np.array([o for o, _ in keys]),
                           np.array([int.from_bytes(k, "big") for _, k in keys]), np.array([counts[k] for k in keys]))

    def bits(context, symbol):
        if context is None:
            return 8.0
        seen = {k[-1]: n for (o, k), n in counts.items() if o == len(context) and k[:-1] == context}
        shorter = context[1:] if context else None
        if not seen:
            return bits(shorter, symbol)
        total = sum(seen.values()) + len(seen)
        return -np.log2(seen[symbol] / total) if symbol in seen else -np.log2(len(seen) / total) + bits(shorter, symbol)

    other = b"\n" * language.ORDER + b"cadabraz ab"
    data = np.frombuffer(other, dtype=np.uint8)
    got = language.bits_of(model, language._keys(data, language.ORDER), language.ORDER)[language.ORDER:, 0]
    want = [bits(other[i - language.ORDER:i], other[i]) for i in range(language.ORDER, len(other))]
    assert np.allclose(got, want, atol=1e-4)


def test_no_letter_has_no_language(spark, tmp_path):
    path = write(tmp_path / "t", [(0, "hello world again", "en"), (1, None, "en"), (2, "123 !?", None), (3, "", None), (4, "bonjour le monde", "fr")])
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.query(spark, path).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and {got[0][0], got[4][0]} <= {"en", "fr"}


def test_rules_in_order_of_gain(spark, sf_small):
    docs = common.documents(spark, sf_small)
    names = [r.name for r in quality.cascade_order(docs)]
    assert sorted(names) == sorted(r.name for r in quality.RULES)
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    rows = {r.doc_id: r for r in quality.query(spark, sf_small).collect()}
    good = [i for i, q in truth.items() if q == 1 and not rows[i].base_failed]
    bad = [i for i, q in truth.items() if q == 0]
    assert sum(rows[i].kept for i in good) >= 0.98 * len(good) and sum(rows[i].kept for i in bad) <= 0.2 * len(bad)


def test_toxic_words_are_learned(spark, tmp_path):
    rows = [(i, prose(i, 40) + (" you filthy scoundrel" if i % 3 == 0 else ""), "en") for i in range(600)]
    path = write(tmp_path / "t", rows, [(i, int(i % 3 == 0)) for i in range(600)])
    got = {r.doc_id: r for r in toxicity.query(spark, path).collect()}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5)
    assert sum(r.predicted == int(i % 3 == 0) for i, r in got.items() if r.held_out) >= 0.97 * sum(r.held_out for r in got.values())
    again = {r.doc_id: r.score for r in toxicity.query(spark, path).collect()}
    assert all(abs(again[i] - r.score) < 1e-9 for i, r in got.items())
