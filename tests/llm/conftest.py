"""Small tables with the awkward rows every operator must survive."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

WORDS = "the of and to in on is that".split() * 8 + [a + b + c for a in ("am", "ber", "cor", "dun", "el") for b in ("a", "ith", "on", "u") for c in (
    "dal", "fen", "gar", "hol", "ket", "lis", "mar", "nor")]


def prose(seed, n, words=WORDS):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(words) + rnd.choice(["", "", "", ",", "."]) for _ in range(n))


def write(path, docs, labels=(), benchmark=(), extra=None, conversations=(), embeddings=()):
    """documents (doc_id, text, lang, source, n_chars, then ``extra``), labels, benchmark,
    conversations (conv_id, turn, role, text, then ``extra``) and embeddings (the same)."""
    path.mkdir(parents=True, exist_ok=True)
    ids, texts, langs = ([r[k] for r in docs] for k in range(3))
    table = {"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()), "lang": pa.array(langs, pa.string()),
             "source": pa.array(["s"] * len(ids), pa.string()), "n_chars": pa.array([len(t or "") for t in texts], pa.int64())}
    table |= {k: pa.array(v * len(ids), pa.string()) for k, v in (extra or {}).items()}
    pq.write_table(pa.table(table), path / "documents.parquet")
    pq.write_table(pa.table({"doc_id": pa.array([r[0] for r in labels], pa.int64()), "quality": pa.array([1] * len(labels), pa.int64()),
                             "toxic": pa.array([r[1] for r in labels], pa.int64())}), path / "labels.parquet")
    pq.write_table(pa.table({"item_id": pa.array([r[0] for r in benchmark], pa.int64()),
                             "text": pa.array([r[1] for r in benchmark], pa.string())}), path / "benchmark.parquet")
    ids, turns, roles, texts = ([r[k] for r in conversations] for k in range(4))
    table = {"conv_id": pa.array(ids, pa.int64()), "turn": pa.array(turns, pa.int64()), "role": pa.array(roles, pa.string()), "text": pa.array(texts, pa.string())}
    table |= {k: pa.array(v * len(ids), pa.string()) for k, v in (extra or {}).items()}
    pq.write_table(pa.table(table), path / "conversations.parquet")
    ids, vectors = ([r[k] for r in embeddings] for k in range(2))
    table = {"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32())), "label": pa.array([0] * len(ids), pa.int32())}
    table |= {k: pa.array(v * len(ids), pa.string()) for k, v in (extra or {}).items()}
    pq.write_table(pa.table(table), path / "embeddings.parquet")
    return str(path)


@pytest.fixture(scope="session")
def empty_dir(tmp_path_factory):
    return write(tmp_path_factory.mktemp("empty"), [])


EDGE_TEXTS = [
    None, "", " \t\n", "\n\n\n", "a", "Héé ß 漢字 \U0001f600 x", "one two three four five six", "one two three FOUR five six",
    "one two three four five\n\none two three four five\n", "x" * 50_000, "9 " * 3_000 + "9", "a.b@" * 500, "1.2.3." * 400, "+1 (" * 300,
    "mail: joe.q+x@mail.example.co.uk, host 10.0.0.255 or 300.1.1.1, card 4111-1111-1111-1111 and 4111 1111 1111 1112, call +44 (20) 7946-0958.",
    "konto DE89 3704 0044 0532 0130 00 bank account 123456789 \x01 GB82WEST12345698765432", "@@a@b.c@d.e f@g.h_i@j.k +1-2345678-9+12 3456789012",
    "Same words\r\nagain and again and again and again\x0b#*$%&|<>\x0c!", prose(1, 300), prose(1, 300), prose(1, 300) + " tail", prose(2, 4_000),
]


NAN, INF = float("nan"), float("inf")
#: Null, empty, ragged and non-finite vectors, null and repeated ids, repeated vectors.
EDGE_VECTORS = [(1, None), (2, []), (3, [1.0, None, 0.5]), (4, [NAN, 1.0, 0.5]), (5, [INF, 1.0, 0.5]), (6, [1.0, 2.0]), (7, [0.1, -0.2, 0.3]), (8, [0.1, -0.2, 0.3]),
                (8, [0.1, -0.2, 0.3]), (None, [0.5, 0.25, -0.125]), (9, [-3.0, 2.0, 7.5]), (10, [100.0, 0.0, 3.0]), (11, [0.0, 0.0, 0.0])]


def turns(seed, n, conversations):
    """Random turns: short texts that repeat, lack their end or are blank, odd and null roles."""
    rnd = random.Random(seed)
    return [(rnd.choice(conversations), rnd.choice([None, *range(12)]), rnd.choice(["user", "assistant", "system", "tool", None, "User"] + ["user", "assistant"] * 4),
             rnd.choice(["Yes.", "No!", "why?", "cut off", " \t", "", None, "Very well. ", "x" * 300, "Hé 漢."])) for _ in range(n)]


@pytest.fixture(scope="session")
def edge_dir(tmp_path_factory):
    """Distinct ids, one null id, repeated texts, null languages, clashing and extra columns."""
    docs = [(i, t, [None, "en", "fr"][i % 3]) for i, t in enumerate(EDGE_TEXTS)] + [(None, EDGE_TEXTS[6], None)]
    return write(tmp_path_factory.mktemp("edge"), docs, [(0, 1), (1, 0), (2, None), (None, 1), (18, 1), (18, 0), (20, 0), (77, 1)],
                 [(1, prose(2, 4_000)[500:800]), (2, None), (3, ""), (None, "few words"), (5, prose(3, 200))],
                 {"th": ["x"], "id": ["y"], "score": ["z"], "words": ["w"], "__id": ["v"], "__th": ["u"], "conv": ["t"], "kind": ["s"], "x": ["r"], "n": ["q"], "v": ["p"]},
                 turns(4, 400, [None, *range(40)]), EDGE_VECTORS)


@pytest.fixture(scope="session")
def repeated_dir(tmp_path_factory):
    """Equal rows, and different texts under one id."""
    docs = [(1, prose(5, 120), "en")] * 3 + [(1, prose(6, 120), "en"), (2, prose(5, 120), None), (None, prose(6, 120), "en"), (None, None, None), (None, None, None)]
    return write(tmp_path_factory.mktemp("repeated"), docs, [(1, 0), (1, 1), (2, 0)], [(1, prose(6, 120)[:250])] * 2,
                 conversations=[(1, 0, "user", "Yes.")] * 5 + [(1, 1, "user", "Yes.")] * 3 + [(None, None, None, None)] * 4, embeddings=[(1, [0.5, 0.25])] * 4)
