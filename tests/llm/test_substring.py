import hashlib
import random

import numpy as np

from contrail.llm import substring as S
from contrail.llm import textarrays as A
from contrail.llm.common import Stages

SCHEMA = "doc_id long, text string, th long, gram string"


def brute(docs):
    rows, owner = [(d, (t or "").encode().split()) for d, t, *_ in docs], {}
    for d, ws in rows:
        if d is not None:
            for i in range(len(ws) - 12):
                w = tuple(ws[i : i + 13])
                owner[w] = min(owner.get(w, d), d)
    out = []
    for d, ws in rows:
        gone = set()
        for i in range(len(ws) - 12):
            if d is not None and owner[tuple(ws[i : i + 13])] < d:
                gone |= set(range(i, i + 13))
        kept = b" ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((d, len(ws), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def fixture(n=150, seed=9):
    r = random.Random(seed)
    vocab = ["a", "b", "c", "é", "the", "of"] + [f"w{i}" for i in range(400)]
    passages = [r.choices(vocab, k=r.choice([12, 13, 14, 40, 200])) for _ in range(8)]
    docs = [(1, None, 1, "g"), (2, "", 1, "g"), (None, " ".join(passages[3]), 1, None), (4, "x " * 40, 1, "g"), (5, "x " * 41, 1, "g"), (5, "x " * 41, 1, "g"), (5, "y " * 41 + "x " * 20, 1, "g")]
    for i in range(n):
        ws = r.choices(vocab, k=r.choice([3, 20, 80, 300]))
        for _ in range(r.choice([0, 1, 2])):
            p, at = r.choice(passages), r.randrange(len(ws))
            cut = r.randrange(len(p))
            ws[at:at] = r.choice([p, p[cut:], p[:cut]])
        docs.append((r.choice([10 + i, 10 + i, 12]), r.choice([" ", "\n", " \t"]).join(ws), 1, "g"))
    docs += [(1000 + i, docs[20 + i][1], 1, "g") for i in range(20)]
    docs.append((-7, " ".join(r.choices(vocab, k=30000)) + " " + " ".join(passages[4]), 1, "g"))
    return docs


def test_against_brute_force(spark):
    docs = fixture()
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    got = sorted(map(tuple, S.op2_query(df).collect()), key=str)
    assert got == brute(docs)
    for batches in (1, 5):
        again = S.dedup(df, batches).select("doc_id", "n_removed").collect()
        assert sorted(map(tuple, again), key=str) == sorted(((d, n) for d, _, n, _ in brute(docs)), key=str)


def test_a_context_that_stands_twice_in_its_first_document(spark):
    w = [f"w{i}" for i in range(60)]
    twice = " ".join(["a", *w, "b", "c", "a", *w, "b", "d"])
    docs = [(1, " ".join(["x", *w[:30], "y"]), 1, "g"), (5, twice, 1, "g"), (5, " ".join(["a", *w, "b"]), 1, "g"), (6, twice, 1, "g")]
    assert sorted(map(tuple, S.op2_query(spark.createDataFrame(docs, SCHEMA)).collect()), key=str) == brute(docs)


def test_index_compacts_and_remembers(spark):
    index = S.FingerprintIndex(Stages(spark), 2)
    batch = lambda rows: spark.createDataFrame(rows, "gram long, doc_id long")
    assert index.ingest(batch([(1, 1), (2, 1), (2, 1), (3, 2)])).collect() == []
    assert sorted(x[0] for x in index.ingest(batch([(2, 5), (7, 6), (7, 8)])).collect()) == [2, 7]
    assert len(index.runs) == 1 and sorted(map(tuple, index.runs[0][1].collect())) == [(1, 1, 1), (2, 1, 5), (3, 2, 2), (7, 6, 8)]
    assert sorted(x[0] for x in index.ingest(batch([(3, 9), (9, 9)])).collect()) == [3]


def _signs(n):
    """A sequence of a and b whose swapped copy has the same polynomial hash modulo 2**64 under any odd base."""
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_built_collisions_remove_nothing(spark):
    """Two words, and two passages, that rolling hashes modulo 2**64 can't tell apart."""
    head, x = " ".join(f"w{i}" for i in range(12)), _signs(1024)
    y = x.translate(str.maketrans("ab", "ba"))
    docs = [(1, f"{head} {x}", 1, "g"), (2, f"{head} {y}", 1, "g"), (3, " ".join(x), 1, "g"), (4, " ".join(y), 1, "g")]
    got = sorted(map(tuple, S.op2_query(spark.createDataFrame(docs, SCHEMA)).collect()), key=str)
    assert got == brute(docs) and [g[2] for g in got[:2]] == [0, 0]


def test_places_past_a_block(monkeypatch):
    """Minimizers of a text of many blocks are those of one block; their places lie in their windows."""
    rng = np.random.default_rng(4)
    grams, valid, windows = rng.integers(0, 2**63, 5000, dtype=np.uint64), np.ones(5000, bool), np.arange(4992)
    whole = A.minimizers(grams, valid, windows, 9)
    monkeypatch.setattr(A, "BLOCK", 64)
    assert (A.minimizers(grams, valid, windows, 9) == whole).all() and (whole >= windows).all() and (whole < windows + 9).all()


def test_places_past_24_bits():
    n = (1 << 24) + 3000
    grams = A.mixed(np.arange(n, dtype=np.uint64))
    windows = np.arange(n - 2000, n - 8)
    got = A.minimizers(grams, np.ones(n, bool), windows, 9)
    assert ((got >= windows) & (got < windows + 9)).all()
    assert (grams[got] >> np.uint64(24) == [(grams[w : w + 9] >> np.uint64(24)).min() for w in windows]).all()


def test_empty(spark):
    assert S.op2_query(spark.createDataFrame([], SCHEMA)).collect() == []
    one = S.op2_query(spark.createDataFrame([(1, "few words", 1, "g")], SCHEMA)).collect()
    assert [tuple(x)[:3] for x in one] == [(1, 2, 0)]
