import hashlib
import random
from collections import Counter

import numpy as np

from contrail.llm import suffix as S

SCHEMA = "doc_id long, text string, gram long, kept string"


def brute(docs):
    texts = [(d, (t or "").encode()) for d, t, *_ in docs]
    seen = Counter(hash(b[i : i + 200]) for _, b in texts for i in range(len(b) - 199))
    out = []
    for d, b in texts:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 199):
            if seen[hash(b[i : i + 200])] > 1:
                gone[i : i + 200] = True
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def fixture(seed=10):
    r = random.Random(seed)
    text = lambda n: "".join(r.choices("abcdefgh éß😀\n", k=n))
    passages = [text(n) for n in (150, 199, 200, 230, 700, 1500)]
    docs = [(1, None, 1, "k"), (2, "", 1, "k"), (None, passages[4], 1, "k"), (3, "a" * 450, 1, "k"), (4, "a" * 199, 1, "k"), (5, "ab" * 300, 1, "k"), (6, passages[2], 1, "k"), (6, passages[2], 1, "k")]
    for i in range(90):
        t = text(r.choice([5, 150, 600, 1500]))
        for _ in range(r.choice([0, 1, 1, 3])):
            p, at = r.choice(passages), r.randrange(len(t))
            cut = r.randrange(len(p))
            t = t[:at] + r.choice([p, p, p[cut:], p[:cut], p[:cut] + "#" + p[cut:]]) + t[at:]
        docs.append((10 + i, t, 1, "k"))
    docs += [(200, text(900) * 2, 1, "k"), (201, docs[30][1], 1, "k")]
    return docs


def test_against_brute_force(spark):
    docs = fixture()
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    want = brute(docs)
    assert sum(w[2] for w in want) > 10000
    assert sorted(map(tuple, S.op6_query(df).collect()), key=str) == want
    few = S.dedup_bytes(df, crowd=2).select("doc_id", "n_bytes", "n_removed", "n_spans")
    assert sorted(map(tuple, few.collect()), key=str) == sorted((w[:4] for w in want), key=str)


def test_long_texts_in_pieces(spark):
    r = random.Random(11)
    p = "".join(r.choices("abcd", k=S.LENGTH + 300))
    long = "".join(r.choices("abcd", k=2 * S.SLICE - 250)) + p + "".join(r.choices("abcd", k=S.SLICE)) + p[:250]
    got = S.dedup_bytes(spark.createDataFrame([(1, long, 1, "k"), (2, p, 1, "k")], SCHEMA)).select("doc_id", "n_removed").collect()
    assert {x[0]: x[1] for x in got} == {1: 750, 2: 500}


def test_induced_order_against_sorting():
    r = random.Random(12)
    rows = []
    for g in range(30):
        base = bytes(r.choices(b"ab", k=400))
        for _ in range(r.choice([1, 2, 3, 9])):
            left, right = base[100 - r.randrange(100) : 100], base[100:300]
            if r.random() < 0.5:
                left = bytes(r.choices(b"ab", k=r.randrange(60))) + left[-r.randrange(1, 60) :]
            if r.random() < 0.5:
                right = right[: r.randrange(S.GRAM, 200)] + bytes(r.choices(b"cd", k=200))
            lo = r.randrange(len(left) + 1)
            rows.append((g, right[: 200 - lo], lo, left))
    rows.sort(key=lambda x: x[:2])
    got = S.induce(np.array([x[0] for x in rows]), np.array([x[2] for x in rows]), [x[3] for x in rows], [x[1] for x in rows])
    at = {}
    for i, (g, right, lo, left) in enumerate(rows):
        for o in range(lo, len(left) + 1):
            at.setdefault((g, o, left[len(left) - o :] + right[: 200 - o]), []).append((i, o))
    assert sorted(got) == sorted(x for v in at.values() if len(v) > 1 for x in v)


def test_built_collisions_remove_nothing(spark):
    """Two texts that a rolling hash modulo 2**64 can't tell apart."""
    x = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    docs = [(1, "q" * 60 + x, 1, "k"), (2, "z" * 60 + x.translate(str.maketrans("ab", "ba")), 1, "k")]
    assert sorted(map(tuple, S.op6_query(spark.createDataFrame(docs, SCHEMA)).collect())) == brute(docs)


def test_a_crowded_gram(spark):
    """Hundreds of contexts around one passage: cut by longer keys down to whole strings, nothing lost."""
    r = random.Random(3)
    text = lambda n: "".join(r.choices("ab", k=n))
    p = text(190)
    docs = [(i, text(r.choice([0, 5, 9, 180])) + p + text(r.choice([0, 4, 10, 180])), 1, "k") for i in range(250)]
    got = S.dedup_bytes(spark.createDataFrame(docs, SCHEMA), crowd=3).select("doc_id", "n_bytes", "n_removed", "n_spans").collect()
    assert sorted(map(tuple, got), key=str) == [w[:4] for w in brute(docs)]


def test_empty(spark):
    assert S.op6_query(spark.createDataFrame([], SCHEMA)).collect() == []
