import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from contrail.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, size long, target double"


def targets(sizes):
    """The rule as stated: share by weight, cut at twice the size, share the rest again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    out, open_, left = dict.fromkeys(names, 0.0), list(names), 1.5 * sum(sizes.values())
    while left > 1e-9 and open_:
        w = sum(weight[s] for s in open_)
        for s in open_:
            out[s] += left * weight[s] / w
        left = sum(max(0, out[s] - 2 * sizes[s]) for s in open_)
        open_ = [s for s in open_ if out[s] < 2 * sizes[s]]
        out = {s: min(x, 2 * sizes[s]) for s, x in out.items()}
    return out


def fixture():
    r = random.Random(15)
    docs = [(1, None, "b", 1, 1.0), (2, "", "zero", 1, 1.0), (None, "x y z " * 50, "b", 1, 1.0), (3, "a b " * 30, None, 1, 1.0), (3, "a b " * 30, None, 1, 1.0)]
    for i in range(300):
        docs.append((10 + i, "w " * r.choice([0, 1, 7, 64, 500]), r.choice(["b", "b", "b", "a", "é", "Z", "tiny" if i < 3 else "a", None]), 1, 1.0))
    return docs + [(999, "w " * 60000, "long", 1, 1.0)]


def test_mixture(spark):
    docs = fixture()
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    got = [x.asDict() | {"i": i} for i, x in enumerate(M.mix(df).taken.collect())]
    assert len(got) == len(docs) and all(x["taken"] <= 2 * x["size"] for x in got)
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, t, s, *_ in docs:
        sizes[s] += len((t or "").split())
    want = targets(sizes)
    for x in got:
        taken[x["source"]] += x["taken"]
        assert x["source_size"] == sizes[x["source"]] and abs(x["target"] - want[x["source"]]) < 1e-6 * max(1, want[x["source"]])
    assert abs(sum(want.values()) - 1.5 * sum(sizes.values())) < 1
    assert all(abs(taken[s] - want[s]) <= M.BLOCK for s in sizes)
    again = M.op10_query(spark, df.repartition(5)).collect()
    key = lambda x: (str(x["doc_id"]), x["size"], x["taken"])
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_permutation_is_one_to_one(spark):
    for n in (1, 2, 3, 64, 1000, 1000003, 4095):
        rows = spark.range(min(n, 5000)).select(M.permuted(F.col("id"), F.lit(n).cast("long"), F.lit("2:1")).alias("p"))
        got = [x["p"] for x in rows.collect()]
        assert len(set(got)) == len(got) and min(got) >= 0 and max(got) < n


def test_slots_meet_the_quotas(spark):
    m = M.mix(spark.createDataFrame(fixture(), SCHEMA), block=16, shard=64)
    quota = {x["rank"]: (x["n_slots"], x["n_blocks"]) for x in m.sources.collect()}
    slots, drawn = m.slots.collect(), defaultdict(int)
    by_rank, by_shard = defaultdict(list), defaultdict(int)
    for x in slots:
        by_rank[x["rank"]].append((x["slot"], x["block"]))
        by_shard[x["shard"]] += 1
    for x in m.counts.collect():
        drawn[x["rank"]] += x["n"]
    assert drawn != {k: v for k, (v, _) in quota.items()} and sum(drawn.values()) == len(slots)  # some draws had to move
    for rank, (n, n_blocks) in quota.items():
        assert sorted(j for j, _ in by_rank[rank]) == list(range(n))
        uses = Counter(b for _, b in by_rank[rank])
        assert not uses or max(uses.values()) <= 2 and max(uses) < n_blocks
    last = max(by_shard)
    assert all(n == 64 for k, n in by_shard.items() if k != last) and sum(by_shard.values()) == len(slots)


def test_shard_counts_vary_as_a_multinomial(spark):
    """A quarter of a thousand slots has a variance of 1024 * 0.25 * 0.75 = 192 over the shards."""
    n_all = 1 << 20
    sources = spark.createDataFrame([(1, 0, n_all // 4), (2, n_all // 4, n_all // 2), (3, 3 * n_all // 4, 0), (4, 3 * n_all // 4, n_all // 4)], "rank long, first_slot long, n_slots long")
    rows = M.draw_counts(sources, n_all, 1024).collect()
    counts = [[x["n"] for x in rows if x["rank"] == k] for k in (1, 2, 4)]
    assert [len(c) for c in counts] == [1024] * 3 and {x["rank"] for x in rows} == {1, 2, 4}
    assert all(sum(c[k] for c in [{x["shard"]: x["n"] for x in rows if x["rank"] == r} for r in (1, 2, 4)]) == 1024 for k in range(1024))
    for c, p in zip(counts, (0.25, 0.5, 0.25)):
        assert abs(np.var(c) / (1024 * p * (1 - p)) - 1) < 0.1 and abs(np.mean(c) / (1024 * p) - 1) < 0.01


def test_blocks_have_the_words_that_are_taken(spark):
    r = random.Random(2)
    docs = [(i, " ".join(f"d{i}w{k}" for k in range(r.choice([0, 1, 9, 64, 200, 1000]))), r.choice(["a", "a", "b", None]), 1, 1.0) for i in range(60)]
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    taken = {x["doc_id"]: x["taken"] for x in M.mix(df, 16, 32).taken.collect()}
    rows = M.blocks(df, 16, 32).collect()
    got, source = defaultdict(int), {d[0]: d[2] for d in docs}
    for x in rows:
        ws = x["text"].split()
        assert 0 < len(ws) <= 16
        for w in ws:
            got[int(w[1:].split("w")[0])] += 1
            assert source[int(w[1:].split("w")[0])] == x["source"]
    assert all(got[d] == t for d, t in taken.items())
    places = [(x["shard"], x["place"]) for x in rows]
    assert len(set(places)) == len(places) and max(p for _, p in places) < 32


def test_empty(spark):
    assert M.op10_query(spark, spark.createDataFrame([], SCHEMA)).collect() == []
    one = M.op10_query(spark, spark.createDataFrame([(1, None, "a", 1, 1.0)], SCHEMA)).collect()
    assert [tuple(x) for x in one] == [(1, 0, 0, 0.0, 0)]
