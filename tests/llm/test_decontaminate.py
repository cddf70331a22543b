import random

from contrail.llm import decontaminate as D

DOCS = "doc_id long, text string, source string, item_id string"
ITEMS = "item_id long, text string, extra long"


def words(text):
    return (text or "").encode().lower().split()


def brute(docs, items):
    out = []
    for d, text, *_ in docs:
        for i, item, *_ in items:
            ws = words(item)
            if ws:
                k = min(5, len(ws))
                own = D.shingles(ws, k)
                n = len(own & D.shingles(words(text), k))
                if n >= 0.8 * len(own) - 1e-9:
                    out.append((d, i, len(own), n))
    return sorted(out, key=str)


def data():
    r = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(r.choices(vocab, k=r.choice([1, 3, 4, 5, 6, 9, 15, 40, 90]))), 0) for i in range(60)]
    items += [(60, None, 1), (61, "  \n", 1), (None, "alpha beta gamma delta eps zeta", 1), (62, items[5][1], 2)]
    docs = [(1, None, "a", "x"), (2, "", "a", "x"), (None, "Alpha BETA\ngamma delta eps zeta", None, None)]
    for d in range(120):
        ws = r.choices(vocab, k=r.choice([0, 3, 50, 400]))
        for _ in range(r.choice([0, 1, 2])):
            item = r.choice(items)[1] or ""
            part = item.split()
            if part and r.random() < 0.5:
                part[r.randrange(len(part))] = "changed"
            ws[len(ws) // 2 : len(ws) // 2] = part
        docs.append((10 + d, "  ".join(ws), "s", "y"))
    docs.append((10, docs[-1][1], "s", "y"))
    docs.append((999, "fill " * 100000 + (items[9][1] or "") + " é" * 1000, "s", "y"))
    return docs, items


def test_against_brute_force(spark):
    docs, items = data()
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    want = brute(docs, items)
    got = D.contained_items(d.select("doc_id", "text"), i)
    assert sorted(((x[0], x[1], x[2], x[3]) for x in got.collect()), key=str) == want
    again = D.contained_items(d.select("doc_id", "text"), i, block=200)
    assert sorted(((x[0], x[1], x[2], x[3]) for x in again.collect()), key=str) == want
    for block in (200, 10**6):
        clean = D.decontaminate(d, i, block)
        assert clean.columns == d.columns
        assert sorted((x["doc_id"] for x in clean.collect()), key=str) == sorted((x[0] for x in docs if not brute([x], items)), key=str)


def test_sketch_holds_a_shared_shingle():
    for n in range(1, 300):
        missing = n - -(-8 * n // 10)  # most that a holder may lack
        assert D.sketch_size(n) > missing or D.sketch_size(n) == n


def test_empty(spark):
    none, some = spark.createDataFrame([], ITEMS), spark.createDataFrame([(1, "a b c d e f", 1)], ITEMS)
    docs = spark.createDataFrame([(1, "a b c d e f", "s", "y")], DOCS)
    assert D.contained_items(docs.select("doc_id", "text"), none).count() == 0
    assert D.contained_items(docs.limit(0).select("doc_id", "text"), some).count() == 0
    assert D.decontaminate(docs, some).count() == 0
