import hashlib
import math
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from contrail.llm import pii
from contrail.llm.common import Stages

SCHEMA = "doc_id long, text string, key string, email string"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, m):
    d = [int(c) for c in m if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(reversed(d))) % 10 == 0
    return kind != "phone" or 9 <= len(d) <= 15


def base(text):
    return sorted((m.start(), k, m.end()) for k, kind in enumerate(BASE) for m in re.finditer(BASE[kind], text) if holds(kind, m[0]))


def term(w):
    t = w.lower().strip(pii.OUTER)
    return t if len(t) >= 3 and re.search(r"[^\W\d]", t) and "@" not in t else ""


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]


def brute(docs):
    texts, contexts, n_t = {t or "" for _, t, *_ in docs}, defaultdict(set), defaultdict(int)
    for t in texts:
        for w in {term(w) for w in split(t)}:
            n_t[w] += 1
        for kind, p in BASE.items():
            ms = [m for m in re.finditer(p, t) if holds(kind, m[0])]
            for i, m in enumerate(ms):
                left = t[ms[i - 1].end() if i else 0 : m.start()]
                right = t[m.end() : ms[i + 1].start() if i + 1 < len(ms) else None]
                contexts[kind, m[0].lower()].add((*split(left)[-8:], *split(right)[:8]))
    told = {}
    for c, found in contexts.items():
        n_tc = defaultdict(int)
        for ws in found:
            for w in {term(w) for w in ws} - {""}:
                n_tc[w] += 1
        for w, n in n_tc.items():
            if n >= 3 and n_t[w]:
                d = math.log2(len(texts) * n / (n_t[w] * len(found))) / math.log2(len(texts) / len(found))
                if d >= 0.9:
                    told[w] = max(told.get(w, 0), d)
    out = []
    for d, t, *_ in docs:
        t = t or ""
        spans = base(t)
        names = [(m.start(), 4, m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", t) if term(m[0]) in told and not any(a < m.end() and b > m.start() for a, _, b in spans)]
        text = lambda ss: ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in ss)
        out.append((d, *(sum(k == x for _, k, _ in spans) for x in range(4)), hashlib.sha256(text(spans).encode()).hexdigest(), text(sorted(spans + names))))
    return sorted(out, key=str), told


def test_against_brute_force(spark):
    r = random.Random(6)
    vocab = [f"{a}{b}" for a in ("ka", "lo", "mi", "été", "ßu", "t😀") for b in ("ran", "tel", "vos", "dim", "pex,")]
    odd = [
        "a@b.c%d@e.f x@y@z.com ...@q.r a@b", "1.2.3.4.5.6.7.8 300.1.1.1 000001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111",
        "+1 (555) 123-4567 x +12 +1234567890123456789", "1" * 5000, "a." * 4000 + "@x.y", "@" * 50, "12345678901237", "a@b" + ".c" * 9000,
    ]
    docs = [(1, None, "k", "e"), (2, "", "k", "e"), (None, odd[0], "k", None), (3, odd[2], "k", "e"), (3, odd[2], "k", "e")]
    docs += [(10 + i, o, "k", "e") for i, o in enumerate(odd)]
    for i in range(200):
        ws = r.choices(vocab, k=r.choice([5, 30, 80]))
        if i % 6 == 0:
            ws = r.choices(vocab, k=60)
            at = r.randrange(20, 50)
            ws[at:at] = ["zarkona", "zar.kona@mail.example"]
        if i == 1:
            ws.insert(1, '"Zarkona",')
        ws.insert(2, r.choice(odd[:6]))
        docs.append((100 + i, r.choice([" ", "\n", " \t"]).join(ws), "k", "e"))
    want, told = brute(docs)
    assert "zarkona" in told
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    assert sorted(map(tuple, pii.op1_query(df).collect()), key=str) == want
    clean = {x["doc_id"]: x for x in pii.sanitise(df).collect() if x["doc_id"] and x["doc_id"] >= 100}
    assert pii.sanitise(df).columns == df.columns
    assert not any("zarkona" in x["text"].lower() or "zar.kona" in x["text"] for x in clean.values())


def test_context_is_words_of_the_whole_text(spark):
    """Neither long white space, long words nor matches that fail their test end a context."""
    sides = [
        ("zarkona" + " " * 400, ""), ("", "\n" * 500 + "zarkona"), ("zarkona " + "x" * 900 + " ", ""), ("zarkona in 2024 and 2025, ", ""),
        ("", " from 10-20 to 30 40 zarkona"), ("", " x1,22,33,44,55,66,77,88,99,11,22,33 zarkona"), ("\uffff zarkona ", ""),
    ]
    docs = [(i, f"w{i}: {a}4111 1111 1111 1111{b} v{i}", "k", "e") for i, (a, b) in enumerate(sides)]
    docs += [(100 + i, f"other words number {i}", "k", "e") for i in range(100)]
    want, told = brute(docs)
    assert "zarkona" in told
    assert sorted(map(tuple, pii.op1_query(spark.createDataFrame(docs, SCHEMA)).collect()), key=str) == want


def test_other_columns_keep_their_values(spark):
    df = spark.createDataFrame([(1, "mail a@b.cc now", "k", -7, "s")], "doc_id long, text string, key string, pii_k int, spans string")
    assert [tuple(r) for r in pii.sanitise(df).collect()] == [(1, "mail [email] now", "k", -7, "s")]


def test_empty(spark):
    assert pii.op1_query(spark.createDataFrame([], SCHEMA)).collect() == []


def whole_terms(docs):
    """The disclosing terms by n(t), the distinct texts with the term, and trimming of all but letters and numbers."""
    def own(w):
        t = re.sub(r"^[\W_]+|[\W_]+$", "", w.lower())
        return t if len(t) >= 3 and re.search(r"[^\W\d]", t) and "@" not in t else ""

    texts, contexts, n_t, told = set(docs), defaultdict(set), defaultdict(int), set()
    for t in texts:
        for w in {own(w) for w in split(t)}:
            n_t[w] += 1
        for kind, p in BASE.items():
            ms = [m for m in re.finditer(p, t) if holds(kind, m[0])]
            for i, m in enumerate(ms):
                left = t[ms[i - 1].end() if i else 0 : m.start()]
                right = t[m.end() : ms[i + 1].start() if i + 1 < len(ms) else None]
                contexts[kind, m[0]].add((*split(left)[-8:], *split(right)[:8]))
    for found in contexts.values():
        for w in {own(w) for ws in found for w in ws} - {""}:
            n = sum(w in map(own, ws) for ws in found)
            if n >= 3 and n_t[w] and math.log2(len(texts) * n / (n_t[w] * len(found))) / math.log2(len(texts) / len(found)) >= 0.9:
                told.add(w)
    return told


def test_terms_of_several_entities_and_odd_punctuation(spark):
    r = random.Random(8)
    vocab = [f"{a}{b}" for a in ("ka", "lo", "mi", "su") for b in ("ran", "tel", "vos", "dim", "pex")]
    docs = []
    for i in range(150):
        ws = r.choices(vocab, k=12)
        if i % 10 == 0:  # one signature with three entities
            ws[6:6] = ["zarkona", "zar.kona@mail.example", "4111111111111111", "+15551234567"]
        if i % 10 == 1:
            ws[6:6] = [r.choice(["\u3010velmira\u3011", "\u2022velmira", "velmira\u00b7"]), "vel@mail.example"]
        if i % 10 == 2:  # the match is cut from a word
            ws[6:6] = ["tonrek:ton@mail.example"]
        if i == 3:
            ws.insert(2, "tonrek:")
        docs.append(" ".join(ws))
    want = whole_terms(docs)
    assert {"zarkona", "velmira", "tonrek"} <= want
    df = spark.createDataFrame([(i, t, "k", "e") for i, t in enumerate(docs * 2)], SCHEMA).repartition(3)
    stages = Stages(spark)
    terms = pii.disclosing_terms(df, stages.keep(pii.find_base(df), "found"), stages).collect()
    assert {x["term"] for x in terms} == want


def test_trimming_is_by_letters_and_numbers(spark):
    ws = ["\u00b7a1\u00b7", "...", "\u3010x\u3011", "Y", "(\u2022deux\u2022)", "a" + "\u2022" * 9000 + "b", "\u2022" * 9000, "", "e\u0301\u00b7z\u00b7"]
    got = [x[0] for x in spark.createDataFrame([(w, i) for i, w in enumerate(ws)], "w string, i int").orderBy("i").select(pii.bare(F.col("w"))).collect()]
    assert got == [re.sub(r"^[\W_]+|[\W_]+$", "", w.lower()) if len(w) < 100 else "" if w[0] != "a" else w for w in ws]
