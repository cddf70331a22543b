import random
from collections import defaultdict

from contrail.llm import quality as Q
from contrail.llm.common import Stages

SCHEMA = "doc_id long, text string, source string, q_words string"


def split(text):
    return [w for w in (text or "").replace("\x0b", " ").replace("\x0c", " ").split() if w] if text and text.isascii() else __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(docs, max_rate=0.5):
    rows, hosts = [], defaultdict(list)
    for d, t, source, *_ in docs:
        t = t or ""
        ws = split(t)
        at = defaultdict(list)
        for i in range(len(ws) - 7):
            at[tuple(ws[i : i + 8])].append(i)
        repeated = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
        lines = [x for x in t.split("\n") if split(x)]
        symbols, chars, dup = sum(c in "#*$%&|<>" for c in t), sum(map(len, ws)), len(lines) - len(set(lines))
        failed = len(ws) < 20 or 100 * len(repeated) > 30 * len(ws)
        rows.append((d, len(ws), chars, symbols, dup, len(repeated), failed, source))
        if source is not None:
            hosts[source].append((failed, 10 * symbols > chars, 10 * dup > len(ws)))
    bad = set()
    for k in range(3):
        if hosts:
            k_, n_ = {h: sum(x[k] for x in v) for h, v in hosts.items()}, {h: len(v) for h, v in hosts.items()}
            total, groups = sum(n_.values()), len(hosts)
            m = sum(k_.values()) / total
            s = 1.0
            if m * (1 - m) * (total - sum(n * n for n in n_.values()) / total - (groups - 1)) > 1e-9:
                between = sum(n_[h] * (k_[h] / n_[h] - m) ** 2 for h in hosts) - (groups - 1) * m * (1 - m)
                rho = between / (m * (1 - m) * (total - sum(n * n for n in n_.values()) / total - (groups - 1)))
                s = 1 / min(max(rho, 1e-6), 1 - 1e-6) - 1
            bad |= {h for h in hosts if (k_[h] + m * s) / (n_[h] + s) > max_rate}
    return sorted((*r[:7], not r[6] and r[7] not in bad) for r in rows) if all(r[0] is not None for r in rows) else sorted(((*r[:7], not r[6] and r[7] not in bad) for r in rows), key=str)


def fixture():
    r = random.Random(13)
    vocab = [f"w{i}" for i in range(500)] + ["é", "😀x", "#a", "$%&", "\xa0"]
    docs = [(1, None, "a", "q"), (2, "", "a", "q"), (3, " \n\t\x0b ", "b", None), (4, "word " * 40, None, "q"), (None, "x y z", "a", "q"), (6, "a b c d e f g h " * 2 + "i " * 3, "b", "q")]
    for i in range(200):
        host = r.choice(["a", "a", "b", "c", "junk", None])
        n = r.choice([5, 10]) if host == "junk" and r.random() < 0.6 else r.choice([19, 20, 60, 300])
        ws = r.choices(vocab, k=n)
        if r.random() < 0.2:
            ws += ws[: r.choice([8, 9, 20])] * r.choice([1, 2])
        lines = "".join(w + r.choice(["  ", " ", "\n", "\r\n", "\t"]) for w in ws)
        docs.append((10 + i, lines + ("\nsame line\nsame line" if r.random() < 0.2 else ""), host, "q"))
    docs += [docs[-1], (9999, "long words repeat never " + " ".join(str(i) for i in range(30000)), "a", "q")]
    return docs


def test_against_brute_force(spark):
    docs = fixture()
    got = Q.op8_query(spark, spark.createDataFrame(docs, SCHEMA).repartition(3))
    want = brute(docs)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert any(not w[6] and not w[7] for w in want)  # a host is rejected


def test_filter_keeps_columns_and_rows(spark):
    docs = fixture()
    kept = Q.quality_filter(spark.createDataFrame(docs, SCHEMA))
    assert kept.columns == ["doc_id", "text", "source", "q_words"] and kept.count() == sum(w[7] for w in brute(docs))


def test_names_of_its_own_are_left_alone(spark):
    schema = "doc_id long, text string, source string, q_words long, q string, host long, row string, kept string"
    rows = [(1, " ".join(map(str, range(60))), "s", -7, "q", 3, "r", "k"), (2, "short", "s", 1, "q", 3, "r", "k")]
    kept = Q.quality_filter(spark.createDataFrame(rows, schema)).collect()
    assert [tuple(x) for x in kept] == [rows[0]]


def test_small_hosts_are_shrunk(spark):
    """A host of two failures among good hosts stays; one of two hundred goes."""
    good = " ".join(f"w{i}" for i in range(30))
    docs = [(i, good, f"h{i % 20}", "q") for i in range(2000)] + [(5000 + i, "few words", "big", "q") for i in range(200)] + [(6000 + i, good if i else "few", "two", "q") for i in range(3)]
    df = spark.createDataFrame(docs, SCHEMA)
    stages = Stages(spark)
    got = {x["host"]: x for x in Q.host_verdicts(Q.measured(df, stages, ["doc_id"]), stages).collect()}
    assert not got["big"]["host_ok"] and got["two"]["host_ok"] and got["two"]["rate_base"] < 1 / 3 + 0.05 and got["h0"]["rate_base"] < 0.02


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert Q.op8_query(spark, empty).collect() == [] and Q.quality_filter(empty).collect() == []
