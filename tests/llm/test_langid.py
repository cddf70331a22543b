import math
import random
import re
import zlib

import numpy as np
import pytest

from contrail.llm import langid as L

SCHEMA = "doc_id long, text string, lang string, source string, score double"


def phrases(text, known):
    """Cross-parsing by search in each labelled text."""
    n = i = 0
    while i < len(text):
        k = 1
        while i + k < len(text) and any(text[i : i + k + 1] in t for t in known):
            k += 1
        i, n = i + k, n + 1
    return n


def plain(text):
    return re.sub(r"[\W\d_]+", " ", (text or "").lower())


@pytest.mark.parametrize("block, at_once, tables", [(L.BLOCK, L.AT_ONCE, L.TABLES), (7, 1 << 20, 0), (64, 256, L.TABLES), (64, 256, 0)])
def test_phrases_against_search(monkeypatch, block, at_once, tables):
    """Whatever the blocks, the phrases are those of one parse over the whole text."""
    monkeypatch.setattr(L, "BLOCK", block)
    monkeypatch.setattr(L, "AT_ONCE", at_once)
    monkeypatch.setattr(L, "TABLES", tables)
    r = random.Random(7)
    known = {"x": ["".join(r.choices("abc ", k=n)) for n in (300, 5, 300)], "y": ["".join(r.choices("abde ", k=500))], "z": ["q"]}
    m = L.Model(tuple((k, t) for k, ts in known.items() for t in ts))
    texts = ["".join(r.choices("abcdez ", k=n)) for n in (1, 2, 3, 50, 2048, 2049, 5000)] + [known["x"][0], "ééé", ""]
    codes = [L.normal(t) for t in texts]
    got = m.entropies(codes)
    for a, lang in enumerate(m.langs):
        own = ["".join(map(chr, L.normal(t))) for t in known[lang]]
        for i, c in enumerate(codes):
            want = phrases("".join(map(chr, c)), own) * math.log2(max(2, sum(map(len, own)))) / max(1, len(c))
            assert abs(got[a, i] - want) < 1e-9


def test_many_languages_and_a_large_alphabet():
    """Twenty languages with three thousand letters each take a few MB and are told apart."""
    r = random.Random(1)
    words = {f"l{k:02}": ["".join(chr(0x4E00 + r.randrange(3000)) for _ in range(r.choice([1, 2, 3]))) for _ in range(2000)] for k in range(20)}
    text = lambda lang, n: " ".join(r.choices(words[lang], k=n))
    m = L.Model(tuple((lang, text(lang, 2500)) for lang in words for _ in range(3)))
    assert sum(x.nbytes for a in m.automata for x in (a.symbol, a.to, a.keys, a.others, a.start, a.codes)) < 60e6
    assert sum(a.table.nbytes for a in m.automata if a.table is not None) <= L.TABLES
    asked = [(lang, text(lang, 60)) for lang in words]
    bits = m.entropies([L.normal(t) for _, t in asked])
    assert [m.langs[k] for k in bits.argmin(axis=0)] == [lang for lang, _ in asked]


def test_normal():
    assert "".join(map(chr, L.normal("Ab1,É\n\nß😀z"))) == "ab é ß z"


def rows():
    r = random.Random(8)
    syllables = {"en": "the ing and wh ou er", "fr": "é eau que les oi ç", "de": "sch ung ein ß ö er"}
    out = []
    for i in range(240):
        lang = r.choice(list(syllables))
        text = " ".join("".join(r.choices(syllables[lang].split(), k=3)) for _ in range(r.choice([20, 60, 600])))
        out.append((i, text, lang, "s", 1.0))
    return out


def test_held_out_accuracy_and_odd_rows(spark):
    docs = rows()
    odd = [(1000, None, "en", "s", 0.0), (1001, "", None, "s", 0.0), (1002, "12 !? 34", "fr", None, 0.0), (None, "the ing and", None, None, None)]
    df = spark.createDataFrame(docs + odd + odd[-1:], SCHEMA).repartition(3)
    got = L.op3_query(df).collect()
    assert len(got) == 245
    by = {x["doc_id"]: x for x in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1000, 1001, 1002))
    assert by[None]["lang_pred"] == "en"
    for i, *_ in docs:
        assert by[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= by[i]["score"] <= 1
    held = [(by[i]["lang_pred"], lang) for i, _, lang, *_ in docs if by[i]["held_out"]]
    assert np.mean([a == b for a, b in held]) > 0.97
    again = {x["doc_id"]: x["lang_pred"] for x in L.op3_query(df.repartition(5)).collect()}
    assert again == {k: v["lang_pred"] for k, v in by.items()}


def test_query_against_brute_force(spark):
    """The query's predictions and scores, by search in all labelled texts that aren't held out."""
    docs = rows()[:90]
    docs = [(i, t[:200] if k % 3 else t[:1300], lang, s, x) for k, (i, t, lang, s, x) in enumerate(docs)]
    known = {}
    for i, t, lang, *_ in docs:
        if zlib.crc32(str(i).encode()) % 3 != 1:
            known.setdefault(lang, []).append(plain(t))
    want = {}
    for i, t, *_ in docs[:30]:
        t = plain(t)
        bits = sorted((phrases(t, known[x]) * math.log2(sum(map(len, known[x]))) / len(t), x) for x in known)
        want[i] = (bits[0][1], (bits[1][0] - bits[0][0]) / bits[1][0])
    got = {x["doc_id"]: x for x in L.op3_query(spark.createDataFrame(docs, SCHEMA).repartition(3)).collect()}
    for i, (lang, score) in want.items():
        assert got[i]["lang_pred"] == lang and abs(got[i]["score"] - score) < 1e-9


def test_empty_and_unlabelled(spark):
    assert L.op3_query(spark.createDataFrame([], SCHEMA)).collect() == []
    got = L.op3_query(spark.createDataFrame([(3, "some words", None, "s", 1.0)], SCHEMA)).collect()
    assert [(x["lang_pred"], x["score"]) for x in got] == [("und", 0.0)]
