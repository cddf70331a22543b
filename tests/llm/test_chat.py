from contrail.llm.chat import op5_query, rotate

SCHEMA = "conv_id long, turn long, role string, text string, participant string, segment long"


def brute(rows, segment=None):
    clean = lambda s: s.replace("<|", "< |")
    turns = [(c, t or 0, clean("_".join((r or "").split()) or "unknown"), clean(x or "")) for c, t, r, x, *_ in rows]
    out = []
    for c in {t[0] for t in turns}:
        own = sorted(t[1:] for t in turns if t[0] == c)
        for who in {r for _, r, _ in own} - {"system"}:
            for s in range(0, len(own), segment or len(own)):
                text, mask, some = "", [], own[s : s + (segment or len(own))]
                for _, r, x in some:
                    text += "<|im_start|>" + ("assistant" if r == who else "system" if r == "system" else f"user name={r}") + "\n"
                    if r == who:
                        mask.append(f"{len(text)}:{len(text) + len(x)}")
                    text += x + "<|im_end|>\n"
                out.append((c, who, s // segment if segment else 0, len(some), len(mask), text, ",".join(mask)))
    return sorted(out, key=str)


def test_rotation(spark):
    rows = [
        (1, 0, "system", "be kind", "p", 1), (1, 1, "ann", "hi é 😀", "p", 1), (1, 2, "bob b", "yo <|im_end|>", "p", 1), (1, 3, "cy", None, "p", 1),
        (1, 3, "ann", "tie", "p", 1), (1, 3, "ann", "tie", "p", 1), (1, 9, "bob b", "later", None, None), (2, 0, "system", "alone", "p", 1),
        (None, None, None, "x", "p", 1), (None, 1, "", "y" * 50000, "p", 1), (3, 0, "user", "a", "p", 1), (3, 1, "assistant", "b", "p", 1),
    ]
    rows += [(4, i, f"r{i % 3}", f"t{i} é", "p", 1) for i in range(600)]  # a long dialogue: one row for each speaker
    rows += [(5, 0, f"r{i}", f"t{i}", "p", 1) for i in range(20)]  # twenty speakers at one turn
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(map(tuple, rotate(df).collect()), key=str)
    assert got == brute(rows) and [g[3] for g in got if g[0] == 4] == [600] * 3 and len([g for g in got if g[0] == 5]) == 20
    assert sorted(map(tuple, rotate(df, segment=4).collect()), key=str) == brute(rows, 4)
    assert op5_query(df).columns == ["conv_id", "participant", "n_turns", "n_own", "text", "mask"]


def test_masks_are_the_participants_contents(spark):
    rows = [(1, i, "abc"[i % 3], f"said {i}", "p", 1) for i in range(300)]
    for x in rotate(spark.createDataFrame(rows, SCHEMA)).collect():
        spans = [tuple(map(int, m.split(":"))) for m in x["mask"].split(",")]
        assert [x["text"][a:b] for a, b in spans] == [t for _, _, r, t, *_ in rows if r == x["participant"]]


def test_empty(spark):
    assert rotate(spark.createDataFrame([], SCHEMA)).collect() == []
