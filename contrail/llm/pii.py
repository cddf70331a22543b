"""Personal data: patterns, and terms that disclose the people or things behind them.

Base spans come from four patterns. Every base match is a protected entity, named by its kind
and value. The corpus then tells how much a term (a word in lower case without outer
punctuation) discloses of an entity:

    disclosure(t, c) = PMI(t; c) / IC(c) = log2(N * n(t, c) / (n(t) * n(c))) / log2(N / n(c))

n(c) counts the distinct contexts (CONTEXT words to either side, as far as the next base match of
the kind, however long the words and the space between them) in which entity c stands,
n(t, c) those that have t, n(t) the distinct texts that have t, N the distinct texts. It is 1
if t occurs with c only, and near 0 if t is as common elsewhere. A term with MIN_SUPPORT
contexts or more of an entity and a disclosure of GENERALISE or more is a span of kind
``term`` wherever it stands; sanitise() replaces it by its class, or removes it from REMOVE
on. Distinct contexts keep copies of one text from counting as evidence.

A mention gives at most 2 * CONTEXT rows, so work is linear in the text. Terms are counted over
the corpus only if they could still disclose enough were they in no text beyond those that have
them in a context: no more than n(t), so no term is lost.

Defined results. A null text is empty and has no spans. Texts that repeat are counted once;
each of their rows gets the same spans. A null doc_id is kept. An empty table gives an empty
result. U+FFFF in a text is read as U+FFFE where contexts are cut. Other columns are left alone by sanitise() and not read by find().
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stages, let, prefix_sums, words

CONTEXT = 8
MIN_SUPPORT = 3
GENERALISE = 0.9
REMOVE = 0.98
KINDS = ("email", "ip", "card", "phone", "term")
_SOME = " OR ".join(f"size({k}) > 0" for k in KINDS[:4])
#: The patterns of the contract. Possessive steps and the anchors at the front (a run's start, or
#: the end of the last match) keep them linear on long runs and change no match.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character that every match of the kind has.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_KEPT = "\uffff"  #: stands for a base match where a text is cut at those
#: The first CONTEXT words of a piece; possessive, so it never goes back.
_FEW = rf"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++){{0,{CONTEXT - 1}}}+[^\x20\x09-\x0D]*+"
_PLACES = "array<struct<start:bigint,end:bigint,value:string>>"
_SPAN = "array<struct<start:bigint,end:bigint,value:string,left:array<string>,right:array<string>>>"
#: Common characters that aren't part of a term at its ends; nor is any but a letter or number.
#: In a text of these, letters, numbers and white space only, no other character needs trimming.
OUTER = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”‘’„…–—¡¿"


def _luhn(digits: Column) -> Column:
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _holds(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "card":
        return F.when((F.length(digits) >= 12) & (F.length(digits) <= 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return (F.length(digits) >= 9) & (F.length(digits) <= 15)
    return F.lit(True)


def _side(piece: Column, left: bool) -> Column:
    """Up to CONTEXT words next to a match."""
    if left:
        return words(F.reverse(F.regexp_extract(F.reverse(piece), _FEW, 0)))
    return words(F.regexp_extract(piece, _FEW, 0))


def _spans(ms: Column, ps: Column) -> Column:
    """Matches with their places, in code points; ps are the pieces of text between them."""
    steps = F.transform(ms, lambda m, i: F.length(F.get(ps, i)) + F.length(m))
    return let(prefix_sums(steps), lambda before: F.transform(ms, lambda m, i: F.struct(
        (F.get(before, i) + F.length(F.get(ps, i))).alias("start"),
        (F.get(before, i) + F.length(F.get(ps, i)) + F.length(m)).alias("end"),
        m.alias("value"),
    )))


def _found(text: Column, pattern: str, none: Column, body) -> Column:
    """body(matches, pieces between them), or none without a match."""
    some = lambda ms: F.when(F.size(ms) > 0, let(F.split(text, pattern), lambda ps: body(ms, ps))).otherwise(none)
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), some)


def base_spans(text: Column, kind: str) -> Column:
    """Matches of one kind that pass its test, with the words around them; failing ones are dropped
    and not retried, and are part of the text around the others."""
    none = F.array().cast(_SPAN)
    text = F.when(F.contains(text, F.lit(_KEPT)), F.translate(text, _KEPT, "\ufffe")).otherwise(text)

    def kept(ms: Column, ps: Column) -> Column:
        rest = F.transform(ms, lambda m, i: F.concat(F.get(ps, i), F.when(_holds(kind, m), F.lit(_KEPT)).otherwise(m)))
        around = F.split(F.concat(F.array_join(rest, ""), F.get(ps, F.size(ms))), _KEPT)
        spans = F.filter(_spans(ms, ps), lambda s: _holds(kind, s["value"]))
        return let(around, lambda x: F.transform(spans, lambda s, i: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
            _side(F.get(x, i), True).alias("left"), _side(F.get(x, i + 1), False).alias("right"),
        )))

    def some(ms: Column, ps: Column) -> Column:
        return F.when(F.exists(ms, lambda m: _holds(kind, m)), kept(ms, ps)).otherwise(none)

    spans = _found(text, PATTERNS[kind], none, some)
    return F.when(F.contains(text, F.lit(NEEDS[kind])), spans).otherwise(none) if NEEDS[kind] else spans


def bare(word: Column) -> Column:
    """A word in lower case without outer punctuation."""
    core = r"(?s)[\p{L}\p{N}](?:.*[\p{L}\p{N}])?"
    odd = r"^[^\p{L}\p{N}]|[^\p{L}\p{N}]\z"
    return let(F.btrim(F.lower(word), F.lit(OUTER)), lambda w: F.when(w.rlike(odd), F.regexp_extract(w, core, 0)).otherwise(w))


def own_words(text: Column) -> Column:
    """The distinct bare words of a text; the costly trimming is only for texts that need it."""
    odd = F.lower(text).rlike(r"[^\p{L}\p{N}\x20\x09-\x0D" + re.escape(OUTER) + "]")
    quick = lambda w: F.btrim(F.lower(w), F.lit(OUTER))
    return let(F.array_distinct(words(text)), lambda ws: F.array_distinct(F.when(odd, F.transform(ws, bare)).otherwise(F.transform(ws, quick))))


def term(word: Column) -> Column:
    """A word as a term; empty if it is none: under three characters, or without a letter."""
    t = bare(word)
    return F.when((F.length(t) >= 3) & t.rlike(r"\p{L}") & ~F.contains(t, F.lit("@")), t).otherwise("")


def _key(text: Column) -> Column:
    """Tells texts apart: two hashes and the length."""
    return F.concat_ws(":", F.hex(F.xxhash64(text)), F.hex(F.hash(text)), F.length(text))


def find_base(docs: DataFrame) -> DataFrame:
    """doc_id, key, an array of spans for each kind, and the text's own words that are terms of its contexts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    spans = docs.select("doc_id", "text", _key(text).alias("key"), *(base_spans(text, k).alias(k) for k in KINDS[:4]))
    around = F.flatten(F.concat(*(F.transform(k, lambda s: F.concat(s["left"], s["right"])) for k in KINDS[:4])))
    # a word that a match was cut from is in a context, but no word of the text
    own = F.array_intersect(F.filter(F.transform(around, term), lambda t: t != ""), own_words(text))
    near = F.when(F.expr(_SOME), own).otherwise(F.array().cast("array<string>"))
    return spans.select("doc_id", "key", *KINDS[:4], near.alias("near"))


def _contexts(found: DataFrame) -> DataFrame:
    """(entity, context, terms): one row for each distinct context of an entity."""

    def mentions(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(
            F.concat(F.lit(f"{kind}:"), F.lower(s["value"])).alias("entity"), F.concat(s["left"], s["right"]).alias("ws")
        ))

    every = F.concat(*map(mentions, KINDS[:4]))
    some = found.where(_SOME).select(F.explode(every).alias("m")).select("m.*")
    return some.select(
        "entity", F.xxhash64("ws").alias("context"), F.filter(F.array_distinct(F.transform("ws", term)), lambda t: t != "").alias("terms")
    ).dropDuplicates(["entity", "context"])


def disclosing_terms(docs: DataFrame, found: DataFrame, stages: Stages) -> DataFrame:
    """(term, disclosure): each term's largest disclosure, for those of GENERALISE or more."""
    contexts = stages.keep(_contexts(found), "contexts")
    n = float(found.select("key").distinct().count())
    n_c = contexts.groupBy("entity").agg(F.count(F.lit(1)).alias("n_c"))
    each = contexts.select("entity", F.explode("terms").alias("term"))
    near = found.select("key", F.explode("near").alias("term")).distinct().groupBy("term").agg(F.count(F.lit(1)).alias("near"))
    pairs = each.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_tc")).where(F.col("n_tc") >= MIN_SUPPORT)

    def disclosure(n_t: Column) -> Column:
        return F.log2(F.lit(n) * F.col("n_tc") / (n_t * F.col("n_c"))) / F.log2(F.lit(n) / F.col("n_c"))

    # near <= n(t), and disclosure falls with n(t) where IC is positive; a term that is no word of any such text may be one elsewhere
    could = F.when((F.col("n_c") < n) & F.col("near").isNotNull(), disclosure(F.col("near")) >= GENERALISE).otherwise(True)
    pairs = stages.keep(pairs.join(near, "term", "left").join(n_c, "entity").where(could).drop("near"), "pairs")
    wanted = stages.keep(pairs.select("term").distinct(), "wanted")
    # a written side of known size: broadcast if small, else sorted and merged
    n_t = _terms_of(docs).join(wanted, "term", "left_semi").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    told = pairs.join(n_t, "term").withColumn("disclosure", disclosure(F.col("n_t")))
    return stages.keep(told.groupBy("term").agg(F.max("disclosure").alias("disclosure")).where(F.col("disclosure") >= GENERALISE), "terms")


def _terms_of(docs: DataFrame) -> DataFrame:
    """(key, term): the distinct bare words of each text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(_key(text).alias("key"), F.explode(own_words(text)).alias("term"))


def term_spans(docs: DataFrame, terms: DataFrame, stages: Stages) -> DataFrame:
    """(key, terms): the places of disclosing terms, for the texts that have some."""
    text = F.coalesce(F.col("text"), F.lit(""))
    hits = _terms_of(docs)
    hits = hits.join(terms, "term").groupBy("key").agg(F.map_from_entries(F.collect_set(F.struct("term", "disclosure"))).alias("known"))
    # a written side of known size; where it is broadcast, copies of a text are reduced before any shuffle
    hits = stages.keep(hits, "hits")
    some = docs.select(_key(text).alias("t_key"), text.alias("t")).join(hits, F.col("t_key") == F.col("key")).dropDuplicates(["key"])
    some = some.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # few bytes, but much to do with each
    rows = F.filter(
        F.transform(_found(F.col("t"), r"[^\x20\x09-\x0D]++", F.array().cast(_PLACES), _spans), lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.col("known")[bare(s["value"])].alias("disclosure"), s["value"].alias("value")
        )),
        lambda s: s["disclosure"].isNotNull(),
    )
    return some.select("key", rows.alias("terms"))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, key, an array of base spans for each kind, and terms; one row for each of docs."""
    stages = Stages(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    found = stages.keep(find_base(docs), "found")
    terms = disclosing_terms(docs, found, stages)
    at = stages.keep(term_spans(docs, terms, stages), "at")
    out = found.drop("near").join(at, "key", "left")
    clear = lambda t: ~F.exists(_all(("email", "ip", "card", "phone")), lambda s: (s["start"] < t["end"]) & (s["end"] > t["start"]))
    none = F.array().cast("array<struct<start:bigint,end:bigint,disclosure:double,value:string>>")
    return out.withColumn("terms", F.filter(F.coalesce("terms", none), clear))


def _all(kinds) -> Column:
    """Spans of these columns, sorted by start, then kind as listed."""

    def spans(kind: str) -> Column:
        return F.transform("terms" if kind == "term" else kind, lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("k"), s["end"].alias("end"),
            (s["disclosure"] if kind == "term" else F.lit(1.0)).alias("disclosure"), s["value"].alias("value"),
        ))

    return F.array_sort(F.concat(*map(spans, kinds)))


def _told(kinds) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(_all(kinds), lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"], s["end"])), ",")


def sanitise(docs: DataFrame) -> DataFrame:
    """docs with base matches replaced by their kind in brackets, terms by their class or by nothing."""
    spans = find(docs).select("key", _all(KINDS).alias("spans")).where("size(spans) > 0").dropDuplicates(["key"])
    own = F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in docs.columns)).alias("row")  # whatever their names
    joined = docs.select(own, _key(F.coalesce(F.col("text"), F.lit(""))).alias("key")).join(spans, "key", "left")
    text = F.coalesce(F.col("row.text"), F.lit(""))
    label = lambda s: F.when(s["k"] < 4, F.concat(F.lit("["), F.get(F.array(*map(F.lit, KINDS)), s["k"]), F.lit("]"))).when(
        s["disclosure"] >= REMOVE, F.lit("")).when(s["value"].rlike(r"^\P{L}*\p{Lu}"), F.lit("[name]")).otherwise(F.lit("[word]"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    step = lambda a, s: F.when(s["start"] < a["at"], F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))).otherwise(
        F.struct(s["end"].alias("at"), F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), label(s)).alias("out")))
    end = lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text)))
    new = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(F.aggregate("spans", start, step, end))
    return joined.select(*(new.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))


def op1_query(docs: DataFrame) -> DataFrame:
    return find(docs).select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:4]),
        F.sha2(F.encode(_told(KINDS[:4]), "UTF-8"), 256).alias("base_sha256"),
        _told(KINDS).alias("spans"),
    )
