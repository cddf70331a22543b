"""Host-level quality rules: failures by host, shrunk with an empirical beta prior.

Every document is measured by itself, once. For each rule the failures are counted by host, a
beta-binomial is fitted to the hosts' counts by moments, and each host's rate is shrunk towards
the prior mean. A host whose shrunk rate exceeds ``max_rate`` for any rule is rejected with all
its documents.

Defined results. A null text has no words and fails the base rule. A null host is no host: its
documents are judged by the base rule alone and count for no prior. Repeated rows count each.
An empty table gives an empty result. Other columns are left alone, whatever their names: a row
is carried as one struct beside its measures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stages, let, words

MIN_WORDS = 20
WINDOW = 8
#: A host goes if a rule's shrunk failure rate is above this.
MAX_RATE = 0.5


def _repeat_words(ws: Column) -> Column:
    """Words inside windows of WINDOW words that the text holds twice or more."""
    hashes = F.transform(F.sequence(F.lit(1), F.size(ws) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(ws, i, WINDOW)))

    def covered(starts: Column) -> Column:  # sorted starts of repeated windows
        nexts = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.element_at(starts, -1) + WINDOW))
        return F.aggregate(
            F.zip_with(starts, nexts, lambda a, b: F.least(b - a, F.lit(WINDOW))),
            F.lit(0).cast("long"), lambda a, x: a + x.cast("long"),
        )

    def starts(hs: Column) -> Column:
        rows = F.array_sort(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = let(rows, lambda r: F.filter(r, lambda x, k: (F.get(r, k - 1)["h"] == x["h"]) | (F.get(r, k + 1)["h"] == x["h"])))
        return F.array_sort(F.transform(same, lambda x: x["i"]))

    found = let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(let(starts(hs), covered)))
    return F.when(F.size(ws) > WINDOW, found).otherwise(F.lit(0).cast("long"))


def measures(text: Column) -> Column:
    """words, chars, symbols, dup_lines, repeat_words (long) and failed, as a struct."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def told(ws: Column) -> Column:
        return let(F.struct(F.size(ws).cast("long").alias("n"), _repeat_words(ws).alias("r")), lambda x: F.struct(
            x["n"].alias("words"),
            F.length(F.array_join(ws, "")).cast("long").alias("chars"),
            (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long").alias("symbols"),
            let(lines, lambda y: F.size(y) - F.size(F.array_distinct(y))).cast("long").alias("dup_lines"),
            x["r"].alias("repeat_words"),
            ((x["n"] < MIN_WORDS) | (100 * x["r"] > 30 * x["n"])).alias("failed"),
        ))

    return let(words(text), told)


def measured(docs: DataFrame, stages: Stages, columns: list[str], host: str = "source", text: str = "text") -> DataFrame:
    """(row, host, q): a struct of these columns of docs, the host and the measures; written, so that texts are measured once."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), F.col(f"`{host}`").alias("host"), measures(F.col(f"`{text}`")).alias("q"))
    return stages.keep(rows, "measured")


def _rules() -> dict[str, Column]:
    """Failures that are counted by host."""
    return {"base": F.col("q.failed"), "symbols": 10 * F.col("q.symbols") > F.col("q.chars"), "lines": 10 * F.col("q.dup_lines") > F.col("q.words")}


def host_verdicts(rows: DataFrame, stages: Stages, max_rate: float = MAX_RATE) -> DataFrame:
    """One row a host: host, n, k_<rule>, rate_<rule> (shrunk), host_ok.

    The prior's mean m is the rate over all documents of hosts. Its strength is 1/rho - 1 with the
    moment estimate of the beta-binomial's correlation, (S - (H-1)m(1-m)) / ((N - sum n^2/N - (H-1))m(1-m)),
    where H hosts have N documents and S = sum n(rate - m)^2: hosts that differ by no more than chance
    give rho near 0, so rates of small hosts give way to m. rho is kept in [1e-6, 1 - 1e-6], and the strength is
    1 where rho can't be told. Documents are summed by host before any shuffle, and only the moments, one
    row, come to the driver.
    """
    rules = _rules()
    hosts = rows.where(F.col("host").isNotNull()).groupBy("host").agg(F.count(F.lit(1)).alias("n"), *(F.sum(c.cast("long")).alias(f"k_{k}") for k, c in rules.items()))
    hosts = stages.keep(hosts, "hosts")
    sums = hosts.agg(
        F.sum("n").alias("N"), F.count(F.lit(1)).alias("H"), F.sum(F.col("n") * F.col("n")).alias("n2"),
        *(F.sum(f"k_{k}").alias(f"k_{k}") for k in rules), *(F.sum(F.col(f"k_{k}") * F.col(f"k_{k}") / F.col("n")).alias(f"q_{k}") for k in rules),
    ).first()
    out, ok = hosts, F.lit(True)
    for k in rules:
        m = sums[f"k_{k}"] / sums["N"] if sums["N"] else 0.0
        spread = (sums["N"] - sums["n2"] / sums["N"] - (sums["H"] - 1)) * m * (1 - m) if sums["N"] else 0.0
        strength = 1.0
        if spread > 1e-9:
            rho = (sums[f"q_{k}"] - m * m * sums["N"] - (sums["H"] - 1) * m * (1 - m)) / spread
            strength = 1 / min(max(rho, 1e-6), 1 - 1e-6) - 1
        out = out.withColumn(f"rate_{k}", (F.col(f"k_{k}") + m * strength) / (F.col("n") + strength))
        ok = ok & (F.col(f"rate_{k}") <= max_rate)
    return out.withColumn("host_ok", ok)


def judge(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(row, q, kept). The few verdict rows meet a hot host's documents in a join that
    adaptive execution broadcasts when small, and splits by skew when not."""
    v = verdicts.select(F.col("host").alias("v_host"), "host_ok")
    return rows.join(v, F.col("host") == F.col("v_host"), "left").select("row", "q", (~F.col("q.failed") & F.coalesce("host_ok", F.lit(True))).alias("kept"))


def quality_filter(docs: DataFrame, host: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """The rows of docs that are kept, with their own columns only."""
    stages = Stages(docs.sparkSession)
    rows = measured(docs, stages, docs.columns, host)
    return judge(rows, host_verdicts(rows, stages, max_rate)).where("kept").select("row.*")


def op8_query(spark, docs: DataFrame) -> DataFrame:
    stages = Stages(spark)
    rows = measured(docs, stages, ["doc_id"])
    names = {"words": "n_words", "chars": "word_chars", "symbols": "n_symbols", "dup_lines": "n_dup_lines", "repeat_words": "n_repeat_words", "failed": "base_failed"}
    return judge(rows, host_verdicts(rows, stages)).select("row.doc_id", *(F.col(f"q.{a}").alias(b) for a, b in names.items()), "kept")


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS x
        FROM w, unnest(range(1, len(ws) - 6)) AS u(i) WHERE len(ws) >= 8),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, x) AS c FROM win) WHERE c >= 2),
cov AS (SELECT rid, count(DISTINCT j) AS c FROM rep, unnest(range(i, i + 8)) AS u(j) GROUP BY rid),
m AS (SELECT w.rid, doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.c, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN cov ON w.rid = cov.rid),
f AS (SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
             (10 * n_symbols > word_chars) AS f_sym, (10 * n_dup_lines > n_words) AS f_line FROM m),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS k1, sum(f_sym::INT) AS k2, sum(f_line::INT) AS k3
      FROM f WHERE source IS NOT NULL GROUP BY source),
p AS (SELECT sum(n)::DOUBLE AS n_all, count(*)::DOUBLE AS n_hosts, sum(n * n)::DOUBLE AS n2, sum(k1) / sum(n) AS m1, sum(k2) / sum(n) AS m2, sum(k3) / sum(n) AS m3,
             sum(k1 * k1 / n) AS q1, sum(k2 * k2 / n) AS q2, sum(k3 * k3 / n) AS q3 FROM h),
g AS (SELECT *, n_all - n2 / n_all - (n_hosts - 1) AS w FROM p),
s AS (SELECT *, CASE WHEN w * m1 * (1 - m1) > 1e-9 THEN 1 / least(greatest((q1 - m1 * m1 * n_all - (n_hosts - 1) * m1 * (1 - m1)) / (w * m1 * (1 - m1)), 1e-6::DOUBLE), 1 - 1e-6::DOUBLE) - 1 ELSE 1.0 END AS s1,
             CASE WHEN w * m2 * (1 - m2) > 1e-9 THEN 1 / least(greatest((q2 - m2 * m2 * n_all - (n_hosts - 1) * m2 * (1 - m2)) / (w * m2 * (1 - m2)), 1e-6::DOUBLE), 1 - 1e-6::DOUBLE) - 1 ELSE 1.0 END AS s2,
             CASE WHEN w * m3 * (1 - m3) > 1e-9 THEN 1 / least(greatest((q3 - m3 * m3 * n_all - (n_hosts - 1) * m3 * (1 - m3)) / (w * m3 * (1 - m3)), 1e-6::DOUBLE), 1 - 1e-6::DOUBLE) - 1 ELSE 1.0 END AS s3 FROM g),
ok AS (SELECT source, ((k1 + m1 * s1) / (n + s1) <= 0.5 AND (k2 + m2 * s2) / (n + s2) <= 0.5
                       AND (k3 + m3 * s3) / (n + s3) <= 0.5) AS host_ok FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND coalesce(host_ok, true)) AS kept
FROM f LEFT JOIN ok ON f.source = ok.source
"""
