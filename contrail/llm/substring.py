"""Incremental substring dedup: a log-structured index of window fingerprints.

A window is WINDOW consecutive words of one document. A word goes if a window that covers it
also starts in a document with a smaller doc_id.

Index. Of every window the run of GRAM words with the least hash stands for it (equal windows
choose the same run at the same place), so about two grams in (WINDOW - GRAM + 2) words are
indexed, not all windows. The index is a log of immutable runs, tables sorted by gram with the
least and the greatest doc_id that have it. A batch is reduced to a run of its own, merge-joined
with the runs of history, and becomes a run itself; once there are MAX_RUNS they are compacted
into one. What a batch shares with history or within itself are the candidate grams.

Verification. What a candidate gram stands for in a document is its context, the words from the
first to the last of its windows. Contexts are compared by 96 bits of XXH3 over their words:
where a smaller doc_id has the same context, all its windows go. Of each context only its first
holder is left to settle, and only if the gram stands in other contexts too: its windows are
compared by XXH3 with 128 bits over their words; the least doc_id that has one owns it. The
grams' own quick hashes decide nothing; two grams under one hash only meet for nothing.

Joins on grams and windows have sums by key on one side; the other side's hot keys are left to
adaptive splitting. Texts are shuffled twice, by document.

Defined results. A null text has no words. A null doc_id is not smaller than any other and has
none smaller: nothing is removed from or because of it. Rows with one doc_id are one document
for the comparison, and each row gets its own result. Texts shorter than a window keep all. An
empty table gives an empty result. Other columns are not read. A text is held whole by a task; it
may have any number of words that fits.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stages
from .textarrays import Words, anchors, covered, digests, minimizers, parts, runs, spread

WINDOW = 13
GRAM = 5
BATCHES = 3
MAX_RUNS = 2


def _with_key(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")


_OCC = ["gram", "context", "check", "doc_id", "th", "first", "more"]


def _occurrences(batches):
    """(doc_id, th, text) -> _OCC: the windows first .. first + more that a gram stands for, and their words' digest."""
    for batch in batches:
        for lo, hi, data, offsets in parts(batch.column(2)):
            ws = Words(data, offsets)
            hs, i = ws.hashes(1), np.arange(len(ws))
            valid = i + GRAM <= ws.row_end
            grams = np.zeros(len(ws), np.uint64)
            grams[valid] = runs(hs, i[valid], GRAM)
            windows = ws.run_starts(WINDOW)
            at, first, last = anchors(minimizers(grams, valid, windows, WINDOW - GRAM + 1), windows)
            row = np.searchsorted(ws.first, at, "right") - 1
            own = batch.select(["doc_id", "th"]).take(pa.array(lo + row))
            buffer, starts, ends = ws.joined()
            context, check = digests(buffer, starts[first], ends[last + WINDOW - 1], (at - first) * 100 + (last - first))
            places = [pa.array((first - ws.first[row]).astype(np.int32)), pa.array((last - first).astype(np.int8))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[at].view(np.int64)), pa.array(context), pa.array(check.astype(np.int32)), own.column(0), own.column(1), *places], names=_OCC
            )


def _windows(batches):
    """(doc_id, text, contexts) -> (w1, w2, doc_id, gram, context, check, at): digests of the windows of contexts, at from their start."""
    for batch in batches:
        found = batch.column(2)
        bounds, flat = found.offsets.to_numpy(), found.values
        firsts, mores, grams, contexts, checks = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(5))
        for lo, hi, data, offsets in parts(batch.column(1)):
            ws = Words(data, offsets)
            a, b = bounds[lo], bounds[hi]
            row = np.repeat(np.arange(hi - lo), np.diff(bounds[lo : hi + 1]))
            n = mores[a:b] + 1
            windows = spread(firsts[a:b], firsts[a:b] + mores[a:b]) + np.repeat(ws.first[row], n)
            buffer, starts, ends = ws.joined()
            w1, w2 = digests(buffer, starts[windows], ends[windows + WINDOW - 1])
            ids = batch.column(0).take(pa.array(lo + np.repeat(row, n)))
            at = spread(np.zeros(len(n), np.int64), n - 1)
            keys = [pa.array(np.repeat(x[a:b], n)) for x in (grams, contexts, checks.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([pa.array(w1), pa.array(w2), ids, *keys, pa.array(at.astype(np.int32))], names=["w1", "w2", "doc_id", "gram", "context", "check", "at"])


def _kept(batches):
    """(doc_id, text, ranges) -> (doc_id, n_words, n_removed, text): what is left of each text."""
    for batch in batches:
        words, removed, texts = [], [], []
        ranges = batch.column(2)
        bounds, flat, some = ranges.offsets.to_numpy(), ranges.values, ranges.is_valid().to_pylist()
        firsts, lasts = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        for r, t in enumerate(batch.column(1).to_pylist()):
            ws = (t or "").encode().split()
            words.append(len(ws))
            if some[r]:
                a, b = bounds[r], bounds[r + 1]
                gone = covered(firsts[a:b], lasts[a:b] + WINDOW, len(ws))
                ws = [w for w, x in zip(ws, gone.tolist()) if not x]
            removed.append(words[-1] - len(ws))
            texts.append(b" ".join(ws).decode())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "n_words", "n_removed", "text"])


class FingerprintIndex:
    """A log of sorted immutable runs: (gram, lo, hi) with the least and greatest doc_id of each gram."""

    def __init__(self, stages: Stages, max_runs: int = MAX_RUNS):
        self.stages, self.max_runs, self.runs, self._made = stages, max_runs, [], 0

    def _write(self, run: DataFrame) -> tuple[str, DataFrame]:
        self._made += 1
        name = f"run-{self._made}"
        return name, self.stages.keep(run.sortWithinPartitions("gram"), name)

    def ingest(self, occurrences: DataFrame) -> DataFrame:
        """Adds a batch; returns its candidate grams: those that history has, or two documents of the batch."""
        name, run = self._write(occurrences.groupBy("gram").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")))
        found = run.where("lo < hi").select("gram")
        for _, old in self.runs:  # two sorted sides: a merge join, each gram once on either
            found = found.unionByName(run.join(old.select("gram").hint("merge"), "gram", "left_semi").select("gram"))
        found = self.stages.keep(found.distinct(), f"{name}-found")
        self.runs.append((name, run))
        if len(self.runs) >= self.max_runs:
            self.compact()
        return found

    def compact(self) -> None:
        """All runs into one; the old ones go when the new one is written."""
        old, merged = self.runs, self.runs[0][1]
        for _, run in old[1:]:
            merged = merged.unionByName(run)
        self.runs = [self._write(merged.groupBy("gram").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))]
        self.stages.drop(*(name for name, _ in old))

    def drop(self) -> None:
        self.stages.drop(*(name for name, _ in self.runs))
        self.runs = []


def _candidates(occ: DataFrame, stages: Stages, batches: int) -> DataFrame:
    """The grams that two documents share; documents come to the index in batches of rising doc_id."""
    index, found = FingerprintIndex(stages), None
    cuts = occ.agg(F.percentile_approx("doc_id", [k / batches for k in range(1, batches)], 1000)).first()[0] or []
    cuts = sorted(set(cuts))
    for k in range(len(cuts) + 1):
        batch = occ
        if k:
            batch = batch.where(F.col("doc_id") > cuts[k - 1])
        if k < len(cuts):
            batch = batch.where(F.col("doc_id") <= cuts[k])
        new = index.ingest(batch)
        found = new if found is None else found.unionByName(new)
    grams = stages.keep(found.distinct(), "grams")
    index.drop()
    return grams


def dedup(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(doc_id, n_words, n_removed, text): text has the words that are left, joined by one space."""
    stages, docs = Stages(docs.sparkSession), _with_key(docs)
    some = docs.where("doc_id is not null")
    occ = stages.keep(some.mapInArrow(_occurrences, "gram long, context long, check int, doc_id long, th long, first int, more byte"), "occ")
    grams = _candidates(occ, stages, batches)
    hits = stages.keep(occ.join(grams.hint("merge"), "gram", "left_semi"), "hits")
    stages.drop("occ", "grams")
    key = ["gram", "context", "check"]

    def same(prefix: str):
        return (F.col("gram") == F.col(f"{prefix}_gram")) & (F.col("context") == F.col(f"{prefix}_context")) & (F.col("check") == F.col(f"{prefix}_check"))

    def named(rows: DataFrame, prefix: str) -> DataFrame:
        return rows.withColumnsRenamed({c: f"{prefix}_{c}" for c in key})

    classes = stages.keep(hits.groupBy(*key).agg(F.min(F.struct("doc_id", "th", "first", "more")).alias("one")), "classes")
    crowds = classes.groupBy(F.col("gram").alias("c_gram")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    asked = classes.join(crowds.hint("merge"), F.col("gram") == F.col("c_gram")).select("one.*", *key)
    asked = asked.groupBy(F.col("doc_id").alias("a_id"), F.col("th").alias("a_th")).agg(F.collect_list(F.struct("first", "more", *key)).alias("contexts"))
    once = some.join(asked.hint("merge"), (F.col("doc_id") == F.col("a_id")) & (F.col("th") == F.col("a_th"))).select("doc_id", "text", "contexts")
    windows = stages.keep(once.mapInArrow(_windows, "w1 long, w2 long, doc_id long, gram long, context long, check int, at int"), "windows")
    owners = windows.groupBy(F.col("w1").alias("o1"), F.col("w2").alias("o2")).agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    owned = windows.join(
        owners.where("lo < hi").hint("merge"), (F.col("w1") == F.col("o1")) & (F.col("w2") == F.col("o2")) & (F.col("lo") < F.col("doc_id"))
    ).select(*key, F.col("doc_id").alias("w_id"), "at").distinct()
    first = classes.select(*key, F.col("one.doc_id").alias("lo"))
    again = hits.join(named(first, "f").hint("merge"), same("f") & (F.col("lo") < F.col("doc_id"))).select(
        "doc_id", "th", "first", (F.col("first") + F.col("more")).alias("last")
    )
    # the windows that the first holder loses, wherever it has that context
    settled = hits.join(named(owned, "w").hint("merge"), same("w") & (F.col("doc_id") == F.col("w_id"))).select(
        "doc_id", "th", (F.col("first") + F.col("at")).alias("first"), (F.col("first") + F.col("at")).alias("last")
    )
    gone = again.unionByName(settled).groupBy(F.col("doc_id").alias("g_id"), F.col("th").alias("g_th")).agg(
        F.collect_set(F.struct("first", "last")).alias("ranges")  # of one document
    )
    gone = stages.keep(gone, "gone")
    stages.drop("windows", "hits", "classes")
    out = docs.join(gone.hint("merge"), (F.col("doc_id") == F.col("g_id")) & (F.col("th") == F.col("g_th")), "left")
    return out.select("doc_id", "text", "ranges").mapInArrow(_kept, "doc_id long, n_words long, n_removed long, text string")


def op2_query(docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT rid, doc_id, i, array_to_string(ws[i:i + 12], ' ') AS x FROM d, unnest(range(1, len(ws) - 11)) AS u(i) WHERE len(ws) >= 13),
o AS (SELECT x, min(doc_id) AS lo FROM w GROUP BY x),
g AS (SELECT rid, i FROM w JOIN o ON w.x = o.x WHERE o.lo < doc_id),
c AS (SELECT DISTINCT rid, j FROM g, unnest(range(i, i + 13)) AS u(j)),
l AS (SELECT rid, list(j) AS js FROM c GROUP BY rid),
p AS (SELECT d.rid, doc_id, len(ws)::BIGINT AS n_words, coalesce(len(js), 0)::BIGINT AS n_removed, ws, js FROM d LEFT JOIN l ON d.rid = l.rid),
k AS (SELECT p.rid, string_agg(ws[q], ' ' ORDER BY q) AS t FROM p, unnest(range(1, len(ws) + 1)) AS u(q)
      WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.rid = p.rid AND c.j = u.q) GROUP BY p.rid)
SELECT doc_id, n_words, n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM p LEFT JOIN k ON p.rid = k.rid
"""
