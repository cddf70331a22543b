"""Suffix-array dedup of bytes by external induced sorting.

A byte goes if a string of LENGTH bytes that covers it also starts anywhere else. Only suffixes
that can begin such a string, and only their first LENGTH bytes, matter; they are sorted, with
their common prefixes, in this way:

1. Sampling. Every string of LENGTH bytes has a sampled suffix inside: the one that starts at
   its run of GRAM bytes with the least hash. Equal strings have it at the same offset. What a
   sampled suffix stands for is its context: the bytes from the first to the last of its strings.
   Contexts are counted by XXH3 of 128 bits; all strings of a context that occurs twice are
   repeated, and a gram that stands in one context only needs no sorting. This is the recursion's
   reduced text: each distinct context under a gram that others share is one tuple.
2. Recursion. A key with more than CROWD tuples is cut by longer keys: its strings begin at most
   ``rest`` bytes left of the anchor; those of the nearer half share half of ``rest`` bytes more
   to the right of it, those of the farther half as many to the left, and these bytes join the
   key. After eight steps at most a key is a whole string, and its tuples are all alike.
3. Base. The tuples are sorted by (key, bytes from the anchor on). The sort is Spark's external
   one: sorted runs on disk, merged through a heap, which is the disk-backed priority queue
   here; no task holds more than CHUNK tuples and CROWD of a key. Neighbours' common prefixes
   follow from it.
4. Induction. The suffixes one byte further left are in the order of (that byte, order so far),
   and the common prefix of neighbours with one byte is one more than the least between them in
   the order so far. So order and common prefixes are carried left byte by byte, without
   comparing strings again; suffixes that share too little with both neighbours drop out.
   Neighbours with LENGTH bytes in common are repeated strings.

So suffixes are sorted and induced around sampled anchors and not over the whole corpus: there is
no suffix array of all bytes, whose induction passes every byte through the queues many times.

Defined results. A null text has no bytes. Rows are texts of their own, also if doc_ids repeat or
are null: of two equal rows both lose what they share. An empty table gives an empty result.
Other columns are not read. A long text is worked on in pieces that overlap by LENGTH - 1 bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stages
from .textarrays import SLICE, Sums, anchors, byte_values, covered, digests, minimizers, parts

LENGTH = 200
GRAM = 32
CHUNK = 20_000
CROWD = 20_000
#: key groups the tuples (at first the gram); a string of a tuple begins lo .. length(left_bytes) before the anchor, rest at most;
#: shift is how far the anchor lies left of the gram.
_TUPLES = "key long, rest int, shift int, gram long, context long, check long, lo int, left_bytes binary, right_bytes binary"
_NAMES = [x.split()[0] for x in _TUPLES.split(", ")]


def _pieces(column):
    """(row, base, bytes, row offsets): texts together, or a part of one long text from base on."""
    for lo, hi, data, offsets in parts(column):
        if hi - lo > 1 or len(data) <= 2 * SLICE:
            yield lo, hi, 0, data, offsets
        else:
            for base in range(0, len(data), SLICE):
                piece = data[base : base + SLICE + LENGTH - 1]
                if len(piece) >= LENGTH:
                    yield lo, hi, base, piece, np.array([0, len(piece)])


def _occurrences(batches):
    """(doc_id, th, text) -> (gram, context, check, doc_id, th, at, first, last), places in bytes of the text."""
    names = ["gram", "context", "check", "doc_id", "th", "at", "first", "last"]
    for batch in batches:
        for lo, hi, base, data, offsets in _pieces(batch.column(2)):
            n = len(data)
            row_end = np.repeat(offsets[1:], np.diff(offsets))
            i = np.arange(n)
            sums = Sums(byte_values(11)[data])
            valid = i + GRAM <= row_end
            grams = np.zeros(n, np.uint64)
            grams[valid] = sums.of(i[valid], i[valid] + GRAM)
            windows = i[i + LENGTH <= row_end]
            at, first, last = anchors(minimizers(grams, valid, windows, LENGTH - GRAM + 1), windows)
            context, check = digests(data.tobytes(), first, last + LENGTH, (at - first) * 1000 + (last - first))
            row = np.searchsorted(offsets, at, "right") - 1
            own = batch.select(["doc_id", "th"]).take(pa.array(lo + row))
            start = offsets[row] - base
            places = [pa.array((x - start).astype(np.int64)) for x in (at, first, last)]
            yield pa.RecordBatch.from_arrays([pa.array(grams[at].view(np.int64)), pa.array(context), pa.array(check), own.column(0), own.column(1), *places], names=names)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    columns = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_NAMES)


def _tuples(batches):
    """(text, contexts) -> _TUPLES: the bytes before and from the gram on."""
    for batch in batches:
        found = batch.column(1)
        bounds, flat = found.offsets.to_numpy(), found.values
        lists = [flat.field(k).to_pylist() for k in range(6)]
        rows = []
        for r, text in enumerate(batch.column(0).to_pylist()):
            data = text.encode()
            for j in range(bounds[r], bounds[r + 1]):
                gram, context, check, at, first, last = (x[j] for x in lists)
                rows.append((gram, LENGTH - GRAM, 0, gram, context, check, at - last, data[first:at], data[at : last + LENGTH]))
        yield _batch(rows)


def _finer(batches):
    """Tuples of crowded keys under two longer keys each: strings that begin near the anchor, and those that begin farther."""
    key = lambda *x: int(np.uint64(xxhash.xxh3_64_intdigest(b"%d %d " % x[:2] + x[2])).view(np.int64))
    for batch in batches:
        rows = []
        for k, rest, shift, gram, context, check, lo, left, right in zip(*(batch.column(i).to_pylist() for i in range(9))):
            half = rest // 2
            if lo <= half:
                rows.append((key(k, 0, right[: LENGTH - half]), half, shift, gram, context, check, lo, left[max(0, len(left) - half) :], right))
            far = half + 1
            if len(left) >= far:
                more = (left[len(left) - far :] + right)[: LENGTH - max(lo - far, 0)]
                less = rest - far
                rows.append((key(k, 1, more[: LENGTH - less]), less, shift + far, gram, context, check, max(lo - far, 0), left[: len(left) - far], more))
        yield _batch(rows)


def _matrix(column: list[bytes], width: int, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(b) for b in column], np.int64)
    out = np.zeros((len(column), width), np.uint8)
    for i, b in enumerate(column):
        out[i, : len(b)] = np.frombuffer(b[::-1] if reverse else b, np.uint8)
    return out, lengths


def induce(gram: np.ndarray, lo: np.ndarray, left: list[bytes], right: list[bytes]) -> list[tuple[int, int]]:
    """(tuple, offset) of all repeated strings; tuples are sorted by (gram, right).

    The string of a tuple at offset o has the last o bytes of left and the first LENGTH - o of
    right; tuple i has the offsets lo[i] .. len(left[i]).
    """
    rights, n_right = _matrix(right, LENGTH)
    lefts, hi = _matrix(left, max(1, max(map(len, left), default=1)), reverse=True)
    m = len(gram)
    lcp = np.zeros(m, np.int64)  # with the one before; 0 at the first of a gram
    if m > 1:
        differ = rights[1:] != rights[:-1]
        n = np.where(differ.any(axis=1), differ.argmax(axis=1), LENGTH)
        lcp[1:] = np.where(gram[1:] == gram[:-1], np.minimum(n, np.minimum(n_right[1:], n_right[:-1])), 0)
    order, out = np.arange(m), []
    _, group = np.unique(gram, return_inverse=True)
    for o in range(0, lefts.shape[1] + 1):
        if o:
            keep = hi[order] >= o
            near = np.maximum(lcp, np.concatenate((lcp[1:], [0]))) >= GRAM + o - 1
            order, lcp = _thin(order, lcp, keep & near)
            if len(order) < 2:
                break
            order, lcp = _left(order, lcp, group[order], lefts[order, o - 1])
        some = np.flatnonzero((lo[order] <= o) & (hi[order] >= o))
        if len(some) > 1:
            same = np.minimum.reduceat(lcp, some[:-1] + 1)  # up to the next one's place, but for the last
            same[-1] = lcp[some[-2] + 1 : some[-1] + 1].min()
            hit = np.zeros(len(some), bool)
            hit[1:] |= same >= LENGTH
            hit[:-1] |= same >= LENGTH
            out += [(int(t), o) for t in order[some[hit]]]
    return out


def _thin(order: np.ndarray, lcp: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept ones in their order; a common prefix spans those left out between."""
    at = np.flatnonzero(keep)
    if len(at) < 2:
        return order[at], lcp[at] * 0
    new = np.zeros(len(at), np.int64)
    least = np.minimum.reduceat(lcp, at[:-1] + 1)
    least[-1] = lcp[at[-2] + 1 : at[-1] + 1].min()
    new[1:] = least
    return order[at], new


def _left(order: np.ndarray, lcp: np.ndarray, group: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One byte further left: a stable sort by that byte within a gram, and its common prefixes."""
    key = group.astype(np.int64) * 256 + byte
    moved = np.argsort(key, kind="stable")
    new = np.zeros(len(order), np.int64)
    pairs = np.flatnonzero(key[moved[1:]] == key[moved[:-1]]) + 1
    if len(pairs):
        a, b = moved[pairs - 1] + 1, moved[pairs] + 1
        padded = np.concatenate((lcp, [0]))
        new[pairs] = 1 + np.minimum.reduceat(padded, np.stack((a, b), 1).reshape(-1))[::2]
    return order[moved], new


def _induced(batches):
    """Tuples sorted by (key, right bytes) -> (gram, context, check, first, last): offsets of repeated strings."""
    held: list[tuple] = []
    names = ["gram", "context", "check", "first", "last"]

    def flush(rows):
        if not rows:
            return
        key, shift, gram, context, check, lo, left, right = zip(*rows)
        found = induce(np.array(key, np.int64), np.array(lo, np.int64), list(left), list(right))
        ranges, prev = [], None
        for t, o in sorted(found):
            if prev and prev[0] == t and prev[2] + 1 == o:
                prev[2] = o
            else:
                prev = [t, o, o]
                ranges.append(prev)
        columns = [[x[t] for t, _, _ in ranges] for x in (gram, context, check)] + [[y[k] + shift[y[0]] for y in ranges] for k in (1, 2)]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(),) * 3 + (pa.int32(),) * 2)], names=names)

    for batch in batches:
        held += list(zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5, 6, 7, 8))))
        if len(held) >= CHUNK:
            cut = len(held)
            while cut and held[cut - 1][0] == held[-1][0]:
                cut -= 1
            yield from flush(held[:cut])
            held = held[cut:]
    yield from flush(held)


def repeated_offsets(tuples: DataFrame, stages: Stages, crowd: int = CROWD) -> DataFrame:
    """(gram, context, check, first, last): the offsets of strings that two tuples have."""
    small, level, drop = [], 0, []
    while True:
        sizes = tuples.where("rest > 0").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        many = stages.keep(sizes.where(F.col("n") > crowd).select(F.col("key").alias("m_key")), f"many-{level}")
        drop.append(f"many-{level}")
        if many.isEmpty():
            small.append(tuples)
            break
        small.append(tuples.join(many.hint("merge"), F.col("key") == F.col("m_key"), "left_anti"))
        level += 1
        crowded = tuples.join(many.hint("merge"), F.col("key") == F.col("m_key"), "left_semi")
        tuples = stages.keep(crowded.mapInArrow(_finer, _TUPLES), f"tuples-{level}")
        drop.append(f"tuples-{level}")
    rows = small[0]
    for more in small[1:]:
        rows = rows.unionByName(more)
    n_tasks = max(1, int(tuples.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.where("rest > 0").repartition(n_tasks, "key").sortWithinPartitions("key", "right_bytes")
    induced = dealt.mapInArrow(_induced, "gram long, context long, check long, first int, last int")
    # the recursion's end: a key is a whole string, and its bytes are compared as they are
    ends = rows.where("rest = 0").select("gram", "context", "check", F.col("shift").alias("first"), F.col("shift").alias("last"), F.substring("right_bytes", 1, LENGTH).alias("string"))
    twice = ends.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("string").alias("t_string"))
    whole = ends.join(twice.hint("merge"), F.col("string") == F.col("t_string"), "left_semi").drop("string")
    out = stages.keep(induced.unionByName(whole) if level else induced, "offsets")
    stages.drop(*drop)
    return out


def _cut(batches):
    """(doc_id, text, ranges) -> (doc_id, n_bytes, n_removed, n_spans, kept)."""
    for batch in batches:
        out = ([], [], [], [])
        ranges = batch.column(2)
        bounds, flat = ranges.offsets.to_numpy(), ranges.values
        firsts, lasts = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        valid = ranges.is_valid().to_pylist()
        for r, text in enumerate(batch.column(1).to_pylist()):
            data = (text or "").encode()
            spans, n = 0, 0
            kept = data
            if valid[r]:
                a, b = bounds[r], bounds[r + 1]
                gone = covered(firsts[a:b], lasts[a:b] + LENGTH, len(data))
                n = int(gone.sum())
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            for column, value in zip(out, (len(data), n, spans, kept)):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        )


def dedup_bytes(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): kept has the bytes that are left."""
    stages = Stages(docs.sparkSession)
    docs = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")
    occ = stages.keep(docs.mapInArrow(_occurrences, "gram long, context long, check long, doc_id long, th long, at long, first long, last long"), "occ")
    shared = stages.keep(occ.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "shared")
    some = stages.keep(occ.join(shared.hint("merge"), "gram", "left_semi"), "some")
    stages.drop("occ", "shared")
    key = ["gram", "context", "check"]
    one = F.struct("doc_id", "th", "at", "first", "last")
    classes = stages.keep(some.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min(one).alias("one")), "classes")
    crowds = classes.groupBy(F.col("gram").alias("c_gram")).agg(F.count(F.lit(1)).alias("classes")).where("classes > 1")
    asked = classes.join(crowds.hint("merge"), F.col("gram") == F.col("c_gram"), "left_semi").select(*key, "one.*")
    asked = asked.groupBy(F.col("doc_id").alias("a_id"), F.col("th").alias("a_th")).agg(  # a document's contexts
        F.collect_list(F.struct(*key, "at", "first", "last")).alias("contexts")
    )
    # a row that repeats a document gives its tuples twice, and all of its strings are repeated indeed
    texts = docs.join(asked.hint("merge"), F.col("doc_id").eqNullSafe(F.col("a_id")) & (F.col("th") == F.col("a_th")))
    tuples = stages.keep(texts.select("text", "contexts").mapInArrow(_tuples, _TUPLES), "tuples")
    offsets = repeated_offsets(tuples, stages, crowd)
    stages.drop("tuples")

    def same(prefix: str):
        return (F.col("gram") == F.col(f"{prefix}_gram")) & (F.col("context") == F.col(f"{prefix}_context")) & (F.col("check") == F.col(f"{prefix}_check"))

    def named(rows: DataFrame, prefix: str) -> DataFrame:
        return rows.withColumnsRenamed({c: f"{prefix}_{c}" for c in key})

    lone = some.join(named(classes.where("n > 1").select(*key), "k").hint("merge"), same("k"), "left_semi")
    found = named(offsets, "f").withColumnsRenamed({"first": "o1", "last": "o2"})
    part = some.join(found.hint("merge"), same("f"))
    starts = lone.select("doc_id", "th", "first", "last").unionByName(
        part.select("doc_id", "th", (F.col("at") - F.col("o2")).alias("first"), (F.col("at") - F.col("o1")).alias("last"))
    )
    gone = starts.groupBy(F.col("doc_id").alias("g_id"), F.col("th").alias("g_th")).agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
    gone = stages.keep(gone, "gone")
    stages.drop("some", "classes", "offsets")
    out = docs.join(gone.hint("merge"), F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("th") == F.col("g_th")), "left")
    return out.select("doc_id", "text", "ranges").mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op6_query(docs: DataFrame) -> DataFrame:
    return dedup_bytes(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
