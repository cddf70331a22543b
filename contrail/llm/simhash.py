"""SimHash near-duplicates through pivot distance tables.

A fingerprint has 64 bits for each seed; two fingerprints link at ``max_bits`` or fewer differing
bits. A Plan has shingle length, seeds and limit: CONTRACT is 3 words, 64 bits and 3 bits; SIMILAR,
for deduplication, is 5 words and 128 bits, of which the limit allows what texts with four
fifths of their shingles in common are expected to differ in.

Pivot tables. REFERENCES random fingerprints are the pivots. For the fingerprints that may link,
a table of their Hamming distances to all pivots is computed once. Distances obey the triangle
inequality, so two fingerprints differ in at least their largest coordinate difference; pairs
for which that exceeds the limit are discarded, and survivors are verified by their bits.

Who may link. Distances to pivots of 64 random bits crowd around 32, so one coordinate parts only
half of all pairs: pivots can discard pairs, but can't deal fingerprints out to tasks. Bits do
that. Under CONTRACT 3 differing bits leave two of five bands alike: each distinct fingerprint is
dealt out under every two bands (ten keys), and pairs are looked at inside a key only. A key with
more than LIMIT fingerprints is cut finer by the same argument on its other bits, as often as
needed: those are halved into four bands of which one must be alike, until few enough remain or
so few bits that no more than LIMIT can differ. So no pair is lost and no group is large. Under
SIMILAR the limit is too wide for equal bands, but not for close ones: of 22 differing bits at most
11 are in the first 64 or at most 10 in the others, and of 11 at most 2 are in one of four bands of
16, of 10 at most 2 in one of three or 1 in the fourth. So a fingerprint meets, band by band,
those whose band differs in so few bits: 1.5 per cent of all if bits are random. Bands decide what
is looked at inside a task only; fingerprints are dealt out by a hash in chunks, and every two
chunks meet in one cell of a grid, so whatever bits crowd, tasks are alike and no pair is lost. The
work grows with the square of the number of distinct fingerprints, by a small factor.

Copies have one fingerprint and are one class before any of this; links inside a key are reduced
to a spanning forest; components are then found over classes.

Defined results. Null and empty texts have fingerprint zero, linked like any other. Repeated
rows are documents of their own. A null doc_id counts for no class's least doc_id. An empty
table gives an empty result. Other columns are left alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stages, extended
from .graph import components

SEED = 42
BANDS = 5
REFERENCES = 16
#: Fingerprints under one key that are compared in one go, AT_ONCE pairs at a time.
LIMIT = 4096
#: Pairs that are compared at once.
AT_ONCE = 1 << 20
#: Rows of a key up to which all its pairs are compared together with those of other keys.
FEW = 16
#: Fingerprints of a chunk of the grid at most, give or take; the fewest for which it is cut to keep all tasks busy.
CHUNK, CHUNK_LEAST = 1 << 19, 1 << 14
#: Pairs that a cell looks at together: what the processor's cache holds.
LOOK = 1 << 16
_EDGES = [64 * b // BANDS for b in range(BANDS + 1)]
_MASK = (1 << 64) - 1


@dataclass(frozen=True)
class Plan:
    shingle: int = 3
    seeds: tuple[int, ...] = (SEED,)
    max_bits: int = 3
    references: int = REFERENCES

    @property
    def width(self) -> int:
        return len(self.seeds)

    @property
    def names(self) -> list[str]:
        return [f"f{i}" for i in range(self.width)]


CONTRACT = Plan()
#: Texts of n shingles each that share s: cosine s/n, Jaccard s/(2n-s). At 0.8 the cosine is 8/9, so
#: acos(8/9)/pi = 0.15 of all bits differ, 19.4 of 128, give or take 4. So similarity is judged by an
#: estimate: pairs of 0.9 or more all but always link, of 0.5 or less all but never.
SIMILAR = Plan(5, (SEED, SEED + 1), 22, 2)


def fingerprint(text: str | None, plan: Plan = CONTRACT) -> tuple[int, ...]:
    """The fingerprint of one text, 64 bits for each seed, unsigned."""
    ws = (text or "").encode().lower().split()
    if not ws:
        return (0,) * plan.width
    k = plan.shingle
    n = max(1, len(ws) - k + 1)
    counts = np.zeros(64 * plan.width, np.int64)
    for lo in range(0, n, 1 << 14):  # bounded memory for a long text
        some = [b" ".join(ws[i : i + k]) for i in range(lo, min(n, lo + (1 << 14)))]
        hs = np.array([[xxhash.xxh64_intdigest(x, seed) for x in some] for seed in plan.seeds], "<u8")
        bits = np.unpackbits(np.ascontiguousarray(hs.T).view(np.uint8).reshape(len(some), -1), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return tuple(np.packbits(counts * 2 > n, bitorder="little").view("<u8").tolist())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def with_fingerprint(docs: DataFrame, plan: Plan = CONTRACT, text: str = "text") -> DataFrame:
    """docs with the fingerprint as longs f0, f1 ..., instead of text."""
    schema, at = docs.drop(text).schema, docs.columns.index(text)
    names = schema.names

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), plan) for t in batch.column(at)], np.uint64).reshape(-1, plan.width).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(batch.columns) if i != at), *(pa.array(np.ascontiguousarray(x)) for x in fps.T)], names=[*names, *plan.names])

    return docs.mapInArrow(run, extended(schema, ", ".join(f"{x} long" for x in plan.names)))


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints, one a row."""
    return np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)


class Pivots:
    """Reference fingerprints, and the table of distances to them."""

    def __init__(self, plan: Plan):
        self.references = np.array(
            [[xxhash.xxh64_intdigest(f"reference {r} {w}", SEED) for w in range(plan.width)] for r in range(plan.references)], np.uint64
        )

    def table(self, fps: np.ndarray) -> np.ndarray:
        """(reference, fingerprint): Hamming distances."""
        return np.stack([distance(fps, r[None, :]) for r in self.references]).astype(np.int16)

    @staticmethod
    def left(table: np.ndarray, a: np.ndarray, b: np.ndarray, enough: int) -> np.ndarray:
        """Which pairs the coordinates can't discard; pivots in turn, on what is left."""
        left = np.arange(len(a))
        for row in table:
            left = left[np.abs(row[a[left]] - row[b[left]]) <= enough]
        return left


_pivots: dict[Plan, Pivots] = {}


def pivots(plan: Plan) -> Pivots:
    if plan not in _pivots:
        _pivots[plan] = Pivots(plan)
    return _pivots[plan]


def _find(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def linked(fps: np.ndarray, plan: Plan = CONTRACT) -> list[tuple[int, int]]:
    """A spanning forest (pairs of places) of the links among distinct fingerprints, one a row."""
    n, out = len(fps), []
    table, parent, root = pivots(plan).table(fps), list(range(len(fps))), np.arange(len(fps))
    lo, rows = 0, 1
    while lo < n - 1:  # a bounded number of pairs at once, few at first: one row of a close group joins all of it
        i = np.arange(lo, min(n - 1, lo + rows))
        counts = n - 1 - i
        a = np.repeat(i, counts)
        b = np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts) + a + 1
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
        left = Pivots.left(table, a, b, plan.max_bits)
        a, b = a[left], b[left]
        true = distance(fps[a], fps[b]) <= plan.max_bits
        a, b = a[true], b[true]
        _, first = np.unique(root[a] * n + root[b], return_index=True)
        for x, y in zip(a[first].tolist(), b[first].tolist()):
            p, q = _find(parent, x), _find(parent, y)
            if p != q:
                parent[max(p, q)] = min(p, q)
                out.append((x, y))
        if len(first):
            root = np.array(parent)
            while (root[root] != root).any():
                root = root[root]
        lo, rows = lo + rows, min(max(1, AT_ONCE // n), rows * 2)
    return out


def _rows(fps: np.ndarray, key: np.ndarray, rest: int) -> pa.RecordBatch:
    names = ["key", "rest", *(f"f{i}" for i in range(fps.shape[1]))]
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.full(len(fps), rest)), *(pa.array(np.ascontiguousarray(x).view(np.int64)) for x in fps.T)], names=names)


def _matrix(batch: pa.RecordBatch, first: int) -> np.ndarray:
    return np.stack([c.to_numpy(zero_copy_only=False).view(np.uint64) for c in batch.columns[first:]], axis=1)


def _hashed(values: np.ndarray, salt: int) -> np.ndarray:
    x = values * np.uint64(0x9E3779B97F4A7C15) + np.uint64((salt * 0xD6E8FEB86659FD93) & _MASK)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(29))


def _keys(it):
    """(f0) -> (key, rest, f0): rest has the bits on which the fingerprints of a key may differ."""
    for batch in it:
        fps = _matrix(batch, 0)
        for k, (a, b) in enumerate(combinations(range(BANDS), 2)):
            own = sum(((1 << (_EDGES[x + 1] - _EDGES[x])) - 1) << _EDGES[x] for x in (a, b))
            yield _rows(fps, _hashed(fps[:, 0] & np.uint64(own), k), _signed(_MASK & ~own))


def _finer(plan: Plan):
    """The same for the rows of a key with too many: four bands of the other bits, one of them alike."""

    def run(it):
        n = plan.max_bits + 1
        for batch in it:
            for key, rest, fp in zip(*(batch.column(i).to_pylist() for i in range(3))):
                bits = [i for i in range(64) if rest >> i & 1]
                out = []
                for k in range(n):
                    mask = sum(1 << i for i in bits[len(bits) * k // n : len(bits) * (k + 1) // n])
                    out.append((_signed(xxhash.xxh64_intdigest(f"{key} {k} {fp & mask}")), _signed(rest & _MASK & ~mask), fp))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["key", "rest", "f0"])

    return run


def _node(fps: np.ndarray) -> np.ndarray:
    """A fingerprint as one long: itself, or a hash of more than one."""
    return (fps[:, 0] if fps.shape[1] == 1 else _hashed(_hashed(fps[:, 0], 1) ^ fps[:, 1], 2)).view(np.int64)


def _links(keys: np.ndarray, fps: np.ndarray, plan: Plan):
    """Links (as two arrays of nodes) among the rows of each key; keys are sorted.

    Keys with few rows, the most by far, are compared all at once, a distance of places at a time.
    """
    cuts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))
    sizes = np.diff(cuts)
    few = np.repeat((sizes > 1) & (sizes <= FEW), sizes)
    at = np.flatnonzero(few)
    if len(at):
        keys_few, some = keys[at], fps[at]
        table = pivots(plan).table(some)
        for step in range(1, FEW):
            a = np.flatnonzero(keys_few[step:] == keys_few[:-step])
            if not len(a):
                break
            left = Pivots.left(table, a, a + step, plan.max_bits)
            a = a[left]
            a = a[distance(some[a], some[a + step]) <= plan.max_bits]
            if len(a):
                yield _node(some[a]), _node(some[a + step])
    for j in np.flatnonzero(sizes > FEW).tolist():
        own = fps[cuts[j] : cuts[j + 1]]
        if found := linked(own, plan):
            u, v = (_node(own[list(x)]) for x in zip(*found))
            yield u, v


def _pairs(plan: Plan):
    """Rows (key, f0 ...) sorted by key -> links (u, v) of nodes. Rows of a key that may go on are held."""

    def run(it):
        keys, fps = np.zeros(0, np.int64), np.zeros((0, plan.width), np.uint64)

        def batch_of(u, v):
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        for batch in it:
            if not batch.num_rows:
                continue
            keys = np.concatenate((keys, batch.column(0).to_numpy(zero_copy_only=False)))
            fps = np.concatenate((fps, _matrix(batch, 1)))
            whole = int(np.searchsorted(keys, keys[-1], "left"))
            for u, v in _links(keys[:whole], fps[:whole], plan):
                yield batch_of(u, v)
            keys, fps = keys[whole:], fps[whole:]
        if len(keys) > 1:
            for u, v in _links(keys, fps, plan):
                yield batch_of(u, v)

    return run


def _parts(total: int, n: int) -> list[int]:
    return [total // n + (i < total % n) for i in range(n)]


def _close(plan: Plan):
    """(word, its limit, band of 16 bits, masks): two that link are within a word's limit, and differ in one of its bands by a mask."""
    for w, within in enumerate(_parts(plan.max_bits + 1, plan.width)):
        for band, some in enumerate(_parts(within, 4)):
            masks = [sum(1 << i for i in bits) for k in range(some) for bits in combinations(range(16), k)]
            yield w, within - 1, band, np.array(masks, np.uint16)


class _Forest:
    """Links that join what was apart, of those added; root is brought up to date where many have come."""

    def __init__(self, n: int):
        self.root, self.parent, self.new = np.arange(n, dtype=np.int32), {}, []

    def find(self, i: int) -> int:
        while (j := self.parent.get(i, i)) != i:
            self.parent[i] = self.parent.get(j, j)
            i = j
        return i

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        p, q = self.root[a], self.root[b]
        _, first = np.unique(np.minimum(p, q) * np.int64(len(self.root)) + np.maximum(p, q), return_index=True)
        old = len(self.new)
        for x, y, i, j in zip(p[first].tolist(), q[first].tolist(), a[first].tolist(), b[first].tolist()):
            x, y = self.find(x), self.find(y)
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                self.new.append((i, j))
        if len(self.new) > old:
            least = np.arange(len(self.root), dtype=np.int32)
            for i in list(self.parent):
                least[i] = self.find(i)
            self.root = least[self.root]
            self.parent = {}


def met(x: np.ndarray, y: np.ndarray | None, plan: Plan) -> list[tuple[int, int]]:
    """A spanning forest of the links between x and y, or within x if y is None; places in y go on after those in x."""
    within = y is None
    n, fps = len(x), x if within else np.concatenate((x, y))
    table, forest, held, count = pivots(plan).table(fps), _Forest(len(fps)), [], 0

    def flush():
        if held:
            forest.add(*(np.concatenate(z) for z in zip(*held)))
            held.clear()

    for w, limit, band, masks in _close(plan):
        bands = (fps[:, w] >> np.uint64(16 * band)).astype(np.uint16)
        order = np.argsort(bands[:n], kind="stable")
        other = order if within else n + np.argsort(bands[n:], kind="stable")
        own, own_word, word = bands[order], fps[order, w], fps[other, w]
        sizes = np.bincount(bands[other], minlength=1 << 16)
        starts = np.cumsum(sizes) - sizes
        for mask in masks:
            key = own ^ mask
            hits = np.flatnonzero(sizes[key] if not within or not mask else sizes[key] * (own < key))
            if not len(hits):
                continue
            key = key[hits]
            own_hits, some = own_word[hits], sizes[key]
            ends = np.cumsum(some)
            shift = starts[key] - ends + some
            lo = 0
            while lo < len(hits):  # as many as come to LOOK pairs, one at least
                base = int(ends[lo - 1]) if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, base + LOOK, "right")))
                at = np.arange(base, int(ends[hi - 1])) + np.repeat(shift[lo:hi], some[lo:hi])
                near = np.flatnonzero(np.bitwise_count(np.repeat(own_hits[lo:hi], some[lo:hi]) ^ word[at]) <= limit)
                if len(near):
                    a, b = order[hits[np.searchsorted(ends, base + near, "right")]], other[at[near]]
                    apart = forest.root[a] != forest.root[b]
                    a, b = a[apart], b[apart]
                    left = Pivots.left(table, a, b, plan.max_bits)
                    a, b = a[left], b[left]
                    true = distance(fps[a], fps[b]) <= plan.max_bits
                    if true.any():
                        held.append((a[true], b[true]))
                        count += int(true.sum())
                        if count >= LOOK:
                            flush()
                            count = 0
                lo = hi
        flush()
        count = 0
    return forest.new


def _cells(plan: Plan):
    """Rows (cell, second, f0 ...) sorted by cell -> links (u, v) of nodes; second: 0 or 1 for a cell's two chunks, -1 for its only one."""

    def links(second, fps):
        x, y = fps[second != 1], fps[second == 1]
        both = np.concatenate((x, y))
        found = met(x, None if second[0] < 0 else y, plan) if len(x) and (len(y) or second[0] < 0) else []
        if found:
            u, v = (_node(both[list(z)]) for z in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    def run(it):
        cell, parts = None, []
        for batch in it:
            cells = batch.column(0).to_numpy(zero_copy_only=False)
            second, fps = batch.column(1).to_numpy(zero_copy_only=False), _matrix(batch, 2)
            cuts = np.concatenate(([0], np.flatnonzero(cells[1:] != cells[:-1]) + 1, [len(cells)])) if len(cells) else []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if parts and cells[lo] != cell:
                    yield from links(*(np.concatenate(z) for z in zip(*parts)))
                    parts = []
                cell = cells[lo]
                parts.append((second[lo:hi], fps[lo:hi]))
        if parts:
            yield from links(*(np.concatenate(z) for z in zip(*parts)))

    return run


def _grid_links(distinct: DataFrame, stages: Stages, plan: Plan) -> DataFrame:
    """(u, v) for a limit of any width: chunks by a hash, every two of them in a cell."""
    tasks, n = max(1, int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))), distinct.count()
    g = max(1, -(-n // CHUNK), min(math.isqrt(2 * tasks), n // CHUNK_LEAST))
    chunk, other = F.col("chunk"), F.col("other")
    rows = distinct.select(*plan.names, F.pmod(F.xxhash64(*plan.names), F.lit(g)).cast("int").alias("chunk"))
    rows = rows.select(*plan.names, "chunk", F.explode(F.sequence(F.lit(0), F.lit(g - 1))).alias("other"))
    first, last = F.least(chunk, other), F.greatest(chunk, other)
    cell = (last * (last + 1) / 2 + first).cast("int")  # 0, 1, 2 ... without gaps
    second = F.when(chunk == other, -1).otherwise((chunk > other).cast("int"))
    dealt = rows.select(cell.alias("cell"), second.cast("int").alias("second"), *plan.names).repartitionById(g * (g + 1) // 2, F.col("cell"))
    return stages.keep(dealt.sortWithinPartitions("cell").mapInArrow(_cells(plan), "u long, v long").distinct(), "links")


def fingerprint_links(distinct: DataFrame, stages: Stages, plan: Plan = CONTRACT) -> DataFrame:
    """(u, v): links of nodes that connect what the links at max_bits connect; distinct has f0 ..."""
    if (plan.width, plan.max_bits) != (1, 3):
        return _grid_links(distinct, stages, plan)
    schema = "key long, rest long, " + ", ".join(f"{x} long" for x in plan.names)
    keyed = stages.keep(distinct.select(*plan.names).mapInArrow(_keys, schema), "keys")
    small, level, drop = [], 0, ["keys"]
    while True:
        sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.first("rest").alias("r")).where("n > 1")
        # with few bits left no more than LIMIT fingerprints can differ, whatever the count
        many = stages.keep(sizes.where((F.col("n") > LIMIT) & (F.bit_count("r") > 12)).select("key"), f"many-{level}")
        if many.isEmpty():
            small.append(keyed)
            break
        small.append(keyed.join(many, "key", "left_anti"))
        level += 1
        keyed = stages.keep(keyed.join(many, "key", "left_semi").mapInArrow(_finer(plan), schema), f"keys-{level}")
        drop.append(f"keys-{level}")
    rows = small[0]
    for more in small[1:]:
        rows = rows.unionByName(more)
    n = max(1, int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    links = rows.select("key", *plan.names).repartition(n, "key").sortWithinPartitions("key").mapInArrow(_pairs(plan), "u long, v long")
    out = stages.keep(links.distinct(), "links")
    stages.drop(*drop, *(f"many-{i}" for i in range(level + 1)))
    return out


def _named(nodes):
    """(f0 ...) -> (f0 ..., node)."""
    for batch in nodes:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_node(_matrix(batch, 0)))], names=[*batch.schema.names, "node"])


def _grouped(docs: DataFrame, stages: Stages, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """(doc_id, th, f0 ...) for each row of (doc_id, text), and (c_f0 ..., root) for each distinct fingerprint."""
    own = stages.keep(with_fingerprint(docs.select("doc_id", F.xxhash64("text").alias("th"), "text"), plan), "fingerprints")
    classes = own.select(*plan.names).distinct()
    classes = stages.keep(classes.withColumn("node", F.col("f0")) if plan.width == 1 else classes.mapInArrow(_named, ", ".join(f"{x} long" for x in [*plan.names, "node"])), "classes")
    roots = components(fingerprint_links(classes, stages, plan), stages).withColumnRenamed("node", "r_node")
    rooted = classes.join(roots, F.col("node") == F.col("r_node"), "left")
    return own, rooted.select(*(F.col(x).alias(f"c_{x}") for x in plan.names), F.coalesce("root", "node").alias("root"))


def _with_root(own: DataFrame, rooted: DataFrame, plan: Plan) -> DataFrame:
    on = F.lit(True)
    for x in plan.names:
        on = on & (F.col(x) == F.col(f"c_{x}"))
    return own.join(rooted, on)


def near_duplicates(docs: DataFrame, plan: Plan = CONTRACT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, f0 ..., component_id) for each row of docs."""
    stages = Stages(docs.sparkSession)
    own, rooted = _grouped(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), stages, plan)
    rooted = stages.keep(rooted, "rooted")
    least = own.groupBy(*plan.names).agg(F.min("doc_id").alias("least"))  # combined before the shuffle
    ids = _with_root(least, rooted, plan).groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, F.col("root") == F.col("r")).drop("root", "r")
    return _with_root(own, stages.keep(named, "components"), plan).select("doc_id", *plan.names, "component_id")


def keep_one(docs: DataFrame, plan: Plan = SIMILAR) -> DataFrame:
    """Of each component the row with the least (doc_id, hash of the text); rows without a doc_id stay.

    Of rows alike in both one stays.
    """
    stages = Stages(docs.sparkSession)
    own, rooted = _grouped(docs.select("doc_id", "text"), stages, plan)
    kept = _with_root(own.where("doc_id is not null"), rooted, plan).groupBy("root").agg(F.min(F.struct("doc_id", "th")).alias("one"))
    kept = stages.keep(kept.select(F.col("one.doc_id").alias("simhash_id"), F.col("one.th").alias("simhash_th")), "kept")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.where("doc_id is not null").select(F.struct(*columns).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("th"))
    found = rows.join(kept, (F.col("id") == F.col("simhash_id")) & (F.col("th") == F.col("simhash_th")), "left_semi").dropDuplicates(["id", "th"])
    return found.select("row.*").unionByName(docs.where("doc_id is null"))


def op9_query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")
