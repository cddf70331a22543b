"""Benchmark decontamination: which documents hold which test items.

A document holds an item if it has at least THRESHOLD of the item's distinct shingles of
SHINGLE words. Words are split at white space and lower-cased (A-Z). An item of fewer words is
one shingle of all its words.

Search. Items are partitioned by size: those whose number of shingles lies in (u/2, u] share
the size bound u. An item's sketch is a bottom-k MinHash: the k shingles with the least hashes,
k = floor((1 - THRESHOLD) * u) + 1. A document with enough of the item's shingles lacks fewer
than k of them, so it has one of the sketch: no holder is missed, however long the document and
wherever the shingles lie. Every shingle of every document is looked up in the sketches.
Candidates are verified by counting the item's shingles, as strings, in the document.

Items are taken in blocks of about BLOCK shingles, so what is sent to the executors has a fixed
bound; a larger benchmark takes more passes over the documents.

Defined results. Null or empty texts and items have no shingles and match nothing. Repeated
documents match each; repeated items too. A null doc_id or item_id is returned as null. An empty
table gives an empty result. Other columns are left alone.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import extended
from .textarrays import Words, parts, runs

SHINGLE = 5
THRESHOLD = 0.8
BLOCK = 400_000
HOLDS = "item_id long, item_shingles long, shared long, containment double"


def shingles(ws: list[bytes], k: int = SHINGLE) -> set[bytes]:
    return {b" ".join(ws[i : i + k]) for i in range(len(ws) - k + 1)}


def sketch_size(n: int) -> int:
    """k for an item with n shingles, from its partition's size bound."""
    bound = 1 << max(0, math.ceil(math.log2(n)))
    return min(n, math.floor((1 - THRESHOLD) * bound + 1e-9) + 1)


def _hashes(ws: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    starts = ws.run_starts(k)
    return starts, runs(ws.hashes(7), starts, k)


class Items:
    """A block of items, with the sketches of all of them in sorted arrays by shingle length."""

    def __init__(self, rows: list[tuple]):
        self.rows, sketch = [], defaultdict(list)
        for item_id, text in rows:
            ws = (text or "").encode().lower().split()
            if not ws:
                continue
            k = min(SHINGLE, len(ws))
            own = sorted(shingles(ws, k))
            data = np.frombuffer(b"\n".join(own), np.uint8)
            ends = np.cumsum([len(s) + 1 for s in own]) - 1
            _, hs = _hashes(Words(data, np.concatenate(([0], ends[:-1] + 1, [len(data)]))), k)
            i = len(self.rows)
            self.rows.append((item_id, k, frozenset(own)))
            sketch[k] += [(h, i) for h in sorted(set(hs.tolist()))[: sketch_size(len(own))]]
        self.sketch = {}
        for k, found in sketch.items():
            found.sort()
            self.sketch[k] = np.array([h for h, _ in found], np.uint64), np.array([i for _, i in found])

    def candidates(self, data: np.ndarray, offsets: np.ndarray) -> set[tuple[int, int]]:
        """(row, item) pairs that share a hash of a sketch."""
        ws, out = Words(data, offsets, lower=True), set()
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(ws.first))
        for k, (hashes, items) in self.sketch.items():
            starts, hs = _hashes(ws, k)
            lo = np.searchsorted(hashes, hs, "left")
            found = np.flatnonzero(hashes[np.minimum(lo, len(hashes) - 1)] == hs)
            for r, at, h in zip(row[starts[found]].tolist(), lo[found].tolist(), hs[found].tolist()):
                while at < len(hashes) and hashes[at] == h:
                    out.add((r, int(items[at])))
                    at += 1
        return out

    def verify(self, text: bytes, candidates: list[int]):
        """(item_id, shingles, shared, containment) of the candidates that the text holds."""
        ws, by_k = text.lower().split(), {}
        for i in candidates:
            item_id, k, own = self.rows[i]
            if k not in by_k:
                by_k[k] = shingles(ws, k)
            shared = len(own & by_k[k])
            if shared >= THRESHOLD * len(own) - 1e-9:
                yield item_id, len(own), shared, shared / len(own)


def _blocks(items: DataFrame, block: int) -> list[DataFrame]:
    """The items in parts of about ``block`` words at most."""
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = math.ceil(total / (5 * block)) or 1
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b) for b in range(n)]


def _search(docs: DataFrame, items: DataFrame, block: int, text: str, held: bool):
    """held: one row for each (document, item); else the documents' rows without any, unchanged."""
    names, at = docs.columns, docs.columns.index(text)
    schema = extended(docs.select([c for c in names if c != text]).schema, HOLDS) if held else docs.schema
    out = None
    for part in _blocks(items.select("item_id", "text"), block):
        sent = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in part.collect()])  # a bounded block

        def run(batches, sent=sent):
            found = Items(sent.value)
            for batch in batches:
                rows, hits = [], set()
                for lo, _, data, offsets in parts(batch.column(at)):
                    by_row = defaultdict(list)
                    for r, i in found.candidates(data, offsets):
                        by_row[r].append(i)
                    for r, some in by_row.items():
                        for hit in found.verify(data[offsets[r] : offsets[r + 1]].tobytes(), sorted(some)):
                            rows.append((lo + r, hit))
                            hits.add(lo + r)
                if held:
                    took = batch.take(pa.array([r for r, _ in rows], pa.int64()))
                    own = [c for i, c in enumerate(took.columns) if i != at]
                    new = [pa.array([h[j] for _, h in rows], kind) for j, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.float64()))]
                    yield pa.RecordBatch.from_arrays([*own, *new], names=schema.names)
                else:
                    yield batch.filter(pa.array([r not in hits for r in range(batch.num_rows)], pa.bool_()))

        now = (docs if held or out is None else out).mapInArrow(run, schema)
        out = now if out is None or not held else out.unionByName(now)
    return out


def contained_items(docs: DataFrame, items: DataFrame, block: int = BLOCK) -> DataFrame:
    """The columns of docs without text, and HOLDS: a row for each item that a document holds."""
    return _search(docs, items, block, "text", True)


def decontaminate(docs: DataFrame, items: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of docs that hold no item."""
    return _search(docs, items, block, "text", False)


def op4_query(docs: DataFrame, items: DataFrame) -> DataFrame:
    return contained_items(docs.select("doc_id", "text"), items)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP4_SQL = rf"""
WITH i AS (SELECT row_number() OVER () AS iid, item_id,
                  list_filter(string_split_regex({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM benchmark),
d AS (SELECT row_number() OVER () AS rid, doc_id,
             list_filter(string_split_regex({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
si AS (SELECT DISTINCT iid, item_id, least(len(ws), 5) AS k, array_to_string(ws[p:p + least(len(ws), 5) - 1], ' ') AS s
       FROM i, unnest(range(1, len(ws) - least(len(ws), 5) + 2)) AS u(p) WHERE len(ws) > 0),
ks AS (SELECT DISTINCT k FROM si),
sd AS (SELECT DISTINCT rid, doc_id, k, array_to_string(ws[p:p + k - 1], ' ') AS s
       FROM d, ks, unnest(range(1, len(ws) - k + 2)) AS u(p) WHERE len(ws) >= k),
n AS (SELECT iid, count(*) AS n FROM si GROUP BY iid),
m AS (SELECT rid, doc_id, si.iid, item_id, count(*) AS shared FROM si JOIN sd ON si.k = sd.k AND si.s = sd.s GROUP BY ALL)
SELECT doc_id, item_id, n::BIGINT AS item_shingles, shared::BIGINT AS shared, shared / n AS containment
FROM m JOIN n ON m.iid = n.iid WHERE shared >= 0.8 * n - 1e-9
"""
