"""Secret scans: patterns, and strings that a tokenizer can't shorten.

Base spans come from three patterns. The method adds spans of kind ``random``: strings of
MIN_CHARS or more of ``[A-Za-z0-9+/_=-]`` whose characters per token under a byte-pair
vocabulary are at most MAX_RATIO. Words of a language take few tokens; random strings take
about one for every two characters. Known digests (32, 40, 56, 64, 96 or 128 hexadecimal
digits of one case, UUIDs) and identifiers (numbers; paths and names whose every part is a number,
of SHORT letters at most, or takes few tokens by itself as words do) are excluded, as are strings
that overlap a base span. Letters of one case are no identifier by that alone.

Defined results. A null text is empty: no spans. A long string is tokenized in pieces of PIECE
characters, all of them. Repeated rows count each; an empty table gives an empty result; other
columns are kept by scan() and clash with none, as its own names begin with ``s_``.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import extended

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MIN_CHARS = 20
MAX_RATIO = 2.1
PIECE = 512
SHORT = 3
KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_LONG = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_CHARS},}}")
_DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
_DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
_UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\Z")
_PLAIN = re.compile(r"[0-9+/_=-]*\Z")
_NAME = re.compile(r"(?:[A-Za-z]?[a-z]*|[A-Z]*|[0-9]*)(?:[-_/=+](?:[A-Za-z]?[a-z]*|[A-Z]*|[0-9]*))*\Z")
_JOINS = re.compile("[-_/=+]")
SCHEMA = "s_n_assign long, s_n_access long, s_n_hex long, s_base string, s_spans string"


@lru_cache(maxsize=2)
def encoding(path: str):
    """A byte-pair encoding from a file of ranks."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})


def known(s: str) -> bool:
    """Whether a string is a digest, a UUID or a number, so no secret by its looks alone."""
    return bool(len(s) in _DIGEST_LENGTHS and _DIGEST.match(s) or _UUID.match(s) or _PLAIN.match(s))


def ratio(s: str, path: str) -> float:
    """Characters per token."""
    pieces = [s[i : i + PIECE] for i in range(0, len(s), PIECE)]
    return len(s) / max(1, sum(map(len, encoding(path).encode_ordinary_batch(pieces, num_threads=1))))


def named(s: str, path: str, max_ratio: float) -> bool:
    """Whether a string is a path or name: all its parts are short, numbers or like words."""
    if not _JOINS.search(s) or not _NAME.match(s):
        return False
    return all(len(p) <= SHORT or p.isdigit() or ratio(p, path) > max_ratio for p in _JOINS.split(s))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end), sorted."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def random_spans(text: str, base: list[tuple[int, int, int]], path: str = VOCABULARY, max_ratio: float = MAX_RATIO) -> list[tuple[int, int, int]]:
    """The spans of the method that overlap none of base, which is sorted by start."""
    out, at, reach = [], 0, 0
    for m in _LONG.finditer(text):
        while at < len(base) and base[at][0] < m.end():  # both in order, so each base span is looked at once
            reach = max(reach, base[at][2])
            at += 1
        s = m[0]
        if reach > m.start() or known(s):
            continue
        if ratio(s, path) <= max_ratio and not named(s, path, max_ratio):
            out.append((m.start(), 3, m.end()))
    return out


def _digest(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, max_ratio: float = MAX_RATIO) -> DataFrame:
    """docs with s_n_<kind>, s_base and s_spans (kind:start:end by start, comma-joined)."""
    names = [f.name for f in docs.schema]
    at = names.index(text)

    def run(batches):
        for batch in batches:
            found = ([], [], [], [], [])
            for t in batch.column(at).to_pylist():
                base = base_spans(t) if t else []
                counts = [0, 0, 0]
                for _, k, _ in base:
                    counts[k] += 1
                more = random_spans(t, base, vocabulary, max_ratio) if t else []
                for column, value in zip(found, (*counts, _digest(base), _digest(sorted(base + more)))):
                    column.append(value)
            arrays = [pa.array(x, pa.int64()) for x in found[:3]] + [pa.array(x, pa.string()) for x in found[3:]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*names, "s_n_assign", "s_n_access", "s_n_hex", "s_base", "s_spans"])

    return docs.mapInArrow(run, extended(docs.schema, SCHEMA))


def redact(text: str, spans: str) -> str:
    """text with every span replaced by its kind in brackets; overlapping spans are one."""
    out, at = [], 0
    for kind, a, b in (x.split(":") for x in spans.split(",") if x):
        a, b = int(a), int(b)
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame) -> DataFrame:
    """docs with secrets in text replaced; all rows and columns stay."""
    names = [f.name for f in docs.schema]
    at = names.index("text")

    def run(batches):
        for batch in batches:
            texts = []
            for t in batch.column(at).to_pylist():
                base = base_spans(t) if t else []
                spans = sorted(base + random_spans(t, base)) if t else []
                texts.append(redact(t, _digest(spans)) if spans else t)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)], names=names)

    return docs.mapInArrow(run, docs.schema)


def op7_query(docs: DataFrame) -> DataFrame:
    return scan(docs.select("doc_id", "text")).select(
        "doc_id",
        F.col("s_n_assign").alias("n_assign"),
        F.col("s_n_access").alias("n_access"),
        F.col("s_n_hex").alias("n_hex"),
        F.sha2(F.encode("s_base", "UTF-8"), 256).alias("base_sha256"),
        F.col("s_spans").alias("spans"),
    )
