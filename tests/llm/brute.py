"""Plain restatements of operators, without the library's own functions."""

from __future__ import annotations

import base64
import re
from collections import defaultdict
from functools import lru_cache

import tiktoken
import xxhash

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
KINDS = ("assign", "access", "hex", "random")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def passes_quality(text):
    """The base rule."""
    ws = split(text)
    windows = defaultdict(list)
    for i in range(len(ws) - 7):
        windows[tuple(ws[i : i + 8])].append(i)
    repeated = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return len(ws) >= 20 and 100 * len(repeated) <= 30 * len(ws)


def shingles(text, k):
    """All shingles of k words, repeats included; of fewer words the whole sequence."""
    ws = split(lower(text))
    return [" ".join(ws[i : i + k]) for i in range(len(ws) - k + 1)] or ([" ".join(ws)] if ws else [])


def fingerprint(text, k=3, seeds=(42,)):
    """One whole number with 64 bits for each seed."""
    out = 0
    for n, seed in enumerate(seeds):
        hs = [xxhash.xxh64_intdigest(s.encode(), seed) for s in shingles(text, k)]
        out |= sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) << 64 * n
    return out


def components(ids, fps, bits=3):
    """For each document the least id that it reaches through fingerprints within so many bits, by all pairs."""
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    best = {}
    for i, d in enumerate(ids):
        if d is not None:
            best[find(i)] = min(best.get(find(i), d), d)
    return [best.get(find(i)) for i in range(len(ids))]


def holds(text, item):
    """Whether a text holds a test item: four fifths of its distinct shingles of five words."""
    own = set(shingles(item, min(5, max(1, len(split(item))))))
    k = min(5, max(1, len(split(item))))
    return bool(own) and len(own & set(shingles(text, k))) >= 0.8 * len(own) - 1e-9


@lru_cache
def _tokenizer():
    ranks = {}
    for line in open(VOCABULARY):
        piece, rank = line.split()
        ranks[base64.b64decode(piece)] = int(rank)
    return tiktoken.Encoding("brute", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})


def per_token(s):
    """Characters a token, in pieces of 512 characters."""
    return len(s) / sum(len(_tokenizer().encode_ordinary(s[i : i + 512])) for i in range(0, len(s), 512))


def secrets(text):
    """(start, kind, end) of all spans, sorted by start, then kind."""
    text, out = text or "", []
    for m in re.finditer(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 12:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    base = list(out)
    for m in re.finditer("[A-Za-z0-9+/_=-]+", text):
        s = m[0]
        parts = re.split("[-_/=+]", s)
        digest = len(s) in (32, 40, 56, 64, 96, 128) and (set(s) <= set("0123456789abcdef") or set(s) <= set("0123456789ABCDEF"))
        uuid = re.fullmatch("[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}", s)
        wordlike = all(re.fullmatch("[A-Za-z]?[a-z]*|[A-Z]*|[0-9]*", p) for p in parts)
        if len(s) < 20 or digest or uuid or not re.search("[A-Za-z]", s) or per_token(s) > 2.1:
            continue
        if len(parts) > 1 and wordlike and all(len(p) <= 3 or p.isdigit() or per_token(p) > 2.1 for p in parts):
            continue
        if not any(a < m.end() and b > m.start() for a, _, b in base):
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def redacted(text):
    out, at = "", 0
    for a, kind, b in secrets(text):
        if a >= at:
            out += text[at:a] + f"[{KINDS[kind]}]"
        at = max(at, b)
    return out + text[at:]
