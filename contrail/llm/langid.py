"""Language identification by cross-parsing entropy.

Labelled text of each language makes a suffix automaton. A document is parsed against each:
the longest match with anything in a labelled text is a phrase, and parsing goes on behind
it (a character that the labelled texts lack is a phrase by itself). The language that needs
the fewest phrases, normalised, wins: phrases * log2(labelled characters) / characters.

Letters are lower-cased; all that isn't a letter counts as one space. Texts are parsed whole. So
that many characters are parsed at once, a text is cut into blocks that are parsed from the
automaton's start side by side; then every block is parsed again from the state in which the one
before it really ends, until both parses are in one state, from where on they are the same.

The labelled sample is at most SAMPLE_ROWS rows and SAMPLE_CHARS characters a language, the rows
with the least hashes of their ids, and all languages. It is the only thing that goes through the
driver. Automata are built once in a worker; one has some 60,000 states, each with its first move
in an array and its others in one sorted array, so a language takes about 2 MB however large its
alphabet is, and languages are parsed in turn. As far as TABLES bytes reach, moves are put into
full tables, which are quicker and give the same phrases.

Defined results. Null texts and texts without a letter are ``und`` with score 0. Without labelled
rows every text is ``und``. Ties go to the first language by code point. Score is the gap
between the two least entropies, relative to the second (1 with a single language). Repeated
rows count each; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import extended

SAMPLE_ROWS = 200
SAMPLE_CHARS = 30_000
#: Characters of a block, and of all blocks that are parsed side by side.
BLOCK = 1024
AT_ONCE = 1 << 21
#: Bytes of the full move tables that a worker holds; automata beyond that are searched in their arrays.
TABLES = 1 << 27


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point: itself in lower case (one character) if a letter, else a space."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def normal(text: str) -> np.ndarray:
    """Code points of a text, lower-cased letters with single spaces between."""
    cs = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    space = cs == 32
    return cs[~(space & np.concatenate(([True], space[:-1])))]


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """The transitions of the suffix automaton of a sequence; state 0 is the start."""
    moves, link, length, last = [{}], [-1], [0], 0
    for c in symbols:
        now = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = now
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
                link[q] = link[now] = twin
        last = now
    return moves


class Automaton:
    """The suffix automaton of a language's labelled texts in arrays; no match spans two of them."""

    def __init__(self, texts: list[np.ndarray]):
        alphabet = np.unique(np.concatenate(texts)) if texts else np.zeros(0, np.uint32)
        self.codes = np.zeros(int(alphabet[-1]) + 1 if len(alphabet) else 1, np.int32)  # 0: the texts lack it
        self.codes[alphabet] = np.arange(1, len(alphabet) + 1)
        self.width, symbols = len(alphabet) + 2, []
        for t in texts:
            symbols += [*self.codes[t].tolist(), self.width - 1]  # the last symbol stands between texts only
        self.bits = math.log2(max(2, sum(map(len, texts))))
        moves = automaton(symbols)
        self.start = np.zeros(self.width, np.int32)  # moves from the start; 0 for none
        self.symbol, self.to = np.full(len(moves), -1, np.int32), np.zeros(len(moves), np.int32)
        more = []
        for c, to in moves[0].items():
            self.start[c] = to
        for s in range(1, len(moves)):
            for k, (c, to) in enumerate(moves[s].items()):
                if k:
                    more.append((s * self.width + c, to))
                else:
                    self.symbol[s], self.to[s] = c, to
        more.sort()
        self.keys = np.array([*(k for k, _ in more), np.iinfo(np.int64).max], np.int64)
        self.others = np.array([*(to for _, to in more), 0], np.int32)
        self.table: np.ndarray | None = None

    def full_size(self) -> int:
        return 4 * len(self.to) * self.width

    def fill(self) -> None:
        """All moves in one table, by state and symbol: the next state, and above it the phrases that end."""
        n = len(self.to)
        table = np.tile(self.start + ((self.start == 0).astype(np.int32) << 28), (n, 1))
        table[1:] += 1 << 28
        own = np.flatnonzero(self.symbol >= 0)
        table[own, self.symbol[own]] = self.to[own]
        table = table.reshape(-1)
        table[self.keys[:-1]] = self.others[:-1]
        self.table = table

    def coded(self, text: np.ndarray) -> np.ndarray:
        return np.where(text < len(self.codes), self.codes[np.minimum(text, len(self.codes) - 1)], 0)

    def step(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states, and the phrases that end on the way: where a match can't go on, and at an unknown symbol."""
        if self.table is not None:
            entry = self.table[state * self.width + symbol]
            return entry & ((1 << 28) - 1), (entry >> 28).astype(np.uint8)
        next_, ended = self.to[state], np.zeros(len(state), np.uint8)
        odd = np.flatnonzero(self.symbol[state] != symbol)
        if len(odd):
            s, c = state[odd], symbol[odd]
            key = s.astype(np.int64) * self.width + c
            at = np.searchsorted(self.keys, key)
            found = self.keys[at] == key
            anew = self.start[c]
            next_[odd] = np.where(found, self.others[at], anew)
            ended[odd] = np.where(found, 0, (s > 0).astype(np.uint8) + (anew == 0))
        return next_, ended

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """The number of phrases of each text."""
        out, carried, some, held = np.zeros(len(texts), np.int64), {}, [], 0
        for i, t in enumerate(texts):
            for lo in range(0, len(t), BLOCK):
                some.append((i, lo))
                held += BLOCK
                if held >= AT_ONCE:
                    self._parse(texts, some, carried, out)
                    some, held = [], 0
        self._parse(texts, some, carried, out)
        for i, state in carried.items():
            out[i] += state > 0
        return out

    def _parse(self, texts, some: list[tuple[int, int]], carried: dict[int, int], out: np.ndarray) -> None:
        """Adds the phrases that end in these blocks to out; carried has the state behind each text's last block so far."""
        if not some:
            return
        lengths = np.array([min(BLOCK, len(texts[i]) - lo) for i, lo in some])
        order = np.argsort(-lengths, kind="stable")
        lengths, place = lengths[order], np.empty(len(some), np.int64)
        place[order] = np.arange(len(some))
        owner = np.array([i for i, _ in some])
        before = np.full(len(some), -1)  # the lane of the block before
        first = np.zeros(len(some), np.int32)  # or the state behind it
        for j, (i, lo) in enumerate(some):
            if lo and j and some[j - 1][0] == i:
                before[place[j]] = place[j - 1]
            elif lo:
                first[place[j]] = carried[i]
        symbols = np.zeros((int(lengths[0]), len(some)), np.int32)
        for lane, j in enumerate(order.tolist()):
            i, lo = some[j]
            symbols[: lengths[lane], lane] = self.coded(texts[i][lo : lo + BLOCK])
        states, ended = np.zeros(symbols.shape, np.int32), np.zeros(symbols.shape, np.uint8)
        alive = np.searchsorted(-lengths, -np.arange(1, len(symbols) + 1), "right")
        now = first.copy()
        for k in range(len(symbols)):
            now, ended[k, : alive[k]] = self.step(now[: alive[k]], symbols[k, : alive[k]])
            states[k, : alive[k]] = now
        used, ends = first.copy(), lengths - 1
        while True:
            starts = np.where(before >= 0, states[ends[before], before], first)
            lanes = np.flatnonzero(starts != used)
            if not len(lanes):
                break
            used = starts
            now = starts[lanes]
            for k in range(len(symbols)):
                now, phrases = self.step(now, symbols[k, lanes])
                apart = (states[k, lanes] != now) & (k < ends[lanes])
                states[k, lanes], ended[k, lanes] = now, phrases
                lanes, now = lanes[apart], now[apart]
                if not len(lanes):
                    break
        counts = ended.sum(axis=0, dtype=np.int64)
        np.add.at(out, owner[order], counts)
        for j, (i, _) in enumerate(some):
            carried[i] = int(states[ends[place[j]], place[j]])


class Model:
    """The automata of all languages."""

    def __init__(self, sample: tuple[tuple[str, str], ...]):
        by_lang: dict[str, list[np.ndarray]] = {}
        for lang, text in sample:
            by_lang.setdefault(lang, []).append(normal(text))
        self.langs = sorted(by_lang)
        self.automata = [Automaton([t for t in by_lang[x] if len(t)]) for x in self.langs]
        left = TABLES
        for a in self.automata:
            if a.full_size() <= left:
                left -= a.full_size()
                a.fill()

    def entropies(self, texts: list[np.ndarray]) -> np.ndarray:
        """(language, text): bits a character."""
        sizes = np.maximum(1, [len(t) for t in texts])
        out = np.zeros((len(self.langs), len(texts)))
        for k, a in enumerate(self.automata):
            out[k] = a.phrases(texts) * a.bits / sizes
        return out


@lru_cache(maxsize=2)
def model(sample: tuple[tuple[str, str], ...]) -> Model:
    return Model(sample)


def labelled_sample(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[tuple[str, str], ...]:
    """(language, text) of the bounded sample, from rows with a text and a language.

    Ranks within a language are cut in every task before they meet, so a large language costs
    SAMPLE_ROWS rows a task.
    """
    some = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    by = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "text")
    ranked = some.select("doc_id", F.col(lang).alias("lang"), F.substring(text, 1, SAMPLE_CHARS).alias("text"))
    ranked = ranked.withColumn("k", F.row_number().over(by)).where(F.col("k") <= SAMPLE_ROWS)
    rows = ranked.select("lang", "k", "text").collect()
    out, held = [], {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["k"])):
        if held.get(row["lang"], 0) < SAMPLE_CHARS:
            out.append((row["lang"], row["text"][: SAMPLE_CHARS - held.get(row["lang"], 0)]))
            held[row["lang"]] = held.get(row["lang"], 0) + len(out[-1][1])
    return tuple(out)


def predict(docs: DataFrame, sample: tuple[tuple[str, str], ...], text: str = "text") -> DataFrame:
    """docs without text, with lang_pred and score."""
    at = docs.columns.index(text)
    rest = docs.select([c for c in docs.columns if c != text])
    sent = docs.sparkSession.sparkContext.broadcast(sample)  # SAMPLE_CHARS for each language at most
    schema = extended(rest.schema, "lang_pred string, score double")

    def run(batches):
        for batch in batches:
            m = model(sent.value)
            langs, scores = [], []
            for lo in range(0, batch.num_rows, 1024):
                texts = [normal(t or "") for t in batch.column(at).slice(lo, 1024).to_pylist()]
                bits = m.entropies(texts)
                for i, t in enumerate(texts):
                    if not m.langs or not (t != 32).any():
                        langs.append("und")
                        scores.append(0.0)
                        continue
                    best = int(bits[:, i].argmin())
                    second = np.delete(bits[:, i], best).min() if len(m.langs) > 1 else math.inf
                    langs.append(m.langs[best])
                    scores.append(1.0 if second == math.inf else float((second - bits[best, i]) / second) if second else 0.0)
            own = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*own, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def op3_query(docs: DataFrame) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
    sample = labelled_sample(docs.where(~held_out))
    return predict(docs.select("doc_id", held_out.alias("held_out"), "text"), sample)
