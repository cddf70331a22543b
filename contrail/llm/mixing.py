"""Mixing sources to target weights.

1. Words of a source are laid end to end, documents in a fixed pseudorandom order, and cut into
   blocks of ``block`` words. Offsets come from sums by (source, chunk of documents), then
   within a chunk, so that no task holds a whole source.
2. A source's target is its weighted share of ``share`` times all words, at most ``cap`` times
   its own; what is above is shared again by weight (water filling, in closed form).
3. The target fixes the source's number of slots, its quota. Every output shard of ``shard`` slots
   draws its source counts from a multinomial: each of its slots draws a source, with odds as the
   quotas, by a hash of shard and place. A draw is its source's next slot. Draws beyond a quota,
   which come in the last shards, go to sources that were drawn too seldom; so targets are met.
4. Slot j of a source takes block perm(j mod n), with a new permutation for each pass over the
   source's n blocks. Slots and blocks are joined by index. blocks() has the shards with their
   words; what is taken from a document is the sum over its blocks in all shards.

Running sums over shards and documents are taken in groups first, then inside a group, so no task
has a whole source. Draws look up their source through cells of equal odds, a join on the cell.

Defined results. A null text has size 0. A null source is a source of its own, the last. A null
doc_id is kept. Repeated rows are documents of their own. A source without words has target 0.
Targets are met to a block (``block`` words) a source, so a source of one block is taken whole or
not at all in each pass. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Stages, let, words

WEIGHTS = (5, 2, 1)
BLOCK = 64
SHARD = 1024
#: Multipliers of the permutations, fixed primes of about 20 bits.
PRIMES = (1000003, 1000033, 1000037, 1000039, 1000081, 1000099, 1000117, 1000121)
#: Cells of equal odds in which a draw looks for its source.
CELLS = 1024
#: Shards whose counts are summed in one group.
_GROUP = 1 << 12


@dataclass
class Mixture:
    documents: DataFrame  #: doc_id, source, size, rank, start (offset in the source), source_size, target, and text if asked for
    sources: DataFrame  #: source, rank, source_size, target, n_blocks, n_slots (the quota), first_slot
    counts: DataFrame  #: shard, rank, n: the multinomial draw of each shard
    slots: DataFrame  #: shard, rank, slot (of the source), pass_no, block
    taken: DataFrame  #: documents with taken


def _multiplier(n: Column, offset: int) -> Column:
    ps = PRIMES[offset:] + PRIMES[:offset]
    out = F.lit(ps[-1]).cast("long")
    for p in reversed(ps[:-1]):
        out = F.when(n % p != 0, F.lit(p).cast("long")).otherwise(out)
    return out


def _offset(seed: Column, part: int, n: Column) -> Column:
    return F.conv(F.substring(F.md5(seed.cast("string")), 1 + 8 * part, 8), 16, 10).cast("long") % n


def permuted(x: Column, n: Column, seed: Column) -> Column:
    """A permutation of 0..n-1 at x: affine steps modulo n with unshuffles between them."""

    def affine(y: Column, multiplier: int, part: int) -> Column:
        return (y % n * _multiplier(n, multiplier) + _offset(seed, part, n)) % n

    def unshuffle(y: Column) -> Column:
        half = F.floor((n + 1) / 2)
        return F.when(y % 2 == 0, F.floor(y / 2)).otherwise(half + F.floor((y - 1) / 2))

    return affine(unshuffle(affine(unshuffle(affine(x, 0, 0)), 3, 1)), 5, 2)


def _sources(sizes: DataFrame, share: float, cap: float) -> DataFrame:
    """One row a source with its target. Windows here run over sources, not documents."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    s = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    s = s.withColumn("rank", F.row_number().over(by_name).cast("long"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.col("rank") - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    s = s.withColumn("weight", weight.cast("long"))
    before = Window.orderBy(F.col("source_size") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * cap
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    s = s.withColumn("level", left / weights).withColumn("full", F.col("source_size") * cap < F.col("level") * F.col("weight"))
    level = F.min(F.when(~F.col("full"), F.struct(F.col("source_size") / F.col("weight"), "rank", "level"))).over(everything)["level"]
    target = F.when(F.col("full"), F.col("source_size") * cap).otherwise(F.least(level * F.col("weight"), F.col("source_size") * cap))
    return s.withColumn("target", target.cast("double")).drop("level", "full")


def draw_counts(sources: DataFrame, n_all: int, shard: int = SHARD) -> DataFrame:
    """(shard, rank, n): a multinomial draw of each shard's source counts, odds as n_slots.

    sources has rank, first_slot and n_slots; n_all is their sum. Shards are made in parallel and
    counted where they are made.
    """
    spark = sources.sparkSession
    u_of = lambda h, k: F.conv(F.substring(h, 1 + 16 * k, 15), 16, 10).cast("long") % n_all  # noqa: E731  60 bits each
    halves = spark.range(math.ceil(n_all / shard)).select(
        F.col("id").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit((shard - 1) // 2))).alias("half")
    )
    hashed = halves.select("shard", "half", F.md5(F.concat_ws(":", F.lit("draw"), "shard", "half").cast("binary")).alias("h"))
    drawn = hashed.select("shard", F.inline(F.array(*(F.struct((F.col("half") * 2 + k).alias("place"), u_of(F.col("h"), k).alias("u")) for k in (0, 1)))))
    drawn = drawn.where((F.col("place") < shard) & (F.col("shard") * shard + F.col("place") < n_all))
    cell = lambda x: F.floor(x * CELLS / n_all)
    ends = F.col("first_slot") + F.col("n_slots")
    cells = sources.where("n_slots > 0").select(
        "rank", F.col("first_slot").alias("from_u"), ends.alias("to_u"), F.explode(F.sequence(cell(F.col("first_slot")), cell(ends - 1))).alias("c_cell")
    )
    found = drawn.withColumn("cell", cell(F.col("u"))).join(cells, (F.col("cell") == F.col("c_cell")) & (F.col("u") >= F.col("from_u")) & (F.col("u") < F.col("to_u")))
    return found.groupBy("shard", "rank").agg(F.count(F.lit(1)).alias("n"))


def _dealt(counts: DataFrame, sources: DataFrame) -> DataFrame:
    """(shard, rank, slot): all slots 0 .. n_slots - 1 of each source, in the shards that drew them or make up for others."""
    grouped = counts.withColumn("g", F.floor(F.col("shard") / _GROUP))
    groups = grouped.groupBy(F.col("rank").alias("g_rank"), F.col("g").alias("g_g")).agg(F.sum("n").alias("in_group"))
    groups = groups.withColumn("g_start", F.sum("in_group").over(Window.partitionBy("g_rank").orderBy("g_g")) - F.col("in_group"))
    inside = Window.partitionBy("rank", "g").orderBy("shard")
    began = grouped.withColumn("inside", F.sum("n").over(inside) - F.col("n")).join(groups, (F.col("rank") == F.col("g_rank")) & (F.col("g") == F.col("g_g")))
    began = began.select("shard", "rank", "n", (F.col("g_start") + F.col("inside")).alias("lo"))
    totals = counts.groupBy(F.col("rank").alias("t_rank")).agg(F.sum("n").alias("drawn"))
    by_rank = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)  # over sources, not slots
    quota = sources.join(totals, F.col("rank") == F.col("t_rank"), "left").select("rank", "n_slots", F.coalesce("drawn", F.lit(0)).alias("drawn"))
    quota = quota.withColumns({"over": F.greatest(F.col("drawn") - F.col("n_slots"), F.lit(0)), "under": F.greatest(F.col("n_slots") - F.col("drawn"), F.lit(0))})
    quota = quota.withColumns({"over_before": F.coalesce(F.sum("over").over(by_rank), F.lit(0)), "under_before": F.coalesce(F.sum("under").over(by_rank), F.lit(0))})
    q = quota.select(F.col("rank").alias("q_rank"), "n_slots", "over_before")
    n_tasks = max(1, int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # a number, or the few small rows meet in one task
    drawn = began.join(q, F.col("rank") == F.col("q_rank")).repartition(n_tasks, "shard").withColumn("slot", F.explode(F.sequence("lo", F.col("lo") + F.col("n") - 1)))
    spare = drawn.where("slot >= n_slots").select("shard", (F.col("over_before") + F.col("slot") - F.col("n_slots")).alias("d"))
    wanted = quota.where("under > 0").select(F.col("rank").alias("w_rank"), "drawn", "under_before", F.explode(F.sequence("under_before", F.col("under_before") + F.col("under") - 1)).alias("w_d"))
    moved = spare.join(wanted, F.col("d") == F.col("w_d")).select("shard", F.col("w_rank").alias("rank"), (F.col("drawn") + F.col("w_d") - F.col("under_before")).alias("slot"))
    return drawn.where("slot < n_slots").select("shard", "rank", "slot").unionByName(moved)


def mix(docs: DataFrame, block: int = BLOCK, shard: int = SHARD, share: float = 1.5, cap: float = 2.0, texts: bool = False) -> Mixture:
    stages = Stages(docs.sparkSession)
    identity = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.coalesce("text", F.lit("")))).cast("binary"))
    sizes = stages.keep(
        docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"), identity.alias("at"), *(["text"] if texts else [])), "sizes"
    )
    sources = _sources(sizes, share, cap)
    n = F.ceil(F.col("source_size") / block).cast("long")
    slots = F.when(n > 0, F.least(F.floor(F.col("target") * n / F.col("source_size") + 0.5), F.floor(n * cap))).otherwise(0)
    sources = sources.withColumns({"n_blocks": n, "n_slots": slots.cast("long")})
    sources = stages.keep(sources.withColumn("first_slot", F.sum("n_slots").over(Window.orderBy("rank")) - F.col("n_slots")), "sources")
    n_docs, n_all = sizes.count(), sources.agg(F.sum("n_slots")).first()[0] or 0

    # documents lie in the order of ``at``; its first digits cut a source so that a piece has some ten thousand of them
    digits = max(3, math.ceil(math.log(max(1, n_docs) / 65536, 16)) + 1)
    sizes = sizes.withColumn("chunk", F.left("at", F.lit(digits)))
    chunks = sizes.groupBy("source", "chunk").agg(F.sum("size").alias("words"))
    chunks = chunks.withColumn(
        "chunk_start", F.sum("words").over(Window.partitionBy("source").orderBy("chunk")) - F.col("words")
    ).join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s", "words")
    c = chunks.select(F.col("source").alias("c_source"), F.col("chunk").alias("c_chunk"), "chunk_start", "rank", "source_size", "target")
    inside = Window.partitionBy("source", "chunk").orderBy("at", "size").rowsBetween(Window.unboundedPreceding, 0)
    documents = sizes.withColumn("ends", F.sum("size").over(inside)).join(
        c.hint("merge"), F.col("source").eqNullSafe(F.col("c_source")) & (F.col("chunk") == F.col("c_chunk"))
    ).withColumn("start", F.col("chunk_start") + F.col("ends") - F.col("size")).select(
        "doc_id", "source", "size", "rank", "start", "source_size", "target", *(["text"] if texts else [])
    )

    counts = stages.keep(draw_counts(sources, n_all, shard), "counts")
    dealt = _dealt(counts, sources).join(sources.select(F.col("rank").alias("s_rank"), "n_blocks"), F.col("rank") == F.col("s_rank"))
    pass_no = F.floor(F.col("slot") / F.col("n_blocks"))
    filled = dealt.select(
        "shard", "rank", "slot", pass_no.alias("pass_no"),
        permuted(F.col("slot") % F.col("n_blocks"), F.col("n_blocks"), F.concat_ws(":", "rank", pass_no)).alias("block"),
    )

    times = filled.groupBy(F.col("rank").alias("t_rank"), F.col("block").alias("t_block")).agg(F.count(F.lit(1)).alias("times"))
    pieces = documents.where("size > 0").drop("text").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)))
    ).withColumn(
        "inside", F.least((F.col("block") + 1) * block, F.col("start") + F.col("size")) - F.greatest(F.col("block") * block, F.col("start"))
    )
    keys = ["doc_id", "source", "size", "rank", "start", "source_size", "target"]
    used = pieces.join(times.hint("merge"), (F.col("rank") == F.col("t_rank")) & (F.col("block") == F.col("t_block")), "left")
    taken = used.groupBy(*keys).agg(F.sum(F.coalesce("times", F.lit(0)) * F.col("inside")).cast("long").alias("taken"))
    taken = taken.unionByName(documents.where("size = 0").drop("text").withColumn("taken", F.lit(0).cast("long")))
    return Mixture(documents, sources, counts, filled, taken)


def blocks(docs: DataFrame, block: int = BLOCK, shard: int = SHARD, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(shard, place, source, text): the mix itself, a block of ``block`` words (fewer at a source's end) for each slot."""
    m = mix(docs, block, shard, share, cap, texts=True)
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)

    def cut(ws: Column) -> Column:
        at = lambda b: F.greatest(b * block - F.col("start"), F.lit(0))
        return F.transform(F.sequence(first, last), lambda b: F.struct(
            b.alias("block"), at(b).alias("from"), F.array_join(F.slice(ws, (at(b) + 1).cast("int"), F.least((b + 1) * block - F.col("start"), F.col("size")).cast("int") - at(b).cast("int")), " ").alias("piece")
        ))

    pieces = m.documents.where("size > 0").select("rank", "source", "start", F.inline(let(words(F.col("text")), cut)))
    whole = pieces.groupBy("rank", "source", "block").agg(  # a block's pieces are block words at most
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((F.col("start") + F.col("from")).alias("at"), "piece"))), lambda p: p["piece"]), " ").alias("text")
    ).select(F.col("rank").alias("b_rank"), F.col("block").alias("b_block"), "source", "text")
    joined = m.slots.join(whole, (F.col("rank") == F.col("b_rank")) & (F.col("block") == F.col("b_block")))
    in_shard = Window.partitionBy("shard").orderBy(F.md5(F.concat_ws(":", "shard", "rank", "slot").cast("binary")), "rank", "slot")
    return joined.select("shard", (F.row_number().over(in_shard) - 1).alias("place"), "source", "text")


def op10_query(spark, docs: DataFrame) -> DataFrame:
    return mix(docs).taken.select("doc_id", "size", "source_size", "target", "taken")


def _sql_affine(y: str, multiplier: int, seed: str, part: int) -> str:
    ps = PRIMES[multiplier:] + PRIMES[:multiplier]
    m = "CASE " + " ".join(f"WHEN n % {p} <> 0 THEN {p}" for p in ps[:-1]) + f" ELSE {ps[-1]} END"
    return f"((({y}) % n) * ({m}) + ('0x' || substr(md5({seed}), {1 + 8 * part}, 8))::BIGINT % n) % n"


def _sql_unshuffle(y: str) -> str:
    return f"CASE WHEN ({y}) % 2 = 0 THEN ({y}) // 2 ELSE (n + 1) // 2 + (({y}) - 1) // 2 END"


OP10_SQL = rf"""
WITH z AS (SELECT row_number() OVER () AS rid, doc_id, source,
                  len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
                  md5(coalesce(doc_id::VARCHAR, 'text:' || coalesce(text, ''))) AS ord FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM z GROUP BY source),
s1 AS (SELECT *, [5, 2, 1][((rank - 1) % 3 + 1)::INT]::BIGINT AS weight FROM s0),
s2 AS (SELECT *, (sum(source_size) OVER () * 1.5 - coalesce(sum(source_size) OVER b, 0) * 2.0)::DOUBLE
                 / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS level FROM s1
       WINDOW b AS (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT *, source_size * 2.0::DOUBLE < level * weight AS full_up FROM s2),
s4 AS (SELECT *, (SELECT arg_min(level, (source_size / weight, rank)) FROM s3 WHERE NOT full_up) AS lv FROM s3),
s5 AS (SELECT *, CASE WHEN full_up THEN source_size * 2.0::DOUBLE ELSE least(lv * weight, source_size * 2.0::DOUBLE) END AS target,
              ceil(source_size / {BLOCK})::BIGINT AS n FROM s4),
s6 AS (SELECT *, CASE WHEN n > 0 THEN least(floor(target * n / source_size + 0.5), n * 2)::BIGINT ELSE 0 END AS n_slots FROM s5),
d AS (SELECT rid, doc_id, z.source, size, rank, source_size, target,
             (sum(size) OVER (PARTITION BY rank ORDER BY ord, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
      FROM z JOIN s6 ON z.source IS NOT DISTINCT FROM s6.source),
j AS (SELECT rank, n, u.slot, rank || ':' || (u.slot // n) AS seed FROM s6, unnest(range(n_slots)) AS u(slot)),
p1 AS (SELECT *, {_sql_affine("slot % n", 0, "seed", 0)} AS x1 FROM j),
p2 AS (SELECT *, {_sql_unshuffle("x1")} AS x2 FROM p1),
p3 AS (SELECT *, {_sql_affine("x2", 3, "seed", 1)} AS x3 FROM p2),
p4 AS (SELECT *, {_sql_unshuffle("x3")} AS x4 FROM p3),
p5 AS (SELECT rank, {_sql_affine("x4", 5, "seed", 2)} AS block FROM p4),
t AS (SELECT rank, block, count(*) AS times FROM p5 GROUP BY rank, block),
c AS (SELECT rid, sum(times * (least((u.b + 1) * {BLOCK}, start + size) - greatest(u.b * {BLOCK}, start)))::BIGINT AS taken
      FROM d, unnest(range(start // {BLOCK}, (start + size - 1) // {BLOCK} + 1)) AS u(b)
      JOIN t ON t.rank = d.rank AND t.block = u.b WHERE size > 0 GROUP BY rid)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM d LEFT JOIN c ON d.rid = c.rid
"""
