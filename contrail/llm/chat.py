"""Chat formatting: multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered with that speaker as the
assistant and the others as named users; system turns stay system turns and aren't rotated.
A mask has the spans of the assistant's contents, the only ones to train on.

A rendering has the whole dialogue, in one row for each (conversation, participant); a caller may
ask for rows of ``segment`` turns each instead. Turns are in the order of their number, then role,
then text. They are numbered by a sort that may go to disk, and rendered in pieces of PIECE turns;
what meets in one task in the end are the pieces of one row, so a group is as large as its row.

Format of a turn: ``<|im_start|>assistant``, ``<|im_start|>user name=NAME`` or
``<|im_start|>system``, a line feed, the text, ``<|im_end|>``, a line feed. ``<|`` inside a text
or name becomes ``< |``, so a text can't end its turn or open another; white space in a name
becomes ``_``.

Defined results. A null text is an empty one; a null or empty role is the participant
``unknown``; a null turn counts as 0. A null conv_id is a conversation by itself. Repeated rows
are turns of their own. A conversation of system turns only has no participant and gives no
rows. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, prefix_sums

#: Turns that are rendered at once.
PIECE = 256


def _safe(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def rotate(turns: DataFrame, segment: int | None = None) -> DataFrame:
    """(conv_id, participant, segment, n_turns, n_own, text, mask): mask has start:end, comma-joined, in code points.

    segment is 0 everywhere unless rows of that many turns are asked for.
    """
    name = F.regexp_replace(F.coalesce(F.when(F.trim("role") != "", F.col("role")), F.lit("unknown")), r"[\x20\x09-\x0D]+", "_")
    rows = turns.select(
        "conv_id", F.coalesce(F.col("turn"), F.lit(0)).cast("long").alias("turn"), _safe(name).alias("role"), _safe(F.coalesce("text", F.lit(""))).alias("text")
    )
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")  # sorted on disk if large, never gathered
    rows = rows.withColumn("k", (F.row_number().over(in_order) - 1).cast("long"))
    cut = F.floor(F.col("k") / segment) if segment else F.lit(0).cast("long")
    piece = F.floor((F.col("k") - F.col("segment") * (segment or 0)) / PIECE)
    # participants of a whole conversation: a set of names, reduced before the shuffle
    people = rows.where("role <> 'system'").select(F.col("conv_id").alias("p_conv"), F.col("role").alias("participant")).distinct()
    pieces = rows.withColumn("segment", cut).withColumn("piece", piece).groupBy("conv_id", "segment", "piece").agg(
        F.array_sort(F.collect_list(F.struct("k", "role", "text"))).alias("turns")
    )
    each = pieces.join(people, F.col("conv_id").eqNullSafe(F.col("p_conv")))

    def head(t: Column) -> Column:
        return F.when(t["role"] == F.col("participant"), F.lit("<|im_start|>assistant\n")).when(
            t["role"] == "system", F.lit("<|im_start|>system\n")
        ).otherwise(F.concat(F.lit("<|im_start|>user name="), t["role"], F.lit("\n")))

    tail = "<|im_end|>\n"
    parts = F.transform("turns", lambda t: F.struct(F.concat(head(t), t["text"], F.lit(tail)).alias("all"), F.length(head(t)).alias("h"), F.length(t["text"]).alias("n"), (t["role"] == F.col("participant")).alias("own")))

    def done(ps: Column) -> Column:
        starts = prefix_sums(F.transform(ps, lambda p: F.length(p["all"])))
        spans = let(starts, lambda s: F.filter(F.transform(ps, lambda p, i: F.when(p["own"], F.struct(
            (F.get(s, i) + p["h"]).alias("a"), (F.get(s, i) + p["h"] + p["n"]).alias("b")
        ))), lambda x: x.isNotNull()))
        return F.struct(F.col("piece"), F.size(ps).cast("long").alias("n"), F.array_join(F.transform(ps, lambda p: p["all"]), "").alias("text"), spans.alias("spans"))

    rendered = each.select("conv_id", "participant", "segment", let(parts, done).alias("r"))
    whole = rendered.groupBy("conv_id", "participant", "segment").agg(F.array_sort(F.collect_list("r")).alias("rs"))

    def total(f) -> Column:
        return F.aggregate("rs", F.lit(0).cast("long"), lambda a, r: a + f(r).cast("long"))

    offsets = prefix_sums(F.transform("rs", lambda r: F.length(r["text"])))
    spans = let(offsets, lambda o: F.flatten(F.transform("rs", lambda r, i: F.transform(r["spans"], lambda x: F.concat_ws(":", x["a"] + F.get(o, i), x["b"] + F.get(o, i))))))
    return whole.select(
        "conv_id", "participant", "segment", total(lambda r: r["n"]).alias("n_turns"), total(lambda r: F.size(r["spans"])).alias("n_own"),
        F.array_join(F.transform("rs", lambda r: r["text"]), "").alias("text"), F.array_join(spans, ",").alias("mask"),
    )


def op5_query(turns: DataFrame) -> DataFrame:
    return rotate(turns).drop("segment")


OP5_SQL = r"""
WITH t AS (SELECT conv_id, coalesce(turn, 0) AS turn,
                  replace(regexp_replace(CASE WHEN trim(coalesce(role, '')) = '' THEN 'unknown' ELSE role END, '[\x20\x09-\x0D]+', '_', 'g'), '<|', '< |') AS role,
                  replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS participant FROM t WHERE role <> 'system'),
x AS (SELECT t.*, participant, CASE WHEN role = participant THEN '<|im_start|>assistant' || chr(10)
             WHEN role = 'system' THEN '<|im_start|>system' || chr(10) ELSE '<|im_start|>user name=' || role || chr(10) END AS head
      FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
y AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS piece FROM x),
z AS (SELECT *, (sum(length(piece)) OVER w - length(piece))::BIGINT AS off, row_number() OVER w AS k FROM y
      WINDOW w AS (PARTITION BY conv_id, participant ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, participant, count(*) AS n_turns, count(*) FILTER (WHERE role = participant) AS n_own,
       string_agg(piece, '' ORDER BY k) AS text,
       coalesce(string_agg((off + length(head)) || ':' || (off + length(head) + length(text)), ',' ORDER BY k) FILTER (WHERE role = participant), '') AS mask
FROM z GROUP BY conv_id, participant
"""
