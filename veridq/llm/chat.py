"""Chat formatting: collapse of cumulative snapshots, then rendering.

A log often holds a conversation several times, each time with more turns.  Every turn gets
the rolling hash of the prefix that ends with it; a conversation whose last prefix hash
is an inner prefix hash of another one is a snapshot of it and goes, by an anti-join.  Of
conversations that are equal the one with the smallest id stays.  What stays is maximal
and is rendered.

The hash of a prefix is a pair of sums over its turns' hashes, each of the turn's place, role
and text, so prefixes of long conversations are summed in blocks of ``SPAN`` turns:
no conversation has to fit in a task, and equal prefixes are collapsed before the shuffle.

Edge cases: turns are ordered by turn number (null first), then role, then text; a null
role or text is empty; rows with a null id are one conversation; repeated rows are
turns of their own; an empty table gives no rows; further columns are not read.  A
conversation longer than ``SPAN`` turns is rendered as several parts, in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veridq.llm.common import materialise

SPAN = 1024
HASH = (1 << 40) - 1


def prefixes(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (c: id, never null; conv_id, part, pos: 1, 2, ...; role, text), and the rolling prefix
    hashes p1, p2 of each (c, pos)."""
    src = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("c"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("blk", F.coalesce(F.floor(F.col("turn") / SPAN), F.lit(-(1 << 62))))
    inside = Window.partitionBy("c", "blk").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = Window.partitionBy("c").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = src.groupBy("c", "blk").agg(F.count(F.lit(1)).alias("size"))
    starts = sizes.select("c", "blk", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    rows = src.withColumn("rn", F.row_number().over(inside)).join(starts, ["c", "blk"]).withColumn("pos", F.col("start") + F.col("rn"))
    for h, seed in (("h1", 1), ("h2", 2)):
        rows = rows.withColumn(h, F.xxhash64(F.lit(seed), "pos", "role", "text").bitwiseAND(F.lit(HASH)))
    rows = rows.withColumn("part", F.floor((F.col("pos") - 1) / SPAN))
    rows = materialise(rows.select("c", "conv_id", "part", "pos", "role", "text", "h1", "h2"), "chat-turns")
    sums = rows.groupBy("c", "part").agg(F.sum("h1").alias("s1"), F.sum("h2").alias("s2"))
    ahead = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("c", "part", *[F.coalesce(F.sum(s).over(ahead), F.lit(0)).alias(b) for s, b in (("s1", "b1"), ("s2", "b2"))])
    run = Window.partitionBy("c", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    keys = rows.select("c", "conv_id", "part", "pos", F.sum("h1").over(run).alias("r1"), F.sum("h2").over(run).alias("r2")).join(sums, ["c", "part"])
    hashed = keys.select("c", "conv_id", "pos", F.col("r1").cast("decimal(30,0)").alias("r1"), F.col("b1"), "r2", "b2")
    hashed = hashed.select("c", "conv_id", "pos", (F.col("r1") + F.col("b1")).alias("p1"), (F.col("r2") + F.col("b2")).cast("decimal(30,0)").alias("p2"))
    return rows, hashed


def maximal(hashed: DataFrame) -> DataFrame:
    """c and n_turns of the conversations that no other one continues or repeats."""
    ends = hashed.groupBy("c").agg(F.max("conv_id").alias("conv_id"), F.max("pos").alias("pos"))
    whole = hashed.join(ends.select("c", "pos"), ["c", "pos"])
    first = whole.groupBy("pos", "p1", "p2").agg(F.min(F.struct(F.col("conv_id").isNull().alias("last"), "conv_id", "c")).alias("one")).select("pos", "p1", "p2", F.col("one.c").alias("c"))
    inner = hashed.join(ends.select("c", F.col("pos").alias("n")), "c").where("pos < n").select("pos", "p1", "p2").distinct()
    return first.join(inner, ["pos", "p1", "p2"], "left_anti").select("c", F.col("pos").alias("n_turns"))


def render(turns: DataFrame) -> DataFrame:
    """conv_id, part, n_turns (of the conversation) and text of each maximal one."""
    rows, hashed = prefixes(turns)
    kept = rows.join(maximal(materialise(hashed, "chat-prefixes")), "c")
    line = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), "text", F.lit("<|im_end|>\n"))
    parts = kept.select("c", "conv_id", "part", "n_turns", "pos", line.alias("line")).groupBy("c", "part").agg(
        F.first("conv_id").alias("conv_id"), F.first("n_turns").alias("n_turns"), F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("l")
    )
    return parts.select("conv_id", F.col("part").cast("long").alias("part"), F.col("n_turns").cast("long").alias("n_turns"), F.array_join("l.line", "").alias("text"))
