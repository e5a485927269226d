"""Chat formatting: snapshots of growing conversations collapse to the longest ones, which are rendered.

Conversation A is a snapshot of B where A's turns (role and text, in turn order)
are the first turns of the longer B. Each turn has a hash of (place, role, text);
the hash of a prefix is the rolling sum of its turns' hashes, so prefixes of all
lengths come from running totals. Equal conversations keep the smallest conv_id.

Long conversations are cut into spans of turns: running totals go span by span,
and each span renders to one row, so no group grows with the longest conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoquill.workspace import Workspace

#: Turn numbers that share a span.
SPAN = 64
MARKS = ("<|{role}|>\n", "\n<|end|>\n")


def _sum(c: str) -> Column:
    # decimal sums, folded back to 64 bits: a sum of longs would overflow
    return F.sum(F.col(c).cast("decimal(38,0)"))


def _fold(c: Column) -> Column:
    return F.pmod(c, F.lit(str(2**63)).cast("decimal(20,0)")).cast("long")


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, place (1-based), p1, p2 (rolling hashes through this turn).

    Turns order by (turn, role, text); repeated turn numbers all count. Rows
    without conv_id belong to no conversation and are left out; null turns come first.
    """
    t = turns.where("conv_id is not null").select("conv_id", "turn", "role", "text").withColumn("span", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / SPAN))
    inside = Window.partitionBy("conv_id", "span").orderBy("turn", "role", "text")
    spans = t.groupBy("conv_id", "span").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("conv_id", "span", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"))
    t = t.withColumn("row", F.row_number().over(inside)).join(spans, ["conv_id", "span"]).withColumn("place", F.col("row") + F.col("n0"))
    for k, seed in (("h1", 1), ("h2", 2)):
        t = t.withColumn(k, F.pmod(F.xxhash64(F.lit(seed), "place", F.col("role").isNull(), "role", F.col("text").isNull(), "text"), F.lit(2**62)))
    by_place = Window.partitionBy("conv_id", "span").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    sums = t.groupBy("conv_id", "span").agg(_sum("h1").alias("s1"), _sum("h2").alias("s2"))
    zero = F.lit(0).cast("decimal(38,0)")
    sums = sums.select("conv_id", "span", *[F.coalesce(F.sum(s).over(earlier), zero).alias(f"{s}0") for s in ("s1", "s2")])
    t = t.withColumns({"r1": _sum("h1").over(by_place), "r2": _sum("h2").over(by_place)}).join(sums, ["conv_id", "span"])
    return t.select("conv_id", "turn", "role", "text", "span", "place", _fold(F.col("r1") + F.col("s10")).alias("p1"), _fold(F.col("r2") + F.col("s20")).alias("p2"))


def collapse(turns: DataFrame, ws: Workspace | None = None) -> tuple[DataFrame, DataFrame]:
    """(numbered turns, kept conversations: conv_id, n_turns, n_equal).

    n_equal: conversations with exactly these turns, itself included.
    """
    ws = ws or Workspace(turns.sparkSession, "chat")
    t = ws.put(numbered_turns(turns), "turns")
    ends = t.groupBy("conv_id").agg(F.max(F.struct("place", "p1", "p2")).alias("e"))
    whole = ends.groupBy("e.place", "e.p1", "e.p2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_equal"))
    # Every prefix that some conversation goes on from; the distinct is summed up before the shuffle.
    longer = t.join(ends.select("conv_id", F.col("e.place").alias("last")), "conv_id").where("place < last").select("place", "p1", "p2").distinct()
    kept = whole.join(longer, ["place", "p1", "p2"], "left_anti").select("conv_id", F.col("place").cast("long").alias("n_turns"), "n_equal")
    return t, ws.put(kept, "kept")


def render(t: DataFrame, kept: DataFrame, marks: tuple[str, str] = MARKS) -> DataFrame:
    """conv_id, part, n_turns (of the whole conversation), text: one row for each span of a kept conversation.

    The parts of a conversation, one after another, are its whole rendering; up to
    SPAN turns make one part. Null roles render as unknown, null texts as nothing.
    """
    before, after = marks[0].split("{role}"), marks[1]
    turn = F.concat(F.lit(before[0]), F.coalesce(F.col("role"), F.lit("unknown")), F.lit(before[1]), F.coalesce(F.col("text"), F.lit("")), F.lit(after))
    rows = t.join(kept, "conv_id").withColumn("gq_turn", F.struct("place", turn.alias("s")))
    parts = rows.groupBy("conv_id", "span", "n_turns", "n_equal").agg(F.array_sort(F.collect_list("gq_turn")).alias("l"))
    return parts.select("conv_id", F.col("span").alias("part"), "n_turns", "n_equal", F.array_join(F.col("l.s"), "").alias("text"))


def maximal_chats(turns: DataFrame) -> DataFrame:
    """Rendered maximal conversations; an empty table gives no rows."""
    return render(*collapse(turns))
