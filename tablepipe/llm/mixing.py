"""Mixing of sources to target weights by weighted fair queueing.

1. One pass over the texts gives each document its size (words) and a place in its
   source's shuffled queue (60 bits of the MD5 of id and text). Equal rows are
   counted before they move.
2. Targets: sources in code point order, null last, weigh ``WEIGHTS`` in turn and
   share ``SHARE`` of all words; none goes beyond ``MOST`` times its own words, and
   what is cut goes to the others by weight. Closed form over the sources sorted by
   limit over weight.
3. A source's queue holds its documents ``MOST`` times over. A copy's virtual finish
   time is the running total of its source's words divided by the source's target,
   so every source reaches its target at time 1. Running totals come from buckets of
   the place: about sqrt(rows) buckets a source, totals over buckets, then in them.
4. All copies are put in one global order of finish time by ranges of equal width
   (every source's words are spread evenly over its time, so the ranges are even),
   and the order is cut where the total reaches the budget: totals over ranges find
   the range of the cut, only that one is sorted.

A copy is taken whole or not at all. Documents without words are never taken.
Only DataFrame functions run here; one row per source, about sqrt(rows) rows of
totals and the range of the cut are what single tasks see.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablepipe.llm._scratch import Scratch

# The weights in turn, the share of all words as a fraction, the most
# times that a document may be taken.
WEIGHTS = (5, 2, 1)
SHARE = (3, 2)
MOST = 2
PLACE_BITS = 60
BLOCK = 10_000  # equal rows that one generated array holds
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text):
    """Words of a text column, 0 for null."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def sized(df, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """(id, source, size, place) of every row."""
    key = F.md5(F.concat_ws(" ", F.col(id_col).cast("string"), F.col(text_col)).cast("binary"))
    place = F.conv(F.substring(key, 1, PLACE_BITS // 4), 16, 10).cast("long")
    size = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(word_count(F.col(text_col))).cast("long")
    return df.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                     size.alias("size"), place.alias("place"))


def targets(rows, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """(source, no, source_size, target): one row per source of ``rows`` (source, size)."""
    by = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    spot = Window.orderBy(F.col("source").isNull(), "source")
    whole = Window.partitionBy(F.lit(0))
    by = by.select("source", "source_size", (F.row_number().over(spot) - 1).alias("no"))
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("no") % len(weights) + 1).cast("int"))
    by = by.select("*", weight.alias("weight"), (F.col("source_size") * most).alias("limit"))
    line = whole.orderBy(F.col("limit") / F.col("weight"), "no")
    exact = lambda c: c.cast("decimal(38,0)")
    by = by.select("*", F.row_number().over(line).alias("turn"), F.sum("source_size").over(whole).alias("all"),
                   F.coalesce(F.sum("limit").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                   F.sum("weight").over(line.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("rest"))
    left = F.col("all") * share[0] - F.col("before") * share[1]  # of the budget, times share[1]
    full = exact(F.col("limit")) * exact(F.col("rest") * share[1]) <= exact(F.col("weight")) * exact(left)
    by = by.select("*", left.alias("left"), full.alias("full"))
    first = F.min(F.when(~F.col("full"), F.struct("turn", "left", "rest"))).over(whole)
    by = by.select("*", first.alias("level"))
    free = F.col("turn") >= F.col("level.turn")
    target = F.when(free, F.col("weight") * F.col("level.left") / (F.col("level.rest") * share[1])).otherwise(F.col("limit").cast("double"))
    return by.select("source", "no", "source_size", target.cast("double").alias("target"))


def _bits(rows):
    """Bits of about sqrt(rows) buckets."""
    return max(1, (max(1, rows).bit_length() + 1) // 2)


def queue(rows, goals, bits) -> DataFrame:
    """(id, no, size, source_size, target, upto): rows with words in their source's queue;
    ``upto`` is the source's running total with the row."""
    equal = rows.where("size > 0").groupBy("source", "id", "size", "place").agg(F.count("*").alias("times"))
    bucket = F.shiftrightunsigned("place", PLACE_BITS - bits)
    equal = equal.select("*", bucket.alias("bucket"), (F.col("size") * F.col("times")).alias("words"))
    totals = equal.groupBy("source", "bucket").agg(F.sum("words").alias("words"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("source").alias("s"), F.col("bucket").alias("b"),
                           F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "bucket").orderBy("place", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    equal = equal.select("*", F.sum("words").over(inside).alias("inside"))
    line = equal.join(totals, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    goals = goals.withColumnRenamed("source", "g")
    line = line.join(goals, F.col("source").eqNullSafe(F.col("g"))).select(
        "id", "no", "size", "source_size", "target", "times", (F.col("offset") + F.col("inside")).alias("last"))
    # equal rows one by one again, in blocks
    line = line.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / BLOCK))).alias("block"))
    line = line.select("*", F.explode(F.sequence(F.col("block") * BLOCK, F.least(F.col("times"), (F.col("block") + 1) * BLOCK) - 1)).alias("after"))
    return line.select("id", "no", "size", "source_size", "target", (F.col("last") - F.col("after") * F.col("size")).alias("upto"))


def copies(line, most=MOST) -> DataFrame:
    """(id, no, size, round, upto, finish): the queue ``most`` times over, with virtual finish times."""
    again = line.select("*", F.explode(F.array(*[F.lit(k) for k in range(most)])).alias("round"))
    again = again.withColumn("upto", F.col("upto") + F.col("round") * F.col("source_size"))
    return again.select("id", "no", "size", "round", "upto", (F.col("upto") / F.col("target")).alias("finish"))


def cut(served, budget, bits):
    """(finish, no, upto) of the last copy of the global order whose running total is
    within ``budget``; None if all are, False if none is."""
    range_no = F.floor(F.col("finish") * (1 << bits))
    totals = served.groupBy(range_no.alias("range")).agg(F.sum("size").alias("words"))
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    over = (totals.select("range", "words", F.sum("words").over(upto).alias("upto")).where(F.col("upto") > F.lit(budget))
            .orderBy("range").limit(1).collect())
    if not over:
        return None
    spot, start = over[0]["range"], over[0]["upto"] - over[0]["words"]
    order = ("finish", "no", "upto")
    inside = served.where(range_no == spot).select(*order, F.sum("size").over(Window.orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0)).alias("words")).where(F.col("words") + start <= F.lit(budget))
    last = inside.orderBy(*[F.desc(c) for c in order]).limit(1).collect()
    if last:
        return tuple(last[0][c] for c in order)
    before = served.where(range_no < spot)
    last = before.agg(F.max(F.struct(*order)).alias("last")).collect()[0]["last"]
    return tuple(last) if last else False


def _taken(finish, upto, last):
    if last is None:
        return F.lit(True)
    if last is False:
        return F.lit(False)
    at, no, stop = F.lit(last[0]), F.lit(last[1]), F.lit(last[2])
    return (finish < at) | ((finish == at) & ((F.col("no") < no) | ((F.col("no") == no) & (upto <= stop))))


class Mix:
    """The mix of one table: ``rows`` (id, source, size), ``goals``, ``line`` and the cut."""

    def __init__(self, df, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, share=SHARE, most=MOST):
        s = Scratch(df.sparkSession, "mixing")
        self.most = most
        self.rows = s.cut(sized(df, id_col, text_col, source_col), "sizes")
        number, words = self.rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).collect()[0]
        bits = _bits(number)
        self.goals = s.cut(targets(self.rows, weights, share, most), "goals")
        self.line = s.cut(queue(self.rows, self.goals, bits), "queue")
        self.budget = words * share[0] // share[1]
        self.last = cut(copies(self.line, most), self.budget, bits)

    def schedule(self) -> DataFrame:
        """(id, no, size, round, upto, finish) of the taken copies in the global order of the mix."""
        served = copies(self.line, self.most)
        return served.where(_taken(F.col("finish"), F.col("upto"), self.last)).orderBy("finish", "no", "upto")

    def shares(self) -> DataFrame:
        """(id, size, source_size, target, taken), one row per input row."""
        upto = F.col("upto")
        times = sum(_taken((upto + k * F.col("source_size")) / F.col("target"), upto + k * F.col("source_size"), self.last).cast("long")
                    for k in range(self.most))
        full = self.line.select("id", "size", "source_size", "target", (F.col("size") * times).alias("taken"))
        bare = self.rows.where("size = 0").join(self.goals.withColumnRenamed("source", "g"), F.col("source").eqNullSafe(F.col("g")))
        return full.unionByName(bare.select("id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken")))


def mix(df, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """One row per document: (id, size, source_size, target, taken).

    Null and empty texts have size 0 and are not taken; null sources are one
    source, the last; null ids are ordinary rows. Repeated rows are rows of their
    own: equal ones differ at most in which of them is taken. Ties of finish time
    go by source, then by place in the queue, so reruns agree. An empty table
    gives no rows. Other columns are not read.
    """
    return Mix(df, id_col, text_col, source_col, weights, share, most).shares().withColumnRenamed("id", id_col)
