"""Audit of how quality filters interact, over all orders of applying them.

1. One pass over the texts gives each document the failures of the filters that
   look at its own text (a bit mask) and a 64-bit hash of the text.
2. Duplicate prepass: every task counts the hashes in a counting Bloom sketch
   (three counters a text, kept sparse by segment), the sketches are added
   segment by segment, and the counters of at least 2 become a bit map. A text with
   a counter of 1 stands once in the table. The map has 16 slots a document, 64 MB at
   most, which bounds what is broadcast; a fuller map clears fewer texts and changes
   no result.
3. Only texts that the map does not clear move: grouped by the full text, the least
   id of each is exempt from the duplicate filter, all other ids of it fail.
4. Masks with the documents' labels are counted per part; every figure of every
   order is a sum of these counts.
"""

from __future__ import annotations

import math
from itertools import permutations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablepipe.llm import _sketch
from tablepipe.llm._scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
FILTERS = "ABCDE"


def failures(text):
    """Bits of the filters A to D for a text column without nulls."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    long = lambda c: c.cast("long")
    n = long(F.size(words))
    fails = [n < 100,
             100 * long(F.size(F.array_distinct(words))) < 80 * n,
             100 * long(F.length(F.regexp_replace(text, "[^A-Z]+", ""))) > 10 * long(F.length(text)),
             text.rlike("[#$%&*|]")]
    return sum(F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(fails))


def masks(df, labels, id_col="doc_id", text_col="text", part_col="lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the set of filters that they fail."""
    spark = df.sparkSession
    s = Scratch(spark, "audit")
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    own = s.cut(docs.select("id", "part", failures(F.col("text")).alias("mask"), F.xxhash64("text").alias("h")), "own")
    number = own.count()
    slots = min(_sketch.MOST_SLOTS, 1 << max(16, (_sketch.SLOTS * max(1, number) - 1).bit_length()))
    repeat = _sketch.bit_map(spark, own.where("id is not null").select("h"), slots, least=2)
    again = docs.where("id is not null").where(repeat(F.xxhash64("text")))
    first = s.cut(again.groupBy("text").agg(F.min("id").alias("id")).select("id", F.xxhash64("text").alias("h"), F.lit(True).alias("first")),
                  "first")
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"))
    named = own.where("id is not null").withColumn("again", repeat(F.col("h")))
    named = named.join(first, ["id", "h"], "left").join(known, "id", "left")
    late = F.col("again") & F.col("first").isNull()
    bit = F.when(late, F.lit(1 << FILTERS.index("E"))).otherwise(F.lit(0))
    named = named.select("part", (F.col("mask") + bit).alias("mask"), F.coalesce("good", F.lit(0)).alias("good"),
                         F.coalesce("toxic", F.lit(0)).alias("toxic"))
    bare = own.where("id is null").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return named.unionByName(bare).groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.sum("good").cast("long").alias("good"), F.sum("toxic").cast("long").alias("toxic"))


def places(filters=FILTERS):
    """(filter_order, step, filter bit, bits of the filters before it) of every step of every order."""
    bit = {f: 1 << k for k, f in enumerate(filters)}
    return [("".join(o), k + 1, bit[f], sum(bit[g] for g in o[:k])) for o in permutations(filters) for k, f in enumerate(o)]


def orders(counts) -> DataFrame:
    """The figures of every step of every order from the counts of ``masks``."""
    spark = counts.sparkSession
    steps = places()
    cases = sorted({(own, before) for _, _, own, before in steps})
    spots = F.array(*[F.struct(F.lit(o).alias("own"), F.lit(b).alias("before")) for o, b in cases])
    each = counts.select("*", F.explode(spots).alias("at")).select("*", "at.own", "at.before")
    fails, earlier = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda cond, what: F.coalesce(F.sum(F.when(cond, F.col(what))), F.lit(0)).cast("long")
    case = each.groupBy("part", "own", "before").agg(
        total(~fails & ~earlier, "n").alias("kept"), total(fails & ~earlier, "n").alias("removed"),
        total(fails & earlier, "n").alias("redundant"), total(F.col("mask") == F.col("own"), "n").alias("unique_fails"),
        total(fails & ~earlier, "good").alias("good_lost"), total(fails & ~earlier, "toxic").alias("toxic_lost"))
    others = len(FILTERS) - 1
    times = F.element_at(F.array(*[F.lit(math.factorial(k) * math.factorial(others - k)) for k in range(others + 1)]),
                         (F.bit_count("before") + 1).cast("int"))  # orders with these filters before
    case = case.withColumn("shapley", F.sum(F.col("removed") * times).over(Window.partitionBy("part", "own")))
    table = spark.createDataFrame(steps, "filter_order string, step int, own int, before int")
    return case.join(F.broadcast(table), ["own", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(df, labels, id_col="doc_id", text_col="text", part_col="lang") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley): a row for each part, order and step, zeros included.

    Null texts count as empty and a null part is the part ''. A document is a
    duplicate where a smaller id has the same text; a null id is neither smaller nor
    larger than any, so it is no duplicate and makes none. Repeated rows count each,
    and rows of one id with one text are no duplicates of one another. Several labels
    of a document count as 1 where one of them is 1; null labels and ids are no
    label. An empty table gives no rows. Other columns are not read.
    """
    return orders(masks(df, labels, id_col, text_col, part_col))
