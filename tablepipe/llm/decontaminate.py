"""Benchmark decontamination by template canonicalisation, in DataFrame operations only.

Texts and benchmark items are cut into words and turned into templates: numbers,
a unit after a number, and capitalised words inside a sentence each become a
placeholder of their kind. Windows of the templates are hashed and joined, so a
question is found with other numbers, names or units too. Per text, item and
diagonal (place in the text minus place in the item) the matched windows are
counted; neighbouring diagonals within ``SLACK`` merge, since a name may take
more words. A match needs ``min_coverage`` of the item's windows, and its slots
must be consistent: one value of the item's slots is always replaced by one
value in the text.

A text with names is read twice: with a placeholder for each run of names, and
with the names as plain lower-case words, since a copy in other case has other
names or none. The reading with the better coverage counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablepipe.llm.licenses import gram_hashes, let, split_words

WINDOW = 6
SLACK = 2
MIN_COVERAGE = 0.5
MIN_CONSISTENT = 0.6
BROADCAST_BYTES = 64 << 20  # of the items' windows with their words, beyond which they are joined by shuffle
SALTS = 16  # tasks that share a window of placeholders only, in the join by shuffle
JOINT = "\u00b7"  # stands for the mark inside a number
# between words: ASCII but letters, digits, # and the joint; Latin-1, general and CJK punctuation
# Up to U+00FF named one by one: Java finds those in a table, but tries ranges one after the other.
_LATIN = ((0x00, 0x22), (0x24, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0xA9), (0xAB, 0xB4), (0xB6, 0xB6), (0xB8, 0xB9), (0xBB, 0xBF))
NO_WORD = "[" + "".join(rf"\x{c:02X}" for a, b in _LATIN for c in range(a, b + 1)) + r"\u2000-\u206F\u3000-\u303F]+"
# Words that are units after a number.
UNITS = ("mm cm m km in ft inch inches foot feet yard yards mile miles mg g kg lb lbs oz ounce ounces gram grams kilogram "
         "kilograms pound pounds ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute "
         "minutes h hr hour hours day days week weeks month months year years dollar dollars cent cents euro euros percent "
         "degree degrees meter meters metre metres kilometer kilometers kilometre kilometres kmh mph watt watts volt volts")


def marked(text: Column) -> Column:
    """The text as lower-case words with single blanks between, slots marked:
    ``#d`` before a number, ``#u`` before its unit, ``#n`` before a name (a
    capitalised word that follows a word, a number or a comma)."""
    t = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("#"), F.lit(" ")), F.lit(JOINT), F.lit(" "))
    t = let(t, lambda t: F.when(t.rlike(r"\p{Nd}"), _numbered(_named(F.regexp_replace(t, r"[.,:](?<=\p{Nd}.)(?=\p{Nd})", JOINT))))
            .otherwise(_named(t)))
    return F.lower(F.regexp_replace(t, NO_WORD, " "))


def _named(t: Column) -> Column:
    return F.regexp_replace(t, r"\p{Lu}(?<=[\p{L}\p{Nd},;:] .)\p{Ll}+", "#n$0")


def _numbered(t: Column) -> Column:
    t = F.regexp_replace(t, rf"\p{{Nd}}(?<!\p{{L}}.)[\p{{Nd}}{JOINT}]*", "#d$0 ")
    return F.regexp_replace(t, rf"(#d[\p{{Nd}}{JOINT}]+ +)(?:#n)?((?i:{'|'.join(UNITS.split())})(?!\p{{L}}))", "$1#u$2")


NAMED, PLAIN, NAMELESS = 0, 1, 2  # readings: names are slots, names are words, there are no names


def folded(marks: Column) -> Column:
    """Adjacent names as one."""
    return F.replace(F.regexp_replace(marks, r"(#n[^ ]+)(?= #n)", f"$1{JOINT}"), F.lit(f"{JOINT} #n"), F.lit(JOINT))


def kinds_of(marks: Column) -> Column:
    """Template tokens: every slot is its placeholder."""
    return split_words(F.regexp_replace(marks, r"#([dnu])[^ ]+", "#$1"))


def window_hashes(kinds: Column, k: int) -> Column:
    return gram_hashes(kinds, k)


def _reading(marks, mode, starts=None) -> Column:
    """One reading; ``kinds`` is null where no word is a slot and the kinds are the words."""
    return F.struct(F.when(F.contains(marks, F.lit("#")), kinds_of(marks)).alias("kinds"), split_words(marks).alias("values"), F.lit(mode).alias("mode"),
                    (F.lit(None).cast("array<int>") if starts is None else starts).alias("starts"))


def _starts(marks) -> Column:
    """First word of each token of the folded text and the number of words; null where every token is a word."""
    whole = F.regexp_replace(marks, r"(#n[^ ]+)(?= #n)", f"$1{JOINT}")
    split = split_words(F.replace(whole, F.lit(f"{JOINT} #n"), F.lit(" #m")))
    starts = let(split, lambda w: F.concat(F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: ~F.startswith(F.get(w, i), F.lit("#m"))),
                                           F.array(F.size(w))))
    return F.when(marks.rlike("#n[^ ]+ #n"), starts)


def _templates(df, key, text_col) -> DataFrame:
    """(key, kinds, values, mode, starts): one row for each reading of a text."""
    t = df.select(*key, F.explode(let(marked(F.col(text_col)), lambda m: F.when(F.contains(m, F.lit("#n")), F.array(
        _reading(folded(m), NAMED, _starts(m)), _reading(F.replace(m, F.lit("#n"), F.lit("")), PLAIN)))
        .otherwise(F.array(_reading(m, NAMELESS))))).alias("m"))
    return t.select(*key, F.coalesce("m.kinds", "m.values").alias("kinds"), "m.values", "m.mode", "m.starts")


def _text_windows(templates, key, k) -> DataFrame:
    """(key, mode, pos, hash, first, last, d_values, bare) of all windows of ``k`` words. Each moves with its own words.

    Only places are exploded, so that Spark compiles the loop over a text and holds the text once: exploded hashes would
    copy the text for each window. The loop's rows of one text are kept in memory; ``coalesce`` (which leaves the
    partitions as they are) ends it there, so that the texts do not go on with every hit of the join."""
    pos = F.col("pos")
    kinds = [F.get("kinds", pos + j) for j in range(k)]
    bare = F.startswith(kinds[0], F.lit("#"))  # windows without a word
    for kind in kinds[1:]:
        bare = bare & F.startswith(kind, F.lit("#"))
    first = F.coalesce(F.get("starts", pos), pos)
    last = F.coalesce(F.get("starts", pos + k), F.element_at("starts", -1), pos + k) - 1
    return (templates.select("*", F.posexplode("kinds").alias("pos", "__kind")).where(pos + k <= F.size("kinds"))
            .select(*key, "mode", "pos", F.xxhash64(*kinds).alias("hash"), first.alias("first"), last.alias("last"),
                    F.slice("values", pos + 1, k).alias("d_values"), bare.alias("bare"))
            .coalesce(2 ** 31 - 1))


def item_windows(benchmark, item_col="item_id", text_col="text", window=WINDOW) -> DataFrame:
    """(item, mode, k, n_windows, i_pos, hash, i_kinds, i_values) of each reading. Items shorter than ``window``
    are one window of their own length; items without words have none."""
    t = _templates(benchmark.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("__text"))
                   .where("item_id is not null").distinct(), ["item_id"], "__text")
    t = t.withColumn("n", F.size("kinds")).where("n > 0").withColumn("k", F.least("n", F.lit(window)))
    hashes = F.array().cast("array<bigint>")
    for k in range(1, window + 1):
        hashes = F.when(F.col("k") == k, window_hashes(F.col("kinds"), k)).otherwise(hashes)
    t = t.select("item_id", F.col("mode").alias("i_mode"), "k", (F.col("n") - F.col("k") + 1).alias("n_windows"), "kinds", "values",
                 F.posexplode(hashes).alias("i_pos", "hash"))
    return t.select("item_id", "i_mode", "k", "n_windows", "i_pos", "hash",
                    F.slice("kinds", F.col("i_pos") + 1, F.col("k")).alias("i_kinds"),
                    F.slice("values", F.col("i_pos") + 1, F.col("k")).alias("i_values"))


def find(documents, benchmark, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text",
         window=WINDOW, min_coverage=MIN_COVERAGE, min_consistent=MIN_CONSISTENT):
    """Contaminated (document, item) pairs: (id, item_id, text_hash, n_windows, n_matched, coverage, first_word,
    last_word, n_slots, n_changed, consistency, kind).

    ``kind`` is ``exact`` where no slot changed, else ``re-parameterised``. A
    pair appears once per different text of the id, repeated rows once. Null and
    empty texts and items match nothing; null item ids are left out; a null
    document id is matched as a value; other columns are not read.
    """
    key = [id_col, "text_hash"]
    items = item_windows(benchmark, item_col, item_text_col, window)
    room = F.octet_length(F.array_join("i_values", " ")) + F.octet_length(F.array_join("i_kinds", " ")) + 32 * F.col("k") + 100
    sizes = items.groupBy("k").agg(F.sum(room).alias("bytes")).collect()  # window lengths: ``window`` rows at most
    docs = _templates(documents.select(id_col, F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("__text")),
                      key, "__text")
    small = sum(r["bytes"] for r in sizes) <= BROADCAST_BYTES
    hits = None
    same = (F.col("mode") == F.col("i_mode")) | (F.col("mode") == NAMELESS) | (F.col("i_mode") == NAMELESS)
    for k in [r["k"] for r in sizes] or [window]:
        grams = _text_windows(docs, key, k)
        own = items.where(F.col("k") == k)
        if small:
            got = grams.join(F.broadcast(own), "hash").where(same)
        else:  # windows without a word are shared by several tasks
            salt = F.when(F.col("bare"), F.pmod(F.xxhash64(*key, "pos"), F.lit(SALTS))).otherwise(0)
            salts = F.sequence(F.lit(0), F.when(F.forall("i_kinds", lambda w: F.startswith(w, F.lit("#"))), SALTS - 1).otherwise(0))
            own = own.select("*", F.explode(salts.cast("array<bigint>")).alias("salt"))
            got = grams.withColumn("salt", salt.cast("long")).join(own, ["hash", "salt"]).where(same)
        got = got.select(*key, "item_id", "mode", "i_mode", "n_windows", "pos", "first", "last", "i_pos", "i_kinds", "i_values", "d_values")
        hits = got if hits is None else hits.unionByName(got)
    hits = hits.withColumn("pairs", F.transform(
        F.filter(F.arrays_zip("i_kinds", "i_values", "d_values"), lambda x: F.startswith(x["i_kinds"], F.lit("#"))),
        lambda x: F.struct(x["i_values"].alias("i"), x["d_values"].alias("d"))))
    group = [*key, "item_id", "mode", "i_mode", "n_windows"]
    votes = (hits.groupBy(*group, (F.col("pos") - F.col("i_pos")).alias("diagonal"))
             .agg(F.collect_set("i_pos").alias("places"), F.min("first").alias("lo"), F.max("last").alias("hi"),
                  F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs")))
    # both sets hold places of one item: bounded by its length
    w = Window.partitionBy(*key, "item_id", "mode", "i_mode").orderBy("diagonal")
    new = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(w) > SLACK).cast("int"), F.lit(1))
    spans = (votes.withColumn("__new", new).withColumn("span", F.sum("__new").over(w))
             .groupBy(*group, "span")
             .agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("n_matched"),
                  F.min("lo").alias("first_word"), F.max("hi").alias("last_word"),
                  F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("pairs")))
    slots = F.array_distinct(F.transform("pairs", lambda p: p["i"]))
    spans = (spans.withColumn("n_slots", F.size(slots))
             .withColumn("n_changed", F.size(F.filter("pairs", lambda p: p["i"] != p["d"])))
             .withColumn("coverage", F.col("n_matched") / F.col("n_windows"))
             # each item value needs one pair; more pairs are contradictions
             .withColumn("consistency", F.when(F.col("n_slots") > 0, F.col("n_slots") / F.size("pairs")).otherwise(F.lit(1.0))))
    best = Window.partitionBy(*key, "item_id").orderBy(F.desc("coverage"), "mode", "i_mode", "first_word")
    return (spans.where((F.col("coverage") >= min_coverage) & (F.col("consistency") >= min_consistent))
            .withColumn("__r", F.row_number().over(best)).where("__r = 1")
            .select(id_col, "item_id", "text_hash", "n_windows", "n_matched", "coverage", "first_word", "last_word", "n_slots",
                    "n_changed", "consistency",
                    F.when(F.col("n_changed") == 0, "exact").otherwise("re-parameterised").alias("kind")))


def remove(documents, benchmark, id_col="doc_id", text_col="text", **options):
    """``documents`` without the rows whose text holds a benchmark item."""
    bad = find(documents, benchmark, id_col, text_col, **options).select(
        F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash"))
    same = documents[id_col].eqNullSafe(bad["__id"]) & (F.xxhash64(documents[text_col]) == bad["__hash"])
    return documents.join(bad, same, "left_anti")
