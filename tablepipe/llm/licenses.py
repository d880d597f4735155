"""License scan by diagonal voting, in DataFrame operations only.

Every rolling word k-gram of every text is hashed and joined with the hashes of
the license templates' k-grams. A hit votes for the diagonal (its place in the
text minus its place in the template); the votes are summed per text, template
and diagonal, neighbouring diagonals (a few words inserted or left out) merge
into one span, and a span counts when the template words that its k-grams cover,
against the longer of template and span, reach ``min_score``.

Beside that, places of the base phrases are found on the words themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 3
GAP = 3  # diagonals this near to each other belong to one span
MIN_SCORE = 0.6
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what stands between words, in lower case

# The base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Public license notices, as (label, wording).
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
               "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc0", "dedicated to the public domain under the Creative Commons CC0 1.0 Universal"),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in "
                    "any form or by any means without the prior written permission"),
]


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row, not again for each element of a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Words of the text with A-Z in lower case. Other letters may change case
    too, which moves no word bound and makes no ASCII phrase."""
    return split_words(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NO_WORD, " "))


def split_words(spaced: Column) -> Column:
    """Words of a text in which single blanks part them."""
    return let(F.trim(spaced), lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " ")))


def gram_hashes(words: Column, k: int) -> Column:
    """64-bit hashes of all windows of ``k`` words; empty for fewer words."""
    def hashes(w):
        last = F.size(w) - k
        out = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                          lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
        return F.when(last >= 0, out).otherwise(F.array().cast("array<bigint>"))

    return let(words, hashes)


def template_grams(spark, templates=None, k=K) -> DataFrame:
    """(template, label, t_len, t_pos, hash) of the templates, a bounded literal table."""
    rows = [(i, label, text) for i, (label, text) in enumerate(templates or TEMPLATES)]
    t = spark.createDataFrame(rows, "template int, label string, text string").withColumn("w", words_of(F.col("text")))
    t = t.withColumn("t_len", F.size("w"))
    return t.select("template", "label", "t_len", F.posexplode(gram_hashes(F.col("w"), k)).alias("t_pos", "hash"))


def spans(df, id_col="doc_id", text_col="text", templates=None, k=K, gap=GAP, min_score=MIN_SCORE):
    """Verified spans: (id, text_hash, template, label, first_word, last_word, votes, score)."""
    key = [id_col, "text_hash"]
    grams = (df.select(id_col, F.xxhash64(text_col).alias("text_hash"), words_of(F.col(text_col)).alias("w"))
             .select(*key, F.posexplode(gram_hashes(F.col("w"), k)).alias("pos", "hash")))
    hits = grams.join(F.broadcast(template_grams(df.sparkSession, templates, k)), "hash")  # the template list
    votes = (hits.groupBy(*key, "template", "label", "t_len", (F.col("pos") - F.col("t_pos")).alias("diagonal"))
             .agg(F.collect_set("t_pos").alias("t_places"), F.min("pos").alias("lo"), F.max("pos").alias("hi")))
    # collect_set holds places in one template: bounded by its length
    w = Window.partitionBy(*key, "template").orderBy("diagonal")
    new = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(w) > gap).cast("int"), F.lit(1))
    merged = (votes.withColumn("__new", new).withColumn("span", F.sum("__new").over(w))
              .groupBy(*key, "template", "label", "t_len", "span")
              .agg(F.flatten(F.collect_list("t_places")).alias("t_places"), F.min("lo").alias("first_word"),
                   (F.max("hi") + k - 1).alias("last_word")))
    covered = F.size(F.array_distinct(F.flatten(F.transform("t_places", lambda p: F.sequence(p, p + k - 1)))))
    length = F.greatest(F.col("t_len"), F.col("last_word") - F.col("first_word") + 1)
    return (merged.withColumn("votes", F.size(F.array_distinct("t_places"))).withColumn("score", covered / length)
            .where(F.col("score") >= min_score)
            .select(*key, "template", "label", "first_word", "last_word", "votes", "score"))


def _places(words: Column, phrase: str) -> Column:
    parts = phrase.split()
    same = lambda i: [F.get(words, i + j) == p for j, p in enumerate(parts)]

    def every(i):
        out = same(i)[0]
        for c in same(i)[1:]:
            out = out & c
        return F.coalesce(out, F.lit(False))

    return F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0))), every)


def _all_places(words: Column) -> Column:
    """An array of places for each phrase."""
    return let(words, lambda w: F.array(*[_places(w, p) for p in PHRASES]))


def base(df, id_col="doc_id", text_col="text"):
    """(id, text_hash, n_words, n_base, first_word, last_word, base array) per row."""
    lower = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    t = df.select(id_col, F.xxhash64(text_col).alias("text_hash"), words_of(F.col(text_col)).alias("w"),
                  (F.contains(lower, F.lit("license")) | F.contains(lower, F.lit("cc"))).alias("may"))
    nothing = F.array().cast("array<array<int>>")
    t = t.select(id_col, "text_hash", F.size("w").cast("long").alias("n_words"),
                 F.when(F.col("may"), _all_places(F.col("w"))).otherwise(nothing).alias("places"))
    every = F.flatten("places")
    found = F.array_compact(F.array(*[F.when(F.size(F.coalesce(F.get("places", F.lit(i)), F.array().cast("array<int>"))) > 0,
                                             F.lit(label)) for i, label in enumerate(PHRASES.values())]))
    return t.select(id_col, "text_hash", "n_words", F.size(every).cast("long").alias("n_base"),
                    F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
                    F.array_sort(F.array_distinct(found)).alias("base"))


def scan(df, id_col="doc_id", text_col="text", templates=None):
    """One row per document: (id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_spans).

    Null and empty texts have no words and no labels (empty strings), score 0.
    ``score`` is the best verified span's, 1 where a base phrase stands.
    Repeated rows each give the same row; a null id is matched as a value; other
    columns are not read.
    """
    found = (spans(df, id_col, text_col, templates).groupBy(F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash"))
             .agg(F.collect_set("label").alias("__labels"), F.max("score").alias("__score"), F.count("*").alias("__n")))
    rows = base(df, id_col, text_col)
    both = rows.join(found, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash")), "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("__labels", F.array().cast("array<string>"))))
    score = F.greatest(F.coalesce("__score", F.lit(0.0)), (F.col("n_base") > 0).cast("double"))
    return both.select(id_col, "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
                       F.array_join(labels, ",").alias("labels"), F.least(score, F.lit(1.0)).alias("score"),
                       F.coalesce("__n", F.lit(0)).alias("n_spans"))
