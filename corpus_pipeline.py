"""Training-data pipeline: documents in, token ids out.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir)
and returns what the stage keeps, with the columns of ``documents`` (the last one
returns tokens). ``run`` writes each stage's rows as Parquet in the shared folder
and reads them back for the next.

No stage can be written as SQL as a whole (rank-order profiles, Bayesian
verification, suffix arrays, byte-pair merges), so ``ORACLE_SQL`` is None and
the tests hold ``run`` against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tablepipe.llm import bpe_codec, decontaminate, langid, minhash, substring_dedup
from tablepipe.llm._scratch import Scratch
from tablepipe.plans import table

ORACLE_SQL = None


def language_id(spark, docs, sf_dir):
    """Documents in a language that the labelled ones teach; texts without letters or in no such language go."""
    return langid.keep_known(docs, langid.learn(docs.where(~langid.held_out("doc_id"))))


def near_dedup(spark, docs, sf_dir):
    """One document of each near-duplicate group (five-word shingles, similarity 0.8): the smallest id.

    Repeated rows count as one. Documents without an id go by a key of their text
    behind all ids, so one of them stays where no document with an id is like it."""
    key, number = "__key", "__n"
    while {key, number} & set(docs.columns):
        key, number = f"_{key}", f"_{number}"
    behind = F.lit(2**62) + F.pmod(F.xxhash64("text"), F.lit(2**62))
    keyed = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), behind))
    kept = minhash.near_duplicates(keyed, id_col=key, width=5, percent=80).where("kept").select(key).distinct()
    once = Window.partitionBy(key, F.xxhash64("text")).orderBy(F.lit(0))
    rows = keyed.join(kept, key, "left_semi")
    return rows.withColumn(number, F.row_number().over(once)).where(F.col(number) == 1).select(*docs.columns)


def substring_dedup_stage(spark, docs, sf_dir):
    """Documents without passages of 50 bytes that a smaller id holds; ``n_chars`` follows the text."""
    out = substring_dedup.without_repeats(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def decontamination(spark, docs, sf_dir):
    """Documents that hold no benchmark item, neither as it is nor re-parameterised."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def bpe(spark, docs, sf_dir):
    """(doc_id, lang, source, n_tokens, token_ids, decoded_ok) of each document; the ids are decoded again as a check."""
    coded = bpe_codec.decode(bpe_codec.encode(docs.select("doc_id", "lang", "source", "text")))
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", F.size("token_ids").alias("n_tokens"), "token_ids", same.alias("decoded_ok"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup_stage),
    ("decontamination", decontamination),
    ("bpe", bpe),
]


def run(spark, sf_dir):
    """The token table of ``documents`` after all stages."""
    scratch = Scratch(spark, "corpus")
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        docs = scratch.cut(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
