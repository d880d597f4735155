"""Language identification by rank-order n-gram profiles.

A language's profile is its ``TOP`` most frequent character n-grams (1 to 3, in
words padded with blanks), in order of rank. A document's own most frequent
n-grams are ranked the same way and compared with each profile: the
out-of-place distance adds up how far each n-gram's rank is from its rank in the
profile, and ``TOP`` for one that the profile lacks. The nearest profile wins.

Profiles are learned from about ``PER_LANGUAGE`` documents of each language: a
share of the language's rows by the hash of their id, set from its row count (a
documented bound of the fit). Spark counts them, and ``TOP`` n-grams a language
reach the driver. All
documents are classified, on their whole text.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablepipe.llm import pretoken
from tablepipe.llm._text import long_column, map_arrow, slices

TOP = 300
PER_LANGUAGE = 400
UNKNOWN = "und"
BLANK = np.uint64(32)
_SHIFT = np.uint64(21)


@functools.lru_cache(1)
def _is_letter():
    return np.isin(pretoken._tables()[0], pretoken.LETTERS)


def ngrams(text):
    """All n-grams of a text's padded words, each packed into 63 bits (unsorted); empty without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _is_letter()[points]
    if not letter.any():
        return np.zeros(0, np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first character after a word stands for the blank
    chars = np.where(letter, points, 32)[keep].astype(np.uint64)
    chars = np.concatenate([[BLANK], chars, [BLANK]])
    one = chars[chars != BLANK]
    two = chars[:-1] << _SHIFT | chars[1:]
    two = two[(chars[:-1] != BLANK) | (chars[1:] != BLANK)]
    three = (chars[:-2] << _SHIFT | chars[1:-1]) << _SHIFT | chars[2:]
    return np.concatenate([one, two, three[chars[1:-1] != BLANK]])


def ranked(codes, top=TOP):
    """The ``top`` most frequent codes, most frequent first, equal counts by code."""
    codes = np.sort(codes)
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    counts = np.diff(np.append(first, len(codes)))
    return codes[first][np.argsort(-counts, kind="stable")[:top]]


class Profiles:
    """Profiles of all languages as one sorted code array and a rank matrix."""

    def __init__(self, by_language, top=TOP):
        self.languages, self.top = sorted(by_language), top
        every = [np.asarray(by_language[x], np.uint64) for x in self.languages]
        self.codes = np.unique(np.concatenate([*every, np.zeros(0, np.uint64)]))
        self.ranks = np.full((len(self.codes) + 1, len(every)), -1, np.int32)
        for k, codes in enumerate(every):
            self.ranks[np.searchsorted(self.codes, codes), k] = np.arange(len(codes))

    def classify(self, text):
        """(language, score): 1 - distance / largest distance, 0 where nothing is in common."""
        codes = ngrams(text)
        if not len(codes) or not self.languages:
            return UNKNOWN, 0.0
        own = ranked(codes, self.top)
        at = np.searchsorted(self.codes, own)
        at[at == len(self.codes)] = 0
        at[self.codes[at] != own] = len(self.codes)
        ranks = self.ranks[at]
        apart = np.where(ranks < 0, self.top, np.minimum(np.abs(ranks - np.arange(len(own))[:, None]), self.top))
        distance = apart.sum(0)
        best = int(distance.argmin())
        return self.languages[best], float(1 - distance[best] / (self.top * len(own)))


def held_out(id_col):
    """Rows that nothing is learned from: crc32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(df, id_col="doc_id", text_col="text", lang_col="lang", per_language=PER_LANGUAGE, top=TOP):
    """Profiles from ``df`` (call it with training rows only). Rows with a null
    id, text or language teach nothing."""
    taught = df.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    sizes = taught.groupBy(F.col(lang_col).alias("__lang")).count().collect()  # a row a language
    if not sizes:
        return Profiles({}, top)
    shares = df.sparkSession.createDataFrame([(r["__lang"], per_language / r["count"]) for r in sizes], "__lang string, __share double")
    sample = (taught.select(F.col(text_col).alias("__text"), F.col(lang_col).alias("__lang"),
                            (F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) / float(1 << 30)).alias("__at"))
              .join(F.broadcast(shares), "__lang").where("__at < __share").select("__text", "__lang"))

    def count(batches):
        for batch, texts in slices(batches, "__text"):
            languages = batch.column(1).to_pylist()
            every = texts.to_pylist()
            for lang in sorted(set(languages)):
                codes = np.concatenate([ngrams(t) for t, x in zip(every, languages) if x == lang])
                codes, counts = np.unique(codes, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)),
                     pa.array(counts, pa.int64())], ["lang", "code", "n"])

    counts = map_arrow(sample, count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    rows = counts.withColumn("r", F.row_number().over(best)).where(F.col("r") <= top).orderBy("lang", "r").collect()
    profiles: dict = {}
    for r in rows:
        profiles.setdefault(r["lang"], []).append(r["code"])
    return Profiles(profiles, top)


def predict(df, profiles, id_col="doc_id", text_col="text"):
    """One row per document: (id, held_out, lang_pred, score), from the whole text alone.

    ``lang_pred`` is ``und`` with score 0 where the text is null or has no
    letter (and where no language was learned). Repeated rows each give a row; a
    null id is not held out; other columns are not read.
    """
    def run(batches):
        for batch, texts in slices(batches, "__text"):
            got = [profiles.classify(t) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [long_column(batch, id_col), batch.column(1), pa.array([x[0] for x in got], pa.string()),
                 pa.array([x[1] for x in got], pa.float64())], [id_col, "held_out", "lang_pred", "score"])

    rows = df.select(id_col, held_out(id_col).alias("held_out"), F.col(text_col).alias("__text"))
    return map_arrow(rows, run, f"`{id_col}` long, held_out boolean, lang_pred string, score double")


def keep_known(df, profiles, text_col="text", min_score=0.15):
    """The rows of ``df`` whose text is in a learned language, all columns kept: rows
    without a letter go, and rows whose score is under ``min_score`` (hardly an
    n-gram in common with any profile, as in another script)."""
    def run(batches):
        for batch, texts in slices(batches, text_col):
            got = [profiles.classify(t) for t in texts.to_pylist()]
            yield batch.filter(pa.array([lang != UNKNOWN and score >= min_score for lang, score in got], pa.bool_()))

    return map_arrow(df, run, df.schema)


def identify(df, id_col="doc_id", text_col="text", lang_col="lang", **bounds):
    """Learn from the rows of ``df`` that are not held out, then predict every row."""
    profiles = learn(df.where(~held_out(id_col)), id_col, text_col, lang_col, **bounds)
    return predict(df, profiles, id_col, text_col)
