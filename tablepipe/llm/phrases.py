"""Phrase collocations by Rabin-Karp fingerprints.

1. Fingerprints. The words of a text get position-free hashes from numpy prefix
   polynomials over its bytes, and every phrase of 1 to ``LONGEST`` words inside a
   piece the polynomial of its words' hashes; the language is mixed in. A task sorts
   the fingerprints of a few million phrases, counts them, and passes on
   (part, low 32 bits, counts): the high bits are the part. Parts are summed; the
   fingerprints with at least ``least`` occurrences become a two-probe bit map, part
   by part. It has ``MAP_BITS`` bits a fingerprint, ``MOST_BITS`` at most, which bounds
   what is broadcast; a fuller map lets more phrases through and changes no result.
2. Texts. The occurrences whose fingerprint is in the map are pointers (word numbers)
   into a block of text. Those with one fingerprint are compared word by word with
   the first of them (equal word hashes are first compared byte by byte); colliding
   ones are told apart by their words. Only then is a phrase written out, once a
   block, with its count and the least document that holds it, and summed by its
   text, so counts are exact whatever the fingerprints do.
3. Scores, containment and ranks are joins, aggregates and a top-k over the frequent
   phrases.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablepipe.llm import _words as W
from tablepipe.llm._scratch import Scratch
from tablepipe.llm._text import map_arrow, prepare, slices, utf8_view

# Bytes that end pieces, bytes that part words.
PIECE_ENDS = (*b".,;:!?", *range(0x0A, 0x0E))
SPACES = (0x20, 0x09)
LONGEST = 4
UNNAMED = "und"
LEAST, TOP = 30, 2000
INSIDE = 80  # percent of a phrase's occurrences in a longer one that drop it
SCALE = 2_000_000
PART_ROWS = 1 << 20  # phrases of the corpus for each part of the fingerprints
FLUSH = 4 << 20  # fingerprints that a task holds before it passes them on
BLOCK_BYTES = 2 << 20  # text that pass 2 aggregates at a time
MAP_BITS, MOST_BITS = 16, 1 << 30
_GROW = np.uint64(0x9E3779B97F4A7C15 | 1)


def _byte_table(values):
    t = np.zeros(256, bool)
    t[list(values)] = True
    return t


_ENDS, _GAPS = _byte_table(PIECE_ENDS), _byte_table((*PIECE_ENDS, *SPACES))


class Block:
    """Words of a block of texts: low (bytes in lower case), start, stop, doc and piece of each word."""

    def __init__(self, data, offsets):
        self.low = low = W.lower_ascii(data)
        n = len(low)
        inside = ~_GAPS[low]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        begin, end = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1] | edge[1:n]
        end[:-1] &= ~inside[1:] | edge[1:n]
        self.start, self.stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1
        ends = np.cumsum(_ENDS[low], dtype=np.int64) if n else np.zeros(0, np.int64)
        self.piece = ends[self.start] + self.doc  # both only grow, so a sum is one piece
        self.hash = W.span_hash(W.prefix_hash(low), self.start, self.stop)

    def phrases(self, salt):
        """For 1 to LONGEST words: (first word of each phrase, fingerprint). ``salt`` is one number a text."""
        salt, h = salt[self.doc], self.hash
        print_ = h.copy()
        first = np.arange(len(h))
        for k in range(1, LONGEST + 1):
            if k > 1:
                first = first[first < len(h) - k + 1]
                first = first[self.piece[first] == self.piece[first + k - 1]]
                print_[first] = print_[first] * _GROW + h[first + k - 1]
            yield k, first, W.mix(print_[first] + salt[first] + np.uint64(k))


def _salts(langs):
    """A number for each language name."""
    values = langs.dictionary.to_pylist()
    if not values:
        return np.zeros(len(langs), np.uint64)
    known = [W.span_hash(W.prefix_hash(x), np.array([0]), np.array([len(x)]))[0] for x in (np.frombuffer(v.encode(), np.uint8) for v in values)]
    return np.array(known, np.uint64)[langs.indices.to_numpy(zero_copy_only=False)]


def _texts(batches, budget):
    """(ids, languages as a dictionary array, bytes, offsets) of at most about ``budget`` bytes;
    a longer text is cut at ends of pieces."""
    for batch, texts in slices(batches, "text", budget):
        langs = batch.column(batch.schema.get_field_index("lang")).dictionary_encode()
        ids = batch.column(batch.schema.get_field_index("id"))
        data, offsets = utf8_view(texts)
        if len(texts) > 1 or len(data) <= 2 * budget:
            yield ids, langs, data, offsets
            continue
        at = 0
        while at < len(data):
            stop = min(len(data), at + budget)
            while stop < len(data) and not _ENDS[data[stop - 1]]:
                more = np.flatnonzero(_ENDS[data[stop:stop + budget]])
                stop = stop + int(more[0]) + 1 if len(more) else min(len(data), stop + budget)
            yield ids, langs, data[at:stop], np.array([0, stop - at], np.int64)
            at = stop


def _counted(prints, part_bits):
    """Rows (part, low, counts) of an array of fingerprints."""
    prints = np.sort(prints >> np.uint64(32 - part_bits))
    new = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
    n = np.minimum(np.diff(np.append(new, len(prints))), 255).astype(np.uint8)
    prints = prints[new]
    part = (prints >> np.uint64(32)).astype(np.int64)
    low = prints.astype("<u4")
    cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
    return pa.RecordBatch.from_arrays(
        [pa.array(part[cuts[:-1]], pa.int64()), pa.array([low[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])], pa.binary()),
         pa.array([n[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])], pa.binary())], ["part", "low", "counts"])


def fingerprints(docs, part_bits) -> DataFrame:
    """(part, low, counts) of all phrases of ``docs`` (id, lang, text); a task's counts stop at 255."""
    def run(batches):
        held, size = [], 0
        for _, langs, data, offsets in _texts(batches, 512 << 10):
            for _, _, prints in Block(data, offsets).phrases(_salts(langs)):
                held.append(prints)
                size += len(prints)
            if size >= FLUSH:
                yield _counted(np.concatenate(held), part_bits)
                held, size = [], 0
        if size:
            yield _counted(np.concatenate(held), part_bits)

    return map_arrow(docs, run, "part long, low binary, counts binary")


def frequent(counted, least) -> DataFrame:
    """(part, low): the sorted fingerprints of each part with at least ``least`` occurrences."""
    least = min(least, 255)  # a task's count stops there

    def run(table):
        low = np.frombuffer(b"".join(table["low"].to_pylist()), "<u4")
        n = np.frombuffer(b"".join(table["counts"].to_pylist()), np.uint8)
        order = np.argsort(low)
        low, n = low[order], n[order]
        new = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        low = low[new][np.add.reduceat(n, new, dtype=np.int64) >= least]
        return pa.table({"part": table["part"].slice(0, 1), "low": pa.array([low.tobytes()], pa.binary())})

    prepare(counted.sparkSession)
    return counted.groupBy("part").applyInArrow(run, "part long, low binary")


def _probes(prints, part_bits, map_bits):
    """Two places in the map for each fingerprint, both in its part's stretch of the map."""
    key = prints >> np.uint64(32 - part_bits)
    part, low = key >> np.uint64(32), key & np.uint64(0xFFFFFFFF)
    inner = np.uint64(map_bits - part_bits)
    mask, base = (np.uint64(1) << inner) - np.uint64(1), part << inner
    return base | (W.mix(low + np.uint64(1)) & mask), base | (W.mix(low + np.uint64(1 << 40)) & mask)


def _map_of(found, part_bits, map_bits):
    """The map (packed bits) of the frequent fingerprints; each part's stretch is made in a task."""
    width = 1 << (map_bits - part_bits)

    def run(batches):
        for batch in batches:
            out = []
            for part, low in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                key = (np.uint64(part) << np.uint64(32)) | np.frombuffer(low, "<u4").astype(np.uint64)
                bits = np.zeros(width, bool)
                for spot in _probes(key << np.uint64(32 - part_bits), part_bits, map_bits):
                    bits[(spot & np.uint64(width - 1)).astype(np.int64)] = True
                out.append(np.packbits(bits).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["part", "bits"])

    table = np.zeros((1 << map_bits) // 8, np.uint8)
    for row in map_arrow(found.select("part", "low"), run, "part long, bits binary").toLocalIterator():
        table[row["part"] * width // 8:(row["part"] + 1) * width // 8] = np.frombuffer(row["bits"], np.uint8)
    return table.tobytes()


def _gather(data, start, stop):
    """Strings data[start:stop] as an Arrow array."""
    size = stop - start
    ends = np.concatenate([[0], np.cumsum(size)])
    index = np.arange(ends[-1]) + np.repeat(start - ends[:-1], size)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[index]))


def _word_numbers(block):
    """A number for each word of the block, equal exactly where the words' bytes are."""
    _, first, number = np.unique(block.hash, return_index=True, return_inverse=True)
    lead = first[number]
    size = block.stop - block.start
    same = bool((size == size[lead]).all())
    if same and len(size):
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(ends[-1]) - np.repeat(ends[:-1], size)
        same = bool((block.low[at + np.repeat(block.start, size)] == block.low[at + np.repeat(block.start[lead], size)]).all())
    if not same:  # two words with one hash
        words = _gather(block.low, block.start, block.stop)
        number = words.dictionary_encode().indices.to_numpy()
    return number


def _distinct(words, k, first, prints):
    """(first word of one occurrence of each distinct phrase, group of each occurrence)."""
    _, lead, group = np.unique(prints, return_index=True, return_inverse=True)
    if all((words[first + j] == words[first[lead[group]] + j]).all() for j in range(k)):
        return first[lead], group
    _, lead, group = np.unique(np.stack([words[first + j] for j in range(k)]), axis=1, return_index=True, return_inverse=True)
    return first[lead], group.ravel()


def _write(block, k, at):
    """The texts of the phrases of k words from word ``at`` on, words joined by single spaces."""
    start, stop = block.start[at], block.stop[at + k - 1]
    plain = np.ones(len(at), bool)
    for j in range(k - 1):
        plain &= (block.start[at + j + 1] == block.stop[at + j] + 1) & (block.low[block.stop[at + j]] == 0x20)
    out = _gather(block.low, start, np.where(plain, stop, start))
    if plain.all():
        return out
    texts = out.to_pylist()
    for i in np.flatnonzero(~plain):
        texts[i] = " ".join(block.low[block.start[w]:block.stop[w]].tobytes().decode() for w in range(at[i], at[i] + k))
    return pa.array(texts, pa.large_string())


def occurrences(docs, shared, part_bits, map_bits) -> DataFrame:
    """(lang, phrase, n, doc): phrases that the map lets through, counted by block; a null phrase
    counts all words of the block."""
    def run(batches):
        table = np.frombuffer(shared.value, np.uint8)
        for ids, langs, data, offsets in _texts(batches, BLOCK_BYTES):
            block = Block(data, offsets)
            if not len(block.start):
                continue
            words = _word_numbers(block)
            lang = langs.indices.to_numpy(zero_copy_only=False)[block.doc]
            names, id_ = langs.dictionary, ids.to_numpy(zero_copy_only=False)[block.doc] if not ids.null_count else None
            if id_ is None:
                id_ = np.where(ids.is_null().to_numpy(zero_copy_only=False), np.iinfo(np.int64).max, ids.fill_null(0).to_numpy())[block.doc]
            total = np.bincount(lang, minlength=len(names))
            yield _rows(names.take(pa.array(np.arange(len(names)))), pa.nulls(len(names), pa.large_string()), total, None)
            for k, first, prints in block.phrases(_salts(langs)):
                live = np.ones(len(first), bool)
                for spot in _probes(prints, part_bits, map_bits):
                    live &= (table[(spot >> np.uint64(3)).astype(np.int64)] >> (7 - (spot & np.uint64(7))).astype(np.uint8) & 1).astype(bool)
                first, prints = first[live], prints[live]
                if not len(first):
                    continue
                # languages apart, even where a fingerprint collides
                key = words * len(names) + lang if len(names) > 1 else words
                at, group = _distinct(key, k, first, prints)
                n = np.bincount(group, minlength=len(at))
                doc = np.full(len(at), np.iinfo(np.int64).max)
                np.minimum.at(doc, group, id_[first])
                yield _rows(names.take(pa.array(lang[at])), _write(block, k, at), n, doc)

    return map_arrow(docs, run, "lang string, phrase string, n long, doc long")


def _rows(langs, phrases, n, doc):
    doc = pa.nulls(len(n), pa.int64()) if doc is None else pa.array(doc, pa.int64(), mask=doc == np.iinfo(np.int64).max)
    return pa.RecordBatch.from_arrays([langs.cast(pa.string()), phrases.cast(pa.string()), pa.array(n, pa.int64()), doc],
                                      ["lang", "phrase", "n", "doc"])


def frequent_phrases(df, least=LEAST, id_col="doc_id", text_col="text", lang_col="lang"):
    """(lang, phrase, f, doc) of the phrases of 1 to LONGEST words with f >= ``least``, and (lang, n) of all words."""
    spark = df.sparkSession
    s = Scratch(spark, "phrases")
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(lang_col).cast("string"), F.lit(UNNAMED)).alias("lang"),
                     F.col(text_col).alias("text")).where("text is not null")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).collect()[0][0]
    part_bits = min(31, max(8, (size // PART_ROWS).bit_length()))  # about a phrase a byte
    found = s.cut(frequent(fingerprints(docs, part_bits), least), "frequent")
    number = found.agg(F.coalesce(F.sum(F.octet_length("low") / 4), F.lit(0))).collect()[0][0]
    map_bits = min(MOST_BITS.bit_length() - 1, max(part_bits + 3, int(number * MAP_BITS).bit_length()))
    shared = spark.sparkContext.broadcast(_map_of(found, part_bits, max(map_bits, part_bits + 3)))
    rows = occurrences(docs, shared, part_bits, max(map_bits, part_bits + 3))
    sums = s.cut(rows.groupBy("lang", "phrase").agg(F.sum("n").alias("f"), F.min("doc").alias("doc"))
                 .where(F.col("phrase").isNull() | (F.col("f") >= least)), "phrases")
    return sums.where("phrase is not null"), sums.where("phrase is null").select("lang", F.col("f").alias("n"))


def scored(phrases, inside=INSIDE) -> DataFrame:
    """(lang, phrase, a, l, r, score, doc) of the phrases of 2 words and more that no longer one covers."""
    words = F.split("phrase", " ")
    many = phrases.withColumn("words", words).withColumn("count", F.size("words")).where("count > 1")
    span = lambda start, n: F.array_join(F.slice("words", start, n), " ")
    # cuts
    cuts = many.select("lang", "phrase", F.col("f").alias("a"), "doc", "words", "count", F.explode(F.sequence(F.lit(1), F.col("count") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "doc", "k", span(F.lit(1), F.col("k")).alias("head"),
                       span(F.col("k") + 1, F.col("count") - F.col("k")).alias("tail"))
    known = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    cuts = cuts.join(known, ["lang", "head"]).join(known.select("lang", F.col("head").alias("tail"), F.col("l").alias("r")), ["lang", "tail"])
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    # exact: the whole part of a quotient of decimals
    score = F.expr(f"(cast(a as decimal(20,0)) * {SCALE}bd) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    cuts = cuts.withColumn("score", score)
    least = cuts.groupBy("lang", "phrase", "a", "doc").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # phrases inside longer ones
    parts = many.where("count > 2").select("lang", "f", "words", "count", F.explode(F.sequence(F.lit(2), F.col("count") - 1)).alias("n"))
    parts = parts.select("lang", "f", "words", "n", F.explode(F.sequence(F.lit(1), F.col("count") - F.col("n") + 1)).alias("at"))
    parts = parts.select("lang", "f", span(F.col("at"), F.col("n")).alias("phrase"))
    longer = parts.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    covered = (F.lit(100).cast("decimal(20,0)") * wide("longer")) >= (F.lit(inside).cast("decimal(20,0)") * wide("a"))
    return (least.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~covered)
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", "doc"))


def collocations(df, least=LEAST, top=TOP, id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """The ``top`` collocations of each language: (lang, rank, phrase, a, l, r, n, score, first_doc).

    Words are counted in lower case (A-Z) inside pieces; a null language is ``und``,
    null and empty texts hold no words, repeated rows count each, and null ids are
    ordinary rows (``first_doc`` is the least id that holds the phrase, if any).
    Ties of score go by count, then by phrase in byte order. An empty table gives no
    rows. Other columns are not read.
    """
    phrases, words = frequent_phrases(df, least, id_col, text_col, lang_col)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(phrases).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", F.col("doc").alias("first_doc"))
