"""Quality rules: word statistics and perplexity bands under an n-gram model.

The model is a character 4-gram model with modified Kneser-Ney smoothing, one
per language. Spark counts the 4-grams of all documents (code points in full, two
to a column); lower orders are continuation counts, discounts come from the counts
of counts, and the interpolated probabilities are joins of those aggregates. An
entry is stored under a 64-bit hash of order, language and n-gram, in one sorted
array per order with the log probabilities beside it.

Arrays of up to ``MODEL_BYTES`` go to every task as a whole. A larger model is cut by
hash into shards of ``SHARD_ENTRIES``: the documents that it was counted from have an
entry for each of their 4-grams, so each shard in turn adds its part to their sums.

A document fails outside its language's band of log perplexity: the quartiles of
all documents of the language, widened by ``SPREAD`` interquartile ranges below
and above.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablepipe.llm import _words as W
from tablepipe.llm._text import long_column, map_arrow, slices, utf8_view
from tablepipe.session import scratch_path

ORDER = 4
CHAR_BITS = 21  # of a code point
CHAR = (1 << CHAR_BITS) - 1
MODEL_BYTES, SHARD_ENTRIES = 192 << 20, 8 << 20
SPREAD = 5.0
NO_LANGUAGE = "und"
FLUSH = 1 << 20
SYMBOLS = b"#*$%&|<>"  # fixed value: the symbols that the rules count
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
FLOOR = -30.0


def gram_stream(data, offsets):
    """4-grams ending at each character: (first two and last two code points, packed, as uint64;
    text of each). ASCII white space is a blank, and each text starts after three begin marks."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), "<u4")
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    ends = lead[offsets]
    chars = points.astype(np.uint64)
    chars[(points <= 13) & (points >= 9)] = 32
    chars = np.insert(chars, np.repeat(ends[:-1], ORDER - 1), np.uint64(1))
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(ends))
    at = np.arange(len(owner)) + (ORDER - 1) * (owner + 1)
    pair = chars.copy()
    pair[1:] |= chars[:-1] << np.uint64(CHAR_BITS)
    return pair[at - 2], pair[at], owner


def shorter(hi, lo, order):
    """The last ``order - 1`` characters of n-grams of ``order`` characters; arrays or columns."""
    if isinstance(hi, np.ndarray):
        c = np.uint64(CHAR)
        return (hi & c if order == 4 else np.zeros_like(hi)), (lo & c if order == 2 else lo)
    return (hi.bitwiseAND(F.lit(CHAR)) if order == 4 else F.lit(0).cast("long")), (lo.bitwiseAND(F.lit(CHAR)) if order == 2 else lo)


def context(hi, lo):
    """The characters before the last one of n-grams; arrays or columns."""
    if isinstance(hi, np.ndarray):
        bits, c = np.uint64(CHAR_BITS), np.uint64(CHAR)
        return hi >> bits, (hi & c) << bits | lo >> bits
    return (F.shiftrightunsigned(hi, CHAR_BITS),
            F.shiftleft(hi.bitwiseAND(F.lit(CHAR)), CHAR_BITS).bitwiseOR(F.shiftrightunsigned(lo, CHAR_BITS)))


def fold(language, hi, lo, table):
    """64-bit hash of n-grams of one language in one table of the model."""
    seed = np.uint64(zlib.crc32(f"{table}:{language}".encode()) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    return W.mix(W.mix(np.asarray(hi, np.uint64) + seed) + np.asarray(lo, np.uint64))


def _tally(hi, lo, counts=None):
    """Distinct n-grams (by their 64-bit hash) with their counts."""
    key = W.mix(W.mix(hi) + lo)
    if counts is None:
        _, first, counts = np.unique(key, return_index=True, return_counts=True)
    else:
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        counts = np.bincount(inverse, counts).astype(np.int64)
    return hi[first], lo[first], counts


def count_grams(df, text_col="text", lang_col="lang"):
    """(lang, hi, lo, n): 4-gram counts of all texts, summed per task before the shuffle."""
    def run(batches):
        kept: dict = {}

        def flush():
            for lang, (hi, lo, counts) in kept.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(hi), pa.string()), pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64)),
                     pa.array(counts, pa.int64())], ["lang", "hi", "lo", "n"])
            kept.clear()

        for batch, texts in slices(batches, "__text"):
            data, offsets = utf8_view(texts)
            hi, lo, owner = gram_stream(data, offsets)
            languages, of_text = np.unique(np.array(batch.column(1).to_pylist(), object).astype(str), return_inverse=True)
            of_gram = of_text[owner]
            for k, lang in enumerate(languages.tolist()):
                mine = of_gram == k
                got = _tally(hi[mine], lo[mine])
                if lang in kept:
                    got = _tally(*(np.concatenate(x) for x in zip(kept[lang], got)))
                kept[lang] = got
            if sum(len(x[0]) for x in kept.values()) > FLUSH:
                yield from flush()
        yield from flush()

    rows = df.select(F.col(text_col).alias("__text"), F.coalesce(F.col(lang_col), F.lit(NO_LANGUAGE)).alias("__lang"))
    return map_arrow(rows, run, "lang string, hi long, lo long, n long").groupBy("lang", "hi", "lo").agg(F.sum("n").alias("n"))


def _discounts(counts):
    """Per language the three discounts of modified Kneser-Ney."""
    of = [F.count_if(F.col("n") == k).cast("double").alias(f"c{k}") for k in range(1, 5)]
    t = counts.groupBy("lang").agg(*of).withColumn("y", F.try_divide("c1", F.col("c1") + 2 * F.col("c2")))
    out = [F.least(F.lit(float(k)), F.greatest(F.lit(0.05), F.coalesce(
        k - (k + 1) * F.col("y") * F.try_divide(f"c{k + 1}", f"c{k}"), F.lit(0.5 * k)))).alias(f"d{k}") for k in (1, 2, 3)]
    return t.select("lang", *out)


def _smoothed(counts, order):
    """The entries of one order with their context (chi, clo) and its back-off weight gamma, and the
    probability that the order itself gives."""
    chi, clo = context(F.col("hi"), F.col("lo")) if order > 1 else (F.lit(0).cast("long"), F.lit(0).cast("long"))
    c = counts.join(F.broadcast(_discounts(counts)), "lang").withColumns({"chi": chi, "clo": clo})  # a row a language
    discount = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    c = c.withColumn("d", discount)
    ctx = c.groupBy("lang", "chi", "clo").agg(F.sum("n").alias("total"), F.sum("d").alias("held"), F.count("*").alias("types"))
    c = c.join(ctx, ["lang", "chi", "clo"]).withColumn("gamma", F.col("held") / F.col("total"))
    return c, (F.col("n") - F.col("d")) / F.col("total")


def tables(df, text_col="text", lang_col="lang"):
    """[(order, kind, frame (lang, hi, lo, v))]: the log probabilities and back-off weights of the
    model of all of ``df``."""
    spark = df.sparkSession
    path = scratch_path(spark, "grams")
    count_grams(df, text_col, lang_col).write.parquet(path)
    counts = {ORDER: spark.read.parquet(path)}
    for k in range(ORDER - 1, 0, -1):  # continuation counts
        hi, lo = shorter(F.col("hi"), F.col("lo"), k + 1)
        counts[k] = (counts[k + 1].select("lang", hi.alias("hi"), lo.alias("lo")).groupBy("lang", "hi", "lo").agg(F.count("*").alias("n")))
    out, lower = [], None
    for k in range(1, ORDER + 1):
        c, own = _smoothed(counts[k], k)
        if lower is None:
            c = c.withColumn("p", own + F.col("gamma") / F.col("types"))
        else:
            hi, lo = shorter(F.col("hi"), F.col("lo"), k)
            below = lower.select("lang", F.col("hi").alias("bhi"), F.col("lo").alias("blo"), F.col("p").alias("p_below"))
            c = c.withColumns({"bhi": hi, "blo": lo}).join(below, ["lang", "bhi", "blo"])
            c = c.withColumn("p", own + F.col("gamma") * F.col("p_below"))
        path = scratch_path(spark, f"order{k}")
        c.select("lang", "hi", "lo", "chi", "clo", "gamma", "p").write.parquet(path)
        lower = spark.read.parquet(path)
        out.append((k, "p", lower.select("lang", "hi", "lo", F.log("p").alias("v"))))
        if k > 1:
            weights = lower.groupBy("lang", F.col("chi").alias("hi"), F.col("clo").alias("lo")).agg(F.log(F.max("gamma")).alias("v"))
            out.append((k, "gamma", weights))
    return out


def keyed(frame, order, kind) -> DataFrame:
    """(key, v) of a table of the model."""
    def run(batches):
        for b in batches:
            langs = np.array(b.column(0).to_pylist(), object)
            hi, lo = (b.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (1, 2))
            key = np.zeros(len(hi), np.uint64)
            for lang in set(langs.tolist()):
                mine = langs == lang
                key[mine] = fold(lang, hi[mine], lo[mine], f"{order}{kind}")
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), b.column(3).cast(pa.float32())], ["key", "v"])

    return map_arrow(frame, run, "key long, v float")


def collected(frame):
    """Sorted keys and their values. Callers bound the rows."""
    got = frame.toArrow()
    keys, values = got.column(0).to_numpy().view(np.uint64), got.column(1).to_numpy()
    order = np.argsort(keys, kind="stable")
    return keys[order], values[order]


def train(df, text_col="text", lang_col="lang"):
    """Sorted hash arrays [(order, kind, keys, log values)] of the model of all of ``df``, whatever their size."""
    return [(k, kind, *collected(keyed(t, k, kind))) for k, kind, t in tables(df, text_col, lang_col)]


class Model:
    """Scores texts by binary search in the sorted arrays."""

    def __init__(self, arrays):
        self.tables = {(order, kind): (slots, values) for order, kind, slots, values in arrays}

    def look_up(self, language, hi, lo, order, kind):
        """Log values of n-grams, NaN where the model has none."""
        keys, values = self.tables[order, kind]
        return found(keys, values, fold(language, hi, lo, f"{order}{kind}"))

    def log_p(self, language, hi, lo, order=ORDER):
        """Log probability of the last character of each n-gram: its own entry,
        or the context's back-off weight and the shorter n-gram."""
        out = self.look_up(language, hi, lo, order, "p")
        miss = np.isnan(out)
        if miss.any():
            if order == 1:
                out[miss] = FLOOR
            else:
                h, l = hi[miss], lo[miss]  # noqa: E741
                gamma = self.look_up(language, *context(h, l), order, "gamma")
                gamma = np.where(np.isnan(gamma), 0.0, gamma)
                out[miss] = np.maximum(FLOOR, gamma + self.log_p(language, *shorter(h, l, order), order - 1))
        return out


def found(keys, values, want):
    """Values of the wanted keys in sorted arrays, NaN where there is none."""
    if not len(keys):
        return np.full(len(want), np.nan)
    at = np.searchsorted(keys, want)
    at[at == len(keys)] = 0
    return np.where(keys[at] == want, values[at], np.nan).astype(np.float64)


_model: dict = {}


def _loaded(shared):
    if _model.get("id") != shared.id:
        _model.update(id=shared.id, model=Model(shared.arrays.value))
    return _model["model"]


class _Shared:
    def __init__(self, spark, arrays):
        import uuid

        self.id, self.arrays = uuid.uuid4().hex, spark.sparkContext.broadcast(arrays)


def word_statistics(data, offsets):
    """Columns of the base rules for each text, as int64 arrays."""
    n = len(offsets) - 1
    start, stop, owner = W.words(data, offsets)
    per_text = lambda text, weight=None: np.bincount(text, weight, minlength=n).astype(np.int64)
    out = {"n_words": per_text(owner)}
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    out["word_chars"] = per_text(owner, (lead[stop] - lead[start]).astype(np.float64))
    symbol = np.zeros(256, np.int64)
    symbol[list(SYMBOLS)] = 1
    seen = np.concatenate([[0], np.cumsum(symbol[data])])
    out["n_symbols"] = seen[offsets[1:]] - seen[offsets[:-1]]
    prefix = W.prefix_hash(data)
    # lines with a word
    breaks = np.flatnonzero(data == 10)
    cuts = np.unique(np.concatenate([breaks + 1, offsets[:-1][np.diff(offsets) > 0]])) if len(data) else np.zeros(0, np.int64)
    cuts = cuts[cuts < len(data)]
    if len(cuts):
        line_text = np.searchsorted(offsets, cuts, side="right") - 1
        until = np.append(cuts[1:], len(data))
        until = np.minimum(until, offsets[line_text + 1])
        until = until - (data[until - 1] == 10)
        first_word = np.searchsorted(start, cuts)
        has = np.zeros(len(cuts), bool)
        ok = first_word < len(start)
        has[ok] = start[first_word[ok]] < until[ok]
        text, keys = line_text[has], W.span_hash(prefix, cuts[has], until[has])
        pairs = np.unique(W.mix(keys + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
        out["n_dup_lines"] = per_text(text) - per_text(text[pairs])
    else:
        out["n_dup_lines"] = np.zeros(n, np.int64)
    # words in repeated 3-word windows
    covered = np.zeros(len(start), bool)
    if len(start) > 2:
        h = W.span_hash(prefix, start, stop)
        inside = owner[:-2] == owner[2:]
        key = W.mix(W.mix(W.mix(h[:-2]) + h[1:-1]) + h[2:])
        key = W.mix(key + owner[:-2].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        again = np.zeros(len(key), bool)
        again[inside] = W.group_sizes(key[inside]) > 1
        for k in range(3):
            covered[k:len(start) - 2 + k] |= again
    out["n_repeat_words"] = per_text(owner, covered.astype(np.float64))
    return out


def score(df, arrays, id_col="doc_id", text_col="text", lang_col="lang"):
    """Per document (id, lang, word statistics, log_ppl); log_ppl is null for a text without characters."""
    shared = _Shared(df.sparkSession, arrays)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        model = _loaded(shared)
        for batch, texts in slices(batches, "__text"):
            data, offsets = utf8_view(texts)
            stats = word_statistics(data, offsets)
            hi, lo, owner = gram_stream(data, offsets)
            lang = batch.column(1).to_pylist()
            languages, of_text = np.unique(np.array(lang, object).astype(str), return_inverse=True)
            of_gram, logs = of_text[owner], np.zeros(len(hi))
            for k, name in enumerate(languages.tolist()):
                mine = of_gram == k
                logs[mine] = model.log_p(name, hi[mine], lo[mine])
            sums = np.bincount(owner, logs, minlength=len(lang))
            chars = np.bincount(owner, minlength=len(lang))
            log_ppl = -sums / np.maximum(chars, 1)
            yield pa.RecordBatch.from_arrays(
                [long_column(batch, id_col), batch.column(1), *[pa.array(stats[x], pa.int64()) for x in names],
                 pa.array(log_ppl, pa.float64(), mask=chars == 0)], [id_col, "lang", *names, "log_ppl"])

    rows = df.select(id_col, F.coalesce(F.col(lang_col), F.lit(NO_LANGUAGE)).alias("__lang"), F.col(text_col).alias("__text"))
    schema = f"`{id_col}` long, lang string, " + ", ".join(f"{x} long" for x in names) + ", log_ppl double"
    return map_arrow(rows, run, schema)


def score_in_shards(df, frame, entries, id_col="doc_id", text_col="text", lang_col="lang"):
    """What ``score`` gives for the very documents that the model was counted from, where its 4-gram
    table is too large for a task: each shard adds the log probabilities of its 4-grams. Rows with
    equal id, language and text have equal sums."""
    spark = df.sparkSession
    shards = max(1, -(-entries // SHARD_ENTRIES))
    keys = F.pmod("key", F.lit(shards))
    path = scratch_path(spark, "model")
    frame.withColumn("shard", keys).write.partitionBy("shard").parquet(path)
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(lang_col), F.lit(NO_LANGUAGE)).alias("lang"),
                     F.xxhash64(text_col).alias("h"), F.col(text_col).alias("__text"))
    parts = scratch_path(spark, "sums")
    for j in range(shards):
        shard = spark.read.parquet(path).where(F.col("shard") == j).select("key", "v")
        shared = spark.sparkContext.broadcast(collected(shard))

        def run(batches, shared=shared, j=j):
            keys, values = shared.value
            for batch, texts in slices(batches, "__text"):
                hi, lo, owner = gram_stream(*utf8_view(texts))
                of_gram, logs = np.array(batch.column(1).to_pylist(), object)[owner], np.zeros(len(hi))
                for name in set(of_gram.tolist()):
                    mine = np.flatnonzero(of_gram == name)
                    want = fold(name, hi[mine], lo[mine], f"{ORDER}p")
                    here = want.view(np.int64) % shards == j
                    logs[mine[here]] = found(keys, values, want[here])
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(2), pa.array(np.bincount(owner, logs, minlength=n)),
                     pa.array(np.bincount(owner, minlength=n), pa.int64())], ["id", "lang", "h", "logs", "chars"])

        map_arrow(rows, run, "id long, lang string, h long, logs double, chars long").groupBy("id", "lang", "h").agg(
            F.first("logs").alias("logs"), F.first("chars").alias("chars")).write.mode("append").parquet(parts)
        shared.destroy()
    sums = spark.read.parquet(parts).groupBy("id", "lang", "h").agg(F.sum("logs").alias("logs"), F.first("chars").alias("chars"))
    sums = sums.select(F.col("id").alias("__id"), F.col("lang").alias("__lang"), F.col("h").alias("__h"),
                       F.when(F.col("chars") > 0, -F.col("logs") / F.col("chars")).alias("log_ppl"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def statistics(batches):
        for batch, texts in slices(batches, "__text"):
            stats = word_statistics(*utf8_view(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.array(stats[x], pa.int64()) for x in names]], ["id", "lang", "h", *names])

    stats = map_arrow(rows, statistics, "id long, lang string, h long, " + ", ".join(f"{x} long" for x in names))
    same = F.col("id").eqNullSafe(F.col("__id")) & (F.col("lang") == F.col("__lang")) & (F.col("h") == F.col("__h"))
    return stats.join(sums, same).select(F.col("id").alias(id_col), "lang", *names, "log_ppl")


def score_all(df, id_col="doc_id", text_col="text", lang_col="lang"):
    """``score`` of the documents under the model of these documents."""
    model = tables(df, text_col, lang_col)
    sizes = [t.count() for _, _, t in model]
    if 12 * sum(sizes) <= MODEL_BYTES:
        return score(df, [(k, kind, *collected(keyed(t, k, kind))) for k, kind, t in model], id_col, text_col, lang_col)
    top = [i for i, (k, kind, _) in enumerate(model) if (k, kind) == (ORDER, "p")][0]
    return score_in_shards(df, keyed(model[top][2], ORDER, "p"), sizes[top], id_col, text_col, lang_col)


def bands(scored, spread=SPREAD):
    """(lang, lower, upper) of log perplexity over all scored documents."""
    q = F.percentile_approx("log_ppl", F.array(F.lit(0.25), F.lit(0.75)), F.lit(10_000))
    return (scored.groupBy("lang").agg(q.alias("q"))
            .select("lang", F.expr(f"q[0] - {spread} * (q[1] - q[0])").alias("lower"),
                    F.expr(f"q[1] + {spread} * (q[1] - q[0])").alias("upper")))


def assess(df, id_col="doc_id", text_col="text", lang_col="lang", spread=SPREAD):
    """One row per document: (id, word statistics, base_failed, kept, log_ppl).

    Null text counts as empty: no words, base_failed. A null language is a
    language of its own (``und``). Repeated rows each give a row; a null id
    stays null; other columns are not read. An empty table gives no rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "scored")
    score_all(df, id_col, text_col, lang_col).write.parquet(path)
    scored = spark.read.parquet(path)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    inside = F.coalesce(F.col("log_ppl").between(F.col("lower"), F.col("upper")), F.lit(False))
    return (scored.join(F.broadcast(bands(scored, spread)), "lang", "left")  # a row a language
            .select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), (~failed & inside).alias("kept"), "log_ppl"))
