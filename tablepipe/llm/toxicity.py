"""Toxicity scores on text restored by noisy-channel decoding.

Disguised words (digits and symbols for letters, letters set apart, letters
repeated) become character lattices: each symbol may stand for its look-alike
letters, a repeated letter for one or two, a separator for nothing or for a word
bound. Viterbi decoding finds the likeliest words under a character trigram model, an equal
mix of the corpus words' model and the model of the learned toxic words, times
the channel's costs. The corpus words' trigrams are counted over the texts of all
documents, labelled or not. Words without such signs have a lattice of one path and
stand as they are.

The restored words are scored by a lexicon of word beginnings and whole words
learned from labels: log odds between toxic and other documents, where a feature
counts once per different word before it, so copies of one document teach
nothing new. A logistic regression on a document's strongest weights, fitted on
other rows than the lexicon, gives the score.

Labels are learned from at most ``TOXIC_ROWS`` and ``OTHER_ROWS`` labelled rows,
those with the smallest hash of the id (documented bounds). Every document is
scored on its whole text.
"""

from __future__ import annotations

import functools
import math
import re
import sys
from collections import Counter, defaultdict
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tablepipe.llm._text import long_column, map_arrow, slices
from tablepipe.llm.langid import held_out

TOXIC_ROWS, OTHER_ROWS = 3000, 6000
PREFIXES = (4, 5, 6)
MIN_CONTEXTS, MIN_WEIGHT = 6, math.log(20)
# Letters that a symbol may stand for.
LOOKS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i"}
SEPARATORS = " .-_*~,'\"`^/\\:;|"
COST_LOOK, COST_DROP, COST_KEEP_TWO, COST_SEPARATOR = 0.7, 0.4, 1.5, 0.2
BEAM = 40
FLUSH = 1 << 20  # different trigrams that a task holds before it passes them on
DENSE = 1 << 22  # trigrams of an alphabet that are counted in a direct table
CACHE = 1_000_000
SETTLE = 64  # symbols after which the words that all paths share are put aside

WORD = re.compile(r"[^\W\d_]+")
_marks = re.escape("".join(LOOKS))
_letter = rf"(?:[^\W_]|[{_marks}])"
REPEATED = re.compile(r"([^\W\d_])\1\1")
RUN = re.compile(r"(.)\1{3,}")  # no word has a letter more than three times in a row
SPACED_TOKEN = re.compile(rf"{_letter}(?:[.\-_*~/]{_letter}){{3,}}")
# at least four single letters with one or two separators between them
SPACED = re.compile(rf"(?<!\S){_letter}(?:[ .\-_*~/]{{1,2}}{_letter}){{3,}}(?!\w)")
PUNCTUATION = ".,;:?\"'()[]{}*#%&-_=~`^/\\\u00ab\u00bb\u201c\u201d\u2018\u2019"
EDGE = re.compile(rf"^([{_marks}])\1{{1,}}|([{_marks}])\2{{1,}}$|[!|(+<]+$")


@functools.lru_cache(1)
def _in_words():
    """Whether ``WORD`` takes a code point."""
    return np.fromiter((c.isalnum() and not c.isdecimal() for c in map(chr, range(sys.maxunicode + 1))), bool, sys.maxunicode + 1)


def trigrams(texts):
    """(codes, counts) of the character trigrams of all words in lower-case texts,
    each word behind ``^^`` and before ``$``; three code points to a code, 21 bits each."""
    points = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    inside = _in_words()[points]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    start = np.flatnonzero(first[inside])  # of each word among the letters
    marks = np.tile(np.array([ord(c) for c in "$^^"], np.int64), len(start))
    chars = np.append(np.insert(points[inside].astype(np.int64), np.repeat(start, 3), marks), ord("$"))
    ends = np.flatnonzero(chars[2:] != ord("^")) + 2
    seen = np.zeros(sys.maxunicode + 1, bool)
    seen[chars] = True
    letters = np.flatnonzero(seen)
    n = len(letters)
    if n ** 3 > DENSE:
        return np.unique((chars[ends - 2] << 21 | chars[ends - 1]) << 21 | chars[ends], return_counts=True)
    rank = (np.cumsum(seen) - 1)[chars]
    counts = np.bincount((rank[ends - 2] * n + rank[ends - 1]) * n + rank[ends], minlength=1)
    codes = np.flatnonzero(counts)
    return (letters[codes // (n * n)] << 21 | letters[codes // n % n]) << 21 | letters[codes % n], counts[codes]


def _summed(codes, counts):
    """Counts of equal codes added up, codes ascending."""
    codes, owner = np.unique(codes, return_inverse=True)
    out = np.zeros(len(codes), np.int64)
    np.add.at(out, owner, counts)
    return codes, out


class Packed:
    """Counts of packed strings in sorted arrays, read like a ``Counter``."""

    def __init__(self, codes, counts):
        self.codes, self.counts = codes, counts

    def __getitem__(self, string):
        code = 0
        for c in string:
            code = code << 21 | ord(c)
        at = int(np.searchsorted(self.codes, np.int64(code)))
        return int(self.counts[at]) if at < len(self.codes) and self.codes[at] == code else 0


def corpus_model(documents, text_col="text"):
    """(trigrams, contexts, letters) of the words of all documents, summed in Spark.

    The driver and the workers hold 16 bytes for each different trigram of the
    corpus: as many as its alphabets give, however many rows there are."""
    def run(batches):
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for _, texts in slices(batches, "__text"):
            more = trigrams([t.lower() for t in texts.to_pylist()])
            codes, counts = _summed(np.concatenate([codes, more[0]]), np.concatenate([counts, more[1]]))
            if len(codes) > FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], ["g", "n"])
                codes, counts = codes[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], ["g", "n"])

    rows = documents.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("__text"))
    got = map_arrow(rows, run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).toArrow()
    codes, counts = _summed(got.column(0).to_numpy(), got.column(1).to_numpy())
    letters = np.unique(codes & (1 << 21) - 1)
    return Packed(codes, counts), Packed(*_summed(codes >> 21, counts)), max(1, len(letters))


class CharModel:
    """Character trigram model: an equal mix of two word lists' models."""

    def __init__(self, common, special):
        self.models = [self._counts(common), self._counts(special)]
        self.cache: dict = {}

    @staticmethod
    def _counts(words):
        grams, contexts, letters = Counter(), Counter(), set("$")
        for w, n in words.items():
            w = f"^^{w}$"
            for i in range(2, len(w)):
                grams[w[i - 2:i + 1]] += n
                contexts[w[i - 2:i]] += n
                letters.add(w[i])
        return grams, contexts, len(letters)

    def log_p(self, context, ch):
        """Log probability of a letter or of the word's end after two letters; a blank ends a word and begins the next."""
        if " " in context:
            context = "^^" if context[1] == " " else "^" + context[1]
        if ch == " ":
            ch = "$"
        got = self.cache.get(context + ch)
        if got is None:
            if len(self.cache) > CACHE:
                self.cache.clear()
            p = 0.0
            for grams, contexts, v in self.models:
                p += 0.5 * (grams[context + ch] + 0.05) / (contexts[context] + 0.05 * (v + 1))
            got = self.cache[context + ch] = math.log(p)
        return got


def lattice(token):
    """[(letters, cost), ...] for each symbol of a disguised token; '' drops it, ' ' is a word bound."""
    out, before = [], ""
    for ch in token:
        if ch.isalpha():
            arcs = [(ch, 0.0)]
            if ch == before:
                arcs = [("", COST_DROP), (ch, COST_KEEP_TWO)]
            before = ch
        else:
            arcs = [(x, COST_LOOK) for x in LOOKS.get(ch, "") if x != before]
            if before and before in LOOKS.get(ch, ""):
                arcs += [("", COST_DROP), (before, COST_KEEP_TWO)]
            if ch in SEPARATORS or not arcs:
                arcs += [("", COST_SEPARATOR), (" ", COST_SEPARATOR)]
            before = "" if ch in SEPARATORS else before
        out.append(arcs)
    return out


def decode(token, model):
    """The likeliest clean words behind a token, blanks between: Viterbi over its lattice."""
    states, settled = {"^^": (0.0, "")}, []
    for at, arcs in enumerate(lattice(token), 1):
        nxt: dict = {}
        for context, (score, word) in states.items():
            for letters, cost in arcs:
                if letters:
                    s, c, w = score - cost + model.log_p(context, letters), context[1] + letters, word + letters
                    if letters == " ":
                        c = "^^"
                else:
                    s, c, w = score - cost, context, word
                if c not in nxt or (s, w) > nxt[c]:
                    nxt[c] = (s, w)
        if len(nxt) > BEAM:
            nxt = dict(sorted(nxt.items(), key=lambda x: x[1], reverse=True)[:BEAM])
        states = nxt
        if at % SETTLE == 0:
            same = commonprefix([w for _, w in states.values()])
            settled.append(same)
            states = {c: (s, w[len(same):]) for c, (s, w) in states.items()}
    return "".join(settled) + max((s + model.log_p(c, "$"), w) for c, (s, w) in states.items())[1]


def disguised(token):
    """What needs decoding in a lower-case token without blanks, or None."""
    bare = EDGE.sub("", token.strip(PUNCTUATION))
    if len(bare) < 3:
        return None
    if SPACED_TOKEN.fullmatch(bare) or REPEATED.search(bare):
        return bare
    letters = sum(map(str.isalpha, bare))
    return bare if letters > 1 and letters * 3 >= len(bare) > letters and any(ch in LOOKS for ch in bare) else None


class Scorer:
    def __init__(self, weights, common, coefficients, corpus=None):
        """``common``: words of the lexicon's texts and their counts; ``corpus``: the ``corpus_model``, else that of ``common``."""
        self.weights, self.coefficients = weights, coefficients
        special = {w: n for w, n in common.items() if self.weight(w) >= MIN_WEIGHT}
        for f in weights:
            special.setdefault(f.strip("$"), 1)
        self.model = CharModel(common, special)
        if corpus is not None:
            self.model.models[0] = corpus
        self.known: dict = {}
        self.decoded: dict = {}

    def weight(self, word):
        w = self.weights
        return max([w.get(word + "$", 0.0), *[w.get(word[:n], 0.0) for n in PREFIXES if len(word) >= n]])

    def restore(self, token):
        """The words of a disguised token or of letters set apart."""
        token = RUN.sub(r"\1\1\1", token)
        if len(self.decoded) > 100_000:
            self.decoded.clear()
        got = self.decoded.get(token)
        if got is None:
            got = self.decoded[token] = decode(token, self.model).split()
        return got

    def token_weight(self, token):
        """Largest weight of the words in a token, as it stands or restored."""
        best = max([self.weight(w) for w in WORD.findall(token)], default=0.0)
        hidden = disguised(token)
        return max([best, *map(self.weight, self.restore(hidden))]) if hidden else best

    def features(self, text):
        """(strongest weight, sum of the five strongest tokens' weights) of a text."""
        text = text.lower()
        tokens = set(text.split())
        known = self.known
        if len(known) > 400_000:
            known.clear()
        for t in tokens.difference(known):
            known[t] = self.token_weight(t)
        weights = [x for x in map(known.__getitem__, tokens) if x]
        weights += [x for x in (self.weight(w) for m in SPACED.finditer(text) for w in self.restore(m[0])) if x]
        top = sorted(weights, reverse=True)[:5]
        return (top[0], sum(top)) if top else (0.0, 0.0)

    def score(self, text):
        a, b, c = self.coefficients
        x, y = self.features(text)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x + c * y))))


def _sample(documents, labels, id_col, text_col, label_col):
    """Bounded labelled rows (text, y, part): part 0 teaches the lexicon, part 1 the regression."""
    y = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y"))
    y = y.where(F.col("__y").isin(0, 1) & F.col("__id").isNotNull()).groupBy("__id").agg(F.max("__y").alias("__y"))
    y = y.where(~held_out("__id"))
    picked = [y.where(F.col("__y") == k).orderBy(F.xxhash64("__id"), "__id").limit(n) for k, n in ((1, TOXIC_ROWS), (0, OTHER_ROWS))]
    y = picked[0].unionAll(picked[1])
    rows = documents.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return rows.join(F.broadcast(y.select("__id", "__y")), "__id").select(  # TOXIC_ROWS + OTHER_ROWS rows
        "__text", "__y", F.pmod(F.xxhash64(F.col("__id"), F.lit(7)), F.lit(2)).cast("int").alias("__part"))


def _word_features(word):
    return [word + "$", *[word[:n] for n in PREFIXES if len(word) >= n]]


def learn(documents, labels, id_col="doc_id", text_col="text", label_col="toxic"):
    """A ``Scorer``, or the share of toxic rows where a class has no rows."""
    sample = _sample(documents, labels, id_col, text_col, label_col).cache()
    try:
        sizes = {(r["__y"], r["__part"]): r["count"] for r in sample.groupBy("__y", "__part").count().collect()}
        toxic, other = (sum(n for (y, _), n in sizes.items() if y == k) for k in (1, 0))
        if not all(sizes.get((y, p)) for y in (0, 1) for p in (0, 1)):
            return toxic / max(1, toxic + other)

        def contexts(batches):
            for _, texts in slices(batches, "__text"):
                seen = set()
                for t in texts.to_pylist():
                    words = WORD.findall(t.lower())
                    for before, w in zip(["", *words], words):
                        seen.update((f, before) for f in _word_features(w))
                seen = sorted(seen)
                yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in seen], pa.string()),
                                                  pa.array([b for _, b in seen], pa.string())], ["f", "b"])

        lexicon = sample.where("__part = 0")
        toxic_counts = (map_arrow(lexicon.where("__y = 1").select("__text"), contexts, "f string, b string")
                        .groupBy("f").agg(F.approx_count_distinct("b", 0.03).alias("n"))
                        .where(F.col("n") >= MIN_CONTEXTS))
        toxic_n = {r["f"]: r["n"] for r in toxic_counts.collect()}  # of at most TOXIC_ROWS texts

        def documents_with(batches):
            counts = Counter()
            for _, texts in slices(batches, "__text"):
                for t in texts.to_pylist():
                    counts.update({f for w in set(WORD.findall(t.lower())) for f in _word_features(w) if f in toxic_n})
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()),
                                              pa.array(list(counts.values()), pa.int64())], ["f", "n"])

        def by_class(k):
            got = map_arrow(lexicon.where(f"__y = {k}").select("__text"), documents_with, "f string, n long")
            return defaultdict(int, {r["f"]: r["n"] for r in got.groupBy("f").agg(F.sum("n").alias("n")).collect()})

        in_toxic, in_other = by_class(1), by_class(0)
        n1, n0 = sizes[1, 0], sizes[0, 0]
        weights = {}
        for f, n in toxic_n.items():
            n = min(n, in_toxic[f])
            odds = math.log((n + 0.5) / (n1 + 1)) - math.log((in_other[f] + 0.5) / (n0 + 1))
            if n >= MIN_CONTEXTS and odds >= MIN_WEIGHT:
                weights[f] = odds

        def vocabulary(batches):
            counts = Counter()
            for _, texts in slices(batches, "__text"):
                for t in texts.to_pylist():
                    counts.update(WORD.findall(t.lower()))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()),
                                              pa.array(list(counts.values()), pa.int64())], ["w", "n"])

        common = map_arrow(lexicon.select("__text"), vocabulary, "w string, n long")
        common = common.groupBy("w").agg(F.sum("n").alias("n")).where("n > 1")  # of the bounded sample
        common = {r["w"]: r["n"] for r in common.collect()}
        corpus = corpus_model(documents, text_col)
        shared = _shared(documents.sparkSession, Scorer(weights, common, (0.0, 1.0, 0.0), corpus))

        def measured(batches):
            draft = _loaded(shared.value)
            for batch, texts in slices(batches, "__text"):
                got = np.array([draft.features(t) for t in texts.to_pylist()])
                yield pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1]), batch.column(1)], ["x", "s", "y"])

        rows = map_arrow(sample.where("__part = 1").select("__text", "__y"), measured, "x double, s double, y int").toArrow()
        x, s, y = (rows.column(k).to_numpy().astype(float) for k in range(3))
        return Scorer(weights, common, _logistic(x, s, y), corpus)
    finally:
        sample.unpersist()


def _logistic(x, s, y, ridge=0.05, rounds=30):
    """Newton's method with a small ridge; classes weigh the same."""
    a = np.stack([np.ones_like(x), x, s], 1)
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    beta = np.zeros(3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (weight * (p - y)) + ridge * beta
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge * np.eye(3)
        step = np.linalg.solve(hess, grad)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(beta.tolist())


def predict(df, scorer, id_col="doc_id", text_col="text"):
    """One row per document: (id, held_out, score, predicted), from the whole text alone.

    Null text counts as empty and is scored as a text without toxic words.
    Repeated rows each give a row; a null id is not held out; other columns are
    not read. Where a class had no labelled rows, every score is the share of
    toxic ones.
    """
    shared = None if isinstance(scorer, float) else _shared(df.sparkSession, scorer)
    constant = scorer if isinstance(scorer, float) else None

    def run(batches):
        own = None if constant is not None else _loaded(shared.value)
        for batch, texts in slices(batches, "__text"):
            got = [constant if own is None else own.score(t) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [long_column(batch, id_col), batch.column(1), pa.array(got, pa.float64()),
                 pa.array([int(x >= 0.5) for x in got], pa.int32())], [id_col, "held_out", "score", "predicted"])

    rows = df.select(id_col, held_out(id_col).alias("held_out"), F.col(text_col).alias("__text"))
    return map_arrow(rows, run, f"`{id_col}` long, held_out boolean, score double, predicted int")


_scorer: dict = {}


def _shared(spark, scorer):
    return spark.sparkContext.broadcast((scorer.weights, scorer.model.models, scorer.coefficients))


def _loaded(value):
    if _scorer.get("of") is not value:
        weights, models, coefficients = value
        s = Scorer(weights, {}, coefficients)
        s.model.models = models
        _scorer.update(of=value, scorer=s)
    return _scorer["scorer"]


def assess(documents, labels, id_col="doc_id", text_col="text", label_col="toxic"):
    """Learn from labelled rows that are not held out, then score every document."""
    return predict(documents, learn(documents, labels, id_col, text_col, label_col), id_col, text_col)
