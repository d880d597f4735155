"""Language, toxicity, quality, token counts and the codec against references and on odd rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablepipe.llm import _words as W
from tablepipe.llm import bpe_codec, langid, pretoken, quality_lm, token_fst, toxicity
from tablepipe.llm._text import slices, utf8_view

PIECES = st.text(alphabet="ab'strevlmd ST\n\t1٣é!?.　\U0001f600ñ", max_size=60)


def split(texts):
    data, offsets = utf8_view(pa.array(texts, pa.string()))
    begin, stop, owner = pretoken.piece_bounds(data, offsets)
    out = [[] for _ in texts]
    for a, b, k in zip(begin, stop, owner):
        out[k].append(data.tobytes()[a:b].decode())
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(PIECES, min_size=1, max_size=5))
def test_pretoken_matches_the_pattern(texts):
    import public_tokenizers as P
    import regex

    assert split(texts) == [regex.findall(P.PATTERN, t) for t in texts]


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import public_tokenizers as P
    import tiktoken

    ranks = bpe_codec.read_ranks(bpe_codec.default_path())
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def some_texts(documents):
    rng = random.Random(5)
    made = ["".join(rng.choice("abcdeth ing") for _ in range(n)) for n in (0, 1, 5, 300, 3000)]
    made += ["a" * 5000, " " * 3000 + "x", "!" * 2500, "".join(rng.choice("aeitrns") for _ in range(2000)), "it's we'll I'd"]
    return made + [r.text for r in documents.orderBy("doc_id").limit(60).collect()]


def test_codec_equals_tiktoken_and_round_trips(documents, tiktoken_encoding):
    texts = some_texts(documents)
    c = bpe_codec.codec(bpe_codec.default_path())
    got = [np.frombuffer(b"".join(e[1] for e in x), "<i4").tolist() for x in c.encode_texts(pa.array(texts))]
    assert got == [tiktoken_encoding.encode_ordinary(t) for t in texts]
    assert [c.decode(g) for g in got] == [t.encode() for t in texts]


def test_codec_digests_on_odd_rows(odd, empty, tiktoken_encoding):
    rows = bpe_codec.digests(odd).collect()
    by_text = Counter()
    for r in odd.collect():
        ids = tiktoken_encoding.encode_ordinary(r.text or "")
        by_text[r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, rows)) == by_text
    assert bpe_codec.digests(empty).count() == 0
    coded = bpe_codec.decode(bpe_codec.encode(odd, path=bpe_codec.default_path()), ids_col="_token_ids")
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in coded.collect())


def test_token_counts_equal_the_library(documents, odd, empty):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = some_texts(documents) + ["a<|endoftext|>b <|endoftext|>", "<|endoftext|>"]
    sizes, counts = token_fst.count_texts(pa.array(texts), token_fst.default_path())
    assert counts.tolist() == [len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(t.encode()) for t in texts]
    want = Counter((r.doc_id, len((r.text or "").encode()), n := len(tok.encode(r.text or "", add_special_tokens=False).ids), n > 1024)
                   for r in odd.collect())
    assert Counter(map(tuple, token_fst.token_counts(odd).collect())) == want
    assert token_fst.token_counts(empty).count() == 0


def test_transducer_restarts_keep_counts(monkeypatch):
    m, _ = token_fst.machine(token_fst.default_path())
    words = [w.encode() for w in "internationalization counterrevolutionary antidisestablishment aaaaaaaaaa".split()]
    want = [m.count(w) for w in words]
    monkeypatch.setattr(token_fst, "MAX_STATES", 5)
    assert [m.count(w) for w in words] == want


def test_slices_are_bounded_and_complete():
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["a" * 10, None, "", "b" * 50, "c", "d"])], ["i", "t"])
    got = [(b.column(0).to_pylist(), t.to_pylist()) for b, t in slices([batch], "t", 12)]
    assert [i for ids, _ in got for i in ids] == list(range(6))
    assert all(len(t) == 1 or sum(map(len, t)) <= 12 for _, t in got)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aB \n\t\x1cé#$", max_size=40), min_size=1, max_size=5))
def test_word_statistics_match_brute_force(texts):
    data, offsets = utf8_view(pa.array(texts, pa.string()))
    got = quality_lm.word_statistics(data, offsets)
    for i, t in enumerate(texts):
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        grams = Counter(zip(ws, ws[1:], ws[2:]))
        repeated = {i + k for i in range(len(ws) - 2) for k in range(3) if grams[tuple(ws[i:i + 3])] > 1}
        want = (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeated))
        assert tuple(int(got[k][i]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want


def test_span_hash_is_free_of_place():
    data = np.frombuffer(b"xx hello yy hello", np.uint8)
    h = W.span_hash(W.prefix_hash(data), np.array([3, 12]), np.array([8, 17]))
    assert h[0] == h[1]


def brute_kneser_ney(texts):
    """Interpolated modified Kneser-Ney of one language, as nested dictionaries."""
    counts = [Counter() for _ in range(5)]
    for t in texts:
        chars = [1, 1, 1, *[32 if c in "\t\n\x0b\x0c\r" else ord(c) for c in t]]
        for i in range(3, len(chars)):
            counts[4][tuple(chars[i - 3:i + 1])] += 1
    for k in (3, 2, 1):
        for g in counts[k + 1]:
            counts[k][g[1:]] += 1
    p = [None] * 5
    for k in range(1, 5):
        c = counts[k]
        of = Counter(c.values())
        y = of[1] / (of[1] + 2 * of[2]) if of[1] + 2 * of[2] else None
        d = {}
        for j in (1, 2, 3):
            v = j - (j + 1) * y * of[j + 1] / of[j] if y is not None and of[j] else 0.5 * j
            d[j] = min(j, max(0.05, v))
        total, held, types = Counter(), Counter(), Counter()
        for g, n in c.items():
            total[g[:-1]] += n
            held[g[:-1]] += d[min(n, 3)]
            types[g[:-1]] += 1
        p[k] = {g: (n - d[min(n, 3)]) / total[g[:-1]] + held[g[:-1]] / total[g[:-1]] * (1 / types[g[:-1]] if k == 1 else p[k - 1][g[1:]])
                for g, n in c.items()}
    return p[4]


def test_model_matches_brute_force(spark, documents):
    docs = documents.where("lang = 'en'").select("doc_id", "text", "lang").limit(40)
    wide = spark.createDataFrame([(10**6 + i, "a\U00010061 the \U0001F600\U0001F601 e\u00e9 the" * (i + 1), "en") for i in range(4)], docs.schema)
    docs = docs.unionByName(wide).cache()
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    p = brute_kneser_ney(texts)
    model = quality_lm.Model(quality_lm.train(docs))
    data, offsets = utf8_view(pa.array(texts))
    hi, lo, _ = quality_lm.gram_stream(data, offsets)
    got = np.exp(model.log_p("en", hi, lo))
    want = np.array([p[h >> 21, h & quality_lm.CHAR, l >> 21, l & quality_lm.CHAR] for h, l in zip(hi.tolist(), lo.tolist())])
    assert len(model.tables[4, "p"][0]) == len(p) and np.all(np.abs(got - want) <= 1e-5 * want)  # every entry its own
    by_context = Counter()
    for g, v in p.items():
        by_context[g[:-1]] += v
    assert max(by_context.values()) < 1 + 1e-9


def test_a_model_in_shards_gives_the_same_scores(odd, documents, monkeypatch):
    for df in (odd, documents):
        want = {(r.doc_id, r.log_ppl is None, r.n_words): r for r in quality_lm.score_all(df).collect()}
        with monkeypatch.context() as m:
            m.setattr(quality_lm, "MODEL_BYTES", 0)
            m.setattr(quality_lm, "SHARD_ENTRIES", 3000)
            got = quality_lm.score_all(df).collect()
        assert len(got) == df.count()
        for r in got:
            w = want[r.doc_id, r.log_ppl is None, r.n_words]
            assert r[:-1] == w[:-1] and (r.log_ppl is None or abs(r.log_ppl - w.log_ppl) < 1e-4)


def test_characters_beyond_16_bits_stay_apart():
    text = "a\U00010061\U0001F600x\U0010FFFF"  # the second one ends in the 16 bits of "a"
    data = np.frombuffer(text.encode(), np.uint8)
    hi, lo, owner = quality_lm.gram_stream(data, np.array([0, len(data)]))
    points = [1, 1, 1] + [ord(c) for c in text]
    assert [(int(h) >> 21, int(h) & quality_lm.CHAR, int(l) >> 21, int(l) & quality_lm.CHAR) for h, l in zip(hi, lo)] == [
        tuple(points[i:i + 4]) for i in range(len(text))]
    assert len(set(quality_lm.fold("en", hi, lo, "4p").tolist())) == len(text)


def test_quality_on_odd_rows(odd, empty, documents):
    rows = quality_lm.assess(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r.kept in (True, False) and not (r.base_failed and r.kept)
    assert all(r.n_words == 0 and r.base_failed for r in rows if r.doc_id in (3, 4, 5))
    assert quality_lm.assess(empty).count() == 0
    clean = quality_lm.assess(documents).where("not base_failed")
    assert clean.where("kept").count() > 0.9 * clean.count()


def test_language_held_out_accuracy(documents):
    rows = langid.identify(documents).join(documents, "doc_id").where("held_out").collect()
    assert rows and sum(r.lang_pred == r.lang for r in rows) >= 0.95 * len(rows)


def test_profile_ranks_by_hand():
    p = langid.Profiles({"x": [ord("a"), ord("b")], "y": [ord("b"), ord("a")]}, top=2)
    assert p.classify("b b a")[0] == "y" and p.classify("a a b")[0] == "x"
    assert p.classify("12 !") == ("und", 0.0) and langid.Profiles({}).classify("abc") == ("und", 0.0)


def test_language_on_odd_rows(odd, empty):
    rows = langid.identify(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (3, 4, 5, 9))
    assert {r.lang_pred for r in rows} == {"en", "und"} and all(0 <= r.score <= 1 for r in rows)
    assert langid.identify(empty).count() == 0
    profiles = langid.learn(odd)
    kept = langid.keep_known(odd, profiles)
    assert kept.columns == odd.columns and kept.where("text is null").count() == 0


def scorer():
    weights = {"idio": 6.0, "idiot$": 6.0, "stupid$": 5.0, "loser$": 5.0}
    return toxicity.Scorer(weights, {"the": 100, "thing": 20, "idiot": 4, "loser": 3, "edlyon": 20, "there": 40, "stupid": 3}, (-4, 1, 0.5))


@pytest.mark.parametrize("text", ["you 1d10t", "!d!ot", "i d i o t", "i.d.i.o.t", "stuuuupid", "$tup1d", "l0s3r", "lo$er***", "IDI0T$$$"])
def test_disguised_words_are_restored(text):
    s = scorer()
    assert s.features(text)[0] >= 5 and s.score(text) > 0.5


@pytest.mark.parametrize("text", ["", "the thing", "there 3 things", "ther*** thing$$$ &&&", "room 101", "A B C", "12345"])
def test_plain_texts_stay_clean(text):
    assert scorer().score(text) < 0.5


@pytest.mark.parametrize("text", ["stu" + 45 * "u" + "pid", "there-" * 12 + "1d10t", "t h e r e t h e " + 8 * "t h i n g " + "l o s e r", "a l o s e r",
                                  "the a 1 d 1 0 t", "| s t u p i d |"])
def test_long_and_joined_disguises_are_restored(text):
    s = scorer()
    assert s.features(text)[0] >= 5 and s.score(text) > 0.5


def test_decoding_is_linear_and_whole():
    s = scorer()
    assert s.restore("the.1d10t." * 3000 + "l0s3r")[-1] == "loser" and "idiot" in s.restore("t h e 1 d 1 0 t")
    token = "thing.st00p!d." * 20
    whole, toxicity.SETTLE = toxicity.SETTLE, 10 ** 9
    try:
        want = toxicity.decode(token, s.model)
    finally:
        toxicity.SETTLE = whole
    assert toxicity.decode(token, s.model) == want


def test_viterbi_is_the_best_path():
    import itertools

    s = scorer()
    for token in ("1d0t", "st00p!d", "aaa1", "l.o"):
        arcs = toxicity.lattice(token)
        best = None
        for path in itertools.product(*arcs):
            word, cost = "".join(a for a, _ in path), sum(c for _, c in path)
            padded = "^^" + word + "$"
            score = sum(s.model.log_p(padded[i - 2:i], padded[i]) for i in range(2, len(padded))) - cost
            best = max(best, (score, word)) if best else (score, word)
        assert toxicity.decode(token, s.model) == best[1]


def test_toxicity_learns_and_holds_out(spark):
    rng = random.Random(3)
    plain = ["alpha", "bravo", "carol", "delta", "echoes", "foxes", "golfer", "hotels"]
    rows, labels = [], []
    for i in range(600):
        ws = [rng.choice(plain) + rng.choice("abcde") for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            for k in range(3):
                ws.insert(rng.randrange(len(ws)), rng.choice(["vexling", "grubber"]))
        rows.append((i, " ".join(ws)))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.assess(docs, marks).join(marks, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert held and all(r.predicted == r.toxic for r in held)


def test_character_model_counts_all_documents(spark, odd):
    rows = [(i, f"alpha{i % 7} bravo carol vexling" if i % 3 == 0 else "alpha bravo carol delta") for i in range(300)]
    rows += [(1000 + i, "Qwyxzor Ωμέγα 漢字 \U00020000a x_y don't qwyxzor") for i in range(50)]  # no labels
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    marks = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    words = Counter(w for _, t in rows for w in toxicity.WORD.findall(t.lower()))
    grams, contexts, n = toxicity.CharModel._counts(words)
    model = toxicity.learn(docs, marks).model
    got, got_contexts, got_n = model.models[0]
    assert len(got.codes) == len(grams) and all(got[g] == k for g, k in grams.items())
    assert len(got_contexts.codes) == len(contexts) and all(got_contexts[c] == k for c, k in contexts.items())
    assert got_n == n and got["zzz"] == 0 and toxicity.decode("qwyxz0r", model) == "qwyxzor"
    for texts in ([t for _, t in rows], [], [""], ["".join(map(chr, range(0x4E00, 0x4F00)))]):
        want = toxicity.CharModel._counts(Counter(w for t in texts for w in toxicity.WORD.findall(t)))[0]
        codes, counts = toxicity.trigrams(texts)
        assert len(codes) == len(want) and all(toxicity.Packed(codes, counts)[g] == k for g, k in want.items())
    assert toxicity.corpus_model(odd.limit(0))[2] == 1


def test_toxicity_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, 0), (3, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.assess(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert toxicity.assess(odd, labels.limit(0)).where("score != 0").count() == 0
    assert toxicity.assess(empty, labels).count() == 0
