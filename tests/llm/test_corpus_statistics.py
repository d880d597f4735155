"""Phrase mining, source mixing and the filter audit, held against plain Python."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablepipe.llm import _sketch, filter_audit, mixing, phrases
from tablepipe.llm import _words as W


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# phrases


def brute_phrases(rows, least, top):
    counts, total, docs = Counter(), Counter(), defaultdict(set)
    for i, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                for j in range(len(w) - k + 1):
                    counts[lang, tuple(w[j:j + k])] += 1
                    docs[lang, tuple(w[j:j + k])].add(i)
    f = {p: n for p, n in counts.items() if n >= least}
    out = defaultdict(list)
    for (lang, w), a in f.items():
        if len(w) < 2:
            continue
        if any(100 * b >= 80 * a for (x, v), b in f.items() if x == lang and len(v) > len(w)
               and any(v[j:j + len(w)] == w for j in range(len(v) - len(w) + 1))):
            continue
        s, k = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        ids = [i for i in docs[lang, w] if i is not None]
        out[lang].append((-s, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]], min(ids, default=None)))
    return {(lang, r, p.decode(), -a, l_, r_, total[lang], -s, d) for lang, x in out.items()
            for r, (s, a, p, l_, r_, d) in enumerate(sorted(x)[:top], 1)}


def phrase_rows():
    rng = random.Random(5)
    words = ["The", "the", "cat", "sat", "on", "mat", "ünï", "日本", "a", "x\x0by", "it's", "#1"]
    gaps = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "!", "\r\n", " ; "]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(60)))
        rows.append((rng.choice([i, i, i, None, 7]), text, rng.choice(["en", "en", "en", "de", None, "und"])))
    return rows + [(1, None, "en"), (2, "", "en"), (3, " ,. ", None), (4, "the cat " * 3000, "xx")] + rows[:15]


@pytest.mark.parametrize("least,top", [(3, 2000), (9, 4)])
def test_phrases_match_brute_force(spark, least, top):
    rows = phrase_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for name in ("phrase", "part", "rank", "id", "f", "n", "low", "score"):
        df = df.withColumn(name, F.lit("clash"))
    got = phrases.collocations(df.repartition(5), least=least, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "first_doc"]
    assert {tuple(r) for r in got.collect()} == brute_phrases(rows, least, top)


def test_phrases_of_no_rows(spark, empty):
    assert phrases.collocations(empty).count() == 0


def test_long_texts_are_cut_at_pieces_only(spark, monkeypatch):
    text = "one two three four, five six. " * 500 + "seven eight " * 500
    monkeypatch.setattr(phrases, "LONGEST", 4)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"id": [1], "lang": ["en"], "text": [text]})
    parts = list(phrases._texts([batch], 1000))
    assert b"".join(p[2].tobytes() for p in parts).decode() == text and len(parts) > 5
    whole = Counter(re.findall(r"\w+", text))
    assert sum(len(phrases.Block(p[2], p[3]).start) for p in parts) == sum(whole.values())
    assert all(phrases._ENDS[p[2][-1]] for p in parts[:-1])


def test_colliding_hashes_are_told_apart_by_text():
    data = np.frombuffer(b"aa bb aa cc bb aa", np.uint8)
    block = phrases.Block(data, np.array([0, len(data)]))
    exact = phrases._word_numbers(block)
    block.hash = np.zeros(len(block.start), np.uint64)  # every word collides
    words = phrases._word_numbers(block)
    for x in (exact, words):
        assert len(set(x)) == 3 and x[0] == x[2] == x[5] and x[1] == x[4]
    first = np.arange(5)
    at, group = phrases._distinct(words, 2, first, np.zeros(5, np.uint64))
    seen = [tuple(words[i:i + 2]) for i in first]
    assert len(at) == len(set(seen)) and [tuple(words[at[g]:at[g] + 2]) for g in group] == seen


def test_map_has_every_fingerprint_and_few_others():
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 2**63, 5000, np.uint64)
    spots = phrases._probes(prints, 8, 17)
    table = np.zeros(1 << 17, bool)
    for s in spots:
        assert (s >> np.uint64(9) == prints >> np.uint64(56)).all()  # in the part's stretch
        table[s.astype(np.int64)] = True
    others = rng.integers(0, 2**63, 5000, np.uint64)
    assert np.logical_and(*(table[s.astype(np.int64)] for s in phrases._probes(others, 8, 17))).mean() < 0.02


# mixing


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by repeated resharing: {source: words} -> {source: target}."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level >= most * sizes[s]}
        if not over:
            out.update((s, weight[s] * level) for s in free)
            break
        out.update((s, float(most * sizes[s])) for s in over)
        left -= sum(most * sizes[s] for s in over)
        free -= over
    return out


def mixing_rows():
    rng = random.Random(11)
    rows = []
    for i in range(3000):
        source = rng.choices(["b", "a", "é", "Z", None, "", "tiny"], [33, 20, 15, 10, 10, 10, 1])[0]
        rows.append((i, " ".join("w" * rng.randrange(1, 5) for _ in range(int(rng.expovariate(1 / 40)))), source))
    same = (None, "same words of a repeated row", "b")
    return rows + [same] * 700 + [(5, None, "a"), (6, "", "a"), (7, " \n\x1c ", "z"), (None, None, None), (8, None, "only null")]


def test_mix_meets_targets(spark):
    rows = mixing_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for name in ("size", "id", "place", "no", "taken", "target", "upto", "bucket"):
        df = df.withColumn(name, F.lit("clash"))
    out = mixing.mix(df).collect()
    size = Counter()
    for _, text, source in rows:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    goal = brute_targets(size)
    assert len(out) == len(rows)
    assert Counter((r.doc_id, r.size) for r in out) == Counter((i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, _ in rows)
    assert all(r.taken in (0, r.size, 2 * r.size) for r in out)
    taken = Counter()
    by_target = {(size[s], round(goal[s], 6)): s for s in size}
    for r in out:
        taken[by_target[r.source_size, round(r.target, 6)]] += r.taken
    largest = max(r.size for r in out)
    assert all(abs(taken[s] - goal[s]) <= 2 * largest for s in size), (taken, goal)
    assert 0 <= 1.5 * sum(size.values()) - sum(taken.values()) <= largest
    assert any(goal[s] == 2 * size[s] for s in size if size[s]) and any(goal[s] < size[s] for s in size)
    again = mixing.mix(df.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))


def test_schedule_is_the_mix_in_order(spark):
    df = spark.createDataFrame(mixing_rows(), "doc_id long, text string, source string")
    mix = mixing.Mix(df)
    rows = mix.schedule().collect()
    keys = [(r.finish, r.no, r.upto) for r in rows]
    assert keys == sorted(keys)
    assert sum(r.size for r in rows) == sum(r.taken for r in mix.shares().collect())


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 1000, "c": 1000}, {None: 10, "a": 10}, {"a": 5}, {"a": 0, "b": 7, "c": 100, "d": 1}, {"a": 0}])
@pytest.mark.parametrize("share,most", [((3, 2), 2), ((2, 1), 2), ((1, 3), 1)])
def test_targets(spark, sizes, share, most):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(df, share=share, most=most).collect()}
    want = brute_targets(sizes, share=share[0] / share[1], most=most)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_mix_of_no_rows(spark, empty, odd):
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(odd).count() == odd.count()


# filter audit


def brute_audit(rows, labels):
    quality, toxic = set(), set()
    for i, q, t in labels:
        if q == 1:
            quality.add(i)
        if t == 1:
            toxic.add(i)
    parts = defaultdict(list)
    for i, text, lang in rows:
        text, w = text or "", re.findall(r"[^\x20\x09-\x0D]+", text or "")
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
                 "D": bool(re.search("[#$%&*|]", text)),
                 "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows)}
        parts[lang or ""].append(({f for f in fails if fails[f]}, i is not None and i in quality, i is not None and i in toxic))
    out, shapley = {}, Counter()
    for part, docs in parts.items():
        for order in map("".join, permutations("ABCDE")):
            for k, f in enumerate(order):
                before = set(order[:k])
                here = [d for d in docs if f in d[0] and not d[0] & before]
                shapley[part, f] += len(here)
                out[part, order, k + 1] = (sum(not d[0] & (before | {f}) for d in docs), len(here),
                                           sum(f in d[0] and bool(d[0] & before) for d in docs), sum(d[0] == {f} for d in docs),
                                           sum(d[1] for d in here), sum(d[2] for d in here))
    return {(p, o, k, *v, shapley[p, o[k - 1]]) for (p, o, k), v in out.items()}


def audit_rows():
    rng = random.Random(2)
    rows = []
    for i in range(150):
        n = rng.choice([0, 5, 99, 100, 130])
        vocabulary = rng.choice([10, 81, 100, 100000])
        w = [rng.choice(["x", "X", "ß"]) + str(rng.randrange(vocabulary)) for _ in range(n)]
        rows.append((i, " ".join(w) + rng.choice(["", "", "#", " 50%", "AAAAAAAAAAAAAA"]), rng.choice(["en", "en", "de", None, ""])))
    copies = [(rng.choice([i + 200, -i, i, None]), t, lang) for i, t, lang in rng.choices(rows, k=60)]
    return rows + copies + [(900, None, "en"), (901, "", "fr"), (None, None, None), (902, "a b " * 200000, "en")]


def test_audit_matches_brute_force(spark):
    rows = audit_rows()
    labels = [(i, i % 2, i % 3 // 2) for i in range(0, 300, 2)] + [(None, 1, 1), (4, None, 1), (6, 1, None), (6, 0, 0), (999999, 1, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for name in ("id", "h", "mask", "part", "first", "good", "toxic", "n", "step"):
        df = df.withColumn(name, F.lit("clash"))
    got = filter_audit.audit(df.repartition(6), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert {tuple(r) for r in got} == brute_audit(rows, labels)
    assert len(got) == 600 * len({r[2] or "" for r in rows})


def test_audit_of_no_rows(spark, empty):
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty, labels).count() == 0
    some = spark.createDataFrame([(1, "x", "en")], "doc_id long, text string, lang string")
    rows = filter_audit.audit(some, labels.limit(0)).collect()
    assert len(rows) == 600 and sum(r.good_lost for r in rows) == 0


def test_a_small_sketch_changes_no_result(spark, monkeypatch):
    rows = [(i, f"text {i % 40}", "en") for i in range(100)] + [(i, f"other {i}", "en") for i in range(100, 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    want = {tuple(r) for r in filter_audit.audit(df, labels).collect()}
    monkeypatch.setattr(_sketch, "MOST_SLOTS", 1 << 16)
    monkeypatch.setattr(_sketch, "SLOTS", 1)
    assert {tuple(r) for r in filter_audit.audit(df, labels).collect()} == want


def test_sketches_clear_unique_texts_only(spark):
    h = [W.mix(np.array([i], np.uint64)).view(np.int64)[0].item() for i in range(500)]
    df = spark.createDataFrame([(x,) for x in h + h[:50] * 3], "h long").repartition(4)
    slots = 1 << 16
    repeat = _sketch.bit_map(spark, df, slots, least=2)
    flagged = {r.h for r in df.distinct().where(repeat("h")).collect()}
    assert set(h[:50]) <= flagged and len(flagged) < 60
