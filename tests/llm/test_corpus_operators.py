"""WARC, near-duplicates, substring dedup, licenses, decontamination and the pipeline."""

import base64
import gzip
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablepipe.llm import decontaminate, licenses, minhash, oracle_sql, queries, substring_dedup, warc
from tablepipe.llm.suffix_array import permuted_lcp, suffix_array
from tablepipe.plans.oracle import compare, duckdb_views


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_oracles(spark, sf, name):
    ok, message = compare(queries()[name](spark, sf), duckdb_views(sf), oracle_sql()[name])
    assert ok, message


# WARC


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, run string")


ODD_PAGES = [(1, "http://www.B.org/x?q=1#f", "same", "r"), (2, "https://a.org/", "same", "r"), (2, "https://a.org/", "same", "r"),
             (3, None, None, None), (4, "", "", None), (None, "http://a.org/n", "same", "r"), (None, None, None, None),
             (5, "http://a.org/\r\n\r\nX: 1", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "r"), (6, "http://a.org/é", "é" * 70000, "r")]


def test_warc_round_trip_on_odd_rows(spark, out):
    df = pages(spark, ODD_PAGES)
    rows = warc.round_trip(df, f"{out}/warc").collect()
    least = {}
    for i, _, html, _ in ODD_PAGES:
        if i is not None:
            least[html or ""] = min(i, least.get(html or "", i))
    want = Counter()
    for i, _, html, _ in ODD_PAGES:
        body = (html or "").encode()
        first = least.get(html or "")
        again = first is not None and i != first
        want[i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response",
             first if again else None] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    ordered = sorted(rows, key=lambda r: (r.range_no, r.place))
    keys = [(r.urlkey, r.captured, r.page_id is None, r.page_id or 0) for r in ordered]
    assert keys == sorted(keys)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_reads_members_and_plain_archives():
    def record(kind, payload, extra=""):
        block = f"HTTP/1.1 200 OK\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
        return (f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:7>\r\nWARC-Target-URI: http://x.org/\r\n"
                f"WARC-Date: 2024-01-02T03:04:05Z\r\n{extra}Content-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"

    many = [record("warcinfo", b"x"), record("response", b"ab" * 50000), record("response", b"")]
    for content in (b"".join(many), b"".join(map(gzip.compress, many)), gzip.compress(b"".join(many))):
        lines = warc.index_lines(content, "f")
        assert sorted(x[1] for x in lines) == [0, 100000] and lines[0][5:7] == ("org,x)/", "20240102030405")
    with pytest.raises(ValueError):
        warc.index_lines(record("response", b"abc", "WARC-Payload-Digest: sha1:WRONG\r\n"), "f")
    with pytest.raises(ValueError):
        warc.index_lines(many[1][:200], "f")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9)), max_size=7))
def test_loser_tree_merges(runs):
    runs = [sorted(r) for r in runs]
    got = list(warc.LoserTree([[(x,) for x in r] for r in runs], lambda line: line))
    assert got == sorted((x,) for r in runs for x in r)


# near-duplicates


def brute_groups(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    comp = {i: i for i in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                comp[y] = x
    return {(i, len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(spark, documents, width, percent):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(500)]
    base = [rng.choice(words) for _ in range(120)]
    rows = []
    for i in range(90):  # a family with random edits, so similarities lie around the threshold
        t = list(base)
        for _ in range(rng.randrange(7)):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((1000 + i, " ".join(t)))
    rows += [(r.doc_id, r.text) for r in documents.collect()] + [(2000, ""), (2001, None), (2002, "one two"), (2003, "One  two")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(df, width=width, percent=percent).select("doc_id", "n_shingles", "component_id", "kept")
    assert set(map(tuple, got.collect())) == brute_groups(rows, width, percent)


def test_near_duplicates_on_odd_rows(odd, empty):
    rows = minhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {(r.doc_id, r.component_id) for r in rows if r.doc_id in (1, 2, 3, 4, 5)} == {(1, 1), (2, 1), (3, 3), (4, 4), (5, 5)}
    assert all(not r.kept for r in rows if r.doc_id is None)
    assert minhash.near_duplicates(empty).count() == 0


def test_pruning_bound_keeps_what_it_promises():
    import math

    bounds = minhash.least_matches(0.85)
    for n, least in zip(range(minhash.BATCH, minhash.HASHES + 1, minhash.BATCH), bounds):
        below = sum(math.comb(n + 1, k) * 0.85**k * 0.15**(n + 1 - k) for k in range(least))
        assert below < minhash.MISS


# suffix arrays and substring dedup


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array_matches_sorting(symbols):
    text = np.array(symbols, np.int64)
    assert suffix_array(text, 4).tolist() == sorted(range(len(text)), key=lambda i: symbols[i:])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=12), min_size=1, max_size=8))
def test_permuted_lcp(strings):
    parts = [[ord(c) - 95 for c in s] for s in strings]
    text = np.array([x for p in parts for x in [*p, 0]], np.int64)
    ends = np.flatnonzero(text == 0)
    first = np.append(0, ends[:-1] + 1)
    sa = suffix_array(text, 4)
    got = permuted_lcp(text, sa, first, ends)

    def suffix(i):
        return text[i:ends[np.searchsorted(ends, i)]].tolist()

    for rank, p in enumerate(sa):
        if text[p] != 0 and rank:
            a, b = suffix(p), suffix(sa[rank - 1])
            same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert got[p] == same


def brute_repeats(rows):
    last = 2**63
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            w = b[p:p + 50]
            first[w] = min(first.get(w, last), last if i is None else i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < (last if i is None else i):
                gone[p:p + 50] = b"\1" * 50
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return Counter(out)


RESULT = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_repeats_match_brute_force(spark, documents):
    rng = random.Random(2)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    for i in range(40):  # passages of 45 to 60 bytes, periodic texts, cut copies
        source = rng.choice(rows)[1]
        at = rng.randrange(max(1, len(source) - 60))
        rows.append((10_000 + i, f"{i} start " + source[at:at + rng.randrange(45, 60)] + f" end {i} " + "ab" * rng.randrange(20, 60)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert Counter(map(tuple, substring_dedup.remove_repeats(df).select(*RESULT).collect())) == brute_repeats(rows)


def test_repeats_across_small_chunks_and_flushes(spark, documents, monkeypatch):
    monkeypatch.setattr(substring_dedup, "FLUSH", 300)
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 9000)
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", 50_000)
    rows = [(r.doc_id, r.text) for r in documents.limit(80).collect()]
    rows += [(i + 5000, t) for i, t in rows[:20]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(map(tuple, substring_dedup.remove_repeats(df).select(*RESULT).collect())) == brute_repeats(rows)


def test_anchors_over_several_steps(monkeypatch):
    data = np.frombuffer(("lorem ipsum dolor sit amet " * 40).encode(), np.uint8)
    offsets = np.array([0, 500, len(data)])

    def windows():
        place, first, last, text, _ = substring_dedup.anchors(data, offsets)
        return {(w, p) for p, a, b in zip(place, first, last) for w in range(a, b + 1)}

    whole = windows()
    monkeypatch.setattr(substring_dedup, "STEP", 64)
    assert windows() == whole and len(whole) == 500 - 49 + len(data) - 500 - 49


def test_repeats_on_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = substring_dedup.remove_repeats(odd)
    assert Counter(map(tuple, got.select(*RESULT).collect())) == brute_repeats(rows)
    assert substring_dedup.remove_repeats(empty).count() == 0
    kept = substring_dedup.without_repeats(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert kept.where("doc_id = 3 and text is null and kept = 'clash'").count() == 1


# licenses


def brute_licenses(text):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at, labels = [], set()
    for p, label in phrases.items():
        q = p.split()
        found = [i for i in range(len(w)) if w[i:i + len(q)] == q]
        at += found
        labels |= {label} if found else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_license_base_columns_match_brute_force(spark, documents, odd, empty):
    extra = [(9001, "Under the MIT License, or the mit-license; CC BY, cc\nby"), (9002, "GNU General Public License" * 3),
             (9003, "é MIT License é"), (9004, "mitlicense"), (9005, "MIT"), (9006, "KMIT LICENSE")]
    df = documents.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    cols = ["n_words", "n_base", "first_word", "last_word", "base_labels"]
    for source in (df, odd):
        want = Counter((r.doc_id, *brute_licenses(r.text)) for r in source.collect())
        rows = licenses.scan(source).collect()
        assert Counter((r.doc_id, *[r[c] for c in cols]) for r in rows) == want
        assert all(set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
                   for r in rows)
    assert licenses.scan(empty).count() == 0


def test_license_spans_survive_small_edits(spark):
    notice = dict((i, t) for i, (_, t) in enumerate(licenses.TEMPLATES))[9]
    words = notice.split()
    rows = [(1, "prose before " + notice + " prose after"), (2, " ".join(words[:8] + ["really", "truly"] + words[8:])),
            (3, " ".join(words[:6])), (4, "nothing here at all")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].labels == "mit" and got[1].score == 1.0 and got[1].base_labels == ""
    assert got[2].labels == "mit" and 0.6 <= got[2].score < 1 and got[2].n_spans == 1
    assert got[3].labels == "" and got[4].score == 0.0


# decontamination

ITEM = "a train leaves the town of Alice at 9 and travels 120 km to the place where Bob waits 3 hours with 120 boxes"


def found(spark, rows, items=((1, ITEM),)):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontaminate.find(docs, bench).collect()}


def test_exact_and_reparameterised_items_are_found(spark):
    other = ITEM.replace("Alice", "Carol").replace("Bob", "Dave").replace("9", "7").replace("120", "90").replace("km", "miles")
    loose = other.replace("travels 90", "travels 80").replace("Dave waits 3", "Dave waits 5")
    got = found(spark, [(1, "Some words first, " + ITEM + " and more."), (2, "As we know " + other + "."), (3, "wholly other prose " * 20),
                        (4, ITEM[:30]), (5, loose), (6, None), (7, "")])
    assert set(got) == {(1, 1), (2, 1), (5, 1)}
    assert got[1, 1].kind == "exact" and got[2, 1].kind == "re-parameterised"
    assert got[2, 1].consistency == 1.0 and got[5, 1].consistency < 1.0


def test_copies_in_other_case_and_longer_names_are_found(spark):
    other = ITEM.lower().replace("120", "90").replace("9 ", "7 ")
    named = ITEM.replace("Alice", "Mary Ann Jane Brown").replace("Bob", "John Henry Smith")
    item = "we saw that Ann went home with Bob then met Carl near the old gate and told Dora about a book"
    longer = item.replace("Ann", "Ann Lee").replace("Bob", "Bob Roy Kent").replace("Carl", "Carl May Jones Hill").replace("Dora", "Dora Poe")
    rows = [(1, ITEM.lower()), (2, "So: " + ITEM.upper()), (3, ITEM.title()), (4, other), (5, named), (6, longer), (7, item.lower()), (8, ITEM)]
    got = found(spark, rows, [(1, ITEM), (2, item), (3, ITEM.lower())])
    assert {(1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (8, 1), (6, 2), (7, 2), (3, 3), (8, 3)} <= set(got)
    assert got[1, 1].coverage == got[2, 1].coverage == got[3, 1].coverage == got[4, 1].coverage == got[5, 1].coverage == got[6, 2].coverage == 1.0
    assert got[1, 1].kind == got[8, 1].kind == "exact" and got[4, 1].kind == got[5, 1].kind == "re-parameterised"
    assert (got[5, 1].first_word, got[5, 1].last_word) == (0, len(named.split()) - 1)
    assert (got[6, 2].first_word, got[6, 2].last_word) == (0, len(longer.split()) - 1)


def test_inconsistent_slots_are_no_match(spark):
    item = "add 5 then add 5 then add 5 then add 5 then add 5 then stop"
    rows = [(1, "add 7 then add 7 then add 7 then add 7 then add 7 then stop"), (2, "add 1 then add 2 then add 3 then add 4 then add 6 then stop")]
    assert set(found(spark, rows, [(1, item)])) == {(1, 1)}


def test_short_and_odd_items(spark, odd, empty):
    got = found(spark, [(1, "we say hello brave world today"), (2, "hello world")], [(1, "hello brave world"), (2, None), (3, ""), (None, "we say")])
    assert set(got) == {(1, 1)}
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog while seven wizards")], "item_id long, text string")
    rows = decontaminate.find(odd, bench).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == [(False, 1), (False, 2), (False, 6), (False, 10), (True, 0)]
    left = decontaminate.remove(odd, bench)
    assert left.columns == odd.columns and left.count() == odd.count() - 6
    assert decontaminate.find(empty, bench).count() == 0 and decontaminate.find(odd, bench.limit(0)).count() == 0


def test_places_are_the_words_of_the_match(spark):
    got = found(spark, [(1, "hello brave world"), (2, "we say: hello brave world, today"), (3, "so " + ITEM)], [(1, "hello brave world"), (2, ITEM)])
    assert [(got[k].first_word, got[k].last_word) for k in ((1, 1), (2, 1), (3, 2))] == [(0, 2), (2, 4), (1, len(ITEM.split()))]


def reparameterised(rng):
    """Items that differ in their words, and texts with other numbers: used alike, contradicting, or none."""
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    items, rows, want = [], [], set()
    for i in range(12):
        shape = [rng.choice(words) if rng.random() < 0.75 else None for _ in range(20)]
        own = [rng.randrange(10, 20) for _ in shape]
        items.append((i, " ".join(w or str(n) for w, n in zip(shape, own))))
        new = {n: rng.randrange(100, 999) for n in own}
        kinds = {"alike": [new[n] for n in own], "same": own, "mixed": [rng.randrange(1000, 99999) for _ in own]}
        for kind, numbers in kinds.items():
            doc = len(rows)
            rows.append((doc, " ".join(rng.choices(words, k=9)) + " " + " ".join(w or str(n) for w, n in zip(shape, numbers)) + " tail"))
            pairs = {(str(a), str(b)) for w, a, b in zip(shape, own, numbers) if w is None}
            slots = {a for a, _ in pairs}
            if not pairs or len(slots) / len(pairs) >= decontaminate.MIN_CONSISTENT:
                want.add((doc, i, "exact" if all(a == b for a, b in pairs) else "re-parameterised", 9, 28))
    return rows, items, want


def test_reparameterised_items_match_brute_force_in_both_joins(spark, monkeypatch):
    rows, items, want = reparameterised(random.Random(8))
    results = []
    for limit in (decontaminate.BROADCAST_BYTES, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
        got = found(spark, rows, items)
        assert {(d, i, r.kind, r.first_word, r.last_word) for (d, i), r in got.items()} == want
        results.append(got)
    assert results[0] == results[1]


def test_shuffled_windows_carry_no_texts(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    docs = spark.createDataFrame([(1, "5 " * 3000 + ITEM + " Ann Bob went " * 40), (2, ITEM)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, ITEM), (2, "1 2 3 4 5 6 7")], "item_id long, text string")
    plan = decontaminate.find(docs, bench)._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join Inner"):].split("\n")[1]
    assert "d_values" in join and "kinds" not in join.split("[")[1].split("]")[0] and "starts" not in join.split("[")[1].split("]")[0]
    assert (1, 1) in {(r.doc_id, r.item_id) for r in decontaminate.find(docs, bench).collect()}


def test_texts_are_not_copied_for_their_windows(spark, sf, monkeypatch):
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", decontaminate.BROADCAST_BYTES)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan then marks what is compiled
    try:
        for limit in (decontaminate.BROADCAST_BYTES, 0):
            decontaminate.BROADCAST_BYTES = limit
            plan = decontaminate.find(docs, bench)._jdf.queryExecution().executedPlan().toString().split("\n")
            places = [i for i, line in enumerate(plan) if "Generate posexplode" in line and "text_hash" in line]
            assert places and all(re.search(r"\*\(\d+\) Generate posexplode\(kinds#", plan[i]) for i in places)
            # between the loop and the join stand rows of one window
            above = "\n".join(plan[places[0] - 3:places[0]])
            assert re.search(r"Coalesce \d+\n.*\*\(\d+\) Project .*d_values", above)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_planted_items_match_brute_force(spark, sf):
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    items = {r.item_id: re.findall(r"\w+", r.text.lower()) for r in bench.collect()}
    want = set()
    for r in docs.collect():
        text = " " + " ".join(re.findall(r"\w+", r.text.lower())) + " "
        want |= {(r.doc_id, i) for i, w in items.items() if " " + " ".join(w) + " " in text}
    assert {(r.doc_id, r.item_id) for r in decontaminate.find(docs, bench).collect()} == want


def test_native_operators_run_no_python(spark, sf):
    for name in ("op6_license_scan", "op10_decontamination"):
        plan = queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# pipeline


def test_pipeline_matches_brute_force(spark, sf):
    import corpus_pipeline
    from tablepipe.llm import bpe_codec, langid

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = {r.item_id: re.findall(r"\w+", r.text.lower()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    profiles = langid.learn(docs.where(~langid.held_out("doc_id")))
    rows = [(r.doc_id, r.text) for r in docs.collect() if profiles.classify(r.text)[0] != "und"]
    kept = {i for i, _, _, keep in brute_groups(rows, 5, 80) if keep}
    rows = [(i, t) for i, t in rows if i in kept]
    first = {}
    for i, t in rows:
        b = t.encode()
        for p in range(len(b) - 49):
            first[b[p:p + 50]] = min(first.get(b[p:p + 50], i), i)
    texts = {}
    for i, t in rows:
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < i:
                gone[p:p + 50] = b"\1" * 50
        at, out = 0, []
        for ch in t:
            n = len(ch.encode())
            out.append("" if all(gone[at:at + n]) else ch)
            at += n
        texts[i] = "".join(out)
    for i, t in list(texts.items()):
        flat = " " + " ".join(re.findall(r"\w+", t.lower())) + " "
        if any(" " + " ".join(w) + " " in flat for w in bench.values()):
            del texts[i]
    c = bpe_codec.codec(bpe_codec.default_path())
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(got) == set(texts)
    assert all(r.decoded_ok and c.decode(r.token_ids).decode() == texts[i] and r.n_tokens == len(r.token_ids) for i, r in got.items())


def test_stages_take_odd_and_empty_tables(spark, sf, odd, empty):
    import corpus_pipeline

    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for source in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, source, sf)
            assert name == "bpe" or got.columns == source.columns
            assert got.count() <= source.count()


def test_anchor_tasks_hold_little(monkeypatch):
    """A task sends its anchors in bounded lots, however many it finds."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    found = []
    monkeypatch.setattr(substring_dedup, "map_arrow", lambda df, run, schema: found.append(run))
    substring_dedup._find_anchors(type("Frame", (), {"select": lambda self, *c: self})(), "doc_id", "text", 13, 13)
    rng = np.random.default_rng(3)
    texts = ([pa.array([i]), pa.array([rng.integers(97, 123, 400_000, dtype=np.uint8).tobytes().decode()])] for i in range(40))
    tracemalloc.start()
    try:
        anchors = sum(len(s) // substring_dedup._SPOTS.itemsize for b in found[0](pa.RecordBatch.from_arrays(t, ["doc_id", "text"]) for t in texts)
                      for s in b.column(3).to_pylist())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert anchors > 1_000_000 and peak < 50e6


def near_copies(versions, size):
    """``versions`` texts of ``size`` bytes with ids 0, 1, ...: one of random letters and copies with a byte in 200 changed."""
    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 123, size, dtype=np.uint8) for _ in range(versions)]
    for v in range(1, versions):
        texts[v] = texts[0].copy()
        texts[v][rng.integers(0, size, size // 200)] = 64 + v
    return [t.tobytes().decode() for t in texts]


def chunk_steps(monkeypatch, texts):
    """(peak of traced memory by step, rows): each text is a chunk, all go to one shard; run without Spark."""
    import tracemalloc

    import pyarrow as pa
    import pyarrow.compute as pc

    n, found, peaks, docs = len(texts), [], {}, pa.table({"__id": range(len(texts)), "__text": texts})
    docs = docs.append_column("__row", docs["__id"]).append_column("__null", pa.array([False] * n))
    monkeypatch.setattr(substring_dedup, "map_arrow", lambda df, run, schema: found.append(run))
    substring_dedup._find_anchors(type("Frame", (), {"select": lambda self, *c: self})(), "__id", "__text", 1, n)
    spots = substring_dedup._resolve(n)(pa.Table.from_batches(found[0](docs.select(["__id", "__text"]).to_batches())))

    def of(table, chunk):
        return table.filter(pc.equal(table["chunk"], chunk))

    def step(name, run, *group):
        tracemalloc.start()
        try:
            out = run(*group)
            peaks[name] = max(peaks.get(name, 0), tracemalloc.get_traced_memory()[1])
        finally:
            tracemalloc.stop()
        return out

    entries = pa.concat_tables([step("fold", substring_dedup._fold("__text", 1), (pa.scalar(i),), docs.slice(i, 1), of(spots, i)) for i in range(n)])
    answers, rows = step("answer", substring_dedup._answer, entries), []
    for i in range(n):
        notes = pa.concat_tables([of(spots, i), of(answers, i)], promote_options="default")
        rows += step("remove", substring_dedup._remove(1, False), (pa.scalar(i),), docs.slice(i, 1), notes).to_pylist()
    return peaks, rows


def test_chunks_hold_little_beside_their_text(monkeypatch):
    """Per byte of text in a chunk or shard whose windows are all shared."""
    size = 1 << 20
    peaks, rows = chunk_steps(monkeypatch, near_copies(3, size))
    assert [r["n_removed"] > size // 2 for r in rows] == [False, True, True]
    assert peaks["fold"] < 25 * size and peaks["remove"] < 25 * size and peaks["answer"] < 70 * size


def test_lots_of_cores_give_the_answers_of_one_string(monkeypatch):
    texts = near_copies(6, 4000) + near_copies(2, 300)
    seen, want = set(), []
    for text in texts:
        windows = [text[i:i + 50] for i in range(len(text) - 49)]
        gone = {j for i, w in enumerate(windows) if w in seen for j in range(i, i + 50)}
        want.append("".join(c for j, c in enumerate(text) if j not in gone).encode())
        seen.update(windows)
    for lot in (1, 7, 1 << 30):
        monkeypatch.setattr(substring_dedup, "LOT", lot)
        assert [r["kept"] for r in chunk_steps(monkeypatch, texts)[1]] == want


def test_workers_give_memory_back_after_a_group():
    """A worker that waits beside others holds none of the arrays of its last group."""
    import os
    import subprocess
    import sys

    code = """
import re
import numpy as np
from tablepipe.llm import _text

def resident():
    return int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024

def run(table):
    arrays = [np.ones(1 << 18) for _ in range(40)]
    kept.append(np.ones(1 << 10))
    return table

kept, before = [], resident()
for _ in range(3):
    _text.returned(run)(None)
print(resident() - before)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=root)
    assert float(done.stdout) < 8
