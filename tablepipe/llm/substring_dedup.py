"""Exact substring deduplication with suffix arrays over shards of the corpus.

A byte goes when it is covered by a 50-byte string that also starts in a document
with a smaller id. Equal strings have to meet in one shard, however the corpus is
spread, and no shard may hold a whole group of copies. So:

1. Anchors. Every 50-byte window has one anchor: its leftmost minimal 24-byte
   gram by hash. The anchor depends on the window's content alone, so equal
   windows have equal anchors. Runs of windows with one anchor are a region.
   Anchors are dealt by hash; those in one document only are dropped. An anchor
   that several documents of one task hold is shared already and sends one
   representative, so a hot anchor costs a row a task.
2. Variants. A region is cut in two classes (windows with at most 12 bytes before
   the anchor, the others), whose windows all hold a core of 38 or 37 bytes. Per
   chunk of documents, equal regions fold into one entry: 128-bit key of the
   core, the bytes left and right of it, the smallest id.
3. Shards. Entries are dealt by core. A core with one variant is settled by its
   smallest id. All others go into one string per lot of a shard's cores, a symbol
   for the core: its suffix array by induced sorting and the permuted common
   prefixes give the classes of equal windows, and each class its smallest id.
4. The chunks get their entries' answers back, mark the windows, and remove the
   bytes.

Hashes stand for equality where they have 128 bits; a 64-bit hash only chooses
candidates. Intermediate tables are in the shared folder.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepipe.llm import _words as W
from tablepipe.llm._scratch import Scratch
from tablepipe.llm._text import map_arrow, prepare, release, returned, slices, text_column, utf8_view
from tablepipe.llm.suffix_array import permuted_lcp, suffix_array

LENGTH, GRAM = 50, 24
FREE = LENGTH - GRAM  # 26: bytes of a window beside its anchor
SPLIT = FREE // 2  # windows with at least this much before the anchor are class 1
SIDE = 13  # bytes kept on either side of a core
CORE = (GRAM + FREE - (SPLIT - 1), GRAM + SPLIT)  # 38, 37
NEED = (LENGTH - CORE[0] + 1, LENGTH - CORE[1] + 1)  # symbols of a window when the core is one: 13, 14
POSITION_BITS = 24
STEP = 4 << 20  # windows at a time; positions fit POSITION_BITS
FLUSH = 1 << 18  # anchors a task gathers before it sends them; several copies of them are alive then
CHUNK_BYTES, SHARD_BYTES = 4 << 20, 16 << 20  # text bytes per chunk of documents and per shard
BUCKET_BYTES = 4 << 20  # text bytes per bucket of anchors
LOT = 1 << 14  # variants whose windows are sorted together, unless one core has more
BLOCK = 1 << 15  # rows compared at a time
LAST_ID = 2**63 - 1  # stands for a null id
RECORD = 2 + 2 * SIDE

_PRIMES_FROM = 3


def _prime(n):
    """The smallest odd prime >= n, so that regular ids spread."""
    n = max(_PRIMES_FROM, n) | 1
    while any(n % d == 0 for d in range(3, int(n**0.5) + 1, 2)):
        n += 2
    return n


def _loads(data):
    """uint64 of the 8 bytes from each place (zeros behind the end)."""
    padded = np.concatenate([data, np.zeros(40, np.uint8)])
    view = np.lib.stride_tricks.sliding_window_view(padded, 8)[:len(data) + 32]
    return np.ascontiguousarray(view).view("<u8").ravel()


def anchors(data, offsets):
    """Regions of texts given as bytes: (anchor, first window, last window, text, anchor hash)."""
    out = []
    for at in range(0, len(data), STEP):
        part = data[at:at + STEP + LENGTH + GRAM]
        x = _loads(part)
        n = len(part)
        h = W.mix(W.mix(W.mix(x[:n]) + x[8:n + 8]) + x[16:n + 16])
        low = np.uint64((1 << POSITION_BITS) - 1)
        best = (h & ~low) | np.arange(n, dtype=np.uint64)
        size = 1
        while 2 * size <= FREE + 1:
            best = np.minimum(best[:-size], best[size:]) if len(best) > size else best[:0]
            size *= 2
        rest = FREE + 1 - size
        best = np.minimum(best[:-rest], best[rest:]) if len(best) > rest else best[:0]
        window = np.arange(min(len(best), STEP))
        text = np.searchsorted(offsets, window + at, side="right") - 1
        inside = window + at + LENGTH <= offsets[text + 1]
        window, text = window[inside], text[inside]
        if not len(window):
            continue
        place = (best[window] & low).astype(np.int64)
        first = np.ones(len(window), bool)
        first[1:] = (place[1:] != place[:-1]) | (window[1:] != window[:-1] + 1)
        begin = np.flatnonzero(first)
        end = np.append(begin[1:], len(window)) - 1
        place = place[begin]
        out.append((place + at, window[begin] + at, window[end] + at, text[begin], h[place]))
    if not out:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, np.zeros(0, np.uint64)
    return tuple(np.concatenate(c) for c in zip(*out))


def _ids(column):
    """int64 ids of an Arrow column, null as LAST_ID."""
    return np.asarray(column.cast(pa.int64()).fill_null(LAST_ID).to_numpy(zero_copy_only=False), np.int64)


_SPOTS = np.dtype([("id", "<i8"), ("at", "<i4"), ("before", "u1"), ("more", "u1")])  # regions of a text


def _pack(spots):
    """Spots as bytes, column after column: what repeats stands together for the codecs."""
    return b"".join(np.ascontiguousarray(spots[c]).tobytes() for c in _SPOTS.names)


def _unpack(blobs):
    """The spots of packed blobs, end to end."""
    sizes = [len(b) // _SPOTS.itemsize for b in blobs]
    out, done = np.empty(sum(sizes), _SPOTS), 0
    for b, n in zip(blobs, sizes):
        at = 0
        for c in _SPOTS.names:
            out[c][done:done + n] = np.frombuffer(b, _SPOTS[c], n, at)
            at += n * _SPOTS[c].itemsize
        done += n
    return out


def _pack_hashes(h):
    """The upper six bytes of each hash: they choose candidates within a bucket only."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def _unpack_hashes(blobs):
    six = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), np.uint8)
    out[:, 2:] = six
    return out.view("<u8").ravel()


def _cut_by(keys, arrays):
    """(key, arrays of the key) for each distinct key."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    bounds = np.append(first, len(keys))
    arrays = [a[order] for a in arrays]
    for a, b in zip(bounds[:-1], bounds[1:]):
        yield int(keys[a]), [x[a:b] for x in arrays]


def _shared(hashes, spots):
    """Whether each anchor's hash is in two documents (or comes with a representative of several)."""
    order = np.argsort(hashes, kind="stable")
    h, doc, rep = hashes[order], spots["id"][order], spots["at"][order] < 0
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    sizes = np.diff(np.append(first, len(h)))
    both = (np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)) | np.logical_or.reduceat(rep, first)
    out = np.zeros(len(h), bool)
    out[order] = np.repeat(both, sizes)
    return out


def _find_anchors(df, id_col, text_col, buckets, chunks):
    """(bucket, chunk, hashes, spots): anchors packed by bucket; those shared within a
    task go on under their chunk, with one representative in the bucket."""
    def run(batches):
        kept, count = [], 0

        def flush():
            h, spots = (np.concatenate(c) for c in zip(*kept))
            kept.clear()
            here = _shared(h, spots)
            rows = [(b, -1, *x) for b, x in _cut_by((spots["id"][here] % chunks), [h[here], spots[here]])]
            rows = [(c % buckets, c, None, _pack(s)) for c, _, _, s in rows]
            reps, at = np.unique(h[here], return_index=True)
            few = spots[here][at]
            few["at"] = -1
            h, spots = np.concatenate([h[~here], reps]), np.concatenate([spots[~here], few])
            rows += [(b, None, _pack_hashes(x), _pack(s)) for b, (x, s) in
                     _cut_by((h % np.uint64(buckets)).astype(np.int64), [h, spots])]
            del h, spots, here, reps, at, few
            for i in range(0, len(rows), 2000):
                columns = zip(*rows[i:i + 2000])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)
            rows.clear()
            release()

        for batch, texts in slices(batches, text_col):
            data, offsets = utf8_view(texts)
            place, first, last, text, h = anchors(data, offsets)
            if not len(place):
                continue
            spots = np.empty(len(place), _SPOTS)
            spots["id"], spots["at"] = _ids(batch.column(0))[text], place - offsets[text]
            spots["before"], spots["more"] = place - first, last - first
            kept.append((h, spots))
            count += len(place)
            if count >= FLUSH:
                yield from flush()
                count = 0
        if kept:
            yield from flush()

    names, kinds = ["bucket", "chunk", "hashes", "spots"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return map_arrow(df.select(id_col, text_col), run, "bucket long, chunk long, hashes binary, spots binary")


def _resolve(chunks):
    """Grouped function of a bucket: spots of shared anchors by chunk."""
    def run(table):
        whole = table.filter(pa.compute.is_valid(table["chunk"]))
        rows = list(zip(whole["chunk"].to_pylist(), whole["spots"].to_pylist()))
        part = table.filter(pa.compute.is_null(table["chunk"]))
        if part.num_rows:
            h = _unpack_hashes(part["hashes"].to_pylist())
            spots = _unpack(part["spots"].to_pylist())
            del part
            spots = spots[_shared(h, spots) & (spots["at"] >= 0)]
            del h
            spots = spots[np.lexsort((spots["at"], spots["id"]))]
            rows += [(c, _pack(s)) for c, (s,) in _cut_by(spots["id"] % chunks, [spots])]
            del spots
        return pa.table({"chunk": pa.array([r[0] for r in rows], pa.int64()),
                         "spots": pa.array([r[1] for r in rows], pa.binary())})
    return returned(run)


class _Chunk:
    """Texts of a chunk with their shared regions, and the entries these fold into.

    Entries are in an order that depends on their content only (shard, hash of the
    variant), so the same chunk gives the same numbering in each pass. Only with
    ``pack`` are they made."""

    def __init__(self, docs, spots, text_col, shards, pack):
        ids = _ids(docs["__id"].combine_chunks() if docs.num_rows else pa.array([], pa.int64()))
        order = np.argsort(ids, kind="stable")
        self.docs, self.ids = docs.take(pa.array(order)), ids[order]
        batch = self.docs.combine_chunks().to_batches()
        texts = text_column(batch[0], text_col) if batch else pa.array([], pa.string())
        self.data, self.offsets = utf8_view(texts)
        at = np.int32 if len(self.data) < 2**31 - LENGTH else np.int64  # of places in the chunk
        s = np.unique(_unpack(spots))
        lo, hi = np.searchsorted(self.ids, s["id"], "left"), np.searchsorted(self.ids, s["id"], "right")
        row = (np.repeat(lo, hi - lo) + _ranges(hi - lo)).astype(np.int32)  # rows that share an id each get its places
        s = s[np.repeat(np.arange(len(s)), hi - lo)]
        place = (self.offsets[row] + s["at"]).astype(at)
        first = place - s["before"]
        last = first + s["more"]
        fits = (first >= self.offsets[row]) & (last + LENGTH <= self.offsets[row + 1])
        place, first, last, row = place[fits], first[fits], last[fits], row[fits]
        del s, lo, hi, fits
        parts = []
        for k in (0, 1):
            if k == 0:
                a, b, core = np.maximum(first, place - SPLIT + 1), last, place
            else:
                a, b, core = first, np.minimum(last, place - SPLIT), place - SPLIT
            some = np.flatnonzero(a <= b)
            parts.append((a[some], b[some], core[some], row[some], np.full(len(some), k, np.uint8)))
        del place, first, last, row, a, b, core, some
        self.first, self.last, core, self.row, kind = (np.concatenate(c) for c in zip(*parts))
        del parts
        size = np.array(CORE, np.int32)[kind]
        padded = np.concatenate([self.data, np.zeros(2 * SIDE, np.uint8)])
        x = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))  # the 8 bytes from each place
        got = x[core]
        key1 = W.mix(got + kind.astype(np.uint64))
        key2 = W.mix(got ^ np.uint64(0x9E3779B97F4A7C15))
        for step in (8, 16, 24):
            got = x[core + step]
            key1, key2 = W.mix(key1 + got), W.mix(key2 ^ got)
        got = x[core + size - 8]
        key1, key2 = W.mix(key1 + got), W.mix(key2 ^ got)
        left, right = core - self.first, self.last + LENGTH - (core + size)
        look = np.zeros((len(core), LOOK), np.uint8)
        look[:, 0], look[:, 1] = left, right
        for column, begin, count in ((2, self.first, left), (2 + SIDE, core + size, right)):
            for j in range(SIDE):  # byte by byte: places of all bytes at once are 100 bytes a region
                look[:, column + j] = np.where(j < count, padded[begin + j], 0)
        del x, padded, got, core, size, left, right, begin, count
        same = W.mix(key1 ^ W.mix(key2))
        for step in range(LOOK // 8):
            same = W.mix(same + look.view("<u8")[:, step])
        shard = (key1 % np.uint64(shards)).astype(np.int32)
        order = np.lexsort((same, shard))
        del same
        # one entry where the 128 bits of the core and the bytes beside it are equal
        new = _unlike(look, order)
        for key in (key1, key2, kind):
            new[1:] |= key[order[1:]] != key[order[:-1]]
        self.entry = np.zeros(len(order), np.int32)
        self.entry[order] = np.cumsum(new) - 1
        head = order[new]
        del order, new
        self.shard = shard[head]
        self.begin = np.searchsorted(self.shard, np.arange(shards + 1))
        if not pack:
            return
        self.packed = np.empty(len(head), _ENTRY)
        self.packed["key1"], self.packed["key2"], self.packed["kind"] = key1[head], key2[head], kind[head]
        self.packed["record"] = look[head, :RECORD]
        docs_of = self.ids[self.row]
        least, most = np.full(len(head), LAST_ID), np.full(len(head), -2**63)
        np.minimum.at(least, self.entry, docs_of)
        np.maximum.at(most, self.entry, docs_of)
        self.packed["least"], self.packed["several"] = least, most > least

    def entries(self):
        """(shard, packed entries) of every shard that has some."""
        for shard in np.unique(self.shard).tolist():
            yield shard, self.packed[self.begin[shard]:self.begin[shard + 1]].tobytes()

    def covered(self, answers):
        """How often each byte is covered by removed windows (an array over the chunk's bytes)."""
        runs = [np.frombuffer(a, _ANSWER).copy() for _, a in answers]
        for (shard, _), r in zip(answers, runs):
            r["entry"] += self.begin[shard]
        cover = np.zeros(len(self.data) + 1, np.int32)
        if runs:
            runs = np.concatenate(runs)
            runs = runs[np.argsort(runs["entry"], kind="stable")]
            lo = np.searchsorted(runs["entry"], self.entry, "left")
            n = np.searchsorted(runs["entry"], self.entry, "right") - lo
            r = runs[np.repeat(lo, n) + _ranges(n)]
            occurrence = np.repeat(np.arange(len(self.entry)), n)
            goes = r["least"] < self.ids[self.row[occurrence]]
            r, occurrence = r[goes], occurrence[goes]
            np.add.at(cover, self.first[occurrence] + r["lo"], 1)
            np.add.at(cover, self.first[occurrence] + r["hi"] + LENGTH, -1)
        return np.cumsum(cover[:-1], out=cover[:-1])


_ENTRY = np.dtype([("key1", "<u8"), ("key2", "<u8"), ("least", "<i8"), ("kind", "u1"), ("several", "u1"), ("record", "u1", RECORD)])
LOOK = -(-RECORD // 8) * 8  # a record with zeros behind, for reading it in words
_ANSWER = np.dtype([("least", "<i8"), ("entry", "<i4"), ("lo", "u1"), ("hi", "u1")])


def _unlike(look, order):
    """Whether each row differs from the one before it in ``order`` (the first one does)."""
    words, out = look.view("<u8"), np.ones(len(order), bool)
    for i in range(1, len(order), BLOCK):
        rows = words[order[i - 1:i + BLOCK]]
        out[i:i + BLOCK] = (rows[1:] != rows[:-1]).any(1)
    return out


def _ranges(counts):
    """0..n-1 for each n, end to end."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def _fold(text_col, shards):
    """Cogrouped function of a chunk: its entries by shard."""
    def run(key, docs, spots):
        rows = list(_Chunk(docs, spots["spots"].to_pylist(), text_col, shards, True).entries())
        return pa.table({"shard": pa.array([r[0] for r in rows], pa.int64()),
                         "chunk": pa.array([key[0].as_py()] * len(rows), pa.int64()),
                         "entries": pa.array([r[1] for r in rows], pa.binary())})
    return returned(run)


def _window_classes(record, need, key, least):
    """Smallest id for each window of each variant: (variant, window, id), in order.

    The variants are of one class, whose windows have ``need`` symbols. They are strings of their left bytes, a symbol for the core and their right
    bytes; windows are equal where their cores are (``key``) and the permuted common
    prefix reaches the window's length."""
    left, right = record[:, 0].astype(np.int64), record[:, 1].astype(np.int64)
    size = left + right + 2  # the core and a separator
    ends = np.cumsum(size)
    begin = ends - size
    text = np.zeros(int(ends[-1]), np.int64)
    own = np.repeat(np.arange(len(size)), size)
    at = _ranges(size)
    text[begin + left] = 1
    is_left = at < left[own]
    text[is_left] = record[own[is_left], 2 + at[is_left]].astype(np.int64) + 2
    after = at - left[own] - 1
    is_right = (after >= 0) & (after < right[own])
    text[is_right] = record[own[is_right], 2 + SIDE + after[is_right]].astype(np.int64) + 2
    sa = suffix_array(text, 258)
    plcp = permuted_lcp(text, sa, begin, ends - 1)
    starts_window = at <= (size - 1 - need)[own]
    ordered = sa[starts_window[sa]]
    same = plcp[ordered] >= need
    same[:1] = False
    group = np.cumsum(~same)
    order = np.lexsort((key[own[ordered]], group))
    ordered, group = ordered[order], group[order]
    k = key[own[ordered]]
    new = np.ones(len(ordered), bool)
    new[1:] = (group[1:] != group[:-1]) | (k[1:] != k[:-1])
    head = np.flatnonzero(new)
    best = np.minimum.reduceat(least[own[ordered]], head)
    value = np.zeros(len(text), np.int64)
    value[ordered] = np.repeat(best, np.diff(np.append(head, len(ordered))))
    places = np.flatnonzero(starts_window)
    return own[places], at[places], value[places]


def _answer(table):
    """Grouped function of a shard: for the entries of each chunk the windows that a smaller id has."""
    chunk, shard = table["chunk"].to_pylist(), table["shard"][0].as_py()
    data, offsets = utf8_view(table["entries"].combine_chunks())
    e, sizes = data.view(_ENTRY), np.diff(offsets) // _ENTRY.itemsize
    look = np.zeros((len(e), LOOK), np.uint8)
    look[:, :RECORD] = e["record"]
    content = W.mix(e["key2"] + e["kind"].astype(np.uint64))
    for step in range(LOOK // 8):
        content = W.mix(content + look.view("<u8")[:, step])
    order = np.lexsort((content, e["key2"], e["key1"]))
    k1, k2, c = e["key1"][order], e["key2"][order], content[order]
    new_key = np.ones(len(order), bool)
    new_key[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
    new = _unlike(look, order) | new_key
    new[1:] |= c[1:] != c[:-1]
    del k1, k2, c, content, look
    head = np.flatnonzero(new)
    variant = np.zeros(len(e), np.int32)
    variant[order] = np.cumsum(new) - 1
    least = np.minimum.reduceat(e["least"][order], head)
    own = order[head]  # an entry of each variant
    record, kinds = e["record"], e["kind"][own]
    key = np.cumsum(new_key[head]) - 1
    del order, new, new_key
    several = np.bincount(key)[key] > 1
    # a core with one variant: all its windows have the same smallest id
    windows = record[own, 0].astype(np.int64) + record[own, 1] + 2 - np.array(NEED)[kinds]
    alone = np.flatnonzero(~several)
    runs = [(alone, np.zeros(len(alone), np.int64), windows[alone] - 1, least[alone])]
    for kind, need in enumerate(NEED):
        many = np.flatnonzero(several & (kinds == kind))
        cores = np.flatnonzero(np.diff(key[many], prepend=-1, append=-1))  # where a core's variants begin, and the end
        begin = 0
        while begin < len(many):
            end = int(cores[max(np.searchsorted(cores, begin + LOT, "right") - 1, np.searchsorted(cores, begin, "right"))])
            lot, begin = many[begin:end], end
            v, w, best = _window_classes(record[own[lot]], need, key[lot], least[lot])
            first = np.ones(len(v), bool)
            first[1:] = (v[1:] != v[:-1]) | (best[1:] != best[:-1])
            at = np.flatnonzero(first)
            runs.append((lot[v[at]], w[at], w[np.append(at[1:], len(v)) - 1], best[at]))
    v, lo, hi, best = (np.concatenate(x) for x in zip(*runs))
    order = np.argsort(v, kind="stable")
    v, lo, hi, best = v[order], lo[order], hi[order], best[order]
    a, n = np.searchsorted(v, variant, "left"), np.bincount(v, minlength=len(head))[variant]
    run = np.repeat(a, n) + _ranges(n)
    entry = np.repeat(np.arange(len(e)), n)
    useful = (best[run] < e["least"][entry]) | (e["several"][entry] > 0)
    run, entry = run[useful], entry[useful]
    blob_begin = np.cumsum(sizes) - sizes
    blob = np.searchsorted(np.cumsum(sizes), entry, "right")
    answer = np.empty(len(run), _ANSWER)
    answer["least"], answer["entry"], answer["lo"], answer["hi"] = best[run], entry - blob_begin[blob], lo[run], hi[run]
    rows = [(chunk[b], a.tobytes()) for b, (a,) in _cut_by(blob, [answer])]
    return pa.table({"chunk": pa.array([r[0] for r in rows], pa.int64()),
                     "shard": pa.array([shard] * len(rows), pa.int64()),
                     "answers": pa.array([r[1] for r in rows], pa.binary())})


def _whole_characters(data, gone):
    """``gone`` without the bytes of characters that keep a byte."""
    if not len(data):
        return gone
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    return np.repeat(np.minimum.reduceat(gone, lead), np.diff(np.append(lead, len(data)))) > 0


def _remove(shards, whole):
    """Cogrouped function of a chunk: its rows with what is left of the text; ``whole``:
    characters stay whole."""
    def run(key, docs, notes):
        spots = [x for x in notes["spots"].to_pylist() if x is not None]
        answers = [x for x in zip(notes["shard"].to_pylist(), notes["answers"].to_pylist()) if x[1] is not None]
        own = _Chunk(docs, spots, "__text", shards, False)
        gone = own.covered(answers) > 0
        del spots, answers
        if whole:
            gone = _whole_characters(own.data, gone)
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for a, b in zip(own.offsets[:-1], own.offsets[1:]):
            g = gone[a:b]
            n_bytes.append(int(b - a))
            n_removed.append(int(g.sum()))
            n_spans.append(int(g[:1].sum() + (g[1:] & ~g[:-1]).sum()))
            kept.append(own.data[a:b][~g].tobytes() if n_removed[-1] else own.data[a:b].tobytes())
        out = own.docs.select(["__row", "__null"])
        for name, values, kind in (("n_bytes", n_bytes, pa.int64()), ("n_removed", n_removed, pa.int64()),
                                   ("n_spans", n_spans, pa.int64()), ("kept", kept, pa.binary()),
                                   ("kept_sha256", [hashlib.sha256(k).hexdigest() for k in kept], pa.string())):
            out = out.append_column(name, pa.array(values, kind))
        return out
    return returned(run)


_MADE = {"n_bytes": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType(), "kept": T.BinaryType(),
         "kept_sha256": T.StringType()}


def _removed(df, id_col, text_col, carried, whole):
    """(__row, __null, results): ``carried`` columns of each row as a struct, whether its text is null."""
    spark = df.sparkSession
    prepare(spark)
    s = Scratch(spark, "repeats")
    size = df.select(F.sum(F.octet_length(text_col))).collect()[0][0] or 0
    chunks, shards = _prime(size // CHUNK_BYTES), _prime(size // SHARD_BYTES)
    found = _find_anchors(df, id_col, text_col, _prime(size // BUCKET_BYTES), chunks)
    spots = s.cut(found.groupBy("bucket").applyInArrow(_resolve(chunks), "chunk long, spots binary"), "spots")
    ident = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))
    rows = df.select(F.pmod(ident, F.lit(chunks).cast("long")).alias("__chunk"), ident.alias("__id"),
                     F.col(text_col).alias("__text"), F.col(text_col).isNull().alias("__null"),
                     F.struct(F.lit(0).alias("__"), *[F.col(c) for c in carried]).alias("__row"))
    entries = (rows.select("__chunk", "__id", "__text").groupBy("__chunk").cogroup(spots.groupBy("chunk"))
               .applyInArrow(_fold("__text", shards), "shard long, chunk long, entries binary"))
    answers = s.cut(entries.groupBy("shard").applyInArrow(returned(_answer), "chunk long, shard long, answers binary"), "answers")
    notes = (spots.select("chunk", "spots", F.lit(None).cast("long").alias("shard"), F.lit(None).cast("binary").alias("answers"))
             .unionByName(answers.select("chunk", F.lit(None).cast("binary").alias("spots"), "shard", "answers")))
    schema = T.StructType([rows.schema["__row"], rows.schema["__null"], *[T.StructField(k, v) for k, v in _MADE.items()]])
    return rows.groupBy("__chunk").cogroup(notes.groupBy("chunk")).applyInArrow(_remove(shards, whole), schema)


def remove_repeats(df, id_col="doc_id", text_col="text"):
    """Every row of ``df`` with (n_bytes, n_removed, n_spans, kept, kept_sha256) in
    place of the text: ``kept`` is what is left of its UTF-8 bytes.

    Strings are judged on the input, matches never cross documents, overlaps
    count. Null and empty texts have 0 bytes. Rows that share an id are one
    document to each other: they remove nothing from each other, but each loses
    what smaller ids hold. A null id comes after every other. Other columns pass
    through; those named like a result column give way to it.
    """
    carried = [c for c in df.columns if c != text_col and c not in _MADE]
    return _removed(df, id_col, text_col, carried, False).select(*[F.col("__row")[c].alias(c) for c in carried], *_MADE)


def without_repeats(df, id_col="doc_id", text_col="text"):
    """``df`` with its repeated passages taken out of ``text_col``: same rows and
    columns. A character goes only when all of its bytes do, so the text is valid
    UTF-8; a null text stays null."""
    carried = [c for c in df.columns if c != text_col]
    text = F.when(~F.col("__null"), F.col("kept").cast("string"))
    return _removed(df, id_col, text_col, carried, True).select(
        *[text.alias(c) if c == text_col else F.col("__row")[c].alias(c) for c in df.columns])
