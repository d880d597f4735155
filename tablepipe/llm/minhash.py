"""MinHash near-duplicate groups with sequential Bayesian verification.

1. One pass over the texts gives each document the set of its word shingles (as
   64-bit hashes), a 128-bit fingerprint of the set, ``HASHES`` minima and band
   keys of as many minima as ``band_rows`` allows. Documents with equal sets are one
   node from here on. Band keys travel packed, a few bytes each, and only those of
   several nodes leave their part.
2. Nodes that share a band key are candidates. A node is first compared with one
   leader, the least of the least nodes of its buckets; the links found make a
   forest. In buckets with several components the nodes outside the largest one are
   compared with a leader of that component, again one a node. What is left are
   pairs across the components of a bucket: the members outside its
   largest component are compared with all members. Members come with their
   signatures in tiles of bounded size, so a large bucket is many tiles, and only
   pairs that survive the comparison leave a tile, packed.
3. A pair's signatures (16 bits of each minimum) are compared in batches of
   ``BATCH``. After each batch it is given up where the posterior probability
   (uniform prior) of a similarity of at least t is under ``MISS``; survivors are
   verified exactly on their full sets.
4. Components come from pointer jumping in the forest, then from label propagation
   over the few links between its trees.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablepipe.llm import _words as W
from tablepipe.llm._scratch import Scratch
from tablepipe.llm._sketch import MOST_SLOTS, SLOTS, bit_map
from tablepipe.llm._text import long_column, map_arrow, prepare, slices, utf8_view

HASHES = 256
BAND_MISS = 1e-6  # most a pair at the threshold may be missed by all bands
BATCH, MISS = 16, 1e-7
TILE_ALL, TILE_SOME = 1000, 500  # members of a tile on either side
BLOCK_NODES = 1000  # nodes on a side of a block of exact comparisons
GROUP_ROWS = 4000  # rows of small tiles that one call handles together
_rng = np.random.default_rng(20240229)
_A = (_rng.integers(1, 2**32, HASHES, np.uint32, endpoint=False) | np.uint32(1))[:, None]
_B = _rng.integers(0, 2**32, HASHES, np.uint32, endpoint=False)[:, None]
BLOCK = 1 << 13


def shingle_sets(data, offsets, width):
    """(hashes, first) of texts as bytes: the distinct shingles of text i are hashes[first[i]:first[i + 1]], sorted."""
    n = len(offsets) - 1
    low = W.lower_ascii(data)
    start, stop, owner = W.words(low, offsets)
    prefix = W.prefix_hash(low)
    h = W.span_hash(prefix, start, stop)
    counts = np.bincount(owner, minlength=n)
    key, text = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(h) >= width:
        key = W.mix(h[:len(h) - width + 1])
        for k in range(1, width):
            key = W.mix(key + h[k:len(h) - width + 1 + k])
        inside = owner[:len(key)] == owner[width - 1:]
        key, text = key[inside], owner[:len(inside)][inside]
    short = np.flatnonzero((counts > 0) & (counts < width))  # the whole sequence is the shingle
    first = np.searchsorted(owner, short)
    whole = W.mix(h[first] + np.uint64(width)) if len(short) else np.zeros(0, np.uint64)
    for k in range(1, width):
        more = counts[short] > k
        whole[more] = W.mix(whole[more] + h[first[more] + k] + np.uint64(1))
    key, text = np.concatenate([key, whole]), np.concatenate([text, short])
    order = np.argsort(key)
    small = text[order].astype(np.uint16) if n < 2**16 else text[order]  # 16 bits sort by radix
    order = order[np.argsort(small, kind="stable")]
    key, text = key[order], text[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    key, text = key[new], text[new]
    return key, np.searchsorted(text, np.arange(n + 1))


def signatures(key, first):
    """Minima of each non-empty set: uint32 [sets, HASHES]."""
    sizes = np.diff(first)
    full = np.flatnonzero(sizes > 0)
    out = np.full((len(full), HASHES), np.uint32(2**32 - 1), np.uint32)
    if not len(full):
        return full, out
    set_of = np.repeat(np.arange(len(full)), sizes[full])
    short = (key >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(key), BLOCK):  # bounded matrix; a set may span blocks
        own = set_of[i:i + BLOCK]
        hashed = (short[None, i:i + BLOCK] ^ _B) * _A
        cuts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        rows = own[cuts]
        out[rows] = np.minimum(out[rows], np.minimum.reduceat(hashed, cuts, axis=1).T)
    return full, out


def band_rows(threshold):
    """The most minima a band may have so that pairs at the threshold share one with
    probability 1 - BAND_MISS: longer bands make fewer candidates."""
    fit = [r for r in range(1, HASHES + 1) if (1 - threshold**r) ** (HASHES // r) <= BAND_MISS]
    return max(fit, default=1)


def band_keys(signature, rows):
    """int64 [sets, bands]: equal where a band's minima are equal."""
    count = HASHES // rows
    bands = signature[:, :count * rows].reshape(len(signature), count, rows).astype(np.uint64)
    key = np.arange(1, count + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for k in range(rows):
        key = W.mix(key + bands[:, :, k])
    return key.view(np.int64)


def node_keys(key, first, full):
    """128-bit fingerprint (bytes) of each non-empty set."""
    if not len(full):
        return []
    sizes = np.diff(first)[full].astype(np.uint64)
    parts = [W.mix(np.add.reduceat(W.mix(key + np.uint64(seed)), first[full]) + sizes) for seed in (0x51ED, 0xA24B)]
    return [row.tobytes() for row in np.stack(parts, 1)]


def sketches(df, id_col, text_col, width, rows, part_bits) -> DataFrame:
    """One pass over the texts; ``kind`` tells what a row is:

    ``DOC``: (id, n_shingles, node), node null for an empty set;
    ``BANDS``: (part, low, nodes, shared), band keys of many nodes packed by the key's high bits;
    ``MEMBERS``: (low, nodes), keys that several nodes of one task share and those nodes.

    A key that a task knows to be shared leaves one entry in its part, so a hot
    bucket costs its part an entry a task, however many nodes it has."""
    def blobs(held):
        nodes = np.concatenate([n for n, _ in held])
        nodes, first = np.unique(nodes, return_index=True)  # documents with equal sets
        keys = np.concatenate([k for _, k in held])[first] >> np.uint64(32 - part_bits)
        owner = np.repeat(np.arange(len(nodes)), keys.shape[1])
        keys = keys.ravel()
        order = np.argsort(keys, kind="stable")
        keys, owner = keys[order], owner[order]
        head = np.concatenate([[True], keys[1:] != keys[:-1]])
        several = np.diff(np.append(np.flatnonzero(head), len(keys)))[np.cumsum(head) - 1] > 1
        out = []
        for i in range(0, int(several.sum()), 1 << 16):
            at = np.flatnonzero(several)[i:i + (1 << 16)]
            out.append((MEMBERS, None, keys[at].astype("<u8").tobytes(), nodes[owner[at]].tobytes(), None))
        keys, owner, several = keys[head], owner[head], several[head]
        part, low = (keys >> np.uint64(32)).astype(np.int64), keys.astype("<u4")
        cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else [0]
        out += [(BANDS, int(part[i]), low[i:j].tobytes(), nodes[owner[i:j]].tobytes(), several[i:j].astype(np.uint8).tobytes())
                for i, j in zip(cuts[:-1], cuts[1:])]
        kind, part, low, nodes, shared = zip(*out)
        none = pa.nulls(len(kind))
        return _sketch_batch(kind, none, none, none, part, low, nodes, shared)

    def run(batches):
        held, size = [], 0
        for batch, texts in slices(batches, text_col):
            key, first = shingle_sets(*utf8_view(texts), width)
            sizes = np.diff(first)
            full, sig = signatures(key, first)
            nodes = [None] * len(sizes)
            own = node_keys(key, first, full)
            for i, node in zip(full, own):
                nodes[i] = node
            none = pa.nulls(len(sizes))
            yield _sketch_batch([DOC] * len(sizes), long_column(batch, id_col), sizes, nodes, none, none, none, none)
            if len(full):
                held.append((np.frombuffer(b"".join(own), "V16"), band_keys(sig, rows).view(np.uint64)))
                size += held[-1][1].size
            if size >= FLUSH:
                yield blobs(held)
                held, size = [], 0
        if held:
            yield blobs(held)

    return map_arrow(df.select(id_col, text_col), run, _SKETCH)


DOC, BANDS, MEMBERS = 0, 1, 2
FLUSH = 1 << 19  # band keys that a task holds before it passes them on
PART_KEYS = 1 << 19  # band keys of the corpus for each part
_SKETCH = "kind int, id long, n_shingles long, node binary, part long, low binary, nodes binary, shared binary"


def _sketch_batch(*columns):
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    arrays = [c.cast(t) if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _SKETCH.split(", ")])


def _node_array(blobs):
    return np.frombuffer(b"".join(blobs), "V16")


def bucket_members(rows) -> DataFrame:
    """(bucket, node) of the buckets with several nodes, from the rows of ``sketches``."""
    def parted(table):
        low = np.frombuffer(b"".join(table["low"].to_pylist()), "<u4")
        nodes = _node_array(table["nodes"].to_pylist())
        shared = np.frombuffer(b"".join(table["shared"].to_pylist()), np.uint8) > 0
        order = np.argsort(low, kind="stable")
        low, nodes, shared = low[order], nodes[order], shared[order]
        head = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        sizes = np.diff(np.append(head, len(low)))
        other = nodes != nodes[np.repeat(head, sizes)]
        live = np.repeat(np.logical_or.reduceat(other | shared, head), sizes) & ~shared  # those are members already
        bucket = (np.int64(table["part"][0].as_py()) << np.int64(32)) | low[live].astype(np.int64)
        return pa.table({"bucket": bucket, "node": pa.array([n.tobytes() for n in nodes[live]], pa.binary())})

    def known(batches):
        for batch in batches:
            for low, nodes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                nodes = np.frombuffer(nodes, "V16")
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(low, "<u8").astype(np.int64)),
                                                  pa.array([n.tobytes() for n in nodes], pa.binary())], ["bucket", "node"])

    schema = "bucket long, node binary"
    bands = rows.where(F.col("kind") == BANDS).select("part", "low", "nodes", "shared")
    found = bands.groupBy("part").applyInArrow(parted, schema)
    return found.unionAll(map_arrow(rows.where(F.col("kind") == MEMBERS).select("low", "nodes"), known, schema)).distinct()


def full_sets(df, text_col, width) -> DataFrame:
    """(node, sig, shingles) of each text that has a set: fingerprint, 16 bits of each minimum, sorted 64-bit set."""
    def run(batches):
        for _, texts in slices(batches, text_col):
            key, first = shingle_sets(*utf8_view(texts), width)
            full, sig = signatures(key, first)
            sets = [key[first[i]:first[i + 1]].tobytes() for i in full]
            signs = [(s >> np.uint32(16)).astype("<u2").tobytes() for s in sig]
            yield pa.RecordBatch.from_arrays(
                [pa.array(node_keys(key, first, full), pa.binary()), pa.array(signs, pa.binary()), pa.array(sets, pa.binary())],
                ["node", "sig", "shingles"])

    return map_arrow(df, run, "node binary, sig binary, shingles binary")


def least_matches(threshold, miss=MISS):
    """For n = BATCH, 2 * BATCH, ...: the fewest equal minima at which the posterior
    probability of a similarity >= threshold is at least ``miss`` (uniform prior:
    it is P(Binomial(n + 1, threshold) <= matches))."""
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold)**(n + 1 - m)
        out.append(m)
    return out


def _survivors(left, right, bound):
    """Which pairs of signature rows may reach the threshold: compared batch by batch."""
    live, matches = np.arange(len(left)), np.zeros(len(left), np.int64)
    for step, least in enumerate(bound):
        at = slice(step * BATCH, (step + 1) * BATCH)
        matches[live] += (left[live, at] == right[live, at]).sum(1)
        live = live[matches[live] >= least]
    return live


def _signatures(column):
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, HASHES)


def _judge(pairs, sigs, threshold):
    """The pairs (a, b) that survive the comparison of their signatures."""
    bound = least_matches(threshold)
    a = sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"))
    b = sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                live = _survivors(_signatures(batch.column(2)), _signatures(batch.column(3)), bound)
                yield batch.select(["a", "b"]).take(pa.array(live))

    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "sig_a", "sig_b")
    return map_arrow(joined, run, "a binary, b binary")


def _tiles(s, members, sigs):
    """(tile, some, node, comp, sig): members of the buckets with several components.
    ``some`` rows, those outside the bucket's largest component, meet all others."""
    count = members.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    sizes = (count.groupBy("bucket").agg(F.sum("n").alias("all"), F.max_by("comp", F.struct("n", "comp")).alias("most"),
                                         F.max("n").alias("top")).where(F.col("top") < F.col("all")))
    sizes = sizes.select("bucket", "most", F.ceil(F.col("all") / TILE_ALL).cast("int").alias("rows"),
                         F.ceil((F.col("all") - F.col("top")) / TILE_SOME).cast("int").alias("columns"))
    m = members.join(sizes, "bucket").join(sigs, "node")
    spot = F.xxhash64("node", "bucket")
    tile = F.xxhash64("bucket", "row", "column")
    every = m.select("*", F.pmod(spot, F.col("rows")).cast("int").alias("row"), F.explode(
        F.sequence(F.lit(0), F.col("columns") - 1)).alias("column"), F.lit(False).alias("some"))
    outside = m.where("comp != most").select("*", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"),
                                             F.pmod(spot, F.col("columns")).cast("int").alias("column"), F.lit(True).alias("some"))
    return every.unionByName(outside).select(tile.alias("tile"), "some", "node", "comp", "sig")


def _compare(threshold, side):
    """Grouped function over whole tiles: (block, pairs), the surviving pairs across components,
    packed by the blocks of their nodes."""
    bound = least_matches(threshold)

    def run(table):
        tile = table["tile"].to_numpy()
        some = table["some"].to_numpy(zero_copy_only=False)
        nodes, rank = np.unique(_node_array(table["node"].to_pylist()), return_inverse=True)
        comp = np.unique(_node_array(table["comp"].to_pylist()), return_inverse=True)[1]
        sig = _signatures(table["sig"])
        order = np.lexsort((~some, tile))
        cuts = np.flatnonzero(np.concatenate([[True], tile[order][1:] != tile[order][:-1], [True]]))
        found = [np.zeros(0, np.int64)]
        for i, j in zip(cuts[:-1], cuts[1:]):
            rows = order[i:j]
            one, all_ = rows[some[rows]], rows[~some[rows]]
            if not len(one) or not len(all_):
                continue
            step = max(1, 16_000 // len(all_))  # pairs at a time: about 16 MB of signatures
            for k in range(0, len(one), step):
                part = one[k:k + step]
                a, b = np.repeat(part, len(all_)), np.tile(all_, len(part))
                apart = comp[a] != comp[b]
                a, b = a[apart], b[apart]
                # the first batch on all pairs, the rest on what it leaves
                first = (sig[a, :BATCH] == sig[b, :BATCH]).sum(1) >= bound[0]
                a, b = a[first], b[first]
                live = _survivors(sig[a], sig[b], bound)
                x, y = rank[a[live]], rank[b[live]]
                found.append(np.minimum(x, y) * len(nodes) + np.maximum(x, y))
        found = np.unique(np.concatenate(found))
        return _packed(nodes[found // len(nodes)], nodes[found % len(nodes)], side)

    return run


_PACKED = "block long, pairs binary"


def _place(nodes, side):
    """The side of the blocks that each node is on: its fingerprint is uniform."""
    return nodes.view("<u4").reshape(-1, 4)[:, 0].astype(np.int64) % side


def _packed(a, b, side):
    """One row for each block: its pairs, all a before all b."""
    if not len(a):
        return pa.table({"block": pa.array([], pa.int64()), "pairs": pa.array([], pa.binary())})
    block = _place(a, side) * side + _place(b, side)
    order = np.argsort(block, kind="stable")
    block, a, b = block[order], a[order], b[order]
    cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
    return pa.table({"block": block[cuts[:-1]], "pairs": pa.array([a[i:j].tobytes() + b[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])], pa.binary())})


def _unpacked(blob):
    both = np.frombuffer(blob, "V16")
    return both[:len(both) // 2], both[len(both) // 2:]


def _side(nodes):
    return max(1, -(-nodes // BLOCK_NODES))


def _linked_sets(x, y, percent):
    """Whether two sorted sets have 100 * intersection >= percent * union."""
    if len(x) > len(y):
        x, y = y, x
    if 100 * len(x) < percent * len(y):  # the union is too large
        return False
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    both = int((y[at] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _known(needed):
    return {n: np.frombuffer(x.as_buffer(), np.uint64) for n, x in zip(needed["node"].to_pylist(), needed["shingles"])}


def _linked_blocks(scratch, packed, sets, labels, percent):
    """(a, b): of the pairs of ``packed`` blocks, links that join the components (``labels``) which
    any of them joins. A pair is verified once, whatever the number of its buckets, and not at all
    where links of its block have made its components one; a node's set goes to a block once."""
    def merge(table):
        a, b = (np.concatenate(x) for x in zip(*map(_unpacked, table["pairs"].to_pylist())))
        both = np.unique(np.stack([a, b], 1).view("V32").ravel())
        a, b = both.view("V16").reshape(-1, 2).T
        return pa.table({"block": table["block"].slice(0, 1), "pairs": pa.array([a.tobytes() + b.tobytes()], pa.binary())})

    def ends(batches):
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                nodes = np.unique(np.frombuffer(blob, "V16"))
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(nodes), pa.int64()), pa.array([n.tobytes() for n in nodes], pa.binary())],
                                                 ["place", "node"])

    def run(blocks, needed):
        known, up = _known(needed), {}
        comp = dict(zip(needed["node"].to_pylist(), needed["comp"].to_pylist()))

        def root(c):
            while c in up:
                up[c] = up.get(up[c], up[c])
                c = up[c]
            return c

        a, b = _unpacked(blocks["pairs"][0].as_py()) if blocks.num_rows else ([], [])
        out = []
        for m, n in zip(a, b):
            m, n = m.tobytes(), n.tobytes()
            x, y = root(comp[m]), root(comp[n])
            if x != y and _linked_sets(known[m], known[n], percent):
                up[x] = y
                out.append((m, n))
        return pa.table({"a": pa.array([x for x, _ in out], pa.binary()), "b": pa.array([y for _, y in out], pa.binary())})

    prepare(packed.sparkSession)
    blocks = scratch.cut(packed.groupBy("block").applyInArrow(merge, _PACKED), "blocks")
    needed = map_arrow(blocks, ends, "place long, node binary")
    own = sets.select("node", "shingles").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    needed = needed.join(own, "node")
    return blocks.groupBy("block").cogroup(needed.groupBy("place")).applyInArrow(run, "a binary, b binary")


def _linked(pairs, sets, percent):
    """The pairs (a, b) that are linked: about as many pairs as nodes, dealt to blocks by the hashes
    of both nodes."""
    side = _side(sets.count())
    at = lambda c: F.pmod(F.xxhash64(c), F.lit(side))
    pairs = pairs.select("a", "b", (at("a") * side + at("b")).alias("block"))
    needed = pairs.select(F.col("block").alias("place"), F.explode(F.array("a", "b")).alias("node")).distinct().join(
        sets.select("node", "shingles"), "node")

    def run(pairs, needed):
        known = _known(needed)
        good = [_linked_sets(known[m], known[n], percent) for m, n in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist())]
        return pairs.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    prepare(pairs.sparkSession)
    return (pairs.groupBy("block").cogroup(needed.groupBy("place")).applyInArrow(run, "a binary, b binary"))


def roots(scratch, parents, tag):
    """(node, comp) of a forest (node, up), up the smaller: each node's root, by pointer jumping."""
    at = scratch.cut(parents, f"{tag}-0")
    step = 0
    while True:
        up = at.select(F.col("node").alias("up"), F.col("up").alias("further"))
        nxt = at.join(up, "up", "left").select("node", F.coalesce("further", "up").alias("up"), F.col("further").isNotNull().alias("moved"))
        step += 1
        nxt = scratch.cut(nxt, f"{tag}-{step}")
        scratch.drop(f"{tag}-{step - 1}")
        moved = nxt.where("moved").limit(1).count()
        at = nxt.select("node", "up")
        if not moved:
            tops = at.select(F.col("up").alias("node")).distinct().withColumn("up", F.col("node"))
            return at.unionByName(tops).withColumnRenamed("up", "comp")


def components(scratch, edges, tag):
    """(node, comp) of the nodes of an edge table (a, b): comp is the smallest node reachable."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = scratch.cut(both, f"{tag}-edges")
    labels = scratch.cut(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("comp")), f"{tag}-0")
    step = 0
    while True:
        # the smallest label among a node's neighbours, then that label's own label
        near = (both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("comp").alias("m")))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        nxt = (labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "m").alias("comp"))
               .join(jump, "comp").select("node", F.least("comp", "up").alias("comp"), "old"))
        step += 1
        nxt = scratch.cut(nxt, f"{tag}-{step}")
        changed = nxt.where("comp != old").limit(1).count()
        scratch.drop(f"{tag}-{step - 1}")
        labels = nxt.select("node", "comp")
        if not changed:
            scratch.drop(f"{tag}-edges")
            return labels


def _joined(scratch, labels, edges, tag):
    """``labels`` (node, comp) with the components that ``edges`` (a, b) connect made one: only
    the graph of components is labelled anew."""
    for end in ("a", "b"):
        own = labels.select(F.col("node").alias(end), F.col("comp").alias(f"c{end}"))
        edges = edges.join(own, end, "left").withColumn(f"c{end}", F.coalesce(f"c{end}", end))
    ends = edges.select(F.col("a").alias("node"), F.col("ca").alias("comp")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("cb").alias("comp")))
    all_ = labels.unionByName(ends).distinct()
    graph = edges.select(F.col("ca").alias("a"), F.col("cb").alias("b")).where("a != b").distinct()
    new = components(scratch, graph, tag).select(F.col("node").alias("comp"), F.col("comp").alias("new"))
    return scratch.cut(all_.join(new, "comp", "left").select("node", F.coalesce("new", "comp").alias("comp")), f"{tag}-labels")


def _pair(a, b):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def _leaders(members):
    """One pair a node: the least of the least nodes of its buckets, and the node."""
    leader = members.groupBy("bucket").agg(F.min("node").alias("leader"))
    near = members.join(leader, "bucket").where("node != leader")
    return near.groupBy("node").agg(F.min("leader").alias("leader")).select(F.col("leader").alias("a"), F.col("node").alias("b"))


def _others(members, turn):
    """One pair a node that is outside the largest component of one of its buckets: with the least
    node of that component (of one such bucket, chosen by hash)."""
    count = members.groupBy("bucket", "comp").agg(F.count("*").alias("n"), F.min("node").alias("leader"))
    top = count.groupBy("bucket").agg(F.max(F.struct("n", "comp", "leader")).alias("top"), F.count("*").alias("comps")).where("comps > 1")
    near = members.join(top.select("bucket", F.col("top.comp").alias("most"), F.col("top.leader").alias("leader")), "bucket").where("comp != most")
    pick = near.groupBy("node").agg(F.min(F.struct(F.xxhash64("bucket", F.lit(turn)).alias("h"), "leader")).alias("p"))
    return pick.select(*_pair(F.col("p.leader"), F.col("node"))).distinct()


STAR_ROUNDS = 2  # of one pair a node, before the tiles


def near_duplicates(df, id_col="doc_id", text_col="text", width=5, percent=80):
    """One row per document: (id, n_shingles, component_id, kept, n_links, group_node).

    Two documents are linked where 100 * intersection >= percent * union of
    their sets of ``width``-word shingles (A-Z in lower case); ``component_id``
    is the smallest id reachable, ``kept`` marks that document, and ``n_links``
    counts the verified links of the document's set that hold its group together. Null and empty
    texts, and texts without words, have no shingles and are linked with
    nothing. Repeated rows have equal sets and share a component; rows that
    share an id but not a text are documents of their own. A null id never
    names a component and is not kept. Other columns are not read.
    """
    spark = df.sparkSession
    s = Scratch(spark, "minhash")
    rows_of_band = band_rows(percent / 100)
    keys = df.count() * (HASHES // rows_of_band)
    part_bits = min(31, max(8, (keys // PART_KEYS).bit_length()))
    every = s.cut(sketches(df, id_col, text_col, width, rows_of_band, part_bits), "sketches")
    members = s.cut(bucket_members(every), "members")
    rows = every.where(F.col("kind") == DOC).select("id", "n_shingles", "node")
    wanted = members.select("node").distinct()
    texts = s.cut(rows.where("node is not null").groupBy("node").agg(F.min("id").alias("id")).join(wanted, "node", "left_semi"), "texts")
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("__t"))
    sets = s.cut(_sets_of(source, texts, width), "sets")
    nodes = sets.select("node", "sig")

    threshold = percent / 100
    links = s.cut(_linked(_judge(_leaders(members), nodes, threshold), sets, percent), "links0")
    labels = roots(s, links.select(F.col("b").alias("node"), F.col("a").alias("up")), "comp0")
    named = lambda: members.join(labels, "node", "left").select("bucket", "node", F.coalesce("comp", "node").alias("comp"))
    for turn in range(1, STAR_ROUNDS):
        more = s.cut(_linked(_judge(_others(s.cut(named(), f"named{turn}"), turn), nodes, threshold), sets, percent), f"links{turn}")
        s.drop(f"named{turn}")
        if not more.limit(1).count():
            break
        labels, links = _joined(s, labels, more, f"comp{turn}"), links.unionAll(more)
    tiles = s.cut(_tiles(s, s.cut(named(), "named"), nodes), "tiles")
    groups = max(1, tiles.count() // GROUP_ROWS)
    packed = tiles.groupBy(F.pmod("tile", F.lit(groups))).applyInArrow(_compare(threshold, _side(sets.count())), _PACKED)
    across = s.cut(_linked_blocks(s, packed, sets, labels, percent), "across")
    s.drop("tiles", "named", "blocks")
    if across.limit(1).count():
        labels, links = _joined(s, labels, across, "comp"), links.unionAll(across)
    ends = links.select(F.col("a").alias("node")).unionAll(links.select(F.col("b").alias("node")))
    degree = ends.groupBy("node").agg(F.count("*").alias("n_links"))
    by_node = (texts.join(labels, "node", "left").join(degree, "node", "left")
               .select("node", "id", F.coalesce("comp", "node").alias("comp"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    least = by_node.groupBy("comp").agg(F.min("id").alias("component_id"))
    named = s.cut(by_node.join(least, "comp").select("node", "component_id", "n_links", F.col("comp").alias("group_node")), "nodes")
    s.drop("sets", "members")
    # a node that is alone in all its buckets is a group of its own
    alone = rows.where("node is not null").groupBy("node").agg(F.min("id").alias("alone"))
    out = rows.join(named, "node", "left").join(alone, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(
        F.when(F.col("group_node").isNull(), F.col("alone")).otherwise(F.col("component_id")))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
                      F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("group_node", "node").alias("group_node"))


def _sets_of(source, texts, width):
    """(node, sig, shingles) of the nodes of ``texts``, from the rows whose ids made them. The ids go
    to the scan as a bit map of bounded size, so no other text moves; what it lets through
    beyond them is dropped by node."""
    number = texts.count()
    slots = min(MOST_SLOTS, 1 << max(16, (SLOTS * max(1, number) - 1).bit_length()))
    wanted = bit_map(source.sparkSession, texts.select(F.xxhash64("id").alias("h")), slots)
    picked = source.where(wanted(F.xxhash64("id"))).select("__t")
    found = full_sets(picked, "__t", width).join(texts.select("node"), "node", "left_semi")
    return found.groupBy("node").agg(F.first("sig").alias("sig"), F.first("shingles").alias("shingles"))
