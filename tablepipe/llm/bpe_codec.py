"""Byte-level BPE encoding and decoding on length-bucketed padded numpy matrices.

Texts are split by the pre-tokenizer transducer. The distinct pieces of a slice
that are not in the piece cache go into matrices by length bucket, one row per
piece, padded. In each round every row merges its leftmost pair of minimum rank:
ranks come from a hashed table of token pairs, the row is closed up behind the
merge, only the two pairs beside it are looked up anew, and finished rows leave
the matrix. Rows beyond ``LONG`` bytes merge all places of the minimum pair in
one round where no token built from its result has a smaller rank (then the
leftmost-first order gives the same tokens), so a long run costs a round per
distinct pair instead of one per byte.

Decoding gathers token bytes by id from one byte array.
"""

from __future__ import annotations

import base64
import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from tablepipe.llm._text import long_column, map_arrow, slices, utf8_view
from tablepipe.llm.pretoken import piece_bounds

RANK_FILE = "byte_bpe_50k.tiktoken"
LONG = 1024
BUCKETS = (2, 4, 6, 8, 12, 16, 24, 32, 64, 128, 256, 512, LONG)
CELLS = 1 << 21  # matrix cells at a time
CACHE_PIECES = 60_000  # a worker keeps them between tasks: about 20 MB
NONE = np.int32(2**31 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def default_path(name=RANK_FILE):
    import public_tokenizers

    return public_tokenizers.path(name)


def read_ranks(path):
    """{token bytes: rank} of a rank file (base64 token, rank)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PairTable:
    """Open-addressing hash table (left id, right id) -> id of the joined token."""

    def __init__(self, keys, values):
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, np.uint64(2**64 - 1), np.uint64)
        self.values = np.full(1 << bits, NONE, np.int32)
        empty = self.keys[0]
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slot[left]] == empty
            want = left[free]
            first = np.unique(slot[want], return_index=True)[1]  # one key a slot and round
            put = want[first]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            left = left[self.keys[slot[left]] != keys[left]]
            taken = self.keys[slot[left]] != empty
            slot[left[taken]] = (slot[left[taken]] + 1) & self.mask

    def _slot(self, keys):
        return ((keys * _MIX) >> self.shift).astype(np.int64)

    def get(self, left, right):
        """Ids of the joined tokens, NONE where a pair makes no token."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.values[slot], NONE)
        open_ = np.flatnonzero((self.keys[slot] != keys) & (self.values[slot] != NONE))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            at = slot[open_]
            hit = self.keys[at] == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (self.values[at] != NONE)]
        return out


class Codec:
    """Encoder and decoder of one rank file; keep one per process (``codec``)."""

    def __init__(self, ranks):
        tokens = sorted(ranks.items(), key=lambda x: x[1])
        size = max(ranks.values()) + 1
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        keys, values = [], []
        for token, rank in tokens:
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        keys, values = np.array(keys, np.uint64), np.array(values, np.int32)
        self.pairs = PairTable(keys, values)
        lowest = np.full(size, NONE, np.int32)  # smallest rank that a merge with the token makes
        np.minimum.at(lowest, (keys >> np.uint64(32)).astype(np.int64), values)
        np.minimum.at(lowest, (keys & np.uint64(2**32 - 1)).astype(np.int64), values)
        self.safe = lowest > np.arange(size)
        lengths = np.zeros(size, np.int64)
        for token, rank in tokens:
            lengths[rank] = len(token)
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        blob = bytearray(int(self.starts[-1]))
        for token, rank in tokens:
            blob[self.starts[rank]:self.starts[rank] + len(token)] = token
        self.blob = np.frombuffer(bytes(blob), np.uint8)
        self.cache: dict = {}

    # encoding of pieces

    def encode_pieces(self, pieces):
        """Ids (int32 arrays) of each byte string."""
        out = [None] * len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        bucket = np.searchsorted(BUCKETS, lengths)
        for k in np.unique(bucket):
            rows = np.flatnonzero(bucket == k)
            if k == len(BUCKETS):
                for r in rows:
                    out[r] = self._long(pieces[r])
                continue
            step = max(1, CELLS // BUCKETS[k])
            for i in range(0, len(rows), step):
                part = rows[i:i + step]
                for r, ids in zip(part, self._matrix([pieces[r] for r in part], BUCKETS[k])):
                    out[r] = ids
        return out

    def _matrix(self, pieces, width):
        n = len(pieces)
        flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8)
        ids = self.of_byte[flat].reshape(n, width)
        size = np.fromiter(map(len, pieces), np.int64, n)
        columns = np.arange(width)
        ranks = np.full((n, width), NONE, np.int32)  # of the pair that starts in each cell
        inside = columns[None, :-1] + 1 < size[:, None]
        ranks[:, :-1][inside] = self.pairs.get(ids[:, :-1][inside], ids[:, 1:][inside])
        result, live = [None] * n, np.arange(n)
        while len(live):
            at = ranks.argmin(1)
            rank = ranks[np.arange(len(live)), at]
            over = rank == NONE
            if over.any():
                for r in np.flatnonzero(over):
                    result[live[r]] = ids[r, :size[r]].copy()
                keep = ~over
                ids, ranks, size, live, at, rank = ids[keep], ranks[keep], size[keep], live[keep], at[keep], rank[keep]
                if not len(live):
                    break
                used = int(size.max())
                ids, ranks = ids[:, :used], ranks[:, :used]
            rows, used = np.arange(len(live)), ids.shape[1]
            source = columns[:used][None, :] + (columns[:used][None, :] > at[:, None])
            np.minimum(source, used - 1, out=source)
            ids = np.take_along_axis(ids, source, 1)
            ids[rows, at] = rank
            ranks = np.take_along_axis(ranks, source, 1)
            size = size - 1
            ranks[rows, size - 1] = NONE
            has = at + 1 < size
            ranks[rows[has], at[has]] = self.pairs.get(rank[has], ids[rows[has], at[has] + 1])
            has = at > 0
            ranks[rows[has], at[has] - 1] = self.pairs.get(ids[rows[has], at[has] - 1], rank[has])
        return result

    def _long(self, piece):
        ids = self.of_byte[np.frombuffer(piece, np.uint8)]
        ranks = self.pairs.get(ids[:-1], ids[1:])
        while len(ranks):
            first = int(ranks.argmin())
            rank = ranks[first]
            if rank == NONE:
                break
            at = np.flatnonzero(ranks == rank) if self.safe[rank] else np.array([first])
            run = np.cumsum(np.concatenate([[True], np.diff(at) > 1])) - 1
            head = at[np.concatenate([[True], np.diff(at) > 1])]
            at = at[(at - head[run]) % 2 == 0]  # overlapping places: leftmost first
            ids = ids.copy()
            ids[at] = rank
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            ranks = np.append(ranks, NONE)[stay]
            ids = ids[stay]
            new = at - np.arange(len(at))
            touched = np.unique(np.concatenate([new, new - 1]))
            touched = touched[(touched >= 0) & (touched < len(ids) - 1)]
            ranks = ranks[:-1]
            ranks[touched] = self.pairs.get(ids[touched], ids[touched + 1])
        return ids

    # decoding

    def decode(self, ids):
        """Bytes of an id array: one gather from the token byte array."""
        ids = np.asarray(ids, np.int64)
        lengths = self.starts[ids + 1] - self.starts[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.blob[at].tobytes()

    # texts

    def encode_texts(self, texts):
        """Piece entries of each text of a string array: (ids as text, ids as int32 bytes)."""
        data, offsets = utf8_view(texts)
        begin, stop, owner = piece_bounds(data, offsets)
        buf = data.tobytes()
        pieces = [buf[s:e] for s, e in zip(begin.tolist(), stop.tolist())]
        if len(self.cache) > CACHE_PIECES:
            self.cache.clear()
        known = self.cache
        new = list(set(pieces).difference(known))
        for piece, ids in zip(new, self.encode_pieces(new)):
            known[piece] = (" ".join(map(str, ids.tolist())).encode(), ids.astype("<i4").tobytes())
        entries = [known[p] for p in pieces]
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        return [entries[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


@functools.lru_cache(2)
def codec(path):
    return Codec(read_ranks(path))


def encode(df, text_col="text", path=None):
    """``df`` with ``token_ids array<int>`` of each whole text.

    Null and empty texts give an empty array. ``path`` names a rank file that
    every executor can open; the default is the public 50k byte vocabulary.
    """
    path = path or default_path()

    def run(batches):
        c = codec(path)
        for batch, texts in slices(batches, text_col):
            ids = [b"".join([e[1] for e in entries]) for entries in c.encode_texts(texts)]
            ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            arrays = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays(ends, values)],
                                             [*batch.schema.names, out_name])

    out_name = "token_ids"
    while out_name in df.columns:
        out_name = f"_{out_name}"
    schema = T.StructType([*df.schema.fields, T.StructField(out_name, T.ArrayType(T.IntegerType()))])
    return map_arrow(df, run, schema)


def decode(df, ids_col="token_ids", path=None):
    """``df`` with ``decoded binary``: the bytes of each id array (null: empty)."""
    path = path or default_path()
    out_name = "decoded"
    while out_name in df.columns:
        out_name = f"_{out_name}"

    def run(batches):
        c = codec(path)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids_col))
            got = [c.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else b"" for x in lists]
            arrays = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(got, pa.binary())], [*batch.schema.names, out_name])

    return map_arrow(df, run, T.StructType([*df.schema.fields, T.StructField(out_name, T.BinaryType())]))


def digests(df, id_col="doc_id", text_col="text", path=None):
    """One row per document: (id, n_tokens, ids_sha256, decoded_sha256).

    Each whole text is encoded and its ids decoded again in the same task, so
    ids never leave it. ``ids_sha256`` is of the decimal ids joined by one
    space, ``decoded_sha256`` of the decoded bytes. Null text counts as empty
    (0 tokens, digests of the empty string); a null id stays null; repeated
    rows each give a row; other columns are not read.
    """
    path = path or default_path()

    def run(batches):
        c = codec(path)
        for batch, texts in slices(batches, text_col):
            counts, hashes, decoded = [], [], []
            for entries in c.encode_texts(texts):
                ids = np.frombuffer(b"".join([e[1] for e in entries]), "<i4")
                counts.append(len(ids))
                hashes.append(hashlib.sha256(b" ".join([e[0] for e in entries])).hexdigest())
                decoded.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [long_column(batch, id_col), pa.array(counts, pa.int64()), pa.array(hashes), pa.array(decoded)],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = f"`{id_col}` long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_arrow(df.select(id_col, text_col), run, schema)
