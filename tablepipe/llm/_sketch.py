"""Counting Bloom sketches of 64-bit hashes: counted sparsely by each task, added up by
segment, and read as a bit map of bounded size."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablepipe.llm._text import map_arrow, prepare
from tablepipe.llm._words import mix

PROBES, SLOTS = 3, 16  # counters and slots for each hash
MOST_SLOTS = 1 << 29  # 64 MB of bits
SEGMENT = 1 << 16
FLUSH = 1 << 20  # counters that a task holds before it passes them on


def slots_of(hashes, slots):
    """uint64 [PROBES, n]: the counters of each hash."""
    h = hashes.astype(np.uint64)
    steps = np.arange(1, PROBES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(h[None, :] + steps[:, None]) & np.uint64(slots - 1)


def sketches(hashes, slots) -> DataFrame:
    """(segment, spots, counts): the counters of each task by segment, sparse; ``hashes`` has the one column h."""
    def out(parts):
        spot, n = np.unique(np.concatenate(parts), return_counts=True)
        segment = (spot // SEGMENT).astype(np.int64)
        cuts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1], [True]]))
        low, n = (spot % SEGMENT).astype("<u2"), np.minimum(n, 255).astype(np.uint8)
        return pa.RecordBatch.from_arrays(
            [pa.array(segment[cuts[:-1]], pa.int64()),
             pa.array([low[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])], pa.binary()),
             pa.array([n[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])], pa.binary())], ["segment", "spots", "counts"])

    def run(batches):
        parts, held = [], 0
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            parts.append(slots_of(h, slots).ravel())
            held += parts[-1].size
            if held >= FLUSH:
                yield out(parts)
                parts, held = [], 0
        if held:
            yield out(parts)

    return map_arrow(hashes, run, "segment long, spots binary, counts binary")


def merged(parts, least) -> DataFrame:
    """(segment, bits): the sketches of a segment added up, one bit for each counter of at least ``least``."""
    def run(table):
        spots = np.frombuffer(b"".join(table["spots"].to_pylist()), "<u2")
        counts = np.frombuffer(b"".join(table["counts"].to_pylist()), np.uint8)
        total = np.bincount(spots, weights=counts, minlength=SEGMENT)
        return pa.table({"segment": table["segment"].slice(0, 1), "bits": pa.array([np.packbits(total >= least).tobytes()], pa.binary())})

    prepare(parts.sparkSession)
    return parts.groupBy("segment").applyInArrow(run, "segment long, bits binary")


def bit_map(spark, hashes, slots, least=1):
    """Column function over a hash: false only where it stands fewer than ``least`` times in
    ``hashes`` (one column h). At most ``MOST_SLOTS`` bits go through the driver."""
    bits = np.zeros(max(slots, SEGMENT) // 8, np.uint8)
    for row in merged(sketches(hashes, slots), least).toLocalIterator():
        at = row["segment"] * SEGMENT // 8
        bits[at:at + SEGMENT // 8] = np.frombuffer(row["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(bits.tobytes())

    @F.pandas_udf("boolean")
    def known(h: pd.Series) -> pd.Series:
        table = np.frombuffer(shared.value, np.uint8)
        spot = slots_of(h.to_numpy().view(np.uint64), slots)
        return pd.Series(((table[spot >> np.uint64(3)] >> (7 - (spot & np.uint64(7))).astype(np.uint8)) & 1).all(0))

    prepare(spark)
    return known
