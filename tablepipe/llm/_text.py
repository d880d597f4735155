"""Arrow helpers of the text operators: bounded sub-batches and raw UTF-8 views."""

from __future__ import annotations

import ctypes
import functools
import inspect

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tablepipe.session import ship_package

# A worker holds one slice of a batch at a time; a longer text is a slice of its own.
SLICE_BYTES = 512 << 10


def text_column(batch, name):
    """The column as a string array, null read as empty."""
    col = batch.column(batch.schema.get_field_index(name))
    if not (pa.types.is_string(col.type) or pa.types.is_large_string(col.type)):
        col = col.cast(pa.string())
    return pc.fill_null(col, "")


def slices(batches, name, budget=SLICE_BYTES):
    """(batch slice, its text array with nulls as empty) of at most ``budget`` text bytes,
    one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        texts = text_column(batch, name)
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        row, n = 0, batch.num_rows
        while row < n:
            done = int(ends[row - 1]) if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, done + budget, side="right")))
            yield batch.slice(row, stop - row), texts.slice(row, stop - row)
            row = stop
        del batch, texts, ends
        release()


@functools.lru_cache(1)
def _trim():
    """glibc's ``malloc_trim``, where the C library has it."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return lambda pad: 0


def release():
    """Give freed memory back: a worker that goes on to other stages keeps none of it."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


# Of glibc's mallopt; an array of that many bytes is a mapping of its own and leaves the process when it goes.
MMAP_THRESHOLD, MMAP_BYTES = -3, 1 << 20


@functools.lru_cache(1)
def _map_arrays():
    """From now on arrays do not go to the heap. By default glibc raises the limit up to 32 MB
    when such an array is freed, and the heap keeps the most that ever was in use."""
    try:
        ctypes.CDLL(None).mallopt(MMAP_THRESHOLD, MMAP_BYTES)
    except (OSError, AttributeError):
        pass


def returned(run):
    """A grouped function whose worker keeps little memory of a group: Spark leaves the workers
    of earlier stages waiting beside those at work, each with what it did not give back."""
    def of_group(*group):
        _map_arrays()
        out = run(*group)
        release()
        return out

    if len(inspect.signature(run).parameters) == 1:  # Spark counts the parameters
        return lambda table: of_group(table)
    return lambda key, left, right: of_group(key, left, right)


def utf8_view(texts):
    """(bytes of all texts as uint8, offsets int64 of n + 1 entries starting at 0)."""
    if pa.types.is_large_string(texts.type):
        width, kind = 8, np.int64
    else:
        width, kind = 4, np.int32
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], kind, n + 1, texts.offset * width).astype(np.int64)
    first, last = int(offsets[0]), int(offsets[-1])
    if last == first:
        data = np.zeros(0, np.uint8)
    else:
        data = np.frombuffer(buffers[2], np.uint8, last - first, first)
    return data, offsets - first


def code_points(data):
    """(code points uint32, byte position of each) of valid UTF-8."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), "<u4")
    if len(points) == len(data):
        return points, np.arange(len(data), dtype=np.int64)
    return points, np.flatnonzero((data & 0xC0) != 0x80)


def long_column(batch, name):
    """The column as an Arrow int64 array (nulls kept)."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.int64())


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def map_arrow(df, run, schema):
    """``df.mapInArrow`` with this package importable in the Python workers.

    Rows hold whole texts, so a session that names no batch size gets batches of
    500 rows (Spark's default of 10,000 would hold tens of MB on either side)."""
    prepare(df.sparkSession)
    return df.mapInArrow(run, schema)


def prepare(spark):
    ship_package(spark)
    if spark.conf.get(BATCH_ROWS, None) is None:
        spark.conf.set(BATCH_ROWS, "500")
