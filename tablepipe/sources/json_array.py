"""Elements of one large JSON array, read by many tasks.

A JSON array in one file - an export, or the ``features`` of a collection - is no
line format, so Spark's JSON reader gives the whole file to one task. Here the
text reader splits the file at closing braces into byte ranges, on any file system:

1. Each range folds into a small state map: for either start (outside or inside a
   string) how it changes the bracket depth, how low the depth gets, where the
   wanted array opens; and whether it holds an odd number of quotes.
2. The maps of a file are composed in order, a few numbers per range, which gives
   every range its start: in a string or not, the depth, in the wanted array or
   not, and the range where the element that is open began.
3. Each range gives out its whole elements, which are parsed and written to the shared
   folder in the same scan; the pieces of elements that cross ranges meet by (file,
   range of the first piece), are joined in order and then parsed.

So the text is read twice, however often its rows are used.
An array's elements have to be objects. Compressed files are one range.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepipe.session import scratch_path, ship_package

_QUOTE, _SLASH = 0x22, 0x5C
_CURLY_OPEN, _CURLY_CLOSE, _CASE = 0x7B, 0x7D, 0x20  # square brackets differ from the curly ones by one bit


class BrokenArray(ValueError):
    """The text is no JSON array of objects."""


def _chunks(spark: SparkSession, path) -> DataFrame:
    """(file, start, size, value): texts between closing braces, in order inside a byte range."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("size"), "value")


def _ranges(batch):
    """(file, start, size, bytes) for each run of rows of one byte range in a batch: its texts, a closing
    brace behind each."""
    file, start, size = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
    if not len(file):
        return
    cuts = np.flatnonzero(np.concatenate([[True], (file[1:] != file[:-1]) | (start[1:] != start[:-1]), [True]]))
    for a, b in zip(cuts[:-1], cuts[1:]):
        texts = pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), batch.column(3).slice(a, b - a).cast(pa.binary()))
        yield int(file[a]), int(start[a]), int(size[a]), pc.binary_join(texts, b"}")[0].as_py() + b"}"


def marks(data: bytes):
    """(places of brackets, +1 or -1 for each, quotes before each modulo 2, quotes modulo 2) of a text
    as if it started outside strings."""
    b = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(b == _QUOTE)
    if len(quotes) and _SLASH in data:
        slashes = np.flatnonzero(b == _SLASH)
        begins = np.flatnonzero(np.concatenate([[True], np.diff(slashes) > 1]))  # of each run of backslashes
        k = np.searchsorted(slashes, quotes) - 1  # the last backslash before each quote
        run = np.searchsorted(begins, k, "right") - 1
        length = np.where((k >= 0) & (slashes[k] == quotes - 1), k - begins[run] + 1, 0)
        quotes = quotes[length % 2 == 0]
    curly = b | _CASE
    opening = curly == _CURLY_OPEN
    places = np.flatnonzero(opening | (curly == _CURLY_CLOSE))
    return places, np.where(opening[places], 1, -1), np.searchsorted(quotes, places) % 2, len(quotes) % 2


def _opener(key):
    return re.compile(b'"' + re.escape(key.encode()) + rb'"\s*:\s*\[') if key else None


class RangeMap:
    """The state map of a byte range: for s = 0 (starts outside a string) and 1 (inside)."""

    def __init__(self, key, first):
        self.opener, self.first = _opener(key), first
        self.odd, self.bytes = 0, 0
        self.depth, self.low = [0, 0], [0, 0]
        self.opens = [[], []]  # [depth of the array's inside, lowest depth after it]

    def add(self, data: bytes):
        places, kind, odd, total = marks(data)
        found = [m.end() - 1 for m in self.opener.finditer(data)] if self.opener else []
        for s in (0, 1):
            live = (odd + self.odd + s) % 2 == 0
            steps = kind[live]
            if not len(steps):
                continue
            path = self.depth[s] + np.cumsum(steps)
            low = int(path.min())
            for o in self.opens[s]:
                o[1] = min(o[1], low)
            if self.opener is None and self.first:  # the root array opens the file
                found = [int(places[0])] if data[places[0]] == 0x5B else []
            for at in np.flatnonzero(np.isin(places[live], found)) if len(found) else ():
                self.opens[s].append([int(path[at]), int(path[at:].min())])
            self.low[s] = min(self.low[s], low)
            self.depth[s] = int(path[-1])
        self.first = self.first and not len(places)
        self.odd = (self.odd + total) % 2

    def row(self, file, start, size):
        return {"file": file, "start": start, "size": size, "bytes": self.bytes, "odd": self.odd,
                "depth": self.depth, "low": self.low, "opens": [[list(o) for o in x] for x in self.opens]}


_MAP_SCHEMA = ("file long, start long, size long, bytes long, odd int, depth array<long>, low array<long>, "
               "opens array<array<array<long>>>")
_MAP_TYPE = pa.schema([("file", pa.int64()), ("start", pa.int64()), ("size", pa.int64()), ("bytes", pa.int64()),
                       ("odd", pa.int32()), ("depth", pa.list_(pa.int64())), ("low", pa.list_(pa.int64())),
                       ("opens", pa.list_(pa.list_(pa.list_(pa.int64()))))])


def range_maps(chunks: DataFrame, key) -> DataFrame:
    """One row per byte range: its state map."""
    def run(batches):
        at, own = None, None
        for batch in batches:
            for file, start, size, data in _ranges(batch):
                if at != (file, start, size):
                    if at:
                        yield pa.RecordBatch.from_pylist([own.row(*at)], schema=_MAP_TYPE)
                    at, own = (file, start, size), RangeMap(key, start == 0)
                own.bytes += len(data)
                own.add(data)
        if at:
            yield pa.RecordBatch.from_pylist([own.row(*at)], schema=_MAP_TYPE)

    return chunks.mapInArrow(run, _MAP_SCHEMA)


def compose(rows, key):
    """{(file, start): (in a string, depth, in the wanted array, start of the range where the open
    element began)} from the rows of ``range_maps``."""
    level = 2 if key else 1
    out = {}
    by_file = {}
    for r in rows:
        by_file.setdefault(r["file"], []).append(r)
    for file, own in by_file.items():
        own.sort(key=lambda r: r["start"])
        bare_end = sum(r["bytes"] for r in own) == own[0]["size"] + 1  # one brace more than the file has
        string, depth, wanted, began, seen = 0, 0, False, None, False
        for r in own:
            out[file, r["start"]] = (string, depth, wanted, began)
            end, low = depth + r["depth"][string], depth + r["low"][string]
            opened = [o for o in r["opens"][string] if depth + o[0] == level]
            if opened:
                if seen or len(opened) > 1:
                    raise BrokenArray("a second array")
                seen, wanted = True, depth + opened[0][1] >= level
                began = r["start"] if wanted and end > level else None
            elif wanted:
                wanted = low >= level
                if not wanted or end <= level:
                    began = None
                elif low <= level:
                    began = r["start"]
            string = (string + r["odd"]) % 2
            depth = end
        if string or depth + bare_end != 0 or not seen:  # that brace closed nothing
            raise BrokenArray(f"an array that does not end, or no array{f' {key!r}' if key else ''}")
    return out


class Elements:
    """The elements of one byte range, from its start state on."""

    def __init__(self, key, state):
        self.opener, self.level = _opener(key), 2 if key else 1
        self.string, self.depth, self.wanted, self.began = state
        self.held = []  # pieces of the element that is open
        self.number = 0

    def add(self, data: bytes):
        """Yields (whole, text) pieces; whole is False for the end of an element that began in an earlier range."""
        places, kind, odd, total = marks(data)
        live = (odd + self.string) % 2 == 0
        places, kind = places[live], kind[live]
        path = self.depth + np.cumsum(kind)
        level = self.level
        since = 0 if self.depth > level and self.wanted else None
        gap = 0 if since is None and self.wanted else None
        begins, ends = places[(kind > 0) & (path == level + 1)], places[(kind < 0) & (path == level)] + 1
        if self.wanted and len(path) and int(path.min()) >= level:  # within the array all through
            yield from self._inside(data, begins.tolist(), ends.tolist(), since)
            self.string, self.depth = (self.string + total) % 2, int(path[-1])
            return
        opens = places[(kind > 0) & (path == level)]
        found = self.found(data) if len(opens) else ()
        opens = [p for p in opens.tolist() if self.opener is None and data[p] == 0x5B or p in found]
        edges = [(p + 1, 0) for p in opens]
        edges += [(p, 1) for p in ends.tolist()]
        edges += [(p, 2) for p in begins.tolist()]
        edges += [(p, 3) for p in places[(kind < 0) & (path == level - 1)].tolist()]
        for at, what in sorted(edges):
            if what == 0:
                self.wanted, gap = True, at
            elif not self.wanted:
                continue
            elif what == 1 and since is not None:
                self.held.append(data[since:at])
                yield self.began is None, b"".join(self.held)
                self.held, since, self.began, gap = [], None, None, at
                self.number += 1
            elif what == 2:
                _only_commas(data[gap:at])
                since, gap = at, None
            elif what == 3:
                _only_commas(data[gap:at])
                self.wanted, gap = False, None
        if since is not None:
            self.held.append(data[since:])
        elif gap is not None:
            _only_commas(data[gap:])
        self.string = (self.string + total) % 2
        self.depth = int(path[-1]) if len(path) else self.depth

    def _inside(self, data, begins, ends, since):
        """The pieces of a text that lies within the array; ``begins`` and ``ends`` of elements take turns."""
        if since is not None:
            if not ends:
                self.held.append(data)
                return
            self.held.append(data[:ends[0]])
            yield self.began is None, b"".join(self.held)
            self.held, self.began = [], None
            self.number += 1
            gaps = zip(ends, [*begins, len(data)])
            ends = ends[1:]
        else:
            gaps = zip([0, *ends], [*begins, len(data)])
        for gap in {data[a:b] for a, b in gaps if a <= b}:
            _only_commas(gap)
        for a, b in zip(begins, ends):
            yield True, data[a:b]
            self.number += 1
        if len(begins) > len(ends):
            self.held.append(data[begins[-1]:])

    def found(self, data):
        return {m.end() - 1 for m in self.opener.finditer(data)} if self.opener else ()


def _only_commas(gap):
    if gap.strip() not in (b"", b","):
        raise BrokenArray(f"an element that is no object: {gap.strip()[:40]!r}")


_PIECES = "file long, began long, start long, pos long, whole boolean, element string"
_PIECE_TYPE = pa.schema([("file", pa.int64()), ("began", pa.int64()), ("start", pa.int64()), ("pos", pa.int64()),
                         ("whole", pa.bool_()), ("element", pa.string())])


def pieces(chunks: DataFrame, key, shared) -> DataFrame:
    """(file, began, start, pos, whole, element): whole elements, and pieces of those that cross ranges;
    ``shared`` is a broadcast of the ranges' starts and the files' ranks."""
    def run(batches):
        starts, ranks = shared.value
        at, own = None, None
        for batch in batches:
            out = []
            for file, start, _, data in _ranges(batch):
                if at != (file, start):
                    out += _rest(at, own, ranks)
                    at, own = (file, start), Elements(key, starts[file, start])
                began = own.began
                for whole, text in own.add(data):
                    out.append((ranks[file], start if whole else began, start, own.number, whole, text.decode()))
            if out:
                yield _piece_batch(out)
        out = _rest(at, own, ranks)
        if out:
            yield _piece_batch(out)

    return chunks.mapInArrow(run, _PIECES)


def _rest(at, own, ranks):
    """The piece of an element that goes on in the next range."""
    if own is None or not own.held:
        return []
    file, start = at
    return [(ranks[file], start if own.began is None else own.began, start, own.number + 1, False, b"".join(own.held).decode())]


def _piece_batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PIECE_TYPE.types)], schema=_PIECE_TYPE)


def parsed_elements(spark: SparkSession, path, parse, key: str | None = None, order_col: str | None = None,
                    stage: str | None = None) -> DataFrame:
    """One row per element of the array: ``element``, what the function ``parse`` of a column
    makes of its JSON text. ``key`` names the array in the file's root object, without it the
    root itself is the array. ``order_col`` adds the elements' order (file by path, byte
    range, number) as one orderable column.

    The text is scanned twice and every element is parsed once: the rows come from a table in
    the shared folder, so any number of later jobs reads the columns it wants of it, and the text
    is not read again. ``stage`` names that table's path, for a caller that deletes it after use.
    No whole element is shuffled; only pieces of elements that cross byte ranges (one a range) move.
    The driver holds a few numbers per byte range. Text that is no such array, or an array cut
    off before its end, raises ``BrokenArray``."""
    ship_package(spark)
    chunks = _chunks(spark, path)
    starts = compose([r.asDict(True) for r in range_maps(chunks, key).collect()], key)
    names = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("name"))
    names = names.select(F.xxhash64("name").alias("file"), "name").orderBy("name").collect()
    ranks = {r["file"]: k for k, r in enumerate(names)}
    rows = pieces(chunks, key, spark.sparkContext.broadcast((starts, ranks)))
    rows = rows.select("file", "began", "start", "pos", "whole", F.when(~F.col("whole"), F.col("element")).alias("piece"),
                       parse(F.when(F.col("whole"), F.col("element"))).alias("element"))
    stage = stage or scratch_path(spark, "elements")
    rows.write.parquet(stage)
    rows = spark.read.schema(rows.schema).parquet(stage)
    order = F.struct("file", "began", "pos")
    columns = ["element"] + ([order.alias(order_col)] if order_col else [])
    whole = rows.where("whole").select(*columns)
    crossing = rows.where("not whole").groupBy("file", "began").agg(
        F.array_sort(F.collect_list(F.struct("start", "piece"))).alias("parts"))
    joined = crossing.select("file", "began", F.lit(2**62).alias("pos"), parse(F.array_join("parts.piece", "")).alias("element"))
    return whole.unionByName(joined.select(*columns))


def array_elements(spark: SparkSession, path, key: str | None = None, order_col: str | None = None) -> DataFrame:
    """One row per element of the array: ``element`` (JSON text); see :func:`parsed_elements`."""
    return parsed_elements(spark, path, lambda text: text, key, order_col)
