"""Paged extract as a Python Data Source.

``spark.read.format("paged")`` plans one input partition per page, so pages
are fetched in parallel by executor tasks instead of one loop on one machine.
A page is ``fetch(offset, limit)``: either a list of lists whose first row is
the header (as the portal returns CSV), or an Arrow table. Headers are cleaned
(strip, lower, drop non-word characters, system ``sid`` -> ``id``) and the
columns come out in ``columns`` order, all as text; typing is a Catalyst
projection afterwards.

Page plan: pages at offsets 0, P, 2P, ... up to the row count. With a
``size_limit`` S the extract stops after the first page whose offset is at
least S, so it holds up to ``(ceil(S/P) + 1) * P`` rows, as the original did.

Options: ``fetcher`` (``module:Class``), ``fetcher_args`` (JSON object),
``columns`` (comma list, required), ``page_size`` (default 90000),
``size_limit`` (optional, > 0), ``row_count`` (optional; else asked of the
fetcher).
"""

from __future__ import annotations

import importlib
import json
import math
import re

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Fixed value: default page size of the extract.
PAGE_SIZE = 90_000
_NON_WORD = re.compile(r"[^a-zA-Z0-9_]")


def clean_header(name: str) -> str:
    """Portal header rule: strip, lower, drop non-word characters, exact ``sid`` -> ``id``."""
    n = _NON_WORD.sub("", name.strip().lower())
    return "id" if n == "sid" else n


def page_offsets(row_count: int, page_size: int, size_limit=None) -> list[int]:
    if page_size <= 0:
        raise ValueError("page_size must be positive")
    if size_limit is not None and size_limit <= 0:
        raise ValueError("size_limit must be positive (None means no limit)")
    n = math.ceil(max(row_count, 0) / page_size)
    if size_limit is not None:
        n = min(n, math.ceil(size_limit / page_size) + 1)
    return [i * page_size for i in range(n)]


def load_fetcher(spec: str, args: dict):
    mod, _, cls = spec.partition(":")
    return getattr(importlib.import_module(mod), cls)(**args)


class Page(InputPartition):
    def __init__(self, offset: int, limit: int, hint=None):
        self.offset, self.limit, self.hint = offset, limit, hint


class Rest(InputPartition):
    """The pages from an offset on, until a short or empty one: the last partition, since a
    source may have grown since its pages were planned."""

    def __init__(self, offset: int):
        self.offset = offset


def has_row(page) -> bool:
    """Whether a page (a list of lists with a header, or an Arrow table) has a row."""
    return len(page) > 1 if isinstance(page, list) else page.num_rows > 0


def frontier(probe, page_size: int, most: int | None = None) -> int:
    """The number of pages of a source that cannot count its rows: pages 1, 2, 4, ... are
    probed until one is empty, then the last one with rows is found by halving. ``probe(offset)``
    tells whether a row stands at an offset; ``most`` bounds the pages."""
    if not probe(0):
        return 0
    low, high = 0, 1  # page low has rows
    while (most is None or high < most) and probe(high * page_size):
        low, high = high, 2 * high
    high = high if most is None else min(high, most)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if probe(middle * page_size) else (low, middle)
    return low + 1


class PagedDataSource(DataSource):
    @classmethod
    def name(cls):
        return "paged"

    def schema(self):
        cols = [c.strip() for c in self.options.get("columns", "").split(",") if c.strip()]
        if not cols:
            raise ValueError("option 'columns' is required (declared column order)")
        return ", ".join(f"`{c}` string" for c in cols)

    def reader(self, schema):
        return PagedReader(self.options, schema)


class PagedReader(DataSourceReader):
    def __init__(self, options, schema):
        self.options = dict(options)
        self.columns = [f.name for f in schema.fields]
        self.page_size = int(self.options.get("page_size", PAGE_SIZE))
        lim = self.options.get("size_limit")
        self.size_limit = int(lim) if lim not in (None, "", "None") else None
        self.spec = self.options["fetcher"]
        self.args = json.loads(self.options.get("fetcher_args", "{}"))

    def partitions(self):
        fetcher = load_fetcher(self.spec, self.args)
        rc = self.options.get("row_count")
        index = fetcher.index() if hasattr(fetcher, "index") else None
        if rc in (None, "") and index is None and not hasattr(fetcher, "count"):
            most = None if self.size_limit is None else len(page_offsets(2**62, self.page_size, self.size_limit))
            pages = frontier(lambda at: has_row(fetcher.fetch(at, 1)), self.page_size, most)
            rc = pages * self.page_size  # of the last page only the start is known
        if rc in (None, ""):
            rc = sum(n for _, n in index) if index is not None else fetcher.count()
        offsets = page_offsets(int(rc), self.page_size, self.size_limit)
        if index is None:  # the count may be stale: the last task reads on until a short page
            last = offsets[-1:] if offsets else [0]
            return [*[Page(o, self.page_size) for o in offsets[:-1]], *[Rest(o) for o in last]]
        # one pass over pages and files together: each page gets only the
        # files it covers, with their start rows
        located, start = [], 0
        for name, n in index:
            located.append((name, n, start))
            start += n
        pages, first = [], 0
        for o in offsets:
            while first < len(located) and located[first][2] + located[first][1] <= o:
                first += 1
            hint, j = [], first
            while j < len(located) and located[j][2] < o + self.page_size:
                hint.append(located[j])
                j += 1
            pages.append(Page(o, self.page_size, hint))
        return pages

    def read(self, partition):
        if partition is None:  # no pages were planned (an empty dataset)
            return
        fetcher = load_fetcher(self.spec, self.args)
        more = {"columns": self.columns} if getattr(fetcher, "prunes", False) else {}
        if isinstance(partition, Rest):
            offset = partition.offset
            # a size limit allows one page more than it fills, as page_offsets does
            last = None if self.size_limit is None else page_offsets(2**62, self.page_size, self.size_limit)[-1]
            while last is None or offset <= last:
                table = self._table(fetcher.fetch(offset, self.page_size, **more), offset)
                if table is not None:
                    yield from table.to_batches()
                if table is None or table.num_rows < self.page_size:
                    return
                offset += self.page_size
            return
        if partition.hint is not None:
            more["hint"] = partition.hint
        table = self._table(fetcher.fetch(partition.offset, partition.limit, **more), partition.offset)
        if table is not None:
            yield from table.to_batches()

    def _table(self, page, offset):
        """A page as a table of the declared columns, or None if it is empty."""
        import pyarrow as pa

        if isinstance(page, list):
            if len(page) <= 1:
                return None
            header = [clean_header(h) for h in page[0]]
            cols = list(zip(*page[1:]))
            table = pa.table({h: pa.array([None if v is None else str(v) for v in col], pa.string())
                              for h, col in zip(header, cols)})
        else:
            table = page.rename_columns([clean_header(h) for h in page.column_names])
        missing = [c for c in self.columns if c not in table.column_names]
        if missing:
            raise KeyError(f"page at offset {offset} lacks columns {missing}")
        return pa.table([table.column(c).cast(pa.string()) for c in self.columns], names=self.columns)


class SortedParquetFetcher:
    """Offset/limit pages over a directory of parquet part files written in
    key order (e.g. ``df.orderBy(key).write.parquet(dir)``). Row counts come
    from file footers, so a page reads only the row groups it covers, and of
    those the declared columns."""

    prunes = True

    def __init__(self, path: str, header_case: str = "keep", index_path: str | None = None):
        self.path = path
        self.header_case = header_case
        self.index_path = index_path
        self._index = None

    def _files(self):
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs

        filesystem, root = pafs.FileSystem.from_uri(self.path if "://" in self.path else "file://" + self.path)
        infos = filesystem.get_file_info(pafs.FileSelector(root, recursive=False))
        names = sorted(i.path for i in infos if i.path.endswith(".parquet") and "/part-" in i.path)
        out = []
        for n in names:
            with filesystem.open_input_file(n) as f:
                out.append((n, pq.ParquetFile(f).metadata.num_rows))
        return filesystem, out

    def index(self):
        """(file, rows) in key order; read once by each user. With ``index_path`` (see
        :func:`build_page_index`) it was counted by a Spark job and no footers are read here."""
        if self._index is None and self.index_path:
            import pyarrow.parquet as pq

            t = pq.read_table(_local(self.index_path)).sort_by("file")
            self._index = [(_local(f), int(n)) for f, n in zip(t.column("file").to_pylist(), t.column("rows").to_pylist())]
        elif self._index is None:
            self._index = self._files()[1]
        return self._index

    def count(self) -> int:
        return sum(n for _, n in self.index())

    def fetch(self, offset: int, limit: int, hint=None, columns=None):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs

        filesystem = pafs.FileSystem.from_uri(self.path if "://" in self.path else "file://" + self.path)[0]
        located, start = hint, 0
        if hint is None:
            located = []
            for name, n in self.index():
                located.append((name, n, start))
                start += n
        pieces = []
        for name, n, start in located:
            lo, hi = max(offset - start, 0), min(offset + limit - start, n)
            if lo < hi:
                with filesystem.open_input_file(name) as f:
                    pf = pq.ParquetFile(f)
                    # read only the row groups overlapping [lo, hi)
                    groups, g_start, first = [], 0, None
                    for g in range(pf.num_row_groups):
                        g_n = pf.metadata.row_group(g).num_rows
                        if g_start + g_n > lo and g_start < hi:
                            groups.append(g)
                            first = g_start if first is None else first
                        g_start += g_n
                    wanted = [c for c in pf.schema_arrow.names if columns is None or clean_header(c) in columns]
                    t = pf.read_row_groups(groups, columns=wanted)
                    pieces.append(t.slice(lo - first, hi - lo))
        if not pieces:
            return [[]]
        table = pa.concat_tables(pieces)
        return table.cast(pa.schema([(f.name, pa.string()) for f in table.schema]))


class CountlessFetcher:
    """The same pages from a service that tells no row count."""

    def __init__(self, **args):
        self._pages = SortedParquetFetcher(**args)

    prunes = True

    def fetch(self, offset: int, limit: int, columns=None):
        return self._pages.fetch(offset, limit, columns=columns)


def _local(path: str) -> str:
    """``file:/x`` or ``file:///x`` -> ``/x``; other paths unchanged."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def build_page_index(spark, store: str, index_path: str) -> None:
    """Rows per part file of a store written in key order, counted by a Spark
    job (footer counts, in parallel) and written as a small parquet
    ``(file, rows)`` - one row per file - for ``SortedParquetFetcher(index_path=...)``."""
    from pyspark.sql import functions as F

    files = spark.read.parquet(store).select(F.col("_metadata.file_path").alias("file"))
    files.groupBy("file").agg(F.count(F.lit(1)).alias("rows")).coalesce(1) \
        .write.mode("overwrite").parquet(index_path)


def register(spark) -> None:
    spark.dataSource.register(PagedDataSource)


def read_paged(spark, fetcher: str, columns, page_size: int = PAGE_SIZE, size_limit=None,
               fetcher_args: dict | None = None, row_count: int | None = None):
    """``spark.read.format('paged')`` with the options spelled out."""
    from tablepipe.session import ship_package

    ship_package(spark)
    register(spark)
    r = (spark.read.format("paged").option("fetcher", fetcher)
         .option("fetcher_args", json.dumps(fetcher_args or {}))
         .option("columns", ",".join(columns)).option("page_size", str(page_size)))
    if size_limit is not None:
        if size_limit <= 0:
            raise ValueError("size_limit must be positive (None means no limit)")
        r = r.option("size_limit", str(size_limit))
    if row_count is not None:
        r = r.option("row_count", str(row_count))
    return r.load()
