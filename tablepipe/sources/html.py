"""HTML extraction.

Built on the standard ``html.parser``; each page is parsed by the task that holds
its row, so pages are spread over the cluster. :func:`html_rows` and
:func:`html_options` map Arrow batches, so that many small pages share a batch on
the way in and out; SQL has the same as two Python UDTFs, called once a page. Flat ``tag attr="..."`` lists without an element scope use a
JVM regular expression instead and never leave the JVM.

* ``html_rows(html, element_id, row_tag, cell_tags)`` -> ``(pos, cells, header, error)``:
  rows of the first element with that id (a table: ``tr`` rows of ``td``/``th``
  cells; a list: ``li`` rows whose text is the one cell). ``header`` repeats
  the first row's cells on every row, so naming the cells needs no join.
* ``html_options(html, element_id, tag, attr)`` -> ``(pos, value)``: attribute
  values of ``tag`` elements under the element with that id.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf

from tablepipe.session import ship_package

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
         "param", "source", "track", "wbr"}


# An element of the key is closed by the start of one of its values
# (end tags that HTML lets authors leave out), up to the nearest boundary.
_CLOSED_BY = {"td": {"td", "th", "tr", "tbody", "thead", "tfoot"}, "th": {"td", "th", "tr", "tbody", "thead", "tfoot"},
              "tr": {"tr", "tbody", "thead", "tfoot"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"},
              "li": {"li"}, "option": {"option", "optgroup"}, "optgroup": {"optgroup"},
              "p": {"p", "div", "table", "ul", "ol", "form", "h1", "h2", "h3", "h4", "pre"}}
_BOUNDARY = {"td": "table", "th": "table", "tr": "table", "thead": "table", "tbody": "table", "li": ("ul", "ol"),
             "option": "select", "optgroup": "select", "p": ("td", "th", "li")}


# start tag -> the open elements that it closes
_CLOSES: dict = {}
for _own, _tags in _CLOSED_BY.items():
    for _tag in _tags:
        _CLOSES.setdefault(_tag, []).append(_own)


class _Whole(Exception):
    """The element is complete; what follows it is not parsed."""


class _Scoped(HTMLParser):
    """Keeps the stack of open elements and knows whether the parser is inside the
    first element with ``element_id`` (the whole document when the id is None)."""

    def __init__(self, element_id):
        super().__init__(convert_charrefs=True)
        self.element_id, self.stack, self.open = element_id, [], {}
        self.scope = 0 if element_id is None else None  # stack height inside the element
        self.found, self.done = element_id is None, False

    @property
    def inside(self):
        return self.scope is not None and not self.done

    def opened(self, tag, attrs):
        """An element inside the scope starts (already on the stack)."""

    def closed(self, tag):
        """An element inside the scope ends (already off the stack)."""

    def _pop(self):
        tag = self.stack.pop()
        self.open[tag] -= 1
        if self.inside:
            if self.element_id is not None and len(self.stack) < self.scope:
                self.done = True
            self.closed(tag)

    def _imply_ends(self, tag):
        """Close the elements that the start of ``tag`` ends."""
        while any(self.open.get(own) for own in _CLOSES.get(tag, ())):
            for depth in range(len(self.stack) - 1, -1, -1):
                own = self.stack[depth]
                if tag in _CLOSED_BY.get(own, ()):
                    while len(self.stack) > depth:
                        self._pop()
                    break
                if own in ("table", "select", "ul", "ol"):
                    return
            else:
                return

    def handle_starttag(self, tag, attrs):
        self._imply_ends(tag)
        enters = bool(attrs) and self.scope is None and dict(attrs).get("id") == self.element_id
        if tag in _VOID:
            if enters:
                self.found, self.scope, self.done = True, 0, True
            elif self.inside:
                self.opened(tag, attrs)
            return
        self.stack.append(tag)
        self.open[tag] = self.open.get(tag, 0) + 1
        if enters:
            self.found, self.scope = True, len(self.stack)
        elif self.inside:
            self.opened(tag, attrs)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self.open.get(tag):
            return
        if self.stack[-1] == tag:
            self._pop()
            if self.done:
                raise _Whole
            return
        depth = len(self.stack) - 1 - self.stack[::-1].index(tag)
        stop = _BOUNDARY.get(tag, ())
        if any(t in stop if isinstance(stop, tuple) else t == stop for t in self.stack[depth + 1:]):
            return  # an end tag does not reach out of a nested table or list
        while len(self.stack) > depth:
            self._pop()
        if self.done:
            raise _Whole

    def close(self):
        super().close()
        while self.stack:
            self._pop()


class RowParser(_Scoped):
    """Rows of the first table (or list) in the scope; nested tables are text of their
    cell, a cell spanning columns is repeated for each."""

    def __init__(self, element_id, row_tag="tr", cell_tags=("td", "th")):
        super().__init__(element_id)
        self.row_tag, self.cell_tags = row_tag, tuple(cell_tags)
        self.rows, self.row, self.row_text, self.row_depth = [], None, None, None
        self.cell, self.cell_depth, self.span = None, None, 1

    def opened(self, tag, attrs):
        if tag == self.row_tag and self.row is None:
            self.row, self.row_text, self.row_depth = [], [], len(self.stack)
        elif self.row is not None and self.cell is None and tag in self.cell_tags:
            self.cell, self.cell_depth = [], len(self.stack)
            span = dict(attrs).get("colspan") or "1"
            self.span = min(1000, max(1, int(span))) if span.isdigit() else 1

    def closed(self, tag):
        height = len(self.stack) + 1
        if self.cell is not None and height == self.cell_depth:
            self.row += [" ".join("".join(self.cell).split())] * self.span
            self.cell = None
        elif self.row is not None and height == self.row_depth:
            self.rows.append(self.row or ["".join(self.row_text).strip()])
            self.row, self.row_text = None, None

    def handle_data(self, data):
        if not self.inside:
            return
        if self.cell is not None:
            self.cell.append(data)
        if self.row_text is not None:
            self.row_text.append(data)


class OptionParser(_Scoped):
    def __init__(self, element_id, tag="option", attr="value"):
        super().__init__(element_id)
        self.tag, self.attr, self.values = tag, attr, []

    def opened(self, tag, attrs):
        if tag == self.tag:
            self.values.append(dict(attrs).get(self.attr))


# Tags without anything that needs more than a pattern; a page with other markup goes to ``HTMLParser.feed``.
_SPACE = "[ \\t\\n\\r\\f]"
_VALUE = "\"[^\"<>&]*\"|[^ \\t\\n\\r\\f\\x0b\"'<>=`&/]+"
_PLAIN_TAG = re.compile(f"<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:{_SPACE}+[a-zA-Z][a-zA-Z0-9-]*(?:=(?:{_VALUE}))?)*){_SPACE}*>")
_PLAIN_ATTR = re.compile(f"([a-zA-Z][a-zA-Z0-9-]*)(?:=({_VALUE}))?")
_OTHER = re.compile("[&\\0]|/>|<[!?]|</?(?:script|style|textarea|title|iframe|xmp|no[a-z]+|plaintext)", re.IGNORECASE)


def _plain(html):
    """[text, slash, tag, attributes, text, ...] of a page of plain tags, None for any other."""
    if _OTHER.search(html):
        return None
    parts = _PLAIN_TAG.split(html)
    if any("<" in text for text in parts[::4]) or any(s and a for s, a in zip(parts[1::4], parts[3::4])):
        return None
    return parts


def _feed(parser, html):
    parts = _plain(html)
    if parts is None:
        parser.feed(html)
        parser.close()
        return
    if parts[0]:
        parser.handle_data(parts[0])
    for slash, tag, attrs, text in zip(parts[1::4], parts[2::4], parts[3::4], parts[4::4]):
        if slash:
            parser.handle_endtag(tag.lower())
        else:
            found = [(k.lower(), (v[1:-1] if v[0] == '"' else v) if v else None) for k, v in _PLAIN_ATTR.findall(attrs)] if attrs else []
            parser.handle_starttag(tag.lower(), found)
        if text:
            parser.handle_data(text)
    parser.close()


def _parse(parser, html):
    try:
        _feed(parser, html or "")
    except _Whole:
        pass
    if not parser.found:
        raise ValueError(f"no element with id {parser.element_id!r}")


def parse_rows(html, element_id=None, row_tag="tr", cell_tags=("td", "th")):
    """Python form of ``html_rows`` (used by the UDTF and by tests)."""
    p = RowParser(element_id, row_tag, cell_tags)
    _parse(p, html)
    return p.rows


def parse_options(html, element_id=None, tag="option", attr="value"):
    p = OptionParser(element_id, tag, attr)
    _parse(p, html)
    return p.values


_ROWS = "pos int, cells array<string>, header array<string>, error string"
_ROW_TYPES = [pa.int32(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()]
_OPTIONS = "pos int, value string, error string"
_OPTION_TYPES = [pa.int32(), pa.string(), pa.string()]


def page_rows(html, element_id=None, row_tag="tr", cell_tags="td,th"):
    """(pos, cells, header, error) of a page; a failed page is reported, not dropped."""
    tags = tuple(t for t in (cell_tags or "").split(",") if t)
    try:
        rows = parse_rows(html, element_id, row_tag or "tr", tags)
    except Exception as e:
        return [(None, None, None, f"{type(e).__name__}: {e}")]
    return [(i, r, rows[0], None) for i, r in enumerate(rows)]


def page_options(html, element_id=None, tag="option", attr="value"):
    """(pos, value, error) of a page."""
    try:
        values = parse_options(html, element_id, tag or "option", attr or "value")
    except Exception as e:
        return [(None, None, f"{type(e).__name__}: {e}")]
    return [(i, v, None) for i, v in enumerate(values)]


@udtf(returnType=_ROWS, useArrow=True)
class HtmlRows:
    def eval(self, html, element_id=None, row_tag="tr", cell_tags="td,th"):
        yield from page_rows(html, element_id, row_tag, cell_tags)


@udtf(returnType=_OPTIONS, useArrow=True)
class HtmlOptions:
    def eval(self, html, element_id=None, tag="option", attr="value"):
        yield from page_options(html, element_id, tag, attr)


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Parsing is CPU-bound Python: a few small files that arrive in fewer
    partitions than the cluster has cores can be dealt to ``partitions``
    round-robin; None keeps the input's layout."""
    return df.repartition(partitions) if partitions else df


# Rows of a batch that goes out.
_BATCH_ROWS = 5000


def _mapped(df: DataFrame, html_col, keep, partitions, page, args, made: str, types) -> DataFrame:
    """The kept columns of ``df`` x the rows that ``page`` makes of each page."""
    ship_package(df.sparkSession)
    df = spread(df.select(*keep, F.col(html_col).alias("__html")), partitions)
    kept = len(df.columns) - 1
    schema = T.StructType([*df.schema.fields[:kept], *T.StructType.fromDDL(made).fields])

    def run(batches):
        for batch in batches:
            rows, own = [], []
            for i, html in enumerate(batch.column(kept)):
                for row in page(html.as_py(), *args):
                    own.append(i)
                    rows.append(row)
                    if len(rows) >= _BATCH_ROWS:
                        yield _out(batch, rows, own)
                        rows, own = [], []
            if rows:
                yield _out(batch, rows, own)

    def _out(batch, rows, own):
        at = pa.array(own, pa.int32())
        columns = [batch.column(k).take(at) for k in range(kept)]
        columns += [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays(columns, schema.names)

    return df.mapInArrow(run, schema)


def html_rows(df: DataFrame, html_col: str, element_id=None, row_tag: str = "tr",
              cell_tags: str = "td,th", keep=(), partitions: int | None = None) -> DataFrame:
    """The kept columns of ``df`` x ``(pos, cells, header, error)``."""
    return _mapped(df, html_col, keep, partitions, page_rows, (element_id, row_tag, cell_tags), _ROWS, _ROW_TYPES)


def html_options(df: DataFrame, html_col: str, element_id=None, tag: str = "option",
                 attr: str = "value", keep=(), partitions: int | None = None) -> DataFrame:
    """The kept columns of ``df`` x ``(pos, value, error)``."""
    return _mapped(df, html_col, keep, partitions, page_options, (element_id, tag, attr), _OPTIONS, _OPTION_TYPES)


def attr_values(col, tag: str = "a", attr: str = "href") -> Column:
    """Every ``attr`` value of ``tag`` elements, in document order, by a JVM
    regular expression (double-quoted attributes)."""
    c = col if isinstance(col, Column) else F.col(col)
    return F.regexp_extract_all(c, F.lit(f'<{tag}\\b[^>]*?\\b{attr}="([^"]*)"'), F.lit(1))


def read_html_files(spark, path: str, name_pattern: str | None = None, keys=()) -> DataFrame:
    """Saved pages as rows ``(path, html, *keys)``: one row per file, read
    whole (``wholetext``), files spread over tasks. ``name_pattern`` is a
    regular expression over the file name whose groups become ``keys``
    (e.g. ``r"(\\d{4})-(\\d+)-(\\w+)\\.html"`` -> year, month, line)."""
    df = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))
    if name_pattern:
        name = F.regexp_extract(F.col("path"), r"([^/]+)$", 1)
        df = df.withColumns({k: F.regexp_extract(name, name_pattern, i + 1) for i, k in enumerate(keys)})
    return df


def register(spark) -> None:
    """Make the UDTFs callable from SQL:
    ``SELECT p.page_id, r.* FROM pages p, LATERAL html_rows(p.html, 'id') r``."""
    ship_package(spark)
    spark.udtf.register("html_rows", HtmlRows)
    spark.udtf.register("html_options", HtmlOptions)
