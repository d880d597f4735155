"""WARC archives of pages and their capture index by external merge.

``write_archives`` turns each page into a WARC record: the first page with a
payload (smallest id) is a ``response`` with the payload as HTTP body, later
ones are ``revisit`` records that refer to it and keep the HTTP header only. The
records are written by Spark's text writer, gzip-compressed, with the blank
lines that end a record as its line separator, so every file is a valid archive
and a retried task leaves no part of one.

``read_archives`` parses archives by their Content-Length fields. Each file gives
a run of index lines sorted by URL key, timestamp and page id, and the runs are
written out. ``merge_runs`` deals them by ranges of the sort key, and each range
merges its pieces of the runs with a loser tree. Ranges are in order, so (range,
place) orders all captures and every URL's captures stand together by time.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepipe.llm._text import map_arrow
from tablepipe.session import scratch_path

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
EPOCH = "2024-01-01 00:00:00"  # capture time of id 0 where pages have no time
END = "\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_PER_FILE = 20_000
RANGE_ROWS = 100_000
INDEX = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
         "urlkey string, captured string, run string, run_place int")


def sha1_base32(text: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a string's UTF-8 bytes."""
    digest = F.sha1(text.cast("binary"))

    def letter(i):  # five hexadecimal digits make four letters
        value = F.conv(F.substring(digest, F.floor(i / 4).cast("int") * 5 + 1, F.lit(5)), 16, 10).cast("int")
        five = F.expr("cast(1 as int)") * value
        shift = F.lit(15) - (i % 4) * 5
        return F.substring(F.lit(BASE32), F.floor(five / F.pow(F.lit(2.0), shift)).cast("int").bitwiseAND(31) + 1, F.lit(1))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), letter), "")


def records(pages, id_col="page_id", payload_col="html", url_col="url", time_col=None) -> DataFrame:
    """One WARC record a page (without its closing blank lines), as ``record`` strings."""
    time = F.col(time_col) if time_col else F.timestamp_seconds(
        F.unix_timestamp(F.lit(EPOCH)) + F.coalesce(F.col(id_col).cast("long"), F.lit(0)))
    p = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"),
                     F.regexp_replace(F.coalesce(F.col(url_col), F.lit("")), r"[\x00-\x20\x7F]", "%20").alias("url"),
                     F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"))
    p = p.withColumn("digest", sha1_base32(F.col("payload")))
    first = (pages.select(F.col(id_col).cast("long").alias("id"),
                          sha1_base32(F.coalesce(F.col(payload_col), F.lit(""))).alias("digest"))
             .groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"))
    p = p.join(first, "digest", "left")
    # an id of null follows every other; equal smallest ids are all responses
    again = F.col("first").isNotNull() & F.coalesce(F.col("id") != F.col("first"), F.lit(True))
    ident = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    size = F.octet_length("payload")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(END))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    return p.select(F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), ident, F.lit(">"))),
        F.when(again, F.concat(line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first"), F.lit(">"))),
                               line("WARC-Profile", F.lit(REVISIT)))).otherwise(""),
        line("WARC-Target-URI", F.col("url")), line("WARC-Date", F.coalesce("time", F.lit(""))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        line("Content-Length", (F.octet_length(http) + F.when(again, 0).otherwise(size)).cast("string")), F.lit("\r\n"),
        http, F.when(again, "").otherwise(F.col("payload"))).alias("record"))


def write_archives(pages, path, **columns):
    """Write one record per row of ``pages`` below ``path`` (``part-*.txt.gz``).

    A null payload is an empty one; equal payloads, empty ones too, are one
    response and revisits; a null URL is empty; a null id is written as
    ``null`` and revisits any other page of its payload. Extra columns are not
    read; an empty table writes no record.
    """
    (records(pages, **columns).write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


class _Stream:
    """Bytes of an archive, unzipped as they are asked for."""

    def __init__(self, content):
        self.rest, self.buf = memoryview(content), bytearray()
        self.zip = zlib.decompressobj(31) if bytes(content[:2]) == b"\x1f\x8b" else None

    def _more(self):
        if not self.rest:
            return False
        if self.zip is None:
            self.buf += self.rest
            self.rest = memoryview(b"")
            return True
        self.buf += self.zip.decompress(self.rest[:1 << 16])
        tail = self.zip.unused_data
        self.rest = self.rest[1 << 16:]
        if self.zip.eof:  # the next member
            self.rest = memoryview(tail + bytes(self.rest))
            self.zip = zlib.decompressobj(31)
        return True

    def until(self, mark):
        """Bytes before and with ``mark``; None at the end."""
        start = 0
        while (at := self.buf.find(mark, start)) < 0:
            start = max(0, len(self.buf) - len(mark))
            if not self._more():
                return None
        return self.take(at + len(mark))

    def take(self, n):
        while len(self.buf) < n:
            if not self._more():
                raise ValueError("an archive ends inside a record")
        out = bytes(self.buf[:n])
        del self.buf[:n]
        return out


def parse(content):
    """(header fields in lower case, block bytes) of each record of an archive, gzipped or not."""
    stream = _Stream(content)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record: {lines[0][:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}
        block = stream.take(int(fields["content-length"]))
        stream.take(4)
        yield fields, block


def url_key(url):
    """Sort key of a URL: host labels from the right, then the path; scheme, ``www.`` and fragment go."""
    rest = re.sub(r"^[a-z][a-z0-9+.-]*://", "", url.strip().lower()).partition("#")[0]
    host, slash, path = rest.partition("/")
    host, _, port = host.partition(":")
    host = re.sub(r"^www\d*\.", "", host)
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + slash + path


def _page(urn):
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(m[1]) if m else None


def index_lines(content, run):
    """The sorted run of one archive: index tuples in the order of ``INDEX``.

    A response's size and digest are taken from its payload, and a digest that
    differs from the header's is an error; a revisit's from its headers."""
    out = []
    for fields, block in parse(content):
        if fields.get("warc-type") not in ("response", "revisit"):
            continue
        http, _, payload = block.partition(b"\r\n\r\n")
        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        if fields["warc-type"] == "response":
            size, own = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if digest and digest != own:
                raise ValueError(f"payload of {fields.get('warc-record-id')} has digest {own}, not {digest}")
            digest = own
        else:
            size = int(re.search(rb"(?i)^content-length:\s*(\d+)", http, re.M)[1])
        out.append((_page(fields.get("warc-record-id")), size, digest, fields["warc-type"],
                    _page(fields.get("warc-refers-to")), url_key(fields.get("warc-target-uri", "")),
                    re.sub(r"\D", "", fields.get("warc-date", "")), run))
    out.sort(key=_order)
    return [(*x, i) for i, x in enumerate(out)]


def _order(line):
    page = line[0]
    return line[5], line[6], page is None, page or 0


def _batches(lines, names, size=4096):
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32()]
    for i in range(0, len(lines), size):
        part = list(zip(*lines[i:i + size]))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, types)], names)


_NAMES = [x.split()[0] for x in INDEX.split(", ")]


def read_archives(spark, path) -> DataFrame:
    """Index lines of all archives below ``path``, one sorted run per file."""
    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                lines = index_lines(content.as_buffer(), name.rsplit("/", 1)[-1])
                yield from _batches(lines, _NAMES)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return map_arrow(files, run, INDEX)


class LoserTree:
    """k-way merge of sorted lists: inner nodes hold the loser of their match, the winner is taken out."""

    def __init__(self, runs, key):
        self.runs, self.key, self.k = [iter(r) for r in runs], key, len(runs)
        self.heads = [None] * self.k
        for i in range(self.k):
            self._advance(i)
        self.losers = [-1] * max(1, self.k)
        for i in range(self.k):
            self._play(i)

    def _advance(self, i):
        line = next(self.runs[i], None)
        self.heads[i] = None if line is None else ((*self.key(line), i), line)

    def _beats(self, a, b):
        """Whether run ``a`` comes before run ``b``; an empty place (-1) beats all while the tree is built."""
        if a < 0 or b < 0:
            return a < 0
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x[0] < y[0])

    def _play(self, i):
        node = (i + self.k) // 2
        while node > 0:
            if self._beats(self.losers[node], i):
                self.losers[node], i = i, self.losers[node]
            node //= 2
        self.losers[0] = i

    def __iter__(self):
        while self.k and (best := self.heads[winner := self.losers[0]]) is not None:
            yield best[1]
            self._advance(winner)
            self._play(winner)


def merge_runs(runs) -> DataFrame:
    """All index lines in global order of (urlkey, captured, page_id): columns of
    the runs with ``range_no`` and ``place``. Ranges hold about ``RANGE_ROWS``
    lines; the full key and the run bound them, so a URL with many captures
    spans several."""
    spark = runs.sparkSession
    n = max(1, -(-runs.count() // RANGE_ROWS))
    key = ["urlkey", "captured", F.col("page_id").asc_nulls_last(), "run", "run_place"]
    dealt = runs.repartitionByRange(n, *key).sortWithinPartitions("run", "run_place").withColumn(
        "range_no", F.spark_partition_id())

    def merge(batches):
        pieces: dict = {}
        number = 0
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for line in zip(*columns):
                pieces.setdefault(line[7], []).append(line)
                number = line[9]
        place, out = 0, []
        names = [*_NAMES, "range_no", "place"]
        for line in LoserTree(list(pieces.values()), _order):
            out.append(line[:9])
            if len(out) == 4096:
                yield _numbered(out, number, place, names)
                place, out = place + len(out), []
        if out:
            yield _numbered(out, number, place, names)

    return map_arrow(dealt, merge, INDEX + ", range_no int, place int")


def _numbered(lines, number, place, names):
    batch = next(_batches(lines, _NAMES, len(lines)))
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array([number] * len(lines), pa.int32()),
                                       pa.array(range(place, place + len(lines)), pa.int32())], names)


def round_trip(pages, path=None, **columns):
    """Write ``pages`` to archives, read them back and merge their capture index."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, **columns)
    runs = scratch_path(spark, "runs")
    read_archives(spark, path).write.parquet(runs)
    return merge_runs(spark.read.parquet(runs))
