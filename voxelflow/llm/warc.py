"""WARC archives of captured pages and a globally ordered capture index.

Writing: one record per page, as text rows that Spark's text writer commits to
the shared folder (the end of a record, CR LF CR LF, is the row separator), so
a lost task rewrites its file.  Of captures with equal payloads the one with
the largest id is the response; the others are revisit records that refer to it
and carry no payload, only its length and digest.  Digests are grouped with
map-side combine, and a payload shared by a third of all pages is looked up
from a broadcast of bounded size (``skew.join_unique``).

Reading: every archive is parsed record by record from its content lengths (a
payload may hold anything, record separators too).  Its index entries, sorted
by URL key and time, form one run.

Index merge: the runs are dealt out by ranges of (URL key, time, id), which
splits a URL with any number of captures, and every range merges its runs with
a loser tree.  Partitions follow each other in key order, so the result is one
ordered capture history per URL across the whole index.

Nulls, blanks: a null html is an empty payload; a null url has no target line
and the empty URL key.  A null id sorts below all ids; it is a revisit of its
group's response, and a response where the group has no id at all.  Repeated
rows of the largest id are all responses.  An empty table gives an empty index;
other columns are ignored.
"""

from __future__ import annotations

import gzip
import heapq
import io
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import join_unique
from ..session import cut_lineage
from . import common

CRLF = "\r\n"
END = CRLF + CRLF
#: First half of a record id; the second half is the page id.
RECORD = "urn:uuid:70616765-6361-4000-"
INDEX = ("url_key string, captured string, page_id bigint, payload_bytes bigint, payload_digest string, "
         "record_type string, refers_to bigint, url string, archive string, position bigint")
FIELDS = [f.split()[0] for f in INDEX.split(", ")]


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a string: 40 bits at a time."""
    h = F.sha1(F.encode(payload, "UTF-8"))
    parts = [F.lpad(F.conv(F.substring(h, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(page_id: Column) -> Column:
    h = F.lower(F.lpad(F.hex(page_id), 16, "0"))
    return F.concat(F.lit("<" + RECORD), F.substring(h, 1, 4), F.lit("-"), F.substring(h, 5, 12), F.lit(">"))


def classified(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``(page_id, url, payload, digest, refers_to)``; refers_to is null for responses."""
    p = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce("html", F.lit("")).alias("payload"))
    p = p.withColumn("digest", base32_sha1(F.col("payload")))
    small = F.octet_length("payload") < least_bytes
    groups = cut_lineage(p.filter(~small).groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
                         .filter("n > 1"))
    p = join_unique(p, groups.select("digest", "last"), "digest", groups.select("digest", "n"))
    revisit = ~small & F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return p.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("last")).alias("refers_to"))


def records(found: DataFrame) -> DataFrame:
    """One WARC record per row as the column ``value``, without the closing line ends."""
    first = F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1 << 28)))
    date = F.date_format(F.to_utc_timestamp(first, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    revisit = F.col("refers_to").isNotNull()
    size = F.octet_length("payload").cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size, F.lit(END))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    target = F.translate(F.col("url"), "\r\n", "")

    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.when(F.col("page_id").isNotNull(), line("WARC-Record-ID", _record_id(F.col("page_id"))))
         .otherwise(line("WARC-Record-ID", F.concat(F.lit("<urn:sha1:"), F.col("digest"), F.lit(">")))),
        F.when(target.isNotNull(), line("WARC-Target-URI", target)).otherwise(""),
        line("WARC-Date", date),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", _record_id(F.col("refers_to"))),
                                 F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}")))
         .otherwise(""),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF))
    return found.select(F.concat(head, block).alias("value"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, records_per_file: int = 2000) -> str:
    """Write the archives (gzip) below ``folder``, a folder that all executors share."""
    (records(classified(pages, least_bytes)).write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(folder))
    return folder


# ------------------------------------------------------------------- reading

def url_key(url: str | None) -> str:
    """Sort-friendly key: reversed host labels, then path and query, in lower case."""
    if not url:
        return ""
    try:
        u = urlsplit(url.strip())
        host = u.hostname or ""
    except ValueError:
        return url.strip().lower()
    labels = host.removeprefix("www.").split(".")
    return (",".join(reversed(labels)) + ")" + (u.path or "/") + ("?" + u.query if u.query else "")).lower()


def _id(value: str | None) -> int | None:
    if not value or RECORD not in value:
        return None
    n = int(value.strip("<>")[len(RECORD):].replace("-", ""), 16)
    return n - (1 << 64) if n >> 63 else n


def parse(stream, name: str):
    """Index entries of the records of one archive."""
    while True:
        at = stream.tell()
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            at = stream.tell()
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: no record at {at}")
        head = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            k, _, v = line.partition(b":")
            head[k.lower()] = v.strip().decode("utf-8")
        block = stream.read(int(head[b"content-length"]))
        http, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        if head[b"warc-type"] == "revisit":
            size = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        url = head.get(b"warc-target-uri")
        yield (url_key(url), head[b"warc-date"], _id(head[b"warc-record-id"]), size,
               head[b"warc-payload-digest"].removeprefix("sha1:"), head[b"warc-type"],
               _id(head.get(b"warc-refers-to")), url, name, at)


def order(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0, row[8], row[9]


def _batch(rows) -> pa.RecordBatch:
    kinds = [pa.int64() if f.split()[1] == "bigint" else pa.string() for f in INDEX.split(", ")]
    cols = list(zip(*rows)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=FIELDS)


def capture_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Index entries of all archives below ``folder``; those of one archive in order."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path", "content")

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                name = b.column(0)[i].as_py().rpartition("/")[2]
                with gzip.GzipFile(fileobj=io.BytesIO(b.column(1)[i].as_buffer())) as raw:
                    yield _batch(sorted(parse(io.BufferedReader(raw, 1 << 20), name), key=order))
    return files.mapInArrow(run, INDEX)


# --------------------------------------------------------------- index merge

class LoserTree:
    """k-way merge of sorted lists: every node holds the loser of its match, one path is replayed per row."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at = runs, [0] * len(runs)
        self.k = 1
        while self.k < len(runs):
            self.k *= 2
        self.node: list = [None] * self.k
        self.win = self._build(1)

    def _head(self, i: int):
        if i < len(self.runs) and self.at[i] < len(self.runs[i]):
            row = self.runs[i][self.at[i]]
            return order(row), i, row
        return None

    @staticmethod
    def _play(x, y):
        if y is None or x is not None and x[:2] < y[:2]:
            return x, y
        return y, x

    def _build(self, i: int):
        if i >= self.k:
            return self._head(i - self.k)
        win, self.node[i] = self._play(self._build(2 * i), self._build(2 * i + 1))
        return win

    def __iter__(self):
        while self.win is not None:
            _, i, row = self.win
            yield row
            self.at[i] += 1
            win, up = self._head(i), (i + self.k) // 2
            while up:
                win, self.node[up] = self._play(win, self.node[up])
                up //= 2
            self.win = win


def merge_index(runs: DataFrame, rows_per_range: int = 200_000) -> DataFrame:
    """The entries of all runs in global order of URL key, time and id, by range partitions."""
    n = int(runs.count() // rows_per_range) + 1
    ranges = runs.repartitionByRange(n, "url_key", "captured", "page_id", "archive", "position")

    def run(batches):
        own: dict[str, list[tuple]] = {}
        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                own.setdefault(row[8], []).append(row)
        # rows of a run arrive in pieces; each piece is in order, so mending a run is a merge as well
        runs = []
        for rows in own.values():
            keys = list(map(order, rows))
            cut = [0, *(i for i in range(1, len(rows)) if keys[i] < keys[i - 1]), len(rows)]
            pieces = [rows[a:b] for a, b in zip(cut, cut[1:])]
            runs.append(pieces[0] if len(pieces) == 1 else list(heapq.merge(*pieces, key=order)))
        rows = []
        for row in LoserTree(runs) if runs else ():
            rows.append(row)
            if len(rows) >= 10_000:
                yield _batch(rows)
                rows = []
        yield _batch(rows)
    return ranges.mapInArrow(run, INDEX)


def archive_and_index(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives below ``folder``, read them back and return the merged index."""
    spark = pages.sparkSession
    write_archives(pages, folder, least_bytes)
    return merge_index(cut_lineage(capture_runs(spark, folder)))
