"""WARC archives: writing, reading, and a globally ordered capture index.

Method of the index: external merge. Each archive gives one run of index rows,
sorted by URL key and timestamp. The runs are cut at common key ranges, and in
each range the pieces of all runs are merged k ways with a loser tree, so the
partitions of the result, one after the other, hold all captures in order.

Records are written by Spark's text sink with the record separator of WARC as
line separator: payloads are UTF-8 text, so an archive is a valid text file.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read_table, scratch_path, written

_CRLF = "\r\n"
#: Bytes of the records in an archive before compression, on average.
ARCHIVE_BYTES = 128 << 20
#: Pages have no capture time: their id, modulo this, is the number of seconds after ``epoch``.
SECONDS = 1 << 30
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_INDEX = "url_key string, timestamp string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long, length long"
INDEX_COLUMNS = [c.split()[0] for c in _INDEX.split(", ")]


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a text's UTF-8 bytes, in built-in functions."""
    hex_ = F.sha1(payload.cast("binary"))
    part = lambda i: F.conv(F.substring(hex_, 5 * i + 1, 5), 16, 10).cast("int")
    letter = lambda v, shift: F.substring(F.lit(_LETTERS), F.shiftright(v, shift).bitwiseAND(31) + 1, F.lit(1))
    return F.concat(*(letter(part(i), shift) for i in range(8) for shift in (15, 10, 5, 0)))


def with_revisits(pages: DataFrame, key: str, url: str, page: str, least: int) -> DataFrame:
    """(page_id, url, payload, digest, first): ``first`` is the page that an equal payload refers to."""
    payload = F.coalesce(F.col(page), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"), base32_sha1(payload).alias("digest"))
    # copies meet by digest in partial sums first; the join's large partitions can be split, since one side has a row per digest
    first = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("page_id").alias("first"))
    return rows.join(first, "digest", "left")


def _uri(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def record(rows: DataFrame, epoch: int) -> Column:
    """The text of a WARC record without its closing separator."""
    date = F.date_format(F.timestamp_seconds(F.lit(epoch) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(SECONDS))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    size = F.octet_length("payload").cast("string")
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "), size, F.lit(_CRLF * 2))
    body = F.when(again, head).otherwise(F.concat(head, "payload"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF))
    return F.concat(
        F.lit(f"WARC/1.1{_CRLF}"),
        line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _uri(F.col("page_id"))),
        line("WARC-Date", date),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(again, F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", _uri(F.col("first"))))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(body).cast("string")),
        F.lit(_CRLF),
        body,
    )


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", page: str = "html", least: int = 0, records: int = 20_000, epoch: int = 1_704_067_200) -> None:
    """Writes gzipped archives with a record for each row of ``pages``.

    Of equal payloads of at least ``least`` bytes the one with the least id is
    a response and the others revisit it. An archive has at most ``records``
    records, fewer where payloads are long (``ARCHIVE_BYTES``).
    """
    held = pages.agg(F.sum(F.octet_length(F.col(page))).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    records = max(1, min(records, ARCHIVE_BYTES * held.n // (held.bytes or 1))) if held.n else records
    rows = with_revisits(pages, key, url, page, least)
    rows.select(record(rows, epoch).alias("value")).write.options(lineSep=_CRLF * 2, compression="gzip", maxRecordsPerFile=records).text(path)


def url_key(url: str) -> str:
    """The URL with its host turned round, for sorting: ``com,example)/path?query``."""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").removeprefix("www.")
        port = f":{parts.port}" if parts.port and parts.port not in (80, 443) else ""
    except ValueError:
        return url.lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port}){(parts.path or '/').lower()}{query.lower()}"


def read_records(stream):
    """(headers, block, offset, length) of each record of an open archive."""
    offset = 0
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            offset += len(line)
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {offset}")
        headers, begin = {}, offset
        offset += len(line)
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
            offset += len(line)
        offset += len(line)
        block = stream.read(int(headers["content-length"]))
        offset += len(block)
        yield headers, block, begin, offset - begin


def _page(uri: str | None) -> int | None:
    digits = (uri or "").strip("<>").removeprefix("urn:x-page:")
    return int(digits) if digits else None


def index_row(headers: dict, block: bytes, archive: str, offset: int, length: int) -> tuple:
    """The index row of a record; a response's payload is measured, and must have the digest it says."""
    head, _, payload = block.partition(b"\r\n\r\n")
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    if headers["warc-type"] == "response":
        size = len(payload)
        if (found := base64.b32encode(hashlib.sha1(payload).digest()).decode()) != digest:
            raise ValueError(f"{archive}, {offset}: digest {found}, not {digest}")
    else:
        size = int(next(x.partition(b":")[2] for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")))
    stamp = "".join(c for c in headers["warc-date"] if c.isdigit())
    url = headers["warc-target-uri"]
    return url_key(url), stamp, _page(headers["warc-record-id"]), url, size, digest, headers["warc-type"], _page(headers.get("warc-refers-to")), archive, offset, length


def _order(row: tuple) -> tuple:
    """URL key, timestamp, page (null first), place."""
    return row[0], row[1], row[2] is not None, row[2] or 0, row[8], row[9]


_FIELDS = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]


def _to_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _FIELDS, strict=True)], names=INDEX_COLUMNS)


def _index(rows):
    """A sorted run for each archive."""
    for batch in rows:
        for path, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
            raw = io.BytesIO(content.as_buffer())
            name = path.rsplit("/", 1)[-1]
            stream = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) if name.endswith(".gz") else raw
            run = sorted((index_row(h, b, name, at, n) for h, b, at, n in read_records(stream)), key=_order)
            if run:
                yield _to_batch(run)


class LoserTree:
    """k-way merge of sorted runs: each step replays one path of the tree."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs = [iter(r) for r in runs]
        self.k = max(1, len(runs))
        self.heads = [self._next(i) for i in range(len(runs))] or [None]
        self.losers = [-1] * self.k
        self.winner = -1
        for i in range(self.k):
            self._play(i)

    def _next(self, i: int):
        row = next(self.runs[i], None)
        return None if row is None else (_order(row), row)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x[0], a) < (y[0], b))

    def _play(self, i: int) -> None:
        node = (i + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = i
                return
            if self._beats(other, i):
                self.losers[node], i = i, other
            node //= 2
        self.winner = i

    def __iter__(self):
        while (head := self.heads[self.winner]) is not None:
            yield head[1]
            self.heads[self.winner] = self._next(self.winner)
            self._play(self.winner)


def _merge(rows):
    """Merges the runs of one key range; rows come in the order of their run."""
    runs: list[list[tuple]] = []
    last = None
    for batch in rows:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[8] != last:
                runs.append([])
                last = row[8]
            runs[-1].append(row)
    out = []
    for row in LoserTree(runs):
        out.append(row)
        if len(out) == 5000:
            yield _to_batch(out)
            out = []
    if out:
        yield _to_batch(out)


def capture_index(spark, path: str) -> DataFrame:
    """The captures of all archives below ``path``, globally ordered by URL key and timestamp.

    A range of keys is one task's; timestamps and pages are part of the range
    bounds, so a URL with many captures is cut into several ranges.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    runs = written(files.mapInArrow(_index, _INDEX), "captures")
    order = ["url_key", "timestamp", "page_id", "archive", "offset"]
    return runs.repartitionByRange(*order).sortWithinPartitions("archive", *order[:3], "offset").mapInArrow(_merge, _INDEX)


def archived(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", least: int = 0) -> DataFrame:
    """Writes ``pages`` to archives in the shared folder and returns their capture index.

    A row for each row of ``pages``: see ``INDEX_COLUMNS``; offsets and lengths
    are places in the archive's uncompressed stream. A null page is an
    empty payload; a null url is written empty; a page without an id (null)
    refers to the least id that has its payload, if any; rows that repeat the
    least id are responses as well; an empty table gives no rows. Other columns
    of ``pages`` are ignored, whatever their names.
    """
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, key, url, page, least)
    return capture_index(pages.sparkSession, path)


def op8_warc(spark, sf_dir: str) -> DataFrame:
    """Records of ``pages`` as read back from the archives."""
    out = archived(read_table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
s AS (SELECT page_id, strlen(h) AS n, sha1(h) AS x FROM p),
b AS (SELECT *, list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(x, CAST(5 * (i // 4) + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT) + 1, 1)) AS c FROM s),
f AS (SELECT x, min(page_id) AS first FROM s GROUP BY x)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, array_to_string(c, '') AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM b JOIN f USING (x)
"""
