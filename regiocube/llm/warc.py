"""WARC archives and their capture index, merged from sorted runs.

Writing: one record per page as a line of Spark's text writer whose line end
completes the record, so every file of the folder is a plain WARC/1.1 file. Of
equal payloads of at least ``LEAST_BYTES`` bytes the smallest page_id is kept as
``response``; the others become ``revisit`` records that refer to it and carry
no payload.

Reading: each file is parsed record by record (by Content-Length; payload
digests are verified) into a run of captures sorted by URL key, timestamp
and page. The runs are the external part of a merge sort: their captures are
dealt to ranges of (URL key, timestamp, page, place), and each range merges its pieces
of the runs, which arrive in order, with a loser tree. The ranges in order are the globally ordered
capture history. A URL with very many captures spans several ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiocube.llm.common import map_arrow, parts, scratch_path, stored

LEAST_BYTES = 100
#: Records in one archive file at most, and bytes of their payloads unless it holds one record.
FILE_RECORDS = 1024
FILE_BYTES = 64 << 20
#: Captures in one range of the merge, about.
RANGE_CAPTURES = 100_000
#: Pages carry no time of capture: page n counts as fetched n seconds after this (2024-01-01 UTC).
FIRST_CAPTURE = 1704067200

_CRLF = "\r\n"
_RECORD_ID = "urn:page:"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit(f"<{_RECORD_ID}"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF))


def records(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(record string) per row of ``pages`` (page_id, url, html): a WARC record without its last line end.

    - null or empty html: a response with an empty payload;
    - equal payloads below ``least_bytes``: responses all;
    - rows that repeat the smallest page_id of a payload: responses all;
    - null page_id: never referred to; it revisits the smallest page with its payload, if any;
    - null url: about:blank; white space and control characters in a url: percent-encoded;
    - empty table: no records; other columns of ``pages`` are not looked at.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("n"))
    # Which pages revisit which is decided on narrow rows and stored, so its
    # size is known: the payloads meet it by a broadcast if it is small, and
    # are shuffled by page if it is not. A key of many rows (null page ids with one
    # payload) has one row on the other side, so AQE can split it.
    narrow = rows.select("page_id", "digest", "n").where(F.col("n") >= least_bytes)
    firsts = (narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("many"))
              .where("many > 1 and first is not null").select("digest", "first"))
    again = (narrow.join(firsts, "digest").where(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")))
             .select(F.col("page_id").alias("of_page"), F.col("digest").alias("of"), "first").distinct())
    rows = rows.join(stored(again, "revisits"), (F.col("digest") == F.col("of"))
                     & F.col("page_id").eqNullSafe(F.col("of_page")) & (F.col("n") >= least_bytes), "left")
    revisit = F.col("first").isNotNull()
    at = F.timestamp_seconds(F.lit(FIRST_CAPTURE) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1_000_000_000)))
    date = F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    url = F.regexp_replace(F.coalesce("url", F.lit("about:blank")), r"[\x00-\x20\x7f]", "%20")
    http = F.concat(F.lit("HTTP/1.1 200 OK" + _CRLF), _line("Content-Type", F.lit("text/html; charset=utf-8")),
                    _line("Content-Length", F.col("n").cast("string")), F.lit(_CRLF))
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("n"))
    head = F.concat(
        F.lit("WARC/1.1" + _CRLF),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))), _line("WARC-Date", date), _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(_line("WARC-Profile", F.lit(_REVISIT)), _line("WARC-Refers-To", _record_id(F.col("first")))))
        .otherwise(""),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", length.cast("string")), F.lit(_CRLF))
    return rows.select(F.concat(head, http, F.when(revisit, "").otherwise(F.col("payload")), F.lit(_CRLF)).alias("record"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Write the records of ``pages`` as WARC files under ``path``.

    Pages are written by size class, the longer ones with fewer records to a file, so
    a file stays below FILE_BYTES of payload or holds one record. Equal payloads are
    of one class: what revisits what does not depend on it.
    """
    most = sorted({max(1, FILE_RECORDS >> k) for k in (0, 5, 30)}, reverse=True)
    shelf = F.lit(len(most) - 1)
    for k in range(len(most) - 2, -1, -1):
        shelf = F.when(F.coalesce(F.octet_length(F.col("html").cast("string")), F.lit(0)) <= FILE_BYTES // most[k], k).otherwise(shelf)
    used = sorted(r[0] for r in pages.select(shelf.alias("shelf")).distinct().collect()) or [0]  # three at most
    for k in used:
        (records(pages.where(shelf == k), least_bytes).write.mode("append").option("lineSep", _CRLF)
         .option("maxRecordsPerFile", most[k]).text(path))


def parse(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers by lower-case name, block) of each record of a WARC file."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at:end].decode("utf-8").split("\r\n")[1:]
        headers = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
        block = end + 4
        stop = block + int(headers["content-length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield at, stop + 4 - at, headers, data[block:stop]
        at = stop + 4


def url_key(url: str) -> str:
    """The sort key of a URL: host labels reversed, then path and query; scheme and fragment dropped."""
    try:
        u = urlsplit(url)
        host, port = (u.hostname or ""), u.port
    except ValueError:
        return url
    labels = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "")
    return f"{labels}){u.path or '/'}" + (f"?{u.query}" if u.query else "")


def _page(record_id: str | None) -> int | None:
    tail = (record_id or "").strip("<>").removeprefix(_RECORD_ID)
    return int(tail) if tail and tail != "none" else None


_CAPTURE = ("url_key string, captured string, page_id long, payload_bytes long, payload_digest string, "
            "record_type string, refers_to long, file string, offset long, length long")
_FIELDS = pa.schema([(c.split()[0], pa.int64() if c.split()[1] == "long" else pa.string()) for c in _CAPTURE.split(", ")])


def _capture(file: str, offset: int, length: int, headers: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = headers["warc-payload-digest"].removeprefix("sha256:")
    if headers["warc-type"] == "response":
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"{file}: the payload at byte {offset} does not have its digest")
        size = len(payload)
    else:
        size = next(int(x[16:]) for x in http.decode().split("\r\n") if x.lower().startswith("content-length: "))
    stamp = "".join(c for c in headers["warc-date"] if c.isdigit())
    return (url_key(headers["warc-target-uri"]), stamp, _page(headers["warc-record-id"]), size, digest, headers["warc-type"],
            _page(headers.get("warc-refers-to")), file, offset, length)


def _order(capture: Sequence) -> tuple:
    """URL key, timestamp, page (null first), then the place in the archives."""
    return (capture[0], capture[1], capture[2] is not None, capture[2] or 0, capture[7], capture[8])


def runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of every archive file under ``path``: each file a run, in index order."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column(0), b.column(1)):
                name = file.as_py().rsplit("/", 1)[-1]
                found = sorted((_capture(name, *r) for r in parse(content.as_py())), key=_order)
                for k in range(0, len(found), 10_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*found[k:k + 10_000]), _FIELDS)], schema=_FIELDS)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return map_arrow(files.select("path", "content"), read, _CAPTURE)


class LoserTree:
    """Merge of sorted lists: each inner node holds the loser of its match, so the
    next smallest item costs one match per level on the way from its leaf to the root."""

    def __init__(self, lists: Sequence[Sequence], key) -> None:
        self._lists, self._key = lists, key
        self._at = [0] * len(lists)
        self._heads = [self._head(i) for i in range(len(lists))]
        self._losers = [0] * max(1, len(lists))
        self._winner = self._play(1) if lists else 0

    def _head(self, i: int):
        run = self._lists[i]
        return (0, self._key(run[self._at[i]]), i) if self._at[i] < len(run) else (1, (), i)

    def _play(self, node: int) -> int:
        """The winner below a node; the losers stay on the way. Leaves are the nodes from k on."""
        k = len(self._lists)
        if node >= k:
            return node - k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        if self._heads[b] < self._heads[a]:
            a, b = b, a
        self._losers[node] = b
        return a

    def __iter__(self) -> Iterator:
        k = len(self._lists)
        while k and self._heads[self._winner][0] == 0:
            i = self._winner
            yield self._lists[i][self._at[i]]
            self._at[i] += 1
            self._heads[i] = self._head(i)
            node = (i + k) // 2
            while node >= 1:
                if self._heads[self._losers[node]] < self._heads[i]:
                    i, self._losers[node] = self._losers[node], i
                node //= 2
            self._winner = i


def _pieces(captures: Iterator[tuple]) -> list[list[tuple]]:
    """The captures as sorted lists, without sorting: a run comes in order within a shuffle
    block, its blocks in any order, so where a run steps back a new list begins."""
    open_: dict[str, list[tuple]] = {}
    out: list[list[tuple]] = []
    for capture in captures:
        piece = open_.get(capture[7])
        if piece is None or _order(capture) < _order(piece[-1]):
            piece = open_[capture[7]] = []
            out.append(piece)
        piece.append(capture)
    return out


def merged_index(captures: DataFrame, range_captures: int = RANGE_CAPTURES) -> DataFrame:
    """The captures of sorted runs in global order, with their range and position in it.

    ``captures`` are ``runs``; ranges of (url_key, captured, page_id, file, offset) are disjoint
    and ordered by ``range``, ``position`` orders the captures of one. Captures that agree in URL, time
    and page (null pages of one URL) differ in their place, so they too are dealt to several ranges.
    """
    captures = stored(captures, "runs")
    n = parts(captures.count(), range_captures)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        here = TaskContext.get().partitionId()
        held: list[tuple] = []
        done = 0
        for capture in LoserTree(pieces, _order):
            held.append((*capture, here, done))
            done += 1
            if len(held) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), out)], schema=out)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), out)], schema=out)

    out = pa.schema([*_FIELDS, pa.field("range", pa.int64()), pa.field("position", pa.int64())])
    dealt = captures.repartitionByRange(n, "url_key", "captured", "page_id", "file", "offset")
    return map_arrow(dealt, merge, _CAPTURE + ", range long, position long")


def archive_and_index(pages: DataFrame, path: str | None = None, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write ``pages`` as WARC files (in the shared folder, or under ``path``), read them back, and merge their index."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, least_bytes)
    return merged_index(runs(spark, path))
