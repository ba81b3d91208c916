"""Web archives: WARC records out and back, and an index merged from sorted runs.

Records are written as text with Spark's writer, so archives land on any file
system that Spark reaches. Each archive, read back by its lengths, gives one run
of captures sorted by URL key and time; the runs are cut at common bounds, and a
loser tree merges the pieces of a range into the global order.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, functions as F

from ..session import fresh_path, stage
from .common import map_rows, small_batches, text_of

#: Payloads below this are never replaced by a revisit record.
LEAST_REVISIT = 1000
#: Bytes of pages that an archive is meant to hold; one page may exceed it.
ARCHIVE_BYTES = 8 * 1024 * 1024
#: Bytes that a record is taken to have beside its page.
RECORD_BYTES = 600
#: Hash buckets that tell payloads without copies; at most so many rows are broadcast.
COPY_BUCKETS = 1 << 18
#: Captures that one range of the merged index is meant to hold.
RANGE_ROWS = 50_000
#: Capture time of a page without a date: its page_id in seconds after 2020-01-01.
FIRST_SECOND = 1_577_836_800
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n\r\n"


def decide(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``pages`` (page_id, url, html, date if there) with date, payload, digest and refers_to.

    Of rows with equal payloads of at least ``least`` bytes the one of largest
    page_id is kept whole; the others refer to it. Rows repeating that page_id
    are kept whole as well; rows without an id refer to it like the others.
    """
    second = F.timestamp_seconds(F.lit(FIRST_SECOND) + F.coalesce(F.col("page_id").cast("long"), F.lit(0)))
    given = [F.col("date").try_cast("timestamp")] if "date" in pages.columns else []
    rows = pages.select(
        F.col("page_id").cast("long"), "url", F.coalesce(*given, second).alias("date"), text_of("html").alias("payload")
    ).withColumn("digest", F.sha1(F.encode("payload", "UTF-8")))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long"))
    copies = (
        rows.filter(F.col("bytes") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("kept"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", "kept")
    )
    copies = stage(copies, "copied-payloads")
    # a payload whose bucket no copied one shares needs no join, so it isn't shuffled for one
    bucket = F.pmod(F.xxhash64("digest"), F.lit(COPY_BUCKETS)).cast("int")
    buckets = F.broadcast(copies.select(bucket.alias("bucket")).distinct())
    dealt = rows.withColumn("bucket", bucket)
    single = dealt.join(buckets, "bucket", "left_anti").withColumn("kept", F.lit(None).cast("long"))
    copied = dealt.join(buckets, "bucket", "left_semi").join(copies, "digest", "left")
    joined = single.unionByName(copied)
    refers = F.when(~F.col("kept").eqNullSafe(F.col("page_id")), F.col("kept"))
    return joined.withColumn("refers_to", refers).drop("kept", "bucket")


def _line(text: Column) -> Column:
    """A header value: control characters would break the record."""
    return F.regexp_replace(text, r"[\x00-\x1f\x7f]", "")


def _records() -> Column:
    """The record of a row of ``decide``, without the two line ends that close it."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit(_END),
    )
    revisit = F.col("refers_to").isNotNull()
    block_bytes = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"),
        page,
        F.lit(">\r\nWARC-Date: "),
        F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), _line(F.col("url"))), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.when(
            revisit,
            F.concat(
                F.lit(f"\r\nWARC-Profile: {_REVISIT}\r\nWARC-Refers-To: <urn:page:"),
                F.col("refers_to").cast("string"),
                F.lit(">"),
            ),
        ).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        block_bytes.cast("string"),
        F.lit(_END),
        http,
        F.when(revisit, "").otherwise(F.col("payload")),
    )


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write one WARC record per row of ``pages`` to gzip archives under ``path``.

    The capture time is the column ``date`` where there is one and it is a time,
    else page_id seconds after 2020-01-01 (null: that day). Rows are dealt in turn, not by a
    key, into archives of about ``archive_bytes``, and an archive of small records
    ends at its number of records, so none grows with the table or with a row
    that repeats. Records are made before they are dealt: a revisit moves without its page.
    """
    spark = pages.sparkSession
    rows = decide(pages)
    total = pages.agg(F.sum(F.coalesce(F.octet_length("html"), F.lit(0)) + RECORD_BYTES)).first()[0] or 0
    archives = int(-(-total // archive_bytes)) or 1
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        (
            rows.select(_records().alias("value"))
            .repartition(archives)
            .write.option("lineSep", _END)
            .option("compression", "gzip")
            .option("maxRecordsPerFile", max(1, archive_bytes // RECORD_BYTES))
            .text(path)
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def _headers(block: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in block.decode().split("\r\n")[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def parse(archive: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, headers and block of each record, by the lengths it states."""
    at = 0
    while at < len(archive):
        head = archive.index(b"\r\n\r\n", at)
        if not archive.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        headers = _headers(archive[at:head])
        start = head + 4
        end = start + int(headers["content-length"])
        if archive[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it says")
        yield at, end + 4 - at, headers, archive[start:end]
        at = end + 4


def url_key(url: str | None) -> str:
    """Sort-friendly form: reversed host, path, sorted query; no scheme, www, port or fragment."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url
    if not host:
        return url
    port_text = f":{port}" if port and port not in (80, 443) else ""
    query = "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    path = parts.path.rstrip("/").lower() or "/"
    return f"{','.join(reversed(host.split('.')))}{port_text}){path}" + (f"?{query}" if query else "")


def _stamp(date: str) -> str:
    return re.sub(r"\D", "", date)[:14]


_RECORD = (
    "url_key string, stamp string, page_id long, archive string, offset long, length long, url string, "
    "payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def read_archives(spark, path: str) -> DataFrame:
    """One row per record of the archives under ``path``; each archive is one sorted run.

    The digest of a response is taken from the payload read, that of a revisit
    from its header; so are its bytes, from the HTTP length.
    """
    small_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")

    def captures(rows):
        for name, content in rows:
            data = zlib.decompress(content, 47)
            run = []
            for offset, length, headers, block in parse(data):
                http_end = block.index(b"\r\n\r\n") + 4
                payload = block[http_end:]
                revisit = headers["warc-type"] == "revisit"
                stated = headers["warc-payload-digest"].removeprefix("sha1:")
                digest = stated if revisit else hashlib.sha1(payload).hexdigest()
                if digest != stated:
                    raise ValueError(f"{name}, byte {offset}: the payload's digest is not the stated one")
                size = int(_headers(block[:http_end])["content-length"]) if revisit else len(payload)
                number = lambda field: int(x) if (x := field[len("<urn:page:") : -1]) else None
                url = headers.get("warc-target-uri")
                run.append(
                    (
                        url_key(url),
                        _stamp(headers["warc-date"]),
                        number(headers["warc-record-id"]),
                        name.rpartition("/")[2],
                        offset,
                        length,
                        url,
                        size,
                        digest,
                        headers["warc-type"],
                        number(headers["warc-refers-to"]) if revisit else None,
                    )
                )
            yield from sorted(run, key=_order)

    out = map_rows(files, _RECORD, captures)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1024)
    return out


def _order(row: tuple) -> tuple:
    return row[0], row[1], -1 if row[2] is None else row[2], row[3], row[4]


class LoserTree:
    """Tournament of sorted runs: each inner node keeps the loser, the root's winner is next."""

    def __init__(self, runs: list[Iterable[tuple]], key=_order):
        self.runs = [iter(run) for run in runs]
        self.key = key
        self.k = len(self.runs)
        self.heads: list[tuple | None] = [None] * self.k
        self.keys: list[tuple] = [(1,)] * self.k  # (0, key) of a head, (1,) of a run at its end
        for i in range(self.k):
            self._advance(i)
        self.losers = [-1] * max(self.k, 1)
        for i in range(self.k):
            self._replay(i, filling=True)

    def _advance(self, i: int) -> None:
        self.heads[i] = next(self.runs[i], None)
        self.keys[i] = (1,) if self.heads[i] is None else (0, self.key(self.heads[i]))

    def _replay(self, i: int, filling: bool = False) -> None:
        """Play from leaf ``i`` up; while filling, the first to come waits at each node."""
        node = (i + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0 and filling:
                self.losers[node] = i
                return
            if (self.keys[other], other) < (self.keys[i], i):
                self.losers[node], i = i, other
            node //= 2
        self.losers[0] = i

    def __iter__(self) -> Iterator[tuple]:
        while self.k:
            i = self.losers[0]
            if self.heads[i] is None:
                return
            yield self.heads[i]
            self._advance(i)
            self._replay(i)


def merge_runs(captures: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The captures in global order of (url_key, stamp, page_id), range by range.

    The ranges follow the whole key, so a URL with very many captures is cut
    like any other; their number grows with the rows. Within a range the pieces
    of each run arrive together and sorted, and the loser tree merges them.
    """
    rows = captures.count()
    ranges = -(-rows // range_rows) or 1
    pieces = captures.repartitionByRange(ranges, "url_key", "stamp", "page_id", "archive", "offset")
    pieces = pieces.sortWithinPartitions("archive", "url_key", "stamp", F.col("page_id").asc_nulls_first(), "offset")

    def merge(rows):
        yield from LoserTree([list(run) for _, run in groupby(rows, key=lambda r: r[3])])

    return map_rows(pieces, _RECORD, merge)


def archive_round_trip(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Write ``pages`` as archives, read them back and return the merged index.

    One row per page row: page_id, payload_bytes, payload_digest, record_type,
    refers_to, and url_key, stamp, archive, offset, length. Null html is an
    empty payload; a null url gives no target and an empty key; null page_ids
    stay null; rows repeated are records repeated; an empty table gives no rows;
    other columns are ignored.
    """
    spark = pages.sparkSession
    path = fresh_path(spark, "archives")
    write_archives(pages, path, archive_bytes)
    # staged: count, range bounds and shuffle would each inflate the archives anew
    index = merge_runs(stage(read_archives(spark, path), "captures"), range_rows)
    return index.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        "url_key", "stamp", "archive", "offset", "length",
    )
