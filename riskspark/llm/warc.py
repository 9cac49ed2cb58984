"""WARC archives of captures and their merged index.

Writing: a record for each page, as text through Spark's own writer (a
record's end, two line ends, is the writer's separator), so that archives
land in any shared store with Spark's commit protocol.  Of pages with equal
payloads of at least ``least_revisit_bytes`` the one with the largest id is a
response and the others are revisits that refer to it; others are responses.

Reading: archives are parsed by their Content-Length headers, payload digests
are checked, and the captures of each archive leave the task as one sorted
run.

Index: runs are dealt to ranges of (URL key, timestamp, page id); each range
merges its parts of the runs with a tournament tree of losers, so the output
is in global order, and a URL with very many captures spans several ranges.

Defined results: a null html is an empty payload; a null URL is written as
``urn:x-no-url`` and control characters and spaces in URLs are percent-encoded;
a null id is smaller than any other and is read back as null; all rows that
bear the largest id of a payload are responses, as are all rows of a payload
without any id; the capture time is derived from the id (the table has none);
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.shared import stage, stage_path

EOL = "\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
RECORD_ID = "urn:x-page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIRST_DAY, DAYS = "2024-01-01", 3650


def base32_column(hexed: Column) -> Column:
    """Base32 of 20 bytes given in hex: 5 bytes are 8 digits to the base 32."""
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def capture_time(page_id: Column) -> Column:
    """ISO time derived from the id, free of time zones."""
    at = F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(DAYS * 86400))
    two = lambda x: F.lpad(x.cast("int").cast("string"), 2, "0")
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), F.floor(at / 86400).cast("int")).cast("string")
    return F.concat(day, F.lit("T"), two(F.floor(at / 3600) % 24), F.lit(":"), two(F.floor(at / 60) % 60),
                    F.lit(":"), two(at % 60), F.lit("Z"))


def write_archives(pages: DataFrame, path: str, least_revisit_bytes: int = 0, id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html", records_per_file: int = 2000) -> None:
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.unhex(F.sha2("html", 256)))
    repeated = rows.filter(F.octet_length("html") >= least_revisit_bytes).groupBy("sha").agg(
        F.max("page_id").alias("kept_id"), F.count(F.lit(1)).alias("n")).filter("n > 1 and kept_id is not null")
    rows = rows.join(stage(repeated.drop("n"), "warc-repeated"), "sha", "left")
    revisit = F.col("kept_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept_id"))
    page = F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(">"))
    url = F.coalesce(F.col("url"), F.lit("urn:x-no-url"))
    for code in (0x25, *range(0x21), 0x7F):  # line ends would end the header; % first
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    size = F.octet_length("html")
    head = F.concat(F.lit(HTTP_HEAD), size.cast("string"), F.lit(EOL + EOL))
    block = F.when(revisit, F.lit(0)).otherwise(size) + F.octet_length(head)
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), page, F.lit("\r\nWARC-Date: "), capture_time(F.col("page_id")),
        F.lit("\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), base32_column(F.sha1("html")),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: <{RECORD_ID}"),
                                 F.col("kept_id").cast("string"), F.lit(">"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        block.cast("string"), F.lit(EOL + EOL), head, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    rows.select(record.alias("value")).write.option("lineSep", EOL + EOL).option(
        "maxRecordsPerFile", records_per_file).text(path)


def url_key(url: str) -> str:
    """Host labels in reverse, then path and query: captures of a site are
    neighbours.  A URL that can't be split is its own key."""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").removeprefix("www.")
        port = f":{parts.port}" if parts.port and parts.port not in (80, 443) else ""
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port}){parts.path or '/'}{query}"


def parse_records(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of each record of an archive."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode().split(EOL)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = int(headers["Content-Length"])
        yield at, headers, content[end + 4:end + 4 + size]
        at = end + 4 + size + 4


def _page(value: str | None) -> int | None:
    number = (value or "").removeprefix(f"<{RECORD_ID}").removesuffix(">")
    return int(number) if number and number != "null" else None


def capture(headers: dict[str, str], block: bytes) -> tuple:
    """(URL key, time, page id, type, refers to, payload bytes, digest)."""
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(head.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if headers["WARC-Type"] == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if (len(payload), found) != (size, digest):
            raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its record")
    return (url_key(headers["WARC-Target-URI"]), headers["WARC-Date"], _page(headers["WARC-Record-ID"]),
            headers["WARC-Type"], _page(headers.get("WARC-Refers-To")), size, digest)


RUN = ("url_key string, captured_at string, page_id long, record_type string, refers_to long, "
       "payload_bytes long, payload_digest string, archive string, offset long")
_NAMES = [x.split()[0] for x in RUN.split(", ")]


def _order(row: tuple) -> tuple:
    return row[0], row[1], -1 if row[2] is None else row[2], row[7], row[8]


def read_runs(spark, path: str) -> DataFrame:
    """The captures of all archives; those of one archive as a sorted run."""
    def runs(batches: Iterator) -> Iterator:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                archive = name.as_py().rsplit("/", 1)[1]
                rows = [(*capture(headers, block), archive, offset)
                        for offset, headers, block in parse_records(content.as_py())]
                yield _batch(sorted(rows, key=_order))

    archives = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return archives.select("path", "content").mapInArrow(runs, RUN)


def _batch(rows: list[tuple]):
    import pyarrow as pa

    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kinds[x.split()[1]]) for i, x in enumerate(RUN.split(", "))], _NAMES)


class LoserTree:
    """k-way merge of sorted runs.  Each inner node holds the loser of the
    match below it, so taking the smallest item replays one path."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at, self.k = runs, [0] * len(runs), len(runs)
        self.losers = [-1] * max(1, self.k)
        for run in range(self.k):
            self._replay(run)

    def _key(self, run: int):
        place = self.at[run]
        return (0, _order(self.runs[run][place])) if place < len(self.runs[run]) else (1,)

    def _replay(self, run: int) -> None:
        node = (run + self.k) // 2
        while node:
            other = self.losers[node]
            if other < 0:  # the first to come waits for its match
                self.losers[node] = run
                return
            if self._key(other) < self._key(run):
                self.losers[node], run = run, other
            node //= 2
        self.losers[0] = run

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.at[self.losers[0]] < len(self.runs[self.losers[0]]):
            winner = self.losers[0]
            yield self.runs[winner][self.at[winner]]
            self.at[winner] += 1
            self._replay(winner)


def merge_runs(runs: DataFrame) -> DataFrame:
    """All captures in order of (URL key, time, page id)."""
    def merge(batches: Iterator) -> Iterator:
        parts: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*[batch.column(n).to_pylist() for n in _NAMES], strict=True):
                parts.setdefault(row[7], []).append(row)
        out: list[tuple] = []
        for row in LoserTree([sorted(p, key=_order) for _, p in sorted(parts.items())]):  # sorted: runs may be split
            out.append(row)
            if len(out) == 10_000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return runs.repartitionByRange("url_key", "captured_at", "page_id", "archive", "offset").mapInArrow(merge, RUN)


def archive_pages(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``pages`` to archives at ``path`` (shared storage), read them
    back, and return their merged index."""
    path = path or stage_path(pages.sparkSession, "warc")
    write_archives(pages, path, **options)
    return merge_runs(stage(read_runs(pages.sparkSession, path), "warc-runs"))
