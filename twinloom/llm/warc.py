"""WARC archives of pages, and a capture index merged from locally sorted runs.

Writing: pages are joined with the largest page_id of each payload digest. That capture becomes a
``response`` record with its payload, the others ``revisit`` records that refer to it and carry
only the HTTP header, whose Content-Length tells the payload's size. Spark's text sink writes the
archives; the separator of WARC records is its line separator, so commits and retries are Spark's.

Indexing: each archive is read back as bytes and parsed by Content-Length, its captures sorted by
URL key and time, which makes a sorted run, and the runs are written to the shared folder. They
are then cut by sampled ranges of the whole key (URL key, time, archive, offset), so that even one
URL with a third of all captures is spread, and each range merges its pieces of runs with a loser
tree. A run ends where the key falls, so the merge does not depend on the order in which pieces
arrive. Partitions follow each other in key order: the result is globally sorted.

Pages carry no capture time, so it is made from page_id: that many seconds after 2024-01-01,
modulo ten years.

Defined cases: null html is an empty payload; a null URL has no target line and an empty key; line
breaks in URLs are percent-encoded; a null page_id refers to any known page of equal payload and
is otherwise a response; repeated rows with the largest id are all responses; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinloom.llm.rows import written
from twinloom.session import shared_folder

LINE = "\r\n"
#: Records of an archive at most, so that one is read by one task.
RECORDS = 10_000
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CAPTURES = (
    "url_key string, captured_at string, archive string, offset bigint, page_id bigint, url string, "
    "payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
)
KEY = ["url_key", "captured_at", "archive", "offset"]


def base32_sha1(payload: Column) -> Column:
    """SHA-1 as 32 base32 characters: each five hexadecimal digits are four of them."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def capture_time(page_id: Column) -> Column:
    second = F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(3650 * 86400))
    clock = [F.lpad(F.floor(F.pmod(second, F.lit(w)) / F.lit(v)).cast("string"), 2, "0") for w, v in ((86400, 3600), (3600, 60), (60, 1))]
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.floor(second / 86400).cast("int")).cast("string")
    return F.concat(day, F.lit("T"), F.concat_ws(":", *clock), F.lit("Z"))


def record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat(F.lit("page "), F.coalesce(page_id.cast("string"), digest)))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(LINE)), F.lit(""))


def records(pages: DataFrame) -> DataFrame:
    """One WARC record a page, as text without the separator that follows it."""
    pages = pages.select(
        F.col("page_id").cast("bigint"),
        F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", base32_sha1(F.col("html")))
    first = written(pages.groupBy("digest").agg(F.max("page_id").alias("first")), "responses")
    pages = pages.join(first, "digest")
    response = F.col("first").isNull() | F.coalesce(F.col("page_id") == F.col("first"), F.lit(False))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        F.octet_length("html").cast("string"),
        F.lit(LINE * 2),
    )
    block = F.concat(http, F.when(response, F.col("html")).otherwise(""))
    revisit = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    return pages.withColumn("block", block).select(
        F.concat(
            F.lit(f"WARC/1.1{LINE}"),
            _line("WARC-Type", F.when(response, "response").otherwise("revisit")),
            _line("WARC-Record-ID", record_id(F.col("page_id"), F.col("digest"))),
            _line("WARC-Date", capture_time(F.col("page_id"))),
            _line("WARC-Target-URI", F.col("url")),
            _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            _line("WARC-Profile", F.when(~response, revisit)),
            _line("WARC-Refers-To", F.when(~response, record_id(F.col("first"), F.col("digest")))),
            _line("X-Refers-To-Page", F.when(~response, F.col("first"))),
            _line("X-Page", F.col("page_id")),
            _line("Content-Type", F.lit("application/http; msgtype=response")),
            _line("Content-Length", F.octet_length("block")),
            F.lit(LINE),
            F.col("block"),
        ).alias("record")
    )


def write_archives(pages: DataFrame, records_per_archive: int = RECORDS) -> str:
    """Write the archives, compressed, and return their folder."""
    folder = shared_folder(pages.sparkSession, "archives")
    writer = records(pages).write.option("lineSep", LINE * 2).option("compression", "gzip")
    writer.option("maxRecordsPerFile", records_per_archive).text(folder)
    return folder


def url_key(url: str | None) -> str:
    """Host labels in reverse order, then the rest: ``com,example,)/path?query``."""
    if not url:
        return ""
    found = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?(?:www\d*\.)?([^/?#:]*)(?::\d+)?([^#]*)", url, re.I)
    host, rest = found.groups()
    return ",".join(reversed(host.lower().split("."))) + ",)" + (rest.lower() or "/")


def parse(archive: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, header fields and block of each record."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        version, *lines = archive[at:end].decode().split(LINE)
        if version != "WARC/1.1":
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines)
        start = end + 4
        stop = start + int(fields["Content-Length"])
        if archive[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end after its Content-Length")
        yield at, fields, archive[start:stop]
        at = stop + 4


def captures(archive: bytes, name: str) -> list[tuple]:
    """A sorted run: the captures of an archive in key order, payloads checked against digests."""
    import base64
    import hashlib

    out = []
    for offset, fields, block in parse(archive):
        head, _, payload = block.partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if fields["WARC-Type"] == "response":
            found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if len(payload) != length or found != digest:
                raise ValueError(f"{name} is damaged at byte {offset}")
        url = fields.get("WARC-Target-URI")
        page, first = (int(fields[k]) if k in fields else None for k in ("X-Page", "X-Refers-To-Page"))
        out.append((url_key(url), fields["WARC-Date"], name, offset, page, url, length, digest, fields["WARC-Type"], first))
    return sorted(out, key=lambda row: row[:4])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    fields = [f.split() for f in CAPTURES.split(", ")]
    types = {"string": pa.string(), "bigint": pa.int64()}
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def sorted_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The captures of all archives, each archive's in key order, written to the shared folder."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield _batch(captures(zlib.decompress(content, wbits=47), path.rpartition("/")[2]))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")
    return written(files.mapInArrow(work, CAPTURES), "capture-runs")


class LoserTree:
    """Merges sorted sequences; each step replays one path from a leaf to the root."""

    def __init__(self, runs: Sequence[Sequence]):
        self.runs, self.k = runs, len(runs)
        self.at = [0] * self.k
        self.losers = [-1] * self.k
        for run in range(self.k):
            self._play(run)

    def _wins(self, a: int, b: int) -> bool:
        """Whether run a's next key comes first; an exhausted run loses, the earlier run wins ties."""
        if self.at[a] == len(self.runs[a]):
            return False
        if self.at[b] == len(self.runs[b]):
            return True
        x, y = self.runs[a][self.at[a]], self.runs[b][self.at[b]]
        return x < y or (x == y and a < b)

    def _play(self, run: int) -> None:
        node = (run + self.k) // 2
        while node > 0:
            if self.losers[node] == -1:  # while the tree fills up, the first to come waits
                self.losers[node] = run
                return
            if self._wins(self.losers[node], run):
                self.losers[node], run = run, self.losers[node]
            node //= 2
        self.losers[0] = run

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """Run and position of each element in merged order."""
        if not self.k:
            return
        for _ in range(sum(map(len, self.runs))):
            run = self.losers[0]
            yield run, self.at[run]
            self.at[run] += 1
            self._play(run)


def merged(table: pa.Table) -> pa.Table:
    """The rows of pieces of sorted runs, in key order."""
    keys = list(zip(*(table.column(name).to_pylist() for name in KEY), strict=True))
    starts = [i for i in range(len(keys)) if not i or keys[i] < keys[i - 1]]
    runs = [keys[a:b] for a, b in zip(starts, [*starts[1:], len(keys)], strict=True)]
    return table.take(pa.array([starts[run] + place for run, place in LoserTree(runs)], pa.int64()))


def capture_index(runs: DataFrame) -> DataFrame:
    """All captures in the global order of URL key and time."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            yield from merged(pa.Table.from_batches(held)).to_batches()

    return runs.repartitionByRange(*KEY).mapInArrow(work, CAPTURES)


def archived(pages: DataFrame, records_per_archive: int = RECORDS) -> DataFrame:
    """Write the pages as archives, read these back and return the merged index."""
    folder = write_archives(pages, records_per_archive)
    return capture_index(sorted_runs(pages.sparkSession, folder))
