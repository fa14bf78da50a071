"""WARC archives: written with an index, read back by coalesced byte ranges.

Pages become gzip members, one per record, in archive files of a shared folder. Every record's
file, offset, length, URL and digest go into an index table, which Spark commits: a task that
is run again writes files of another name, and what a failed attempt left is in no index. A
reader selects records in the index, sorts them by place, joins near ranges to one read of a
bounded size, and parses the members. ``index_archives`` makes the same index for archives
that came without one, in one streaming pass over each file.

Pages with equal payloads of at least ``REVISIT_BYTES`` are stored once: the largest page_id
is the response, the others are revisit records that refer to it.

The folder may be of any kind that both Spark and ``pyarrow.fs`` open: local or mounted, S3,
GCS, HDFS.

Defined cases: a NULL html is an empty payload, a NULL url leaves its header out; rows that
repeat the page_id of a response are responses too; a NULL page_id is never referred to, and
where all of a group are NULL all are responses; control characters of a url are percent-
encoded.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import shuffle_parts, text_batches
from tallyloom.settings import scratch_path, written_table

REVISIT_BYTES = 1000
FILE_BYTES = 256 << 20
READ_BYTES, GAP_BYTES = 4 << 20, 64 << 10
RUN_BYTES = 32 << 20  # selected records of so many bytes of a file go to one task
LEVEL = 4
CHUNK_BYTES = 4 << 20

# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
ID = "urn:x-page:"
CONTROL = re.compile(r"[\x00-\x20\x7f]")

INDEX = ("file string, offset long, length long, url string, digest string, page_id long, "
         "record_type string")
INDEX_NAMES = ["file", "offset", "length", "url", "digest", "page_id", "record_type"]
INDEX_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
RECORD = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, url string")


def table_of(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def clean_url(url: str) -> str:
    return CONTROL.sub(lambda found: quote(found[0]), url)


def record_bytes(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                 revisit: bool) -> bytes:
    """One record as a gzip member. Lengths of a revisit are those of the payload it omits."""
    block = HTTP_HEAD if revisit else HTTP_HEAD + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{ID}{'' if page is None else page}>"), ("WARC-Date", DATE),
        *([("WARC-Target-URI", clean_url(url))] if url is not None else []),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", len(payload)),
        *([("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{ID}{refers_to}>")] if revisit else []),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block)),
    ]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields).encode()
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return squeeze.compress(VERSION + head + b"\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def page_number(value: str | None) -> int | None:
    digits = value.strip("<>").removeprefix(ID) if value else ""
    return int(digits) if digits else None


def parsed_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of an unpacked record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError("no WARC record at this place")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    return fields, rest[:int(fields["Content-Length"])]


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write pages (page_id, url, html, digest, response_id) and return the index."""
    fs.FileSystem.from_uri(folder)[0].create_dir(fs.FileSystem.from_uri(folder)[1], recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, base = fs.FileSystem.from_uri(folder)
        attempt, number, out, offset = TaskContext.get().taskAttemptId(), 0, None, 0
        try:
            for batch in text_batches(batches, CHUNK_BYTES):
                rows = []
                for page, url, html, digest, response in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None or offset > FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, number, offset = f"records-{attempt:08d}-{number:04d}.warc.gz", number + 1, 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    revisit = response is not None
                    data = record_bytes(page, url, html, digest, response, revisit)
                    out.write(data)
                    rows.append((name, offset, len(data), url, digest, page, "revisit" if revisit else "response"))
                    offset += len(data)
                yield table_of(rows, INDEX_KINDS, INDEX_NAMES)
        finally:
            if out is not None:
                out.close()

    return pages.select("page_id", "url", "html", "digest", "response_id").mapInArrow(run, INDEX)


def indexed_file(store: fs.FileSystem, path: str, name: str) -> Iterator[tuple]:
    """Index rows of one archive, member by member."""
    with store.open_input_stream(path, compression=None) as source:
        data, offset = b"", 0
        while True:
            member, parts, length = zlib.decompressobj(31), [], 0
            while not member.eof:
                if not data and not (data := source.read(1 << 20)):
                    break
                before = len(data)
                parts.append(member.decompress(data))
                data = member.unused_data if member.eof else b""
                length += before - len(data)
            if not length:
                return
            fields, _ = parsed_record(b"".join(parts))
            yield (name, offset, length, fields.get("WARC-Target-URI"),
                   fields.get("WARC-Payload-Digest", "").removeprefix("sha1:"),
                   page_number(fields.get("WARC-Record-ID")), fields["WARC-Type"])
            offset += length


def index_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The index of all archives of a folder. One record is held at a time."""
    store, base = fs.FileSystem.from_uri(folder)
    names = sorted(f.base_name for f in store.get_file_info(fs.FileSelector(base)) if f.is_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                for row in indexed_file(store, f"{base}/{name}", name):
                    rows.append(row)
                    if len(rows) == 5000:
                        yield table_of(rows, INDEX_KINDS, INDEX_NAMES)
                        rows = []
                yield table_of(rows, INDEX_KINDS, INDEX_NAMES)

    files = spark.createDataFrame([(name,) for name in names], "file string")
    return files.repartition(max(1, len(names)), "file").mapInArrow(run, INDEX)


def coalesced(ranges: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """(start, end, ranges) of reads that serve sorted ranges (offset, length)."""
    held: list[tuple[int, int]] = []
    for offset, length in ranges:
        if held:
            start, end = held[0][0], sum(held[-1])
            if offset - end > GAP_BYTES or offset + length - start > READ_BYTES:
                yield start, end, held
                held = []
        held.append((offset, length))
    if held:
        yield held[0][0], sum(held[-1]), held


def read_records(selected: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of index rows (file, offset, length). Payloads are checked against their
    digests."""
    def records(store: fs.FileSystem, path: str, ranges: list[tuple[int, int]]) -> Iterator[tuple]:
        with store.open_input_file(path) as source:
            for start, end, parts in coalesced(ranges):
                data = source.read_at(end - start, start)
                for offset, length in parts:
                    fields, block = parsed_record(zlib.decompress(data[offset - start:offset - start + length], 31))
                    payload = block.partition(b"\r\n\r\n")[2]
                    revisit = fields["WARC-Type"] == "revisit"
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{path} at {offset}: the payload does not match its digest")
                    yield (page_number(fields["WARC-Record-ID"]), int(fields["X-Payload-Length"]), digest,
                           fields["WARC-Type"], page_number(fields.get("WARC-Refers-To")),
                           fields.get("WARC-Target-URI"), payload)

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    width = len(names) - (not with_payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            by_file: dict[str, list[tuple[int, int]]] = {}
            for name, offset, length in zip(*(column.to_pylist() for column in batch.columns[:3])):
                by_file.setdefault(name, []).append((offset, length))
            for name, ranges in by_file.items():
                rows, held = [], 0
                for row in records(store, f"{base}/{name}", ranges):
                    rows.append(row[:width])
                    held += row[1]
                    if held > CHUNK_BYTES:
                        yield table_of(rows, kinds[:width], names[:width])
                        rows, held = [], 0
                yield table_of(rows, kinds[:width], names[:width])

    run_of = F.floor(F.col("offset") / RUN_BYTES)
    return (selected.select("file", "offset", "length")
            .repartition(shuffle_parts(selected.sparkSession), "file", run_of)
            .sortWithinPartitions("file", "offset")
            .mapInArrow(run, RECORD + (", payload binary" if with_payload else "")))


def with_responses(pages: DataFrame) -> DataFrame:
    """Pages (page_id, url, html) as bytes with their digest, and for a revisit the page it
    refers to as ``response_id``. Only digests are grouped; the join is by digest, where a
    payload that a third of the pages share is split by adaptive execution."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    full = pages.select("page_id", "url", html.alias("html")).withColumn("digest", F.sha1("html"))
    large = F.octet_length("html") >= REVISIT_BYTES
    firsts = written_table(
        full.where(large).groupBy("digest").agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
        .where("n > 1 AND largest IS NOT NULL").select("digest", "largest"), "payloads")
    joined = full.join(firsts, "digest", "left")
    return joined.withColumn(
        "response_id", F.when(large & ~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest")))


def archive_pages(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages and return the committed index."""
    return written_table(write_archives(with_responses(pages), folder), "index")


def archived_and_read(pages: DataFrame) -> DataFrame:
    """Write all pages into a new folder and read every record back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_records(archive_pages(pages, folder), folder)
