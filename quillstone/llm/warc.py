"""WARC archives: one gzip member per record, written and read back sequentially."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, join_sized, prepare, rows_of, table, utf8, written

#: Compressed bytes after which an archive is closed.
ARCHIVE_BYTES = 4 << 20
#: Payloads below this many bytes are always stored in full.
REVISIT_BYTES = 100
#: WARC-Date of written records; a parameter, for results must not depend on the clock.
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC/1.1 record as a gzip member. A revisit keeps the HTTP head, with the full length, and no payload."""
    digest = hashlib.sha256(payload).hexdigest()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields[2:2] = [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", _PROFILE)]
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def info(name: str, date: str = DATE) -> bytes:
    """The warcinfo record that begins an archive."""
    block = b"software: quillstone\r\nformat: WARC File Format 1.1\r\n"
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:archive:{name}>"), ("WARC-Date", date), ("WARC-Filename", name), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(block)))]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def members(content: bytes, step: int = 1 << 16) -> Iterator[bytes]:
    """The gzip members of an archive, decompressed step by step."""
    at, rest = 0, b""
    while at < len(content) or rest:
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not rest:
                if at >= len(content):
                    raise ValueError("the archive ends within a record")
                rest, at = content[at : at + step], at + step
            parts.append(unpacker.decompress(rest))
            rest = unpacker.unused_data
        yield b"".join(parts)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and the block, framed by Content-Length; its digest is verified."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    n = int(fields["content-length"])
    block, end = rest[:n], rest[n:]
    if len(block) != n or end != b"\r\n\r\n":
        raise ValueError("the block does not match Content-Length")
    if (want := fields.get("warc-block-digest", "")).startswith("sha256:") and hashlib.sha256(block).hexdigest() != want[7:]:
        raise ValueError("the block does not match WARC-Block-Digest")
    return fields, block


def _page(value: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", value)
    return int(found[1]) if found else None


_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])
_READ_DDL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def read_records(content: bytes) -> Iterator[tuple]:
    for raw in members(content):
        fields, block = parse(raw)
        if fields["warc-type"] not in ("response", "revisit"):
            continue
        http, _, payload = block.partition(b"\r\n\r\n")
        digest, kind = fields["warc-payload-digest"].removeprefix("sha256:"), fields["warc-type"]
        size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
        if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError("the payload does not match its length or WARC-Payload-Digest")
        yield _page(fields["warc-record-id"]), size, digest, kind, _page(fields.get("warc-refers-to", "")), fields["warc-target-uri"], payload if kind == "response" else None


def _archives(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """(name, content) of a task's archives, each closed when its records exceed ARCHIVE_BYTES."""
    pid, n, size, kept = TaskContext.get().partitionId(), 0, 0, []
    for batch in it:
        for page_id, url, payload, first in rows_of(batch):
            name = f"{pid:06d}-{n:06d}.warc.gz"
            kept = kept or [info(name)]
            kept.append(record(page_id, url, payload, first))
            size += len(kept[-1])
            if size >= ARCHIVE_BYTES:
                yield name, b"".join(kept)
                kept, size, n = [], 0, n + 1
    if kept:
        yield f"{pid:06d}-{n:06d}.warc.gz", b"".join(kept)


def _write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from batches(_archives(it), pa.schema([("name", pa.string()), ("content", pa.binary())]))


def _store(folder: str):
    """Writes a task's archives as files; a file gets its name when it is whole, so that a task that runs again changes nothing."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        store.create_dir(base, recursive=True)
        attempt = TaskContext.get().taskAttemptId()

        def out() -> Iterator[tuple]:
            for name, content in _archives(it):
                draft = f"{base}/_{attempt}-{name}"
                with store.open_output_stream(draft, compression=None) as f:
                    f.write(content)
                store.move(draft, f"{base}/{name}")
                yield name, len(content)

        yield from batches(out(), pa.schema([("name", pa.string()), ("bytes", pa.int64())]))

    return run


def _read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from batches((r for b in it for content in b.column(0).to_pylist() for r in read_records(content)), _READ)


def _deduplicated(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, first): first is the response that a revisit refers to."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), utf8(F.col("html")).alias("payload"))
    rows = rows.withColumn("digest", F.when(F.octet_length("payload") >= REVISIT_BYTES, F.sha2("payload", 256)))
    groups = rows.filter(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("size"))
    groups = written(groups.filter("size > 1"), "payloads")
    columns = ["page_id", "url", "payload", "first"]
    short = rows.filter(F.col("digest").isNull()).withColumn("first", F.lit(None).cast("long")).select(columns)
    joined = join_sized(rows.filter(F.col("digest").isNotNull()), groups, "digest", "left").select(columns).unionByName(short)
    first = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "payload", first.alias("first"))


def write_archives(pages: DataFrame) -> DataFrame:
    """Archives (name, content) of ``pages`` (page_id, url, html), each with a warcinfo record first.

    Null html is an empty payload, a null url an empty one. Of records with equal payloads of at least
    REVISIT_BYTES bytes the smallest page_id is the response; rows that repeat that id are responses
    too. If all ids of a group are null, all are responses. An empty table gives no archive. Other columns are not read.
    """
    return _deduplicated(pages).mapInArrow(_write, "name string, content binary")


def write_files(pages: DataFrame, folder: str) -> DataFrame:
    """The same archives as .warc.gz files in a folder that all executors reach (a path or a URI): (name, bytes) of each.

    ``spark.read.format("binaryFile")`` brings them to ``read_archives``, and any other WARC reader opens them.
    """
    return written(_deduplicated(pages).mapInArrow(_store(folder), "name string, bytes long"), "files")


def read_archives(archives: DataFrame) -> DataFrame:
    """Records of archives in a column ``content``, such as those of ``spark.read.format("binaryFile")``. A broken record fails the job."""
    prepare(archives.sparkSession)
    return archives.select("content").mapInArrow(_read, _READ_DDL)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = written(write_archives(table(spark, sf_dir, "pages")), "warc")
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = f"""
WITH d AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n, sha256(coalesce(html, '')) AS s FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY s) AS m FROM d)
SELECT page_id, n AS payload_bytes, s AS payload_digest,
       CASE WHEN n >= {REVISIT_BYTES} AND page_id <> m THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {REVISIT_BYTES} AND page_id <> m THEN m END AS refers_to
FROM g
"""
