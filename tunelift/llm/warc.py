"""Dictionary-compressed WARC archives: write, and read back.

Each task writes archive files of bounded size into a folder that all executors share.  A
file opens with a skippable frame that holds a Zstandard dictionary built from the first
records of that file; every record after it is a frame of its own, compressed with that
dictionary.  Records whose payload repeats an earlier one are revisits that carry headers
only.  File names are unique to the attempt that wrote them, and only those listed in the
manifest (a table that Spark commits) are read, so a lost executor or a repeated task
leaves at most an unused file.
"""

from __future__ import annotations

import base64
import hashlib
import io
import os
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelift.llm.common import read_table
from tunelift.session import materialize, scratch_path

# Fixed values of the WARC and Zstandard formats.
SKIPPABLE_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_REVISIT_BYTES = 1000
FILE_BYTES = 64 << 20        # compressed bytes after which a new archive file begins
SAMPLE_BYTES = 1 << 20       # records sampled for a file's dictionary
DICTIONARY_BYTES = 32 << 10
RECORD_DATE = "2000-01-01T00:00:00Z"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    value = name.strip("<>").rpartition(":")[2]
    return None if value == "none" else int(value)


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
                 revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP headers of its payload, not the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {RECORD_DATE}",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the raw samples where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _archive(records: Iterator[bytes], out, first: list[bytes]) -> int:
    dictionary = build_dictionary([x[:DICTIONARY_BYTES] for x in first])
    out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(dictionary)) + dictionary)
    press = zstandard.ZstdCompressor(level=3, write_checksum=True,
                                     dict_data=zstandard.ZstdCompressionDict(dictionary))
    written = 0
    for record in records:
        frame = press.compress(record)
        out.write(frame)
        written += len(frame)
        if written >= FILE_BYTES:
            break
    return written


def read_archive(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive, read as a stream."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != SKIPPABLE_MAGIC:
        raise ValueError("no leading dictionary frame")
    unpress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(stream.read(size)))
    plain = io.BufferedReader(unpress.stream_reader(stream, read_across_frames=True))
    while version := plain.readline():
        if version != b"WARC/1.1\r\n":
            raise ValueError("no record where one must begin")
        head = {}
        while (line := plain.readline()) != b"\r\n":
            key, _, value = line.decode().rstrip("\r\n").partition(": ")
            head[key] = value
        block = plain.read(int(head["Content-Length"]))
        if plain.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        yield head, block


def parse_record(head: dict[str, str], block: bytes) -> tuple:
    """page_id, payload bytes, payload SHA-1 (hex), type, page referred to; digests are checked."""
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.lower().rpartition(b"content-length: ")[2].split(b"\r\n")[0])
    digest = base64.b32decode(head["WARC-Payload-Digest"].partition(":")[2])
    if head["WARC-Type"] == "response" and (len(payload) != length
                                            or hashlib.sha1(payload).digest() != digest):
        raise ValueError(f"payload of {head['WARC-Record-ID']} differs from its digest")
    refers = head.get("WARC-Refers-To")
    return (_page(head["WARC-Record-ID"]), length, digest.hex(), head["WARC-Type"],
            _page(refers) if refers else None)


def plan_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, html (null: empty), revisit, refers_to.

    Of the rows with equal payloads of at least ``min_bytes``, the one with the largest
    page_id is the response.  Null ids are smaller than others; rows that repeat the id
    and payload of a response are responses too."""
    html = F.coalesce("html", F.lit(""))
    body = pages.select("page_id", "url", html.alias("html"), F.sha2(html, 256).alias("payload"),
                        (F.octet_length(html) >= min_bytes).alias("large"))
    groups = materialize(body.where("large").groupBy("payload")
                         .agg(F.max("page_id").alias("master"), F.count(F.lit(1)).alias("rows"))
                         .where("rows > 1").select("payload", "master"), "payload-groups")
    revisit = (F.col("large") & F.col("master").isNotNull()
               & ~F.col("page_id").eqNullSafe(F.col("master")))
    return (body.join(groups, "payload", "left")
            .withColumn("revisit", F.coalesce(revisit, F.lit(False)))
            .select("page_id", "url", "html", "revisit",
                    F.when(F.col("revisit"), F.col("master")).alias("refers_to")))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write planned records as .warc.zst files below ``folder`` (a path or URI that all
    executors share); returns the committed manifest (path, records, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def build() -> Iterator[bytes]:
            for batch in batches:
                for i in range(batch.num_rows):
                    page_id, url, html, revisit, refers_to = (batch[k][i].as_py() for k in range(5))
                    yield build_record(page_id, url, html.encode(), refers_to, revisit)

        store, base = _filesystem(folder)
        source = build()
        while True:
            first, size = [], 0
            for record in source:
                first.append(record)
                if (size := size + len(record)) >= SAMPLE_BYTES:
                    break
            if not first:
                return
            path = f"{base}/{uuid.uuid4().hex}.warc.zst"
            store.create_dir(base, recursive=True)
            count = 0

            def counted() -> Iterator[bytes]:
                nonlocal count
                for part in (first, source):
                    for record in part:
                        count += 1
                        yield record

            with store.open_output_stream(path) as out:
                written = _archive(counted(), out, first)
            yield pa.record_batch([pa.array([os.path.basename(path)]), pa.array([count], pa.int64()),
                                   pa.array([written], pa.int64())], names=["path", "records", "bytes"])

    return materialize(records.mapInArrow(run, "path string, records long, bytes long"), "manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record of the listed archives (RECORDS); payload digests are checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _filesystem(folder)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for batch in batches:
            for name in batch["path"].to_pylist():
                with store.open_input_stream(f"{base}/{name}") as stream:
                    rows = []
                    for head, block in read_archive(stream):
                        rows.append(parse_record(head, block))
                        if len(rows) == 4096:
                            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                            rows = []
                    if rows:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path").repartition(n, "path").mapInArrow(run, RECORDS)


def op10_warc_dictionary(spark, sf_dir):
    """Archive all pages, then read every archive back."""
    folder = scratch_path(spark, "warc")
    manifest = write_archives(plan_records(read_table(spark, sf_dir, "pages")), folder)
    return read_archives(manifest, folder)


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS master, n >= 1000
        AND page_id IS DISTINCT FROM max(page_id) OVER (PARTITION BY html) AS again FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN master END AS refers_to
FROM g
"""
