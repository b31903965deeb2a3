"""WARC archives: exact round trip."""

import hashlib
import io

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from tunelift.llm import warc
from tunelift.session import scratch_path

BIG, LONG = "x" * 1000, "<p>é</p>\r\n\r\nWARC/1.1\r\n" * 4000
ROWS = [(1, "http://a", BIG), (2, "http://b\r\nX: y", BIG), (3, None, BIG), (4, "u", "x" * 999), (5, "u", "x" * 999),
        (6, "u", None), (7, "u", ""), (8, "u", LONG), (9, "u", LONG), (9, "u", LONG), (None, "u", "é" * 500),
        (None, "u", "é" * 500), (10, "u", "é" * 500), (None, "u", "z" * 1500), (11, "u", "\r\n\r\n")]


def brute(rows):
    out = []
    for i, _, h in rows:
        h = h or ""
        data = h.encode()
        ids = [j for j, _, x in rows if (x or "") == h and j is not None]
        master = max(ids, default=None)
        revisit = len(data) >= 1000 and master is not None and i != master
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", master if revisit else None))
    return sorted(out, key=str)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def round_trip(spark, rows, extra=False):
    from pyspark.sql import functions as F
    df = pages(spark, rows)
    if extra:
        for c in ("payload", "master", "revisit", "large"):
            df = df.withColumn(c, F.lit("x"))
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(warc.plan_records(df), folder)
    return manifest, sorted((tuple(r) for r in warc.read_archives(manifest, folder).collect()), key=str)


def test_round_trip(spark):
    manifest, got = round_trip(spark, ROWS, extra=True)
    assert got == brute(ROWS)
    assert sum(r["records"] for r in manifest.collect()) == len(ROWS)


def test_file_limit_and_empty_table(spark, monkeypatch):
    assert round_trip(spark, [])[1] == []


def test_archive_layout():
    records = [warc.build_record(i, "u", f"page {i}".encode() * 50, None, False) for i in range(40)]
    out = io.BytesIO()
    warc._archive(iter(records), out, records)
    raw = out.getvalue()
    assert raw[:4] == b"\x5d\x2a\x4d\x18"
    size = int.from_bytes(raw[4:8], "little")
    # the records are frames of their own: the first can be read without the others
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8:8 + size]))
    assert d.decompressobj().decompress(raw[8 + size:]) == records[0]
    assert [warc.parse_record(*r)[0] for r in warc.read_archive(io.BytesIO(raw))] == list(range(40))


def test_damage_is_found():
    out = io.BytesIO()
    record = warc.build_record(1, "u", b"payload", None, False).replace(b"payload", b"Payload")
    warc._archive(iter([record]), out, [record])
    with pytest.raises(ValueError, match="differs from its digest"):
        [warc.parse_record(*r) for r in warc.read_archive(io.BytesIO(out.getvalue()))]


@settings(max_examples=60, derandomize=True, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.binary(max_size=200), st.booleans()), min_size=1, max_size=6))
def test_any_payload(rows):
    records = [warc.build_record(i, "u", p, 3 if r else None, r) for i, p, r in rows]
    out = io.BytesIO()
    warc._archive(iter(records), out, records)
    got = [warc.parse_record(*r) for r in warc.read_archive(io.BytesIO(out.getvalue()))]
    assert got == [(i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if r else "response", 3 if r else None) for i, p, r in rows]
