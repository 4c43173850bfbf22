import gzip

import pytest

from seriema.llm import warc
from seriema.session import scratch_path

SCHEMA = "page_id long, url string, html string, block string"


def test_round_trip(spark):
    long = "<p>é</p>\r\n\r\nWARC/1.1\r\n" * 5_000
    pages = [(1, "http://a/ b\n", long, "c"), (2, None, "x", "c"), (3, "u", None, "c"), (4, "u", "", "c"), (5, "u", long, None),
             (6, "u", "x", None), (None, "u", "only", None), (None, "u", "x", None), (7, "u", "again", None), (7, "u", "again", None)]
    path = scratch_path(spark, "warc")
    warc.write(spark.createDataFrame(pages, SCHEMA), path)
    found = warc.read(spark, path, keep_payload=True)
    rows = found.collect()
    assert len(rows) == len(pages)
    texts = {r.page_id: bytes(r.payload).decode() for r in rows if r.record_type == "response"}
    assert texts == {"1": long, "2": "x", "3": "", None: "only", "7": "again"}
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in warc.catalogued(found).collect())
    size = len(long.encode())
    assert got == [(0, 1, "revisit", 2), (0, 4, "response", None), (1, size, "response", None), (2, 1, "response", None),
                   (3, 0, "response", None), (4, 0, "revisit", 3), (5, size, "revisit", 1), (6, 1, "revisit", 2),
                   (7, 5, "response", None), (7, 5, "response", None)]
    assert all(len(r.payload_digest) == 32 for r in rows)


def test_repeated_rows_in_different_files_are_records_of_their_own(spark, tmp_path):
    long = "again " * 5_000
    files = [[(7, "u", long, None), (None, "a", "only", None), (8, "u", long, None), (9, "u", "one", None)],
             [(7, "u", long, None), (None, "b", "only", None), (8, "v", long, None)], [(7, "w", long, None)]]
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"in{k}"))
    pages = [spark.read.parquet(str(tmp_path / f"in{k}")) for k in range(3)]
    path = scratch_path(spark, "warc")
    warc.write(pages[0].unionAll(pages[1]).unionAll(pages[2]), path)
    found = warc.read(spark, path)
    rows = found.collect()
    assert len(rows) == len({r.record_id for r in rows}) == 8
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in warc.catalogued(found).collect())
    size = len(long)
    assert got == [(0, 4, "response", None)] * 2 + [(7, size, "response", None)] * 3 + [(8, size, "revisit", 7)] * 2 + [(9, 3, "response", None)]


def test_segments_can_lie_anywhere(spark, tmp_path):
    payload = b"0123456789" * 300
    digest = warc.base32_sha1(payload)
    parts = warc.records(1, "u", payload, digest, None, False, "", 700)
    assert len(parts) > 3
    for k, part in enumerate(reversed(parts)):  # one plain or gzipped file each, in the wrong order
        data = part + b"\r\n\r\n"
        (tmp_path / f"f{k}.warc").write_bytes(gzip.compress(data) + gzip.compress(b"") if k % 2 else data)
    rows = warc.read(spark, str(tmp_path), keep_payload=True).collect()
    assert [(r.page_id, bytes(r.payload), r.payload_digest) for r in rows] == [("1", payload, digest)]
    (tmp_path / "f1.warc").unlink()
    with pytest.raises(Exception, match="segments"):
        warc.read(spark, str(tmp_path)).collect()


def test_framing():
    for size in (0, 1, 4_096, 4_097, 10_000):
        body = bytes(range(256)) * 40
        assert warc.unchunked(warc.chunked(body[:size])) == body[:size]
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_empty_archive(spark):
    path = scratch_path(spark, "warc")
    warc.write(spark.createDataFrame([], SCHEMA), path)
    assert warc.catalogued(warc.read(spark, path)).count() == 0
