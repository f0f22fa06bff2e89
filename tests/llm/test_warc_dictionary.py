import base64
import hashlib
import io
import struct

import pytest
import zstandard

from strata.llm.blobs import read_blobs
from strata.llm.warc_dictionary import DICTIONARY_FRAME, read_archives, write_archives

SCHEMA = "page_id long, url string, html string, digest string, payload string"
ROWS = [
    (1, "http://a/1", "same body", "x", "y"),
    (9, "http://a/9", "same body", "x", "y"),
    (4, None, "same body", "x", "y"),
    (9, "http://a/9", "same body", "x", "y"),
    (None, "http://a/n", "same body", "x", "y"),
    (2, "http://a/é %41\r\nX: y", "ünïcode\r\n\r\nWARC/1.1\r\n", "x", "y"),
    (3, "http://a/3", None, "x", "y"),
    (5, "http://a/5", "", "x", "y"),
    (6, "http://a/6", "long " * 40_000, "x", "y"),
    (None, "http://a/m", "alone without id", "x", "y"),
]


def expected(rows, min_payload=0):
    last = {}
    for page_id, _, html, *_ in rows:
        if page_id is not None:
            last[html or ""] = max(last.get(html or "", page_id), page_id)
    out = []
    for page_id, url, html, *_ in rows:
        body = html or ""
        raw = body.encode()
        keeps = last.get(body)
        revisit = len(raw) >= min_payload and keeps is not None and page_id != keeps
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page_id, url, len(raw), digest, "revisit" if revisit else "response", keeps if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("archive_bytes,min_payload", [(1, 0), (300, 1), (1 << 24, 6)])
def test_round_trip(spark, tmp_path, archive_bytes, min_payload):
    path = f"file://{tmp_path}/warc"
    write_archives(spark.createDataFrame(ROWS, SCHEMA), path, min_payload=min_payload, archive_bytes=archive_bytes)
    records = read_archives(spark, path).collect()
    got = [(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records]
    assert sorted(got, key=str) == expected(ROWS, min_payload)
    bodies = {(html or "").encode() for _, _, html, *_ in ROWS}
    assert {bytes(r.payload) for r in records if r.record_type == "response"} == bodies
    assert all(r.payload is None for r in records if r.record_type == "revisit")


def test_dictionary_leads_and_frames_stand_alone(spark, tmp_path):
    rows = [(i, f"http://a/{i}", f"<html><body><p>record {i} of the archive {i * 7}</p></body></html>") for i in range(400)]
    path = f"file://{tmp_path}/warc"
    write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    found = 0
    for row in read_blobs(spark, path).collect():
        content = bytes(row["content"])
        kind, size = struct.unpack_from("<II", content)
        assert kind == DICTIONARY_FRAME
        unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content[8 : 8 + size]))
        rest = content[8 + size :]
        while len(rest) > 8:  # the empty frame that ends the file
            frame = unpacker.decompressobj()
            assert frame.decompress(rest).startswith(b"WARC/1.1\r\n")
            rest = frame.unused_data
            found += 1
        with pytest.raises(zstandard.ZstdError):
            zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content[8 + size :])).read()
    assert found == 400


def test_empty_table(spark, tmp_path):
    path = f"file://{tmp_path}/warc"
    write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert read_archives(spark, path).count() == 0
