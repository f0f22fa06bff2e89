"""WARC archives compressed record by record with an embedded Zstandard dictionary.

An archive is a ``.warc.zst`` file: a skippable frame that holds the dictionary
trained from the archive's own records, then one Zstandard frame per record.
Any record can be read alone with the dictionary and its frame.

Records whose payloads are equal are written once: the one with the largest
page id as ``response``, the others as ``revisit`` records that refer to it.

Defined results
- a null ``html`` is the empty payload; a null ``url`` leaves the target URI out;
- a null ``page_id`` never becomes what others refer to; if all pages of a
  payload have a null id, all are ``response``;
- rows that repeat the largest page id of a payload are all ``response``;
- an empty table gives no archive, and reads back as no rows;
- other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.llm.blobs import read_blobs, write_blobs

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
ENDING = "P*M\x18\x00\x00\x00\x00"  # an empty skippable frame, 0x184D2A50
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORD_SCHEMA = (
    "page_id long, url string, record_type string, payload binary, payload_bytes long, "
    "payload_digest string, refers_to long"
)


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: five hex digits are four base32 digits."""
    digest = F.sha1(payload.cast("binary"))
    groups = [
        F.translate(F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0"), HEX32, BASE32)
        for i in range(8)
    ]
    return F.concat(*groups)


def mark_revisits(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """Pages with ``payload``, ``digest``, ``record_type`` and ``refers_to``.

    Payloads shorter than ``min_payload`` bytes are never revisits.  Only the
    digests that occur more than once reach the join, as the build side of a
    shuffled hash join, so payloads are shuffled once and never sorted.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    ).withColumn("digest", sha1_base32(F.col("payload")))
    shared = (
        rows.where(F.octet_length("payload") >= min_payload)
        .groupBy("digest")
        .agg(F.max("page_id").alias("kept_id"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("digest", "kept_id")
    )
    revisit = F.col("kept_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept_id"))
    return rows.join(shared.hint("shuffle_hash"), "digest", "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("kept_id")).alias("refers_to"),
    )


def write_archives(
    pages: DataFrame,
    path: str,
    min_payload: int = 0,
    archive_bytes: int = 16 << 20,
    dictionary_bytes: int = 64 << 10,
    sample_bytes: int = 2 << 20,
    level: int = 3,
    date: str = "2020-01-01T00:00:00Z",
) -> None:
    """Write ``pages(page_id, url, html)`` as archives of about ``archive_bytes``.

    The dictionary of an archive is fitted on records spread evenly over it,
    ``sample_bytes`` of them at most; an archive too small to train one has
    none, and its frames stand alone.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        records: list[bytes] = []
        held = 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                records.append(_record(row, date))
                held += len(records[-1])
                if held >= archive_bytes:
                    yield pd.DataFrame({"content": [_archive(records, dictionary_bytes, sample_bytes, level)]})
                    records, held = [], 0
        if records:
            yield pd.DataFrame({"content": [_archive(records, dictionary_bytes, sample_bytes, level)]})

    marked = mark_revisits(pages, min_payload)
    # ids as text: pandas would turn nullable longs into doubles
    packed = marked.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    write_blobs(packed.mapInPandas(pack, "content binary"), path, ENDING)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives under ``path``.

    Length and digest of a response come from its payload, those of a revisit
    from its own headers.  ``payloads=False`` leaves ``payload`` null.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in RECORD_SCHEMA.split(", ")]
        for batch in batches:
            for content in batch["content"]:
                rows, held = [], 0
                for record in _records(content):
                    held += len(record[3] or b"")
                    rows.append(record if payloads else (*record[:3], None, *record[4:]))
                    if held >= 8 << 20:
                        yield _frame(rows, names)
                        rows, held = [], 0
                if rows:
                    yield _frame(rows, names)

    return read_blobs(spark, path).select("content").mapInPandas(parse, RECORD_SCHEMA)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def _record(row, date: str) -> bytes:
    payload = row.payload.encode()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if row.record_type == "response" else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {row.record_type}",
        f"WARC-Record-ID: {_urn(row.page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{row.digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if row.url is not None:
        # control characters, spaces and % would not survive a header line
        head.append("WARC-Target-URI: " + quote(row.url, safe="!#$&'()*+,/:;=?@[]~"))
    if row.record_type == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_urn(row.refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _urn(page_id: str | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _archive(records: list[bytes], dictionary_bytes: int, sample_bytes: int, level: int) -> bytes:
    total = sum(map(len, records))
    step = max(1, -(-total // sample_bytes))
    samples = [r[: 128 << 10] for r in records[::step]]
    try:
        trained = zstandard.train_dictionary(min(dictionary_bytes, max(256, total // 32)), samples)
    except zstandard.ZstdError:
        trained = None
    head = b""
    if trained is not None:
        head = struct.pack("<II", DICTIONARY_FRAME, len(trained.as_bytes())) + trained.as_bytes()
    packer = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True)
    return head + b"".join(map(packer.compress, records))


def _records(content: bytes) -> Iterator[tuple]:
    trained, start = None, 0
    kind, size = struct.unpack_from("<II", content)
    if kind == DICTIONARY_FRAME:
        start = 8 + size
        trained = zstandard.ZstdCompressionDict(content[8:start])
    unpacker = zstandard.ZstdDecompressor(dict_data=trained)
    source = io.BytesIO(content)
    source.seek(start)
    stream = io.BufferedReader(unpacker.stream_reader(source, read_across_frames=True), 1 << 20)
    while stream.readline():
        head = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(": ")
            head[name] = value
        block = stream.read(int(head["Content-Length"]))
        stream.read(4)
        yield _parsed(head, block)


def _parsed(head: dict[str, str], block: bytes) -> tuple:
    http, _, body = block.partition(b"\r\n\r\n")
    url = head.get("WARC-Target-URI")
    response = head["WARC-Type"] == "response"
    if response:
        size, digest = len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()
    else:
        lengths = (x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))
        size, digest = int(next(lengths)[16:]), head["WARC-Payload-Digest"].removeprefix("sha1:")
    return (
        _page_id(head["WARC-Record-ID"]),
        None if url is None else unquote(url),
        head["WARC-Type"],
        body if response else None,
        size,
        digest,
        None if response else _page_id(head["WARC-Refers-To"]),
    )


def _page_id(urn: str) -> int | None:
    text = urn[len("<urn:x-page:") : -1]
    return int(text) if text else None
