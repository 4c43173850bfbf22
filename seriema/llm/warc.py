"""Web archives: pages as WARC records, and their reassembly from segments.

Writing: a page is a response record with the payload in chunked transfer framing, or, if an equal payload
belongs to a page with a smaller id, a revisit record that refers to that response. Records longer than
``SEGMENT`` are split into a first segment and continuation records. Files are written by Spark's text
writer, one per task, gzipped, with the empty lines that end a record as separator.

Reading: every file is parsed by the lengths in its headers. Continuation records are grouped by the
identifier of their origin, wherever they lie, ordered by segment number, checked against the total
length, and the framing of the whole is decoded. Only segmented bodies are shuffled. A record that does
not fit its length or digest raises an error.

Defined cases: a NULL page is an empty payload; a NULL page_id is archived without one and, if all pages
with its payload have none, is a response; rows that repeat id and payload, wherever they lie, are a response
or revisit each, with identifiers of their own;
equal ids with different payloads are different records; a NULL url has no target; control characters
in a url are percent-encoded; an empty table gives an empty archive. Extra columns do not take part.
"""

from __future__ import annotations

import re
import zlib
from base64 import b32encode
from hashlib import sha1
from uuid import NAMESPACE_URL, uuid5

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage

#: Bytes of a record's block from which it is split, and of a transfer chunk.
SEGMENT, CHUNK = 16_384, 4_096
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
#: What ends a record.
END = "\r\n\r\n"


def base32_sha1(payload: bytes) -> str:
    return b32encode(sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = [payload[a:a + size] for a in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(body[line + 2:line + 2 + size])
        at = line + 2 + size
        if len(out[-1]) != size or body[at:at + 2] != b"\r\n":
            raise ValueError("a transfer chunk does not have its length")
        at += 2


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block


def record_id(page_id: object, digest: str, nth: str = "") -> str:
    return f"<urn:uuid:{uuid5(NAMESPACE_URL, f'{page_id}/{digest}{nth}')}>"


def records(page_id, url: str | None, payload: bytes, digest: str, refers_to, is_copy: bool, nth: str, segment: int) -> list[bytes]:
    """The record of a page, or its segments."""
    own = record_id(page_id, digest, nth)
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else None
    known = [("WARC-Date", DATE), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Page-ID", page_id)]
    if is_copy:
        return [record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), ("WARC-Profile", PROFILE),
                        ("WARC-Refers-To", record_id(refers_to, digest)), *known], HTTP)]
    block = HTTP + chunked(payload)
    first = [("WARC-Type", "response"), ("WARC-Record-ID", own), *known]
    if len(block) <= segment:
        return [record(first, block)]
    parts = [block[a:a + segment] for a in range(0, len(block), segment)]
    out = [record([*first, ("WARC-Segment-Number", 1)], parts[0])]
    for k, part in enumerate(parts[1:], 2):
        total = len(block) if k == len(parts) else None
        out.append(record([
            ("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(page_id, digest, f"{nth}/{k}")), ("WARC-Date", DATE),
            ("WARC-Target-URI", target), ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", k),
            ("WARC-Segment-Total-Length", total),
        ], part))
    return out


def write(pages: DataFrame, path: str, segment: int = SEGMENT) -> None:
    """Archives ``pages`` (page_id, url, html) below ``path``."""
    pages = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    pages = pages.withColumn("sha1", F.sha1("payload"))
    # Digests and ids only: the pages with one payload may be a third of all.
    ids = pages.groupBy("page_id", "sha1").agg(F.count("*").alias("n"))
    least = ids.groupBy("sha1").agg(F.min("page_id").alias("first"))
    own = F.col("page_id").eqNullSafe(F.col("first"))
    # Pages without a copy need no entry; the rest is joined by id, so that no payload gathers its pages.
    marks = ids.join(least, "sha1").where(~own | (F.col("n") > 1)).select(
        F.col("page_id").alias("c_id"), F.col("sha1").alias("c_sha1"), F.when(~own, F.col("first")).alias("first"), (F.col("n") > 1).alias("repeated"))
    marks = stage(marks, "warc-marks")
    joined = pages.join(marks, F.col("page_id").eqNullSafe(F.col("c_id")) & (F.col("sha1") == F.col("c_sha1")), "left")
    joined = joined.withColumn("repeated", F.coalesce("repeated", F.lit(False)))
    columns = ["page_id", "url", "payload", "first", "nth"]
    rows = joined.withColumn("nth", F.lit("")).select(columns)
    if not marks.where("repeated").isEmpty():
        # Rows with equal ids and payloads may lie in any tasks. Their numbers are staged with them, so that they stay
        # the same, and one row of them all keeps the plain id, to which revisits refer.
        again = stage(joined.where("repeated").withColumn("place", F.monotonically_increasing_id()), "warc-repeated")
        plain = again.groupBy("page_id", "sha1").agg(F.min("place").alias("place")).select("place", F.lit("").alias("plain"))
        nth = F.coalesce("plain", F.concat(F.lit("#"), F.col("place").cast("string"))).alias("nth")
        again = again.join(plain, "place", "left").select(*columns[:-1], nth)
        rows = joined.where("NOT repeated").withColumn("nth", F.lit("")).select(columns).unionAll(again)

    def lay_out(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                digest = base32_sha1(row["payload"])
                out += records(row["page_id"], row["url"], row["payload"], digest, row["first"], row["first"] is not None, row["nth"], segment)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    rows.mapInArrow(lay_out, "record binary").select(F.col("record").cast("string").alias("value")).write.option(
        "lineSep", END).option("compression", "gzip").text(path)


def parsed(data: bytes):
    """(headers in lower case, block) of each record of a file; gzip members are opened."""
    while data[:2] == b"\x1f\x8b":
        plain = []
        while data:
            member = zlib.decompressobj(31)
            plain.append(member.decompress(data))
            data = member.unused_data
        data = b"".join(plain)
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record begins at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(fields["content-length"])
        block = data[end + 4:end + 4 + size]
        if len(block) != size or data[end + 4 + size:end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not have its length")
        yield fields, block
        at = end + 8 + size


def payload_of(block: bytes) -> bytes:
    """What an HTTP response carries."""
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked", head) else body


def opened(block: bytes, digest: str | None) -> tuple[bytes, str]:
    payload = payload_of(block)
    found = base32_sha1(payload)
    if digest and digest != found:
        raise ValueError(f"payload digest {found} is not {digest}")
    return payload, found


def read(spark: SparkSession, path: str, keep_payload: bool = False) -> DataFrame:
    """(record_id, record_type, page_id string, payload_digest, payload_bytes, refers_to_id[, payload])
    for every response and revisit below ``path``, segments put together."""
    def parse(batches):
        for batch in batches:
            for data in batch.column("content"):
                rows = {k: [] for k in ("origin", "segment", "total", "type", "page_id", "digest", "refers", "n", "block")}
                for f, block in parsed(data.as_py()):
                    kind = f["warc-type"]
                    if kind not in ("response", "revisit", "continuation"):
                        continue
                    number = f.get("warc-segment-number")
                    digest = f.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    size = None
                    if number is None and kind == "response":
                        payload, digest = opened(block, digest)
                        size, block = len(payload), payload if keep_payload else None
                    values = (
                        f.get("warc-segment-origin-id", f["warc-record-id"]), int(number or 0),
                        int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None, kind,
                        f.get("warc-page-id"), digest, f.get("warc-refers-to"), size, block if kind != "revisit" else None,
                    )
                    for column, value in zip(rows.values(), values):
                        column.append(value)
                yield pa.RecordBatch.from_pydict({
                    k: pa.array(v, pa.int32() if k == "segment" else pa.int64() if k in ("total", "n") else pa.binary() if k == "block" else pa.string())
                    for k, v in rows.items()})

    def join(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                parts = row["parts"]
                head = parts[0]
                digest, size, payload = head["digest"], head["n"], head["block"]
                if head["segment"]:
                    block = b"".join(p["block"] for p in parts)
                    total = parts[-1]["total"]
                    if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)) or total != len(block):
                        raise ValueError(f"segments of {row['origin']} do not make up {total} bytes")
                    payload, digest = opened(block, digest)
                    size = len(payload)
                out.append((row["origin"], head["type"], head["page_id"], digest, size, head["refers"], payload if keep_payload else None))
            columns = list(zip(*out)) if out else [()] * 7
            kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]
            names = ["record_id", "record_type", "page_id", "payload_digest", "payload_bytes", "refers_to_id", "payload"]
            width = 7 if keep_payload else 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns[:width], kinds)], names=names[:width])

    files = spark.read.format("binaryFile").load(path).select("content")
    rows = files.mapInArrow(parse, "origin string, segment int, total long, type string, page_id string, digest string, refers string, n long, block binary")
    # A group is one record: as many rows as it has segments.
    whole = rows.groupBy("origin").agg(F.array_sort(F.collect_list(
        F.struct("segment", "total", "type", "page_id", "digest", "refers", "n", "block"))).alias("parts"))
    schema = "record_id string, record_type string, page_id string, payload_digest string, payload_bytes long, refers_to_id string"
    return whole.mapInArrow(join, schema + (", payload binary" if keep_payload else ""))


def catalogued(found: DataFrame, id_type: str = "bigint") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): revisits with their response's figures."""
    responses = found.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("r_page"), F.col("payload_bytes").alias("r_bytes"))
    out = found.join(responses, "refers_to_id", "left")
    revisit = F.col("record_type") == "revisit"
    return out.select(
        F.col("page_id").cast(id_type).alias("page_id"),
        F.when(revisit, F.col("r_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"), "payload_digest", "record_type",
        F.when(revisit, F.col("r_page")).cast(id_type).alias("refers_to"),
    )
