"""WARC archives: writing, and reading with segment reassembly.

A page becomes a ``response`` record whose block is an HTTP message with a chunked body, or, when its payload
equals that of another page, a ``revisit`` of it. A block longer than a segment is cut: the first part is the
record, the others are ``continuation`` records that name its id, their number and, in the last, the total length.
Reading groups continuations by the record they continue, orders them by number, verifies the total length,
takes the chunks off the body and verifies the digest.

Archives go through Spark's own writer and reader, so any file system that Spark knows will do.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.llm.common import stored
from flowlab.session import fresh_folder

VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"  # one date for all, so that equal tables give equal archives
SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
RECORDS_PER_FILE = 5_000
# Equal payloads up to this many digests are sent to all tasks; more are joined.
BROADCAST_DIGESTS = 500_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(row: object, segment: int = 1) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'row:{row}#{segment}')}>"


def pieces(data: bytes, size: int) -> Iterator[bytes]:
    """Cuts of at most ``size`` bytes, none inside a UTF-8 character (so files stay text)."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[at:end]
        at = end


def chunked(payload: bytes) -> bytes:
    return b"".join(b"%X\r\n%s\r\n" % (len(p), p) for p in pieces(payload, CHUNK_BYTES)) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """Body of a message in chunked framing; framing that does not fit is an error."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        n = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if not n:
            return b"".join(out)
        if body[at + n:at + n + 2] != b"\r\n":
            raise ValueError("a chunk is longer or shorter than it says")
        out.append(body[at:at + n])
        at += n + 2


def _record(headers: dict[str, str], block: bytes) -> str:
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines) + block.decode()


def page_records(row: object, page: int | None, url: str, payload: bytes, refers_to: int | None,
                 refers_to_url: str | None = None) -> Iterator[str]:
    """Records of one page, without the blank lines after each. ``row`` tells it from all other rows, also from those
    of the same page."""
    digest = base32_sha1(payload)
    common = {"WARC-Date": DATE, "WARC-Target-URI": url, "X-Page-Id": "" if page is None else str(page),
              "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http; msgtype=response"}
    if refers_to is not None:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
        yield _record({"WARC-Type": "revisit", "WARC-Record-ID": record_id(row), **common,
                       "WARC-Profile": PROFILE, "WARC-Refers-To-Target-URI": refers_to_url or url,
                       "WARC-Refers-To-Date": DATE, "X-Refers-To-Page": str(refers_to)}, block.encode())
        return
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    block = head + chunked(payload)
    parts = list(pieces(block, SEGMENT_BYTES))
    many = {"WARC-Segment-Number": "1"} if len(parts) > 1 else {}
    yield _record({"WARC-Type": "response", "WARC-Record-ID": record_id(row), **common, **many}, parts[0])
    for n, part in enumerate(parts[1:], 2):
        last = {"WARC-Segment-Total-Length": str(len(block))} if n == len(parts) else {}
        yield _record({"WARC-Type": "continuation", "WARC-Record-ID": record_id(row, n), "WARC-Date": DATE,
                       "WARC-Target-URI": url, "WARC-Segment-Origin-ID": record_id(row),
                       "WARC-Segment-Number": str(n), **last}, part)


def write_pages(pages: DataFrame, path: str, least_bytes: int = 0, key: str = "page_id", url: str = "url",
                html: str = "html") -> None:
    """Write a record per page below ``path``.

    Of pages with equal payloads of ``least_bytes`` or more, the one with the largest key is the response and the
    others revisit it; smaller payloads are all responses. A null payload is empty, a null url is
    ``about:blank``. Null keys and rows that repeat a key stay responses unless another key is larger. An empty
    table writes no record. Other columns are not read. Record ids are made of the page, its digest and the row's place
    in its partition, so no two rows share one.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).cast("bigint").alias("page"), F.coalesce(F.col(url), F.lit("about:blank")).alias("url"),
                        body.alias("html"), F.sha1(body.cast("binary")).alias("digest"))
    large = F.octet_length("html") >= least_bytes
    shared = stored(rows.filter(large).groupBy("digest").agg(F.max(F.struct("page", "url")).alias("_last"), F.count("*").alias("n"))
                    .select("digest", F.col("_last.page").alias("latest"), F.col("_last.url").alias("latest_url"), "n")
                    .filter("n > 1 and latest is not null").drop("n"), "payloads")
    near = F.broadcast(shared) if shared.count() <= BROADCAST_DIGESTS else shared
    revisit = F.when(large & F.col("page").isNotNull() & (F.col("page") < F.col("latest")), F.col("latest"))
    roles = rows.join(near, "digest", "left").select("page", "url", "html", "digest", revisit.alias("refers_to"), "latest_url")

    def one_line(address: str | None) -> str | None:
        return address and address.replace("\r", "%0D").replace("\n", "%0A")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            out = []
            for page, address, text, digest, refers_to, target in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row = f"{page}/{digest}/{part}/{place}"
                out.extend(page_records(row, page, one_line(address), text.encode(), refers_to, one_line(target)))
                place += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    (roles.mapInArrow(records, "value string").write.option("lineSep", "\r\n\r\n")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).option("compression", "gzip").text(path))


def unpacked(data: bytes) -> bytes:
    """All members of a gzip file; other data as they are."""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        if not member.eof:
            raise ValueError("an archive ends inside a gzip member")
        data = member.unused_data
    return b"".join([*out, data])


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record starts at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start = end + 4
        at = start + int(headers["content-length"])
        if data[at:at + 4] != b"\r\n\r\n":
            raise ValueError("a record is longer or shorter than it says")
        yield headers, data[start:at]
        at += 4


RECORD = ("record_id string, origin string, segment int, total bigint, type string, url string, page string, "
          "digest string, refers_to string, block binary")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``, continuations and records of any type among them. Files may be
    plain or gzip, of one member or of a member per record; files whose names start with a point or underscore are
    no archives."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record_id", pa.string()), ("origin", pa.string()), ("segment", pa.int32()),
                            ("total", pa.int64()), ("type", pa.string()), ("url", pa.string()), ("page", pa.string()),
                            ("digest", pa.string()), ("refers_to", pa.string()), ("block", pa.binary())])
        for batch in batches:
            for packed in batch.column(0):
                data = packed.as_py()
                rows = [{"record_id": h.get("warc-record-id"), "origin": h.get("warc-segment-origin-id"),
                         "segment": int(h["warc-segment-number"]) if "warc-segment-number" in h else None,
                         "total": int(h["warc-segment-total-length"]) if "warc-segment-total-length" in h else None,
                         "type": h["warc-type"], "url": h.get("warc-target-uri"), "page": h.get("x-page-id"),
                         "digest": h.get("warc-payload-digest"), "refers_to": h.get("x-refers-to-page"), "block": block}
                        for h, block in parse_records(unpacked(data))]
                for start in range(0, len(rows), 1000):
                    yield pa.RecordBatch.from_pylist(rows[start:start + 1000], schema=schema)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(parse, RECORD)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per page of the archives: page_id, url, payload_bytes, payload_digest, record_type, refers_to,
    payload (null for a revisit).

    Responses in chunked framing or with a plain body are payloads, checked against their digest if it has one (SHA-1 in
    base32); other types than response and revisit (and their segments) are passed over. Missing or repeated segments,
    lengths that do not add up and payloads that do not fit their digest are errors.
    Only cut records are shuffled, by their origin, so each group is one page.
    """
    records = stored(read_records(spark, path), "records")
    cut = records.filter("segment is not null").withColumn("_origin", F.coalesce("origin", "record_id"))
    first = lambda name: F.max(F.when(F.col("segment") == 1, F.col(name))).alias(name)
    joined = cut.groupBy("_origin").agg(
        *[first(c) for c in ("type", "url", "page", "digest", "refers_to")],
        F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("_parts"))
    numbers = F.transform("_parts", lambda p: p["segment"])
    block = F.array_join(F.transform("_parts", lambda p: p["block"].cast("string")), "").cast("binary")
    whole = (joined.withColumn("block", block)
             .withColumn("block", _checked((numbers == F.sequence(F.lit(1), F.size("_parts")))
                                           & (F.octet_length("block") == F.col("total")), F.col("block"))))
    columns = ["type", "url", "page", "digest", "refers_to", "block"]
    pages = records.filter("segment is null").select(*columns).unionByName(whole.select(*columns)).filter(
        F.col("type").isin("response", "revisit"))

    @F.arrow_udf("struct<n:bigint,payload:binary>")
    def payload(blocks: pa.Array, digests: pa.Array, types: pa.Array) -> pa.Array:
        sizes, payloads = [], []
        for value, digest, kind in zip(blocks, digests.to_pylist(), types.to_pylist(), strict=True):
            head, _, body = value.as_py().partition(b"\r\n\r\n")
            fields = dict(line.lower().split(b":", 1) for line in head.split(b"\r\n")[1:] if b":" in line)
            if kind == "revisit":  # the headers of the message without its body
                length = fields.get(b"content-length")
                sizes.append(None if length is None else int(length))
                payloads.append(None)
                continue
            data = dechunked(body) if fields.get(b"transfer-encoding", b"").strip() == b"chunked" else body
            if (digest or "").startswith("sha1:") and digest != f"sha1:{base32_sha1(data)}":
                raise ValueError("a payload does not fit its digest")
            sizes.append(len(data))
            payloads.append(data)
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(payloads, pa.binary())], ["n", "payload"])

    return (pages.withColumn("_p", payload("block", "digest", "type"))
            .select(F.when(F.col("page") != "", F.col("page")).cast("bigint").alias("page_id"), "url",
                    F.col("_p.n").alias("payload_bytes"), F.substring_index("digest", ":", -1).alias("payload_digest"),
                    F.col("type").alias("record_type"), F.col("refers_to").cast("bigint").alias("refers_to"),
                    F.col("_p.payload").alias("payload")))


def _checked(right: Column, value: Column) -> Column:
    return F.when(F.coalesce(right, F.lit(False)), value).otherwise(
        F.raise_error(F.lit("segments of a record are missing or do not add up")).cast("binary"))


def archive_and_read(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the pages to a new archive in the shared folder and read it back."""
    path = fresh_folder(pages.sparkSession, "warc")
    write_pages(pages, path, least_bytes)
    return read_pages(pages.sparkSession, path)
