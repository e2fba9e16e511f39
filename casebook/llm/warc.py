"""A content-addressed WARC archive.

Each distinct payload is stored once, in the response record of the smallest
page id that has it; all other captures are revisit records without payload.
Payloads are told apart by SHA-256 and length.  Next to the WARC files, the
archive holds the exact header block of every record as a table, so headers are
read without touching payloads, and original records come back by joining
headers to payloads.

Records are written as gzipped text files whose line separator is the blank
line that ends a WARC record.  Records are dealt to files by a hash of their
payload, to as many files at least as the archive has ``FILE_BYTES``, so a file is
about that long at most, or as its largest record.  Reading inflates a file piece
by piece and holds one record at a time.

Defined cases: NULL html counts as empty; payloads below ``min_bytes`` are
always responses; of rows that repeat in id and payload the first is the
response and the others revisit it; NULL ids come after all others; line breaks
in a URL are percent-encoded and a NULL URL becomes a URN; an empty table gives
an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from casebook.llm.common import joined_back

#: Bytes of the records of one file, before compression and on average.
FILE_BYTES = 64 << 20
#: Compressed bytes that one step of reading inflates.
STEP = 1 << 16
#: Capture time of records whose table has none.
DATE = "1970-01-01T00:00:00Z"
BREAK = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(hex_digits: Column) -> Column:
    """The base32 form of 40 hexadecimal digits: four characters for every five."""
    part = lambda i: F.lpad(F.conv(F.substring(hex_digits, 5 * i + 1, 5), 16, 32), 4, "0")
    return F.translate(F.concat(*map(part, range(8))), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(page: Column, sha256: Column, nth: Column) -> Column:
    h = F.md5(F.concat_ws(":", F.coalesce(page.cast("string"), F.lit("none")), sha256,
                          nth.cast("string")))
    return F.concat_ws("-", *(F.substring(h, a, n) for a, n in (
        (1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


def headers(pages: DataFrame, min_bytes: int = 0, date: str = DATE) -> DataFrame:
    """A row per capture: its record's type, ids, digests and exact header block."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.sha2(payload, 256).alias("sha256"), base32(F.sha1(payload)).alias("sha1"),
        F.octet_length(payload).cast("bigint").alias("bytes"))
    nth = F.row_number().over(Window.partitionBy("sha256", "bytes", "page_id").orderBy("url"))
    rows = rows.withColumn("nth", nth)
    first = rows.groupBy("sha256", "bytes").agg(F.min("page_id").alias("first_id"))
    rows = joined_back(rows, first, "sha256", "bytes")
    lead = F.col("page_id").eqNullSafe(F.col("first_id")) & (F.col("nth") == 1)
    response = lead | (F.col("bytes") < min_bytes)
    uri = F.coalesce(F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"),
                     F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none"))))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}"
                          f"Content-Length: "), F.col("bytes").cast("string"), F.lit(BREAK * 2))
    length = F.octet_length(http) + F.when(response, F.col("bytes")).otherwise(0)
    own_id = _record_id(F.col("page_id"), F.col("sha256"), F.col("nth"))
    first_id = _record_id(F.col("first_id"), F.col("sha256"), F.lit(1))
    fields = [("WARC-Type", F.when(response, "response").otherwise("revisit")),
              ("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), own_id, F.lit(">"))),
              ("WARC-Date", F.lit(date)), ("WARC-Target-URI", uri),
              ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
              ("X-Payload-SHA256", F.col("sha256")),
              ("X-Page-ID", F.coalesce(F.col("page_id").cast("string"), F.lit("")))]
    only = [("WARC-Profile", F.lit(PROFILE)),
            ("WARC-Refers-To", F.concat(F.lit("<urn:uuid:"), first_id, F.lit(">"))),
            ("X-Refers-To-Page-ID", F.coalesce(F.col("first_id").cast("string"), F.lit("")))]
    tail = [("Content-Type", F.lit("application/http; msgtype=response")),
            ("Content-Length", length.cast("string"))]

    def lines(pairs: list[tuple[str, Column]]) -> list[Column]:
        return [F.concat(F.lit(f"{k}: "), v, F.lit(BREAK)) for k, v in pairs]

    head = F.concat(F.lit(f"WARC/1.1{BREAK}"), *lines(fields),
                    F.when(response, "").otherwise(F.concat(*lines(only))), *lines(tail),
                    F.lit(BREAK), http)
    return rows.select("page_id", "url", "sha256", "sha1", "bytes", "nth",
                       F.when(response, "response").otherwise("revisit").alias("record_type"),
                       F.when(~response, F.col("first_id")).alias("refers_to"),
                       own_id.alias("record_id"), head.alias("header"))


@contextmanager
def _partitions(spark: SparkSession, least: int) -> Iterator[None]:
    """Shuffles of so many partitions at least, none of which Spark merges."""
    count = "spark.sql.shuffle.partitions"
    settings = {count: str(max(least, int(spark.conf.get(count)))) if least > 1 else spark.conf.get(count),
                "spark.sql.adaptive.coalescePartitions.enabled": "false" if least > 1 else "true"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write(pages: DataFrame, path: str, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as an archive under ``path``."""
    spark = pages.sparkSession
    headers(pages, min_bytes).write.parquet(f"{path}/headers")
    index = spark.read.parquet(f"{path}/headers")
    text = F.coalesce(F.col("html").cast("string"), F.lit(""))
    payloads = (pages.select(F.sha2(text.cast("binary"), 256).alias("sha256"),
                             F.octet_length(text).cast("bigint").alias("bytes"), text.alias("payload"))
                .dropDuplicates(["sha256", "bytes"]))
    full = index.where("record_type = 'response'").select("sha256", "bytes", "header")
    records = payloads.join(full, ["sha256", "bytes"]).select(F.concat("header", "payload").alias("value"))
    records = records.union(index.where("record_type = 'revisit'").select("header"))
    size = F.octet_length("header") + F.when(F.col("record_type") == "response", F.col("bytes")).otherwise(0)
    total = index.agg(F.sum(size)).first()[0] or 0
    with _partitions(spark, -(-total // file_bytes)):
        (records.write.option("lineSep", BREAK * 2).option("compression", "gzip").text(f"{path}/warc"))


def inflated(data: bytes) -> Iterator[bytes]:
    """The content of gzip members that follow each other, piece by piece."""
    left = memoryview(data)
    while len(left):
        member, at = zlib.decompressobj(wbits=31), 0
        while at < len(left) and not member.eof:
            piece = member.decompress(left[at:at + STEP])
            at += STEP
            if piece:
                yield piece
        if not member.eof:
            raise ValueError("a file ends within a compressed record")
        left = left[min(at, len(left)) - len(member.unused_data):]


def parse(data: bytes | Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """(fields, header block, block) of every record of a file's bytes, one at a time."""
    pieces = iter([data] if isinstance(data, bytes) else data)
    held, at = bytearray(), 0

    def more() -> bool:
        nonlocal held, at
        piece = next(pieces, None)
        if piece is None:
            return False
        if at > len(held) // 2:
            del held[:at]
            at = 0
        held += piece
        return True

    nth = 0
    while at < len(held) or more():
        searched = at
        while (end := held.find(b"\r\n\r\n", searched)) < 0:
            back = max(0, len(held) - at - 3)
            if not more():
                raise ValueError(f"record {nth} has no end of its header")
            searched = at + back
        if not held.startswith(b"WARC/1.1\r\n", at):
            raise ValueError(f"no record at record {nth}")
        head = bytes(held[at:end + 4])
        fields = {}
        for line in head[:-4].decode().split(BREAK)[1:]:
            name, _, value = line.partition(": ")
            fields[name] = value
        at, size = end + 4, int(fields["Content-Length"])
        while len(held) - at < size + 4 and more():
            pass
        if held[at + size:at + size + 4] != b"\r\n\r\n":
            raise ValueError(f"record {nth} does not end where its length says")
        yield fields, head, bytes(held[at:at + size])
        at += size + 4
        nth += 1


READ = ("page_id bigint, url string, record_type string, record_id string, refers_to_id string, "
        "refers_to bigint, payload_digest string, payload_bytes bigint, header binary")


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of an archive's WARC files, with verified digests.

    ``payload_bytes`` and ``payload`` (on request) are NULL for revisits.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.gz")
             .load(f"{path}/warc").select("content"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                            ("record_id", pa.string()), ("refers_to_id", pa.string()),
                            ("refers_to", pa.int64()), ("payload_digest", pa.string()),
                            ("payload_bytes", pa.int64()), ("header", pa.binary())]
                           + [("payload", pa.binary())] * payloads)
        for batch in batches:
            for content in batch.column(0):
                out, size = [], 0
                for fields, head, block in parse(inflated(content.as_py())):
                    http = block.index(b"\r\n\r\n") + 4
                    body = block[http:] if fields["WARC-Type"] == "response" else None
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if body is not None and (
                            base64.b32encode(hashlib.sha1(body).digest()).decode() != digest
                            or hashlib.sha256(body).hexdigest() != fields["X-Payload-SHA256"]):
                        raise ValueError(f"{fields['WARC-Record-ID']} has another payload")
                    ref = fields.get("X-Refers-To-Page-ID")
                    out.append((int(fields["X-Page-ID"]) if fields["X-Page-ID"] else None,
                                fields["WARC-Target-URI"], fields["WARC-Type"],
                                fields["WARC-Record-ID"], fields.get("WARC-Refers-To"),
                                int(ref) if ref else None, digest,
                                None if body is None else len(body), head + block[:http],
                                *([body] * payloads)))
                    size += len(block) if payloads else 400
                    if size > 1 << 24:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return files.mapInArrow(rows, READ + (", payload binary" if payloads else ""))


def restore(records: DataFrame) -> DataFrame:
    """``records`` with the payload columns of revisits filled in from their responses."""
    filled = [c for c in ("payload_bytes", "payload") if c in records.columns]
    held = records.where("record_type = 'response'").select(
        F.col("record_id").alias("_record"), *(F.col(c).alias(f"_{c}") for c in filled))
    joined = records.join(held, F.coalesce("refers_to_id", "record_id") == F.col("_record"), "left")
    return joined.withColumns({c: F.col(f"_{c}") for c in filled}).drop(
        "_record", *(f"_{c}" for c in filled))
