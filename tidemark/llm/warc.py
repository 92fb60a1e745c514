"""WARC archives: writing with revisit records, reading, and resolving revisits."""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import written

# Payloads shorter than this are always written as responses.
LEAST_BYTES = 0
# Payload bytes per archive file, about; a file is read by one task.
ARCHIVE_BYTES = 32 << 20
# Bytes of payload in a batch of records that a reading task hands on.
BATCH_BYTES = 16 << 20

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
HTTP_TYPE = "application/http;msgtype=response"
END = "\r\n\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def payload_digest(payload: Column) -> Column:
    """SHA-1 in base 32: forty bits at a time, as digits of Spark's base 32, then renamed."""
    sha = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(sha, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _DIGITS, _BASE32)


def record_id(page_id: Column) -> Column:
    """A name-based record id."""
    h = F.md5(page_id.cast("string"))
    parts = [F.substring(h, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def page_records(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = LEAST_BYTES
) -> DataFrame:
    """One record per row: ``page_id``, ``url``, ``payload`` (null in revisits),
    ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``.

    Of equal payloads of at least ``least_bytes`` bytes the one with the smallest id is the
    response and the others revisit it; shorter ones are responses. A null payload is empty.
    Rows that repeat an id and its payload are alike, so each is a response if its page is.
    A null id is larger than any; where no row of a payload has an id, all are responses.

    Only headers are shuffled by digest, their minima combined before it; the payloads are
    dealt by id, so a payload that very many pages share is spread like any other.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit(""))
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        F.regexp_replace(F.col(f"`{url_col}`"), r"[\x00-\x20]+", "%20").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        payload_digest(payload).alias("payload_digest"),
    )
    heads = rows.select("page_id", "payload_bytes", "payload_digest")
    same = ["payload_digest", "payload_bytes"]
    # Written, so that the join has both sides straight from a shuffle and Spark can split the
    # headers of a payload that very many pages share.
    first = written(
        heads.groupBy(*same)
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("times"))
        .where(F.col("times") > 1)
    )
    revisits = (
        heads.join(first, same)
        .where((F.col("payload_bytes") >= least_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")))
        .select(F.struct("page_id", "payload_digest").alias("key"), F.col("first").alias("refers_to"))
        .distinct()
    )
    # As many partitions, and so files, as the payloads need, but no fewer than the session
    # joins by: a join raises a smaller number, and where Spark then finds that there is no
    # revisit and drops the join, it would deal the payloads once more.
    total = heads.agg(F.sum("payload_bytes")).first()[0] or 0
    files = max(-(-total // ARCHIVE_BYTES), int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = rows.withColumn("key", F.struct("page_id", "payload_digest")).repartition(files, "key")
    return keyed.join(revisits.repartition(files, "key"), "key", "left").select(
        "page_id",
        "url",
        F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
        "payload_bytes",
        "payload_digest",
        F.when(F.col("refers_to").isNull(), "response").otherwise("revisit").alias("record_type"),
        "refers_to",
    )


def write_archives(records: DataFrame, folder: str, *, created: str = "1970-01-01T00:00:00Z") -> None:
    """Writes records with fresh headers as compressed archives, one file per partition.

    A record is one string and ends with the two line ends that the format asks for, so
    Spark's text writer, with those as its separator, makes the files where the rows are.
    """
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    maybe = lambda name, value: F.coalesce(line(name, value), F.lit(""))
    block = F.concat(F.lit(HTTP_HEAD), F.coalesce(F.col("payload"), F.lit("")))
    revisit = F.col("record_type") == "revisit"
    record = F.concat(
        F.lit(VERSION + "\r\n"),
        line("WARC-Type", F.col("record_type")),
        maybe("WARC-Record-ID", record_id(F.col("page_id"))),
        F.lit(f"WARC-Date: {created}\r\n"),
        maybe("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", record_id(F.col("refers_to"))), F.lit(f"WARC-Profile: {PROFILE}\r\n"))).otherwise(""),
        maybe("Page-Id", F.col("page_id").cast("string")),
        F.lit(f"Content-Type: {HTTP_TYPE}\r\n"),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )
    records.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip").text(folder)


def _unpacked(data: bytes) -> io.BufferedReader:
    """The bytes of an archive, decompressed as they are read; plain archives pass through."""

    class Members(io.RawIOBase):
        def __init__(self) -> None:
            self.rest, self.member, self.ready = data, zlib.decompressobj(31), b""

        def readable(self) -> bool:
            return True

        def readinto(self, into) -> int:
            while not self.ready and self.rest:
                self.ready = self.member.decompress(self.rest, 1 << 20)
                self.rest = self.member.unconsumed_tail
                if self.member.eof:
                    self.rest, self.member = self.member.unused_data, zlib.decompressobj(31)
            part, self.ready = self.ready[: len(into)], self.ready[len(into) :]
            into[: len(part)] = part
            return len(part)

    return io.BufferedReader(Members() if data[:2] == b"\x1f\x8b" else io.BytesIO(data), 1 << 20)


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of one archive: header fields by lower-case name, and the block, whose
    length the header tells, so nothing inside a block can end it."""
    stream = _unpacked(data)
    while first := stream.readline():
        if not first.strip():
            continue
        if not first.startswith(b"WARC/"):
            raise ValueError("no record starts here")
        fields: dict[str, str] = {}
        while (text := stream.readline().rstrip(b"\r\n")):
            name, _, value = text.partition(b":")
            fields[name.strip().lower().decode()] = value.strip().decode()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("an archive ends inside a record")
        yield fields, block


RECORDS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("record_id", "record_type", "url", "page_id", "refers_to", "stated_digest", "payload_digest")]
    + [T.StructField("payload_bytes", T.LongType()), T.StructField("payload", T.BinaryType())]
)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives of a folder. ``payload_digest`` and ``payload_bytes`` are of
    the payload as read; revisits have neither, nor a payload. ``refers_to`` is a record id."""
    names = RECORDS.names
    schema = pa.schema([(n, pa.string()) for n in names[:-2]] + [("payload_bytes", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for fields, block in parse_archive(content.as_py()):
                    row = dict.fromkeys(names)
                    row |= {"record_id": fields.get("warc-record-id"), "record_type": fields["warc-type"], "url": fields.get("warc-target-uri")}
                    row |= {"page_id": fields.get("page-id"), "refers_to": fields.get("warc-refers-to")}
                    row["stated_digest"] = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                    if row["record_type"] == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        row["payload_digest"] = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        row |= {"payload_bytes": len(payload), "payload": payload}
                        held += len(payload)
                    rows.append(row)
                    if held >= BATCH_BYTES or len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("content").mapInArrow(run, RECORDS)


def resolve_revisits(records: DataFrame, id_type: str = "bigint") -> DataFrame:
    """One row per record read: ``page_id``, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to`` (page), ``digest_holds``. A revisit gets length and digest
    of the response that its digest and its reference name; nulls if there is none."""
    heads = records.drop("payload")
    originals = (
        heads.where("record_type = 'response' and record_id is not null")
        .select(
            F.col("stated_digest"),
            F.col("record_id").alias("refers_to"),
            F.col("page_id").alias("original"),
            F.col("payload_bytes").alias("original_bytes"),
            F.col("payload_digest").alias("original_digest"),
        )
        .dropDuplicates(["stated_digest", "refers_to"])
    )
    return heads.join(originals, ["stated_digest", "refers_to"], "left").select(
        F.col("page_id").cast(id_type).alias("page_id"),
        F.coalesce("payload_bytes", "original_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "original_digest").alias("payload_digest"),
        "record_type",
        F.col("original").cast(id_type).alias("refers_to"),
        (F.coalesce("payload_digest", "original_digest") == F.col("stated_digest")).alias("digest_holds"),
    )
