"""WARC archives of pages: written whole, normalised to one gzip member a record, read back.

``write_archives`` lets Spark write the records of each task as one gzip stream, as archives
made by a plain ``gzip`` are: the record separator of the text writer is WARC's own end of a
record. Nothing in such a file can be read without inflating all before it.

``normalise`` inflates each stream once, in pieces, and rewrites every record as a gzip member
of its own, which is still a valid gzip file. A sidecar table gives the offset and length of
each member, so that one record can be read alone (``read_records``).

Records with equal payloads of at least ``REVISIT_BYTES`` are stored once, in the response of
the largest page_id; the others are revisit records without a payload that name it.

Cases. Null html: empty payload. Null url: empty target. Line breaks in a url: blanks. Null
page_id: read back as null; never the one referred to, unless all equal ones are null. Equal
page_ids: told apart by nothing, each has its record; among equal largest ids all are responses.
Very long pages: a record is held whole by one task; an archive is read and written piece by piece,
and never held by one. Empty table: no rows.
Extra columns: ignored. A task that runs again writes the same bytes to the same name, by way of
a name of its own.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table
from tidemark.session import scratch_dir

REVISIT_BYTES = 1000
RECORDS_PER_FILE = 100_000
PIECE = 1 << 18
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
_INDEX = "archive string, record bigint, offset bigint, length bigint"


def _record_id(page_id: Column) -> Column:
    """A urn made of the page_id alone."""
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit(""))).cast("binary"))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)), F.lit(">"))


def with_revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, refers_to (null: a response)."""
    known = pages.select(
        "page_id",
        "url",
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumns({"payload_bytes": F.octet_length("html").cast("long"), "payload_digest": F.sha1(F.col("html").cast("binary"))})
    groups = (
        known.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("__first"), F.count("*").alias("__n"))
        .where("__n > 1")
        .drop("__n")
    )
    # Spark broadcasts this table if it is small, and splits a hot digest if it is not.
    return known.join(stored(groups, "warc-equal"), "payload_digest", "left").select(
        "page_id", "url", "html", "payload_bytes", "payload_digest", F.when(~F.col("page_id").eqNullSafe(F.col("__first")), F.col("__first")).alias("refers_to")
    )


def record_text(least: int = REVISIT_BYTES) -> Column:
    """The WARC record of a row of ``with_revisits``, but for the blank lines at its end."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", _record_id(F.col("refers_to"))), line("X-Refers-To-Page-Id", F.col("refers_to").cast("string")))).otherwise(""),
        line("X-Page-Id", F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


def write_archives(pages: DataFrame, path: str) -> None:
    """One gzip stream for each task, or for each ``RECORDS_PER_FILE`` records."""
    records = with_revisits(pages).select(record_text().alias("value"))
    records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def inflate(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The bytes of one or several gzip members, piece by piece."""
    inner = zlib.decompressobj(31)
    for piece in pieces:
        while piece:
            out = inner.decompress(piece)
            if out:
                yield out
            piece = inner.unused_data
            if inner.eof:
                inner = zlib.decompressobj(31)


def pieces_of(stream) -> Iterator[bytes]:
    """What a file has, ``PIECE`` bytes at a time."""
    while piece := stream.read(PIECE):
        yield piece


_LENGTH = re.compile(rb"\r\nContent-Length: *(\d+)", re.IGNORECASE)


def split_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, each with its end; holds no more than a record and a piece."""
    held, need = bytearray(), 0
    for piece in pieces:
        held += piece
        while True:
            if not need:
                head = held.find(b"\r\n\r\n")
                if head < 0:
                    break
                found = _LENGTH.search(held, 0, head + 2)
                if not held.startswith(b"WARC/") or not found:
                    raise ValueError("not a WARC record")
                need = head + 4 + int(found[1]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = 0
    if held:
        raise ValueError("the archive ends inside a record")


def member(record: bytes) -> bytes:
    """A gzip member that depends on nothing but the record."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def normalise(spark: SparkSession, archives: str, path: str) -> DataFrame:
    """Rewrites every archive below ``path`` and returns the index, also kept in ``path``/index."""
    system_path, given_path = f"{path.rstrip('/')}/archives", archives.rstrip("/")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(system_path)
        given, given_folder = fs.FileSystem.from_uri(given_path)
        system.create_dir(folder, recursive=True)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                name = re.sub(r"(\.txt)?\.gz$", "", file) + ".warc.gz"
                own = f"{folder}/.{name}-{uuid.uuid4().hex}"
                lengths = []
                # As stored: the stream is inflated here, a piece at a time.
                with given.open_input_stream(f"{given_folder}/{file}", compression=None) as whole, system.open_output_stream(own, compression=None) as out:
                    for record in split_records(inflate(pieces_of(whole))):
                        packed = member(record)
                        out.write(packed)
                        lengths.append(len(packed))
                system.move(own, f"{folder}/{name}")
                offsets = [0]
                for n in lengths:
                    offsets.append(offsets[-1] + n)
                k = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * k, pa.string()), pa.array(range(k), pa.int64()), pa.array(offsets[:k], pa.int64()), pa.array(lengths, pa.int64())],
                    ["archive", "record", "offset", "length"],
                )

    # The names alone; the column of contents is not read.
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(archives).select(F.regexp_extract("path", "[^/]*$", 0).alias("file"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found.repartition(parts, "file").mapInArrow(rewrite, _INDEX).write.parquet(f"{path}/index")
    return spark.read.schema(_INDEX).parquet(f"{path}/index")


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields in lower case, block)."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {}
    for one in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = one.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, rest[: int(fields["content-length"])]


def read_records(index: DataFrame, path: str) -> DataFrame:
    """Every record of the index, read alone by offset and length; digests are checked."""
    system_path = f"{path.rstrip('/')}/archives"
    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(system_path)
        name, file = None, None
        for batch in batches:
            rows = []
            for at in batch.to_pylist():
                if at["archive"] != name:
                    name, file = at["archive"], system.open_input_file(f"{folder}/{at['archive']}")
                fields, block = parse_record(zlib.decompress(file.read_at(at["length"], at["offset"]), 31))
                http, _, payload = block.partition(b"\r\n\r\n")
                kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                size = int(re.search(rb"Content-Length: *(\d+)", http)[1])
                if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
                    raise ValueError(f"{name} at {at['offset']}: the payload does not fit its digest")
                number = lambda x: int(x) if x else None
                rows.append((number(fields["x-page-id"]), fields["warc-target-uri"], size, digest, kind, number(fields.get("x-refers-to-page-id"))))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            )

    # A number given outright stays: the index is small, what it stands for is not.
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = index.repartition(parts, "archive", F.floor(F.col("record") / 500)).sortWithinPartitions("archive", "offset")
    return dealt.mapInArrow(read, schema)


def op8_member_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of all pages, after writing, normalising and reading them."""
    whole, single = scratch_dir(spark, "warc-whole"), scratch_dir(spark, "warc-members")
    write_archives(table(spark, sf_dir, "pages"), whole)
    return read_records(normalise(spark, whole, single), single).drop("url")


SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest, max(page_id) AS first FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
  CASE WHEN f.first IS NULL OR f.first = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest
"""
