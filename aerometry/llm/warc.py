"""WARC archives: writing pages, resolving revisits, reading back.

An archive is a folder of gzip files of WARC/1.1 records, written by Spark's own text
writer with the end of a record as line separator: tasks commit their files, on any
file system. Reading follows ``Content-Length``, so a payload may hold separators and
whole records; a compressed file is read by one task from its beginning.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerometry.llm.documents import Passing, kept
from aerometry.session import scratch_path

# Fixed values of the format.
VERSION = "WARC/1.1"
LINE_END = "\r\n"
BLOCK = LINE_END + LINE_END
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE16_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: A field of our own: the number of the page that a record holds.
PAGE_FIELD = "X-Page-ID"

#: Records of one file; a file is read by one task.
RECORDS_PER_FILE = 20_000

HEADERS = (
    "record_id string, record_type string, page_id long, url string, date string, "
    "payload_bytes long, payload_digest string, refers_to string"
)
RECORDS = f"{HEADERS}, payload binary"


# Writing


def base32_sha1(data: Column) -> Column:
    """SHA-1 in base 32, from its hexadecimal form: five digits are four of the new ones."""
    digest = F.sha1(data)
    parts = [
        F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), BASE16_DIGITS, BASE32_DIGITS)


def header_text(value: Column) -> Column:
    """A value that fits into a header line: line ends are percent-encoded."""
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _lines(start: str, fields: list[tuple[str, Column]]) -> Column:
    """A start line and the fields that are not null."""
    return F.concat_ws(
        LINE_END, F.lit(start), *[F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    )


def records_of(pages: DataFrame) -> DataFrame:
    """Response records of (page_id, url, html); a null html is an empty payload."""
    payload = F.coalesce("html", F.lit(""))
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return pages.select(
        F.uuid().alias("record_id"),
        F.lit("response").alias("record_type"),
        F.col("page_id").cast("long").alias("page_id"),
        header_text(F.col("url")).alias("url"),
        F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        base32_sha1(payload.cast("binary")).alias("payload_digest"),
        F.lit(None).cast("string").alias("refers_to"),
        payload.cast("binary").alias("payload"),
    )


def record_text(records: DataFrame) -> DataFrame:
    """A record as text, but for the end of the record.

    The block is an HTTP response. A revisit keeps its header, with the length of the
    payload that the record does without.
    """
    http = F.concat(
        _lines(
            "HTTP/1.1 200 OK",
            [
                ("Content-Type", F.lit("text/html; charset=utf-8")),
                ("Content-Length", F.col("payload_bytes").cast("string")),
            ],
        ),
        F.lit(BLOCK),
    )
    is_revisit = F.col("record_type") == "revisit"
    length = F.octet_length(http) + F.when(is_revisit, 0).otherwise(F.col("payload_bytes"))
    urn = lambda column: F.concat(F.lit("<urn:uuid:"), column, F.lit(">"))
    header = _lines(
        VERSION,
        [
            ("WARC-Type", F.col("record_type")),
            ("WARC-Record-ID", urn(F.col("record_id"))),
            ("WARC-Date", F.col("date")),
            ("WARC-Target-URI", F.col("url")),
            (PAGE_FIELD, F.col("page_id").cast("string")),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
            ("WARC-Profile", F.when(is_revisit, F.lit(SAME_PAYLOAD))),
            ("WARC-Refers-To", urn(F.col("refers_to"))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
            ("Content-Length", length.cast("string")),
        ],
    )
    payload = F.when(is_revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    return records.select(F.concat(header, F.lit(BLOCK), http, payload).alias("value"))


def write_archives(
    records: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE, fast: bool = False
) -> None:
    """Write records to a new folder; every task writes and commits its own files.

    ``fast`` compresses less, for archives that are soon written anew.
    """
    text = record_text(records).write.option("lineSep", BLOCK).option("compression", "gzip")
    if fast:
        text = text.option("zlib.compress.level", "BEST_SPEED")
    text.option("maxRecordsPerFile", records_per_file).text(path)


# Reading


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of a folder of archives, with or without their payloads.

    A response's length and digest are those of the payload as read; a revisit, which
    has none, carries them in its header. A file that ends within a record, and a
    payload unlike its digest, are errors.
    """
    pieces = (
        spark.read.option("lineSep", BLOCK)
        .text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary"))
    )
    fields = RECORDS if payloads else HEADERS
    width = len(fields.split(", "))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for record in _parsed(batches):
            found.append(record[:width])
            size += 500 + (len(record[-1] or b"") if payloads else 0)
            if size > READ_BYTES:
                yield _records(found, width)
                found, size = [], 0
        yield _records(found, width)

    return pieces.mapInArrow(parse, fields)


#: Bytes of records that are handed on together.
READ_BYTES = 4 << 20

_KINDS = [field.split() for field in RECORDS.split(", ")]
_ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _records(found: list[tuple], width: int) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) if found else [()] * width
    return pa.record_batch(
        [pa.array(list(c), _ARROW[kind]) for c, (_, kind) in zip(columns, _KINDS, strict=False)],
        names=[name for name, _ in _KINDS[:width]],
    )


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Records of the files whose pieces come one after the other."""
    parser, at = None, None
    for batch in batches:
        files, values = batch.column(0).to_pylist(), batch.column(1)
        for file, piece in zip(files, values, strict=True):
            if file != at:
                if parser is not None:
                    parser.close()
                parser, at = ArchiveParser(file), file
            yield from parser.feed(piece.as_py() + BLOCK.encode())
    if parser is not None:
        parser.close()


class ArchiveParser:
    """Bytes in, records out; holds no more than one record and a piece."""

    def __init__(self, name: str) -> None:
        self.name, self.parts, self.size, self.needed = name, [], 0, 1
        self.header: dict[str, str] | None = None

    def feed(self, data: bytes) -> Iterator[tuple]:
        self.parts.append(data)
        self.size += len(data)
        while self.size >= self.needed:
            held = b"".join(self.parts)
            if self.header is None:
                held = held.lstrip(LINE_END.encode())
                end = held.find(BLOCK.encode())
                if end < 0:
                    self._hold(held, len(held) + 1)
                    return
                self.header = _fields(held[:end].decode(errors="replace"), self.name, VERSION)
                self._hold(held[end + len(BLOCK) :], int(self.header["content-length"]))
                continue
            length = int(self.header["content-length"])
            yield self._record(held[:length])
            self.header = None
            self._hold(held[length:], 1)

    def close(self) -> None:
        rest = b"".join(self.parts).strip(LINE_END.encode())
        if self.header is not None or rest:
            raise ValueError(f"{self.name} ends within a record")

    def _hold(self, rest: bytes, needed: int) -> None:
        self.parts, self.size, self.needed = ([rest] if rest else []), len(rest), needed

    def _record(self, block: bytes) -> tuple:
        header = self.header
        http, _, payload = block.partition(BLOCK.encode())
        length = len(payload)
        digest = header["warc-payload-digest"].removeprefix("sha1:")
        kind = header["warc-type"]
        if kind == "revisit":
            length = int(_fields(http.decode(), self.name, "HTTP/1.1")["content-length"])
            payload = None
        elif digest != base64.b32encode(hashlib.sha1(payload).digest()).decode():
            raise ValueError(f"{self.name}: {header['warc-record-id']} has another payload than its digest")
        page = header.get(PAGE_FIELD.lower())
        return (
            _bare(header["warc-record-id"]),
            kind,
            None if page is None else int(page),
            header.get("warc-target-uri"),
            header.get("warc-date"),
            length,
            digest,
            _bare(header.get("warc-refers-to")),
            payload,
        )


def _bare(urn: str | None) -> str | None:
    return None if urn is None else urn.removeprefix("<urn:uuid:").removesuffix(">")


def _fields(text: str, file: str, start: str) -> dict[str, str]:
    first, *lines = text.split(LINE_END)
    if not first.startswith(start):
        raise ValueError(f"{file}: {first[:40]!r} where {start} should be")
    pairs = (line.partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


# Revisits


def resolve_revisits(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """What every record becomes: (record_id, record_type, refers_to record, its page and url).

    Headers are shuffled by payload digest, after every task has found the last page of
    each digest it holds; of records alike, that with the largest page_id stays the
    response, of those the one with the largest record_id. A payload of fewer than
    ``least_bytes`` is always kept.
    """
    told = headers.where(F.col("payload_bytes") >= least_bytes)
    rank = F.struct("page_id", "record_id")
    originals = told.groupBy("payload_digest", "payload_bytes").agg(
        F.max(rank).alias("_original")
    )
    originals = originals.select(
        F.col("payload_digest").alias("_digest"),
        F.col("payload_bytes").alias("_bytes"),
        F.col("_original.record_id").alias("_to"),
    )
    same = (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") == F.col("_bytes"))
    is_revisit = F.col("_to") != F.col("record_id")
    return headers.join(originals, same, "left").select(
        "record_id",
        F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(is_revisit, F.col("_to")).alias("refers_to"),
    )


def deduplicate_archives(
    spark: SparkSession,
    source: str,
    target: str,
    least_bytes: int = 0,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write the archives of ``source`` anew, each payload once.

    Only headers meet by digest. What was decided joins the records by their unique
    identifiers, so that no hot payload gathers its copies; revisits lose theirs.
    """
    passing = Passing(spark)
    headers = passing.kept(read_archives(spark, source, payloads=False), "warc-headers")
    decided = resolve_revisits(headers, least_bytes)
    records = read_archives(spark, source).drop("record_type", "refers_to")
    fresh = records.join(decided, "record_id")
    write_archives(fresh, target, records_per_file)
    passing.drop()


def resolved_headers(spark: SparkSession, path: str) -> DataFrame:
    """The headers of deduplicated archives; revisits with the page they refer to.

    A response meets itself, so that the join is spread by record.
    """
    headers = kept(read_archives(spark, path, payloads=False), "warc-headers")
    pages = headers.where("record_type = 'response'").select(
        F.col("record_id").alias("_to"), F.col("page_id").alias("_page")
    )
    meets = F.coalesce("refers_to", "record_id") == F.col("_to")
    return headers.join(pages, meets).select(
        "page_id",
        "url",
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.when(F.col("record_type") == "revisit", F.col("_page")).alias("refers_to"),
    )


def archive_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages through archives and back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Every row is a record, repeated rows too. A null html is an empty payload, a null
    url leaves the field out, a null page_id ranks below all others and a revisit of
    such a page refers to null. An empty table gives an empty archive and no rows.
    """
    spark = pages.sparkSession
    passing = Passing(spark)
    first, second = passing.path("warc"), scratch_path(spark, "warc-deduplicated")
    write_archives(records_of(pages), first, fast=True)
    deduplicate_archives(spark, first, second, least_bytes)
    passing.drop()
    return resolved_headers(spark, second).drop("url")
