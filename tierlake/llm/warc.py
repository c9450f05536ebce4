"""WARC archives: write and read records, resolve revisits by payload digest."""

import base64
import hashlib
import io
from collections.abc import Iterator
from datetime import datetime, timezone
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.runtime import BATCH_BYTES, BATCH_ROWS, prepare, scratch

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records of one archive file. Files are read as streams, so their size bounds no task's memory.
RECORDS_PER_FILE = 2000
#: Ends each part of a record; files are cut at it into rows.
SEPARATOR = "\r\n\r\n"
URN = "urn:record:"
#: Between the values of a field that a record has several times, such as WARC-Concurrent-To.
REPEATED = "\n"
HTTP_TYPE = "application/http; msgtype=response"
#: The HTTP head of a record that has none of its own, up to the length of its payload.
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
#: Columns that only archives of others need, and the header fields that records are given afresh.
CARRIED = ("kind", "date", "content_type", "head", "profile", "extra")
FRESH = {"warc-type", "warc-record-id", "warc-date", "warc-target-uri", "content-type", "content-length"}
FRESH_REVISIT = {
    "warc-payload-digest", "warc-block-digest", "warc-refers-to", "warc-refers-to-target-uri",
    "warc-refers-to-date", "warc-profile",
}


def payload_digest(payload: Column) -> Column:
    """Upper-case base32 SHA-1 of a text's UTF-8 bytes, eight characters from each five bytes."""
    hex_digest = F.sha1(payload.cast("binary"))
    parts = [
        F.lpad(F.conv(F.substring(hex_digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)
    ]
    return F.translate(
        F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def _line(name: str, value: Column) -> Column:
    """A header line; nothing where the value is null. Line breaks inside a value become spaces."""
    clean = F.regexp_replace(value, r"[\r\n]+", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def _bracketed(record_id: Column) -> Column:
    """A record id as header lines have it: URNs of others as they are, own ids below a prefix."""
    own = F.when(record_id.startswith("urn:"), record_id).otherwise(F.concat(F.lit(URN), record_id))
    return F.concat(F.lit("<"), own, F.lit(">"))


def write_archive(records: DataFrame, path: str, date: str | None = None) -> None:
    """Write records as gzipped WARC 1.1 files, a revisit without its payload.

    Columns: record_id, target_uri (null: left out), payload (null for a revisit that has none),
    payload_bytes, payload_digest, refers_to (null for a response), refers_to_uri. Those in
    ``CARRIED`` may be there, and null: kind (a record neither response nor revisit; its payload is
    its whole block), date, content_type and head (of the block; with a content_type alone the
    payload is the whole block), profile (of a revisit), extra (further header lines).
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    records = records.withColumns(
        {c: F.lit(None).cast("string") for c in CARRIED if c not in records.columns}
    )
    captured = F.col("kind").isNull()
    revisit = captured & F.col("refers_to").isNotNull()
    made = F.concat(F.lit(HTTP_HEAD), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    http = (
        F.when(F.col("head").isNotNull(), F.concat("head", F.lit("\r\n\r\n")))
        .when(~captured | F.col("content_type").isNotNull(), "").otherwise(made)
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.coalesce("payload", F.lit(""))))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.coalesce("kind", F.when(revisit, "revisit").otherwise("response")),
        F.lit("\r\n"), _line("WARC-Record-ID", _bracketed(F.col("record_id"))),
        _line("WARC-Date", F.coalesce("date", F.lit(date))), _line("WARC-Target-URI", F.col("target_uri")),
        _line("WARC-Payload-Digest", F.when(captured, F.concat(F.lit("sha1:"), F.col("payload_digest")))),
        _line("WARC-Refers-To", F.when(revisit, _bracketed(F.nullif("refers_to", F.lit(""))))),
        _line("WARC-Refers-To-Target-URI", F.when(revisit, F.col("refers_to_uri"))),
        _line("WARC-Profile", F.when(revisit, F.coalesce("profile", F.lit(PROFILE)))),
        _line("Content-Type", F.coalesce("content_type", F.when(captured, F.lit(HTTP_TYPE)))),
        F.coalesce("extra", F.lit("")),
    )
    text = F.concat(
        head, _line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block
    )
    (
        records.select(text.alias("value")).write.option("lineSep", SEPARATOR)
        .option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    )


class Pieces(io.RawIOBase):
    """Pieces of bytes as one stream."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.rest = pieces, memoryview(b"")

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.rest:
            piece = next(self.pieces, None)
            if piece is None:
                return 0
            self.rest = memoryview(piece)
        n = min(len(buffer), len(self.rest))
        buffer[:n] = self.rest[:n]
        self.rest = self.rest[n:]
        return n


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file, value``: the files cut at the separators, each in one partition and in its order.

    A gzipped file is one split, which Spark reads in order. Others are cut into splits; their pieces are
    brought together by file and sorted by split and place, which spills where a file is large.
    """
    text = spark.read.option("lineSep", SEPARATOR).text(path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value")]
    gzipped = F.col("_metadata.file_name").endswith(".gz")
    split = F.col("_metadata.file_block_start").alias("split")
    others = text.where(~gzipped).select(*place, split, F.monotonically_increasing_id().alias("at"))
    others = others.repartition("file").sortWithinPartitions("file", "split", "at")
    return text.where(gzipped).select(*place).unionByName(others.select("file", "value"))


def parse(stream) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Header fields (lower-case names), HTTP head and payload of each record of a file."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where one should begin: {line[:40]!r}")
        fields, name = {}, ""
        while (line := stream.readline()).strip():
            if line[:1] in b" \t" and name:  # a folded line goes on with the value before
                fields[name] += " " + line.decode(errors="replace").strip()
                continue
            name, _, value = line.decode(errors="replace").partition(":")
            name = name.strip().lower()
            fields[name] = f"{fields[name]}{REPEATED}{value.strip()}" if name in fields else value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a record ends before its length")
        head, gap, payload = block.partition(b"\r\n\r\n")
        if not fields.get("content-type", "").startswith("application/http") or not gap:
            head, payload = b"", block
        yield fields, head, payload


def carried(kind: str, fields: dict[str, str], head: bytes, size: int | None) -> dict[str, str | bytes | None]:
    """What ``write_archive`` needs of a record beside its payload; null what it writes by itself."""
    captured = kind in ("response", "revisit")
    fresh = FRESH | FRESH_REVISIT if captured else FRESH
    lines = [
        f"{'-'.join(x.upper() if x in ('warc', 'ip', 'id', 'uri') else x.title() for x in name.split('-'))}: {v}\r\n"
        for name, value in fields.items() if name not in fresh for v in value.split(REPEATED)
    ]
    usual = captured and fields.get("content-type") == HTTP_TYPE and head == f"{HTTP_HEAD}{size}".encode()
    return {
        "kind": None if captured else kind, "date": fields.get("warc-date"),
        "content_type": None if usual else fields.get("content-type", "application/octet-stream" if captured else None),
        "head": head if captured and head and not usual else None,
        "profile": fields.get("warc-profile") if kind == "revisit" else None,
        "extra": "".join(lines) or None, "refers_to_uri": fields.get("warc-refers-to-target-uri"),
    }


def read_archive(spark: SparkSession, path: str, with_payload: bool = True, whole: bool = False) -> DataFrame:
    """One row per response or revisit record, plain or gzipped (``.gz``) files of any size alike.

    Columns: file, ordinal (its place in the file), record_type, record_id, target_uri, refers_to,
    payload_bytes, payload_digest and, ``with_payload``, payload. Length and digest of a response
    are taken from its payload, those of a revisit from its headers (null where they do not tell).
    Other records are left out, unless ``whole``: then they are there with their block as payload, and
    all rows have refers_to_uri and the columns in ``CARRIED``. A task holds a record at a time and a
    batch of rows. A file without the line breaks at its end is read as if it had them.
    """
    prepare(spark)

    def row(file, ordinal, fields, head, payload):
        kind = fields.get("warc-type")
        if kind not in ("response", "revisit"):
            payload = head + b"\r\n\r\n" + payload if head else payload
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if kind == "revisit":
            size = _http_length(head)
            digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        return {
            "file": file, "ordinal": ordinal, "record_type": kind,
            "record_id": _urn(fields.get("warc-record-id")),
            "target_uri": fields.get("warc-target-uri"),
            "refers_to": _urn(fields.get("warc-refers-to")), "payload_bytes": size,
            "payload_digest": digest,
            **({"payload": payload if kind != "revisit" else None} if with_payload else {}),
            **(carried(kind, fields, head, size) if whole else {}),
        }

    def records(batches):
        first = itemgetter(0)
        joined = (  # what a batch has of a file, a separator after each piece
            (file, SEPARATOR.encode().join([*map(itemgetter(1), own), b""])) for batch in batches
            for file, own in groupby(zip(batch["file"].to_pylist(), batch["value"].to_pylist(), strict=True), first)
        )
        rows, held = [], 0
        for file, own in groupby(joined, first):
            stream = io.BufferedReader(Pieces(map(itemgetter(1), own)), 1 << 20)
            for ordinal, (fields, head, payload) in enumerate(parse(stream)):
                if whole or fields.get("warc-type") in ("response", "revisit"):
                    rows.append(row(file, ordinal, fields, head, payload))
                    held += len(payload) if with_payload else 0
                if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([
        ("file", pa.string()), ("ordinal", pa.int64()), ("record_type", pa.string()),
        ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        *([("payload", pa.binary())] if with_payload else []),
        *([(c, pa.binary() if c == "head" else pa.string()) for c in ("refers_to_uri", *CARRIED)] if whole else []),
    ])
    ddl = (
        "file string, ordinal long, record_type string, record_id string, target_uri string,"
        " refers_to string, payload_bytes long, payload_digest string"
    )
    ddl += ", payload binary" if with_payload else ""
    ddl += "".join(f", {c} {'binary' if c == 'head' else 'string'}" for c in ("refers_to_uri", *CARRIED)) if whole else ""
    return pieces(spark, path).mapInArrow(records, ddl)


def _urn(value: str | None) -> str | None:
    return value.strip("<>").removeprefix(URN) if value else None


def _http_length(head: bytes) -> int | None:
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            return int(value)
    return None


def originals(headers: DataFrame, order: Column, min_bytes: int = 0) -> DataFrame:
    """``file, ordinal, refers_to, refers_to_uri`` of records that repeat another's payload.

    Headers only are shuffled, by digest. The first response in ``order`` (ties: file, place) is
    the original; later responses of at least ``min_bytes`` and all revisits refer to it. A revisit
    without an original keeps what it refers to. Digests that few records share meet in a
    partial aggregation; the join back is left to Spark's handling of skewed joins.
    """
    h = headers.select(
        "file", "ordinal", "record_type", "record_id", "target_uri", "refers_to", "payload_digest",
        F.col("payload_bytes").alias("bytes"), order.alias("rank"),
    )
    response = F.col("record_type") == "response"
    place = F.struct("rank", "file", "ordinal", "record_id", "target_uri")
    first = h.where(response).groupBy("payload_digest").agg(F.min(place).alias("first"))
    joined = h.join(first, "payload_digest", "left")
    own = (F.col("first.file") == F.col("file")) & (F.col("first.ordinal") == F.col("ordinal"))
    repeats = F.col("first").isNotNull() & ~own & (~response | (F.col("bytes") >= min_bytes))
    return joined.where(repeats | (~response & F.col("first").isNull())).select(
        F.col("file").alias("at_file"), F.col("ordinal").alias("at_ordinal"),
        F.coalesce("first.record_id", "refers_to", F.lit("")).alias("original_id"),
        F.col("first.target_uri").alias("original_uri"),
    )


def resolve_revisits(spark: SparkSession, source: str, target: str, order: Column | None = None,
                     min_bytes: int = 0) -> None:
    """Write the archives of ``source`` to ``target`` with every repeated payload as a revisit.

    ``order`` (of record columns, default the record id) tells which of equal payloads is the
    original. Headers are written afresh, also those of revisits whose original is another now. What
    does not depend on the original is carried through: dates, HTTP heads, content types, further
    header fields (those that occur several times too) and records of other kinds with their blocks.
    A block's digest is left out, as blocks change.
    """
    order = F.col("record_id") if order is None else order
    repeats = originals(read_archive(spark, source, with_payload=False), order, min_bytes)
    records = read_archive(spark, source, whole=True)
    joined = records.join(
        repeats, (records["file"] == repeats["at_file"]) & (records["ordinal"] == repeats["at_ordinal"]),
        "left",
    )
    write_archive(
        joined.select(
            "record_id", "target_uri", F.col("payload").cast("string").alias("payload"),
            "payload_bytes", "payload_digest", F.col("original_id").alias("refers_to"),
            F.coalesce("original_uri", "refers_to_uri").alias("refers_to_uri"),
            *[F.col(c).cast("string").alias(c) for c in CARRIED],
        ),
        target,
    )


def archive_pages(pages: DataFrame, path: str, key: str = "page_id", uri: str = "url",
                  payload: str = "html") -> None:
    """A response record per row; a null payload is empty, a null URI or key left out or empty."""
    body = F.coalesce(F.col(payload), F.lit(""))
    write_archive(
        pages.select(
            F.coalesce(F.col(key).cast("string"), F.lit("")).alias("record_id"),
            F.col(uri).cast("string").alias("target_uri"), body.alias("payload"),
            F.octet_length(body).alias("payload_bytes"), payload_digest(body).alias("payload_digest"),
            F.lit(None).cast("string").alias("refers_to"), F.lit(None).cast("string").alias("refers_to_uri"),
        ),
        path,
    )


def deduplicated_pages(pages: DataFrame, min_bytes: int = 0, key: str = "page_id", uri: str = "url",
                       payload: str = "html") -> DataFrame:
    """Archive pages, resolve revisits, read the deduplicated archives: a row per page.

    Columns: key, payload_bytes, payload_digest, record_type, refers_to. The smallest integer key
    of equal payloads is the response. Rows that repeat key and payload keep their rows: one is
    the response, the others refer to it by the same key. A null key comes last and reads back as
    null. Null and empty payloads are equal. An empty table gives no rows. Other columns of
    ``pages`` do not matter.
    """
    spark = pages.sparkSession
    raw, clean = scratch(spark, "warc-raw"), scratch(spark, "warc-clean")
    archive_pages(pages, raw, key, uri, payload)
    number = F.col("record_id").try_cast("long")
    resolve_revisits(spark, raw, clean, F.struct(number.isNull(), number), min_bytes)
    kind = pages.schema[key].dataType
    return read_archive(spark, clean, with_payload=False).select(
        F.col("record_id").try_cast(kind).alias(key), "payload_bytes", "payload_digest",
        "record_type",
        F.when(F.col("record_type") == "revisit", F.col("refers_to").try_cast(kind)).alias("refers_to"),
    )
