"""WARC archives: a writer with revisit records and a reader that salvages damaged files."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

CRLF = "\r\n"
END = b"\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
RECORD = ("status string, file string, offset long, length long, reason string, record_type string, "
          "record_id string, refers_to string, target_uri string, payload_digest string, "
          "payload_bytes long, payload binary")
GZIP = b"\x1f\x8b\x08"
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
LENGTH = re.compile(rb"(?i)\r\ncontent-length:[ \t]*(\d+)[ \t]*\r\n")
ONCE = (b"warc-type", b"warc-record-id", b"warc-date", b"content-length")
#: Bytes after which an archive file is closed; a record is never cut, so a larger one has its own.
FILE_BYTES = 1 << 25


# --------------------------------------------------------------------------------- writing

def _field(name: str, value: Column) -> Column:
    """A header line, without control characters in its value; null if the value is null."""
    return F.concat(F.lit(name + ": "), F.regexp_replace(value.cast("string"), r"[\x00-\x20\x7F]", "%20"))


def _urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def warc_records(pages: DataFrame, min_revisit: int = 1000, id_col: str = "page_id",
                 url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """``(_id, record)``: the bytes of a WARC/1.1 record per page, without the closing blank lines.

    Of the pages with equal payloads of at least ``min_revisit`` bytes the one with the largest id
    is the response; the others are revisits that refer to it and carry the HTTP headers, payload
    length included, but no payload.  Pages that repeat the largest id are all responses, and so
    are all of a group without ids.  The largest id of each digest is found by an aggregation that
    combines before the shuffle, and only digests with more than one page are joined back.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"),
                        payload.alias("_payload"))
    rows = rows.withColumns({"_bytes": F.octet_length("_payload"), "_sha": F.sha1("_payload")})
    groups = (rows.where(F.col("_bytes") >= min_revisit)
              .groupBy(F.col("_sha").alias("_gsha"), F.col("_bytes").alias("_gbytes"))
              .agg(F.max("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") > 1))
    rows = rows.join(groups, (F.col("_sha") == F.col("_gsha")) & (F.col("_bytes") == F.col("_gbytes")),
                     "left")
    revisit = F.col("_first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first"))
    http = F.concat_ws(CRLF, F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"),
                       _field("Content-Length", F.col("_bytes")), F.lit(""), F.lit("")).cast("binary")
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("_payload")))
    head = F.concat_ws(
        CRLF, F.lit("WARC/1.1"),
        F.when(revisit, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        F.concat(F.lit("WARC-Record-ID: "), _urn(F.col("_id"))),
        F.lit(f"WARC-Date: {DATE}"), _field("WARC-Target-URI", F.col("_url")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _urn(F.col("_first")))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/"
                              "identical-payload-digest")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("_sha")),
        F.concat(F.lit("WARC-Block-Digest: sha1:"), F.sha1("_block")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("_block").cast("string")),
        F.lit(""), F.lit(""))
    return (rows.withColumn("_block", block)
            .select("_id", F.concat(head.cast("binary"), F.col("_block")).alias("record")))


def _archives(compress: bool, file_bytes: int):
    """Strings of whole records, one per archive file: gzip members or plain records with what
    separates them."""
    separator = EMPTY_MEMBER if compress else END

    def task(batches):
        held, size = [], 0
        for found in batches:
            for record in found.column(0):
                record = record.as_py()
                held.append(gzip.compress(record + END, 6, mtime=0) if compress else record)
                size += len(held[-1])
                if size >= file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([separator.join(held)], pa.binary())], ["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([separator.join(held)], pa.binary())], ["value"])

    return task


def write_warc(pages: DataFrame, path: str, compress: bool = True, file_bytes: int = FILE_BYTES,
               **kwargs) -> None:
    """Write ``pages`` as WARC files below ``path``, any folder that Spark can write.

    A task joins its records up to ``file_bytes`` and Spark's text writer makes a file of each such
    run, so a file is at most that and one record long, whatever the sizes of the records; the
    writer's commit protocol keeps the files of lost or repeated tasks out.  With ``compress`` a
    record is a gzip member and the separator an empty member, which readers of gzip pass over;
    without, the separator is the blank lines that end a record.
    """
    separator = EMPTY_MEMBER.decode("latin-1") if compress else CRLF * 2
    runs = warc_records(pages, **kwargs).select("record").mapInArrow(_archives(compress, file_bytes),
                                                                     "value binary")
    (runs.select(F.col("value").cast("string")).write.option("lineSep", separator)
     .option("encoding", "ISO-8859-1").option("maxRecordsPerFile", 1).text(path))


# --------------------------------------------------------------------------------- reading

def _digest_ok(stated: bytes, data: bytes) -> bool:
    """Whether a stated digest holds; sha1 in base32 or hex is checked, others are accepted."""
    kind, _, value = stated.partition(b":")
    if kind.strip().lower() != b"sha1":
        return True
    value, sha = value.strip(), hashlib.sha1(data)
    return value.lower() in (sha.hexdigest().encode(), base64.b32encode(sha.digest()).lower())


def _parse(data: bytes, pos: int):
    """The record at ``pos``: (end, headers, block), or the failed check's name."""
    if not VERSION.match(data, pos):
        return "no version line"
    top = data.find(END, pos)
    if top < 0:
        return "no end of headers"
    headers = {}
    for line in data[pos:top].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return "bad header line"
        name = name.strip().lower()
        if name in headers and name in ONCE:
            return "header line is repeated"  # as where a cut record runs into the next
        headers.setdefault(name, value.strip())
    length = headers.get(b"content-length", b"")
    if not length.isdigit():
        return "no content length"
    start, stop = top + 4, top + 4 + int(length)
    if data[stop:stop + 4] != END:
        return "record does not end where stated"
    block = data[start:stop]
    if not _digest_ok(headers.get(b"warc-block-digest", b""), block):
        return "block digest differs"
    body = block
    if headers.get(b"content-type", b"").startswith(b"application/http"):
        cut = block.find(END)
        body = block[cut + 4:] if cut >= 0 else b""
    if headers.get(b"warc-type") != b"revisit" and not _digest_ok(
            headers.get(b"warc-payload-digest", b""), body):
        return "payload digest differs"
    return stop + 4, headers, block, body


def _parse_member(data: bytes, pos: int):
    """As :func:`_parse`, for a gzip member that holds one record; ``(end,)`` if it is empty.

    A member is inflated as far as its record states, so one of any size is read and one that
    holds something else, or more, is given up early.
    """
    inflate, plain, at, stated = zlib.decompressobj(wbits=31), bytearray(), pos, None
    while not inflate.eof and at < len(data):
        searched = max(0, len(plain) - len(END))
        try:
            plain += inflate.decompress(data[at:at + 65536])
        except zlib.error as e:
            return f"bad gzip member: {e}"
        at += 65536
        if stated is None and len(plain) >= 10:
            if not VERSION.match(plain):
                return "no version line"
            top = plain.find(END, searched)
            if top >= 0:
                length = LENGTH.search(plain, 0, top + 2)
                if not length:
                    return "no content length"
                stated = top + 2 * len(END) + int(length[1])
        if stated is not None and len(plain) > stated:
            return "gzip member does not end with its record"
    if not inflate.eof:
        return "gzip member is cut short"
    end = min(at, len(data)) - len(inflate.unused_data)
    if not plain:
        return (end,)
    found = _parse(bytes(plain), 0)
    if isinstance(found, str):
        return found
    if found[0] != len(plain):
        return "gzip member does not end with its record"
    return end, *found[1:]


def salvage(data: bytes):
    """Yield ``("record", offset, length, headers, block, body)`` and ``("gap", offset, length,
    reason)`` that together, and with empty gzip members, cover every byte.  After a failed check the search goes on, from the
    next byte, for a version line or a gzip member, and the bytes up to the next record that
    passes all checks are one quarantined gap."""
    pos, lost, why = 0, None, ""
    while pos < len(data):
        found = (_parse_member if data.startswith(GZIP, pos) else _parse)(data, pos)
        if not isinstance(found, str):
            if lost is not None:
                yield "gap", lost, pos - lost, why
                lost = None
            if len(found) > 1:
                yield "record", pos, found[0] - pos, *found[1:]
            pos = found[0]
            continue
        if lost is None:
            lost, why = pos, found
        later = [p for p in (data.find(b"WARC/1.", pos + 1), data.find(GZIP, pos + 1)) if p >= 0]
        pos = min(later, default=len(data))
    if lost is not None:
        yield "gap", lost, len(data) - lost, why


def _text(value: bytes | None) -> str | None:
    return None if value is None else value.decode("utf-8", "replace")


def _rows(file: str, data: bytes):
    for kind, offset, length, *rest in salvage(data):
        if kind == "gap":
            yield (kind, file, offset, length, rest[0], *[None] * 7)
            continue
        headers, block, body = rest
        revisit, size = headers.get(b"warc-type") == b"revisit", len(body)
        digest = hashlib.sha1(body).hexdigest()
        if revisit:
            stated = re.search(rb"(?im)^content-length:[ \t]*(\d+)", block.partition(END)[0])
            size = int(stated[1]) if stated else None
            digest = (_text(headers.get(b"warc-payload-digest")) or "").rpartition(":")[2].lower() or None
        yield (kind, file, offset, length, None, _text(headers.get(b"warc-type")),
               _text(headers.get(b"warc-record-id")), _text(headers.get(b"warc-refers-to")),
               _text(headers.get(b"warc-target-uri")), digest, size, None if revisit else body)


def _read_task(batches):
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 6, pa.int64(), pa.binary()]
    names = [f.split()[0] for f in RECORD.split(", ")]

    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    for found in batches:
        for k in range(found.num_rows):
            rows, held = [], 0
            for row in _rows(found.column(0)[k].as_py(), found.column(1)[k].as_py()):
                rows.append(row)
                held += len(row[-1] or b"")
                if held > 1 << 24:
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Read plain and gzip (a member per record) WARC files below ``path``.

    One row per record (``status`` record) and per quarantined run of bytes (``status`` gap, with
    offset, length and the check that failed first).  A record is kept if its version line,
    headers, length, closing blank lines and stated SHA-1 digests hold; anything else is passed
    over up to the next record that does.  A revisit has the digest and length it states and no
    payload.  Files are tasks; an empty folder gives an empty result.
    """
    return (spark.read.format("binaryFile").load(path).where(F.col("length") > 0)
            .select("path", "content").mapInArrow(_read_task, RECORD))


def page_id(urn: Column) -> Column:
    """The id in a record's ``<urn:page:...>``; null if it had none."""
    return F.nullif(F.regexp_extract(urn, r"^<urn:page:(.*)>$", 1), F.lit(""))
