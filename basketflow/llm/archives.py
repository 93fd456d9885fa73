"""Legacy web archives (ARC) to WARC, and WARC files by Spark.

``parse_arc`` reads an archive by its version: the version block names the fields
of the record lines, each of which ends in the declared length of the content.
``warc_records`` turns ARC records into WARC: identifiers and dates, record type and
digests follow from the record alone, so a task that is run again writes the same
bytes.  Contents that were seen before become ``revisit`` records.

An archive is written by Spark's text writer, record after record, with the
terminator of WARC records as line separator, so that it works on any file system;
it is read back as whole files, whose size is bounded in bytes, and taken apart by the
declared lengths alone, a few records at a time.

``read_arc`` reads legacy archives from storage, compressed ones too.  Lines of real
archives have blanks inside fields, and records are cut or damaged: what cannot be read
becomes a row that tells where and why, and reading goes on at the next record line.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.common import shared_folder, stored, text_chunks

#: Bytes of a WARC file, which a task reads as a whole; one that a single record fills may be larger.
FILE_BYTES = 32 << 20
#: Bytes of records that are handed on at once.
BATCH_BYTES = 4 << 20
#: Equal payloads of at least so many bytes become revisits.
MIN_REVISIT_BYTES = 0
#: Name space of the record identifiers.
NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:archives:records")

#: The fields of record lines by version, and WARC's terms.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: [
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code",
        "Checksum", "Location", "Offset", "Filename", "Archive-length",
    ],
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
TERMINATOR = "\r\n\r\n"


@dataclass
class ArcRecord:
    fields: dict[str, str]
    content: bytes


@dataclass
class WarcRecord:
    headers: dict[str, str]
    block: bytes = b""
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""


def digest(payload: bytes) -> str:
    """Bare SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def split_http(block: bytes) -> tuple[dict[str, str], bytes]:
    """The header fields of an HTTP response (names in lower case) and its body."""
    head, blank, body = block.partition(b"\r\n\r\n")
    if not head.startswith(b"HTTP/") or not blank:
        return {}, block
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, body


def arc_archive(records: list[tuple[str, str, bytes]], version: int) -> bytes:
    """An ARC file of (URL, 14-digit date, content) with a version block."""
    names = " ".join(ARC_FIELDS[version])
    block = f"{version} 0 Basketflow\n{names}\n".encode()

    def line(url: str, kind: str, date: str, length: int) -> bytes:
        middle = {1: [], 2: ["200", "-", "-", "0", "-"]}[version]
        return " ".join([url, "0.0.0.0", date, kind, *middle, str(length)]).encode()

    parts = [line("filedesc://pages.arc", "text/plain", "20260101000000", len(block)), b"\n", block, b"\n"]
    for url, date, content in records:
        parts += [line(quote(url, safe="%/:?#[]@!$&'()*+,;=~") or "-", "text/html", date, len(content)), b"\n", content, b"\n"]
    return b"".join(parts)


@dataclass
class BadRecord:
    """What could not be read of an archive, and where it begins."""

    at: int
    reason: str


#: What a record line looks like: fields that may hold blanks are between such as don't.
ARC_LINES = {
    1: re.compile(rb"(.+) (\S+) (\d{12,14}) (.+) (\d+)\r?"),
    2: re.compile(rb"(.+) (\S+) (\d{12,14}) (.+) (\d+|-) (\S+) (.+) (\d+|-) (.+) (\d+)\r?"),
}


#: Why the rest is missing of an archive that ends within a compressed member.
CUT = "the last compressed member is cut"


def unzipped(archive: bytes) -> tuple[bytes, str | None]:
    """An archive's bytes, decompressed if need be, and why the rest is missing if it is."""
    if not archive.startswith(b"\x1f\x8b"):
        return archive, None
    found, rest = [], archive
    while rest.startswith(b"\x1f\x8b"):  # a member for each record
        member = zlib.decompressobj(31)
        try:
            found.append(member.decompress(rest))
        except zlib.error as damaged:
            return b"".join(found), str(damaged)
        if not member.eof:
            return b"".join(found), CUT
        rest = member.unused_data
    return b"".join(found), "no compressed member where one should begin" if rest.strip(b"\0\r\n") else None


def scan_arc(archive: bytes) -> Iterator[ArcRecord | BadRecord]:
    """The records of an ARC file, without its version block, and what is bad between them.

    After a bad record reading goes on at the next line that looks like a record's.
    An unknown version or none ends it.
    """
    archive, cut = unzipped(archive)
    end = archive.find(b"\n")
    line = ARC_LINES[1].fullmatch(archive[: max(end, 0)])
    if end < 0 or not line or not line[1].startswith(b"filedesc://"):
        yield BadRecord(0, "no version block")
        return
    at = end + 1 + int(line[5])
    block = archive[end + 1 : at].split(b" ", 1)[0]
    version = int(block) if block.isdigit() else None
    if version not in ARC_FIELDS:
        yield BadRecord(0, f"unknown version {block.decode('utf-8', 'replace')}")
        return
    names, pattern = ARC_FIELDS[version], ARC_LINES[version]
    next_line = re.compile(rb"\n(?=" + pattern.pattern + rb"\n)")
    while at < len(archive):
        if archive[at : at + 1] in b"\r\n":  # between records
            at += 1
            continue
        end = archive.find(b"\n", at)
        values = pattern.fullmatch(archive[at : end if end >= 0 else len(archive)])
        reason = None
        if values is None:
            reason = f"no record line of {len(names)} fields"
        else:
            start, length = end + 1, int(values[len(names)])
            content = archive[start : start + length]
            if end < 0 or len(content) < length:
                reason = f"{length} bytes declared, {len(content) if end >= 0 else 0} are there"
            elif archive[start + length : start + length + 1] not in (b"", b"\r", b"\n"):
                reason = f"no line ends after the {length} bytes declared"
        if cut == CUT and reason is None and not archive[start + length :].strip(b"\r\n"):
            break  # the record that was cut: nothing tells whether its bytes are right, as the checksum is missing
        if reason is None:
            texts = [value.decode("utf-8", "replace") for value in values.groups()]
            yield ArcRecord(dict(zip(names, texts, strict=True)), content)
            at = start + length
            continue
        yield BadRecord(at, reason)
        # The content of a record with a wrong length is skipped along with its line.
        later = next_line.search(archive, end if end >= 0 else len(archive))
        at = later.end() if later else len(archive)
    if cut:
        yield BadRecord(len(archive), cut)


def parse_arc(archive: bytes) -> Iterator[ArcRecord]:
    """The records of an ARC file; raises ``ValueError`` where one is bad."""
    for record in scan_arc(archive):
        if isinstance(record, BadRecord):
            raise ValueError(f"at byte {record.at}: {record.reason}")
        yield record


def iso_date(date: str) -> str:
    """An ARC date (12 or 14 digits) as a WARC date."""
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(page_id: object, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{page_id}/{payload_digest}')}>"


def warc_record(arc: ArcRecord, first_id: int | None) -> bytes:
    """The WARC record of an ARC record, without terminator.

    ``first_id``: the page that first had this payload, if this one revisits it.
    """
    http, payload = split_http(arc.content)
    own = digest(payload)
    headers = {
        "WARC-Type": "response" if first_id is None else "revisit",
        "WARC-Record-ID": record_id(http.get("x-page-id"), own),
        "WARC-Date": iso_date(arc.fields["Archive-date"]),
        "WARC-Target-URI": arc.fields["URL"],
        "WARC-IP-Address": arc.fields["IP-address"],
        "WARC-Payload-Digest": f"sha1:{own}",
    }
    block = arc.content
    if first_id is not None:
        # A revisit keeps the response's header, which tells the payload's length.
        block = arc.content[: len(arc.content) - len(payload)]
        headers |= {"WARC-Refers-To": record_id(first_id, own), "WARC-Profile": REVISIT_PROFILE}
    headers |= {
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        "Content-Type": "application/http;msgtype=response" if http else arc.fields["Content-type"],
        "Content-Length": str(len(block)),
    }
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()) + "\r\n"
    return head.encode() + block


def parse_warc(archive: bytes) -> Iterator[WarcRecord]:
    """The records of a WARC file, by their declared lengths; digests are verified."""
    at = 0
    while at < len(archive):
        end = archive.find(b"\r\n\r\n", at)
        if end < 0 or not archive.startswith(b"WARC/1.", at):
            raise ValueError(f"no record at byte {at}")
        lines = archive[at:end].decode("utf-8").split("\r\n")[1:]
        headers = {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        start = end + 4
        at = start + int(headers["Content-Length"])
        block = archive[start:at]
        if archive[at : at + 4] != TERMINATOR.encode():
            raise ValueError(f"record that begins at byte {start} does not end where it declares")
        at += 4
        if headers["WARC-Block-Digest"] != f"sha1:{digest(block)}":
            raise ValueError("the block does not have its digest")
        http, payload = split_http(block)
        if headers["WARC-Type"] == "response" and headers["WARC-Payload-Digest"] != f"sha1:{digest(payload)}":
            raise ValueError("the payload does not have its digest")
        yield WarcRecord(headers, block, http, payload)


def http_response(page_id: object, html: str) -> bytes:
    body = html.encode("utf-8")
    fields = f"Content-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n"
    if page_id is not None:
        fields += f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\n{fields}\r\n".encode() + body


def first_pages(pages: DataFrame, min_bytes: int) -> DataFrame:
    """``digest, first_id``: the smallest page of each payload that occurs again."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "html"):
            bodies = batch.column("html").cast(pa.binary()).to_pylist()
            columns = [batch.column("page_id"), pa.array(map(digest, bodies)), pa.array(map(len, bodies), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "digest", "size"])

    rows = pages.select("page_id", "html").mapInArrow(digests, "page_id long, digest string, size long")
    again = (
        rows.where(F.col("size") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
        .where((F.col("copies") > 1) & F.col("first_id").isNotNull())
        .select("digest", "first_id")
    )
    # Stored, so that Spark knows its size: it is broadcast only if it is small.
    return stored(again, "first-pages")


def legacy_archives(pages: DataFrame) -> DataFrame:
    """``archive`` (an ARC file as binary) and ``firsts``, a row per slice of pages.

    Slices alternate between the two versions.  ``firsts`` are the pages that the
    records revisit, in their order.
    """

    def archived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(text_chunks(batches, "html")):
            rows = batch.to_pylist()
            records = [(r["url"], "20260101000000", http_response(r["page_id"], r["html"])) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([arc_archive(records, 1 + number % 2)], pa.binary()),
                    pa.array([[r["first_id"] for r in rows]], pa.list_(pa.int64())),
                ],
                names=["archive", "firsts"],
            )

    return pages.mapInArrow(archived, "archive binary, firsts array<long>")


def convert(archives: DataFrame) -> DataFrame:
    """``record``: the WARC record (binary, without terminator) of each ARC record.

    ``archives`` has ``archive``, the content of an ARC file of either version, and
    ``firsts``, the page each of its records revisits (null: none do).
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                arcs = list(parse_arc(batch.column("archive")[row].as_py()))
                firsts = batch.column("firsts")[row].as_py() or [None] * len(arcs)
                found = [warc_record(arc, first) for arc, first in zip(arcs, firsts, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["record"])

    return archives.select("archive", "firsts").mapInArrow(records, "record binary")


def slotted(records: DataFrame, file_bytes: int) -> DataFrame:
    """``record`` and ``slot``: a task's records fill one file of ``file_bytes`` after another."""

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, held = 0, 0
        for batch in batches:
            slots = []
            for size in pa.compute.binary_length(batch.column("record")).to_pylist():
                if held and held + size > file_bytes:
                    slot, held = slot + 1, 0
                held += size + len(TERMINATOR)
                slots.append(slot)
            yield pa.RecordBatch.from_arrays([batch.column("record"), pa.array(slots, pa.int32())], names=["record", "slot"])

    return records.select("record").mapInArrow(filled, "record binary, slot int")


def write_warc(records: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """The records as WARC files in a folder that is not there yet."""
    lines = slotted(records, file_bytes).select(F.col("record").cast("string").alias("value"), "slot")
    lines.write.option("lineSep", TERMINATOR).partitionBy("slot").text(path)


def in_batches(rows: Iterator[dict], schema: pa.Schema, size_of) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``BATCH_BYTES``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def read_arc(spark: SparkSession, path: str, pattern: str = "*.arc*") -> DataFrame:
    """``file, url, ip, date, content_type, content, at, error`` of each record of the ARC
    files (compressed or not) in a folder.

    ``date`` is as a WARC date.  A bad record has ``error`` and the byte ``at`` which
    it begins (of the decompressed file); the others have neither.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")
    schema = "file string, url string, ip string, date string, content_type string, content binary, at long, error string"
    names = [field.split() for field in schema.split(", ")]
    kinds = pa.schema([(n, {"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}[k]) for n, k in names])

    def row(file: str, record: ArcRecord | BadRecord) -> dict:
        if isinstance(record, BadRecord):
            return {"file": file, "at": record.at, "error": record.reason}
        f = record.fields
        return {
            "file": file, "url": f["URL"], "ip": f["IP-address"], "date": iso_date(f["Archive-date"]),
            "content_type": f["Content-type"], "content": record.content,
        }

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content"), strict=True):
                name = file.as_py()
                rows = (row(name, record) for record in scan_arc(content.as_py()))
                yield from in_batches(rows, kinds, lambda r: len(r.get("content") or b""))

    return files.mapInArrow(parsed, schema)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``record_id, type, uri, date, page_id, refers_to_record, payload_bytes,
    payload_digest, payload`` of each record in the folder; ``payload`` is null for
    revisits, whose length and digest are those of the full payload."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).select("content")
    schema = (
        "record_id string, type string, uri string, date string, page_id long, refers_to_record string, "
        "payload_bytes long, payload_digest string, payload binary"
    )

    def row(r: WarcRecord) -> dict:
        page, revisit = r.http.get("x-page-id"), r.headers["WARC-Type"] == "revisit"
        return {
            "record_id": r.headers["WARC-Record-ID"],
            "type": r.headers["WARC-Type"],
            "uri": r.headers["WARC-Target-URI"],
            "date": r.headers["WARC-Date"],
            "page_id": None if page is None else int(page),
            "refers_to_record": r.headers.get("WARC-Refers-To"),
            "payload_bytes": int(r.http["content-length"]) if revisit else len(r.payload),
            "payload_digest": r.headers["WARC-Payload-Digest"].removeprefix("sha1:"),
            "payload": None if revisit else r.payload,
        }

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema(
            [(n, pa.int64() if n in ("page_id", "payload_bytes") else pa.string()) for n in
             ("record_id", "type", "uri", "date", "page_id", "refers_to_record", "payload_bytes", "payload_digest")]
            + [("payload", pa.binary())]
        )
        for batch in batches:
            for file in batch.column("content"):
                rows = map(row, parse_warc(file.as_py()))
                yield from in_batches(rows, kinds, lambda r: len(r["payload"] or b""))

    return files.mapInArrow(parsed, schema)


def through_archives(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages to ARC, to WARC, to files, and back.

    Returns ``page_id, payload_bytes, payload_digest, record_type, refers_to``, one
    row per row of ``pages``, from the files read back.  Null HTML is an empty
    payload, a null URL is written as ``-``.  Of rows with equal payloads, those
    with the smallest ``page_id`` are responses (a repeated row is one again), the
    others, also those without ``page_id``, revisit it.  Columns other than
    ``page_id``, ``url`` and ``html`` are not read.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("-")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    firsts = first_pages(rows, min_bytes)
    if firsts.isEmpty():
        marked = rows.withColumn("first_id", F.lit(None).cast("long"))
    else:
        marked = _with_first(rows, firsts, min_bytes)
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(convert(legacy_archives(marked)), path)
    records = read_warc(spark, path).drop("payload")
    targets = (
        records.where("type = 'response'").select(F.col("record_id").alias("target"), F.col("page_id").alias("refers_to"))
    ).dropDuplicates(["target"])
    return records.join(targets, records.refers_to_record == targets.target, "left").select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to"
    )


def _with_first(rows: DataFrame, firsts: DataFrame, min_bytes: int) -> DataFrame:
    """The pages with ``first_id``, the page they revisit, or null."""

    @F.pandas_udf("string")
    def digests(html):
        return html.map(lambda text: digest(text.encode("utf-8")))

    found = rows.withColumn("digest", digests("html")).join(firsts, "digest", "left")
    revisits = F.col("first_id").isNotNull() & (F.octet_length("html") >= min_bytes)
    first = F.when(revisits & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return found.select("page_id", "url", "html", first.alias("first_id"))
