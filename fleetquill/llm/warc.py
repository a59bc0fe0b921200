"""Legacy web archives (ARC) converted to WARC.

An ARC file starts with a version block that names the fields of its record headers: five in
version 1, ten in version 2. A record is a header line and as many bytes as the line declares.
The converter reads these and makes up what WARC wants: an identifier from the archive's
name and the record's place in it, a timestamp from the 14 digits, the payload's digest,
the record type. Of records with equal payloads of ``MIN_BYTES`` or more the one with the
largest page number is a response, the others revisit it: their block is the HTTP head
alone, which still tells the payload's length.

Archives are rows of a binary column, at most about ``ARCHIVE_BYTES`` each, one record at
least; WARC archives are files with one compressed member per record. Which record to refer
to is an aggregate with partial sums and a join, so a payload that very many pages share
never meets in one task.

Defined results: a null html is an empty payload; a null url is written as ``unknown:``,
white space in one percent-encoded; a null page_id stays null and refers to its payload's
largest; repeated rows of the largest page_id are responses each; an empty table
gives no record; other columns are ignored; an archive that breaks off or declares no
length raises ValueError.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetquill.llm import shared

ARCHIVE_BYTES = 8 << 20
MIN_BYTES = 0
LEVEL = 4
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "page_id long, record_id string, uri string, date string, ip string, head binary, payload binary, digest string"
)
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, uri string"


@dataclass
class ArcRecord:
    fields: dict[str, str]
    body: bytes
    offset: int


def arc_file(name: str, version: int, date: str, records: list[tuple[str, bytes]]) -> bytes:
    """An ARC archive of (url, HTTP response) pairs."""
    block = f"{version} 0 {name}\n{FIELDS[version]}\n".encode()
    own = "text/plain" if version == 1 else f"text/plain 200 - - 0 {name}"
    parts = [f"filedesc://{name} 0.0.0.0 {date} {own} {len(block)}\n".encode(), block, b"\n"]
    offset = sum(map(len, parts))
    for url, response in records:
        kind = "text/html" if version == 1 else f"text/html 200 - - {offset} {name}"
        line = f"{url} 0.0.0.0 {date} {kind} {len(response)}\n".encode()
        parts += [line, response, b"\n"]
        offset += len(line) + len(response) + 1
    return b"".join(parts)


def parse_arc(content: bytes) -> Iterator[ArcRecord]:
    """The records after the version block, whose field names tell how to read them."""

    def take(at: int, names: list[str]) -> tuple[ArcRecord, int]:
        end = content.find(b"\n", at)
        values = content[at:end].decode("utf-8", "replace").rsplit(" ", len(names) - 1)
        if end < 0 or len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"no ARC header at byte {at}")
        body = content[end + 1 : end + 1 + int(values[-1])]
        if len(body) != int(values[-1]):
            raise ValueError(f"the ARC record at byte {at} breaks off")
        return ArcRecord(dict(zip(names, values, strict=True)), body, at), end + 1 + len(body)

    first = content[: content.find(b"\n")].count(b" ") + 1
    version = {len(names.split()): number for number, names in FIELDS.items()}.get(first)
    if version is None:
        raise ValueError("no ARC version block")
    head, at = take(0, FIELDS[version].split())
    lines = head.body.decode().split("\n")
    if lines[0].split(" ")[0] != str(version):
        raise ValueError("the ARC version block contradicts its own header")
    names = lines[1].split(" ")
    while at < len(content):
        if content[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        record, at = take(at, names)
        yield record


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def timestamp(digits: str) -> str:
    d = digits.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def http_value(head: bytes, name: str) -> str:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode() if found else ""


def page_archives(pages: DataFrame, date: str = "20240101000000", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(name, content): ARC archives of pages, versions 1 and 2 in turn."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, bytes]] = []
        size = number = 0
        task = TaskContext.get().partitionId()  # the same when a lost executor's task runs again

        def archive() -> pa.RecordBatch:
            version = 1 + number % 2
            name = f"legacy-{task}-{number}.arc"
            content = arc_file(name, version, date, held)
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content], pa.binary())], names=["name", "content"])

        for batch in batches:
            for page, url, html in zip(*batch.columns, strict=True):
                payload = html.as_py() or b""
                page_id = "" if page.as_py() is None else page.as_py()
                where = re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", url.as_py() or "unknown:") or "unknown:"
                head = (
                    "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                    f"X-Page-Id: {page_id}\r\nContent-Length: {len(payload)}\r\n\r\n"
                )
                if held and size + len(payload) > archive_bytes:
                    yield archive()
                    held, size, number = [], 0, number + 1
                held.append((where, head.encode() + payload))
                size += len(payload) + len(head)
        if held:
            yield archive()

    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string").cast("binary")
    )
    return rows.mapInArrow(write, "name string, content binary")


def convert(archives: DataFrame) -> DataFrame:
    """Every record of the ARC archives with what WARC needs to know of it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(*batch.columns, strict=True):
                rows = []
                for record in parse_arc(content.as_py()):
                    head, _, payload = record.body.partition(b"\r\n\r\n")
                    page = http_value(head, "X-Page-Id")
                    place = f"{name.as_py()}#{record.offset}"
                    rows.append(
                        {
                            "page_id": int(page) if page else None,
                            "record_id": f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, place)}",
                            "uri": record.fields["URL"],
                            "date": timestamp(record.fields["Archive-date"]),
                            "ip": record.fields["IP-address"],
                            "head": head + b"\r\n\r\n",
                            "payload": payload,
                            "digest": digest(payload),
                        }
                    )
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    text = ["record_id", "uri", "date", "ip"]
    kinds = pa.schema(
        [("page_id", pa.int64()), *((k, pa.string()) for k in text), ("head", pa.binary()), ("payload", pa.binary()), ("digest", pa.string())]
    )
    return archives.select("name", "content").mapInArrow(read, RECORDS)


def with_revisits(records: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Records and ``original``: the record with an equal payload that they revisit, or null."""
    large = F.octet_length("payload") >= min_bytes
    one = F.max(F.struct("page_id", "record_id", "uri", "date"))
    # written, so that in the join a payload of very many pages is a shuffle that can be split
    originals = shared.stage(
        records.where(large).groupBy("digest").agg(one.alias("original")), "warc-originals"
    )
    joined = records.join(originals, "digest", "left")
    revisits = large & F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original.page_id"))
    return joined.withColumn("original", F.when(revisits, F.col("original")))


def warc_record(row: dict) -> bytes:
    original = row["original"]
    block = row["head"] + (b"" if original else row["payload"])
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if original else 'response'}",
        f"WARC-Record-ID: <{row['record_id']}>",
        f"WARC-Date: {row['date']}",
        f"WARC-Target-URI: {row['uri']}",
        f"WARC-IP-Address: {row['ip']}",
        f"WARC-Payload-Digest: sha1:{row['digest']}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
    ]
    if original:
        lines += [
            f"WARC-Profile: {REVISIT}",
            f"WARC-Refers-To: <{original['record_id']}>",
            f"WARC-Refers-To-Target-URI: {original['uri']}",
            f"WARC-Refers-To-Date: {original['date']}",
            f"X-Refers-To-Page: {original['page_id']}",
        ]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def write(records: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """WARC files below a path, one compressed member per record.

    Each archive is one row and one file of Spark's text writer, which writes a string's bytes as
    they are; its line end is an empty compressed member, so that a file is nothing but members.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for batch in batches:
            for k in range(batch.num_rows):
                record = warc_record({n: c[k].as_py() for n, c in zip(batch.schema.names, batch.columns, strict=True)})
                held.append(member(record))
                size += len(record)
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["value"])

    (
        records.mapInArrow(pack, "value binary")
        .select(F.col("value").cast("string"))
        .write.option("lineSep", member(b"").decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", 1)
        .text(path)
    )


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of every record of an archive, member by member."""
    while content:
        reader = zlib.decompressobj(31)
        record = reader.decompress(content)
        content = reader.unused_data
        while record:
            head, _, rest = record.partition(b"\r\n\r\n")
            lines = head.decode("utf-8", "replace").split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
            size = int(fields["Content-Length"])
            if len(rest) < size + 4:
                raise ValueError("a WARC record breaks off")
            yield fields, rest[:size]
            record = rest[size + 4 :]


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record below a path; digests of responses are checked."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out = []
                for fields, block in parse_warc(content.as_py()):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if fields["WARC-Type"] == "response" and digest(payload) != stated:
                        raise ValueError(f"digest of {fields['WARC-Record-ID']} differs")
                    page, original = http_value(head, "X-Page-Id"), fields.get("X-Refers-To-Page")
                    out.append(
                        (
                            int(page) if page else None,
                            int(http_value(head, "Content-Length")),
                            stated,
                            fields["WARC-Type"],
                            int(original) if original else None,
                            fields["WARC-Record-ID"].strip("<>"),
                            fields["WARC-Target-URI"],
                        )
                    )
                if out:
                    columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
    names = [part.split()[0] for part in READ.split(", ")]
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(rows, READ)


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages as ARC archives, converted to WARC files in the shared folder and read back."""
    path = shared.scratch(pages.sparkSession, "warc")
    write(with_revisits(convert(page_archives(pages))), path)
    return read(pages.sparkSession, path)
