"""Legacy ARC archives, versions 1 and 2, converted to WARC, and WARC read back.

Archives are real files, written by Spark's text writer: a record is a row of
bytes, and the separator that the format wants between records is the line
separator. So any store Spark can reach will do.
"""

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.common import batch, map_arrow, table
from starmill.workspace import materialize, scratch_path

RECORDS = 1000  # records of an archive file, so that one file fits in a task
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed: names that are URLs
ROW_HEADER = "X-Archive-Row"
# Fixed: the field lines by which an archive of either version describes itself.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename "
       "Archive-length",
}


class ArcRecord(NamedTuple):
    offset: int
    version: int
    url: str
    ip: str
    date: str
    mime: str
    block: bytes
    truncated: bool


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def arc_line(version: int, url: str, ip: str, date: str, mime: str, block: bytes, name: str = "-") -> bytes:
    """The header line of a record, in the fields of its version."""
    between = "" if version == 1 else f"200 {digest(block)} - 0 {name} "
    return f"{url} {ip} {date} {mime} {between}{len(block)}\n".encode()


def arc_head(version: int, name: str, date: str) -> bytes:
    """The version block that opens an archive."""
    body = f"{version} 0 archive\n{FIELDS[version]}\n".encode()
    return arc_line(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", body, name) + body


def open_archive(data: bytes) -> BinaryIO:
    """An archive's bytes as a stream, whether or not they are gzipped, in any number of members."""
    return gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)


def read_arc(stream: BinaryIO) -> Iterator[ArcRecord]:
    """The records of an archive, its version block first.

    The first line's number of fields and the block it declares tell the
    version; every later header line is cut from the right into that version's
    fields, so a URL with blanks stays whole. Contents are read by their declared
    length. A record whose archive ends too soon is marked as truncated.
    """
    version, offset = 0, 0
    while line := stream.readline():
        at, offset = offset, offset + len(line)
        if not line.strip():
            continue
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if not version:
            version = 1 if len(text.split(" ")) < 10 else 2
        fields = text.rsplit(" ", len(FIELDS[version].split()) - 1)
        if len(fields) != len(FIELDS[version].split()) or not fields[-1].isdigit():
            raise ValueError(f"no header line of ARC version {version} at byte {at}: {text[:80]!r}")
        block = stream.read(int(fields[-1]))
        offset += len(block)
        if at == 0 and (declared := block.split(b" ", 1)[0]) != str(version).encode():
            raise ValueError(f"the archive calls itself version {declared!r}, its fields are of {version}")
        yield ArcRecord(at, version, *fields[:4], block, len(block) < int(fields[-1]))


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Head of an HTTP message, with the empty line that ends it, and its body."""
    end = re.search(rb"\r?\n\r?\n", block)
    return (block[:end.end()], block[end.end():]) if end else (block, b"")


def http_field(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace").strip() if found else None


def warc_date(date: str) -> str:
    """ISO time of an archive date of 8, 12 or 14 digits."""
    d = date.ljust(14, "0") if len(date) >= 8 else "19700101000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_type(record: ArcRecord) -> str:
    if record.url.startswith("filedesc:"):
        return "warcinfo"
    return "response" if record.block.startswith(b"HTTP/") else "resource"


def record_id(archive: str, record: ArcRecord) -> str:
    """The same for the same record on every reading, and no other record's."""
    return f"urn:uuid:{uuid.uuid5(NAMESPACE, f'{archive} {record.offset} {record.date} {record.url}')}"


def warc_record(fields: dict[str, str | None], block: bytes) -> bytes:
    """A record but for the two empty lines that end it, which are the writer's line separator."""
    lines = [f"{k}: {v}" for k, v in fields.items() if v is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block


def parse_warc(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Named fields, in lower case, and block of each record, by declared length."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError(f"record {fields.get('warc-record-id')} is cut short")
        yield fields, block


def write_archive(records: DataFrame, path: str, separator: str) -> None:
    """Rows of bytes as gzipped files of at most ``RECORDS`` rows, in the order of each task."""
    (
        records.select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", separator).option("maxRecordsPerFile", RECORDS)
        .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)
    )


def write_arc(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
    date: str = "20200101000000", versions: tuple[int, ...] = (1, 2),
) -> None:
    """Pages as ARC archives, each of one version; the versions take turns by task.

    Null bodies are empty. White space in a URL is escaped, for it would end the
    field; a null URL becomes ``unknown:``.
    """
    schema = pa.schema([("record", pa.binary())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block_no = TaskContext.get().partitionId()
        version = versions[block_no % len(versions)]
        written = 0
        for x in batches:
            out = []
            for row, url, body in zip(*(x.column(c).to_pylist() for c in ("id", "url", "body"))):
                if written % RECORDS == 0:  # a new file begins
                    name = f"{block_no}-{written // RECORDS}.arc"
                    out.append(arc_head(version, name, date))
                    written += 1
                body = (body or "").encode()
                field = "" if row is None else f"{ROW_HEADER}: {row}\r\n"
                head = (
                    "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                    f"{field}Content-Length: {len(body)}\r\n\r\n"
                )
                url = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "unknown:")
                block = head.encode() + body
                out.append(arc_line(version, url, "0.0.0.0", date, "text/html", block, name) + block)
                written += 1
            if out:
                yield batch(schema, record=out)

    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(body_col).alias("body")
    )
    write_archive(map_arrow(rows, task, "record binary"), path, "\n")


def arc_records(spark: SparkSession, path: str, contents: bool) -> DataFrame:
    """Every record of the ARC archives below a path, with what a WARC record of it needs.

    ``contents=False`` leaves the blocks out, for passes that need digests only.
    """
    fields = [
        ("archive", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()),
        ("type", pa.string()), ("row", pa.int64()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
    ]
    more = [
        ("uri", pa.string()), ("ip", pa.string()), ("date", pa.string()), ("mime", pa.string()),
        ("truncated", pa.bool_()), ("block", pa.binary()),
    ]
    schema = pa.schema(fields + more * contents)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for archive, data in zip(x.column("path").to_pylist(), x.column("content")):
                out = []
                for r in read_arc(open_archive(data.as_py())):
                    kind = warc_type(r)
                    head, payload = split_http(r.block) if kind == "response" else (b"", r.block)
                    row = http_field(head, ROW_HEADER)
                    values = (
                        archive, r.offset, record_id(archive, r), kind, None if row is None else int(row),
                        len(payload), digest(payload),
                    )
                    if contents:
                        values += (r.url, r.ip, warc_date(r.date), r.mime, r.truncated, r.block)
                    out.append(values)
                if out:
                    yield batch(schema, **dict(zip(schema.names, zip(*out))))

    names = (
        "archive string, offset long, record_id string, type string, row long, payload_bytes long, "
        "payload_digest string"
    )
    if contents:
        names += ", uri string, ip string, date string, mime string, truncated boolean, block binary"
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return map_arrow(files, task, names)


def revisits(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(archive, offset, refers_to, refers_date) of records whose payload another record holds.

    Of equal payloads the record with the largest row holds it; ties go to the
    last place in the archives, null rows come first. One aggregate by digest,
    combined before the shuffle, finds the holders.
    """
    own = headers.where((F.col("type") == "response") & (F.col("payload_bytes") >= min_bytes)).select(
        "payload_digest", F.struct("row", "archive", "offset", "record_id").alias("at")
    )
    holders = (
        own.groupBy("payload_digest").agg(F.max("at").alias("holder"), F.count("at").alias("n"))
        .where("n > 1").drop("n")
    )
    return own.join(holders, "payload_digest").where("at.record_id <> holder.record_id").select(
        "at.archive", "at.offset", F.col("holder.record_id").alias("refers_to")
    )


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_bytes: int = 0) -> None:
    """ARC archives below a path as WARC archives below another.

    The archives are read twice: once for digests, which decide what is a
    revisit, and once for the records themselves, which meet that decision by
    their place, a key without skew.
    """
    decided = materialize(revisits(arc_records(spark, arc_path, False), min_bytes), "revisits")
    records = arc_records(spark, arc_path, True).join(decided, ["archive", "offset"], "left")
    schema = pa.schema([("record", pa.binary())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            out = []
            for r in x.to_pylist():
                kind, block = r["type"], r["block"]
                fields = {
                    "WARC-Type": kind, "WARC-Record-ID": f"<{r['record_id']}>", "WARC-Date": r["date"],
                }
                if kind == "warcinfo":
                    fields |= {"WARC-Filename": r["uri"].removeprefix("filedesc://"), "Content-Type": "text/plain"}
                else:
                    fields |= {
                        "WARC-Target-URI": r["uri"],
                        "WARC-IP-Address": None if r["ip"] == "0.0.0.0" else r["ip"],
                        "WARC-Payload-Digest": f"sha1:{r['payload_digest']}",
                        "WARC-Truncated": "unspecified" if r["truncated"] else None,
                        "Content-Type": "application/http;msgtype=response" if kind == "response" else r["mime"],
                    }
                if r["refers_to"] is not None:
                    block = split_http(block)[0]
                    fields |= {
                        "WARC-Type": "revisit", "WARC-Refers-To": f"<{r['refers_to']}>",
                        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                    }
                fields["WARC-Block-Digest"] = f"sha1:{digest(block)}"
                out.append(warc_record(fields, block))
            if out:
                yield batch(schema, record=out)

    write_archive(map_arrow(records, task, "record binary"), warc_path, "\r\n\r\n")


def warc_records(spark: SparkSession, path: str) -> DataFrame:
    """Every response, revisit and resource of the WARC archives below a path, digests checked.

    ``payload_bytes`` of a revisit is what its own HTTP head declares.
    """
    schema = pa.schema([
        ("record_id", pa.string()), ("record_type", pa.string()), ("uri", pa.string()),
        ("date", pa.string()), ("row", pa.int64()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("refers_to_id", pa.string()),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for data in x.column("content"):
                out = []
                for fields, block in parse_warc(open_archive(data.as_py())):
                    kind, name = fields["warc-type"], fields["warc-record-id"].strip("<>")
                    if kind == "warcinfo":
                        continue
                    http = fields["content-type"].startswith("application/http")
                    head, payload = split_http(block) if http else (b"", block)
                    told = fields["warc-payload-digest"].removeprefix("sha1:")
                    size = len(payload)
                    if kind == "revisit":
                        size = int(http_field(head, "Content-Length"))
                    elif digest(payload) != told:
                        raise ValueError(f"the payload of {name} is not what its digest says")
                    row = http_field(head, ROW_HEADER)
                    out.append((
                        name, kind, fields["warc-target-uri"], fields["warc-date"],
                        None if row is None else int(row), size, told,
                        fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
                    ))
                if out:
                    yield batch(schema, **dict(zip(schema.names, zip(*out))))

    files = spark.read.format("binaryFile").load(path).select("content")
    return map_arrow(
        files, task, "record_id string, record_type string, uri string, date string, row long, "
        "payload_bytes long, payload_digest string, refers_to_id string",
    )


def op1_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to ARC archives, converted to WARC and read back."""
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(table(spark, sf_dir, "pages"), arc)
    convert(spark, arc, warc)
    found = materialize(warc_records(spark, warc), "warc-records")
    holders = found.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("row").alias("refers_to")
    )
    names = [F.col("row").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "uri", "date"]
    plain = found.where("refers_to_id IS NULL").select(*names, F.lit(None).cast("long").alias("refers_to"))
    again = found.where("refers_to_id IS NOT NULL").join(holders, "refers_to_id", "left")
    return plain.unionByName(again.select(*names, "refers_to"))


QUERIES = {"op1_arc_to_warc": (op1_arc_to_warc, None)}
