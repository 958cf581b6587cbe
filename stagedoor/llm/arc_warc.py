"""Legacy ARC archives converted to WARC, and both formats written and read through Spark.

An ARC record is a header line, whose fields depend on the file's version, and as many bytes as the line
declares. The version and the names of the fields stand in the first record of each file. A WARC
record is synthesised from it: identifier, timestamp, type and digests are not in an ARC and are derived from
what is there, so converting again gives the same records.

Archives are plain files: Spark's text sink writes them byte by byte with the record end as its line
separator, compressed, through any file system that Spark knows and with its commit protocol, so a lost task
leaves nothing behind. They are read back as binary files and cut into records in Python.
"""

import base64
import datetime as dt
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagedoor.session import settle

# Header fields of ARC versions 1 and 2, in the order of the header line.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
# Records in an archive file at most, an ARC file's version block being one of them, and bytes of records, about.
FILE_RECORDS = 500
FILE_BYTES = 256 << 20
# Bytes of records that a task hands on at once, about.
CHUNK_BYTES = 4 << 20
WARC_END = "\r\n\r\n"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: name space of URLs

_RECORDS = (
    "archive string, start long, url string, ip string, date string, content_type string, "
    "http binary, payload_bytes long, payload_digest string, block_digest string, key long, is_http boolean"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---- ARC -------------------------------------------------------------------------------------------


def _clean(value: str | None, otherwise: str) -> str:
    """A header field holds no white space."""
    return re.sub(r"\s+", "%20", value) if value and value.strip() else otherwise


def arc_version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 archive\n{ARC_FIELDS[version]}\n".encode()
    fields = {"URL": f"filedesc://{name}", "Content-type": "text/plain", "Archive-date": "19960101000000"}
    return _arc_header(version, fields | {"IP-address": "0.0.0.0"}, len(body)) + body


def _arc_header(version: int, fields: dict, length: int) -> bytes:
    values = [
        str(length) if f == "Archive-length" else _clean(fields.get(f), "-") for f in ARC_FIELDS[version].split()
    ]
    return " ".join(values).encode() + b"\n"


def write_arc(
    pages: DataFrame,
    path: str,
    version: int | None = None,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> None:
    """One ARC record per row of ``pages``: an HTTP response whose body is the html in UTF-8 (null: empty).

    Files hold ``FILE_RECORDS`` records at most, the first being the version block, and about ``FILE_BYTES``:
    pages are written by classes of size, large ones few to a file. Without a version, files
    are of version 1 and 2 in turns. The row's key travels in the HTTP header X-Record-Key.

    - A null key leaves the header out; rows that repeat a key or are equal are records of their own.
    - A null or blank url is ``-``, other white space in it ``%20``. Null and empty html are empty bodies.
    - A page of any length is one record. An empty table gives a folder without archives.
    - Columns other than the three named are not read, whatever their names.
    """

    def record(version: int, k: str | None, u: str | None, body: bytes | None) -> bytes:
        head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
        head += "" if k is None else f"X-Record-Key: {k}\r\n"
        http = head.encode() + b"\r\n" + (body or b"")
        fields = {
            "URL": u, "IP-address": "192.0.2.1", "Archive-date": "20080430204825", "Content-type": "text/html",
            "Result-code": "200", "Checksum": hashlib.md5(http).hexdigest(), "Offset": "0", "Filename": f"v{version}.arc",
        }
        return _arc_header(version, fields, len(http)) + http

    def archive(per_file: int):
        def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out, size, number, file = [], 0, 0, TaskContext.get().partitionId()
            for row in (row for batch in batches for part in _pieces(batch) for row in _rows(part)):
                if number % (per_file - 1) == 0:
                    file += 1
                    kind = version or 2 - file % 2
                    out.append(arc_version_block(kind, f"v{kind}.arc"))
                out.append(record(kind, *row))
                size, number = size + len(out[-1]), number + 1
                if size > CHUNK_BYTES:
                    yield _binary(out)
                    out, size = [], 0
            if out:
                yield _binary(out)

        return records

    rows = pages.select(F.col(key).cast("string").alias("key"), F.col(url).alias("url"), F.col(html).cast("binary").alias("html"))
    sizes = F.coalesce(F.octet_length("html"), F.lit(0))
    for per_file, chosen in _by_size(rows, sizes, at_least=2):
        _write_archive(chosen.mapInArrow(archive(per_file), "record binary"), path, "\n", per_file)


def _by_size(rows: DataFrame, size: Column, at_least: int = 1, known: DataFrame | None = None) -> Iterator[tuple[int, DataFrame]]:
    """Rows by class of size, with how many of a class go into a file: classes are powers of two of bytes.

    All rows whose ``FILE_RECORDS`` fit into ``FILE_BYTES`` are one class, so mostly there is one. ``known`` has
    the same sizes in a narrower table.
    """
    small = (FILE_BYTES // FILE_RECORDS).bit_length() - 1
    kind = F.greatest(F.lit(small), F.ceil(F.log2(F.greatest(size, F.lit(1)))).cast("int"))
    found = sorted((rows if known is None else known).select(kind).distinct().collect())
    if not found:
        yield FILE_RECORDS, rows
    for (bits,) in found:
        yield max(at_least, min(FILE_RECORDS, FILE_BYTES >> bits)), rows.filter(kind == bits)


def _write_archive(records: DataFrame, path: str, end: str, per_file: int) -> None:
    text = records.select(F.col("record").cast("string").alias("value"))
    write = text.write.mode("append").option("lineSep", end).option("maxRecordsPerFile", per_file)
    write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def parse_arc(stream: BinaryIO) -> Iterator[tuple[int, dict, bytes]]:
    """(offset, fields of the header line, content) of each record that isn't a version block.

    Lengths are the declared ones, so a content may hold anything; a file whose declared lengths lead
    past its end or to a malformed line raises ValueError.
    """
    at, names = 0, None
    while line := stream.readline():
        start, at = at, at + len(line)
        if line == b"\n":
            continue
        values = line.removesuffix(b"\n").decode("utf-8", "replace").split(" ")
        if not values[-1].isdigit():
            raise ValueError(f"no ARC header line at byte {start}")
        content = stream.read(int(values[-1]))
        at += len(content)
        if len(content) < int(values[-1]):
            raise ValueError(f"the record at byte {start} is cut short")
        if names is None or values[0].startswith("filedesc://"):
            names = _field_names(values, content)
        elif len(values) != len(names):
            raise ValueError(f"{len(values)} fields at byte {start}, not {len(names)}")
        else:
            yield start, dict(zip(names, values, strict=True)), content


def _field_names(values: list[str], content: bytes) -> list[str]:
    lines = content.decode("utf-8", "replace").split("\n")
    version = lines[0].split(" ")[0]
    if not values[0].startswith("filedesc://") or not version.isdigit() or int(version) not in ARC_FIELDS:
        raise ValueError("an ARC file begins with its version block")
    return lines[1].split(" ") if len(lines) > 1 and lines[1].strip() else ARC_FIELDS[int(version)].split()


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the ARC files below ``path``, with digests; files of both versions may be mixed.

    A block that begins with an HTTP status line has its body as payload, and its X-Record-Key, which may stand
    anywhere in the header, as key. Any other block, such as that of a ``dns:`` record, is its own payload. A file is read
    whole by one task, so it may have two gigabytes at most as it is stored.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows, size = [], 0
                for start, fields, http in parse_arc(gzip.open(pa.BufferReader(content.as_buffer()))):
                    is_http = http.startswith(b"HTTP/")
                    head, _, body = http.partition(b"\r\n\r\n") if is_http else (b"", b"", http)
                    key = _KEY.search(head)
                    rows.append((
                        name, start, fields.get("URL"), fields.get("IP-address"), fields.get("Archive-date"),
                        fields.get("Content-type"), http, len(body), base32_sha1(body), base32_sha1(http),
                        int(key[1]) if key else None, is_http,
                    ))
                    size += len(http)
                    if size > CHUNK_BYTES:
                        yield _batch(rows, _RECORDS)
                        rows, size = [], 0
                yield _batch(rows, _RECORDS)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInArrow(records, _RECORDS)


# The header line that carries a record's key.
_KEY = re.compile(rb"(?m)^X-Record-Key: (-?\d+)\r?$")
_ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}


def _binary(records: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    arrays = [pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])


# ---- WARC ------------------------------------------------------------------------------------------


def warc_date(arc_date: str | None) -> str:
    """An ARC's 14 digits as a WARC timestamp; the epoch where they are no date."""
    try:
        return dt.datetime.strptime((arc_date or "")[:14], "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return "1970-01-01T00:00:00Z"


def record_id(url: str, date: str, digest: str, key: str | None) -> str:
    """The same for the same capture, whichever file it is in."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{url} {date} {digest} {key}')}>"


def warc_record(row: dict) -> bytes:
    """A WARC record without its end. A revisit has the HTTP header only, and names what it revisits.

    What is no HTTP exchange is a resource, of the content type that the ARC gave it.
    """
    http, date = row["http"], warc_date(row["date"])
    kind = "revisit" if row["revisits"] else "response" if row["is_http"] else "resource"
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(row["url"], date, row["payload_digest"], row["key"])),
        ("WARC-Date", date),
        ("WARC-Target-URI", row["url"]),
        ("WARC-IP-Address", row["ip"]),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
        ("Content-Type", "application/http; msgtype=response" if row["is_http"] else row["content_type"]),
    ]
    block_digest = row["block_digest"]
    if row["revisits"]:
        http = http.partition(b"\r\n\r\n")[0] + b"\r\n\r\n"
        block_digest = base32_sha1(http)
        other = record_id(row["refers_url"], warc_date(row["refers_date"]), row["payload_digest"], row["refers_to"])
        head += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", other),
            ("WARC-Refers-To-Target-URI", row["refers_url"]),
            ("WARC-Refers-To-Date", warc_date(row["refers_date"])),
            ("X-Refers-To-Key", row["refers_to"]),
            ("X-Payload-Length", str(row["payload_bytes"])),
        ]
    head += [("WARC-Block-Digest", f"sha1:{block_digest}"), ("Content-Length", str(len(http)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + http


def parse_warc(stream: BinaryIO) -> Iterator[tuple[dict, bytes]]:
    """(header, block) of each record; a block whose digest is not the declared one raises ValueError."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().removesuffix("\r\n").partition(": ")
            head[name] = value
        block = stream.read(int(head["Content-Length"]))
        if base32_sha1(block) != head["WARC-Block-Digest"].removeprefix("sha1:"):
            raise ValueError("a block differs from its digest")
        if stream.read(len(WARC_END)) != WARC_END.encode():
            raise ValueError("a record has no end")
        yield head, block


def convert(spark: SparkSession, arc_path: str, warc_path: str, *, min_revisit_bytes: int = 0) -> None:
    """WARC archives from the ARC archives below ``arc_path``.

    Of HTTP records with one payload of ``min_revisit_bytes`` or more, the one with the smallest key becomes the
    response and the others revisits of it. Records are shuffled once,
    by their place in the archives, which no two share; what decides is joined in narrow tables.

    - Records without a key come after those with one, by date, url and place, so archives that nobody keyed are
      deduplicated too; a revisit of such a record names it by its identifier alone.
    - Repeated keys and equal records are records of their own: one of them is the response.
    - A record that is no HTTP exchange becomes a resource and is neither revisit nor revisited.
    - Dates that are none become the epoch. Empty payloads are payloads. No records give no archives.
    """
    records = read_arc(spark, arc_path)
    meta = settle(records.drop("http", "content_type", "ip", "block_digest"), "arc-records")
    eligible = meta.filter(F.col("is_http") & (F.col("payload_bytes") >= min_revisit_bytes))
    rank = F.struct(F.col("key").isNull().alias("unkeyed"), F.coalesce("key", F.lit(0)).alias("by"), "date", "url", "archive", "start")
    first = settle(
        eligible.groupBy("payload_digest").agg(
            F.min_by(F.struct(F.col("key").alias("refers_to"), F.col("url").alias("refers_url"), F.col("date").alias("refers_date"), F.col("archive"), F.col("start")), rank).alias("first")
        ),
        "responses",
    )
    other = ~((F.col("archive") == F.col("first.archive")) & (F.col("start") == F.col("first.start")))
    refers = settle(
        eligible.join(first, "payload_digest").filter(other).select(
            "archive", "start", "first.refers_to", "first.refers_url", "first.refers_date", F.lit(True).alias("revisits")
        ),
        "revisits",
    )
    joined = records.join(refers, ["archive", "start"], "left").select(
        "url", "ip", "date", "http", "content_type", "is_http", "payload_bytes", "payload_digest", "block_digest", F.col("key").cast("string").alias("key"),
        F.coalesce("revisits", F.lit(False)).alias("revisits"), F.col("refers_to").cast("string").alias("refers_to"), "refers_url", "refers_date",
    )

    def synthesise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch):
                yield _binary([warc_record(row) for row in part.to_pylist()])

    for per_file, chosen in _by_size(joined, F.col("payload_bytes"), known=meta):
        _write_archive(chosen.mapInArrow(synthesise, "record binary"), warc_path, WARC_END, per_file)


def _pieces(batch: pa.RecordBatch, rows: int = 64) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, warc_record_id string, warc_date string, target_uri string"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the WARC archives below ``path``.

    Lengths and digests of responses and resources are computed from their payloads; revisits give those of the
    payload that they stand for. A record without a key has a null page_id, one that revisits such a record a null
    refers_to. Repeated records are rows of their own; no archives give no rows. A damaged record raises.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for head, block in parse_warc(gzip.open(pa.BufferReader(content.as_buffer()))):
                    plain = head["WARC-Type"] == "resource"
                    http, _, body = (b"", b"", block) if plain else block.partition(b"\r\n\r\n")
                    key = _KEY.search(http)
                    revisit = head["WARC-Type"] == "revisit"
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit and base32_sha1(body) != digest:
                        raise ValueError("a payload differs from its digest")
                    rows.append((
                        int(key[1]) if key else None, int(head["X-Payload-Length"]) if revisit else len(body), digest,
                        head["WARC-Type"], int(head["X-Refers-To-Key"]) if "X-Refers-To-Key" in head else None,
                        head["WARC-Record-ID"], head["WARC-Date"], head["WARC-Target-URI"],
                    ))
                yield _batch(rows, _READ)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(records, _READ)
