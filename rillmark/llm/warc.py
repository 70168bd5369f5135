"""WARC archives by chunked record tables.

Payloads travel to the archives as rows of record and chunk number: the task that writes
streams chunks into one gzip member per record, the reader streams them out again with the
digest of what has been read so far on every chunk. Before that, the write side encodes
and digests each payload whole, in one row, and joins and cuts it whole; only behind the
cut is no whole record held. Records with equal payloads are stored once; the others become revisit records
that name the first one and carry its digest and size.

Archives lie in the shared folder, under names that no other attempt uses. The writer
gives a manifest, which is stored before anything is read, so a lost executor leaves at
most files that no manifest names.

Defined results: a null payload counts as empty; a null or unprintable URL is escaped; of
records with equal payloads of at least ``least`` bytes, all rows with the smallest
page_id are responses and the others revisits; a group without any page_id is all
responses; smaller payloads are all responses. Repeated rows get a record each. An empty
table gives an empty archive. A payload that does not match its digest on reading is an
error. Extra columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.frames import stored
from rillmark.session import scratch_path

CHUNK = 1 << 20
FILE_BYTES = 256 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_table(pages: DataFrame, least: int = 0, chunk: int = CHUNK) -> DataFrame:
    """(page_id, url, payload_bytes, sha1, record_type, refers_to, chunk_no, n_chunks, chunk).

    Chunks of a record follow each other within a partition. Who is first is found on
    digests alone; payloads meet the decision by page, so equal payloads do not pile up.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"), "sha1": F.sha1("payload")})
    keys = stored(rows.select("page_id", "payload_bytes", "sha1"), "warc-digests").where(F.col("payload_bytes") >= least)
    first = keys.groupBy("sha1", "payload_bytes").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    again = keys.join(first, ["sha1", "payload_bytes"]).where("page_id is null or page_id <> first")
    again = again.select(F.col("page_id").alias("p"), F.col("sha1").alias("s"), F.col("first").alias("refers_to")).distinct()
    decided = rows.join(again, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("sha1") == F.col("s")), "left").drop("p", "s")
    decided = decided.withColumn("record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"))
    n = F.when(F.col("refers_to").isNotNull(), 1).otherwise(F.greatest(F.ceil(F.col("payload_bytes") / chunk), F.lit(1))).cast("int")
    numbered = decided.withColumn("n_chunks", n).withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)))
    piece = F.when(F.col("refers_to").isNull(), F.substring(F.col("payload"), F.col("chunk_no") * chunk + 1, F.lit(chunk))).otherwise(F.lit(b""))
    return numbered.select("page_id", "url", "payload_bytes", "sha1", "record_type", "refers_to", "chunk_no", "n_chunks", piece.alias("chunk"))


def _filesystem(folder: str):
    """The shared folder as Arrow sees it: any scheme that Arrow has a client for."""
    from pyarrow import fs

    uri = folder
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    uri = uri.replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def base32(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def _head(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def _record_head(row: dict, name: str) -> bytes:
    """Header of a record and of the HTTP message in it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    revisit = row["record_type"] == "revisit"
    page = "" if row["page_id"] is None else str(row["page_id"])
    url = f"urn:page:{page}" if row["url"] is None else quote(row["url"], safe="%/:?#[]@!$&'()*+,;=~-._")
    fields = [
        ("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"), ("WARC-Date", DATE),
        ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{base32(row['sha1'])}"), ("X-Page-ID", page),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(http) + (0 if revisit else row["payload_bytes"]))),
    ]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("X-Refers-To-Page-ID", str(row["refers_to"]))]
    return _head(fields) + http


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Manifest (path, records, bytes) of the archives written by the tasks; stored, so it is written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _filesystem(folder)
        out, path, n, size = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pylist([{"path": path, "records": n, "bytes": size}], pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

        member = None
        for batch in batches:
            columns = [c for c in batch.schema.names if c != "chunk"]
            chunks = batch.column("chunk")
            for k, row in enumerate(batch.select(columns).to_pylist()):
                if row["chunk_no"] == 0:
                    if out is not None and size >= file_bytes:
                        yield closed()
                        out = None
                    if out is None:
                        system.create_dir(root, recursive=True)
                        path, n, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = system.open_output_stream(path, compression=None)
                        info = b"software: rillmark\r\nformat: WARC File Format 1.1\r\n"
                        about = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(info)))]
                        packed = gzip.compress(_head(about) + info + b"\r\n\r\n", 1, mtime=0)
                        out.write(packed)
                        size += len(packed)
                    member = zlib.compressobj(1, zlib.DEFLATED, 31)
                    packed = member.compress(_record_head(row, f"{path}#{n}"))
                else:
                    packed = b""
                packed += member.compress(chunks[k].as_buffer())
                if row["chunk_no"] == row["n_chunks"] - 1:
                    packed += member.compress(b"\r\n\r\n") + member.flush()
                    n += 1
                out.write(packed)
                size += len(packed)
        if out is not None:
            yield closed()

    return stored(records.mapInArrow(run, "path string, records bigint, bytes bigint"), "warc-manifest")


def _fields(stream) -> tuple[str, dict[str, str]]:
    """First line and header fields of a record or message; an empty line ends them."""
    first, fields = stream.readline().decode().rstrip("\r\n"), {}
    while line := stream.readline().rstrip(b"\r\n"):
        name, _, value = line.decode().partition(":")
        fields[name.strip().lower()] = value.strip()
    return first, fields


RECORD = "page_id bigint, record_type string, refers_to bigint, record_id string, url string, payload_bytes bigint, payload_digest string, chunk_no bigint, bytes_so_far bigint, digest_so_far string, last boolean"


def records_of(stream, chunk: int, data: bool) -> Iterator[dict]:
    """Chunk rows of an open archive. At most one chunk is held."""
    number = lambda text: int(text) if text else None
    while start := stream.read(1):
        version, head = _fields(stream)
        if start + version.encode() != b"WARC/1.1":
            raise ValueError(f"not a WARC record: {version[:40]}")
        left = int(head["content-length"])
        if head["warc-type"] in ("response", "revisit"):
            block = _Counted(stream)
            _, http = _fields(block)
            left -= block.count
            digest, so_far, k = hashlib.sha1(), 0, 0
            about = {
                "page_id": number(head.get("x-page-id")), "record_type": head["warc-type"], "refers_to": number(head.get("x-refers-to-page-id")),
                "record_id": head["warc-record-id"], "url": head.get("warc-target-uri"), "payload_bytes": int(http["content-length"]),
                "payload_digest": head["warc-payload-digest"].partition(":")[2],
            }
            while True:
                piece = stream.read(min(chunk, left)) if left else b""
                if left and not piece:
                    raise ValueError("the archive ends inside a record")
                left -= len(piece)
                so_far += len(piece)
                digest.update(piece)
                row = about | {"chunk_no": k, "bytes_so_far": so_far, "digest_so_far": base64.b32encode(digest.digest()).decode(), "last": not left}
                if not left and about["record_type"] == "response" and (row["digest_so_far"], so_far) != (about["payload_digest"], about["payload_bytes"]):
                    raise ValueError(f"payload of {about['record_id']} does not match its digest")
                yield row | {"chunk": piece} if data else row
                k += 1
                if not left:
                    break
        while left:
            left -= len(stream.read(min(chunk, left)))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where it should")


class _Counted:
    """Counts the bytes of lines read."""

    def __init__(self, stream):
        self.stream, self.count = stream, 0

    def readline(self) -> bytes:
        line = self.stream.readline()
        self.count += len(line)
        return line


def read_archives(manifest: DataFrame, folder: str, chunk: int = CHUNK, data: bool = True) -> DataFrame:
    """Chunk rows of all archives of a manifest; with ``data`` the column ``chunk`` holds the bytes."""
    kinds = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    ddl = RECORD + (", chunk binary" if data else "")
    schema = pa.schema([(f.split(" ")[0], kinds[f.split(" ")[1]]) for f in ddl.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _filesystem(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with system.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    rows, held = [], 0
                    for row in records_of(stream, chunk, data):
                        rows.append(row)
                        held += len(row.get("chunk", b"")) + 200
                        if held >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    # few rows, each a file to read: one task for each
    n = max(1, min(manifest.count(), 10_000))
    return manifest.select("path").repartitionByRange(n, "path").mapInArrow(run, ddl)


def archived(pages: DataFrame, least: int = 0) -> DataFrame:
    """Writes the archives of all pages, reads them back: a row per record, from the archives alone."""
    folder = scratch_path(pages.sparkSession, "warc")
    manifest = write_archives(record_table(pages, least), folder)
    back = read_archives(manifest, folder, data=False).where("last")
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id")
